import pytest
from pyspark.sql import functions as F

from docquarry.operators import (
    Manifest,
    count_docs,
    discover_paths,
    flatten,
    flatten_cells,
    get_path,
    infer_manifest,
    keyset_page,
    keyset_spec,
    leaf_paths,
    manifest_table,
    missing_fields,
    page,
    parse_field_list,
    parse_sort,
    path_coverage,
    project,
    sort_docs,
)
from docquarry.sources import sample


def paths(df, doc=None):
    return [r.path for r in discover_paths(df, doc).collect()]


# ---- paths and projection ----


def test_path_lookup_walks_sub_documents_only(variant):
    docs = variant('{"user":{"profile":{"name":"Bob","age":30}},"arr":[{"b":1}],"s":"x","x.y":2}')
    wanted = ["user.profile.name", "user.profile.age", "user.profile.missing", "arr.b", "s.t", "x.y", "a..b"]
    row = docs.select(*[get_path(docs, p, "doc").cast("string") for p in wanted]).first()
    assert tuple(row) == ("Bob", "30", None, None, None, None, None)


def test_typed_path_does_not_map_over_arrays(spark):
    df = spark.sql("SELECT array(named_struct('b', 1)) AS arr, map('k', named_struct('z', 5)) AS m, 1 AS Big")
    row = df.select(get_path(df, "arr.b"), get_path(df, "m.k.z"), get_path(df, "m.q.z"), get_path(df, "big")).first()
    assert tuple(row) == (None, 5, None, None)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("name,age,email", ["name", "age", "email"]),
        ("name, age , email ", ["name", "age", "email"]),
        ("", []),
        ("username", ["username"]),
        ("name,,age,,,email", ["name", "age", "email"]),
    ],
)
def test_field_list(text, expected):
    assert parse_field_list(text) == expected


def test_projection_keeps_shape_and_key(spark):
    df = spark.sql(
        "SELECT 1L AS _id, named_struct('b', 2, 'c', 3) AS a, array(named_struct('x', 1, 'y', 2)) AS l, 4 AS d"
    )
    kept = project(df, "a.b,l.y,nope")
    assert kept.columns == ["_id", "a", "l"]
    assert kept.first().asDict(recursive=True) == {"_id": 1, "a": {"b": 2}, "l": [{"y": 2}]}
    assert project(df, ["a", "a.b"]).first().asDict(recursive=True)["a"] == {"b": 2, "c": 3}
    with pytest.raises(ValueError):
        project(df, " , ")


def test_variant_projection_keeps_absent_fields_absent(variant):
    docs = variant('{"a":{"b":1,"c":2},"n":null,"z":1}', '{"a":5}', '{"a":{}}')
    kept = [r[0] for r in project(docs, "a.b,n", doc="doc").select(F.to_json("doc")).collect()]
    assert kept == ['{"a":{"b":1},"n":null}', "{}", '{"a":{}}']


# ---- sort, page, count ----


@pytest.mark.parametrize(
    "text, expected",
    [
        ("name:1", {"name": 1}),
        ("created_at:-1", {"created_at": -1}),
        ("name:asc", {"name": 1}),
        ("created_at:desc", {"created_at": -1}),
        ("name", {"name": 1}),
        ("name:1,created_at:-1,age:asc", {"name": 1, "created_at": -1, "age": 1}),
        ("name : ascending , created_at : descending", {"name": 1, "created_at": -1}),
        ("a:1,b:1,a:-1", {"a": -1, "b": 1}),
    ],
)
def test_sort_spec(text, expected):
    assert parse_sort(text) == expected
    assert list(parse_sort(text)) == list(expected)


@pytest.mark.parametrize("text", ["name:invalid", "a:1,", ""])
def test_broken_sort_spec(text):
    with pytest.raises(ValueError):
        parse_sort(text)


def test_sort_puts_nulls_first_ascending_and_last_descending(spark, variant):
    df = spark.createDataFrame([(1, None), (2, "b"), (3, "a")], "_id int, v string")
    assert [r._id for r in sort_docs(df, "v:1").collect()] == [1, 3, 2]
    assert [r._id for r in sort_docs(df, "v:-1").collect()] == [2, 3, 1]
    docs = variant('{"v":"b"}', '{"v":2}', '{"v":null}', "{}", '{"v":10}', '{"v":"a"}')
    order = [r[0] for r in sort_docs(docs, "v:1", "doc").select(F.to_json("doc")).collect()]
    assert order[2:] == ['{"v":2}', '{"v":10}', '{"v":"a"}', '{"v":"b"}']


def test_variant_keys_are_taken_out_before_the_sort(variant, plan_of):
    docs = variant(*[f'{{"a":{a}}}' for a in ("2", '"x"', "null", "1.5", "[1]")])
    for found in (sort_docs(docs, "a:-1", "doc"), page(docs, "a:-1", limit=5, doc="doc")):
        orders = [line for line in plan_of(found).splitlines() if "Arguments:" in line and " DESC NULLS LAST" in line]
        assert orders and not any("variant" in line for line in orders)
        assert found.columns == ["doc"]
        assert [r[0] for r in found.select(F.to_json("doc")).collect()] == [f'{{"a":{a}}}' for a in ("[1]", '"x"', "2", "1.5", "null")]


def test_one_hot_sort_key_is_spread_over_tasks(spark):
    df = spark.range(0, 100_000, 1, 4).select("id", F.lit("same").alias("k"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = sort_docs(df, "k:1").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) >= 3 and max(r["count"] for r in sizes) < 60_000


@pytest.mark.parametrize("skip, limit", [(0, 10), (7, None), (95, 50), (100, None), (30, 40), (0, 1000), (200, 5)])
@pytest.mark.parametrize("small_page", [0, 100_000])
def test_page_equals_slice(spark, skip, limit, small_page):
    values = [(i * 37) % 100 for i in range(100)]
    df = spark.createDataFrame([(v, v // 10) for v in values], "v int, g int").repartition(5)
    got = page(df, "g:-1,v:1", skip, limit, small_page=small_page)
    expected = sorted(((v // 10, v) for v in values), key=lambda p: (-p[0], p[1]))
    expected = expected[skip:] if limit is None else expected[skip : skip + limit]
    assert [(r.g, r.v) for r in got.collect()] == expected


def test_unsorted_pages_have_the_right_size(spark):
    df = spark.range(0, 1000, 1, 7)
    assert page(df, skip=100, limit=300, small_page=10).distinct().count() == 300
    assert page(df, skip=990).count() == 10


@pytest.mark.parametrize("limit", [0, -1, 2**63])
def test_bad_limits(spark, limit):
    with pytest.raises(ValueError):
        page(spark.range(5), limit=limit)


def test_page_is_a_top_k(spark, sf_dir, plan_of):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    plan = plan_of(page(orders, "o_totalprice:-1", 10, 20).select("o_orderkey", "o_totalprice"))
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


@pytest.mark.parametrize("skip, limit, expected", [(None, None, 10), (4, None, 6), (20, None, 0), (None, 3, 3), (8, 5, 2)])
def test_count(spark, skip, limit, expected):
    assert count_docs(spark.range(20), {"id": {"$gte": 10}}, skip, limit).first()["n"] == expected


# ---- keyset ----


@pytest.mark.parametrize("cut", [0, 1, 7, 49, 50])
def test_page_and_rest_make_the_whole(spark, cut):
    df = spark.createDataFrame([(f"k{i:03d}",) for i in range(50)], "_id string").repartition(3)
    first = keyset_page(df, limit=cut).collect() if cut else []
    last = first[-1][0] if first else None
    rest = keyset_page(df, last).collect()
    assert [r[0] for r in first + rest] == [f"k{i:03d}" for i in range(50)]


def test_keyset_directions_and_limit(spark):
    df = spark.range(10).withColumnRenamed("id", "_id")
    assert [r[0] for r in keyset_page(df, 5, -1).collect()] == [4, 3, 2, 1, 0]
    assert [r[0] for r in keyset_page(df, 5, 1, limit=8, exported=6).collect()] == [6, 7]
    assert keyset_page(df, 5, 1, limit=6, exported=6).count() == 0


def test_keyset_guards(spark):
    assert keyset_spec({"_id": {"$lt": "z"}}, "m", "_id:1") == {"$and": [{"_id": {"$lt": "z"}}, {"_id": {"$gt": "m"}}]}
    assert keyset_spec({}, "m", {"_id": -1}) == {"_id": {"$lt": "m"}}
    for sort, message in ((None, "without a recorded sort"), ("created_at:1", "only an export sorted by"), ("_id:1,a:1", "only an export sorted by")):
        with pytest.raises(ValueError, match=message):
            keyset_spec({}, "m", sort)
    with pytest.raises(ValueError, match="direction"):
        keyset_spec({}, "m", {"_id": 2})
    with pytest.raises(ValueError, match="no cursor position"):
        keyset_page(spark.range(1), exported=5, key="id")


def test_keyset_predicate_reaches_the_scan(spark, sf_dir, plan_of):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey")
    plan = plan_of(keyset_page(orders, 500, limit=10, key="o_orderkey"))
    assert "GreaterThan(o_orderkey,500)" in plan and "TakeOrderedAndProject" in plan


# ---- discovery, manifest, flatten ----


def test_discovery_of_flat_nested_and_deep_documents(variant):
    assert paths(variant('{"name":"A","age":1,"email":"e"}'), "doc") == ["age", "email", "name"]
    nested = variant('{"name":"A","address":{"city":"c","country":"d","zip":"z"},"age":1}')
    assert paths(nested, "doc") == ["address.city", "address.country", "address.zip", "age", "name"]
    deep = variant('{"user":{"profile":{"name":"n","contact":{"email":"e"}}}}')
    assert paths(deep, "doc") == ["user.profile.contact.email", "user.profile.name"]


def test_discovery_rules(variant):
    docs = variant('{"a":1,"e":{},"n":null,"l":[{"x":1}],"B":1}', '{"a":{"b":1}}', "[1]", "5")
    assert paths(docs, "doc") == ["B", "a", "a.b", "l", "n"]
    assert paths(docs.repartition(3), "doc") == ["B", "a", "a.b", "l", "n"]
    assert dict(path_coverage(docs, "doc").collect()) == {"B": 1, "a": 1, "a.b": 1, "l": 1, "n": 1}


def test_discovery_of_any_depth_and_any_name(variant):
    odd = '{"a<b>":{"c: d,e":{"`q`":[{"x":1}],"":null}},"OBJECT":{"ARRAY":[[1]]},"1":{"日本":2.50},"x.y":{}}'
    docs = variant('{"n":' * 50 + '{"last":1}' + "}" * 50, odd)
    expected = sorted([".".join("n" * 50) + ".last", "a<b>.c: d,e.`q`", "a<b>.c: d,e.", "OBJECT.ARRAY", "1.日本"])
    assert paths(docs, "doc") == expected
    listed = [set(r[0]) for r in docs.select(leaf_paths(docs, "doc")).collect()]
    assert set().union(*listed) == set(expected) and listed[0] == {".".join("n" * 50) + ".last"}


def test_documents_are_counted_by_shape(variant, plan_of):
    docs = variant('{"a":1,"b":{"c":"x"}}', '{"a":2,"b":{"c":"y"}}', '{"a":"z"}', "7", "[1]", "null")
    assert dict(path_coverage(docs, "doc").collect()) == {"a": 3, "b.c": 2}
    assert infer_manifest(docs, doc="doc").sample_size == 6
    plan = plan_of(path_coverage(docs, "doc"))
    tree = plan[: plan.index("\n\n")]
    assert tree.rindex("HashAggregate") > tree.index("MapInArrow")  # the tree is printed from the top


def test_manifest_table_and_cells(spark, variant, out):
    docs = variant('{"b":{"c":[1,"x"]},"a":1.50}', '{"b":5,"it\'s":null}', "{}").withColumn("k", F.monotonically_increasing_id())
    table = manifest_table(docs.select("doc"), out("manifest"), "doc")
    assert [r.path for r in table.orderBy("position").collect()] == ["a", "b", "b.c", "it's"]
    rows = flatten_cells(docs, table, "doc").orderBy("k").collect()
    assert [r.cells for r in rows] == [["1.5", '{"c":[1,"x"]}', "[1,x]", None], [None, "5", None, None], [None] * 4]
    with pytest.raises(ValueError, match="VARIANT"):
        flatten_cells(spark.range(1), table, "id")


def test_typed_discovery_mixes_fixed_and_open_keys(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, named_struct('x', 1, 'y', cast(null as int)), map('k', 1), parse_json('{\"v\":{\"w\":1}}')), "
        "(null, null, map('q', 2), null) AS t(id, s, m, doc)"
    )
    assert dict(path_coverage(df).collect()) == {"id": 1, "s.x": 1, "m.k": 1, "m.q": 1, "doc.v.w": 1}


def test_typed_discovery_is_one_keyless_aggregate(spark, sf_dir, plan_of):
    plan = plan_of(path_coverage(spark.read.parquet(f"{sf_dir}/lineitem.parquet")))
    assert "Generate" in plan and "hashpartitioning" not in plan


def test_manifest_inference(variant):
    manifest = infer_manifest(variant('{"b":1,"a":{"c":null}}', '{"d":[]}'), doc="doc")
    assert manifest.paths == ("a.c", "b", "d") and manifest.sample_size == 2
    for empty in (variant("{}"), variant('{"a":{}}').limit(0)):
        with pytest.raises(ValueError):
            infer_manifest(empty, doc="doc")


def test_manifest_sample_takes_first_documents(spark):
    df = spark.createDataFrame([(i, None if i < 5 else i) for i in range(10)], "_id int, late int")
    assert infer_manifest(df, 5, "_id").paths == ("_id",)
    with pytest.raises(ValueError):
        infer_manifest(df, 0)
    assert sample(df, 5, "_id", limit=3).count() == 3


def test_manifest_digest_ignores_provenance():
    first = Manifest(("name",), 1, "2024-01-01")
    second = Manifest(("name",), 999, "2024-01-02")
    assert first.digest() == second.digest() != Manifest(("other",)).digest()


def test_manifest_round_trip_and_rules(spark, out):
    manifest = Manifest(("a", "b.c"), 7)
    manifest.save(spark, out("m.json"))
    assert Manifest.load(spark, out("m.json")) == manifest
    with pytest.raises(FileExistsError):
        manifest.save(spark, out("m.json"))
    good = manifest.to_dict()
    for change in (
        {"version": 2},
        {"fields": []},
        {"fields": [{"path": " ", "kind": "string", "nullable": True}]},
        {"fields": good["fields"] + good["fields"][:1]},
        {"fields": [{"path": "a", "kind": "int", "nullable": True}]},
        {"fields": [{"path": "a", "kind": "string", "nullable": False}]},
    ):
        with pytest.raises(ValueError):
            Manifest.from_dict({**good, **change})


def test_flatten_missing_null_and_empty(variant):
    docs = variant('{"empty":"","null":null,"nested":{"empty":""}}')
    names = ["empty", "null", "missing", "nested.empty"]
    assert tuple(flatten(docs, names, "null", "doc").first()) == ("", None, None, "")
    assert tuple(flatten(docs, names, "empty", "doc").first()) == ("", "", "", "")


def test_missing_fields(variant):
    docs = variant('{"a":1,"address":{"city":"x"}}')
    rows = missing_fields(docs, ["zip", "a", "address", "address.city"], "doc").collect()
    assert [tuple(r) for r in rows] == [(0, "zip"), (2, "address")]


def test_cells_of_a_manifest_follow_the_documents(spark):
    """One row of values for each document, also with names that no path expression can quote."""
    texts = ["""{"a'\\"b":1,"s":{"t":[2,null],"u.v":3},"z":null}""", "[1]", "{}", None, """{"s":{"t":"x"}}"""]
    docs = spark.createDataFrame(list(enumerate(texts)), "_id long, text string").select("_id", F.parse_json("text").alias("doc"))
    paths = ["no", "z", "s.t", "s.u.v", "a'\"b", "s", "s.t"]
    manifest = spark.createDataFrame([(10 * i, p) for i, p in enumerate(paths)], "position long, path string")
    got = {r._id: r.cells for r in flatten_cells(docs, manifest, "doc").collect()}
    empty = [None] * 7
    first = [None, None, "[2,]", None, "1", '{"t":[2,null],"u.v":3}', "[2,]"]
    assert got == {0: first, 1: empty, 2: empty, 3: empty, 4: [None, None, "x", None, None, '{"t":"x"}', "x"]}


def test_paths_of_wide_schemas_leave_in_bounded_batches():
    import pyarrow as pa

    from docquarry.functions.shapes import ROWS, path_rows

    schema = f"OBJECT<{', '.join(f'p{i}: BIGINT' for i in range(999))}>"
    batch = pa.RecordBatch.from_pydict({"schema": [schema] * 45 + [None], "documents": list(range(45)) + [9]})
    found = list(path_rows(iter([batch])))
    assert max(b.num_rows for b in found) <= ROWS and sum(b.num_rows for b in found) == 45_000
    assert sum(sum(b.column("documents").to_pylist()) for b in found) == 1000 * sum(range(45))
