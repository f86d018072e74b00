import datetime as dt
import json
import random
import struct
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from docquarry.functions import document_json, double_text, render, row_digest
from docquarry.functions.variants import render_variant
from docquarry.operators import flatten


def cells(df):
    columns = [render(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields]
    return df.select(*columns).first()


def test_scalars(spark):
    df = spark.sql("SELECT 'test' s, 42 i, 9999L l, 2.5D d, true b, null n, 1.5D f")
    assert tuple(cells(df)) == ("test", "42", "9999", "2.5", "true", None, "1.5")


def test_doubles_are_positional_and_round_trip(spark):
    rng = random.Random(7)
    values = [0.0, -0.0, 1.0, 2.5, -3.0, 1e7, 1e21, -1.5e-7, 123456789.125, 5e-324, 1.7976931348623157e308, 0.001]
    values += [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3000)]
    values = [v for v in values if v == v and abs(v) != float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for row in df.select("x", double_text(F.col("x")).alias("t")).collect():
        assert "E" not in row.t and "e" not in row.t
        assert not row.t.endswith(".0") and not row.t.endswith(".")
        assert float(row.t) == row.x
        assert row.t.startswith("-") == (str(row.x).startswith("-"))


def test_double_specials(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (None,)], "x double")
    assert [r[0] for r in df.select(double_text(F.col("x"))).collect()] == ["NaN", "inf", "-inf", None]


def test_decimals_lose_padding_in_every_mode(spark):
    df = spark.createDataFrame(
        [(Decimal("1.5"), Decimal("-0.00000000000000123"), Decimal("-20"), Decimal("120"), Decimal("0"))],
        "a decimal(38,18), b decimal(38,18), c decimal(20,4), d decimal(9,0), e decimal(38,18)",
    )
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            assert tuple(cells(df)) == ("1.5", "-0.00000000000000123", "-20", "120", "0")
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_binary_arrays_and_nested(spark):
    df = spark.sql(
        "SELECT X'01FF' AS bin, array('a', null, 'b') AS arr, array(array(1, 2), array()) AS deep, "
        "named_struct('k', 'v\"', 'n', cast(null as int)) AS doc, map('x', 1.0D) AS m"
    )
    row = cells(df)
    assert row.bin == "01ff"
    assert row.arr == "[a,,b]"
    assert row.deep == "[[1,2],[]]"
    assert json.loads(row.doc) == {"k": 'v"', "n": None}
    assert json.loads(row.m) == {"x": 1.0}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_datetimes_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql(
            "SELECT timestamp_millis(1699000000000) a, timestamp_millis(1699000000123) b, "
            "timestamp_micros(-1) c, timestamp_ntz'2024-03-10 02:30:00.5' d, date'2024-02-29' e"
        )
        assert tuple(cells(df)) == (
            "2023-11-03T08:26:40.000Z",
            "2023-11-03T08:26:40.123Z",
            "1969-12-31T23:59:59.999Z",
            "2024-03-10T02:30:00.500Z",
            "2024-02-29T00:00:00.000Z",
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_out_of_range_datetime_becomes_millis(spark):
    df = spark.sql("SELECT timestamp_millis(253402300800000) a, timestamp_millis(253402300799999) b")
    assert tuple(cells(df)) == ("253402300800000", "9999-12-31T23:59:59.999Z")


def test_wrapped_values(spark):
    schema = T.StructType.fromDDL(
        "oid struct<`$oid`:string>, re struct<`$regularExpression`:struct<pattern:string,options:string>>, "
        "ts struct<`$timestamp`:struct<t:bigint,i:bigint>>, code struct<`$code`:string>, low struct<`$minKey`:int>"
    )
    df = spark.createDataFrame([(("507f1f77bcf86cd799439011",), (("^a", "i"),), ((5, 2),), ("f()",), (1,))], schema)
    assert tuple(cells(df)) == ("507f1f77bcf86cd799439011", "/^a/i", "5.2", "f()", "")
    plain = json.loads(df.select(document_json(df, "plain")).first()[0])
    assert plain == {"oid": "507f1f77bcf86cd799439011", "re": "/^a/i", "ts": "5.2", "code": "f()", "low": None}


def test_variant_cells(variant):
    docs = variant('{"mixed":["a","b",1],"tags":["rust",null,[1.50,true]],"big":1e21,"one":1.0,"obj":{"b":1,"a":null}}')
    row = flatten(docs, ["mixed", "tags", "big", "one", "obj", "none"], doc="doc").first()
    assert tuple(row) == ("[a,b,1]", "[rust,,[1.5,true]]", "1000000000000000000000", "1", '{"a":null,"b":1}', None)


def test_variant_of_typed_values(spark):
    df = spark.sql(
        "SELECT to_variant_object(named_struct('t', timestamp_millis(1699000000000), 'b', X'0A', 'f', 1.0e30D, "
        "'n', 'nan', 'd', cast(1.50 as decimal(9,4)))) AS doc"
    )
    row = flatten(df, ["t", "b", "f", "n", "d"], doc="doc").first()
    assert tuple(row) == ("2023-11-03T08:26:40.000Z", "0a", "1" + "0" * 30, "nan", "1.5")


def test_no_nesting_is_too_deep(variant):
    texts = ["[" * 60 + "1" + "]" * 60, '["x",[1,' * 30 + "2" + "]]" * 30, "[[],[[]],1]", '{"a":' * 70 + '["<",{"}":[1.0]}]' + "}" * 70]
    docs = variant(*texts)
    cells = [r[0] for r in docs.select(render_variant(F.col("doc"))).collect()]
    assert cells[:3] == [t.replace('"', "") for t in texts[:3]]
    canonical = [json.loads(r[0]) for r in docs.select(document_json(docs, "canonical", "doc")).collect()]

    def plain(value):
        if isinstance(value, list):
            return [plain(x) for x in value]
        if isinstance(value, dict) and next(iter(value), "").startswith("$number"):
            return float(value["$numberDouble"]) if "$numberDouble" in value else int(value["$numberInt"])
        return {k: plain(v) for k, v in value.items()} if isinstance(value, dict) else value

    assert [plain(c) for c in canonical] == [json.loads(t) for t in texts]


def test_instants_below_mixed_arrays(spark):
    df = spark.sql(
        "SELECT to_variant_object(named_struct('l', array(parse_json('1'), to_variant_object(named_struct('t', "
        "timestamp_millis(1699000000000)))))) AS doc"
    )
    assert df.select(document_json(df, "plain", "doc")).first()[0] == '{"l":[1,{"t":"2023-11-03T08:26:40.000Z"}]}'


def test_plain_json_has_no_wrappers(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2023, 11, 3, 8, 26, 40), Decimal("1.5"), b"\x01\xab", float("nan"), ("alice",), ["a", None])],
        "i int, ts timestamp, amount decimal(38,18), raw binary, x double, nested struct<name:string>, tags array<string>",
    )
    text = df.select(document_json(df, "plain")).first()[0]
    assert "$" not in text
    assert json.loads(text) == {
        "i": 1,
        "ts": "2023-11-03T08:26:40.000Z",
        "amount": "1.5",
        "raw": "01ab",
        "x": None,
        "nested": {"name": "alice"},
        "tags": ["a", None],
    }


def test_canonical_and_relaxed_json(spark):
    df = spark.createDataFrame(
        [(1, 5, 1.0, float("-inf"), dt.datetime(1969, 12, 31, 23, 59, 59), b"\x01", Decimal("2.50"), {"k": 7})],
        "i int, l bigint, d double, inf double, ts timestamp, raw binary, dec decimal(9,2), m map<string,int>",
    )
    read = lambda mode: json.loads(df.select(document_json(df, mode)).first()[0])
    assert read("canonical") == {
        "i": {"$numberInt": "1"},
        "l": {"$numberLong": "5"},
        "d": {"$numberDouble": "1.0"},
        "inf": {"$numberDouble": "-Infinity"},
        "ts": {"$date": {"$numberLong": "-1000"}},
        "raw": {"$binary": {"base64": "AQ==", "subType": "00"}},
        "dec": {"$numberDecimal": "2.5"},
        "m": {"k": {"$numberInt": "7"}},
    }
    relaxed = read("relaxed")
    assert relaxed["i"] == 1 and relaxed["l"] == 5 and relaxed["d"] == 1.0
    assert relaxed["inf"] == {"$numberDouble": "-Infinity"}
    assert relaxed["ts"] == {"$date": {"$numberLong": "-1000"}}  # before 1970: not readable


def test_canonical_json_of_variant(variant):
    docs = variant('{"a":[1,{"b":5000000000}],"s":"q\\"\\u00e9","x":1.5,"one":1.0,"e":{},"l":[],"n":null,"t":true}')
    assert json.loads(docs.select(document_json(docs, "canonical", "doc")).first()[0]) == {
        "a": [{"$numberInt": "1"}, {"b": {"$numberLong": "5000000000"}}],
        "s": 'q"é',
        "x": {"$numberDouble": "1.5"},
        "one": {"$numberDouble": "1.0"},
        "e": {},
        "l": [],
        "n": None,
        "t": True,
    }


def test_unknown_json_mode(spark):
    with pytest.raises(ValueError, match="unknown JSON mode"):
        document_json(spark.range(1), "loose")


def test_row_digest_separates_cells(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), (None, ""), ("", None)], "x string, y string")
    assert df.select(row_digest(df)).distinct().count() == 4


def canonical(value):
    """Canonical JSON of a value that JSON text gives."""
    if isinstance(value, dict):
        return "{" + ",".join(f"{json.dumps(k)}:{canonical(v)}" for k, v in sorted(value.items())) + "}"
    if isinstance(value, list):
        return "[" + ",".join(map(canonical, value)) + "]"
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return json.dumps(value)
    return f'{{"$number{"Int" if isinstance(value, int) else "Double"}":"{value}"}}'


def test_branches_and_brackets_of_a_variant(variant):
    branch = lambda n, end: {"a": 1, "n": branch(n - 1, end), "z": [True]} if n else end
    docs = [
        branch(9, [[], {}, [[None, "x"], 2.5]]), {"l": branch(5, "[[{"), "m": "]}", "r": branch(12, [branch(3, {"k": 7})])},
        [], {}, [[]], [{"a": {}}, {"b": [1, "c", {"d": []}]}], "[{", 3, None, {"[": {"{": ["]"]}}, [[1, [2, [3, [4]]]], {"e": None}],
    ]
    docs = variant(*map(json.dumps, docs), None), docs
    rows = docs[0].select(document_json(docs[0], "canonical", "doc").alias("text")).collect()
    assert [r.text for r in rows] == [canonical(d) for d in docs[1]] + [None]


def test_long_chains_of_a_variant_in_time(variant):
    """A level costs what is still closed there, not what was opened before it."""
    depth, count = 900, 100
    docs = variant(*['{"n":' * depth + f"[{k}]" + "}" * depth for k in range(count)])
    begin = time.monotonic()
    rows = docs.select(document_json(docs, "canonical", "doc").alias("text")).collect()
    assert time.monotonic() - begin < 60
    assert [r.text for r in rows] == ['{"n":' * depth + f'[{{"$numberInt":"{k}"}}]' + "}" * depth for k in range(count)]


def extended(x):
    """Canonical form of a parsed JSON value, fields by name."""
    if isinstance(x, dict):
        return {k: extended(v) for k, v in sorted(x.items())}
    if isinstance(x, list):
        return [extended(v) for v in x]
    if isinstance(x, bool) or x is None or isinstance(x, str):
        return x
    if isinstance(x, float):
        return {"$numberDouble": repr(x)}
    return {"$numberInt" if -(2**31) <= x < 2**31 else "$numberLong": str(x)}


def test_canonical_json_keeps_what_stands_around_its_leaves(variant):
    wide = {"n": [1.0, "x"]}
    for level in range(30):
        wide = {"a": list(range(20)), "n": wide, "z": [level, [2.0, "y"]] * 10}
    values = [
        {},
        [],
        [[], {}, [{}], 1],
        {"a": {}, "b": 1, "c": [], "d": [None, True, ["\\", '"', '\\"]},{', ""]]},
        {"line": "ends\n", "a:b,c": "\r", "q\"'{[": {"\\": -0.5, "é😀": 2**40}, "z\n": " "},
        "ends\n",
        "7",
        7,
        1.0,
        None,
        False,
        wide,
    ]
    docs = variant(*[json.dumps(v) for v in values], None)
    texts = [r[0] for r in docs.select(document_json(docs, "canonical", "doc")).collect()]
    assert texts == [json.dumps(extended(v), separators=(",", ":"), ensure_ascii=False) for v in values] + [None]


def test_json_of_a_variant_asks_a_leaf_for_its_kind_once(variant):
    docs = variant('{"a":[1,"x"]}')
    for mode, others in (("canonical", 0), ("plain", 1), ("relaxed", 1)):
        text = docs.select(document_json(docs, mode, "doc").alias("text"))
        # Plain and relaxed look at the schema of the whole document too.
        plan = text._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("SchemaOfVariant.schemaOfVariant(") == 1 + others, mode


@pytest.mark.parametrize("mode", ["canonical", "plain", "relaxed"])
def test_json_of_a_variant_reads_a_leaf_once(spark, mode):
    docs = spark.sql(
        "SELECT parse_json(s) AS doc FROM VALUES ('{}'), (null) AS t(s) UNION ALL SELECT to_variant_object(named_struct("
        "'t', timestamp_micros(-1), 'far', timestamp_millis(253402300800000), 'l', timestamp_ntz'2024-03-10 02:30:00.5', "
        "'d', array(date'0001-01-01', null), 'f', cast(1.1 AS float), 'n', array(cast('-inf' AS double), 1e30D, 2.0D)))"
    )
    text = docs.select(document_json(docs, mode, "doc").alias("text"))
    plan = text._jdf.queryExecution().optimizedPlan().toString()
    for kind in ("TimestampType", "TimestampNTZType", "DateType", "DoubleType"):
        assert plan.count(f", $, {kind}, ") == 1, kind
    assert plan.count("timestampadd(MICROSECOND") == (mode != "canonical")
    wanted = {
        "canonical": '{"d":[{"$date":{"$numberLong":"-62135596800000"}},null],"f":{"$numberDouble":"1.100000023841858"},'
        '"far":{"$date":{"$numberLong":"253402300800000"}},"l":{"$date":{"$numberLong":"1710037800500"}},'
        '"n":[{"$numberDouble":"-Infinity"},{"$numberDouble":"1000000000000000000000000000000.0"},{"$numberDouble":"2.0"}],'
        '"t":{"$date":{"$numberLong":"-1"}}}',
        "plain": '{"d":["0001-01-01T00:00:00.000Z",null],"f":1.1,"far":"253402300800000","l":"2024-03-10T02:30:00.500Z",'
        '"n":[null,1.0E30,2.0],"t":"1969-12-31T23:59:59.999Z"}',
        "relaxed": '{"d":[{"$date":{"$numberLong":"-62135596800000"}},null],"f":1.1,"far":{"$date":{"$numberLong":"253402300800000"}},'
        '"l":{"$date":"2024-03-10T02:30:00.500Z"},"n":[{"$numberDouble":"-Infinity"},1.0E30,2.0],"t":{"$date":{"$numberLong":"-1"}}}',
    }
    assert [r.text for r in text.collect()] == ["{}", None, wanted[mode]]
