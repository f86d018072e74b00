import datetime as dt

import pytest

from docquarry.operators import combine, where
from docquarry.plans import parse_query

OID = "507f1f77bcf86cd799439011"


@pytest.fixture(scope="module")
def people(spark):
    return spark.createDataFrame(
        [
            (1, "Ann", 30, 1.5, dt.datetime(2024, 1, 1), ("x",), OID, ["a"]),
            (2, "bob", 17, float("nan"), dt.datetime(2023, 1, 1), ("y",), "0" * 24, ["b"]),
            (3, None, None, None, None, None, None, None),
        ],
        "_id bigint, name string, age int, score double, born timestamp, sub struct<k:string>, oid string, tags array<string>",
    )


def ids(df):
    return sorted(r[0] for r in df.select("_id").collect())


@pytest.mark.parametrize(
    "spec, expected",
    [
        ({}, [1, 2, 3]),
        ({"name": "Ann"}, [1]),
        ({"age": {"$gte": 18}}, [1]),
        ({"age": {"$gt": 17, "$lt": 31}}, [1]),
        ({"age": {"$lte": 17}}, [2]),
        ({"age": {"$ne": 30}}, [2, 3]),
        ({"age": {"$in": [17, 99]}}, [2]),
        ({"age": {"$in": [17, None]}}, [2, 3]),
        ({"age": {"$nin": [17]}}, [1, 3]),
        ({"age": {"$nin": [17, None]}}, [1]),
        ({"age": {"$not": {"$gt": 18}}}, [2, 3]),
        ({"name": None}, [3]),
        ({"name": {"$ne": None}}, [1, 2]),
        ({"name": {"$exists": True}}, [1, 2]),
        ({"gone": {"$exists": False}}, [1, 2, 3]),
        ({"gone": None}, [1, 2, 3]),
        ({"gone": 1}, []),
        ({"name": {"$regex": "^B", "$options": "i"}}, [2]),
        ({"name": {"$regex": "^A"}}, [1]),
        ({"name": {"$regularExpression": {"pattern": "N", "options": "i"}}}, [1]),
        ({"sub.k": "x"}, [1]),
        ({"tags.k": "x"}, []),
        ({"age": "30"}, []),
        ({"name": 5}, []),
        ({"score": {"$gt": 1}}, [1]),
        ({"born": {"$gte": {"$date": "2023-06-01T00:00:00Z"}}}, [1]),
        ({"born": {"$lt": {"$date": {"$numberLong": "1704067200000"}}}}, [2]),
        ({"oid": {"$oid": OID.upper()}}, [1]),
        ({"age": {"$numberLong": "30"}}, [1]),
        ({"score": {"$numberDecimal": "1.5"}}, [1]),
        ({"$and": [{"age": 30}, {"name": "Ann"}]}, [1]),
        ({"$or": [{"age": 17}, {"name": "Ann"}]}, [1, 2]),
    ],
)
def test_specs(people, spec, expected):
    assert ids(where(people, spec)) == expected


@pytest.mark.parametrize(
    "spec",
    [
        {"age": {"$near": 1}},
        {"$where": "1"},
        {"age": {"$in": 5}},
        {"sub": {"k": "x"}},
        {"oid": {"$oid": "xyz"}},
        {"name": {"$regex": "a", "$options": "q"}},
        {"$and": []},
        {"age": {"$gt": None}},
    ],
)
def test_unknown_or_broken_specs_raise(people, spec):
    with pytest.raises(ValueError):
        where(people, spec)


def test_query_text_must_be_an_object():
    assert parse_query('{"_id":{"$oid":"%s"}}' % OID) == {"_id": {"$oid": OID}}
    with pytest.raises(ValueError):
        parse_query("[]")


def test_variant_values_match_their_own_kind_only(variant):
    docs = variant('{"a":1}', '{"a":"1"}', '{"a":1.5}', '{"a":true}', '{"a":null}', "{}", '{"a":9007199254740993}')
    count = lambda spec: where(docs, spec, "doc").count()
    assert count({"a": 1}) == 1
    assert count({"a": "1"}) == 1
    assert count({"a": True}) == 1
    assert count({"a": {"$gt": 1}}) == 2
    assert count({"a": 9007199254740993}) == 1
    assert count({"a": 9007199254740992}) == 0
    assert count({"a": None}) == 2
    assert count({"a": {"$exists": True}}) == 6
    assert count({"a": {"$ne": 1}}) == 6
    assert count({"a": {"$regex": "^1"}}) == 1


def test_combine():
    assert combine({}, {"a": 1}) == {"a": 1}
    assert combine({"b": 2}, {"a": 1}) == {"$and": [{"b": 2}, {"a": 1}]}


def test_filters_reach_the_scan(spark, sf_dir, plan_of):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    spec = {
        "o_orderstatus": {"$in": ["F", "O"]},
        "o_totalprice": {"$gte": 10},
        "o_orderpriority": {"$regex": "^1-"},
        "o_orderdate": {"$lt": {"$date": "2000-01-01T00:00:00Z"}},
        "o_custkey": {"$ne": 5},
    }
    plan = plan_of(where(orders, spec).select("o_orderkey"))
    pushed = next(line for line in plan.splitlines() if line.startswith("PushedFilters"))
    for part in ("In(o_orderstatus", "GreaterThanOrEqual(o_totalprice", "StringStartsWith(o_orderpriority", "o_orderdate", "o_custkey"):
        assert part in pushed


def test_a_filter_parses_each_document_once(spark, sf_dir, plan_of):
    from docquarry.checks.fixtures import mixed_documents

    spec = {"$or": [{"props.k": {"$gte": 50, "$lt": 90}}, {"user.type": {"$in": ["click", None]}}], "user": {"$exists": True}}
    plan = plan_of(where(mixed_documents(spark, sf_dir), spec, "doc"))
    assert plan.count("parseJson") == 2  # once to filter, once for the column of the result


def test_paths_below_a_path_and_odd_names_of_a_spec(variant):
    docs = variant('{"a":{"b":1,"B":2},"c`d":5}', '{"a":null,"c`d":5}', '{"a":7}', "[1]", "null")

    def count(spec):
        return where(docs, spec, "doc").count()

    assert count({"a": {"$exists": True}, "a.b": 1}) == 1
    assert count({"a": None}) == 3 and count({"a": {"$exists": False}}) == 2
    assert count({"a.b": 1, "a.B": 2}) == 1 and count({"c`d": {"$gt": 4}}) == 2
    assert count({"a.": 1}) == 0 and count({}) == 5
