import csv
import datetime as dt
import glob
import gzip
import io
import json
from decimal import Decimal

import pytest
from bson_reader import document_at, documents
from pyspark.sql import functions as F, types as T

from docquarry.operators import Manifest
from docquarry.sinks import encode, encode_bson, output_digest, part_digests, write


def parts(path, pattern="part-*"):
    return sorted(glob.glob(f"{path}/{pattern}"))


def read_all(path):
    return b"".join(open(p, "rb").read() for p in parts(path))


NASTY = ['say "hi"', "a,b", "two\nlines", "cr\rhere", " pad ", "", "naïve ☃", "tab\t", "#x", "\\", "'", ","]


def test_csv_matches_the_usual_quoting(spark, out):
    rows = [(i, text) for i, text in enumerate(NASTY)]
    df = spark.createDataFrame(rows, "id int, text string").coalesce(1)
    write(encode(df, "csv", Manifest.of(["id", "text"])), "csv", out("csv"))
    data = read_all(out("csv")).decode()
    back = list(csv.reader(io.StringIO(data, newline="")))
    assert back[0] == ["id", "text"]
    assert back[1:] == [[str(i), text] for i, text in rows]
    assert "\n0,\"say \"\"hi\"\"\"\n" in data and "\n5,\n" in data


def test_one_column_csv_keeps_empty_rows(spark, out):
    df = spark.createDataFrame([("",), ("x",), (None,)], "a string").coalesce(1)
    write(encode(df, "csv", Manifest.of(["a"])), "csv", out("csv"))
    assert [r for r in csv.reader(io.StringIO(read_all(out("csv")).decode()))] == [["a"], [""], ["x"], [""]]


def test_parquet_keeps_null_and_empty_apart(spark, out):
    df = spark.createDataFrame([("", None, 1)], "a string, b string, c int")
    write(encode(df, "parquet", Manifest.of(["c", "a", "b", "zz"])), "parquet", out("p"), "gzip")
    back = spark.read.parquet(out("p"))
    assert [f.dataType for f in back.schema.fields] == [T.StringType()] * 4
    assert tuple(back.first()) == ("1", "", None, None)
    assert all(".gz." in p for p in parts(out("p")))


def test_jsonl_and_gzip(spark, out):
    df = spark.createDataFrame([(i, "x\ny") for i in range(5)], "i int, s string").repartition(2)
    write(encode(df, "jsonl", json_mode="plain"), "jsonl", out("j"), "gzip")
    lines = [json.loads(line) for p in parts(out("j")) for line in gzip.open(p, "rt", encoding="utf-8")]
    assert sorted(d["i"] for d in lines) == list(range(5)) and lines[0]["s"] == "x\ny"


@pytest.mark.parametrize("rows", [0, 1, 2, 25_000])
def test_json_array_parts_are_arrays(spark, out, rows):
    df = spark.range(0, rows, 1, 3)
    write(encode(df, "json", json_mode="plain"), "json", out("a"))
    files = parts(out("a"))
    assert files
    found = [d["id"] for p in files for d in json.load(open(p))]
    assert sorted(found) == list(range(rows))
    first = open(files[0], "rb").read()
    assert first.startswith(b"[\n") and first.endswith(b"\n]\n")


def test_json_array_separators(spark, out):
    df = spark.createDataFrame([(1,), (2,)], "a int").coalesce(1)
    write(encode(df, "json", json_mode="plain"), "json", out("a"))
    assert read_all(out("a")) == b'[\n{"a":1},\n{"a":2}\n]\n'


@pytest.mark.parametrize("compression", ["none", "gzip"])
@pytest.mark.parametrize("first", [90, 100])
def test_json_array_with_empty_partitions(spark, out, compression, first):
    df = spark.range(0, 100, 1, 4).filter(f"id >= {first}")
    write(encode(df, "json", json_mode="plain"), "json", out("a"), compression)
    open_part = gzip.open if compression == "gzip" else open
    assert parts(out("a"))
    assert sorted(d["id"] for p in parts(out("a")) for d in json.load(open_part(p))) == list(range(first, 100))


def test_bson_of_every_type(spark):
    schema = T.StructType.fromDDL(
        "i int, l bigint, d double, f float, s string, t boolean, n string, ts timestamp, ntz timestamp_ntz, day date, "
        "bin binary, dec decimal(38,18), neg decimal(9,2), arr array<string>, deep array<array<int>>, "
        "sub struct<a:int,b:struct<c:string>>, m map<string,bigint>, oid struct<`$oid`:string>, "
        "re struct<`$regularExpression`:struct<pattern:string,options:string>>, "
        "st struct<`$timestamp`:struct<t:bigint,i:bigint>>, code struct<`$code`:string>, low struct<`$minKey`:int>"
    )
    stamp = dt.datetime(1969, 12, 31, 23, 59, 59, 999_900)
    full = (
        1, 2**40, 2.5, 0.5, "héllo", True, None, stamp, stamp, dt.date(1970, 1, 2),
        b"\x00\xff", Decimal("1.5"), Decimal("-0.07"), ["a", None, ""], [[1], [], None],
        (7, ("x",)), {"k": 1, "j": 2}, ("507f1f77bcf86cd799439011",),
        (("^a", "i"),), ((5, 2),), ("f()",), (1,),
    )
    empty = (None,) * len(full)
    df = spark.createDataFrame([full, empty, full], schema).coalesce(1)
    first, second, third = [document_at(bytes(r.bson), 0)[0] for r in encode_bson(df).collect()]
    assert first == third == {
        "i": ("int32", 1), "l": 2**40, "d": 2.5, "f": 0.5, "s": "héllo", "t": True, "n": None,
        "ts": ("date", -1), "ntz": ("date", -1), "day": ("date", 86_400_000), "bin": b"\x00\xff",
        "dec": ("decimal", 15, -1), "neg": ("decimal", -7, -2), "arr": ["a", None, ""],
        "deep": [[("int32", 1)], [], None], "sub": {"a": ("int32", 7), "b": {"c": "x"}}, "m": {"k": 1, "j": 2},
        "oid": ("oid", "507f1f77bcf86cd799439011"), "re": ("regex", "^a", "i"), "st": ("timestamp", 5, 2),
        "code": ("code", "f()"), "low": ("key", 0xFF),
    }
    assert second == dict.fromkeys(first)


def test_bson_files_are_plain_concatenations(spark, out):
    rows = [(i, "x" * (i % 50), [i] * (i % 4)) for i in range(3000)]
    df = spark.createDataFrame(rows, "_id bigint, s string, a array<bigint>").repartition(3)
    write(encode(df, "bson"), "bson", out("b"))
    found = [d for p in parts(out("b")) for d in documents(open(p, "rb").read())]
    assert sorted((d["_id"], d["s"], d["a"]) for d in found) == [(i, s, a) for i, s, a in rows]


def test_bson_of_schemaless_documents(variant):
    deep = '{"n":' * 120 + "[1]" + "}" * 120
    texts = ['{"i":5,"l":5000000000,"d":2.50,"one":1.0,"s":"é\\n","t":true,"n":null,"a":[1,"x",[{}]],"o":{"b":{}}}', "{}", deep]
    raw = [bytes(r.bson) for r in encode_bson(variant(*texts), "doc").collect()]
    first, second, third = (document_at(r, 0)[0] for r in raw)
    assert first == {
        "a": [("int32", 1), "x", [{}]], "d": 2.5, "i": ("int32", 5), "l": 5_000_000_000, "n": None, "o": {"b": {}}, "one": 1.0,
        "s": "é\n", "t": True,
    }
    assert second == {}
    for _ in range(120):
        third = third["n"]
    assert third == [("int32", 1)]
    for odd in ("[1]", "5", "null"):
        with pytest.raises(Exception, match="is an object"):
            encode_bson(variant(odd), "doc").collect()


def test_bson_of_odd_schemaless_documents(variant):
    level, docs = {"n": [[], {}, [{"": None}], "x"]}, []
    for n in range(30):
        level = {"a": [n, [n + 0.5, {"k": True}]], "n": level, "z": {}}
    docs += [level, {"line": "ends\n", "name\n": "\r", "é😀": "[{,:", "big": -(2**31) - 1}, {}]
    wanted = lambda x: (
        {k: wanted(v) for k, v in x.items()} if isinstance(x, dict) else [wanted(v) for v in x] if isinstance(x, list)
        else ("int32", x) if type(x) is int and -(2**31) <= x < 2**31 else x
    )
    raw = [bytes(r.bson) for r in encode_bson(variant(*map(json.dumps, docs)), "doc").collect()]
    assert [document_at(r, 0) for r in raw] == [(wanted(d), len(r)) for d, r in zip(docs, raw, strict=True)]
    with pytest.raises(Exception, match="cannot hold a zero byte"):
        encode_bson(variant('{"a":[{"b\\u0000":1}]}'), "doc").collect()


def test_bson_of_variants_among_typed_columns(spark):
    df = spark.sql(
        "SELECT 1L AS k, parse_json('[1,{\"x\":null}]') AS v, cast(null as variant) AS gone, "
        "array(parse_json('\"q\"')) AS list, named_struct('in', to_variant_object(named_struct('t', "
        "timestamp_millis(1699000000000), 'b', X'0A'))) AS s, map('m', parse_json('2.5')) AS m"
    )
    raw = bytes(encode_bson(df).first().bson)
    assert document_at(raw, 0)[0] == {
        "k": 1, "v": [("int32", 1), {"x": None}], "gone": None, "list": ["q"],
        "s": {"in": {"b": b"\x0a", "t": ("date", 1699000000000)}}, "m": {"m": 2.5},
    }


def test_export_of_schemaless_documents_as_bson(spark, variant, out):
    docs = variant('{"a":1}', '{"a":"x","b":[null]}')
    write(encode(docs, "bson", doc="doc"), "bson", out("b"))
    data, found = b"".join(open(p, "rb").read() for p in sorted(parts(out("b")))), []
    while data:
        document, end = document_at(data, 0)
        found.append(document)
        data = data[end:]
    assert sorted(map(str, found)) == sorted(map(str, [{"a": ("int32", 1)}, {"a": "x", "b": [None]}]))


def test_bson_refuses_what_it_cannot_hold(spark):
    wide = spark.createDataFrame([(Decimal("1" * 38),)], "d decimal(38,0)")
    with pytest.raises(Exception, match="34 digits"):
        encode_bson(wide).collect()


def test_digest_is_the_same_for_both_ways_of_hashing(spark, out):
    import hashlib

    df = spark.range(0, 10_000, 1, 5).select(F.concat(F.lit("line "), "id").alias("value"))
    df.write.text(out("t"))
    small = {tuple(r)[1:] for r in part_digests(spark, out("t")).collect()}
    chunked = {tuple(r)[1:] for r in part_digests(spark, out("t"), whole_part_bytes=0).collect()}
    direct = {(len(b), hashlib.sha256(b).hexdigest()) for b in (open(p, "rb").read() for p in parts(out("t")))}
    assert small == chunked == direct
    total = output_digest(spark, out("t")).first()
    assert total["parts"] == 5 and total["bytes"] == len(read_all(out("t"))) and len(total["sha256"]) == 64
