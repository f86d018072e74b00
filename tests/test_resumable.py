import datetime as dt
import json
import shutil
import time
from decimal import Decimal
from glob import glob

import pytest
from pyspark.sql import functions as F, types as T

from docquarry.operators import Manifest
from docquarry.plans import ExportSpec, export_page
from docquarry.plans import resumable
from docquarry.plans.report import COUNT_DIFFERS
from docquarry.plans.resumable import cursor_json, cursor_value
from docquarry.streaming import IncrementalExport


def spec_of(out, **change):
    base = dict(output=out("data"), format="jsonl", json_mode="plain", state_dir=out("state"), create_dirs=True, key="id")
    return ExportSpec(**{**base, **change})


def ids(spark, spec, prefix="page-"):
    rows = spark.read.text(f"{spec.output}/{prefix}*").collect()
    return sorted(json.loads(r[0])["id"] for r in rows)


@pytest.mark.parametrize(
    "value", [5, "m", 2.5, Decimal("1.50"), b"\x01", dt.datetime(2024, 1, 2, 3, 4, 5, 678901, dt.timezone.utc), None]
)
def test_cursor_round_trip(value):
    assert cursor_value(cursor_json(value)) == value


def test_local_time_is_no_cursor(spark, out):
    with pytest.raises(ValueError, match="without a zone"):
        cursor_json(dt.datetime(2024, 1, 2))
    local = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01 00:00:00' AS id")
    with pytest.raises(ValueError, match="local time"):
        export_page(local, spec_of(out))


def test_pages_add_up(spark, out):
    df, spec = spark.range(0, 50, 1, 4), spec_of(out)
    modes = [export_page(df, spec, 20) for _ in range(4)]
    assert [p.mode for p in modes] == ["create", "append", "append", "append"]
    assert [p.documents for p in modes] == [20, 40, 50, 50]
    assert modes[-1].last_id == 49 and ids(spark, spec) == list(range(50))


def test_equal_keys_stay_in_one_page(spark, out):
    df, spec = spark.createDataFrame([(k,) for k in (1, 1, 1, 2, 2, None)], "id long"), spec_of(out)
    counts = [export_page(df, spec, 2).documents for _ in range(4)]
    assert counts == [4, 6, 6, 6]
    rows = spark.read.schema("id long").json(f"{spec.output}/page-*").collect()
    assert sorted(str(r.id) for r in rows) == ["1", "1", "1", "2", "2", "None"]
    bounded = spec_of(out, output=out("bounded"), state_dir=out("bounded-state"), limit=3)
    assert [export_page(df.where("id > 0"), bounded, 2).documents for _ in range(3)] == [3, 3, 3]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_timestamp_pages_in_every_zone(spark, out, monkeypatch, zone):
    monkeypatch.setenv("TZ", zone)
    time.tzset()
    try:
        df = spark.sql("SELECT timestamp_micros(1700000000000000 + id * 3600000001) AS id FROM range(6)")
        spec = spec_of(out)
        assert [export_page(df, spec, 2).documents for _ in range(5)] == [2, 4, 6, 6, 6]
        assert len(set(ids(spark, spec))) == len(ids(spark, spec)) == 6
    finally:
        monkeypatch.delenv("TZ")
        time.tzset()


def test_another_shape_is_refused(spark, out):
    df = spark.range(9).selectExpr("id", "id AS other")
    export_page(df, spec_of(out, fields="id,other"), 2)
    with pytest.raises(ValueError, match="field list"):
        export_page(df, spec_of(out, fields="id"), 2)


def test_report_and_count_of_a_run_in_steps(spark, out):
    df = spark.range(0, 50, 1, 3)
    spec = spec_of(out, count=True, report=out("reports/run.json"), query={"id": {"$gte": 5}}, limit=40)
    seen = []
    for _ in range(3):
        progress = export_page(df, spec, 15, "numbers", "db")
        seen.append(json.loads(open(spec.report).read()))
    assert [r["documents_exported"] for r in seen] == [15, 30, 40] and [r["steps"] for r in seen] == [1, 2, 3]
    assert all(r["documents_expected"] == 40 for r in seen) and seen[-1]["last_id"] == '{"$numberLong": "44"}'
    assert (seen[-1]["bytes_written"], seen[-1]["database"]) == (progress.bytes, "db")
    assert COUNT_DIFFERS in seen[0]["warnings"] and COUNT_DIFFERS not in seen[-1]["warnings"]
    assert len({r["output_sha256"] for r in seen}) == 3
    export_page(df, spec, 15, "numbers", "db")  # nothing is left; the report is the same run's
    assert json.loads(open(spec.report).read())["output_sha256"] == seen[-1]["output_sha256"]
    with pytest.raises(ValueError, match="path of its own"):
        export_page(df, spec_of(out, report=out("data") + "/../data"), 15)


def test_a_report_of_something_else_is_not_replaced(spark, out):
    (path := out("run.json")) and open(path, "w").write("mine")
    with pytest.raises(FileExistsError):
        export_page(spark.range(5), spec_of(out, report=path))


def test_overwrite_starts_a_recorded_export_anew(spark, out):
    export_page(spark.range(5), spec_of(out), 2)
    changed = spec_of(out, query={"id": {"$gte": 3}}, overwrite=True)
    assert export_page(spark.range(5), changed).mode == "recreate"
    assert ids(spark, changed) == [3, 4]


@pytest.mark.parametrize("few", [2, 2_000])
def test_cut_key_with_a_hot_key(spark, monkeypatch, few):
    monkeypatch.setattr(resumable, "CUT_KEYS", few)
    keys = sorted([7] * 3000 + list(range(0, 3000, 3)) + [None] * 5, key=lambda k: (k is None, k))
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(4)
    whole = [k for k in keys if k is not None]
    for size in (1, 2, 3, 4, 1000, 3002, 3003, 3004, 3500, 4000):
        cut = resumable.key_cut(df, size, F.col("k"), T.LongType())
        assert cut == (whole[size - 1], sum(k <= whole[size - 1] for k in whole)), size
    assert resumable.key_cut(df, 4001, F.col("k"), T.LongType()) is None


def test_limit_counts_over_all_calls(spark, out):
    df, spec = spark.range(100), spec_of(out, limit=30)
    assert [export_page(df, spec, 20).documents for _ in range(3)] == [20, 30, 30]
    assert ids(spark, spec) == list(range(30))


def test_changed_output_starts_over(spark, out):
    df, spec = spark.range(50), spec_of(out)
    export_page(df, spec, 20)
    part = glob(f"{spec.output}/page-000000/part-*")[0]
    with open(part, "a") as stream:
        stream.write('{"id":999}\n')
    again = export_page(df, spec, 10)
    assert (again.mode, again.documents) == ("recreate", 10)
    assert ids(spark, spec) == list(range(10))


def test_missing_output_is_created_anew(spark, out):
    df, spec = spark.range(50), spec_of(out)
    export_page(df, spec, 20)
    shutil.move(spec.output, out("elsewhere"))
    again = export_page(df, spec)
    assert (again.mode, again.documents) == ("create", 50)
    assert ids(spark, spec) == list(range(50))


def test_published_but_unrecorded_page_is_written_again(spark, out, monkeypatch):
    df, spec = spark.range(50), spec_of(out)
    export_page(df, spec, 20)
    with monkeypatch.context() as patch:
        patch.setattr(resumable, "write_small_file", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            export_page(df, spec, 20)
    assert export_page(df, spec).documents == 50
    assert ids(spark, spec) == list(range(50))


def test_foreign_output_and_foreign_state_are_refused(spark, out):
    spark.range(1).write.json(out("data"))
    with pytest.raises(FileExistsError):
        export_page(spark.range(5), spec_of(out))
    spec = spec_of(out, output=out("mine"))
    export_page(spark.range(5), spec, 2)
    with pytest.raises(ValueError, match="another query"):
        export_page(spark.range(5), spec_of(out, output=out("mine"), query={"id": 1}))


@pytest.fixture
def stream(spark, out):
    def make(**change):
        landing = out("landing")
        spark.range(0).write.mode("append").parquet(landing)
        return landing, IncrementalExport(
            spark, landing, spark.range(0).schema, spec_of(out, **change), max_files_per_batch=2
        )

    return make


def test_stream_adds_only_new_files(spark, stream):
    landing, export = stream()
    spark.range(0, 10, 1, 3).write.mode("append").parquet(landing)
    assert export.run().documents == 10
    steps = export.ledger.steps().count()
    again = export.run()
    assert (again.mode, again.documents) == ("append", 10) and export.ledger.steps().count() == steps
    spark.range(10, 15).write.mode("append").parquet(landing)
    assert export.run().documents == 15
    assert ids(spark, export.spec, "batch-") == list(range(15))
    totals = [r.documents_total for r in export.progress().orderBy("batch_id").collect()]
    assert totals[-1] == 15 and totals == sorted(totals)


def test_stream_replays_a_failed_batch(spark, stream, monkeypatch):
    landing, export = stream()
    spark.range(0, 10).write.mode("append").parquet(landing)
    export.run()
    spark.range(10, 30).write.mode("append").parquet(landing)
    with monkeypatch.context() as patch:
        patch.setattr(resumable, "write_small_file", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception, match="lost"):
            export.run()
    assert export.run().documents == 30
    assert ids(spark, export.spec, "batch-") == list(range(30))


def test_stream_starts_over_when_its_output_changed(spark, stream):
    landing, export = stream(query={"id": {"$gte": 5}})
    spark.range(0, 10).write.mode("append").parquet(landing)
    assert export.run().documents == 5
    part = [p for p in glob(f"{export.spec.output}/batch-*/part-*") if open(p).read()][0]
    open(part, "a").write("junk")
    again = export.run()
    assert (again.mode, again.documents) == ("recreate", 5)
    assert ids(spark, export.spec, "batch-") == list(range(5, 10))


def test_stream_has_no_limit(spark, out):
    with pytest.raises(ValueError, match="no limit"):
        IncrementalExport(spark, out("x"), spark.range(0).schema, spec_of(out, limit=5))


def test_stream_of_json_lines(spark, out):
    landing = out("lines")
    lines = spark.createDataFrame([('{"id":2,"a":{"b":"x"}}',), ('{"id":1}',)], "value string")
    lines.write.text(landing)
    spec = spec_of(out, doc="doc", format="csv", json_mode="canonical", manifest=Manifest.of(["id", "a.b"]))
    export = IncrementalExport(spark, landing, spark.range(0).schema, spec, "jsonl")
    done = export.run()
    assert (done.documents, done.last_id) == (2, 2)
    back = spark.read.csv(f"{spec.output}/batch-*", header=True).collect()
    assert sorted((r[0], r[1]) for r in back) == [("1", None), ("2", "x")]
    spark.createDataFrame([('{"id":"three"}',)], "value string").write.mode("append").text(landing)
    with pytest.raises(Exception):
        export.run()


def test_pages_of_documents_need_a_typed_key(spark, out, variant):
    docs = variant('{"id":1,"v":"a"}', '{"id":2,"v":"b"}', '{"id":3}')
    spec = spec_of(out, doc="doc", query={"v": {"$exists": True}})
    with pytest.raises(ValueError, match="typed field"):
        export_page(docs, spec)
    keyed = docs.withColumn("id", F.variant_get("doc", "$.id", "bigint"))
    assert [export_page(keyed, spec, 1).documents for _ in range(3)] == [1, 2, 2]
    assert ids(spark, spec) == [1, 2]
