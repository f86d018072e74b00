import json
import os

import pytest
from pyspark.sql import functions as F

from docquarry.operators import Manifest
from docquarry.plans import ExportSpec, run_export
from docquarry.plans.report import BEST_EFFORT, NO_COUNT
from docquarry.sources import SourceChanged, scan, scan_snapshot, spread

M = Manifest.of(["id"])


@pytest.mark.parametrize(
    "change, message",
    [
        ({"format": "xml"}, "unknown format"),
        ({"json_mode": "x"}, "JSON mode"),
        ({"compression": "zip"}, "compression"),
        ({"consistency": "x"}, "consistency"),
        ({"format": "csv"}, "manifest is required"),
        ({"format": "parquet"}, "manifest is required"),
        ({"format": "csv", "manifest": M, "fields": "id"}, "manifest alone"),
        ({"fields": " , "}, "names nothing"),
        ({"limit": 0}, "limit"),
        ({"limit": 2**63}, "limit"),
        ({"skip": -1}, "skip"),
        ({"sort": "a:up"}, "no sort direction"),
        ({"consistency": "snapshot", "count": True}, "not available with snapshot"),
        ({"state_dir": "s", "json_mode": "plain", "compression": "gzip"}, "with a state folder writes"),
        ({"state_dir": "s", "json_mode": "plain", "skip": 1}, "with a state folder writes"),
        ({"state_dir": "s", "format": "parquet", "manifest": M}, "with a state folder writes"),
        ({"state_dir": "s", "json_mode": "plain", "sort": "a:1"}, "is sorted by"),
        ({"state_dir": "s", "json_mode": "plain", "sort": "_id:-1"}, "is sorted by"),
        ({"state_dir": "s"}, "in plain mode"),
    ],
)
def test_incompatible_options(change, message):
    with pytest.raises(ValueError, match=message):
        ExportSpec(**{"output": "o", "format": "jsonl", **change}).validate()


def test_export_and_report(spark, out):
    df = spark.range(100).withColumn("v", F.col("id") * 2)
    spec = ExportSpec(
        output=out("data"), format="jsonl", query={"id": {"$gte": 10}}, fields="v", sort="id:-1", skip=5, limit=20,
        json_mode="plain", count=True, report=out("report.json"), key="id",
    )
    report = run_export(df, spec, "numbers")
    rows = [json.loads(r[0]) for r in spark.read.text(out("data")).collect()]
    assert sorted(r["id"] for r in rows) == list(range(75, 95)) and set(rows[0]) == {"id", "v"}
    saved = json.loads(open(out("report.json")).read())
    assert saved == json.loads(report.to_json())
    assert saved["documents_exported"] == saved["documents_expected"] == 20
    assert saved["bytes_written"] == sum(len(json.dumps(r, separators=(",", ":"))) + 1 for r in rows)
    assert saved["warnings"] == [BEST_EFFORT] and saved["collection"] == "numbers"
    assert saved["output_sha256"] and saved["query_sha256"] == spec.query_digest()


def test_existing_output_is_refused_and_replaced_only_when_asked(spark, out):
    first = ExportSpec(output=out("d"), format="jsonl", json_mode="plain")
    assert run_export(spark.range(3), first).warnings == [NO_COUNT, BEST_EFFORT]
    with pytest.raises(FileExistsError):
        run_export(spark.range(5), first)
    assert spark.read.text(out("d")).count() == 3
    run_export(spark.range(5), ExportSpec(output=out("d"), format="jsonl", json_mode="plain", overwrite=True))
    assert spark.read.text(out("d")).count() == 5


def test_failed_run_leaves_the_old_output(spark, out):
    run_export(spark.range(3), ExportSpec(output=out("d"), format="jsonl"))
    broken = spark.range(3).select(F.raise_error(F.lit("boom")).cast("long").alias("x"))
    with pytest.raises(Exception, match="boom"):
        run_export(broken, ExportSpec(output=out("d"), format="jsonl", overwrite=True))
    assert spark.read.text(out("d")).count() == 3
    assert [n for n in os.listdir(out("")) if "tmp" in n or "old" in n] == []


def test_missing_folder_needs_create_dirs(spark, out):
    with pytest.raises(FileNotFoundError):
        run_export(spark.range(1), ExportSpec(output=out("a/b/c"), format="jsonl"))
    run_export(spark.range(1), ExportSpec(output=out("a/b/c"), format="jsonl", create_dirs=True))


def test_report_must_not_be_the_output(spark, out):
    spec = ExportSpec(output=out("d"), format="jsonl", report=out("missing/../d"))
    with pytest.raises(ValueError, match="path of its own"):
        run_export(spark.range(1), spec)


@pytest.mark.parametrize("format", ["jsonl", "json", "csv", "parquet", "bson"])
def test_empty_collections_export(spark, out, format):
    spec = ExportSpec(output=out("d"), format=format, manifest=M if format in ("csv", "parquet") else None)
    assert run_export(spark.range(0), spec).documents_exported == 0


def test_snapshot(spark, out):
    spark.range(10).write.parquet(out("src"))
    spec = ExportSpec(output=out("d"), format="jsonl", consistency="snapshot")
    snapshot = scan_snapshot(spark, out("src"))
    assert run_export(snapshot, spec).documents_exported == 10
    spark.range(5).write.mode("append").parquet(out("src"))
    assert snapshot.df.count() == 10
    with pytest.raises(SourceChanged):
        run_export(snapshot, ExportSpec(output=out("e"), format="jsonl", consistency="snapshot"))
    assert not os.path.exists(out("e"))
    with pytest.raises(ValueError, match="go together"):
        run_export(spark.range(1), ExportSpec(output=out("f"), format="jsonl", consistency="snapshot"))


def test_unreadable_documents_abort(spark, out):
    spark.createDataFrame([('{"a":1}',), ('{"a":',)], "value string").write.text(out("j"))
    with pytest.raises(Exception):
        scan(spark, out("j"), "jsonl").collect()
    with pytest.raises(Exception):
        scan(spark, out("j"), "json", schema="a int").collect()


def test_repeated_keys_abort(spark, out):
    spark.createDataFrame([('{"a":1,"a":2}',)], "value string").write.text(out("j"))
    with pytest.raises(Exception):
        scan(spark, out("j"), "jsonl").collect()


def test_small_inputs_are_spread_and_large_ones_left_alone(spark, sf_dir):
    lines = scan(spark, f"{sf_dir}/lineitem.parquet")
    sizes = spread(lines).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == spark.sparkContext.defaultParallelism
    assert spread(lines, max_bytes=1000) is lines
