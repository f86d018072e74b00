"""Batch export in key order that can be interrupted and continued.

The output is a folder of pages, ``page-000001`` and so on.  After a page is published, one small
ledger file records how many documents it holds, its last key and a fingerprint of its files.  A
later run continues after the last recorded key; a page that was published but not recorded is
written again under the same name, so no document is lost or doubled.
"""

from __future__ import annotations

import base64
import datetime as _dt
import decimal
import hashlib
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F, types as T

from docquarry.operators.filters import typed_literal, where
from docquarry.operators.paging import after, count_docs, keyset_page, sort_docs
from docquarry.operators.paths import get_path, lookup
from docquarry.operators.projection import project
from docquarry.plans.report import (
    IN_STEPS,
    PLAIN_JSON,
    ExportReport,
    new_run_id,
    rate,
    standard_warnings,
    utc_now,
)
from docquarry.plans.spec import ExportSpec
from docquarry.session import scratch_path
from docquarry.sinks.digest import output_digest
from docquarry.sinks.publish import FileOps, OutputExists, prepare, staged_output, write_small_file
from docquarry.sinks.writers import encode, write
from docquarry.sources.scan import folder_marks

_EPOCH = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)
LEDGER_SCHEMA = (
    "number long, documents long, bytes long, files long, digest long, last_id string, "
    "query_sha256 string, sort_key string, format string, shape_sha256 string, sha256 string, expected long, "
    "started_at string, finished_at string"
)


def cursor_json(value) -> str | None:
    """Key value as an Extended JSON literal, exact for every key type."""
    if value is None:
        return None
    if isinstance(value, (bytes, bytearray)):
        body = {"$binary": {"base64": base64.b64encode(bytes(value)).decode(), "subType": "00"}}
    elif isinstance(value, _dt.datetime):
        if value.tzinfo is None:
            raise ValueError("an instant without a zone is no exact cursor")
        body = {"$date": value.isoformat()}
    elif isinstance(value, _dt.date):
        body = {"$date": value.isoformat()}
    elif isinstance(value, decimal.Decimal):
        body = {"$numberDecimal": str(value)}
    elif isinstance(value, int) and not isinstance(value, bool):
        body = {"$numberLong": str(value)}
    else:
        body = value
    return json.dumps(body)


def cursor_value(text: str | None):
    return None if text is None else typed_literal(json.loads(text))


@dataclass(frozen=True)
class Progress:
    """What the recorded steps of one export add up to."""

    mode: str
    step: int
    documents: int
    bytes: int
    last_id: object


def key_holder(df: DataFrame, spec: ExportSpec) -> str | None:
    """Column the key is looked up in: none when the key is a column of its own.

    A key inside a VARIANT may be a number in one document and text in the next; a cursor would then
    step over documents, so such a key is refused.  So is local time, which is another instant in
    every session zone.
    """
    holder = None if spec.key in df.columns else spec.doc
    dtype = lookup(df, spec.key, holder).dtype
    if dtype is None or isinstance(dtype, T.VariantType):
        raise ValueError(f"the key {spec.key!r} must be a typed field; select it out of the document first")
    if isinstance(dtype, T.TimestampNTZType):
        raise ValueError(f"the key {spec.key!r} is local time; cast it to TIMESTAMP first")
    return holder


def shape_digest(spec: ExportSpec) -> str:
    """Digest of what decides the columns and the bytes of the output."""
    shape = json.dumps([spec.field_list, spec.manifest_digest(), spec.doc, spec.compression])
    return hashlib.sha256(shape.encode()).hexdigest()


def _exact(key: Column, dtype: T.DataType) -> Column:
    """A key as a value that reaches the driver unchanged in every time zone."""
    return F.unix_micros(key) if isinstance(dtype, T.TimestampType) else key


def _restored(value, dtype: T.DataType):
    if value is None or not isinstance(dtype, T.TimestampType):
        return value
    return _EPOCH + _dt.timedelta(microseconds=value)


#: Distinct keys that may come to the driver to find a cut among them; more are narrowed down by range first.
CUT_KEYS = 2_000


def key_cut(rest: DataFrame, size: int, key: Column, dtype: T.DataType) -> tuple[object, int] | None:
    """Key of the ``size``-th document in key order, and how many documents have it or a smaller one.

    Only keys are read, and they are counted in the tasks that read them, so a key that many documents share is one row.
    The distinct keys are then dealt by range, of which the driver gets one row each, and the range that holds the wanted
    document is dealt again until it has few keys.  None when there are fewer documents.
    """
    spark = rest.sparkSession
    path = scratch_path(spark, "keys")
    rest.select(key.alias("k")).where("k IS NOT NULL").groupBy("k").agg(F.count(F.lit(1)).alias("n")).write.parquet(path)
    keys, before = spark.read.parquet(path), 0
    while True:
        ranges = (
            keys.repartitionByRange("k")
            .groupBy(F.spark_partition_id().alias("part"))
            .agg(
                F.count(F.lit(1)).alias("keys"),
                F.sum("n").alias("n"),
                *(_exact(f("k"), dtype).alias(f.__name__) for f in (F.min, F.max)),
            )
            .orderBy("part")
            .collect()
        )
        for found in ranges:
            if before + found["n"] >= size:
                break
            before += found["n"]
        else:
            return None
        if found["min"] == found["max"]:
            return _restored(found["min"], dtype), before + found["n"]
        low, high = (F.lit(_restored(found[name], dtype)) for name in ("min", "max"))
        keys = keys.where(F.col("k").between(low, high))
        if found["keys"] <= CUT_KEYS or len(ranges) == 1:
            break
    # A range of its own has no more keys than fit, unless the range partitioner could not split it at all.
    until = F.sum("n").over(Window.orderBy("k")) + before
    row = keys.withColumn("until", until).where(F.col("until") >= size).orderBy("k")
    cut = row.select(_exact(F.col("k"), dtype).alias("k"), "until").first()
    return _restored(cut["k"], dtype), cut["until"]


class Ledger:
    """One small JSON file for each finished step of an export, in a folder of its own.

    A step is a page of a batch export or a micro-batch of a streaming one.  A restart after a
    changed output opens a new generation, so old records never mix with new ones.
    """

    def __init__(self, spark: SparkSession, state_dir: str, output: str, prefix: str):
        self.spark, self.output, self.prefix = spark, output, prefix
        self.state_dir = state_dir.rstrip("/")
        self.ops = FileOps(spark, state_dir)

    @property
    def generation(self) -> int:
        names = [n for n in self.ops.folders(self.state_dir) if n.startswith("generation-")]
        return max((int(n.rpartition("-")[2]) for n in names), default=0)

    @property
    def folder(self) -> str:
        return f"{self.state_dir}/generation-{self.generation:04d}"

    def next_generation(self) -> None:
        self.ops.make_dirs(f"{self.state_dir}/generation-{self.generation + 1:04d}/steps")

    def steps(self) -> DataFrame:
        """Recorded steps, one row each; no rows before the first one."""
        folder = f"{self.folder}/steps"
        if not self.ops.exists(folder):
            return self.spark.createDataFrame([], LEDGER_SCHEMA)
        return self.spark.read.schema(LEDGER_SCHEMA).option("mode", "FAILFAST").json(folder)

    def step_path(self, number: int) -> str:
        return f"{self.output.rstrip('/')}/{self.prefix}{number:06d}"

    def intact(self) -> bool:
        """True when every recorded step's files are there, unchanged in name and size."""
        recorded = self.steps().filter(F.col("files") > 0).select("number", "files", "bytes", "digest")
        found = folder_marks(self.spark, self.output, self.prefix)
        return recorded.join(found, ["number", "files", "bytes", "digest"], "left_anti").isEmpty()

    def decide(self, spec: ExportSpec) -> Progress:
        """Create, append or recreate, with the progress that still counts."""
        totals = self.steps().agg(
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.max("number"), F.lit(-1)).alias("step"),
            F.coalesce(F.sum("documents"), F.lit(0)).alias("documents"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
            F.max_by("last_id", F.when(F.col("last_id").isNotNull(), F.col("number"))).alias("last_id"),
            F.count_if(
                (F.col("query_sha256") != spec.query_digest())
                | (F.col("sort_key") != spec.key)
                | (F.col("format") != spec.format)
                | (F.col("shape_sha256") != shape_digest(spec))
            ).alias("foreign"),
        ).first()
        if totals["foreign"] and spec.overwrite and self.ops.exists(self.output):
            return Progress("recreate", 0, 0, 0, None)
        if totals["foreign"]:
            raise ValueError("the state folder belongs to an export with another query, key, format, field list or manifest")
        if not self.ops.exists(self.output):
            return Progress("create", 0, 0, 0, None)
        if not totals["n"]:
            # Nothing is recorded: a folder that is already there is not ours unless a run was cut short.
            if self.generation == 0 and not spec.overwrite:
                raise OutputExists(f"{self.output} is there already and was not made by this state folder")
            return Progress("recreate", 0, 0, 0, None)
        if not self.intact():
            return Progress("recreate", 0, 0, 0, None)
        last_id = cursor_value(totals["last_id"])
        if last_id is None and totals["documents"] > 0:
            raise ValueError("documents are recorded, but there is no cursor position to go on from")
        return Progress("append", totals["step"] + 1, totals["documents"], totals["bytes"], last_id)

    def open(self, spec: ExportSpec) -> Progress:
        """Decide, and clear the way for a create or recreate."""
        progress = self.decide(spec)
        if progress.mode == "append":
            return progress
        if progress.mode == "create":
            prepare(self.ops, self.output, False, spec.create_dirs)
        else:
            self.ops.remove(self.output)
        self.next_generation()
        self.ops.make_dirs(self.output)
        return progress

    def write_step(self, number: int, documents: DataFrame, spec: ExportSpec, expected: int | None = None) -> dict:
        """Publish the documents of one step and record it; doing it twice leaves one copy.

        ``expected`` is how many documents the whole run was found to have when the step began.
        """
        started = utc_now()
        target = self.step_path(number)
        seen = Observation()
        holder = key_holder(documents, spec)
        dtype = lookup(documents, spec.key, holder).dtype
        last = _exact(F.max(get_path(documents, spec.key, holder)), dtype)
        counted = documents.observe(seen, F.count(F.lit(1)).alias("documents"), last.alias("last_id"))
        if spec.field_list is not None:
            counted = project(counted, spec.field_list, spec.key, spec.doc)
        with staged_output(self.spark, target, overwrite=True) as staged:
            write(encode(counted, spec.format, spec.manifest, "plain", spec.doc), spec.format, staged)
        measured = seen.get
        marks = folder_marks(self.spark, target, self.prefix).first()
        record = {
            "number": number,
            "documents": measured["documents"],
            "files": marks["files"] if marks else 0,
            "bytes": marks["bytes"] if marks else 0,
            "digest": marks["digest"] if marks else 0,
            "last_id": cursor_json(_restored(measured["last_id"], dtype)),
            "query_sha256": spec.query_digest(),
            "sort_key": spec.key,
            "format": spec.format,
            "shape_sha256": shape_digest(spec),
            "sha256": output_digest(self.spark, target).first()["sha256"],
            "expected": expected,
            "started_at": started.isoformat(),
            "finished_at": utc_now().isoformat(),
        }
        path = f"{self.folder}/steps/{number:06d}.json"
        write_small_file(self.spark, path, json.dumps(record) + "\n", overwrite=True)
        return record


    def report(self, spec: ExportSpec, collection: str = "", database: str = "") -> ExportReport:
        """The run so far: a fold over the recorded steps, without reading any output again.

        Its digest is taken over the digests of the steps in their order.
        """
        steps = self.steps()
        numbered = F.array_sort(F.collect_list(F.struct("number", "sha256")))
        spent = F.sum(F.unix_millis(F.col("finished_at").cast("timestamp")) - F.unix_millis(F.col("started_at").cast("timestamp")))
        row = steps.agg(
            F.count(F.lit(1)).alias("steps"),
            F.coalesce(F.sum("documents"), F.lit(0)).alias("documents"),
            F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
            F.sha2(F.array_join(F.transform(numbered, lambda x: x["sha256"]), ""), 256).alias("sha256"),
            F.max_by("expected", "number").alias("expected"),
            F.max_by("last_id", F.when(F.col("last_id").isNotNull(), F.col("number"))).alias("last_id"),
            F.min("started_at").alias("started_at"),
            F.max("finished_at").alias("finished_at"),
            F.coalesce(spent, F.lit(0)).alias("spent"),
        ).first()
        now = utc_now().isoformat()
        warnings = [IN_STEPS] + ([PLAIN_JSON] if spec.format == "jsonl" else [])
        return ExportReport(
            run_id=new_run_id(),
            started_at=row["started_at"] or now,
            finished_at=row["finished_at"] or now,
            collection=collection,
            format=spec.format,
            json_mode=spec.reported_json_mode,
            consistency=spec.consistency,
            query_sha256=spec.query_digest(),
            schema_sha256=spec.manifest_digest(),
            output=spec.output,
            output_sha256=row["sha256"],
            bytes_written=row["bytes"],
            documents_expected=row["expected"],
            documents_exported=row["documents"],
            duration_ms=row["spent"],
            last_id=row["last_id"],
            warnings=warnings + standard_warnings(row["expected"], row["documents"], spec.consistency),
            database=database,
            documents_processed=row["documents"],
            docs_per_second=rate(row["documents"], row["spent"]),
            steps=row["steps"],
        )

    def write_report(self, spec: ExportSpec, fresh: bool, collection: str = "", database: str = "") -> None:
        """Publish the report of the run so far; that of an earlier step of the same run is replaced."""
        if spec.report is not None:
            body = self.report(spec, collection, database).to_json() + "\n"
            write_small_file(self.spark, spec.report, body, spec.overwrite or not fresh, spec.create_dirs)


def export_page(
    df: DataFrame, spec: ExportSpec, page_size: int | None = None, collection: str = "", database: str = ""
) -> Progress:
    """Export the next page and return the progress after it.

    ``page_size`` is the wanted size of one call; a page goes on to the last document of its last key, so
    documents with equal keys stay together and none is stepped over.  The spec's ``limit`` bounds the
    export over all calls exactly.  Without a page size the call exports everything that is left.
    Documents without a key are in the first page.  With ``count`` each call counts what the query matches, up to
    the limit; ``report`` describes all calls so far.
    """
    spec.validate()
    if spec.state_dir is None:
        raise ValueError("a resumable export needs a state folder")
    holder = key_holder(df, spec)
    ledger = Ledger(df.sparkSession, spec.state_dir, spec.output, "page-")
    if spec.report is not None and ledger.ops.qualified(spec.report) == ledger.ops.qualified(spec.output):
        raise ValueError("the report would replace the output; give it a path of its own")
    if spec.report is not None and ledger.generation == 0:
        prepare(FileOps(df.sparkSession, spec.report), spec.report, spec.overwrite, spec.create_dirs)
    before = ledger.open(spec)
    remaining = None if spec.limit is None else max(0, spec.limit - before.documents)
    found = where(df, spec.query, spec.doc)
    rest = found if before.last_id is None else after(found, before.last_id, 1, spec.key, holder)
    if remaining == 0 or (before.last_id is not None and rest.isEmpty()):
        ledger.write_report(spec, False, collection, database)
        return before
    key = get_path(rest, spec.key, holder)
    whole = None
    if page_size is not None and (remaining is None or page_size < remaining):
        whole = key_cut(rest, page_size, key, lookup(rest, spec.key, holder).dtype)
    if whole is not None and (remaining is None or whole[1] <= remaining):
        wanted = key <= F.lit(whole[0])
        page = sort_docs(rest.where(wanted | key.isNull() if before.last_id is None else wanted), {spec.key: 1}, holder)
    else:
        page = keyset_page(found, before.last_id, 1, remaining, 0, spec.key, holder)
    expected = count_docs(df, spec.query, None, spec.limit, spec.doc).first()["n"] if spec.count else None
    record = ledger.write_step(before.step, page, spec, expected)
    ledger.write_report(spec, before.mode != "append", collection, database)
    last_id = cursor_value(record["last_id"])
    return Progress(
        before.mode,
        before.step + 1,
        before.documents + record["documents"],
        before.bytes + record["bytes"],
        before.last_id if last_id is None else last_id,
    )
