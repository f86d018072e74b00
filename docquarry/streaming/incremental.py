"""Incremental export of an append-only folder with Structured Streaming.

The file source remembers in its checkpoint which files it has read; each micro-batch becomes one
folder of the output, sorted by the key.  A batch is written under a name made from its batch id, so
a batch that is replayed after a failure replaces its own half-written folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from docquarry.operators.filters import where
from docquarry.operators.paging import sort_docs
from docquarry.operators.paths import variant_path
from docquarry.plans.report import ExportReport
from docquarry.plans.resumable import Ledger, Progress, key_holder
from docquarry.plans.spec import ExportSpec
from docquarry.sources.scan import as_documents

BATCH_PREFIX = "batch-"


@dataclass(frozen=True)
class IncrementalExport:
    """An export that adds only what arrived since its last run.

    The source folder must be append-only.  With ``source_format="jsonl"`` each line is parsed into the
    VARIANT column the spec's ``doc`` names, and ``schema`` gives the type of the key alone.  Use the keyset export when a limit, a global order or a
    source that rewrites files is involved.
    """

    spark: SparkSession
    source: str
    schema: T.StructType
    spec: ExportSpec
    source_format: str = "parquet"
    max_files_per_batch: int | None = None

    def __post_init__(self):
        self.spec.validate()
        if self.spec.state_dir is None:
            raise ValueError("an incremental export needs a state folder")
        if self.source_format == "jsonl" and self.spec.doc is None:
            raise ValueError("JSON lines are read into a document column; name it in the spec")
        if self.spec.limit is not None:
            raise ValueError("an incremental export has no limit; use the keyset export")

    @property
    def ledger(self) -> Ledger:
        return Ledger(self.spark, self.spec.state_dir, self.spec.output, BATCH_PREFIX)

    def documents(self) -> DataFrame:
        """The streaming DataFrame of the selected documents."""
        text_lines = self.source_format == "jsonl"
        reader = self.spark.readStream.format("text" if text_lines else self.source_format)
        if self.max_files_per_batch is not None:
            reader = reader.option("maxFilesPerTrigger", self.max_files_per_batch)
        if text_lines:
            arrived = self._with_key(as_documents(reader.load(self.source), "value", self.spec.doc))
        else:
            arrived = reader.schema(self.schema).load(self.source)
        return where(arrived, self.spec.query, self.spec.doc)

    def _with_key(self, documents: DataFrame) -> DataFrame:
        """Documents with their key as a typed column; a key of another type fails the batch."""
        key_type = self.schema[self.spec.key].dataType
        value = F.variant_get(self.spec.doc, variant_path(self.spec.key.split(".")), key_type.simpleString())
        return documents.withColumn(self.spec.key, value)

    def run(self) -> Progress:
        """Export everything that has arrived and return the totals over all runs."""
        ledger = self.ledger
        mode = ledger.open(self.spec).mode

        def write_batch(batch: DataFrame, batch_id: int) -> None:
            ordered = sort_docs(batch, {self.spec.key: 1}, key_holder(batch, self.spec))
            expected = None
            if self.spec.count:
                earlier = ledger.steps().where(F.col("number") < batch_id).agg(F.sum("documents").alias("n")).first()["n"]
                expected = (earlier or 0) + batch.count()
            ledger.write_step(batch_id, ordered, self.spec, expected)

        query = (
            self.documents()
            .writeStream.foreachBatch(write_batch)
            .option("checkpointLocation", f"{ledger.folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        done = ledger.decide(self.spec)
        ledger.write_report(self.spec, mode != "append")
        return Progress(mode, done.step, done.documents, done.bytes, done.last_id)

    def report(self, collection: str = "", database: str = "") -> ExportReport:
        """What all runs so far have exported."""
        return self.ledger.report(self.spec, collection, database)

    def progress(self) -> DataFrame:
        """One row for each finished batch with the running totals.

        The window runs over the ledger, which has one row a batch, never over documents.
        """
        so_far = Window.orderBy("number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        steps = self.ledger.steps()
        return steps.select(
            F.col("number").alias("batch_id"),
            "documents",
            "bytes",
            F.sum("documents").over(so_far).alias("documents_total"),
            F.sum("bytes").over(so_far).alias("bytes_total"),
        )
