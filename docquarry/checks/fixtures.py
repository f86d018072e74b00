"""Collections derived from the test tables: mixed documents, typed documents and log messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from docquarry.sources import as_documents, scan, spread


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return scan(spark, f"{sf_dir}/{name}.parquet")


# Each event as one JSON document whose shape differs from row to row: ``user.type`` is missing, null
# or text; ``tag`` is a sub-document, an array or text; ``extra`` is at times an empty sub-document.
_MIXED = """concat(
    '{"event_id":', event_id,
    ',"user":{"id":', user_id,
    CASE WHEN event_id % 7 = 0 THEN ''
         WHEN event_id % 5 = 0 THEN ',"type":null'
         ELSE concat(',"type":"', event_type, '"') END,
    '},"value":', value,
    ',"props":', props,
    ',"tag":',
    CASE WHEN event_id % 3 = 0 THEN concat('{"name":"', event_type, '","level":', event_id % 10, '}')
         WHEN event_id % 2 = 0 THEN concat('["', event_type, '",', event_id % 10, ',null]')
         ELSE concat('"', event_type, '"') END,
    ',"extra":', CASE WHEN event_id % 11 = 0 THEN '{}' ELSE '{"note":""}' END,
    '}')"""


def mixed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(_id, doc VARIANT)``: one schemaless document for each event."""
    events = spread(table(spark, sf_dir, "events"))
    return as_documents(events.select(F.col("event_id").alias("_id"), F.expr(_MIXED).alias("text")), "text")


# Chains of sub-documents 3, 12 or 40 levels deep, with a document at the end.
_DEPTH = "CASE event_id % 3 WHEN 0 THEN 3 WHEN 1 THEN 12 ELSE 40 END"
_DEEP = f"""concat(
    repeat('{{"n":', {_DEPTH}), '{{"id":', event_id, ',"list":[', value, ',["', event_type, '",null,', user_id, ']]}}',
    repeat('}}', {_DEPTH}))"""


def deep_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(_id, doc VARIANT)``: documents that nest up to 40 levels."""
    events = spread(table(spark, sf_dir, "events"))
    return as_documents(events.select(F.col("event_id").alias("_id"), F.expr(_DEEP).alias("text")), "text")


def wide_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(_id, doc VARIANT)``: one document a supplier, with up to 35,000 different paths in all of them."""
    lines = table(spark, sf_dir, "lineitem")
    cells = lines.groupBy("l_suppkey", "l_linenumber", F.pmod("l_orderkey", F.lit(5000)).alias("part")).agg(
        F.sum(F.col("l_quantity").cast("long")).alias("quantity")
    )
    inner = F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("p"), "part"), "quantity")))
    groups = cells.groupBy("l_suppkey", "l_linenumber").agg(inner.alias("parts"))
    whole = F.map_from_entries(F.collect_list(F.struct(F.concat(F.lit("g"), "l_linenumber"), "parts")))
    docs = groups.groupBy("l_suppkey").agg(whole.alias("doc"))
    return docs.select(F.col("l_suppkey").alias("_id"), F.to_variant_object("doc").alias("doc"))


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed nested documents: one for each order, with every common value type."""
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").alias("_id"),
        F.struct(
            F.col("o_custkey").alias("key"),
            F.struct(F.lpad(F.lower(F.hex("o_custkey")), 24, "0").alias("$oid")).alias("ref"),
        ).alias("customer"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        F.col("o_orderdate").alias("placed"),
        F.array("o_orderstatus", "o_orderpriority").alias("tags"),
        F.encode("o_orderpriority", "utf-8").alias("raw"),
        (F.col("o_custkey") % 100).cast("int").alias("shard"),
        (F.col("o_orderstatus") == "F").alias("closed"),
    )


# One log message for each event; the wording walks through every rule of the classifiers.
_MESSAGE = """CASE event_id % 8
    WHEN 0 THEN concat('Connection timeout after ', user_id, ' ms')
    WHEN 1 THEN concat('Unauthorized user ', user_id)
    WHEN 2 THEN concat('Access denied for ', event_type, ' query')
    WHEN 3 THEN 'No space left on disk for output'
    WHEN 4 THEN concat('Cannot parse value ', value)
    WHEN 5 THEN 'Process killed: OOM, limit must be raised'
    WHEN 6 THEN concat('mongodb://user', user_id, ':pw', user_id, '@host', user_id, ':27017/db refused')
    ELSE concat('Unexpected ', event_type, ' event')
END"""


def log_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(event_id, message)``: one log line for each event."""
    return table(spark, sf_dir, "events").select("event_id", F.expr(_MESSAGE).alias("message"))
