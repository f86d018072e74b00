"""One query for each operator, sink and streaming feature; every one runs over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from docquarry.checks.fixtures import (
    deep_documents,
    log_messages,
    mixed_documents,
    order_documents,
    table,
    wide_documents,
)
from docquarry.functions import (
    document_json,
    error_category,
    error_retry_delay,
    error_retryable,
    error_severity,
    exit_code,
    format_bytes,
    mask_credentials,
    render,
    row_digest,
    valid_uri,
)
from docquarry.functions.types import column
from docquarry.operators import (
    Manifest,
    count_docs,
    discover_paths,
    error_stats,
    export_stats,
    flatten,
    flatten_cells,
    get_path,
    infer_manifest,
    keyset_page,
    manifest_table,
    missing_fields,
    page,
    path_coverage,
    project,
    sort_docs,
    where,
)
from docquarry.plans import ExportSpec, export_page, run_export
from docquarry.session import scratch_path
from docquarry.sinks import encode_bson, output_digest, part_digests
from docquarry.sinks.writers import CSV_OPTIONS, encode, write
from docquarry.sources import sample, scan_snapshot
from docquarry.streaming import IncrementalExport

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        _QUERIES[name] = function
        return function

    return register


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def _rendered(df: DataFrame, *names: str) -> list:
    return [render(column(n), df.schema[n].dataType).alias(n) for n in names]


MIXED_PATHS = (
    "event_id",
    "user.id",
    "user.type",
    "value",
    "props.k",
    "tag",
    "tag.name",
    "extra",
    "extra.note",
)


def _flat_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.replace(".", "_") for c in df.columns])


# ---- scans ------------------------------------------------------------------------------------


@query("scan_collection")
def scan_collection(spark, sf):
    return table(spark, sf, "customer")


@query("sample_docs")
def sample_docs(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return sample(orders, 1000, "o_orderkey")


@query("scan_snapshot")
def scan_snapshot_counts(spark, sf):
    snapshot = scan_snapshot(spark, f"{sf}/lineitem.parquet")
    counts = snapshot.df.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"))
    path = scratch_path(spark, "snapshot_counts")
    counts.write.parquet(path)
    snapshot.verify()  # after the read, so it vouches for what was read
    return spark.read.parquet(path)


# ---- filters ----------------------------------------------------------------------------------


def _order_filter(spec):
    def run(spark, sf):
        found = where(table(spark, sf, "orders"), spec)
        return found.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority")

    return run


def _mixed_filter(spec):
    return lambda spark, sf: where(mixed_documents(spark, sf), spec, "doc").select("_id")


_QUERIES["filter_all"] = _order_filter({})
_QUERIES["filter_eq"] = _order_filter({"o_orderstatus": "F"})
_QUERIES["filter_gte"] = _order_filter({"o_totalprice": {"$gte": 400000}})
_QUERIES["filter_gt"] = _order_filter({"o_custkey": {"$gt": 700}})
_QUERIES["filter_lt"] = _order_filter({"o_totalprice": {"$lt": 20000.5}})
_QUERIES["filter_lte_eq"] = _order_filter({"o_custkey": {"$lte": 500}, "o_orderstatus": {"$eq": "O"}})
_QUERIES["filter_and"] = _order_filter(
    {"$and": [{"o_orderpriority": "1-URGENT"}, {"o_totalprice": {"$lt": 100000, "$gt": 50000}}]}
)
_QUERIES["filter_or"] = _order_filter({"$or": [{"o_orderstatus": "P"}, {"o_totalprice": {"$gte": 450000}}]})
_QUERIES["filter_in"] = _order_filter(
    {"o_orderpriority": {"$in": ["1-URGENT", "5-LOW"]}, "o_orderstatus": {"$nin": ["F"]}}
)
_QUERIES["filter_not"] = _order_filter({"o_totalprice": {"$not": {"$lt": 250000}}, "o_orderstatus": {"$ne": "O"}})
_QUERIES["filter_prefix_regex"] = _order_filter({"o_orderpriority": {"$regex": "^4-NOT"}})
_QUERIES["filter_date"] = _order_filter(
    {
        "o_orderdate": {
            "$gte": {"$date": "1996-02-01T00:00:00Z"},
            "$lt": {"$date": {"$numberLong": "946684800000"}},
        },
        "o_custkey": {"$gte": {"$numberLong": "10"}},
    }
)
_QUERIES["filter_nested"] = _mixed_filter({"props.k": {"$gte": 50}, "user.type": "click"})
_QUERIES["filter_null_field"] = _mixed_filter({"user.type": None})
_QUERIES["filter_exists"] = _mixed_filter({"user.type": {"$exists": True}, "tag.name": {"$exists": False}})
_QUERIES["filter_nested_number"] = _mixed_filter({"$or": [{"value": {"$lt": 5}}, {"tag.level": 7}]})


@query("filter_multi")
def filter_multi(spark, sf):
    found = where(table(spark, sf, "events"), {"event_type": "purchase", "value": {"$gte": 10.0}})
    return found.select("event_id", "user_id", "event_type", "value", "props")


@query("filter_regex")
def filter_regex(spark, sf):
    found = where(table(spark, sf, "documents"), {"text": {"$regex": "licen[cs]e", "$options": "i"}})
    return found.select("doc_id", "lang", "source")


# ---- projections and paths --------------------------------------------------------------------


@query("project_fields")
def project_fields(spark, sf):
    return project(table(spark, sf, "customer"), "c_name, c_acctbal,,", key="c_custkey")


@query("project_nested")
def project_nested(spark, sf):
    kept = project(order_documents(spark, sf), ["customer.key", "status"])
    return kept.select("_id", F.col("customer.key").alias("customer_key"), "status")


@query("project_variant")
def project_variant(spark, sf):
    kept = project(mixed_documents(spark, sf), "user.type,tag.name,props", doc="doc")
    return kept.select("_id", F.to_json("doc").alias("doc"))


@query("path_lookup")
def path_lookup(spark, sf):
    docs = mixed_documents(spark, sf)
    paths = {"user_id": "user.id", "tag_name": "tag.name", "deep": "tag.name.more", "gone": "no.such.path"}
    return docs.select("_id", *[get_path(docs, p, "doc").cast("string").alias(n) for n, p in paths.items()])


@query("flatten_csv")
def flatten_csv(spark, sf):
    return _flat_names(flatten(mixed_documents(spark, sf), MIXED_PATHS, "empty", "doc"))


@query("flatten_parquet")
def flatten_parquet(spark, sf):
    return _flat_names(flatten(mixed_documents(spark, sf), MIXED_PATHS, "null", "doc"))


@query("flatten_typed")
def flatten_typed(spark, sf):
    paths = ("_id", "customer.key", "customer.ref", "status", "amount", "placed", "tags", "tags.x", "raw", "closed")
    return _flat_names(flatten(order_documents(spark, sf), paths))


# ---- sort, limit, paging, counts --------------------------------------------------------------


def _ranked(ordered):
    """Sorted rows with the rank at which they stand, so that a comparison of sets sees the order."""
    path = scratch_path(ordered.sparkSession, "ranked")
    ordered.withColumn("place", F.monotonically_increasing_id()).write.parquet(path)
    stored = ordered.sparkSession.read.parquet(path).withColumn("part", F.shiftright("place", 33))
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = stored.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("before"))
    rank = F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    return stored.join(F.broadcast(sizes), "part").withColumn("rank", rank).drop("part", "place", "before")


@query("sort_multi")
def sort_multi(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return _ranked(sort_docs(orders, "o_orderstatus:1,o_totalprice:desc,o_orderkey:1"))


@query("sort_nulls")
def sort_nulls(spark, sf):
    """A sort whose leading key is missing or null in part of the documents."""
    docs = sort_docs(mixed_documents(spark, sf), "user.type:1,event_id:1", "doc")
    return _ranked(docs.select("_id", get_path(docs, "user.type", "doc").cast("string").alias("user_type")))


@query("skip_docs")
def skip_docs(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return page(orders, "o_totalprice:-1,o_orderkey:1", skip=5000)


@query("limit_docs")
def limit_docs(spark, sf):
    return page(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey:1", limit=500)


@query("limit_large")
def limit_large(spark, sf):
    """A page too large for one task: taken by stored position instead of a top-k."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    order = "l_extendedprice:-1,l_orderkey:1,l_linenumber:1,l_partkey:1,l_suppkey:1"
    return page(lines, order, skip=1000, limit=20000)


@query("page_topk")
def page_topk(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "value")
    return page(events, "value:-1,event_id:1", skip=20, limit=100)


@query("keyset_page")
def keyset_next_page(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return keyset_page(orders, 500, 1, limit=1000, exported=100, key="o_orderkey")


@query("keyset_resume_union")
def keyset_resume_union(spark, sf):
    """First page, then everything after its last key: together the whole table, once."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    first = keyset_page(orders, limit=700, key="o_orderkey")
    last_id = first.agg(F.max("o_orderkey")).first()[0]
    return first.union(keyset_page(orders, last_id, key="o_orderkey"))


@query("count_exact")
def count_exact(spark, sf):
    return count_docs(table(spark, sf, "orders"), {"o_orderstatus": "O"}, skip=100, limit=5000)


# ---- discovery and statistics -----------------------------------------------------------------


@query("discover_paths")
def discover_paths_mixed(spark, sf):
    return discover_paths(mixed_documents(spark, sf).select("doc"), "doc")


@query("discover_paths_typed")
def discover_paths_typed(spark, sf):
    return discover_paths(order_documents(spark, sf))


@query("infer_manifest")
def infer_manifest_rows(spark, sf):
    manifest = infer_manifest(mixed_documents(spark, sf), doc="doc")
    rows = [(f["path"], f["kind"], f["nullable"], manifest.sample_size) for f in manifest.fields]
    return spark.createDataFrame(rows, "path string, kind string, nullable boolean, sample_size long")


@query("discover_deep")
def discover_deep(spark, sf):
    return path_coverage(deep_documents(spark, sf), "doc")


@query("manifest_wide")
def manifest_wide(spark, sf):
    return manifest_table(wide_documents(spark, sf), scratch_path(spark, "manifest"), "doc")


@query("flatten_wide")
def flatten_wide(spark, sf):
    """Documents with tens of thousands of paths, flattened by a manifest that is a table."""
    docs = wide_documents(spark, sf)
    flat = flatten_cells(docs, manifest_table(docs, scratch_path(spark, "manifest"), "doc"), "doc")
    text = F.array_join("cells", ",", "")
    return flat.select("_id", F.size("cells").alias("cells"), F.sha2(text.cast("binary"), 256).alias("line_sha256"))


WANTED = ["user.id", "user", "user.phone", "tag.name", "extra", "extra.note", "no.such.path"]


@query("missing_fields")
def missing_fields_mixed(spark, sf):
    return missing_fields(mixed_documents(spark, sf), WANTED, "doc")


@query("path_coverage")
def path_coverage_mixed(spark, sf):
    return path_coverage(mixed_documents(spark, sf), "doc")


@query("path_coverage_typed")
def path_coverage_typed(spark, sf):
    return path_coverage(table(spark, sf, "lineitem"))


@query("export_stats")
def export_stats_jsonl(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return export_stats(orders.select(document_json(orders, "plain").alias("text")), "text")


@query("error_stats")
def error_stats_log(spark, sf):
    return error_stats(log_messages(spark, sf), "message")


# ---- value rendering --------------------------------------------------------------------------


@query("render_double")
def render_double(spark, sf):
    lines = table(spark, sf, "lineitem")
    ids = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    return lines.select(*ids, *_rendered(lines, "l_quantity", "l_extendedprice", "l_discount", "l_tax"))


@query("render_scalars")
def render_scalars(spark, sf):
    docs = order_documents(spark, sf)
    return docs.select(*_rendered(docs, "_id", "status", "amount", "shard", "closed"))


@query("render_binary")
def render_binary(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.encode("text", "utf-8").alias("bytes"))
    return docs.select("doc_id", *_rendered(docs, "bytes"))


@query("render_array")
def render_array(spark, sf):
    vectors = table(spark, sf, "embeddings")
    return vectors.select("vec_id", *_rendered(vectors, "embedding"))


@query("render_datetime")
def render_datetime(spark, sf):
    events = table(spark, sf, "events")
    return events.select("event_id", *_rendered(events, "ts"))


@query("render_nested")
def render_nested(spark, sf):
    customers = table(spark, sf, "customer").select(
        "c_custkey", F.struct("c_name", "c_nationkey", F.array("c_mktsegment").alias("tags")).alias("doc")
    )
    return customers.select("c_custkey", *_rendered(customers, "doc"))


def _read_json(texts: DataFrame, paths: dict[str, str], *kept: str) -> DataFrame:
    """Fields of a JSON text column ``text`` as strings; each text is parsed once."""
    parsed = texts.select(*kept, F.parse_json("text").alias("parsed"))
    return parsed.select(*kept, *[F.try_variant_get("parsed", p, "string").alias(n) for n, p in paths.items()])


def _json_fields(mode: str, paths: dict[str, str]) -> Query:
    def run(spark, sf):
        docs = order_documents(spark, sf)
        return _read_json(docs.select("_id", document_json(docs, mode).alias("text")), paths, "_id")

    return run


_QUERIES["json_plain"] = _json_fields(
    "plain",
    {
        "customer_key": "$.customer.key",
        "customer_ref": "$.customer.ref",
        "status": "$.status",
        "amount": "$.amount",
        "placed": "$.placed",
        "tag": "$.tags[1]",
        "raw": "$.raw",
        "closed": "$.closed",
    },
)
_QUERIES["json_relaxed"] = _json_fields(
    "relaxed",
    {
        "customer_key": "$.customer.key",
        "customer_ref": "$.customer.ref['$oid']",
        "amount": "$.amount['$numberDecimal']",
        "placed": "$.placed['$date']",
        "raw": "$.raw['$binary'].base64",
        "shard": "$.shard",
    },
)
_QUERIES["json_canonical"] = _json_fields(
    "canonical",
    {
        "key": "$._id['$numberLong']",
        "customer_key": "$.customer.key['$numberLong']",
        "customer_ref": "$.customer.ref['$oid']",
        "total": "$.total['$numberDouble']",
        "amount": "$.amount['$numberDecimal']",
        "placed": "$.placed['$date']['$numberLong']",
        "raw_subtype": "$.raw['$binary'].subType",
        "shard": "$.shard['$numberInt']",
    },
)


@query("json_canonical_mixed")
def json_canonical_mixed(spark, sf):
    docs = mixed_documents(spark, sf)
    text = docs.select("_id", document_json(docs, "canonical", "doc").alias("text"))
    paths = {
        "event_id": "$.event_id['$numberInt']",
        "user_type": "$.user.type",
        "value": "$.value['$numberDouble']",
        "tag_level": "$.tag.level['$numberInt']",
        "tag_item": "$.tag[1]['$numberInt']",
    }
    return _read_json(text, paths, "_id")


@query("json_canonical_deep")
def json_canonical_deep(spark, sf):
    docs = deep_documents(spark, sf)
    return docs.select("_id", document_json(docs, "canonical", "doc").alias("text"))


@query("json_modes_variant")
def json_modes_variant(spark, sf):
    """Instants, bytes and endless numbers inside a VARIANT, in all three modes."""
    typed = F.struct(
        F.col("o_orderdate").cast("timestamp").alias("placed"),
        F.encode("o_orderpriority", "utf-8").alias("raw"),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit(float("nan"))).otherwise(F.lit(float("inf"))).alias("share"),
        F.array(F.col("o_orderdate").cast("date")).alias("tail"),
    )
    docs = table(spark, sf, "orders").select(F.col("o_orderkey").alias("_id"), F.to_variant_object(typed).alias("doc"))
    return docs.select("_id", *[document_json(docs, m, "doc").alias(m) for m in ("plain", "relaxed", "canonical")])


@query("row_digest")
def row_digests(spark, sf):
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    return customers.select("c_custkey", row_digest(customers).alias("sha256"))


# ---- text rules -------------------------------------------------------------------------------


@query("format_bytes")
def format_bytes_sizes(spark, sf):
    lines = table(spark, sf, "lineitem")
    size = F.col("l_orderkey") * F.col("l_partkey") * F.col("l_suppkey") * (F.col("l_linenumber") + 1)
    return lines.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", format_bytes(size).alias("size_text")
    )


@query("valid_uri")
def valid_uris(spark, sf):
    logs = log_messages(spark, sf)
    urls = table(spark, sf, "pages").select(F.col("page_id").alias("id"), F.col("url").alias("text"))
    texts = logs.select(F.col("event_id").alias("id"), F.col("message").alias("text")).union(urls)
    return texts.select("id", valid_uri(F.col("text")).alias("valid"))


@query("mask_uri")
def mask_uris(spark, sf):
    logs = log_messages(spark, sf)
    return logs.select("event_id", mask_credentials(F.col("message")).alias("masked"))


@query("classify_error")
def classify_errors(spark, sf):
    message = F.col("message")
    return log_messages(spark, sf).select(
        "event_id",
        error_category(message).alias("category"),
        error_severity(message).alias("severity"),
        error_retryable(message).alias("retryable"),
        error_retry_delay(message).alias("retry_delay"),
    )


@query("exit_code")
def exit_codes(spark, sf):
    return log_messages(spark, sf).select("event_id", exit_code(F.col("message")).alias("code"))


# ---- sinks: write, read back ------------------------------------------------------------------


@query("sink_jsonl")
def sink_jsonl(spark, sf):
    docs, path = order_documents(spark, sf), scratch_path(spark, "jsonl")
    write(encode(docs, "jsonl", json_mode="canonical"), "jsonl", path)
    lines = spark.read.text(path).withColumnRenamed("value", "text")
    paths = {"_id": "$._id['$numberLong']", "status": "$.status", "shard": "$.shard['$numberInt']"}
    return _read_json(lines, paths)


@query("sink_json_array")
def sink_json_array(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    path = scratch_path(spark, "json")
    write(encode(orders, "json", json_mode="plain"), "json", path)
    reader = spark.read.schema(orders.schema).option("multiLine", "true").option("mode", "FAILFAST")
    return reader.json(path)


def _read_csv(spark, path, columns):
    schema = ", ".join(f"`{c}` string" for c in columns)
    options = {**CSV_OPTIONS, "multiLine": "true", "mode": "FAILFAST", "nullValue": "\0"}
    return spark.read.options(**options).schema(schema).csv(path)


@query("sink_csv")
def sink_csv(spark, sf):
    pages, path = table(spark, sf, "pages"), scratch_path(spark, "csv")
    manifest = Manifest.of(["page_id", "url", "html"])
    write(encode(pages, "csv", manifest), "csv", path)
    return _read_csv(spark, path, manifest.paths).select("page_id", "url", F.sha2("html", 256).alias("html_sha256"))


@query("sink_gzip")
def sink_gzip(spark, sf):
    docs, path = table(spark, sf, "documents"), scratch_path(spark, "csv-gzip")
    manifest = Manifest.of(["doc_id", "lang", "n_chars", "text"])
    write(encode(docs, "csv", manifest), "csv", path, "gzip")
    back = _read_csv(spark, path, manifest.paths)
    return back.select("doc_id", "lang", "n_chars", F.sha2("text", 256).alias("text_sha256"))


@query("sink_parquet")
def sink_parquet(spark, sf):
    docs, path = mixed_documents(spark, sf), scratch_path(spark, "parquet")
    write(encode(docs, "parquet", Manifest.of(MIXED_PATHS), doc="doc"), "parquet", path)
    return _flat_names(spark.read.parquet(path))


@query("sink_bson")
def sink_bson(spark, sf):
    """Bytes of the published binary documents; the oracle adds up their exact lengths."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    path = scratch_path(spark, "bson")
    write(encode(orders, "bson"), "bson", path)
    return part_digests(spark, path).agg(F.sum("bytes").alias("bytes"))


@query("bson_documents")
def bson_documents(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_orderkey", F.struct("o_orderpriority").alias("sub"), F.array("o_orderstatus").alias("arr")
    )
    return encode_bson(orders).select(F.hex("bson").alias("bson"))


@query("bson_mixed")
def bson_mixed(spark, sf):
    """Schemaless documents; the last field is a double, whose eight bytes and the end byte are left out here."""
    docs = mixed_documents(spark, sf)
    code = F.hex("bson")
    return encode_bson(docs, "doc").select(F.substring(code, F.lit(1), F.length(code) - 18).alias("head"))


@query("run_report")
def run_report(spark, sf):
    spec = ExportSpec(
        output=scratch_path(spark, "report"),
        format="jsonl",
        query={"o_orderstatus": "F"},
        json_mode="plain",
        count=True,
        create_dirs=True,
        key="o_orderkey",
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    report = run_export(orders, spec, "orders").to_df(spark)
    return report.select(
        "collection", "format", "json_mode", "consistency", "documents_expected", "documents_exported", "bytes_written"
    )


@query("output_digest")
def output_digest_bytes(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    path = scratch_path(spark, "digest")
    write(encode(orders, "jsonl", json_mode="plain"), "jsonl", path)
    return output_digest(spark, path).select("bytes")


# ---- resumable and streaming exports ----------------------------------------------------------


@query("resume_pages_equal_keys")
def resume_pages_equal_keys(spark, sf):
    """A paged export by a timestamp that many documents share; every document is there once."""
    day = F.date_trunc("day", F.col("ts").cast("timestamp")).alias("day")
    events = table(spark, sf, "events").select("event_id", day)
    spec = ExportSpec(
        output=scratch_path(spark, "day-pages"),
        format="jsonl",
        json_mode="plain",
        state_dir=scratch_path(spark, "day-pages-state"),
        create_dirs=True,
        key="day",
    )
    size = events.count() // 3 + 1
    progress = export_page(events, spec, size)
    while (step := export_page(events, spec, size)).documents > progress.documents:
        progress = step
    return spark.read.schema("event_id long, day string").json(f"{spec.output}/page-*")


@query("resume_pages")
def resume_pages(spark, sf):
    """Three calls of a paged export, the last one with nothing left to do."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    spec = ExportSpec(
        output=scratch_path(spark, "pages"),
        format="jsonl",
        json_mode="plain",
        state_dir=scratch_path(spark, "pages-state"),
        create_dirs=True,
        key="o_orderkey",
    )
    export_page(orders, spec, page_size=1000)
    export_page(orders, spec)
    export_page(orders, spec)
    return spark.read.schema("o_orderkey long, o_orderstatus string").json(f"{spec.output}/page-*")


@query("resume_report")
def resume_report(spark, sf):
    """The report of an export in three calls, made of what each call recorded."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    spec = ExportSpec(
        output=scratch_path(spark, "reported"),
        format="jsonl",
        json_mode="plain",
        query={"o_orderstatus": "F"},
        state_dir=scratch_path(spark, "reported-state"),
        create_dirs=True,
        key="o_orderkey",
        count=True,
        report=f"{scratch_path(spark, 'report')}/run.json",
    )
    size = orders.where("o_orderstatus = 'F'").count() // 3 + 1
    for _ in range(3):
        export_page(orders, spec, size, "orders", "shop")
    saved = spark.read.text(spec.report, wholetext=True)
    columns = "database string, collection string, json_mode string, documents_expected long, documents_exported long"
    return saved.select(F.from_json("value", f"{columns}, bytes_written long, steps long, last_id string").alias("r")).select("r.*")


def _event_stream(spark, sf, format="jsonl"):
    """Events arriving in two lots, exported after each lot and once more without new input."""
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    landing = scratch_path(spark, "landing")
    spec = ExportSpec(
        output=scratch_path(spark, "stream"),
        format=format,
        json_mode="plain",
        fields="user_id,event_type",
        state_dir=scratch_path(spark, "stream-state"),
        create_dirs=True,
        key="event_id",
    )
    export = IncrementalExport(spark, landing, events.schema, spec)
    early = F.col("ts") < F.lit("2024-01-15").cast("timestamp_ntz")
    for lot in (events.filter(early), events.filter(~early)):
        lot.write.mode("append").parquet(landing)
        export.run()
    export.run()
    return export


@query("stream_resume")
def stream_resume(spark, sf):
    export = _event_stream(spark, sf)
    schema = "event_id long, user_id long, event_type string"
    return spark.read.schema(schema).json(f"{export.spec.output}/batch-*")


@query("stream_progress")
def stream_progress(spark, sf):
    return _event_stream(spark, sf).progress().select("batch_id", "documents", "documents_total")
