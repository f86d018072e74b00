"""DuckDB SQL that states the expected result of each registered query from the base tables."""

from __future__ import annotations

_ORDER_COLUMNS = "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority"


def _orders(condition: str) -> str:
    return f"SELECT {_ORDER_COLUMNS} FROM orders WHERE {condition}"


def _digits(value: str) -> str:
    """Positional double text, for values between 1e-4 and 1e15."""
    return rf"regexp_replace(CAST({value} AS VARCHAR), '\.0$', '')"


def _small_digits(value: str) -> str:
    """Positional double text where DuckDB writes a negative exponent (below 1e-4)."""
    text = f"CAST({value} AS VARCHAR)"
    mantissa = rf"regexp_replace(split_part({text}, 'e', 1), '[-.]', '', 'g')"
    zeros = f"repeat('0', CAST(split_part({text}, 'e-', 2) AS INTEGER) - 1)"
    sign = f"CASE WHEN {text} LIKE '-%' THEN '-' ELSE '' END"
    return f"CASE WHEN {text} LIKE '%e-%' THEN {sign} || '0.' || {zeros} || {mantissa} ELSE {_digits(value)} END"


_USER_TYPE = "CASE WHEN event_id % 7 = 0 OR event_id % 5 = 0 THEN NULL ELSE event_type END"
_HAS_USER_TYPE = "event_id % 7 <> 0"
_TAG_IS_DOC = "event_id % 3 = 0"
_TAG_IS_LIST = "event_id % 3 <> 0 AND event_id % 2 = 0"
_PROPS_K = "regexp_extract(props, '\"k\": (\\d+)', 1)"
_TAG = f"""CASE WHEN {_TAG_IS_DOC} THEN '{{"level":' || (event_id % 10) || ',"name":"' || event_type || '"}}'
    WHEN {_TAG_IS_LIST} THEN '[' || event_type || ',' || (event_id % 10) || ',]' ELSE event_type END"""
_TAG_NAME = f"CASE WHEN {_TAG_IS_DOC} THEN event_type END"
_EXTRA = """CASE WHEN event_id % 11 = 0 THEN '{}' ELSE '{"note":""}' END"""
_EXTRA_NOTE = "CASE WHEN event_id % 11 <> 0 THEN '' END"
_FLAT = {
    "event_id": "CAST(event_id AS VARCHAR)",
    "user_id": "CAST(user_id AS VARCHAR)",
    "user_type": _USER_TYPE,
    "value": _digits("value"),
    "props_k": _PROPS_K,
    "tag": _TAG,
    "tag_name": _TAG_NAME,
    "extra": _EXTRA,
    "extra_note": _EXTRA_NOTE,
}
_FLATTEN_NULL = "SELECT " + ", ".join(f"{e} AS {n}" for n, e in _FLAT.items()) + " FROM events"
_FLATTEN_EMPTY = "SELECT " + ", ".join(f"COALESCE({e}, '') AS {n}" for n, e in _FLAT.items()) + " FROM events"

# Which documents hold which leaf path.
_HOLDS = {
    "event_id": "TRUE",
    "user.id": "TRUE",
    "user.type": _HAS_USER_TYPE,
    "value": "TRUE",
    "props.k": "TRUE",
    "tag": f"NOT ({_TAG_IS_DOC})",
    "tag.name": _TAG_IS_DOC,
    "tag.level": _TAG_IS_DOC,
    "extra.note": "event_id % 11 <> 0",
}
_LEAVES = " UNION ALL ".join(f"SELECT '{p}' AS path FROM events WHERE {c}" for p, c in _HOLDS.items())

_ISO_MS = "strftime({0}, '%Y-%m-%dT%H:%M:%S.') || lpad(CAST((epoch_us({0}) % 1000000) // 1000 AS VARCHAR), 3, '0') || 'Z'"
_PLACED = _ISO_MS.format("o_orderdate")
_REF = "lpad(lower(to_hex(o_custkey)), 24, '0')"
_AMOUNT = _digits("o_totalprice")
_DOUBLE = f"CASE WHEN {_AMOUNT} LIKE '%.%' THEN {_AMOUNT} ELSE {_AMOUNT} || '.0' END"
_RAW_HEX = "lower(hex(encode(o_orderpriority)))"

_MESSAGE = f"""CASE event_id % 8
    WHEN 0 THEN 'Connection timeout after ' || user_id || ' ms'
    WHEN 1 THEN 'Unauthorized user ' || user_id
    WHEN 2 THEN 'Access denied for ' || event_type || ' query'
    WHEN 3 THEN 'No space left on disk for output'
    WHEN 4 THEN 'Cannot parse value ' || CAST(value AS VARCHAR)
    WHEN 5 THEN 'Process killed: OOM, limit must be raised'
    WHEN 6 THEN 'mongodb://user' || user_id || ':pw' || user_id || '@host' || user_id || ':27017/db refused'
    ELSE 'Unexpected ' || event_type || ' event' END"""


def _by_kind(*results: str) -> str:
    """CASE over the eight kinds of log message."""
    return "CASE event_id % 8 " + " ".join(f"WHEN {i} THEN {r}" for i, r in enumerate(results)) + " END"


_CATEGORY = _by_kind(
    "'Network'", "'Authentication'", "'Database'", "'File System'", "'Serialization'", "'Resource'", "'Unknown'",
    "'Unknown'",
)
_SEVERITY = _by_kind(
    "'Error'", "'Critical'", "'Critical'", "'Error'", "'Warning'", "'Error'", "'Error'", "'Error'"
)
_RETRYABLE = _by_kind("true", "false", "false", "true", "true", "true", "true", "true")
_DELAY = _by_kind("5", "NULL", "NULL", "10", "1", "30", "5", "5")
_EXIT = _by_kind("4", "1", "5", "6", "1", "2", "1", "1")

_DEEP = "CASE event_id % 3 WHEN 0 THEN 3 WHEN 1 THEN 12 ELSE 40 END"
_EVENT_DOUBLE = f"CASE WHEN {_digits('value')} LIKE '%.%' THEN {_digits('value')} ELSE {_digits('value')} || '.0' END"
_WIDE = """SELECT l_suppkey, 'g' || l_linenumber || '.p' || (l_orderkey % 5000) AS path,
    sum(CAST(trunc(l_quantity) AS BIGINT)) AS quantity FROM lineitem GROUP BY ALL"""
_WIDE_PATHS = f"SELECT path, row_number() OVER (ORDER BY path) - 1 AS position FROM (SELECT DISTINCT path FROM ({_WIDE}))"

_PLAIN_ORDER = """'{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus
    || '","o_orderpriority":"' || o_orderpriority || '"}'"""


def _le(value: str, width: int) -> str:
    """Little-endian hex of a whole number."""
    digits = f"lpad(to_hex({value}), {2 * width}, '0')"
    return " || ".join(f"substr({digits}, {2 * width - 1 - 2 * i}, 2)" for i in range(width))


def _hex(text: str) -> str:
    return "".join(f"{b:02X}" for b in text.encode())


def _bson_string(name: str, value: str) -> str:
    return f"'02{_hex(name)}00' || {_le(f'strlen({value}) + 1', 4)} || hex(encode({value})) || '00'"


def _bson_document(body: str) -> str:
    return f"({_le(f'length({body}) // 2 + 5', 4)} || {body} || '00')"


_BSON_SUB = _bson_document("(" + _bson_string("o_orderpriority", "o_orderpriority") + ")")
_BSON_ARR = _bson_document("(" + _bson_string("0", "o_orderstatus") + ")")
_BSON = _bson_document(
    f"('12{_hex('o_orderkey')}00' || {_le('o_orderkey', 8)} || '03{_hex('sub')}00' || {_BSON_SUB}"
    f" || '04{_hex('arr')}00' || {_BSON_ARR})"
)


def _bson_int(name: str, value: str) -> str:
    return f"'10{_hex(name)}00' || {_le(value, 4)}"


def _bson_inside(name: str, body: str, code: str = "03") -> str:
    return f"'{code}{_hex(name)}00' || {_bson_document('(' + body + ')')}"


_MIXED_TAG = f"""CASE WHEN {_TAG_IS_DOC}
    THEN {_bson_inside('tag', _bson_int('level', 'event_id % 10') + ' || ' + _bson_string('name', 'event_type'))}
    WHEN {_TAG_IS_LIST} THEN {_bson_inside(
        'tag', _bson_string('0', 'event_type') + ' || ' + _bson_int('1', 'event_id % 10') + f" || '0A{_hex('2')}00'", '04')}
    ELSE {_bson_string('tag', 'event_type')} END"""
_MIXED_USER = f"""{_bson_int('id', 'user_id')} || CASE WHEN event_id % 7 = 0 THEN '' WHEN event_id % 5 = 0
    THEN '0A{_hex('type')}00' ELSE {_bson_string('type', 'event_type')} END"""
_MIXED_EXTRA = f"CASE WHEN event_id % 11 = 0 THEN '' ELSE {_bson_string('note', chr(39) * 2)} END"
_MIXED_BODY = " || ".join(
    (
        _bson_int("event_id", "event_id"),
        _bson_inside("extra", _MIXED_EXTRA),
        _bson_inside("props", _bson_int("k", f"CAST({_PROPS_K} AS INTEGER)")),
        f"({_MIXED_TAG})",
        _bson_inside("user", _MIXED_USER),
        f"'01{_hex('value')}00'",
    )
)


def _cell(value: str) -> str:
    return f"strlen(CAST({value} AS VARCHAR)) || ':' || {value}"


_SIZE = "(l_orderkey * l_partkey * l_suppkey * (l_linenumber + 1))"
_SIZE_STEPS = " ".join(
    f"WHEN {_SIZE} < {1024 ** (p + 1)} THEN printf('%.2f {u}', CAST({_SIZE} AS DOUBLE) / {1024**p})"
    for p, u in enumerate(("KB", "MB", "GB"), start=1)
)
_SIZE_TEXT = (
    f"CASE WHEN {_SIZE} < 1024 THEN {_SIZE} || ' B' {_SIZE_STEPS} "
    f"ELSE printf('%.2f TB', CAST({_SIZE} AS DOUBLE) / {1024**4}) END"
)

SQL: dict[str, str] = {
    "scan_collection": "SELECT * FROM customer",
    "sample_docs": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1000",
    "scan_snapshot": "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL",
    "filter_all": _orders("TRUE"),
    "filter_eq": _orders("o_orderstatus = 'F'"),
    "filter_gte": _orders("o_totalprice >= 400000"),
    "filter_gt": _orders("o_custkey > 700"),
    "filter_lt": _orders("o_totalprice < 20000.5"),
    "filter_lte_eq": _orders("o_custkey <= 500 AND o_orderstatus = 'O'"),
    "filter_and": _orders("o_orderpriority = '1-URGENT' AND o_totalprice < 100000 AND o_totalprice > 50000"),
    "filter_or": _orders("o_orderstatus = 'P' OR o_totalprice >= 450000"),
    "filter_in": _orders("o_orderpriority IN ('1-URGENT', '5-LOW') AND o_orderstatus NOT IN ('F')"),
    "filter_not": _orders("NOT (o_totalprice < 250000) AND o_orderstatus <> 'O'"),
    "filter_prefix_regex": _orders("regexp_matches(o_orderpriority, '^4-NOT')"),
    "filter_date": _orders(
        "o_orderdate >= TIMESTAMP '1996-02-01 00:00:00' AND o_orderdate < TIMESTAMP '2000-01-01 00:00:00' "
        "AND o_custkey >= 10"
    ),
    "filter_nested": f"SELECT event_id AS _id FROM events WHERE CAST({_PROPS_K} AS INTEGER) >= 50 "
    f"AND ({_USER_TYPE}) = 'click'",
    "filter_null_field": f"SELECT event_id AS _id FROM events WHERE ({_USER_TYPE}) IS NULL",
    "filter_exists": f"SELECT event_id AS _id FROM events WHERE {_HAS_USER_TYPE} AND NOT ({_TAG_IS_DOC})",
    "filter_nested_number": "SELECT event_id AS _id FROM events "
    f"WHERE value < 5 OR ({_TAG_IS_DOC} AND event_id % 10 = 7)",
    "filter_multi": "SELECT event_id, user_id, event_type, value, props FROM events "
    "WHERE event_type = 'purchase' AND value >= 10.0",
    "filter_regex": "SELECT doc_id, lang, source FROM documents WHERE regexp_matches(text, 'licen[cs]e', 'i')",
    "project_fields": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "project_nested": "SELECT o_orderkey AS _id, o_custkey AS customer_key, o_orderstatus AS status FROM orders",
    "project_variant": f"""SELECT event_id AS _id,
        '{{"props":{{"k":' || {_PROPS_K} || '}}'
        || CASE WHEN {_TAG_IS_DOC} THEN ',"tag":{{"name":"' || event_type || '"}}'
            WHEN event_id % 2 = 0 THEN ',"tag":[]' ELSE '' END
        || ',"user":' || CASE WHEN event_id % 7 = 0 THEN '{{}}' WHEN event_id % 5 = 0 THEN '{{"type":null}}'
            ELSE '{{"type":"' || event_type || '"}}' END || '}}' AS doc FROM events""",
    "path_lookup": f"SELECT event_id AS _id, CAST(user_id AS VARCHAR) AS user_id, {_TAG_NAME} AS tag_name, "
    "CAST(NULL AS VARCHAR) AS deep, CAST(NULL AS VARCHAR) AS gone FROM events",
    "flatten_csv": _FLATTEN_EMPTY,
    "flatten_parquet": _FLATTEN_NULL,
    "flatten_typed": f"""SELECT CAST(o_orderkey AS VARCHAR) AS _id, CAST(o_custkey AS VARCHAR) AS customer_key,
        {_REF} AS customer_ref, o_orderstatus AS status, {_AMOUNT} AS amount, {_PLACED} AS placed,
        '[' || o_orderstatus || ',' || o_orderpriority || ']' AS tags, CAST(NULL AS VARCHAR) AS tags_x,
        {_RAW_HEX} AS raw, CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS closed FROM orders""",
    "sort_multi": "SELECT o_orderkey, o_orderstatus, o_totalprice, "
    "row_number() OVER (ORDER BY o_orderstatus, o_totalprice DESC, o_orderkey) AS rank FROM orders",
    "sort_nulls": f"SELECT event_id AS _id, {_USER_TYPE} AS user_type, "
    f"row_number() OVER (ORDER BY {_USER_TYPE} ASC NULLS FIRST, event_id) AS rank FROM events",
    "resume_pages_equal_keys": "SELECT event_id, strftime(date_trunc('day', ts), '%Y-%m-%dT00:00:00.000Z') AS day FROM events",
    "json_modes_variant": """WITH d AS (
            SELECT o_orderkey AS _id, strftime(CAST(o_orderdate AS DATE), '%Y-%m-%dT00:00:00.000Z') AS iso,
                CAST(epoch_ms(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP)) AS VARCHAR) AS ms,
                lower(hex(encode(o_orderpriority))) AS hexed, to_base64(encode(o_orderpriority)) AS coded,
                CASE WHEN o_orderkey % 2 = 0 THEN 'NaN' ELSE 'Infinity' END AS endless FROM orders)
        SELECT _id, '{"placed":"' || iso || '","raw":"' || hexed || '","share":null,"tail":["' || iso || '"]}' AS plain,
            '{"placed":{"$date":"' || iso || '"},"raw":{"$binary":{"base64":"' || coded || '","subType":"00"}},"share":'
                || '{"$numberDouble":"' || endless || '"},"tail":[{"$date":"' || iso || '"}]}' AS relaxed,
            '{"placed":{"$date":{"$numberLong":"' || ms || '"}},"raw":{"$binary":{"base64":"' || coded
                || '","subType":"00"}},"share":{"$numberDouble":"' || endless || '"},"tail":[{"$date":{"$numberLong":"'
                || ms || '"}}]}' AS canonical FROM d""",
    "skip_docs": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey OFFSET 5000",
    "limit_docs": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 500",
    "limit_large": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM lineitem ORDER BY "
    "l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 20000 OFFSET 1000",
    "page_topk": "SELECT event_id, user_id, value FROM events ORDER BY value DESC, event_id LIMIT 100 OFFSET 20",
    "keyset_page": "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 500 ORDER BY o_orderkey LIMIT 900",
    "keyset_resume_union": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "count_exact": "SELECT LEAST(GREATEST(count(*) - 100, 0), 5000) AS n FROM orders WHERE o_orderstatus = 'O'",
    "discover_paths": f"SELECT DISTINCT path FROM ({_LEAVES})",
    "discover_paths_typed": "SELECT DISTINCT unnest(['_id', 'customer.key', 'customer.ref', 'status', 'total', 'amount', "
    "'placed', 'tags', 'raw', 'shard', 'closed']) AS path FROM orders",
    "infer_manifest": "SELECT DISTINCT path, 'string' AS kind, TRUE AS nullable, "
    f"(SELECT count(*) FROM events) AS sample_size FROM ({_LEAVES})",
    "discover_deep": f"SELECT path, count(*) AS documents FROM (SELECT repeat('n.', {_DEEP}) || unnest(['id', 'list']) AS path "
    "FROM events) GROUP BY path",
    "manifest_wide": f"SELECT position, path, 'string' AS kind, TRUE AS nullable FROM ({_WIDE_PATHS})",
    "flatten_wide": f"""WITH held AS ({_WIDE}), paths AS ({_WIDE_PATHS}), docs AS (SELECT DISTINCT l_suppkey FROM lineitem)
        SELECT l_suppkey AS _id, CAST(count(*) AS INTEGER) AS cells,
            sha256(string_agg(COALESCE(CAST(quantity AS VARCHAR), ''), ',' ORDER BY position)) AS line_sha256
        FROM docs CROSS JOIN paths LEFT JOIN held USING (l_suppkey, path) GROUP BY l_suppkey""",
    "json_canonical_deep": f"""SELECT event_id AS _id, repeat('{{"n":', {_DEEP}) || '{{"id":{{"$numberInt":"' || event_id
        || '"}},"list":[{{"$numberDouble":"' || {_EVENT_DOUBLE} || '"}},["' || event_type || '",null,{{"$numberInt":"'
        || user_id || '"}}]]}}' || repeat('}}', {_DEEP}) AS text FROM events""",
    "missing_fields": "SELECT position, path FROM (VALUES (0, 'user.id'), (1, 'user'), (2, 'user.phone'), "
    "(3, 'tag.name'), (4, 'extra'), (5, 'extra.note'), (6, 'no.such.path')) AS w(position, path) "
    f"WHERE path NOT IN (SELECT path FROM ({_LEAVES}))",
    "path_coverage": f"SELECT path, count(*) AS documents FROM ({_LEAVES}) GROUP BY path",
    "path_coverage_typed": "SELECT path, count(value) AS documents FROM (UNPIVOT (SELECT "
    "COLUMNS(*)::VARCHAR FROM lineitem) ON COLUMNS(*) INTO NAME path VALUE value) GROUP BY path",
    "export_stats": f"SELECT count(*) AS documents_exported, CAST(sum(strlen({_PLAIN_ORDER})) AS BIGINT) AS "
    f"bytes_written, CAST(sum(strlen({_PLAIN_ORDER})) AS DOUBLE) / count(*) AS avg_document_size FROM orders",
    "error_stats": f"SELECT 'category' AS dimension, {_CATEGORY} AS value, count(*) AS errors FROM events GROUP BY 2 "
    f"UNION ALL SELECT 'severity' AS dimension, {_SEVERITY} AS value, count(*) AS errors FROM events GROUP BY 2",
    "render_double": "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, "
    + ", ".join(f"{_digits(c)} AS {c}" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax"))
    + " FROM lineitem",
    "render_scalars": f"SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_orderstatus AS status, {_AMOUNT} AS amount, "
    "CAST(o_custkey % 100 AS VARCHAR) AS shard, CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS closed "
    "FROM orders",
    "render_binary": "SELECT doc_id, lower(hex(encode(text))) AS bytes FROM documents",
    "render_array": "SELECT vec_id, '[' || array_to_string(list_transform(embedding, lambda x: "
    + _small_digits("CAST(x AS DOUBLE)")
    + "), ',') || ']' AS embedding FROM embeddings",
    "render_datetime": f"SELECT event_id, {_ISO_MS.format('ts')} AS ts FROM events",
    "render_nested": """SELECT c_custkey, '{"c_name":"' || c_name || '","c_nationkey":' || c_nationkey
        || ',"tags":["' || c_mktsegment || '"]}' AS doc FROM customer""",
    "json_plain": f"""SELECT o_orderkey AS _id, CAST(o_custkey AS VARCHAR) AS customer_key, {_REF} AS customer_ref,
        o_orderstatus AS status, {_AMOUNT} AS amount, {_PLACED} AS placed, o_orderpriority AS tag, {_RAW_HEX} AS raw,
        CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS closed FROM orders""",
    "json_relaxed": f"""SELECT o_orderkey AS _id, CAST(o_custkey AS VARCHAR) AS customer_key, {_REF} AS customer_ref,
        {_AMOUNT} AS amount, {_PLACED} AS placed, base64(encode(o_orderpriority)) AS raw,
        CAST(o_custkey % 100 AS VARCHAR) AS shard FROM orders""",
    "json_canonical": f"""SELECT o_orderkey AS _id, CAST(o_orderkey AS VARCHAR) AS key,
        CAST(o_custkey AS VARCHAR) AS customer_key, {_REF} AS customer_ref, {_DOUBLE} AS total, {_AMOUNT} AS amount,
        CAST(epoch_ms(o_orderdate) AS VARCHAR) AS placed, '00' AS raw_subtype,
        CAST(o_custkey % 100 AS VARCHAR) AS shard FROM orders""",
    "json_canonical_mixed": f"""SELECT event_id AS _id, CAST(event_id AS VARCHAR) AS event_id, {_USER_TYPE} AS user_type,
        CASE WHEN {_digits('value')} LIKE '%.%' THEN {_digits('value')} ELSE {_digits('value')} || '.0' END AS value,
        CASE WHEN {_TAG_IS_DOC} THEN CAST(event_id % 10 AS VARCHAR) END AS tag_level,
        CASE WHEN {_TAG_IS_LIST} THEN CAST(event_id % 10 AS VARCHAR) END AS tag_item FROM events""",
    "row_digest": "SELECT c_custkey, sha256("
    + " || ".join(_cell(c) for c in ("c_custkey", "c_name", "c_nationkey", "c_mktsegment"))
    + ") AS sha256 FROM customer",
    "format_bytes": f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, {_SIZE_TEXT} AS size_text FROM lineitem",
    "valid_uri": f"SELECT id, starts_with(text, 'mongodb://') OR starts_with(text, 'mongodb+srv://') AS valid FROM "
    f"(SELECT event_id AS id, {_MESSAGE} AS text FROM events UNION ALL SELECT page_id AS id, url AS text FROM pages)",
    "mask_uri": "SELECT event_id, CASE WHEN event_id % 8 = 6 THEN 'mongodb://***@host' || user_id || ':27017/db refused' "
    f"ELSE {_MESSAGE} END AS masked FROM events",
    "classify_error": f"SELECT event_id, {_CATEGORY} AS category, {_SEVERITY} AS severity, {_RETRYABLE} AS retryable, "
    f"{_DELAY} AS retry_delay FROM events",
    "exit_code": f"SELECT event_id, {_EXIT} AS code FROM events",
    "sink_jsonl": "SELECT CAST(o_orderkey AS VARCHAR) AS _id, o_orderstatus AS status, "
    "CAST(o_custkey % 100 AS VARCHAR) AS shard FROM orders",
    "sink_json_array": "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders",
    "sink_csv": "SELECT CAST(page_id AS VARCHAR) AS page_id, url, sha256(html) AS html_sha256 FROM pages",
    "sink_gzip": "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, CAST(n_chars AS VARCHAR) AS n_chars, "
    "sha256(text) AS text_sha256 FROM documents",
    "sink_parquet": _FLATTEN_NULL,
    # Frame 5 bytes, int64 20, double 22, each text its name, its length and 7 bytes more.
    "sink_bson": "SELECT CAST(sum(5 + 19 + 1 + 21 + 1 + (13 + strlen(o_orderstatus) + 7) + "
    "(15 + strlen(o_orderpriority) + 7)) AS BIGINT) AS bytes FROM orders",
    "bson_documents": f"SELECT {_BSON} AS bson FROM orders",
    # Length, then all fields up to the double: its 8 bytes and the end byte are not compared.
    "bson_mixed": f"SELECT {_le('length(body) // 2 + 13', 4)} || body AS head FROM (SELECT {_MIXED_BODY} AS body FROM events)",
    "run_report": "SELECT 'orders' AS collection, 'jsonl' AS format, 'plain' AS json_mode, 'best-effort' AS consistency, "
    "count(*) AS documents_expected, count(*) AS documents_exported, "
    f"CAST(sum(strlen({_PLAIN_ORDER}) + 1) AS BIGINT) AS bytes_written FROM orders WHERE o_orderstatus = 'F'",
    "output_digest": f"SELECT CAST(sum(strlen({_PLAIN_ORDER}) + 1) AS BIGINT) AS bytes FROM orders",
    "resume_report": "SELECT 'shop' AS database, 'orders' AS collection, 'plain' AS json_mode, count(*) AS documents_expected, "
    f"count(*) AS documents_exported, CAST(sum(strlen({_PLAIN_ORDER}) + 1) AS BIGINT) AS bytes_written, "
    """CAST(3 AS BIGINT) AS steps, '{"$numberLong": "' || max(o_orderkey) || '"}' AS last_id """
    "FROM orders WHERE o_orderstatus = 'F'",
    "resume_pages": "SELECT o_orderkey, o_orderstatus FROM orders",
    "stream_resume": "SELECT event_id, user_id, event_type FROM events",
    "stream_progress": "SELECT batch_id, documents, CAST(sum(documents) OVER (ORDER BY batch_id) AS BIGINT) AS "
    "documents_total FROM (SELECT CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 0 ELSE 1 END AS batch_id, "
    "count(*) AS documents FROM events GROUP BY 1)",
}
