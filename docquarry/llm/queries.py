"""One query for each operator and for the pipeline, over whole tables, with the SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from docquarry.llm.decontaminate import contained_items
from docquarry.llm.exact_dedup import exact_groups
from docquarry.llm.hard_negatives import hard_negatives
from docquarry.llm.lexical_search import ranked_search
from docquarry.llm.near_dedup import near_groups
from docquarry.llm.ngram_lm import ngram_scores, train_ngrams
from docquarry.llm.piece_codec import default_model, piece_report
from docquarry.llm.pii import BASE as PII_KINDS, find_pii
from docquarry.llm.quality import quality_scores, train_quality
from docquarry.llm.quality_rules import quality_rules
from docquarry.llm.rows import small_batches
from docquarry.llm.secret_scan import BASE as SECRET_KINDS, find_secrets, train_field
from docquarry.llm.spans import span_digest
from docquarry.llm.substring_dedup import repeated_passages
from docquarry.llm.token_files import read_token_files, write_token_files
from docquarry.session import scratch_path


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(documents(spark, sf_dir), shingle=4)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages under the id of each text that has them, the first carrier included."""
    return repeated_passages(documents(spark, sf_dir), mirrored=True)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_path(spark, "token_files")
    write_token_files(documents(spark, sf_dir), path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, path, with_ids=False)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digest(find_pii(documents(spark, sf_dir)), "doc_id", PII_KINDS)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_report(documents(spark, sf_dir), default_model())


def remainder(divisor: int) -> Column:
    """Fixed folds: crc32 of the id as text."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def op7_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train_ngrams(docs.where(remainder(7) != 2))
    return ngram_scores(docs, model).withColumn("held_out", remainder(7) == 2)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    weights = train_quality(docs, labels, remainder(3) != 1)
    return quality_scores(docs, weights).select("doc_id", (remainder(3) == 1).alias("held_out"), "score", "predicted")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return span_digest(find_secrets(docs, train_field(docs)), "doc_id", SECRET_KINDS)


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.withColumn("label", moved), anchor=F.col("vec_id") % 100 == 0)


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_token_files": op3_token_files,
    "op4_pii": op4_pii,
    "op5_decontaminate": op5_decontaminate,
    "op6_pieces": op6_pieces,
    "op7_ngram_lm": op7_ngram_lm,
    "op8_quality": op8_quality,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_secrets": op10_secrets,
    "op11_lexical_search": op11_lexical_search,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_quality_rules": op13_quality_rules,
}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+')"

_TERMS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"


def _grams(words: str, size: str) -> str:
    """Distinct runs of words as a list; all words, where there are fewer."""
    starts = f"range(1, greatest(len({words}) - {size} + 1, 1) + 1)"
    grams = f"list_distinct([array_to_string({words}[i : i + {size} - 1], ' ') for i in {starts}])"
    return f"CASE WHEN len({words}) = 0 THEN [] ELSE {grams} END"


SQL: dict[str, str] = {
    "op1_near_dedup": f"""
        WITH RECURSIVE
        sets AS (SELECT doc_id, {_grams('words', '4')} AS grams FROM (SELECT doc_id, {_WORDS} AS words FROM documents)),
        cells AS (SELECT doc_id, len(grams) AS n, unnest(grams) AS gram FROM sets),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b FROM cells a JOIN cells b ON a.gram = b.gram AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
        reached AS (
            SELECT doc_id, doc_id AS other FROM sets
            UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON reached.other = links.a)
        SELECT doc_id, any_value(len(grams)) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
        FROM sets JOIN reached USING (doc_id) GROUP BY doc_id""",
    "op5_decontaminate": f"""
        WITH items AS (
            SELECT item_id, least(5, len(words)) AS width, {_grams('words', '5')} AS grams
            FROM (SELECT item_id, {_WORDS} AS words FROM benchmark)),
        wanted AS (SELECT item_id, width, len(grams) AS n, unnest(grams) AS gram FROM items),
        texts AS (SELECT doc_id, {_WORDS} AS words FROM documents),
        cells AS (
            SELECT doc_id, width, unnest({_grams('words', 'width')}) AS gram
            FROM texts, (SELECT DISTINCT width FROM items) WHERE len(words) >= width)
        SELECT doc_id, item_id, count(*) AS shared, n AS item_shingles, count(*) / n AS containment
        FROM cells JOIN wanted USING (width, gram) GROUP BY doc_id, item_id, n HAVING 100 * count(*) >= 80 * n""",
    "op9_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(lowered) AS text_sha256
        FROM (SELECT doc_id, {_LOWERED} AS lowered FROM documents)
        WINDOW same AS (PARTITION BY lowered)""",
    "op11_lexical_search": rf"""
        WITH held AS (
            SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({_TERMS}) AS term FROM documents)
            GROUP BY doc_id, term),
        sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM held GROUP BY doc_id),
        totals AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM sizes),
        weights AS (
            SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
            FROM (SELECT term, count(*) AS df FROM held GROUP BY term), totals),
        asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
        scores AS (
            SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length))))::BIGINT AS score
            FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN sizes USING (doc_id), totals
            GROUP BY item_id, doc_id)
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
        FROM scores WHERE score > 0 QUALIFY rank <= 50""",
    "op12_hard_negatives": """
        WITH rows AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
                   list_inner_product(a.vector, b.vector)::BIGINT AS score
            FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
        positives AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT anchor_id, positive_id,
               (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
               vec_id AS negative_id, positive_score, score AS negative_score
        FROM positives JOIN scored USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10""",
}
