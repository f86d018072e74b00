"""The registered llm queries against SQL, and the pipeline against a plain version."""

import corpus_pipeline
import duckdb
import pytest
from llm_samples import components, shingle_set

from docquarry.llm.queries import QUERIES, SQL

public_tokenizers = pytest.importorskip("public_tokenizers")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    result = QUERIES[name](spark, sf_dir)
    names = sorted(result.columns)
    cursor = duck.execute(SQL[name])
    at = [[d[0] for d in cursor.description].index(n) for n in names]
    expected = sorted(tuple(str(row[i]) for i in at) for row in cursor.fetchall())
    assert sorted(tuple(str(row[n]) for n in names) for row in result.collect()) == expected and expected


def test_one_query_for_each_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))


def test_pipeline_stages(spark, sf_dir, out):
    """Each stage on what the one before it kept, against a plain version of its rule."""
    from sentencepiece import SentencePieceProcessor

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(out(name))
        docs = spark.read.parquet(out(name))
        kept.append({r[0]: r for r in docs.collect()})
        if name != "pieces":
            assert docs.columns == columns
    quality, exact, near, clean, coded = kept
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    good = [i for i, q in labels.items() if q == 1]
    assert sum(i in quality for i in good) >= 0.99 * len(good)

    last = {}
    for i, r in quality.items():
        low = (r.text or "").encode().lower()
        last[low] = max(i, last.get(low, i))
    assert set(exact) == set(last.values())

    label = components({i: shingle_set(r.text, 5) for i, r in exact.items()}, 80)
    assert set(near) == {i for i in exact if label[i] == i}

    items = [shingle_set(r.text, 5) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    sets = {i: shingle_set(r.text, 5) for i, r in near.items()}
    dirty = {i for i, s in sets.items() if any(100 * len(s & x) >= 80 * len(x) for x in items if x)}
    assert set(clean) == set(near) - dirty and dirty

    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert set(coded) == set(clean)
    assert all(coded[i].ids == library.encode(clean[i].text or "") for i in clean)


def test_pipeline_on_odd_and_empty_documents(spark, sf_dir, out):
    from llm_samples import ODD

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(None if k == 0 else 900_000 + k, t, None, "src", None) for k, t in enumerate(ODD)]
    for name, frame in (("odd", spark.createDataFrame(rows, docs.schema)), ("none", docs.limit(0))):
        for stage, run in corpus_pipeline.STAGES:
            run(spark, frame, sf_dir).write.parquet(out(f"{name}-{stage}"))
            frame = spark.read.parquet(out(f"{name}-{stage}"))
        assert (frame.count() > 0) == (name == "odd")
