"""Token files and the piece codec: equality with the libraries, exact round trips."""

import random
import zlib

import numpy as np
import pytest
from llm_samples import ODD, SCHEMA, frame, prose

from docquarry.llm import blocks
from docquarry.llm.piece_codec import decode_pieces, default_model, encode_pieces, piece_report
from docquarry.llm.pieces import Encoder, load_model
from docquarry.llm.token_files import read_token_files, write_token_files

public_tokenizers = pytest.importorskip("public_tokenizers")

HARD = ["don't <|endoftext|> a<|startoftext|>b", "İstanbul ΣΑΣ é", " no break\x1c", "def f(x):\n\treturn x==1", "   lead"]


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 5000])
@pytest.mark.parametrize("top", [1, 2, 50_000, 2**32])
def test_blocks_round_trip(n, top):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
    ids[rng.random(n) < 0.05] = 2**32 - 1
    data, starts = blocks.encode(ids)
    assert (blocks.decode(data, starts)[:n] == ids).all()


def test_blocks_have_exceptions():
    ids = np.full(512, 5, np.uint32)
    ids[17] = 4_000_000_000
    data, starts = blocks.encode(ids)
    assert len(data) == 2 * blocks.HEAD + 5 and (blocks.decode(data, starts) == ids).all()


def test_token_files(spark, out):
    from tokenizers import Tokenizer

    name = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(name)
    texts = ODD + HARD + prose(60, 51)
    order = random.Random(0).sample(range(1000), len(texts))
    write_token_files(frame(spark, texts, order), out("tokens"), name, end_id=1)
    got = sorted(read_token_files(spark, out("tokens")).collect(), key=lambda r: r.doc_id)
    start = 0
    for r, (i, text) in zip(got, sorted(zip(order, texts), key=lambda x: x[0])):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (i, start, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert len(got) == len(texts)


def test_token_files_null_ids_repeats_and_empty_table(spark, out):
    name = public_tokenizers.path("word_bpe_49k.json")
    write_token_files(frame(spark, ["b", "a", "a", None], [None, 2, 2, 1]), out("odd"), name, end_id=1)
    got = sorted(read_token_files(spark, out("odd"), with_ids=False).collect(), key=lambda r: r.start)
    assert [(r.doc_id, r.start, r.n_tokens) for r in got] == [(None, 0, 2), (1, 2, 1), (2, 3, 2), (2, 5, 2)]
    write_token_files(spark.createDataFrame([], SCHEMA), out("none"), name, end_id=1)
    assert read_token_files(spark, out("none")).count() == 0


def test_pieces_equal_the_library(spark):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=default_model())
    rng = random.Random(3)
    noise = ["".join(rng.choice("abcdehinorstuv.,-é日\n ") for _ in range(rng.randrange(60))) for _ in range(200)]
    gaps = [("x" * (k % 3)) + " " * k + "ab" + " " * (k // 2) + "c" for k in range(50)]
    texts = ODD + HARD + prose(40, 61) + noise + gaps + ["<s> <0x0A> </s> 12345 http://x.y/z?q=1", "\U0001f600\x7f"]
    texts = [t for t in texts if t is None or len(t) < 40_000 or " " in t] + ["x" * 3000]
    docs = frame(spark, texts)
    coded = encode_pieces(docs, default_model())
    got = {r.doc_id: r for r in coded.collect()}
    for i, text in enumerate(texts):
        assert got[i].ids == library.encode(text or "") and got[i].n_tokens == len(got[i].ids), repr(text)[:80]
    back = {r.doc_id: r.text for r in decode_pieces(coded, default_model()).collect()}
    assert all(back[i] == (t or "").replace("▁", " ") for i, t in enumerate(texts))
    report = piece_report(docs, default_model()).collect()
    assert all(r.round_trip for r in report)
    assert {r.doc_id: r.ids_crc32 for r in report} == {i: zlib.crc32(np.array(g.ids, "<u4").tobytes()) for i, g in got.items()}
    assert encode_pieces(spark.createDataFrame([], SCHEMA), default_model()).count() == 0


def test_unigram_path_is_best():
    model = load_model(default_model())
    rng = np.random.default_rng(0)
    model.merges, model.stable = False, np.isin(np.arange(len(model.score)), model.ids)
    model.score = -rng.random(len(model.score)) * 10
    encoder = Encoder(model)
    from sentencepiece import SentencePieceProcessor

    reader = SentencePieceProcessor(model_file=default_model())
    text_of = {reader.id_to_piece(int(i)): int(i) for i in model.ids}
    worst = model.score[model.ids].min() - 10
    for word in (" the", "thermo", "ab", " international", "x"):
        best = [(0.0, [])]
        marked = word.replace(" ", "▁")
        for j in range(1, len(marked) + 1):
            options = [
                (best[i][0] + model.score[text_of[marked[i:j]]], [*best[i][1], text_of[marked[i:j]]])
                for i in range(j) if marked[i:j] in text_of
            ] or [(best[j - 1][0] + worst, [*best[j - 1][1], -1])]
            best.append(max(options))
        ids, count = encoder.encode([word.encode()])
        assert count[0] == len(ids) and ids.tolist() == best[-1][1]
