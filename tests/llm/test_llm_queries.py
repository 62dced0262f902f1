"""The registered queries on the smallest tables against plain versions, and the pipeline's stages."""

import hashlib
import zlib

import brute
import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tabulith.catalog import table
from tabulith.llm import catalog

FOLDER = "/root/testdata/sf0.001"


def rows_of(spark, name, *columns):
    return sorted(tuple(r) for r in catalog.QUERIES[name](spark, FOLDER).select(*columns).collect())


@pytest.fixture(scope="module")
def docs(spark):
    return sorted((r.doc_id, r.text) for r in table(spark, FOLDER, "documents").collect())


@pytest.fixture(scope="module")
def encoded(docs):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return library, [e.ids for e in library.encode_batch([t or "" for _, t in docs], add_special_tokens=False)]


def test_op1(spark, docs):
    lang = {r.doc_id: r.lang for r in table(spark, FOLDER, "documents").collect()}
    got = rows_of(spark, "op1_language_mixture", "doc_id", "held_out", "lang_pred", "score")
    assert [(d, h) for d, h, _, _ in got] == [(d, brute.crc(d) % 3 == 1) for d, _ in docs]
    assert np.mean([p == lang[d] for d, h, p, _ in got if h]) > 0.9


def test_op2(spark, docs):
    assert rows_of(spark, "op2_forest_near_duplicates", "doc_id", "n_shingles", "component_id", "kept") == sorted(
        brute.near_duplicates(docs))


def test_op3(spark):
    turns = table(spark, FOLDER, "conversations").count()
    got = catalog.QUERIES["op3_role_repair"](spark, FOLDER).collect()
    assert sum(r.action != "insert" for r in got) == turns


def test_op4(spark, docs):
    library = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = [(d, len((t or "").encode()), n, n > 4096) for d, t in docs for n in [len(library.encode(t or ""))]]
    assert rows_of(spark, "op4_piece_counts", "doc_id", "n_bytes", "n_tokens", "over_limit") == want


def test_op5(spark, docs):
    got = rows_of(spark, "op5_recurrent_scores", "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    for g, w in zip(got, sorted(brute.unigram_scores(docs))):
        assert g[:5] == w[:5] and abs(g[5] - w[5]) < 1e-6 * abs(w[5])
    held = [g for g in got if g[1]]
    assert sum(g[6] for g in held) > sum(g[5] for g in held)


def test_op6(spark, docs, encoded):
    library, ids = encoded
    want = [(d, len(e), hashlib.sha256(" ".join(map(str, e)).encode()).hexdigest(),
             hashlib.sha256(library.decode(e, skip_special_tokens=False).encode()).hexdigest()) for (d, _), e in zip(docs, ids)]
    assert rows_of(spark, "op6_bpe_round_trip", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == want


def test_op7(spark, docs, encoded):
    want, start = [], 0
    for (d, _), e in zip(docs, encoded[1]):
        e = np.array([*e, 1], "<u4")
        want.append((d, start, len(e), zlib.crc32(e.tobytes())))
        start += len(e)
    assert rows_of(spark, "op7_packed_ids", "doc_id", "start", "n_tokens", "ids_crc32") == want


def test_op8(spark, docs):
    items = [(r.item_id, r.text) for r in table(spark, FOLDER, "benchmark").collect()]
    assert rows_of(spark, "op8_winnow_contamination", "doc_id", "n_words", "n_hit", "n_items", "items_sha256",
                   "contaminated") == sorted(brute.contamination(docs, items))


def test_op9(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, FOLDER, "embeddings").collect()]
    assert rows_of(spark, "op9_hnsw_near_duplicates", "vec_id", "n_links", "component_id", "kept") == sorted(
        brute.embedding_links(rows))


def test_op10(spark, docs):
    got = rows_of(spark, "op10_toxicity_kernel", "doc_id", "held_out", "score", "predicted")
    assert [(d, h) for d, h, _, _ in got] == [(d, brute.crc(d) % 5 == 0) for d, _ in docs]
    assert all(0 <= s <= 1 and p == (s >= 0.5) for _, _, s, p in got)


def test_pipeline(spark):
    """Every stage keeps whole rows of its input, and what it removes is what the plain versions say."""
    docs = table(spark, FOLDER, "documents")
    items = [(r.item_id, r.text) for r in table(spark, FOLDER, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = sorted(map(tuple, docs.collect()))
        after = stage(spark, docs, FOLDER)
        if name == "tokens":
            library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
            want = {}
            for r in before:
                ids = library.encode(r[1] or "", add_special_tokens=False).ids
                want[r[0]] = (ids, len(ids), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest())
            assert {r.doc_id: (r.ids, r.n_tokens, r.decoded_sha256) for r in after.collect()} == want
            break
        assert after.columns == docs.columns
        kept = sorted(map(tuple, after.collect()))
        assert set(kept) <= set(before)
        texts = [r[:2] for r in before]
        if name == "near_dedup":
            want = {d for d, _, _, stays in brute.near_duplicates(texts, 5, 80, 100) if stays}
            assert {r[0] for r in kept} == want
        if name == "decontaminate":
            assert {r[0] for r in kept} == {r[0] for r in brute.contamination(texts, items) if not r[5]}
        if name == "language":
            assert len(kept) > 0.95 * len(before)
        docs = after
    assert corpus_pipeline.run(spark, FOLDER).columns == ["doc_id", "lang", "source", "ids", "n_tokens", "decoded_sha256"]
