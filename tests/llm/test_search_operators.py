"""Hard negatives, spelling variants and nearest neighbours against plain versions, and on odd rows."""

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulith.catalog import table
from tabulith.llm import catalog, collisions, residual_codes, variants

FOLDER, VECTORS = "/root/testdata/sf0.001", "vec_id long, embedding array<float>, label int, score string, key string, block int"
TEXTS = "doc_id long, text string, word string, n int"


def rows_of(frame, *columns):
    return sorted(tuple(r) for r in frame.select(*columns).collect())


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, c, "x", "y", 1) for i, v, c in rows], VECTORS)


@pytest.fixture(scope="module")
def odd():
    """Copies, near copies, ties, other lengths, and rows that take no part."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.1, 16).astype("f").tolist(), i % 3) for i in range(300)]
    same = rows[0][1]
    rows += [(1000 + i, same, i % 3) for i in range(250)]
    rows += [(2000 + i, [1.0] * 7, i % 2) for i in range(30)]
    rows += [(i, [x + 1e-3 for x in same], 1) for i in range(3000, 3040)]
    bad = [(4000, None, 1), (4001, [], 1), (4002, [None] * 16, 1), (4003, [float("nan")] * 16, 1), (4004, [float("inf")] * 16, 2),
           (None, same, 1)]
    return rows, bad


HARD = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
NEAR = ("query_id", "rank", "vec_id", "score")


def test_hard_negatives_on_odd_rows(spark, odd):
    rows, bad = odd
    unlabelled = [(5000, rows[0][1], None), (5100, [3e38] * 16, 1)]
    zero = [(6000, [0.0] * 16, 1)]
    frame = vectors(spark, rows + bad + unlabelled + zero)
    want = [(i, c, v) for i, v, c in rows + zero]
    got = rows_of(residual_codes.hard_negatives(frame, F.col("vec_id") % 100 == 0), *HARD)
    assert got == sorted(brute.hard_negatives(want, [i for i, _, _ in want if i % 100 == 0]))
    # of rows that share an id the first by label takes part
    again = vectors(spark, [*rows, *rows[:50], (0, rows[5][1], 2)])
    assert rows_of(residual_codes.hard_negatives(again, F.col("vec_id") % 100 == 0), *HARD) == sorted(
        brute.hard_negatives([(i, c, v) for i, v, c in rows], [i for i, _, _ in rows if i % 100 == 0]))
    assert residual_codes.hard_negatives(frame.limit(0), F.col("vec_id") % 100 == 0).columns == list(HARD)
    assert residual_codes.hard_negatives(frame.limit(0), F.lit(True)).count() == 0


def test_intervals_hold_and_prune():
    rng = np.random.default_rng(9)
    whole = np.floor(256 * rng.normal(0, 0.125, (4000, 64))).astype(np.int64)
    codes, along, rest = residual_codes.encode(whole.astype(float))
    block = residual_codes.Block(np.arange(4000), np.zeros(4000), codes, along, rest, whole)
    asked = residual_codes.Asked(whole[:3].astype(float))
    for a in range(3):
        exact, seen = whole @ whole[a], []

        def narrow(low, high, every=np.arange(4000)):
            assert len(low) < 4000 or ((low <= exact) & (exact <= high)).all()
            seen.append(residual_codes._at_least(low, high, 5))
            return seen[-1]
        left = block.intervals(asked, a, np.arange(4000), narrow)
        assert set(np.argsort(-exact)[:5]) <= set(left) and len(left) < 1000  # of 4,000 unrelated vectors
        assert (block.scores(left, whole[a]) == exact[left]).all()


def test_large_components_are_scored_in_integers():
    whole = np.array([[1 << 29, 3, 1], [1 << 29, 5, -1]])
    codes, along, rest = residual_codes.encode(whole.astype(float))
    block = residual_codes.Block(np.arange(2), np.zeros(2), codes, along, rest, whole)
    assert block.scores(np.arange(2), whole[0]).tolist() == [(1 << 58) + 10, (1 << 58) + 14]


def test_op11(spark):
    found = {r.vec_id: (r.vec_id, (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label, r.embedding)
             for r in table(spark, FOLDER, "embeddings").collect()}
    want = brute.hard_negatives(list(found.values()), [i for i in found if i % 100 == 0])
    assert rows_of(catalog.QUERIES["op11_residual_hard_negatives"](spark, FOLDER), *HARD) == sorted(want)


def test_neighbours_on_odd_rows(spark, odd):
    rows, bad = odd
    frame = vectors(spark, rows + bad + [(6000, [0.0] * 16, 1)] + rows[:40])
    got = rows_of(collisions.nearest(frame, F.col("vec_id") % 100 == 0), *NEAR)
    want = sorted(brute.neighbours([(i, v) for i, v, _ in rows], {i for i, _, _ in rows if i % 100 == 0}))
    met = {(q, v) for q, _, v, _ in got} & {(q, v) for q, _, v, _ in want}
    assert len(got) == len(want) and len(met) >= 0.97 * len(want)
    copies = [r for r in got if r[0] == 0]
    assert copies == [r for r in want if r[0] == 0] and [r[2] for r in copies] == list(range(1000, 1010))
    assert collisions.nearest(frame.limit(0), F.lit(True)).collect() == []
    few = vectors(spark, rows[:4])
    assert rows_of(collisions.nearest(few, F.col("vec_id") == 0), *NEAR) == sorted(
        brute.neighbours([(i, v) for i, v, _ in rows[:4]], {0}))


def test_distances_beyond_a_double_are_ranked_last():
    block = collisions.Projections(np.array([[1e200, 0.0], [-1e200, 1.0], [0.0, 2.0]]))
    [(at, found, far)] = block.nearest(np.array([[0.0, 1.0]]), 3)
    assert at == 0 and found.tolist() == [0, 1, 2] and far.tolist() == [np.inf, np.inf, 1.0]


def test_op13_recall(spark):
    """Recall against brute force on 2,000 vectors; what is found has the exact distance and rank."""
    folder = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in table(spark, folder, "embeddings").collect()]
    want = brute.neighbours(rows, {i for i, _ in rows if i % 100 == 0})
    got = rows_of(catalog.QUERIES["op13_collision_neighbours"](spark, folder), *NEAR)
    distance = {(q, v): d for q, _, v, d in want}
    met = [r for r in got if (r[0], r[2]) in distance]
    assert len(met) >= 0.98 * len(want) and all(distance[r[0], r[2]] == r[3] for r in met)


FORMS = ("word", "form", "root", "n", "n_near", "form_n")


def spellings(spark, docs, **options):
    frame = spark.createDataFrame([(d, t, "w", 7) for d, t in docs], TEXTS)
    return sorted((tuple(r) for r in variants.group_variants(frame, **options).select(*FORMS).collect()), key=str)


def test_op12(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, FOLDER, "documents").collect()]
    got = catalog.QUERIES["op12_spelling_variants"](spark, FOLDER).select(*FORMS).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute.spelling_variants(docs), key=str)


def test_spelling_of_odd_texts(spark, monkeypatch):
    rng = np.random.default_rng(2)
    made = ["".join(rng.choice(list("abé"), rng.integers(4, 8))) for _ in range(1500)]
    long = "xy" * 3000
    docs = [(i, " ".join(rng.choice(made, 60))) for i in range(100)]
    docs += [(None, "aaaaaa aaaaab " * 5), (7, None), (8, ""), (9, "1 2 ,,"), (10, f"{long} {long}a {long[1:]} " * 4),
             (10, f"{long} {long}a {long[1:]} " * 4), (11, "ÀÉÎÕÜ ÀÉÎÕÝ " * 9), (12, "ABCDEF abcdeg " * 4)]
    want = sorted(brute.spelling_variants(docs), key=str)
    assert spellings(spark, docs) == want
    monkeypatch.setattr(variants, "TILE", 16)  # every common half is then cut into many tiles
    assert spellings(spark, docs) == want
    assert spellings(spark, [(1, None)]) == [] and spellings(spark, docs[:0]) == []


def test_forms_lead_to_the_last_root(spark):
    chain = ["aaaaa", "aaaab", "aaabb", "aabbb", "abbbb", "bbbbb"]
    docs = [(None, " ".join(w for i, w in enumerate(chain) for _ in range(3 * 2**i)))]
    assert {(w, r) for w, _, r, *_ in spellings(spark, docs)} == {(w, "bbbbb") for w in chain}
