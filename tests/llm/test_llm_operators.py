"""Each operator against a plain version, on small tables with every odd case."""

import hashlib
import itertools
import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tabulith.llm import bpe, forest, hnsw, kernel, mixture, packing, pieces, recurrent, roles, winnowing, words

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, score double, key long, spans string, lang_pred string"


def sentence(rng, n, stock="abcdefgh"):
    return " ".join("".join(rng.choice(stock) for _ in range(rng.randint(1, 5))) for _ in range(n))


def odd_texts():
    rng = random.Random(5)
    base = sentence(rng, 60)
    return [base, base, base.upper(), None, "", " \t\r\n\x0b", "12 34 !!!", "one", "été ÉTÉ 東京 ①", "\x1c x\x1cy \x85 z",
            "<|endoftext|> a<|startoftext|>b", "it's I'LL a▁b  c\n\n d", " ".join(base.split()[:-1] + ["zz"]), "x" * 3000,
            sentence(rng, 4000)]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en" if i % 2 else None, 1.0, None, "s", "x") for i, t in enumerate(odd_texts())]
    return spark.createDataFrame([*rows, (None, "a null id", None, None, 1, None, None), rows[0]], DOCS)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x) for x in r[:2]))


def random_texts(n, seed):
    rng = random.Random(seed)
    letters = "abc THE ' 's<|>.é\n\t ▁ß東①" + "".join(map(chr, range(32)))
    wide = [*range(0x250), *range(0x370, 0x3000, 7), *range(0x1F300, 0x1F600, 5)]
    return ["".join(rng.choice(letters) if rng.random() < 0.8 else chr(rng.choice(wide)) for _ in range(rng.randint(0, 60)))
            for _ in range(n)]


def test_word_hashes_are_equal_as_words_are(monkeypatch):
    monkeypatch.setattr(words, "BLOCK", 32)
    texts = [*random_texts(200, 1), None, "", "q" * 100, "ABC abc"]
    for separators, pattern in ((words.SPACE, "[^\x20\x09-\x0D]+"), (words.NOT_ALNUM, "[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")):
        hashes, bounds = words.hash_words(pa.array(texts), words.separator_table(separators))
        want = [brute.re.findall(pattern, brute.lower(t)) for t in texts]
        assert np.diff(bounds).tolist() == [len(w) for w in want]
        flat = list(itertools.chain(*want))
        assert len(set(flat)) == len(set(hashes.tolist())) == len(set(zip(flat, hashes.tolist())))


def test_bpe_equals_the_library():
    own, library = bpe.load(WORD_BPE), Tokenizer.from_file(WORD_BPE)
    texts = [t or "" for t in [*odd_texts(), *random_texts(1500, 2)]]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert list(own.encode_batch(texts)) == want
    assert [own.decode(i) for i in want] == [library.decode(i, skip_special_tokens=False) for i in want]
    assert own.encode(None) == []


def test_bpe_forgets_and_relearns(monkeypatch):
    own = bpe.WordBpe(WORD_BPE)
    texts = [t or "" for t in odd_texts()]
    want = list(own.encode_batch(texts))
    monkeypatch.setattr(bpe, "KEPT_WORDS", 5)
    assert [own.encode(t) for t in texts] == want


def test_piece_counts_equal_the_library():
    library = SentencePieceProcessor(model_file=PIECES)
    texts = [*odd_texts(), *random_texts(2000, 3)]
    assert list(pieces.load(PIECES).count_batch(texts)) == [len(library.encode(t or "")) for t in texts]


@pytest.mark.parametrize("bits", [1, 5, 16, 17, 31, 32])
def test_packing_round_trip(bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000, dtype=np.uint64).astype(np.uint32)
    packed = packing.pack(ids, bits)
    assert (packing.unpack(packed, bits, 0, 1000) == ids).all()
    assert (packing.unpack(packed, bits, 333, 777) == ids[333:777]).all()
    assert len(packed) * 32 <= 1000 * bits + 64
    assert len(packing.unpack(packing.pack(ids[:0], bits), bits, 0, 0)) == 0


def test_packed_files(spark, odd, empty, tmp_path):
    path = str(tmp_path / "ids")
    packing.write_ids(odd, path, WORD_BPE, block_ids=50)
    own = bpe.load(WORD_BPE)
    want, start = [], 0
    for d, t in ordered(pairs(odd)):
        ids = np.array([*own.encode(t), 1], "<u4")
        want.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)

    def digest(block, start):
        ids, o = block.all_ids().astype("<u4"), block.offsets
        return pa.RecordBatch.from_arrays(
            [pa.array(block.keys, pa.int64()), pa.array(start + o[:-1]), pa.array(np.diff(o)),
             pa.array([zlib.crc32(ids[a:b]) for a, b in zip(o[:-1], o[1:])], pa.int64())], names=list("dsnc"))
    got = packing.read_ids(spark, path, digest, "d long, s long, n long, c long").orderBy("s").collect()
    assert [tuple(r) for r in got] == want
    assert [x.tolist() for x in packing.lookup(spark, path, 12)] == [[*own.encode(odd_texts()[12]), 1]]
    packing.write_ids(empty, str(tmp_path / "none"), WORD_BPE)
    assert packing.read_ids(spark, str(tmp_path / "none"), digest, "d long, s long, n long, c long").count() == 0


@pytest.mark.parametrize("broadcast", [0, 10**6])
def test_contamination(spark, odd, empty, monkeypatch, broadcast):
    monkeypatch.setattr(winnowing, "BROADCAST_WINDOWS", broadcast)
    base = odd_texts()[0].split()
    items = [(1, " ".join(base[5:25])), (2, " ".join(base[30:34])), (3, None), (4, ""), (5, "one"), (20, " ".join(base[10:40])),
             (6, sentence(random.Random(9), 30)), (6, "12 34"), (7, "!!!")]
    bench = spark.createDataFrame(items, "item_id long, text string")

    def result(docs, bench):
        found = winnowing.contamination(docs, bench)
        n_hit = winnowing.contaminated_words(F.col("spans"))
        return [(r.doc_id, r.n_words, r.n_hit, len(r.items), hashlib.sha256(",".join(sorted(map(str, r.items))).encode())
                 .hexdigest(), r.bad) for r in found.select("*", n_hit.alias("n_hit"), winnowing.is_contaminated(
                     n_hit, F.col("n_words")).alias("bad")).collect()]
    assert ordered(result(odd, bench)) == ordered(brute.contamination(pairs(odd), items))
    assert result(empty, bench) == []
    assert all(r[2] == 0 for r in result(odd, bench.limit(0)))


def languages(rng, n):
    stock = {"aa": "abcde", "bb": "fghij", "cc": "klmno"}
    return [(i, sentence(rng, 30, stock[l]), l) for i in range(n) for l in [rng.choice(sorted(stock))]]


def test_language_mixture(spark, odd, empty):
    rows = languages(random.Random(3), 120)
    model = mixture.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    shared = spark.sparkContext.broadcast(model)
    both = " ".join(r[1] for l in ("aa", "cc") for r in [next(r for r in rows if r[2] == l)])
    frame = spark.createDataFrame([(r[0], r[1]) for r in rows] + [(900, both)], "doc_id long, text string")
    found = {r.doc_id: r.a for r in frame.select("doc_id", mixture.predict(F.col("text"), shared).alias("a")).collect()}
    assert all(found[i].lang_pred == l for i, _, l in rows)
    assert {x.lang for x in found[900].languages} == {"aa", "cc"}
    assert all(0.3 < x.share < 0.7 for x in found[900].languages)
    answers = {r.doc_id: r.a for r in odd.select("doc_id", mixture.predict(F.col("text"), shared).alias("a")).collect()}
    assert [answers[i].lang_pred for i in (3, 4, 5, 6)] == ["und"] * 4 and answers[3].score == 0
    assert all(0 <= a.score <= 1 for a in answers.values())
    nothing = spark.sparkContext.broadcast(mixture.fit(empty))
    assert {r.a.lang_pred for r in odd.select(mixture.predict(F.col("text"), nothing).alias("a")).collect()} == {"und"}


def test_mixture_equals_direct_search():
    """The selected set has the best penalised likelihood among all sets, found on a grid of shares."""
    rng = np.random.default_rng(2)
    for truth in ((1, 0, 0), (0.6, 0.4, 0), (0, 0.5, 0.5)):
        own = rng.choice(3, 80, p=truth)
        logs = np.where(np.arange(3) == own[:, None], -2.0, -6.0) + rng.normal(0, 0.3, (80, 3))
        shares, _ = mixture.infer(logs, np.ones(80), np.array([0]))
        grid = [np.array((a, b, 20 - a - b)) / 20 for a in range(21) for b in range(21 - a)]
        best = max(grid, key=lambda s: np.log(np.exp(logs) @ s + 1e-300).sum() - 0.5 * ((s > 0).sum() - 1) * np.log(80))
        assert set(np.flatnonzero(shares[0])) == set(np.flatnonzero(best))
        assert np.abs(shares[0] - best).max() < 0.1


def test_string_kernel_equals_all_subsequences():
    def plain(a, b):
        def grams(w):
            out = {}
            for c in itertools.combinations(range(len(w)), kernel.LENGTH):
                g = "".join(w[i] for i in c)
                out[g] = out.get(g, 0) + kernel.DECAY ** (c[-1] - c[0] + 1)
            return out
        x, y = grams(a), grams(b)
        return sum(v * y.get(g, 0) for g, v in x.items())
    some = ["idiot", "i8diot", "idiiot", "abc", "tiodi", "aaaa", "xidiot"]
    a, b = zip(*itertools.product(some, some))
    got = kernel.kernel(kernel._codes(list(a), 0), kernel._codes(list(b), -1))
    assert np.allclose(got, [plain(x, y) for x, y in zip(a, b)])


def test_inserted_letters_and_embedded_words_keep_their_match():
    marks = ["^stupid", "^moron", "^idiot", "stupid", "moron", "idiot"]
    machine = kernel.Machine(marks)
    gaps = {"stxupxid": 0, "stxuxpxid": 0, "mxorxon": 1, "idxixot": 2, "ixdxixot": 2}
    inside = {"totalmoron": 1, "youmoronxx": 1, "reallystupidperson": 0, "suchanidiotindeed": 2}
    machine.learn([*gaps, *inside, "kwyz"])
    for word, at in {**gaps, **inside}.items():
        row = (machine.known[word] >> 3) - 1
        found = machine.table[row]
        assert row >= 0 and found.argmax() % 3 == at, word
        assert found.max() > (0.5 if word in inside else 0.05), word
    assert machine.known["kwyz"] >> 3 == 0
    some = ["^stupid", "^idxixot", "moron", "stxuxpxid", "aaa", "^tattoo"]
    own = kernel._self(marks)
    want = [[kernel.kernel(kernel._codes([w], 0), kernel._codes([m], -1))[0] / np.sqrt(kernel._self([w])[0] * o)
             for m, o in zip(marks, own)] for w in some]
    want = np.where(np.array(want) < kernel.ACTIVE, 0, want) ** 2
    assert np.allclose(kernel.Landmarks(marks).alike(some), want, atol=1e-5)


def toxic_rows(rng, n):
    bad = ["wretch", "dunce"]
    rows = []
    for i in range(n):
        own = sentence(rng, 40, "abcdefghorstu").split()
        if i % 4 == 0:
            own.insert(rng.randint(0, 39), rng.choice(bad))
        rows.append((i, " ".join(own) + ".", int(i % 4 == 0)))
    return rows


def test_toxicity(spark, odd, empty):
    rows = toxic_rows(random.Random(4), 400)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y, y) for i, _, y in rows] + [(0, 1, 1), (None, 1, 1), (5, None, None)],
                                   "doc_id long, quality int, toxic int")
    machine = kernel.fit(docs, labels)
    shared = spark.sparkContext.broadcast(machine)
    test = toxic_rows(random.Random(8), 200)
    frame = spark.createDataFrame([(i, t) for i, t, _ in test], "doc_id long, text string")
    got = {r[0]: r[1] for r in frame.select("doc_id", kernel.score(F.col("text"), shared)).collect()}
    assert np.mean([(got[i] >= 0.5) == bool(y) for i, _, y in test]) > 0.97
    spelled = list(machine.score(["a w r e t c h he is", "you w.r.e.t.c.h", "", None]))
    assert min(spelled[:2]) >= 0.5 and max(spelled[2:]) < 0.5
    assert all(0 <= r[0] <= 1 for r in odd.select(kernel.score(F.col("text"), shared)).collect())
    nobody = kernel.fit(empty, labels)
    assert list(nobody.score(["a", None])) == [nobody.score([""]).__next__()] * 2


def copies(rng, family, size, change):
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(size)]
    for _ in range(family):
        own = list(base)
        for _ in range(rng.randint(0, change)):
            own[rng.randrange(size)] = f"v{rng.randint(0, 10**6)}"
        yield " ".join(own)


@pytest.mark.parametrize("block", [4, 192])
def test_near_duplicates(spark, odd, empty, monkeypatch, block):
    monkeypatch.setattr(forest, "BLOCK_DOCS", block)
    rng = random.Random(6)
    texts = [*odd_texts(), *copies(rng, 40, 120, 6), *copies(rng, 5, 60, 2), *copies(rng, 30, 80, 8)]
    rows = list(enumerate(texts)) + [(0, texts[0])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("rep", F.lit(2))
    for size, share in ((3, 85), (5, 80)):
        got = forest.near_duplicates(frame, size=size, threshold=(share, 100)).collect()
        want = {d: (n, c) for d, n, c, _ in brute.near_duplicates(rows[:-1], size, share, 100)}
        assert len(got) == len(rows)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert forest.near_duplicates(empty).count() == 0
    assert forest.near_duplicates(odd).where("doc_id is null and component_id is null").count() == 1


@pytest.mark.parametrize("shard_rows", [25, 8192])
def test_embedding_duplicates(spark, shard_rows):
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(6, 16))
    rows = [(i, (centers[i % 6] + rng.normal(size=16) * (0.12 if i % 3 else 0.4)).astype(np.float32).tolist(), i % 2)
            for i in range(240)]
    rows += [(300 + i, rows[7][1], rows[7][2]) for i in range(30)]
    rows += [(400, None, 1), (401, [0.0] * 16, 1), (402, [float("nan")] * 16, 1), (403, [1.0, None] * 8, 1), (404, rows[0][1], None),
             (405, [float("inf")] + [0.0] * 15, 0), (406, [1.0] * 4, 0), (407, [], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted(tuple(r) for r in hnsw.near_duplicates(frame.withColumn("links", F.lit(1)), shard_rows=shard_rows).collect())
    assert got == sorted(w[:3] for w in brute.embedding_links(rows))
    assert hnsw.near_duplicates(frame.limit(0)).count() == 0


def test_graph_recall():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(1500, 24))
    x /= np.sqrt((x * x).sum(1))[:, None]
    ids, _ = hnsw.Graph(x).search(x[:200].astype(np.float32), 64)
    truth = np.argsort(-(x[:200] @ x.T), axis=1)[:, :10]
    assert np.mean([len(set(a[:10]) & set(b)) / 10 for a, b in zip(ids.tolist(), truth.tolist())]) > 0.9


def cheapest(seq):
    best = [10**9]

    def go(i, state, cost):
        if cost >= best[0]:
            return
        if i == len(seq):
            best[0] = min(best[0], cost + {0: 0, 1: roles.INSERT + roles.INSERT_LAST, 2: roles.INSERT_LAST, 3: 0}[state])
            return
        own = roles.ROLES.index(seq[i]) + 1 if seq[i] in roles.ROLES else None
        for path in [(), *[(s,) for s in roles.LEGAL[state]]]:
            for n in roles.LEGAL[path[0] if path else state]:
                go(i + 1, n, cost + roles.INSERT * len(path) + (0 if n == own else roles.RELABEL))
        if state:
            go(i + 1, state, cost + (roles.MERGE if state == own else roles.MERGE_OTHER))
    go(0, 0, 0)
    return best[0]


def test_role_repair(spark):
    rng = random.Random(2)
    some = ["system", "user", "assistant", "tool", None, " User "]
    rows = [(c, t, rng.choice(some), rng.choice(["hi", "", None])) for c in range(60) for t in range(rng.randint(1, 6))]
    rows += [(99, t, rng.choice(some), "x") for t in range(400)] + [(None, None, "user", "a"), (3, 0, "user", "tie")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit(0))
    got = roles.repair_turns(frame).collect()
    assert sum(r.action != "insert" for r in got) == len(rows)
    convs = {}
    for r in sorted(got, key=lambda r: (r.turn is not None, r.turn, r.step)):
        convs.setdefault(r.conv_id, []).append(r)
    for c, own in convs.items():
        given = sorted([r for r in rows if (None if r[0] is None else str(r[0])) == c],
                       key=lambda r: tuple((x is not None, x) for x in r[1:]))
        known = [roles._known(r[2]) for r in given]
        cost = cheapest(known) if len(known) < 9 else roles.repair(known)[0]
        assert sum(r.cost for r in own) == cost
        state = roles.START
        for r in own:
            if r.action != "merge":
                after = roles.ROLES.index(r.role) + 1
                assert after in roles.LEGAL[state]
                state = after
                assert r.segment.startswith(f"<|{r.role}|>\n")
        assert state in (roles.START, roles.ASSISTANT)
    assert roles.repair_turns(frame.limit(0)).count() == 0


def test_network_gradient():
    rng = np.random.default_rng(5)
    net = recurrent.Net.fresh(rng.normal(size=recurrent.CLASSES))
    inputs, targets = rng.integers(0, recurrent.CLASSES, (2, 6, 3))
    fresh = np.zeros((6, 3), bool)
    fresh[3, 1] = True
    weight = np.ones((6, 3), np.float32)
    h = rng.normal(size=(3, recurrent.HIDDEN)).astype(np.float64)
    net = recurrent.Net(*[x.astype(np.float64) for x in net.arrays()])

    def loss():
        s, total = h, 0.0
        for t in range(6):
            s = net.step(np.where(fresh[t][:, None], 0, s), inputs[t])[0]
            total -= np.take_along_axis(net.log_classes(s), targets[t][:, None], 1).sum()
        return total / 18
    grads, _ = recurrent.Backward(net, 3)(h.T, inputs, targets, fresh, weight)
    for x, g in zip(net.arrays(), grads):
        for at in rng.integers(0, x.size, 6):
            i = np.unravel_index(int(np.abs(g).argmax() if at % 2 else at), x.shape)
            keep, step = x[i], 1e-6
            x[i] = keep + step
            up = loss()
            x[i] = keep - step
            down = loss()
            x[i] = keep
            assert abs((up - down) / (2 * step) - g[i]) < 1e-4 + 1e-3 * abs(g[i])  # single precision


def test_likelihood_does_not_depend_on_the_batch():
    rng = np.random.default_rng(6)
    net = recurrent.Net.fresh(rng.normal(size=recurrent.CLASSES))
    some = [np.append(rng.integers(0, recurrent.END, n), recurrent.END) for n in (0, 1, 5, 60, 200, 7)]
    alone = [recurrent.log_likelihood(net, [s])[0] for s in some]
    assert np.allclose(recurrent.log_likelihood(net, some), alone, rtol=1e-5)


@pytest.mark.parametrize("head", [0, 30, 400_000])
def test_recurrent_scores(spark, odd, empty, monkeypatch, head):
    monkeypatch.setattr(recurrent, "HEAD_WORDS", head)
    rows = [(i, t) for i, t, _ in languages(random.Random(7), 80)] + [(100 + i, t) for i, t in enumerate(odd_texts())] + [(5, "a b")]
    rows = list(dict(rows).items())
    frame = spark.createDataFrame([*rows, rows[3]], "doc_id long, text string").withColumn("uid", F.lit(1))
    training = frame.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2).dropDuplicates()
    got = {r.doc_id: r for r in recurrent.score(frame, training).collect()}
    for d, _, n, known, total, base in brute.unigram_scores(rows):
        r = got[d]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert abs(r.base_score - base) < 1e-6 * max(1, abs(base)) and np.isfinite(r.score) and r.score < 0
    assert recurrent.score(frame, training).count() == len(rows) + 1
    if head == 30:
        assert recurrent.score(empty, training).count() == 0
        assert all(np.isfinite(r.score) for r in recurrent.score(odd, empty).collect())


@pytest.mark.parametrize("fan_in", [2, 32])
def test_network_learns_from_every_document(spark, monkeypatch, fan_in):
    """Far more documents than any fixed sample would hold, in more replicas than one task averages."""
    monkeypatch.setattr(recurrent, "REPLICA_TOKENS", 2000)
    monkeypatch.setattr(recurrent, "RUN_TOKENS", 500)
    monkeypatch.setattr(recurrent, "FAN_IN", fan_in)
    training = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("a "), F.col("id") % 7).alias("text"))
    counted = recurrent.count_words(training, "text").persist()
    shared = spark.sparkContext.broadcast(recurrent._vocabulary(counted, 6000))
    net, learned = recurrent.fit_network(training, "doc_id", "text", shared, rounds=1)
    assert learned == 6000 * 3
    again, _ = recurrent.fit_network(training.repartition(3), "doc_id", "text", shared, rounds=1)
    assert np.allclose(net.flat(), again.flat(), atol=1e-5)


def test_shares_of_a_class_sum_to_one(spark):
    rows = [(i, t) for i, t, _ in languages(random.Random(9), 60)]
    counted = recurrent.count_words(spark.createDataFrame(rows, "doc_id long, text string"), "text").persist()
    known = recurrent._vocabulary(counted, 60)
    mass = {}
    for h, cls, c in [tuple(r) for r in counted.collect()]:
        at, _ = known.look_up(np.array([h]).view(np.uint64), np.array([0], np.uint16))
        own = int(at[0]) if at[0] < recurrent.OWN_CLASS else cls
        mass[own] = mass.get(own, 0) + c
    for cls, total in mass.items():
        assert total == known.class_total[cls]


def test_a_worker_forgets_at_the_end_of_a_task(monkeypatch):
    from tabulith.llm import kernel, words

    class Owner:
        kept = [1]

        def forget(self):
            self.kept = []
    a, b = Owner(), Owner()
    words.claim_memory(a)
    words.claim_memory(b)
    assert a.kept == [] and b.kept == [1] and words._holder == [b]
    words.release_memory()
    assert b.kept == [] and words._holder == []
    machine = kernel.Machine(["^abcdef"])
    machine.learn(["abcdef", "abcdeg"])
    assert kernel._own_values
    machine.forget()
    assert not kernel._own_values and not machine.known


def test_one_worker_codes_and_decodes(odd):
    """The pipeline's last stage: ids and the digest of their text by one Python step, equal to the two steps."""
    both = odd.select("doc_id", bpe.round_trip(F.col("text"), WORD_BPE).alias("c")).select("doc_id", "c.ids", "c.decoded_sha256", F.size("c.ids"))
    assert both._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    ids = odd.select("doc_id", bpe.encode(F.col("text"), WORD_BPE).alias("ids"))
    plain = ids.select("doc_id", "ids", F.sha2(bpe.decode(F.col("ids"), WORD_BPE).cast("binary"), 256), F.size("ids"))
    assert ordered(map(tuple, both.collect())) == ordered(map(tuple, plain.collect()))


def test_kept_words_of_a_releasing_machine_are_few(odd):
    rows = [(i, f"{w} zebra{i}") for i, w in enumerate(["hatefulness", "kindness"] * 20)]
    docs = odd.sparkSession.createDataFrame(rows, "doc_id long, text string")
    labels = docs.select("doc_id", (1 - F.col("doc_id") % 2).cast("int").alias("toxic"))
    few, many = kernel.fit(docs, labels, release=True), kernel.fit(docs, labels)
    assert few.landmarks == many.landmarks != [] and few.bias == many.bias
    assert few.kept == kernel.FEW_WORDS < many.kept == kernel.KEPT_WORDS
    few.kept = 1
    texts = [t for _, t in rows] * 3
    assert list(few.score(texts)) == list(many.score(texts))


def test_contaminated_documents_are_read_by_one_python_step(spark, odd):
    items = spark.createDataFrame([("a", "one two three")], "item_id string, text string")
    found = winnowing.contamination(odd.select("doc_id", "text"), items)
    gone = found.where(winnowing.is_contaminated(winnowing.contaminated_words(F.col("spans")), F.col("n_words")))
    assert gone._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1


def test_scores_stay_exact_where_logits_are_large_and_lanes_end_apart():
    rng = np.random.default_rng(3)
    for scale in (0.3, 30.0):
        net = recurrent.Net(*[(scale * rng.normal(size=x.shape)).astype(np.float32) for x in recurrent.Net.fresh(np.zeros(recurrent.CLASSES)).arrays()])
        texts = [rng.integers(0, recurrent.CLASSES, n) for n in (1, 7, 300, 2, 40)]
        plain = []
        for text in texts:
            h, before, total = np.zeros((1, recurrent.HIDDEN), np.float32), recurrent.END, 0.0
            for c in text:
                h = net.step(h, np.array([before]))[0]
                total, before = total + float(net.log_classes(h)[0, c]), c
            plain.append(total)
        np.testing.assert_allclose(recurrent.log_likelihood(net, texts), plain, rtol=2e-3)
    assert recurrent.Net.fresh(np.zeros(recurrent.CLASSES)).small_logits() and not net.small_logits()


def test_a_round_of_a_replica_is_one_run():
    """A short second run costs as many steps as its longest document has words."""
    batch = pa.RecordBatch.from_arrays([pa.array([bytes(5000)] * 270, pa.binary())], ["classes"])
    assert [len(r) for r in recurrent._runs([batch], 0)] == [270]
