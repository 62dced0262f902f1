"""Toxicity by a subsequence string kernel and a support vector machine on Nyström landmarks.

Two strings are alike as they share subsequences of three letters, each weighted by how far its letters are
spread, so inserted characters and gaps weaken a match without breaking it. Landmark words come from
a bounded sample of labelled documents; a sentence's features are its words' largest kernel value with
each landmark. Labels belong to documents, so training picks each toxic document's most telling sentence anew
in every round. A document scores as its worst sentence.

Empty, null and landmark-free texts get the score of a sentence without any match.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulith.runtime import reused

from .words import bound_batches, claim_memory, release_memory

TRAIN_DOCS = 4000  # expected number of labelled documents per class that the machine is fitted on
LANDMARKS = 64
CANDIDATES = 600
STEMS = range(4, 8)  # letters of the word beginnings that landmarks are chosen from
CERTAIN, LEAST_Z = 0.85, 4.0
START = "^"
CLOSE = 0.5  # a sentence with such a feature is an instance of its own in training
LENGTH, DECAY = 3, 0.75  # letters of a subsequence, weight per position it spans
ACTIVE = 0.2  # kernel values below count as 0; three letters inserted into a word of six leave about 0.3
WINDOWS = {6: 1, 12: 2}  # longer words are compared in windows of so many letters, one every so many, and whole up to the longest
CHUNK = 2048  # windows of words compared at once
CLOSE_ROWS = 16  # close sentences of a document used in training
ROUNDS = 4
KEPT_WORDS = 400_000  # words whose features a worker remembers; beyond, it begins again
FEW_WORDS = 150_000  # the same where memory counts more than time
BATCH_CHARS = 2_000_000
SPELLED = re.compile(r"(?<!\S)\w(?:[ .*_-]\w){2,}(?!\S)")
OTHER = re.compile(r"[\W_]+")
LETTERS = re.compile(r"\w(?:[.*_-]\w)*")
ACTIVE_WORDS = 8192  # words whose features are laid out at once


def kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Gap-weighted subsequence kernel of row pairs; rows are letter codes padded with 0 (a) and -1 (b)."""
    n, la = a.shape
    lb = b.shape[1]
    same = [[a[:, i] == b[:, j] for j in range(lb)] for i in range(la)]
    before = np.ones((la + 1, lb + 1, n))
    square = DECAY * DECAY
    for _ in range(LENGTH - 1):
        after = np.zeros((la + 1, lb + 1, n))
        for i in range(la):
            run = np.zeros(n)
            for j in range(lb):
                run = DECAY * run + square * same[i][j] * before[i, j]
                after[i + 1, j + 1] = DECAY * after[i, j + 1] + run
        before = after
    total = np.zeros(n)
    for i in range(la):
        for j in range(lb):
            total += square * same[i][j] * before[i, j]
    return total


def _codes(words: list[str], pad: int) -> np.ndarray:
    """Letter codes, one row per word, filled with ``pad``."""
    width = max(map(len, words), default=1)
    flat = np.frombuffer("".join([w.ljust(width, "\0") for w in words]).encode("utf-32-le"), np.int32)
    out = flat.reshape(len(words), width)
    return np.where(out == 0, pad, out) if pad else out


def _self(words: list[str]) -> np.ndarray:
    return kernel(_codes(words, 0), _codes(words, -1)) if words else np.zeros(0)


def _own(codes: np.ndarray) -> np.ndarray:
    """``kernel`` of words of one length with themselves, computed once per pattern of equal letters."""
    n, length = codes.shape
    first = np.tile(np.arange(length, dtype=np.uint8), (n, 1))
    for i in range(1, length):
        for j in range(i - 1, -1, -1):
            np.putmask(first[:, i], codes[:, j] == codes[:, i], j)
    patterns, at = np.unique(first.view(f"V{length}").ravel(), return_inverse=True)
    names = [p.tobytes() for p in patterns]
    fresh = [p for p in names if p not in _own_values]
    if fresh:
        if len(_own_values) > KEPT_WORDS:
            _own_values.clear()
            fresh = names
        some = np.frombuffer(b"".join(fresh), np.uint8).reshape(len(fresh), length).astype(np.int64)
        _own_values.update(zip(fresh, kernel(some, some).tolist()))
    return np.array([_own_values[p] for p in names])[at]


_own_values: dict[bytes, float] = {}


def clean(raw: str) -> str:
    """START and the letters and digits of a white-space separated word; empty if they are too few."""
    word = raw if raw.isalnum() else OTHER.sub("", raw)
    return START + word if len(word) >= LENGTH else ""


def _triples(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places (i, j, k) of all subsequences of three letters of a word, and the weight of the span of each."""
    i, j, k = np.array(list(combinations(range(length), LENGTH)), np.int64).T
    return i, j, k, DECAY ** (k - i + 1.0)


def windows(length: int) -> list[tuple[int, list[int]]]:
    """(letters, starts) of what is compared of a word: the whole word, and windows inside it."""
    whole = [(length, [0])] if length <= max(WINDOWS) else []
    return whole + [(n, sorted({*range(0, length - n, step), length - n})) for n, step in WINDOWS.items() if n < length]


class Landmarks:
    """Landmark words by the letter triples they hold: a word's kernel value with each is a sum over its own triples."""

    def __init__(self, words: list[str]):
        self.words, self.own = words, _self(words)
        letters = sorted({ord(c) for w in words for c in w})
        self.letters = np.array(letters or [0], np.int64)
        self.base = len(letters) + 1
        found: dict[tuple[int, int], float] = {}
        for at, word in enumerate(words):
            ids = self._ids(_codes([word], 0))[0]
            for i, j, k, weight in zip(*_triples(len(word))):
                cell = (int((ids[i] * self.base + ids[j]) * self.base + ids[k]), at)
                found[cell] = found.get(cell, 0.0) + weight
        cells = sorted(found)
        triple = np.array([c[0] for c in cells], np.int64)
        self.mark = np.array([c[1] for c in cells], np.int64)
        self.weight = np.array([found[c] for c in cells]) / np.sqrt(self.own[self.mark]) if cells else np.zeros(0)
        self.start = np.searchsorted(triple, np.arange(self.base**LENGTH + 1))
        self.held = np.diff(self.start) > 0
        self.most = np.zeros(len(self.held))  # largest weight of a triple in any landmark
        np.maximum.at(self.most, triple, self.weight)

    def _ids(self, codes: np.ndarray) -> np.ndarray:
        """Letters as numbers from 1; 0 for letters of no landmark."""
        at = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
        return np.where(self.letters[at] == codes, at + 1, 0)

    def values(self, codes: np.ndarray) -> np.ndarray:
        """Normalised kernel of words of one length with each landmark; values that cannot reach ACTIVE may be 0."""
        n, length = codes.shape
        result = np.zeros((n, len(self.words)))
        i, j, k, weight = _triples(length)
        ids = self._ids(codes).astype(np.int32)
        triple = (ids[:, i] * self.base + ids[:, j]) * self.base + ids[:, k]
        row, place = np.nonzero(self.held[triple])
        if not len(row):
            return result
        cell, span = triple[row, place], weight[place]
        # a word's kernel with itself is no less than if all its triples differed
        least = ACTIVE * np.sqrt((weight * weight).sum()) * (1 - 1e-9)
        likely = np.flatnonzero(np.bincount(row, span * self.most[cell], n) >= least)
        place = np.full(n, -1)
        place[likely] = np.arange(len(likely))
        row = place[row]
        cell, span, row = cell[row >= 0], span[row >= 0], row[row >= 0]
        if not len(row):
            return result
        first, many = self.start[cell], self.start[cell + 1] - self.start[cell]
        entry = np.repeat(first - (np.cumsum(many) - many), many)
        entry += np.arange(len(entry))
        out = np.bincount(np.repeat(row, many) * len(self.words) + self.mark[entry], np.repeat(span, many) * self.weight[entry],
                          len(likely) * len(self.words)).reshape(len(likely), -1)
        near = np.flatnonzero(out.max(1) >= least)
        result[likely[near]] = out[near] / np.sqrt(_own(codes[likely[near]]))[:, None]
        return result

    def alike(self, words: list[str], inside: bool = False) -> np.ndarray:
        """Square of the normalised kernel of each word with each landmark, 0 where it is below ACTIVE; with ``inside`` the
        largest over the word's windows."""
        out = np.zeros((len(words), len(self.words)), np.float32)
        if not len(words) or not self.words:
            return out
        size = np.array([len(w) for w in words])
        for length in np.unique(size[size >= LENGTH]).tolist():
            rows = np.flatnonzero(size == length)
            for n, starts in windows(length) if inside else [(length, [0])]:
                together = max(1, CHUNK // len(starts))
                for low in range(0, len(rows), together):
                    part = rows[low:low + together]
                    codes = _codes([words[r] for r in part], 0)
                    for some in np.array_split(np.array(starts), len(starts) // CHUNK + 1):
                        seen = codes[:, some[:, None] + np.arange(n)]
                        value = self.values(seen.reshape(-1, n)).reshape(len(part), len(some), -1).max(1)
                        out[part] = np.maximum(out[part], value)
        out[out < ACTIVE] = 0
        return out * out


@dataclass
class Machine:
    landmarks: list[str]
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bias: float = 0.0
    slope: float = 1.0
    shift: float = -2.0
    kept: int = KEPT_WORDS

    def __post_init__(self):
        self.marks = Landmarks(self.landmarks)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}  # what is known of a white-space separated word, as in ``learn``
        self.rows: dict[str, int] = {}  # a cleaned word's row in ``table``, -1 if it is alike to no landmark
        self.table = np.zeros((0, len(self.landmarks)), np.float32)
        _own_values.clear()

    def learn(self, raw: Iterable[str]) -> None:
        """Kernel values of new words. ``known`` packs the row in ``table`` plus one, whether the word ends a sentence, and how many
        letters spelled out one by one it may be part of (0 to 3)."""
        pairs = [(w, clean(w)) for w in raw]
        fresh = list({c for _, c in pairs}.difference(self.rows))
        values = self.marks.alike(fresh, inside=True)
        active = np.flatnonzero(values.any(1))
        place = np.full(len(fresh), -1)
        place[active] = len(self.table) + np.arange(len(active))
        self.table = np.vstack([self.table, values[active]])
        self.rows.update(zip(fresh, place.tolist()))
        for w, c in pairs:
            letters = min(3, (len(w) + 1) // 2) if len(w) == 1 or LETTERS.fullmatch(w) else 0
            self.known[w] = self.rows[c] + 1 << 3 | (w[-1] in ".!?") << 2 | letters

    def features(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """Per text, one row for each sentence with a word like a landmark: its words' largest values."""
        claim_memory(self)
        texts, more = iter(texts), True
        while more:
            batch, size, more = [], 0, False
            for text in texts:
                batch.append((text or "").lower())
                size += len(batch[-1])
                if size > BATCH_CHARS:
                    more = True
                    break
            if len(self.known) > self.kept:
                self.forget()
            yield from self._batch(batch)

    def _facts(self, words: list[str]) -> np.ndarray:
        fresh = set(words).difference(self.known)
        if fresh:
            self.learn(fresh)
        return np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))

    def _batch(self, batch: list[str]) -> Iterator[np.ndarray]:
        words, breaks, bounds = [], [], [0]
        for low in batch:
            for line in low.split("\n"):
                words += line.split()
                breaks.append(len(words))
            bounds.append(len(words))
        facts = self._facts(words)
        # a sentence ends with a line, or with a word that ends in a full stop or the like
        opens = np.zeros(len(words) + 1, np.int64)
        opens[breaks] = 1
        opens[1:] |= facts >> 2 & 1
        sentence = np.cumsum(opens[:-1])
        bounds = np.array(bounds)
        owner = np.repeat(np.arange(len(batch)), np.diff(bounds))
        # texts where neighbouring words may spell out a third letter
        run = np.cumsum(np.r_[True, (facts[1:] & 3 == 0) | (facts[:-1] & 3 == 0) | (owner[1:] != owner[:-1])]) if len(words) else facts
        letters = np.bincount(run, facts & 3, minlength=1) if len(words) else np.zeros(1)
        texts = np.unique(owner[letters[run] >= 3]) if len(words) else owner
        more = [(t, w) for t in texts.tolist() for w in spelled(batch[t])]
        row = (facts >> 3) - 1
        at = np.flatnonzero(row >= 0)
        row, sentence, owner = row[at], sentence[at], owner[at]
        if more:
            # letters spelled out one by one are a sentence of their own
            extra = (self._facts([w for _, w in more]) >> 3) - 1
            kept = np.flatnonzero(extra >= 0)
            row = np.r_[row, extra[kept]]
            sentence = np.r_[sentence, len(words) + 1 + kept]
            owner = np.r_[owner, np.array([t for t, _ in more])[kept]]
        order = np.lexsort((sentence, owner))
        row, sentence, owner = row[order], sentence[order], owner[order]
        first = np.flatnonzero(np.r_[True, (sentence[1:] != sentence[:-1]) | (owner[1:] != owner[:-1])]) if len(row) else row
        per = np.bincount(owner[first], minlength=len(batch))
        done = 0
        # a text's sentences together, about ACTIVE_WORDS words at once
        text_end = np.cumsum(per)
        word_end = np.r_[first, len(row)]
        low = 0
        while low < len(batch):
            high = low + 1
            while high < len(batch) and word_end[text_end[high]] - word_end[done] <= ACTIVE_WORDS:
                high += 1
            stop = int(text_end[high - 1])
            if stop > done:
                part = slice(int(word_end[done]), int(word_end[stop]))
                rows = np.maximum.reduceat(self.table[row[part]], first[done:stop] - word_end[done])
            else:
                rows = np.zeros((0, len(self.landmarks)), np.float32)
            yield from np.split(rows, text_end[low:high - 1] - done)
            low, done = high, stop

    def margin(self, rows: np.ndarray) -> float:
        """Decision value of a document: its worst sentence, and never less than a sentence without matches."""
        return max(self.bias, float((rows @ self.weights).max()) + self.bias) if len(rows) else self.bias

    def score(self, texts: Iterable[str | None]) -> Iterator[float]:
        for rows in self.features(texts):
            yield float(1 / (1 + np.exp(-np.clip(self.slope * self.margin(rows) + self.shift, -50, 50))))


def spelled(text: str) -> list[str]:
    """Words whose letters are spelled out one by one."""
    return [OTHER.sub("", m) for m in SPELLED.findall(text)]


def tokens(text: str) -> list[str]:
    """White-space separated words, and those spelled out."""
    return text.split() + spelled(text)


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-4) -> tuple[np.ndarray, float]:
    """Linear machine with squared hinge loss, by Newton steps."""
    n, m = x.shape
    z = np.hstack([x, np.ones((n, 1))])
    w = np.zeros(m + 1)
    ridge = penalty * np.eye(m + 1)
    ridge[m, m] = 1e-9
    for _ in range(30):
        short = 1 - y * (z @ w) > 0
        zs, ws = z[short], weight[short]
        new = np.linalg.solve(ridge * weight.sum() + (zs * ws[:, None]).T @ zs, zs.T @ (ws * y[short]))
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w[:m], float(w[m])


def _platt(margin: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic that turns margins into chances, by damped Newton steps."""
    a, b = 1.0, 0.0
    goal = np.where(y > 0, 0.999, 0.001)
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -50, 50)))
        g = np.array([(weight * (p - goal) * margin).sum() + 1e-3 * a, (weight * (p - goal)).sum()])
        s = weight * p * (1 - p)
        h = np.array([[(s * margin * margin).sum() + 1e-3, (s * margin).sum()], [(s * margin).sum(), s.sum() + 1e-6]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = a - step[0], b - step[1]
    return max(a, 1e-3), b


def _draw(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str,
          train_docs: int) -> tuple[DataFrame, tuple[float, float]]:
    """(text, y) of about ``train_docs`` labelled documents of each class, drawn by a hash of the key, and how many
    documents each drawn toxic and other one stands for."""
    own = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(
        F.max(F.col(label).cast("int")).alias("y"))
    sizes = {r[0]: r[1] for r in own.groupBy("y").count().collect()}
    toxic, clean = (min(1.0, train_docs / max(1, sizes.get(y, 0))) for y in (1, 0))
    rate = F.when(F.col("y") > 0, toxic).otherwise(clean)
    drawn = own.where(F.pmod(F.xxhash64("_k", F.lit(7)), F.lit(1 << 20)) < rate * (1 << 20))
    # the drawn keys are about twice train_docs, whatever the tables' sizes
    return docs.select(F.col(key).alias("_k"), F.col(text).alias("text")).join(F.broadcast(drawn), "_k").select(
        "text", "y"), (1 / toxic, 1 / clean)


def _candidates(sample: DataFrame, n: int) -> list[str]:
    """Word beginnings that mark toxic documents, most telling first, from document frequencies.

    At least CERTAIN of the (class-balanced) documents with such a beginning must be toxic.
    """
    @F.arrow_udf("array<string>")
    def beginnings(texts: pa.Array) -> pa.Array:
        return pa.array([list({START + w[:k] for w in {OTHER.sub("", t) for t in set(tokens((x.as_py() or "").lower()))}
                               for k in STEMS if len(w) >= k}) for x in texts], pa.list_(pa.string()))
    count = {r[0]: r[1] for r in sample.groupBy("y").count().collect()}
    pos, neg = max(1, count.get(1, 0)), max(1, count.get(0, 0))
    seen = (sample.select(F.explode(beginnings("text")).alias("w"), "y").groupBy("w")
            .agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("q")))
    share, toxic, clean = (F.col("p") + F.col("q")) / (pos + neg), F.col("p") / pos, F.col("q") / neg
    z = (toxic - clean) / F.sqrt(share * (1 - share) * (1 / pos + 1 / neg) + F.lit(1e-12))
    telling = (seen.where((F.col("p") >= 3) & (toxic >= CERTAIN * (toxic + clean))).withColumn("z", z).where(F.col("z") > LEAST_Z)
               .orderBy(F.desc(F.round("z", 9)), F.desc(F.length("w")), "w").limit(n))
    return [r.w for r in telling.collect()]


def _spread(words: list[str], n: int, apart: float = 0.6) -> list[str]:
    """The first n words that are not nearly alike to one already taken."""
    close, chosen = Landmarks(words).alike(words), []
    for at in range(len(words)):
        if len(chosen) < n and (not chosen or close[at, chosen].max() < apart):
            chosen.append(at)
    return [words[at] for at in chosen]


def _sentences(sample: DataFrame, machine: Broadcast, release: bool = False) -> DataFrame:
    """(y, x): per document its distinct sentences as rows of features, the last one without any match."""
    def bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(machine.value.landmarks)
        try:
            for batch in batches:
                found = [np.vstack([np.unique(np.round(r, 4), axis=0), np.zeros((1, width), np.float32)]) for r in
                         machine.value.features(map(pa.StringScalar.as_py, batch.column(0)))]
                yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([x.astype(np.float32).tobytes() for x in found], pa.binary())],
                                                 ["y", "x"])
        finally:
            if release:
                release_memory()
    return sample.mapInArrow(bags, "y int, x binary")


def _instances(bags: DataFrame, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, y, 1 / rows of the document): of a toxic document the most telling sentence and at most CLOSE_ROWS of those close to
    a landmark, the closest first; of others the worst sentence. Chosen where the sentences are."""
    width = len(first)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, share, rows = [], [], []
            for sign, x in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = np.frombuffer(x.as_py(), np.float32).reshape(-1, width)
                worst = int((own @ first).argmax())
                chosen = {worst}
                if sign > 0:
                    near = own.max(1)
                    chosen |= {int(r) for r in np.argsort(-near, kind="stable")[:CLOSE_ROWS] if near[r] >= CLOSE}
                y += [sign] * len(chosen)
                share += [1 / len(chosen)] * len(chosen)
                rows += [own[r].tobytes() for r in sorted(chosen)]
            yield pa.RecordBatch.from_arrays([pa.array(y, pa.int32()), pa.array(share, pa.float64()), pa.array(rows, pa.binary())],
                                             ["y", "share", "x"])
    found = bags.mapInArrow(choose, "y int, share double, x binary").toArrow()
    x = np.frombuffer(b"".join(found.column("x").to_pylist()), np.float32).reshape(-1, width).astype(np.float64)
    return x, np.where(found.column("y").to_numpy() > 0, 1, -1), found.column("share").to_numpy()


def _margins(bags: DataFrame, machine: Machine) -> tuple[np.ndarray, np.ndarray]:
    """(y, decision value) of each document."""
    weights, bias = machine.weights, machine.bias

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [float((np.frombuffer(x.as_py(), np.float32).reshape(-1, len(weights)) @ weights).max()) + bias
                      for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.float64())], ["y", "margin"])
    found = bags.mapInArrow(decide, "y int, margin double").toArrow()
    return np.where(found.column("y").to_numpy() > 0, 1, -1), found.column("margin").to_numpy()


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
        train_docs: int = TRAIN_DOCS, landmarks: int = LANDMARKS, release: bool = False) -> Machine:
    """Landmarks and machine from a bounded sample of the labelled documents.

    The sample's sentences stay on the executors; what comes to the driver are the instances of a round, at most
    CLOSE_ROWS + 1 of a document. With ``release`` workers remember FEW_WORDS, here and in ``score``, and forget them at the end of a task.
    """
    kept = FEW_WORDS if release else KEPT_WORDS
    bound_batches(docs.sparkSession)
    sample, true_weight = _draw(docs, labels, key, text, label, train_docs)
    with reused(sample) as sample:
        marks = _spread(_candidates(sample, CANDIDATES), landmarks)
        # without START they are found inside other words
        machine = Machine(marks + [w for w in dict.fromkeys(m[1:] for m in marks) if len(w) > LENGTH], kept=kept)
        if not machine.landmarks:
            return Machine([])
        m = len(machine.landmarks)
        close = machine.marks.alike(machine.landmarks).astype(np.float64)
        close = (close + close.T) / 2 + 1e-3 * np.eye(m)
        value, vector = np.linalg.eigh(close)
        root = (vector / np.sqrt(np.maximum(value, 1e-3))) @ vector.T
        first = np.ones(m)
        with reused(_sentences(sample, docs.sparkSession.sparkContext.broadcast(machine), release)) as bags:
            bags.count()  # stored first: else each task of the first round has two workers, which stay with what they remember
            for _ in range(ROUNDS):
                x, y, share = _instances(bags, first)
                if len(set(y.tolist())) < 2:
                    return machine
                total = np.where(y > 0, share[y > 0].sum(), share[y < 0].sum())  # documents of the class
                docs_drawn = share.sum()
                w, machine.bias = _svm(x @ root, y, share / total * docs_drawn / 2)
                first = machine.weights = root @ w
            y, margin = _margins(bags, machine)
    machine.slope, machine.shift = _platt(margin, y, np.where(y > 0, *true_weight))
    return machine


def score(text: Column, machine: Broadcast, release: bool = False) -> Column:
    """Chance that a text is toxic, 0 to 1. With ``release`` a worker forgets its words at the end of a task, for the sake of
    later stages, and a task learns them anew."""
    @F.arrow_udf("double")
    def chance(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for texts in batches:
                yield pa.array(machine.value.score(map(pa.StringScalar.as_py, texts)), pa.float64())
        finally:
            if release:
                release_memory()
    return chance(text)
