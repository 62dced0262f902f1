"""Language identification as mixture inference.

Each word of a document is drawn from one of several languages; a language gives a word the product of
its character trigrams' probabilities. Expectation-maximisation finds a document's language shares, and
the set of languages grows only while the log-likelihood gains more than half a log of the word count per
share (a penalised likelihood). The trigram model is fitted on a bounded sample of labelled rows.

A null text or one without letters is ``und`` with score 0 and no languages. Rows without a label are not
learned from. Without any labelled row, everything is ``und``. Ties go to the alphabetically first language.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .words import bound_batches, claim_memory, release_memory

TRAIN_DOCS = 3000  # expected number of labelled documents learned from, per language
BUCKETS = 1 << 17  # trigrams are hashed into so many cells per language
SMOOTHING = 0.05
ROUNDS = 12
KEPT_WORDS = 300_000  # word likelihoods a worker remembers; beyond, it begins again
BATCH_CHARS = 500_000
LETTERS = re.compile(r"[^\W\d_]+")
OPEN, CLOSE = "\x01", "\x02"


def trigrams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each trigram of the padded words, position where each word's trigrams begin)."""
    codes = np.frombuffer((OPEN + (CLOSE + OPEN).join(words) + CLOSE).encode("utf-32-le"), np.uint32)
    centre = np.flatnonzero(codes[1:-1] > 2) + 1
    h = codes[centre - 1] * np.uint32(0x9E3779B1) ^ codes[centre] * np.uint32(0x85EBCA77) ^ (
        codes[centre + 1] * np.uint32(0xC2B2AE3D))
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    starts = np.searchsorted(centre, np.flatnonzero(codes == 1))
    return ((h >> np.uint32(12)) % np.uint32(BUCKETS)).astype(np.int64), starts


@dataclass
class Model:
    languages: list[str]
    logs: np.ndarray  # bucket x language: log probability of a trigram
    known: dict[str, int] = field(default_factory=dict)
    rows: list[np.ndarray] = field(default_factory=list)
    filled: int = 0

    def learn(self, words: list[str]) -> None:
        """Log-likelihood of new words under every language."""
        buckets, starts = trigrams(words)
        found = np.add.reduceat(self.logs[buckets], starts, axis=0)
        if not self.rows or self.filled + len(words) > len(self.rows[0]):
            grown = np.zeros((2 * (self.filled + len(words)), len(self.languages)), np.float32)
            if self.rows:
                grown[:self.filled] = self.rows[0][:self.filled]
            self.rows = [grown]
        self.rows[0][self.filled:self.filled + len(words)] = found
        self.known.update(zip(words, range(self.filled, self.filled + len(words))))
        self.filled += len(words)

    def forget(self) -> None:
        self.known, self.rows, self.filled = {}, [], 0


def _fit_shares(like: np.ndarray, times: np.ndarray, doc: np.ndarray, starts: np.ndarray,
                allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shares, log-likelihood up to the words' common factor) of each document over its allowed languages."""
    total = np.add.reduceat(times, starts)
    share = allowed / allowed.sum(1, keepdims=True)
    for _ in range(ROUNDS):
        joint = like * share[doc]
        joint *= (times / np.maximum(joint.sum(1), 1e-300))[:, None]
        share = np.add.reduceat(joint, starts, axis=0) / total[:, None]
    mixed = np.maximum((like * share[doc]).sum(1), 1e-300)
    return share, np.add.reduceat(times * np.log(mixed), starts)


def infer(logs: np.ndarray, times: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shares, confidence) per document from the log-likelihoods of its words and their counts.

    Every document has at least one word. Confidence is the posterior of the best single language where one
    language is selected, else 1.
    """
    n, languages = len(starts), logs.shape[1]
    doc = np.repeat(np.arange(n), np.diff(np.append(starts, len(times))))
    top = logs.max(1, keepdims=True)
    relative = np.maximum(logs - top, -600)
    like = np.exp(relative)
    words = np.add.reduceat(times, starts)
    single = np.add.reduceat(relative * times[:, None], starts, axis=0)
    first = single.argmax(1)
    best = single.max(1)
    spread = np.exp(single - best[:, None])
    confidence = 1 / spread.sum(1)
    shares = np.zeros((n, languages))
    shares[np.arange(n), first] = 1
    if languages == 1:
        return shares, confidence
    whole, bound = _fit_shares(like, times, doc, starts, np.ones((n, languages)))
    penalty = 0.5 * np.log(np.maximum(words, 2))
    order = whole.copy()
    order[np.arange(n), first] = 2
    order = np.argsort(-order, axis=1, kind="stable")
    open_docs = np.flatnonzero(bound - best > penalty)  # the full mixture bounds what any set can gain
    for k in range(2, languages + 1):
        if not len(open_docs):
            break
        allowed = np.zeros((len(open_docs), languages))
        np.put_along_axis(allowed, order[open_docs][:, :k], 1, 1)
        chosen = np.isin(doc, open_docs)
        part = np.cumsum(np.append(0, np.bincount(doc[chosen], minlength=n)[open_docs]))
        own = np.repeat(np.arange(len(open_docs)), np.diff(part))
        share, fit = _fit_shares(like[chosen], times[chosen], own, part[:-1], allowed)
        better = fit - best[open_docs] > penalty[open_docs]
        shares[open_docs[better]] = share[better]
        confidence[open_docs[better]] = 1
        best[open_docs[better]] = fit[better]
        open_docs = open_docs[better]
    return shares, confidence


def _answers(model: Model, texts: Iterator[str | None]) -> Iterator[dict]:
    def settled(rows: list[Counter]) -> Iterator[dict]:
        if len(model.known) > KEPT_WORDS:
            model.forget()
        new = set().union(*rows).difference(model.known)
        if new:
            model.learn(list(new))
        some = [i for i, r in enumerate(rows) if r]
        out = [{"lang_pred": "und", "score": 0.0, "languages": []} for _ in rows]
        if some:
            lengths = [len(rows[i]) for i in some]
            at = np.fromiter((model.known[w] for i in some for w in rows[i]), np.int64, sum(lengths))
            times = np.fromiter((c for i in some for c in rows[i].values()), np.float64, sum(lengths))
            starts = np.cumsum([0, *lengths[:-1]])
            shares, confidence = infer(model.rows[0][at].astype(np.float64), times, starts)
            lead = shares.argmax(1)
            for j, i in enumerate(some):
                present = [(model.languages[l], float(shares[j, l])) for l in np.flatnonzero(shares[j] > 0)]
                out[i] = {"lang_pred": model.languages[lead[j]],
                          "score": float(min(1.0, shares[j, lead[j]] * confidence[j])),
                          "languages": [{"lang": l, "share": s} for l, s in sorted(present, key=lambda x: -x[1])]}
        yield from out

    claim_memory(model)
    rows, size = [], 0
    for text in texts:
        rows.append(Counter(LETTERS.findall(text.lower())) if text and model.languages else Counter())
        size += len(text or "")
        if size > BATCH_CHARS:
            yield from settled(rows)
            rows, size = [], 0
    yield from settled(rows)


def fit(docs: DataFrame, text: str = "text", label: str = "lang", key: str = "doc_id",
        train_docs: int = TRAIN_DOCS) -> Model:
    """Trigram probabilities of each label value from about ``train_docs`` documents of it, drawn by a hash of the key."""
    labelled = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in labelled.groupBy(label).count().collect()}  # one row per language
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32))
    keep = F.create_map(*[F.lit(x) for l in languages for x in (l, min(1.0, train_docs / sizes[l]))])[F.col(label)]
    drawn = labelled.where(F.pmod(F.xxhash64(F.col(key)), F.lit(1 << 20)) < keep * (1 << 20))
    bound_batches(docs.sparkSession)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {}
        for batch in batches:
            for l, t in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = LETTERS.findall(t.as_py().lower())
                if words:
                    found = np.bincount(trigrams(words)[0], minlength=BUCKETS)
                    sums[l] = sums[l] + found if l in sums else found
        for l, c in sums.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([l] * len(at)), pa.array(at), pa.array(c[at])], ["l", "b", "n"])

    found = (drawn.select(label, text).mapInArrow(counts, "l string, b bigint, n bigint")
             .groupBy("l", "b").agg(F.sum("n").alias("n")).toPandas())  # at most BUCKETS rows per language
    table = np.zeros((BUCKETS, len(languages)))
    table[found["b"].to_numpy(np.int64), np.searchsorted(languages, found["l"].to_numpy(str))] = found["n"]
    logs = np.log((table + SMOOTHING) / (table.sum(0) + SMOOTHING * BUCKETS))
    return Model(languages, logs.astype(np.float32))


def predict(text: Column, model: Broadcast) -> Column:
    """struct<lang_pred, score, languages: array<struct<lang, share>> by falling share> of a text column."""
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64()), ("languages", pa.list_(
        pa.struct([("lang", pa.string()), ("share", pa.float64())])))])

    @F.arrow_udf("struct<lang_pred:string,score:double,languages:array<struct<lang:string,share:double>>>")
    def answer(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for texts in batches:
                yield pa.array(_answers(model.value, map(pa.StringScalar.as_py, texts)), kind)
        finally:
            release_memory()  # a worker that idles in later stages keeps nothing
    return answer(text)
