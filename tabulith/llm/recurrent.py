"""Language-model scores of a gated recurrent network with a class-factored output.

A word's probability is that of its class, given by the network from all words before it, times its share of the
class. The most frequent words are classes of their own; all others share classes by their last two bytes. Shares come
from counts over all training documents; each class keeps the mass of its words seen once for words
never seen. The network is fitted by truncated backpropagation on all training documents, in replicas whose number
grows with the words and whose weights are averaged after each round; each round takes the next part of every replica's documents, so that
all are learned from once (or ``passes`` times). Scoring carries its state through whole documents.

Counts of frequent words, of which there is a fixed number, travel to the tasks; rarer words of a document
are joined with the count table. A null or empty text is its end token alone. Repeated rows each get a row. Without training
documents every word is unknown.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulith.runtime import cut_lineage, write_out

from .words import SPACE, bound_batches, hash_spans, separator_table, text_runs

REPLICAS = 6  # at least; a replica learns from about REPLICA_TOKENS words
REPLICA_TOKENS = 4_000_000
RUN_TOKENS = 1 << 21  # words laid out in lanes at once in training
FAN_IN = 32  # replicas' weights averaged in one task
TRAIN_ROUNDS = 3
OWN_CLASS = 40  # words with a class of their own
SUFFIX_CLASSES = 47
END = OWN_CLASS + SUFFIX_CLASSES  # class of the end token
CLASSES = END + 1
HIDDEN = 24
HEAD_WORDS = 400_000  # words whose counts travel to every task, 18 bytes each
WINDOW, LANES, RATE = 24, 96, 0.01
OUT_STEPS = 4  # steps whose output layer is computed at once in training
SCORE_LANES = 256
SCORE_STEPS = 8
SCORE_BYTES = 8 << 20  # text scored at once


def suffix_class(ends: np.ndarray) -> np.ndarray:
    """Class by a word's last two bytes."""
    mixed = (ends.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(12)
    return OWN_CLASS + (mixed % np.uint32(SUFFIX_CLASSES)).astype(np.int64)


@dataclass
class Words:
    """What tasks know of the vocabulary: frequent words by hash, class totals, and the corpus totals."""
    hashes: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    class_total: np.ndarray  # known mass and unseen mass of each class
    unseen: np.ndarray
    tokens: int
    distinct: int

    def look_up(self, words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(class, count) of each word; the count is -1 where the word is not among the frequent ones."""
        if not len(self.hashes):
            return suffix_class(ends), np.full(len(words), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        there = self.hashes[at] == words
        return np.where(there, self.classes[at], suffix_class(ends)), np.where(there, self.counts[at], -1)


@dataclass
class Net:
    """Gated recurrent unit over word classes; gates are update, reset, candidate."""
    embed: np.ndarray  # class x 3 hidden
    recur: np.ndarray  # hidden x 3 hidden
    out: np.ndarray  # hidden x class
    bias: np.ndarray  # class

    @staticmethod
    def fresh(bias: np.ndarray) -> Net:
        rng = np.random.default_rng(11)
        return Net(rng.normal(0, 0.2, (CLASSES, 3 * HIDDEN)).astype(np.float32),
                   rng.normal(0, 0.2, (HIDDEN, 3 * HIDDEN)).astype(np.float32),
                   rng.normal(0, 0.1, (HIDDEN, CLASSES)).astype(np.float32), bias.astype(np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([x.ravel() for x in self.arrays()])

    def arrays(self) -> list[np.ndarray]:
        return [self.embed, self.recur, self.out, self.bias]

    @staticmethod
    def from_flat(flat: np.ndarray) -> Net:
        shapes = [(CLASSES, 3 * HIDDEN), (HIDDEN, 3 * HIDDEN), (HIDDEN, CLASSES), (CLASSES,)]
        cuts = np.cumsum([int(np.prod(s)) for s in shapes])[:-1]
        return Net(*[x.reshape(s).astype(np.float32) for x, s in zip(np.split(flat, cuts), shapes)])

    def step(self, h: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, ...]:
        x, g = self.embed[classes], h @ self.recur
        gates = 1 / (1 + np.exp(-(x[:, :2 * HIDDEN] + g[:, :2 * HIDDEN])))
        z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
        n = np.tanh(x[:, 2 * HIDDEN:] + r * g[:, 2 * HIDDEN:])
        return n + z * (h - n), z, r, n, g[:, 2 * HIDDEN:]

    def small_logits(self) -> bool:
        """No state, whose numbers lie between -1 and 1, can give a logit whose exponential leaves the range of floats."""
        return float((np.abs(self.out).sum(0) + np.abs(self.bias)).max()) < 60

    def log_classes(self, h: np.ndarray) -> np.ndarray:
        logits = h @ self.out + self.bias
        logits -= logits.max(-1, keepdims=True)
        return logits - np.log(np.exp(logits).sum(-1, keepdims=True))

    def log_class(self, states: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Natural log-probability of one class after each state; states are time x hidden x lane, classes time x lane."""
        logits = np.matmul(self.out.T, states)
        logits += self.bias[:, None]
        if not self.small_logits():
            logits -= logits.max(1, keepdims=True)
        own = np.take_along_axis(logits, classes[:, None], 1)[:, 0]
        return own - np.log(np.exp(logits, out=logits).sum(1))


class Backward:
    """Gradients of one network over windows of time x lane arrays, in buffers that are made once.

    Arrays are hidden x lane, so that gates are contiguous slices and every step works on a few kilobytes in place.
    """

    def __init__(self, net: Net, lanes: int):
        self.net, self.lanes = net, lanes
        shape = (WINDOW, HIDDEN, lanes)
        self.past, self.n, self.gn, self.states, self.to_state, self.work, self.gate = (np.empty(shape, np.float32) for _ in range(7))
        self.zr, self.slopes = (np.empty((WINDOW, 2 * HIDDEN, lanes), np.float32) for _ in range(2))
        self.to_x, self.to_g = (np.empty((WINDOW, 3 * HIDDEN, lanes), np.float32) for _ in range(2))
        self.x, self.g = (np.empty((3 * HIDDEN, lanes), np.float32) for _ in range(2))
        self.later, self.back = (np.empty((HIDDEN, lanes), np.float32) for _ in range(2))
        self.wrong = np.empty((OUT_STEPS, CLASSES, lanes), np.float32)

    def __call__(self, h: np.ndarray, inputs: np.ndarray, targets: np.ndarray, fresh: np.ndarray, weight: np.ndarray):
        """(gradients, last state) of one window of time x lane arrays; the state before it, hidden x lane, is taken as given."""
        net, steps = self.net, len(inputs)
        resets, keep = fresh.any(1), (~fresh).astype(np.float32)
        self._forward(h, inputs, keep, resets)
        d_out, d_bias = self._outputs(targets, weight, steps)
        past, n, gn, work = (x[:steps] for x in (self.past, self.n, self.gn, self.work))
        z, r = self.zr[:steps, :HIDDEN], self.zr[:steps, HIDDEN:]
        # what the gradients of update, candidate and reset are per unit of the state's: the same for all steps at once
        to_z, to_r, to_n = self.slopes[:steps, :HIDDEN], self.slopes[:steps, HIDDEN:], np.multiply(n, n, out=self.gate[:steps])
        np.subtract(1, z, out=work)
        np.subtract(past, n, out=to_z)
        to_z *= z
        to_z *= work
        np.subtract(1, to_n, out=to_n)
        to_n *= work
        np.subtract(1, r, out=to_r)
        to_r *= r
        to_r *= gn
        later, back, recur = self.later, self.back, net.recur
        later[:] = 0
        for t in range(steps - 1, -1, -1):
            later += self.to_state[t]
            dx, dg = self.to_x[t], self.to_g[t]
            dn = dx[2 * HIDDEN:]
            np.multiply(to_z[t], later, out=dx[:HIDDEN])
            np.multiply(to_n[t], later, out=dn)
            np.multiply(to_r[t], dn, out=dx[HIDDEN:2 * HIDDEN])
            dg[:2 * HIDDEN] = dx[:2 * HIDDEN]
            np.multiply(dn, r[t], out=dg[2 * HIDDEN:])
            later *= z[t]
            np.matmul(recur, dg, out=back)
            later += back
            if resets[t]:
                later *= keep[t]
        d_recur = np.matmul(past, self.to_g[:steps].transpose(0, 2, 1)).sum(0)
        order = np.argsort(inputs.astype(np.uint8), axis=None, kind="stable")
        classes, first = np.unique(inputs.ravel()[order], return_index=True)
        flat = self.to_x[:steps].transpose(1, 0, 2).reshape(3 * HIDDEN, -1)
        d_embed = np.zeros_like(net.embed)
        d_embed[classes] = np.add.reduceat(np.take(flat, order, 1), first, axis=1).T
        return [d_embed, d_recur, d_out, d_bias], self.states[steps - 1].copy()

    def _forward(self, h: np.ndarray, inputs: np.ndarray, keep: np.ndarray, resets: np.ndarray) -> None:
        net, x, g = self.net, self.x, self.g
        embed, recur = np.ascontiguousarray(net.embed.T), np.ascontiguousarray(net.recur.T)
        for t in range(len(inputs)):
            past, zr, n = self.past[t], self.zr[t], self.n[t]
            past[:] = h
            if resets[t]:
                past *= keep[t]
            np.matmul(recur, past, out=g)
            np.take(embed, inputs[t], 1, out=x, mode="clip")
            self.gn[t] = g[2 * HIDDEN:]
            np.add(x[:2 * HIDDEN], g[:2 * HIDDEN], out=zr)
            np.negative(zr, out=zr)
            np.exp(zr, out=zr)
            zr += 1
            np.reciprocal(zr, out=zr)
            np.multiply(zr[HIDDEN:], self.gn[t], out=n)
            n += x[2 * HIDDEN:]
            np.tanh(n, out=n)
            h = self.states[t]
            np.subtract(past, n, out=h)
            h *= zr[:HIDDEN]
            h += n

    def _outputs(self, targets: np.ndarray, weight: np.ndarray, steps: int) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the output layer; what goes back to the states is kept in ``to_state``."""
        net = self.net
        d_out, d_bias = np.zeros_like(net.out), np.zeros_like(net.bias)
        into, bias = np.ascontiguousarray(net.out.T), net.bias[:, None]
        small = net.small_logits()
        scale = (weight / max(1.0, float(weight.sum()))).astype(np.float32)
        for low in range(0, steps, OUT_STEPS):
            part = slice(low, min(low + OUT_STEPS, steps))
            states, share = self.states[part], scale[part]
            wrong = np.matmul(into, states, out=self.wrong[:len(states)])
            wrong += bias
            if not small:
                wrong -= wrong.max(1, keepdims=True)
            np.exp(wrong, out=wrong)
            wrong *= (share / wrong.sum(1))[:, None]
            right = targets[part][:, None]
            np.put_along_axis(wrong, right, np.take_along_axis(wrong, right, 1) - share[:, None], 1)
            d_out += np.matmul(states, wrong.transpose(0, 2, 1)).sum(0)
            d_bias += wrong.sum(2).sum(0)
            np.matmul(net.out, wrong, out=self.to_state[part])
        return d_out, d_bias


def _lanes(sequences: list[np.ndarray], lanes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(classes, first token of a document, document or -1) as time x lane arrays: documents fill the lanes evenly."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    lanes = max(1, min(lanes, len(sequences)))
    filled, members = np.zeros(lanes, np.int64), [[] for _ in range(lanes)]
    for i in order:
        lane = int(filled.argmin())
        members[lane].append(i)
        filled[lane] += len(sequences[i])
    height = int(filled.max(initial=0))
    classes, first = np.full((height, lanes), END, np.int64), np.zeros((height, lanes), bool)
    owner = np.full((height, lanes), -1, np.int64)
    for lane, own in enumerate(members):
        at = 0
        for i in own:
            n = len(sequences[i])
            classes[at:at + n, lane], owner[at:at + n, lane] = sequences[i], i
            first[at, lane] = True
            at += n
        first[at:, lane] = True
    return classes, first, owner


def train(net: Net, runs: Iterable[list[np.ndarray]], rate: float) -> int:
    """One pass of truncated backpropagation (Adam) over runs of documents given as class sequences with their end.

    Changes ``net`` and returns the number of words learned from.
    """
    mean = [np.zeros_like(x) for x in net.arrays()]
    square = [np.zeros_like(x) for x in net.arrays()]
    k = tokens = 0
    for sequences in runs:
        # a document far longer than the others leaves room for few lanes beside it
        size = sum(map(len, sequences))
        classes, first, owner = _lanes(sequences, min(LANES, 1 + 4 * size // max(map(len, sequences))))
        tokens += size
        inputs = np.vstack([np.full((1, classes.shape[1]), END), classes[:-1]])
        inputs[first] = END
        real = (owner >= 0).astype(np.float32)
        h = np.zeros((HIDDEN, classes.shape[1]), np.float32)
        gradient = Backward(net, classes.shape[1])
        for low in range(0, len(classes), WINDOW):
            k += 1
            part = slice(low, low + WINDOW)
            grads, h = gradient(h, inputs[part], classes[part], first[part], real[part])
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            for x, g, m, v in zip(net.arrays(), grads, mean, square):
                g = g * min(1.0, 1.0 / max(norm, 1e-9))
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                x -= (rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-6)).astype(np.float32)
    return tokens


def log_likelihood(net: Net, sequences: list[np.ndarray]) -> np.ndarray:
    """Natural log-likelihood of the class sequences, each a whole document with its end."""
    out = np.zeros(len(sequences))
    classes, first, owner = _lanes(sequences, SCORE_LANES)
    filled = (owner >= 0).sum(0)
    order = np.argsort(-filled, kind="stable")  # lanes that end first stand last and are left out from there on
    classes, first, owner, filled = classes[:, order], first[:, order], owner[:, order], filled[order]
    embed, recur = np.ascontiguousarray(net.embed.T), np.ascontiguousarray(net.recur.T)
    # hidden x lane, as in ``Backward``
    h = np.zeros((HIDDEN, classes.shape[1]), np.float32)
    before = np.full(classes.shape[1], END)
    for low in range(0, len(classes), SCORE_STEPS):
        live = int((filled > low).sum())
        part = slice(low, min(low + SCORE_STEPS, len(classes)))
        states = np.empty((part.stop - low, HIDDEN, live), np.float32)
        x, g = np.empty((3 * HIDDEN, live), np.float32), np.empty((3 * HIDDEN, live), np.float32)
        gates, n = x[:2 * HIDDEN], g[2 * HIDDEN:]
        h, before = h[:, :live], before[:live]
        for t, new in enumerate(states, low):
            fresh = first[t, :live]
            if fresh.any():
                h, before = h * ~fresh, np.where(fresh, END, before)
            np.matmul(recur, h, out=g)
            np.take(embed, before, 1, out=x, mode="clip")
            gates += g[:2 * HIDDEN]
            np.negative(gates, out=gates)
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            n *= gates[HIDDEN:]
            n += x[2 * HIDDEN:]
            np.tanh(n, out=n)
            np.subtract(h, n, out=new)
            new *= gates[:HIDDEN]
            new += n
            h, before = new, classes[t, :live]
        logs = net.log_class(states, classes[part, :live])
        mine = owner[part, :live] >= 0
        out += np.bincount(owner[part, :live][mine], logs[mine].astype(np.float64), minlength=len(sequences))
    return out


def count_words(docs: DataFrame, text: str) -> DataFrame:
    """(h, cls, c): hash, suffix class and count of every distinct word, summed over all rows."""
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space = separator_table(SPACE)
        for batch in batches:
            found = hash_spans(batch.column(0), space)
            if len(found.hashes):
                distinct, at, n = np.unique(found.hashes, return_index=True, return_counts=True)
                classes = suffix_class(found.ends()[at]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(distinct.view(np.int64)), pa.array(classes),
                                                  pa.array(n)], ["h", "cls", "c"])
    bound_batches(docs.sparkSession)
    return docs.select(text).mapInArrow(counts, "h bigint, cls int, c bigint").groupBy("h", "cls").agg(F.sum("c").alias("c"))


def _vocabulary(counted: DataFrame, training_docs: int) -> Words:
    """The frequent words and all totals; what comes to the driver has a fixed size."""
    octave = F.floor(F.log2("c") * 8).cast("int")
    sizes = counted.groupBy(octave.alias("o"), "cls").agg(
        F.count("*").alias("n"), F.sum("c").alias("c"), F.sum((F.col("c") == 1).cast("int")).alias("once")).toPandas()
    total, distinct = int(sizes["c"].sum()) + training_docs, int(sizes["n"].sum()) + (training_docs > 0)
    by_octave = sizes.groupby("o")["n"].sum().sort_index(ascending=False).cumsum()
    fitting = by_octave[by_octave <= HEAD_WORDS]
    least = int(fitting.index.min()) if len(fitting) else 1 << 30
    head = counted.where(octave >= least).toArrow()
    h = head.column("h").to_numpy().view(np.uint64)
    c = head.column("c").to_numpy().astype(np.int64)
    cls = head.column("cls").to_numpy().astype(np.int64)
    top = np.lexsort((h, -c))[:OWN_CLASS]
    class_total = np.zeros(CLASSES)
    class_total[sizes["cls"].to_numpy(np.int64)] = 0
    np.add.at(class_total, sizes["cls"].to_numpy(np.int64), sizes["c"].to_numpy(float))
    np.subtract.at(class_total, cls[top], c[top].astype(float))
    unseen = np.zeros(CLASSES)
    np.add.at(unseen, sizes["cls"].to_numpy(np.int64), sizes["once"].to_numpy(float))
    unseen[OWN_CLASS:END] = np.maximum(unseen[OWN_CLASS:END], 1)
    cls[top] = np.arange(len(top))
    class_total[:len(top)] = c[top]
    class_total[END] = training_docs
    order = np.argsort(h)
    return Words(h[order], c[order], cls[order].astype(np.int16), class_total, unseen, total, distinct)


def _sequences(words: Words, texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(classes with the end, counts, hashes) of each text's words."""
    found = hash_spans(texts, separator_table(SPACE))
    classes, counts = words.look_up(found.hashes, found.ends())
    for a, b in zip(found.bounds[:-1], found.bounds[1:]):
        yield np.append(classes[a:b], END), counts[a:b], found.hashes[a:b]


def _coded(training: DataFrame, key: str, text: str, words) -> DataFrame:
    """(deal, classes): a hash of each training document, and its class sequence with the end, a byte a word."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = 0
            for texts in text_runs(batch.column(1), SCORE_BYTES):
                coded = [s[0].astype(np.uint8).tobytes() for s in _sequences(words.value, texts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(done, len(texts)), pa.array(coded, pa.binary())],
                                                 ["deal", "classes"])
                done += len(texts)
    bound_batches(training.sparkSession)
    return training.select(F.xxhash64(key, text).alias("deal"), F.col(text)).mapInArrow(rows, "deal bigint, classes binary")


def _runs(batches: Iterable[pa.RecordBatch], column: int) -> Iterator[list[np.ndarray]]:
    """Lists of class sequences of about RUN_TOKENS words together."""
    run, size = [], 0
    for batch in batches:
        for coded in batch.column(column):
            run.append(np.frombuffer(coded.as_py(), np.uint8).astype(np.int64))
            size += len(run[-1])
            if size >= RUN_TOKENS:
                yield run
                run, size = [], 0
    if run:
        yield run


_WEIGHTS = "part int, n bigint, w array<double>"


def _weights(part: int, n: int, w: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([n]), pa.array([w.tolist()], pa.list_(pa.float64()))],
                                      ["part", "n", "w"])


def _average(rows: pa.Table) -> tuple[int, np.ndarray]:
    """(words, weights) of replicas together, summed in the order of their numbers."""
    rows = rows.sort_by("part")
    n = rows.column("n").to_numpy()
    return int(n.sum()), np.average(np.array(rows.column("w").to_pylist()), axis=0, weights=n)


def _averaged(found: DataFrame, replicas: int) -> tuple[int, np.ndarray] | None:
    """Average of all replicas, FAN_IN to a task until so few are left for the driver; None without any."""
    def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = list(batches)
        if sum(b.num_rows for b in own):
            yield _weights(TaskContext.get().partitionId(), *_average(pa.Table.from_batches(own)))
    while replicas > FAN_IN:
        replicas = -(-replicas // FAN_IN)
        found = found.repartition(replicas, "part").mapInArrow(average, _WEIGHTS)
    rows = found.toArrow()
    return _average(rows) if rows.num_rows else None


def fit_network(training: DataFrame, key: str, text: str, words, rounds: int = TRAIN_ROUNDS, passes: int = 1) -> tuple[Net, int]:
    """(network, words learned from in all rounds): weights averaged over replicas after each round.

    Documents are dealt to replicas, and within each to rounds: over all rounds every document is learned from ``passes`` times,
    at most once a round.
    """
    spark = training.sparkSession
    mass = words.value.class_total + words.value.unseen
    net, tokens = Net.fresh(np.log(np.maximum(mass, 1) / np.maximum(mass, 1).sum())), 0
    replicas = max(REPLICAS, -(-words.value.tokens // REPLICA_TOKENS))
    dealt = cut_lineage(_coded(training, key, text, words).repartition(replicas, "deal").sortWithinPartitions("deal"))
    turn = F.pmod(F.xxhash64("deal"), F.lit(rounds))
    for k in range(rounds):
        shared = spark.sparkContext.broadcast(net.flat())
        part = dealt.where(F.pmod(turn - k, F.lit(rounds)) < passes)

        def replica(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = Net.from_flat(shared.value.copy())
            n = train(own, _runs(batches, 1), RATE / (1 + k))
            if n:
                yield _weights(TaskContext.get().partitionId(), n, own.flat())
        found = _averaged(part.mapInArrow(replica, _WEIGHTS), replicas)
        if found:
            tokens, net = tokens + found[0], Net.from_flat(found[1])
    return net, tokens


_SCORED = ("key bigint, uid bigint, n_tokens bigint, n_known bigint, base double, score double, "
           "rare array<struct<h:bigint,cls:int,n:int>>")


def _score_rows(docs: DataFrame, key: str, text: str, words, net) -> DataFrame:
    """Per document all but the rare words' counts: sums over frequent words, class log-likelihood, rare words."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, network = words.value, Net.from_flat(net.value)
        lowest = np.log10(known.tokens + known.distinct + 1)
        within = np.log10(np.maximum(known.class_total + known.unseen, 1))
        uid = TaskContext.get().partitionId() << 33
        for batch in batches:
            done = 0
            for texts in text_runs(batch.column(1), SCORE_BYTES):
                part = batch.slice(done, len(texts))
                done += len(texts)
                found = list(_sequences(known, texts))
                classes = log_likelihood(network, [f[0] for f in found]) / np.log(10)
                out = {c: [] for c in ("n_tokens", "n_known", "base", "score", "rare")}
                for (cls, count, hashes), whole in zip(found, classes.tolist()):
                    head = count >= 0
                    c = count[head]
                    end = int(known.class_total[END])
                    out["n_tokens"].append(len(cls))
                    out["n_known"].append(len(c) + (end > 0))
                    out["base"].append(float(np.log10(c + 1.0).sum() + np.log10(end + 1.0) - len(cls) * lowest))
                    out["score"].append(whole + float(np.log10(np.maximum(c, 1)).sum() - within[cls[:-1]].sum()))
                    rare, at, n = np.unique(hashes[~head], return_index=True, return_counts=True)
                    of = cls[:-1][~head][at]
                    out["rare"].append([{"h": h, "cls": k, "n": m} for h, k, m in zip(
                        rare.view(np.int64).tolist(), of.tolist(), n.tolist())])
                ids = np.arange(uid, uid + len(found))
                uid += len(found)
                rare = pa.array(out["rare"], pa.list_(pa.struct([("h", pa.int64()), ("cls", pa.int32()), ("n", pa.int32())])))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(ids), pa.array(out["n_tokens"], pa.int64()), pa.array(out["n_known"], pa.int64()),
                     pa.array(out["base"], pa.float64()), pa.array(out["score"], pa.float64()), rare],
                    ["key", "uid", "n_tokens", "n_known", "base", "score", "rare"])
    bound_batches(docs.sparkSession)
    return docs.select(F.col(key).cast("bigint").alias("key"), F.col(text)).mapInArrow(rows, _SCORED)


def score(docs: DataFrame, training: DataFrame, key: str = "doc_id", text: str = "text", passes: int = 1) -> DataFrame:
    """(key, n_tokens, n_known, train_tokens, base_score, score) of each row of ``docs``: log10 probabilities of whole
    texts by word frequencies and by the network, both from ``training``."""
    spark = docs.sparkSession
    n_docs = training.count()
    counted = write_out(count_words(training, text), "word-counts")
    words = _vocabulary(counted, n_docs)
    shared = spark.sparkContext.broadcast(words)
    net = spark.sparkContext.broadcast(fit_network(training, key, text, shared, passes=passes)[0].flat())
    rows = write_out(_score_rows(docs, key, text, shared, net), "scores")
    unseen = F.array(*[F.lit(float(max(x, 1))) for x in words.unseen])
    rare = rows.select("uid", F.inline("rare")).join(counted.select("h", "c"), "h", "left")
    c = F.coalesce("c", F.lit(0))
    sums = rare.groupBy("uid").agg(
        F.sum(F.when(c > 0, F.col("n"))).alias("more"), F.sum(F.col("n") * F.log10(c + 1)).alias("base_more"),
        F.sum(F.col("n") * F.log10(F.when(c > 0, c.cast("double")).otherwise(F.get(unseen, F.col("cls"))))).alias("score_more"))
    zero = F.lit(0)
    return rows.drop("rare").join(sums, "uid", "left").select(
        F.col("key").alias(key), "n_tokens", (F.col("n_known") + F.coalesce("more", zero)).alias("n_known"),
        F.lit(words.tokens).cast("bigint").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_more", zero)).alias("base_score"),
        (F.col("score") + F.coalesce("score_more", zero)).alias("score"))
