"""Near-duplicate documents by an LSH forest over MinHash signatures.

A text is its set of distinct word shingles. Equal sets are one class from the start. A class's signature
holds ``HASHES`` minima; each tree of the forest reads them in its own order. Classes that agree on the first
``depth`` values of a tree form a region. Small regions compare all members; in a dense region a class
meets the neighbours with the longest common prefix, deeper in the tree's order. Sketches of one bit per
minimum sort out chance meetings; what is left links classes into families. Every pair of a
family is then decided on the full shingle sets, in blocks of bounded size by matrix products, so a family
found by few meetings loses no link. Components of the confirmed links name the groups.

Null and empty texts and texts without words have no shingles and stay alone. Rows with the same key or the same
text each get a row. Without rows, the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulith.operators.clustering import connected_components
from tabulith.runtime import write_out

from .words import SMALL_BATCH, SPACE, bound_batches, hash_words, mix, release_memory, separator_table, shingles

HASHES = 120
DEPTH = 6  # values that define a region
DEEPER = 2  # further values that order a region's members
TREES = 40  # at similarity 0.8 a pair misses all regions with chance 5e-6, at 0.85 with 6e-9
SMALL_REGION = 12  # up to so many members, all pairs of a region meet
NEIGHBOURS = 4  # in larger regions, the following members met in the tree's order
SLACK = 4.5  # standard deviations by which a sketch may fall short of the threshold
BLOCK_DOCS = 192  # members of a family compared at once
FILTER_BITS = 24  # bit table of the classes in families: 2 MB whatever their number

_rng = np.random.default_rng(7)
_MASKS = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)
_FACTORS = _rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
# the first trees share no value within a round of HASHES / DEPTH trees; each further round reorders all values
_ORDERS = np.concatenate([_rng.permutation(HASHES) for _ in range(-(-TREES * DEPTH // HASHES))])[:TREES * DEPTH].reshape(
    TREES, DEPTH)
_NEXT = (_ORDERS[:, :DEEPER] + HASHES // 2) % HASHES


def signature(items: np.ndarray) -> np.ndarray:
    """Minimum of every hash function over a set of 64-bit shingle hashes."""
    low = np.full(HASHES, np.uint32(0xFFFFFFFF))
    short = (items >> np.uint64(32)).astype(np.uint32)
    for part in np.array_split(short, len(short) // 2048 + 1):
        low = np.minimum(low, ((part[:, None] ^ _MASKS) * _FACTORS).min(0))
    return low


def sketch(low: np.ndarray) -> np.ndarray:
    """One bit per minimum, as two 64-bit numbers (signatures in rows)."""
    bits = ((low * np.uint32(0x9E3779B1)) >> np.uint32(31)).astype(np.uint8)
    bits = np.pad(bits, ((0, 0), (0, 128 - HASHES)))
    return np.packbits(bits, axis=1).view(np.int64)


def _sets(texts: pa.Array, size: int, separators: list[int]) -> Iterator[np.ndarray]:
    words, bounds = hash_words(texts, separator_table(separators))
    for a, b in zip(bounds[:-1], bounds[1:]):
        yield shingles(words[a:b], size)


def shingle_classes(docs: DataFrame, key: str, text: str, size: int, separators: list[int]) -> DataFrame:
    """(key, n, h1, h2, low): size, 128-bit fingerprint and signature of each text's shingle set."""
    @F.arrow_udf("struct<n:bigint,h1:bigint,h2:bigint,low:binary>")
    def digest(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        try:
            for texts in batches:
                n, h1, h2, low = [], [], [], []
                for s in _sets(texts, size, separators):
                    n.append(len(s))
                    h1.append(int(np.bitwise_xor.reduce(s).astype(np.int64)) if len(s) else 0)
                    h2.append(int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).astype(np.int64)) if len(s) else 0)
                    low.append(signature(s).tobytes() if len(s) else None)
                yield pa.StructArray.from_arrays([pa.array(n, pa.int64()), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                                                  pa.array(low, pa.binary())], names=["n", "h1", "h2", "low"])
        finally:
            release_memory()
    bound_batches(docs.sparkSession, SMALL_BATCH)
    return docs.select(F.col(key).cast("bigint").alias("key"), digest(F.col(text)).alias("d")).select("key", "d.*")


def _tree_rows(classes: DataFrame) -> DataFrame:
    """(region, path, rep, s1, s2): each class once per tree, with its region and its place in the tree's order."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            reps = batch.column(0).to_numpy()
            low = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(-1, HASHES)
            bits = sketch(low)
            for t in range(TREES):
                region = np.full(len(low), t, np.uint64)
                for v in low[:, _ORDERS[t]].T:
                    region = mix(region * np.uint64(0x9E3779B97F4A7C15) + v)
                after = low[:, _NEXT[t]].astype(np.uint64)
                path = (after[:, 0] << np.uint64(31)) ^ after[:, 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(region.view(np.int64)), pa.array(path.view(np.int64)), pa.array(reps),
                     pa.array(bits[:, 0].copy()), pa.array(bits[:, 1].copy())], ["region", "path", "rep", "s1", "s2"])
    bound_batches(classes.sparkSession)
    return classes.select("rep", "low").mapInArrow(rows, "region bigint, path bigint, rep bigint, s1 bigint, s2 bigint")


def _meetings(trees: DataFrame, threshold: float) -> DataFrame:
    """(src, dst): classes that meet in a region, connected by neighbours whose sketches could belong to similar sets."""
    same = (1 + threshold) / 2
    allowed = HASHES - HASHES * same + SLACK * np.sqrt(HASHES * same * (1 - same))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            cols = [batch.column(i).to_numpy() for i in range(5)]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            # the last rows may go on in the next batch; of a region, no more than its last members are still needed
            keep = min(max(SMALL_REGION, NEIGHBOURS), len(cols[0]))
            tail = cols[0][-keep:] == cols[0][-1]
            held = [c[-keep:][tail] for c in cols]
            yield from _near(cols, allowed)

    bound_batches(trees.sparkSession)
    # ordered by region and path: a large region is spread over partitions, and its members stay in the tree's order
    ordered = trees.repartitionByRange("region", "path").sortWithinPartitions("region", "path", "rep")
    return ordered.mapInArrow(pairs, "src bigint, dst bigint").distinct()


def _near(cols: list[np.ndarray], allowed: float) -> Iterator[pa.RecordBatch]:
    """Neighbours that pass the sketch connect members of a region; each meets the smallest it is connected with.

    That keeps what neighbour pairs would connect, and most trees name the same few pairs of a dense family.
    """
    region, rep = cols[0], cols[2]
    s1, s2 = cols[3].view(np.uint64), cols[4].view(np.uint64)
    n = len(region)
    if n < 2:
        return
    fresh = np.flatnonzero(np.concatenate([[True], region[1:] != region[:-1]]))
    size = np.repeat(np.diff(np.append(fresh, n)), np.diff(np.append(fresh, n)))
    left, right = [], []
    for step in range(1, min(SMALL_REGION, n)):
        i = np.flatnonzero(region[step:] == region[:-step])
        if step > NEIGHBOURS:
            i = i[size[i] <= SMALL_REGION]
        apart = np.bitwise_count(s1[i] ^ s1[i + step]) + np.bitwise_count(s2[i] ^ s2[i + step])
        left.append(i[apart <= allowed])
        right.append(left[-1] + step)
    root = _roots(n, np.concatenate(left), np.concatenate(right))
    least = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, root, rep)
    low = least[root]
    both = np.unique(np.stack([low[low != rep], rep[low != rep]], 1), axis=0)
    if len(both):
        yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy())], ["src", "dst"])


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """One member of its connected set for each of n places, by hooking and halving paths."""
    root = np.arange(n)
    while True:
        a, b = root[left], root[right]
        open_ = a != b
        if not open_.any():
            return root
        left, right = left[open_], right[open_]
        np.minimum.at(root, np.maximum(a, b)[open_], np.minimum(a, b)[open_])
        while (root[root] != root).any():
            root = root[root]


def _starred(pairs: DataFrame) -> DataFrame:
    """The same connections with fewer pairs: the smaller classes that one class meets (40 at most) are tied to the smallest."""
    met = pairs.groupBy("dst").agg(F.min("src").alias("low"), F.collect_set("src").alias("others"))
    ties = met.select(F.col("low").alias("src"), F.explode(F.array_union(F.array("dst"), F.col("others"))).alias("dst"))
    return ties.where("src <> dst").distinct()


def _slots(values: np.ndarray) -> np.ndarray:
    return (mix(values.view(np.uint64)) & np.uint64((1 << FILTER_BITS) - 1)).astype(np.int64)


def _bit_table(keys: DataFrame) -> np.ndarray:
    """The keys as a bit table of fixed size; each task's share is merged before it comes back."""
    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            table[_slots(batch.column(0).to_numpy())] = True
        words = np.packbits(table, bitorder="little").view(np.int64)
        at = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(words[at])], ["at", "w"])
    out = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    merged = keys.mapInArrow(share, "at bigint, w bigint").groupBy("at").agg(F.bit_or("w").alias("w")).toArrow()
    out[merged.column("at").to_numpy()] = merged.column("w").to_numpy()
    return out.view(np.uint8)


def _family_sets(docs: DataFrame, members: DataFrame, key: str, text: str, size: int, separators: list[int]) -> DataFrame:
    """(rep, items): full shingle sets of the classes in families, read again from the documents."""
    table = docs.sparkSession.sparkContext.broadcast(_bit_table(members.select("node")))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = _slots(batch.column(0).to_numpy())
            inside = (table.value[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            batch = batch.filter(pa.array(inside))
            for low in range(0, batch.num_rows, 256):
                part = batch.slice(low, 256)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([s.tobytes() for s in _sets(part.column(1), size, separators)], pa.binary())],
                    ["rep", "items"])
    bound_batches(docs.sparkSession)
    own = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).alias("text")).where("key is not null")
    return own.mapInArrow(sets, "rep bigint, items binary").where(F.length("items") > 0)


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all pairs: products of the sets' incidence over shingles that occur twice or more."""
    lengths = np.fromiter(map(len, sets), np.int64, len(sets))
    item, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), lengths)
    order = np.argsort(item, kind="stable")
    item, owner = item[order], owner[order]
    column = np.cumsum(np.concatenate([[0], item[1:] != item[:-1]]))
    shared = np.bincount(column) > 1
    place = np.cumsum(shared) - 1
    keep = shared[column]
    column, owner = place[column[keep]], owner[keep]
    total = np.zeros((len(sets), len(sets)), np.float32)
    width = max(64, (4 << 20) // (4 * len(sets)))
    for low in range(0, int(place[-1]) + 1 if len(place) else 0, width):
        a, b = np.searchsorted(column, [low, low + width])
        grid = np.zeros((len(sets), width), np.float32)
        grid[owner[a:b], column[a:b] - low] = 1
        total += grid @ grid.T
    return total


def _links(reps: np.ndarray, sets: list[np.ndarray], threshold: tuple[int, int]) -> list[tuple[int, int]]:
    """Links that join the members of one block as all confirmed pairs would (a spanning forest of them)."""
    if len(sets) < 2:
        return []
    both = np.rint(_overlaps(sets)).astype(np.int64)
    lengths = np.fromiter(map(len, sets), np.int64, len(sets))
    union = lengths[:, None] + lengths[None, :] - both
    similar = threshold[1] * both >= threshold[0] * union
    np.fill_diagonal(similar, False)
    found, waiting = [], np.ones(len(sets), bool)
    for i in range(len(sets)):
        if not waiting[i]:
            continue
        waiting[i] = False
        front = [i]
        while front:
            at = front.pop()
            new = np.flatnonzero(similar[at] & waiting)
            waiting[new] = False
            found += [(int(reps[at]), int(reps[j])) for j in new]
            front += new.tolist()
    return found


def _confirmed(members: DataFrame, sets: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """(src, dst): links of each family, decided on full sets block by block.

    A family of more than BLOCK_DOCS members is dealt into blocks by a hash, and every two blocks meet.
    """
    sizes = members.groupBy("component").agg(F.count("*").alias("m"))
    blocks = F.ceil(F.col("m") / BLOCK_DOCS).cast("int")
    placed = (members.join(sizes, "component").withColumn("blocks", blocks)
              .withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(
        F.least(o, F.col("own")).alias("i"), F.greatest(o, F.col("own")).alias("j")))
    # with two or more blocks, a block meets itself within each of its pairs with others
    meets = F.when(F.col("blocks") == 1, meets).otherwise(F.filter(meets, lambda x: x["i"] != x["j"]))
    dealt = (placed.join(sets, placed["node"] == sets["rep"]).select("component", "rep", "items", F.inline(meets)))

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, reps, sets_ = None, [], []

        def settled():
            found = _links(np.array(reps), sets_, threshold)
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()),
                                               pa.array([b for _, b in found], pa.int64())], ["src", "dst"])
        for batch in batches:
            for c, i, j, rep, items in zip(*(batch.column(k).to_pylist() for k in range(5))):
                if (c, i, j) != group:
                    if len(reps) > 1:
                        yield settled()
                    group, reps, sets_ = (c, i, j), [], []
                if not reps or reps[-1] != rep:  # repeated rows of one document
                    reps.append(rep)
                    sets_.append(np.frombuffer(items, np.uint64))
        if len(reps) > 1:
            yield settled()

    bound_batches(members.sparkSession)
    grouped = (dealt.select("component", "i", "j", "rep", "items").repartition("component", "i", "j")
               .sortWithinPartitions("component", "i", "j", "rep"))
    return grouped.mapInArrow(links, "src bigint, dst bigint")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5,
                    threshold: tuple[int, int] = (80, 100), separators: list[int] = SPACE) -> DataFrame:
    """(key, n_shingles, component_id) of each row; documents whose shingle sets have an intersection of at least
    threshold[0] / threshold[1] of their union are linked, and a component is named by its smallest key.

    Keys are integers; a row with a null key stays alone and takes no part.
    """
    digests = write_out(shingle_classes(docs, key, text, size, separators), "shingle-classes")
    linked = digests.where("n > 0 and key is not null")
    classes = write_out(linked.groupBy("h1", "h2", "n").agg(F.min("key").alias("rep"), F.first("low").alias("low")),
                        "distinct-sets")
    pairs = write_out(_starred(_meetings(_tree_rows(classes), threshold[0] / threshold[1])), "meetings")
    nodes = pairs.select(F.col("src").alias("node")).union(pairs.select("dst")).distinct()
    members = write_out(connected_components(nodes, pairs), "families")
    links = write_out(_confirmed(members, _family_sets(docs, members, key, text, size, separators), threshold), "links")
    ends = links.select(F.col("src").alias("node")).union(links.select("dst")).distinct()
    groups = connected_components(ends, links)
    names = classes.select("h1", "h2", "n", "rep").join(groups, F.col("rep") == F.col("node"), "left").select(
        "h1", "h2", "n", F.coalesce("component", "rep").alias("component_id"))
    out = digests.select("key", "n", "h1", "h2").join(names, ["h1", "h2", "n"], "left")
    alone = F.col("key").isNull() | (F.col("n") == 0)
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"),
                      F.when(alone, F.col("key")).otherwise(F.col("component_id")).alias("component_id"))
