"""Joins the analytics need: by id, by lookup, to given centers, within a radius, k nearest."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalars import as_column, euclidean
from ..runtime import cut_lineage
from .ordering import hash_key



def attach_by_id(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Bring the columns of the row with the same id; Spark picks the strategy from run-time sizes."""
    return left.join(right, key, how)


def column_concat(df: DataFrame, **columns: Column) -> DataFrame:
    """Set new columns beside the old ones: same rows, so expressions and no join."""
    return df.withColumns(columns)


def lookup(df: DataFrame, column: str, table: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Map a column through a table of any size; NULL where the table has no entry."""
    pairs = table.select(as_column(key).alias("_key"), as_column(value).alias(out))
    return df.join(pairs, as_column(column) == F.col("_key"), "left").drop("_key")


def cross_grid(spark: SparkSession, values: Mapping[str, Sequence]) -> DataFrame:
    """Every combination of short parameter lists, numbered from 1 with the last list varying fastest."""
    grid = spark.range(1).select()
    for name, options in values.items():
        grid = grid.select("*", F.explode(F.array(*[F.lit(v) for v in options])).alias(name))
    trial = F.lit(0)
    for name, options in values.items():
        trial = trial * len(options) + F.array_position(F.array(*[F.lit(v) for v in options]), F.col(name)) - 1
    return grid.withColumn("trial", (trial + 1).cast("int")).select("trial", *values)


# ---- distances to a given list of centers -----------------------------------

def center_structs(features: Sequence[str], centers: Sequence[Sequence[float]]) -> Column:
    """Array of (distance, center) for every center: an expression, so no join."""
    return F.array(*[F.struct(euclidean(features, [float(v) for v in c]).alias("distance"), F.lit(i).alias("center"))
                     for i, c in enumerate(centers)])


def center_distances(df: DataFrame, keys: Sequence[str], features: Sequence[str],
                     centers: Sequence[Sequence[float]]) -> DataFrame:
    """One row per point and center with their distance."""
    return df.select(*[as_column(k) for k in keys], F.inline(center_structs(features, centers)))


def distance_join(df: DataFrame, features: Sequence[str], centers: Sequence[Sequence[float]],
                  cluster: str = "cluster", distance: str = "distance") -> DataFrame:
    """Nearest center of each point (the lower number on ties) and its distance."""
    nearest = F.array_min(center_structs(features, centers))
    return (df.withColumn("_nearest", nearest).withColumn(cluster, F.col("_nearest.center"))
            .withColumn(distance, F.col("_nearest.distance")).drop("_nearest"))


# ---- within a radius --------------------------------------------------------

def _cell(features: Sequence[str], width: float) -> list[Column]:
    return [F.floor(as_column(f).cast("double") / F.lit(width)).cast("long") for f in features]


def cell_codes(features: Sequence[str], eps: float) -> list[Column]:
    """One whole number per feature: the cell of a point, in which any two points lie within ``eps`` of each other."""
    # a hair under eps / sqrt(d), so that rounding cannot push a diagonal over eps
    return _cell(features, eps / math.sqrt(len(features)) * (1.0 - 1e-9))


def fine_cells(points: DataFrame, features: Sequence[str], eps: float) -> DataFrame:
    """Assign each point to a cell in which any two points lie within ``eps`` of each other."""
    return points.withColumn("cell", F.to_json(F.array(*cell_codes(features, eps))))


def coarse_keys(low: Sequence[Column], high: Sequence[Column], eps: float, side: float,
                axes: int = 3) -> tuple[Column, Column]:
    """(home key, probe keys) of boxes at most ``side`` wide, on at most three axes of cells ``eps`` wide.

    A box lives at the key of its low corner and probes every key where the low corner of
    a box within eps of it may lie, so each pair of close boxes meets exactly once.
    """
    used = range(min(axes, len(low)))
    pad = eps * (1.0 + 1e-9)
    home = F.array(*[F.floor(low[i] / eps).cast("long") for i in used])
    spans = [F.sequence(F.floor((low[i] - (pad + side)) / eps).cast("long"), F.floor((high[i] + pad) / eps).cast("long"))
             for i in used]
    probes = F.transform(spans[0], lambda a: F.array(a))
    for span in spans[1:]:
        probes = _extended(probes, span)
    return home, probes


def _extended(heads: Column, tails: Column) -> Column:
    """Every array of ``heads`` with every element of ``tails`` appended."""
    return F.flatten(F.transform(heads, lambda head: F.transform(tails, lambda a: F.concat(head, F.array(a)))))


def radius_join(points: DataFrame, key: str, features: Sequence[str], eps: float) -> DataFrame:
    """Every pair (src, dst, distance) with src < dst and distance <= eps.

    For 20 or so neighbours per row; a dense cloud has quadratically many pairs by nature.

    Points are cut into cells of width eps on up to three axes; a point meets only the
    points of its own and the neighbouring cells, and the exact distance decides. The
    pairs are the result asked for; ``neighbor_counts`` counts without forming them.
    """
    axes = list(features[:3])
    base = points.select(as_column(key).alias("id"), *[as_column(f).cast("double").alias(f"_x{i}")
                                                       for i, f in enumerate(features)])
    names = [f"_x{i}" for i, _ in enumerate(features)]
    width = eps * (1.0 + 1e-9)
    home = _cell(names[:len(axes)], width)
    left = base.withColumn("_cell", F.array(*home))
    right = base.select(F.col("id").alias("_id"), *[F.col(n).alias(f"y{n}") for n in names],
                        F.explode(F.array(*[F.array(*[h + F.lit(s) for h, s in zip(home, shift)])
                                            for shift in product((-1, 0, 1), repeat=len(axes))])).alias("_probe"))
    distance = euclidean(names, [f"y{n}" for n in names])
    # always shuffled: the size Spark reads off compressed files is far below that of the rows, so it would broadcast millions
    return (left.hint("merge").join(right, (F.col("_cell") == F.col("_probe")) & (F.col("id") < F.col("_id")))
            .select(F.col("id").alias("src"), F.col("_id").alias("dst"), distance.alias("distance"))
            .where(F.col("distance") <= F.lit(float(eps))))


def cell_table(celled: DataFrame, features: Sequence[str]) -> DataFrame:
    """Row count and bounding box of every fine cell."""
    return celled.groupBy("cell").agg(
        F.sum("weight").alias("n"),
        *[F.min(f).alias(f"lo{i}") for i, f in enumerate(features)],
        *[F.max(f).alias(f"hi{i}") for i, f in enumerate(features)])


def _box_gap(d: int, a: str, b: str) -> Column:
    """Least possible squared distance between two boxes."""
    total = F.lit(0.0)
    for i in range(d):
        gap = F.greatest(F.col(f"{b}lo{i}") - F.col(f"{a}hi{i}"), F.col(f"{a}lo{i}") - F.col(f"{b}hi{i}"), F.lit(0.0))
        total = total + gap * gap
    return total


def _box_reach(d: int, a: str, b: str) -> Column:
    """Largest possible squared distance between two boxes."""
    total = F.lit(0.0)
    for i in range(d):
        reach = F.greatest(F.abs(F.col(f"{b}hi{i}") - F.col(f"{a}lo{i}")), F.abs(F.col(f"{a}hi{i}") - F.col(f"{b}lo{i}")))
        total = total + reach * reach
    return total


def near_cells(cells: DataFrame, d: int, eps: float) -> DataFrame:
    """Ordered pairs of different cells that may hold points within eps; ``sure`` if all their points are.

    Boxes meet through coarse cells on at most three axes, then through their exact gap.
    """
    low = [F.col(f"lo{i}") for i in range(d)]
    high = [F.col(f"hi{i}") for i in range(d)]
    home, probe = coarse_keys(low, high, eps, eps / math.sqrt(d))
    stats = ["cell", "n", *[f"lo{i}" for i in range(d)], *[f"hi{i}" for i in range(d)]]
    left = cells.select(*[F.col(c).alias(f"a_{c}") for c in stats], home.alias("_k"))
    right = cells.select(*[F.col(c).alias(f"b_{c}") for c in stats], F.explode(probe).alias("_p"))
    met = left.join(right, (F.col("_k") == F.col("_p")) & (F.col("a_cell") != F.col("b_cell")))
    slack = 1e-9 * eps * eps
    met = met.where(_box_gap(d, "a_", "b_") <= F.lit(eps * eps + slack))
    sure = _box_reach(d, "a_", "b_") <= F.lit(eps * eps - slack)
    return met.select("a_cell", "b_cell", "a_n", "b_n", sure.alias("sure"))


def collapse_copies(points: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """Distinct positions with their number of rows and smallest id. Copies cost nothing from here on.

    Rows that lack a coordinate have no position and are left out.
    """
    known = points.dropna(subset=list(features))
    return known.groupBy(*[as_column(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)]).agg(
        F.count("*").alias("weight"), F.min(as_column(key)).alias("id"))


def neighbor_counts(points: DataFrame, key: str, features: Sequence[str], eps: float,
                    at_least: int | None = None) -> DataFrame:
    """Per distinct position: x0.., id, weight, cell, and ``neighbors`` = rows within eps, itself included.

    Cells whose boxes lie wholly within eps of each other add their counts without looking
    at points; only positions of cells at the edge of the radius are compared one by one.
    With ``at_least``, a cell that already holds that many rows is left at its own count,
    which is enough to know that its points are core points; otherwise counts are exact.
    """
    d = len(features)
    names = [f"x{i}" for i in range(d)]
    celled = fine_cells(collapse_copies(points, key, features), names, eps)
    cells = cell_table(celled, names)
    pairs = near_cells(cells, d, eps)
    if at_least is not None:
        pairs = pairs.where(F.col("a_n") < at_least)
    whole = pairs.where("sure").groupBy(F.col("a_cell").alias("cell")).agg(F.sum("b_n").alias("_sure"))
    base = (celled.join(cells.select("cell", F.col("n").alias("_own")), "cell")
            .join(whole, "cell", "left"))
    edge = pairs.where(~F.col("sure")).select(F.col("a_cell").alias("cell"), "b_cell")
    other = celled.select(F.col("cell").alias("_oc"), F.col("weight").alias("_w"), *[F.col(n).alias(f"o{n}") for n in names])
    close = (celled.select("cell", *names).join(edge, "cell").join(other, F.col("b_cell") == F.col("_oc"))
             .where(euclidean(names, [f"o{n}" for n in names]) <= F.lit(float(eps)))
             .groupBy(*names).agg(F.sum("_w").alias("_close")))
    total = F.col("_own") + F.coalesce("_sure", F.lit(0)) + F.coalesce("_close", F.lit(0))
    return base.join(close, names, "left").select("id", "weight", "cell", *names, total.cast("long").alias("neighbors"))


# ---- k nearest neighbours ---------------------------------------------------

QUERY_GROUPS = 16       # a vector is sent to a candidate side at most this often, while a group fits a block
BLOCK_BYTES = 64 << 20  # vectors of one side of a block, four bytes a number where they came so
QUERY_STEP, CANDIDATE_STEP = 256, 4096  # rows per numpy step


def _pivot_distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (vectors**2).sum(1)[:, None] + (pivots**2).sum(1)[None, :] - 2.0 * vectors @ pivots.T
    return np.sqrt(np.maximum(square, 0.0))


def collapsed(points: DataFrame, key: str, vector: str, k: int) -> tuple[DataFrame, DataFrame]:
    """Rows with the code ``g`` of their vector, and one row per distinct vector with its k + 1 smallest ids (stored)."""
    rows = points.select(as_column(key).alias("src"), F.transform(as_column(vector), lambda v: v.cast("double")).alias("v"))
    rows = rows.withColumn("g", F.md5(F.to_json("v")))
    smallest = Window.partitionBy("g").orderBy("src")
    # row_number() <= k + 1 is applied before the shuffle too, so a huge group of copies stays small
    first = rows.withColumn("_r", F.row_number().over(smallest)).where(F.col("_r") <= k + 1)
    members = first.groupBy("g").agg(F.sort_array(F.collect_list("src")).alias("ids"), F.first("v").alias("v"))
    members = cut_lineage(members.withColumn("low", F.col("ids")[0]))
    return rows, members


def expanded(rows: DataFrame, members: DataFrame, best: DataFrame, k: int) -> DataFrame:
    """The k nearest other rows of every row, from the k + 1 nearest vectors ``h`` of every vector ``g`` (itself included)."""
    # every neighbour vector offers its k + 1 smallest ids; k of them suffice for any one row
    offered = (best.join(members.select(F.col("g").alias("h"), "ids"), "h")
               .select("g", F.explode("ids").alias("dst"), "distance")
               .withColumn("_o", F.row_number().over(Window.partitionBy("g").orderBy("distance", "dst")))
               .where(F.col("_o") <= k + 1)
               .groupBy("g").agg(F.sort_array(F.collect_list(F.struct("distance", "dst"))).alias("near")))
    own = rows.select("src", "g").join(offered, "g")
    picked = F.slice(F.filter("near", lambda e: e["dst"] != F.col("src")), 1, k)
    return own.select("src", F.posexplode(picked).alias("_p", "e")).select(
        "src", F.col("e.dst").alias("dst"), F.col("e.distance").alias("distance"), (F.col("_p") + 1).alias("rank"))


def _nearest(a: np.ndarray, b: np.ndarray, take: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Places in ``b`` and distances of the ``take`` rows of ``b`` nearest to each row of ``a``, ties by place.

    Candidates come in steps; a step adds only what is no farther than the ``take``-th found so far.
    """
    take = min(take, len(b))
    places, distances = [], []
    size = (b * b).sum(1)
    for lo in range(0, len(a), QUERY_STEP):
        rows = a[lo:lo + QUERY_STEP]
        slack = 1e-9 * ((rows * rows).sum(1) + size.max())
        cut = np.full(len(rows), np.inf)
        who, what, value = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)
        found, held = [], 0
        for at in range(0, len(b), CANDIDATE_STEP):
            rough = size[at:at + CANDIDATE_STEP] - 2.0 * (rows @ b[at:at + CANDIDATE_STEP].T)  # less the row's own square
            if not at and take < rough.shape[1]:
                cut = np.partition(rough, take - 1, axis=1)[:, take - 1] + slack
            i, j = np.nonzero(rough <= cut[:, None])
            found.append((i, j + at, rough[i, j]))
            held += len(i)
            if held > 3 * take * len(rows) or at + CANDIDATE_STEP >= len(b):
                who, what, value = (np.concatenate(c) for c in zip((who, what, value), *found))
                order = np.lexsort((value, who))
                who, what, value = who[order], what[order], value[order]
                last = np.arange(len(who)) - np.searchsorted(who, who) == take - 1
                cut[who[last]] = value[last] + slack[who[last]]
                kept = value <= cut[who]
                who, what, value = who[kept], what[kept], value[kept]
                found, held = [], 0
        exact = np.sqrt(((rows[who] - b[what]) ** 2).sum(1))
        order = np.lexsort((what, exact, who))
        who, what, exact = who[order], what[order], exact[order]
        kept = np.arange(len(who)) - np.searchsorted(who, who) < take
        ends = np.searchsorted(who[kept], np.arange(1, len(rows)))
        places.extend(np.split(what[kept], ends))
        distances.extend(np.split(exact[kept], ends))
    return places, distances


def _cell_groups(centers: np.ndarray, sizes: np.ndarray, wanted: int) -> np.ndarray:
    """A group number for every cell: the group with the most rows is halved along its widest axis, up to ``wanted`` groups."""
    groups = [np.arange(len(centers))]
    while len(groups) < wanted:
        most = max((g for g in range(len(groups)) if len(groups[g]) > 1), key=lambda g: sizes[groups[g]].sum(), default=None)
        if most is None:
            break
        cells = groups.pop(most)
        cells = cells[np.argsort(centers[cells][:, np.ptp(centers[cells], axis=0).argmax()], kind="stable")]
        summed = sizes[cells].cumsum()
        cut = min(max(1, int(np.searchsorted(summed, summed[-1] / 2))), len(cells) - 1)
        groups += [cells[:cut], cells[cut:]]
    number = np.empty(len(centers), np.int64)
    for g, cells in enumerate(groups):
        number[cells] = g
    return number


def _unpacked(vectors: pd.Series, width: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), kind).reshape(-1, width).astype(float)


def _dealt(placed: DataFrame, centers: np.ndarray, limits: np.ndarray, sizes: np.ndarray, block: int, kind: str) -> tuple[DataFrame, DataFrame]:
    """Queries and candidates of every block (cell group, qb, cb); a cell's candidates lie within its limit of its pivot."""
    id_type, width = placed.schema["low"].dataType.simpleString(), centers.shape[1]
    group = _cell_groups(centers, sizes, QUERY_GROUPS)
    count = np.bincount(group, sizes).astype(int)
    member = (np.arange(len(count))[None, :] == group[:, None]).astype(np.float32)  # cell x group
    rows_each = min(block, max(1, -(-int(sizes.sum()) // QUERY_GROUPS)))
    query_blocks = F.array(*[F.lit(max(1, -(-int(c) // rows_each))) for c in count])

    def reached(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            near = _pivot_distances(_unpacked(pdf["v"], width, kind), centers) <= limits
            i, g = np.nonzero(near.astype(np.float32) @ member)
            yield pd.DataFrame({"low": pdf["low"].to_numpy()[i], "v": pdf["v"].to_numpy()[i], "cell": g})

    candidates = placed.select("low", "v").mapInPandas(reached, f"low {id_type}, v binary, cell int")
    held = {r["cell"]: r["n"] for r in candidates.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    cand_blocks = F.array(*[F.lit(max(1, -(-held.get(g, 0) // block))) for g in range(len(count))])
    cell = F.get(F.array(*[F.lit(int(g)) for g in group]), F.col("home"))

    def dealt(rows, blocks, repeated, name, other):
        own = F.pmod(F.xxhash64("low"), F.get(blocks, F.col("cell"))).cast("int")
        return rows.withColumn(name, own).withColumn(other, F.explode(F.sequence(F.lit(0), F.get(repeated, F.col("cell")) - 1)))

    # the query side is repeated per candidate block of its group and the other way round
    queries = dealt(placed.select(cell.alias("cell"), "low", "v", "home"), query_blocks, cand_blocks, "qb", "cb")
    return queries, dealt(candidates, cand_blocks, query_blocks, "cb", "qb")


def knn_join(points: DataFrame, key: str, vector: str, k: int, pivots: int | None = None,
             block_rows: int | None = None, seed: int = 42) -> DataFrame:
    """Exact k nearest other rows by Euclidean distance, ties by id: (src, dst, distance, rank).

    Rows with the same vector are collapsed first. Distinct vectors are split into cells by nearest
    pivot, and cells into ``QUERY_GROUPS`` groups of neighbouring ones. A group is sent only those vectors that
    the triangle inequality cannot rule out for one of its cells, so a vector is sent at most once per group, however
    many rows there are. Groups are cut into blocks of at most ``block_rows`` (by default 64 MB), which return
    k + 1 rows per vector, never all pairs. A few numbers per pivot pass through the driver (at most 256 pivots).
    """
    rows, members = collapsed(points, key, vector, k)
    n = members.count()
    wanted = pivots or int(min(256, max(1, math.sqrt(n) / 2)))
    chosen = members.orderBy(hash_key(["g"], seed)).limit(wanted).select("v").collect()
    if not chosen:
        return rows.select("src", F.col("src").alias("dst"), F.lit(0.0).alias("distance"), F.lit(1).alias("rank")).limit(0)
    centers = np.array([r["v"] for r in chosen])
    width = centers.shape[1]
    # numbers given in four bytes travel in four, which loses nothing
    kind = "f4" if points.select(as_column(vector)).schema[0].dataType.simpleString() == "array<float>" else "f8"
    block = block_rows or max(1024, BLOCK_BYTES // (int(kind[1]) * max(width, 1)))

    def assign(batches):
        for pdf in batches:
            if pdf.empty:
                continue
            vectors = np.array(pdf["v"].tolist(), dtype=float)
            far = _pivot_distances(vectors, centers)
            home = far.argmin(1)
            yield pd.DataFrame({"low": pdf["low"], "v": [v.tobytes() for v in vectors.astype(kind)], "home": home,
                                "own": far[np.arange(len(home)), home]})

    id_type = points.schema[key].dataType.simpleString()
    placed = members.select("low", "v").mapInPandas(assign, f"low {id_type}, v binary, home int, own double")
    placed = cut_lineage(placed)
    per_home = Window.partitionBy("home").orderBy("own")
    near = (placed.withColumn("_r", F.row_number().over(per_home)).where(F.col("_r") <= k + 1)
            .groupBy("home").agg(F.sort_array(F.collect_list("own")).alias("near"), F.max("own").alias("_x")))
    reach = placed.groupBy("home").agg(F.max("own").alias("radius"), F.count("*").alias("n"))
    summary = {r["home"]: r for r in near.join(reach, "home").collect()}  # at most 256 rows

    # theta: no vector of group i has its (k+1)-th nearest (itself included) farther away than this
    gaps = _pivot_distances(centers, centers)
    bound = np.full(len(centers), -1.0)
    for i, row in summary.items():
        offers = np.concatenate([gaps[i, j] + np.array(other["near"]) for j, other in summary.items()])
        offers.sort()
        theta = row["radius"] + offers[min(k, len(offers) - 1)] if len(offers) > k else np.inf
        bound[i] = row["radius"] + theta
    scale = float(np.abs(centers).max()) * math.sqrt(width) + 1.0
    limits = np.where(np.isinf(bound) | (bound < 0), bound, bound + 1e-6 * scale)
    sizes = np.array([summary[i]["n"] if i in summary else 0 for i in range(len(centers))])
    queries, candidates = _dealt(placed, centers, limits, sizes, block, kind)

    def block_best(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """The k + 1 nearest candidates (by distance, then smallest id) of every query vector."""
        out = {"low": [], "distances": [], "others": []}
        if len(left) and len(right):
            right = right.sort_values("low", kind="stable")
            a, b = _unpacked(left["v"], width, kind), _unpacked(right["v"], width, kind)
            mine, theirs, homes = left["low"].to_numpy(), right["low"].to_numpy(), left["home"].to_numpy()
            for home in np.unique(homes):
                asked = np.flatnonzero(homes == home)
                open_ = np.flatnonzero(_pivot_distances(b, centers[home:home + 1])[:, 0] <= limits[home])
                if not len(open_):
                    continue
                places, distances = _nearest(a[asked], b if len(open_) == len(b) else b[open_], k + 1)
                out["low"].extend(mine[asked])
                out["distances"].extend(distances)
                out["others"].extend(theirs[open_[p]] for p in places)
        # lists need the object type where a block has no rows
        return pd.DataFrame({c: pd.Series(v, dtype=None if v else object) for c, v in out.items()})

    best = (queries.groupBy("cell", "qb", "cb").cogroup(candidates.groupBy("cell", "qb", "cb"))
            .applyInPandas(block_best, f"low {id_type}, distances array<double>, others array<{id_type}>"))
    offers = F.flatten(F.collect_list(F.arrays_zip(F.col("distances").alias("distance"), F.col("others").alias("h"))))
    best = (best.groupBy(F.col("low").alias("g")).agg(F.slice(F.array_sort(offers), 1, k + 1).alias("near"))
            .select("g", F.inline("near")))
    coded = rows.select("src", "g").join(members.select("g", "low"), "g").select("src", F.col("low").alias("g"))
    return expanded(coded, members.select(F.col("low").alias("g"), "ids"), best, k)
