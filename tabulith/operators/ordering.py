"""Totals, ranks and quantiles along a global order, without one task seeing all rows.

A window without ``partitionBy`` moves the table into one task. Here rows are first
split into order-preserving buckets, ranked inside each bucket, and shifted by the
totals of the buckets before it. The bucket totals have a fixed maximum size.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import as_column
from ..runtime import one_row


def hash_key(ids: Sequence[str], seed: int = 42) -> Column:
    """Pseudo-random but reproducible sort key of a row: md5 of seed and id columns."""
    return F.md5(F.concat_ws("-", F.lit(str(seed)), *[as_column(c).cast("string") for c in ids]))


def hash_uniform(ids: Sequence[str], seed: int = 42) -> Column:
    """Reproducible uniform number in [0, 1) from the first 12 hex digits of the row's md5."""
    return F.conv(F.substring(hash_key(ids, seed), 1, 12), 16, 10).cast("double") / F.lit(float(16**12))


def hash_rank(df: DataFrame, ids: Sequence[str], seed: int = 42, by: Sequence[str] = (),
              out: str = "rank", total: str | None = None, digits: int = 4) -> DataFrame:
    """1-based rank of each row in hash order, over the table or within each ``by`` group.

    Rows go to 16**digits buckets by the leading hash digits, so even a group that holds
    a third of a table of 10**12 rows is ranked in pieces of a few million rows.
    """
    keyed = df.withColumn("_key", hash_key(ids, seed)).withColumn("_bucket", F.substring("_key", 1, digits))
    order = Window.partitionBy(*by).orderBy("_bucket")
    sizes = keyed.groupBy(*by, "_bucket").agg(F.count("*").alias("_size"))
    offsets = sizes.select(
        *[F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)],
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"),
        F.sum("_size").over(Window.partitionBy(*by)).alias("_total"))
    if not by:
        offsets = F.broadcast(offsets)  # at most 16**digits rows
    condition = keyed["_bucket"] == offsets["_b"]
    for i, c in enumerate(by):
        condition = condition & keyed[c].eqNullSafe(offsets[f"_by_{i}"])
    inside = Window.partitionBy(*by, "_bucket").orderBy("_key", *ids)
    ranked = (keyed.withColumn("_inner", F.row_number().over(inside))
              .join(offsets, condition)
              .withColumn(out, (F.col("_inner") + F.col("_offset")).cast("long")))
    if total:
        ranked = ranked.withColumn(total, F.col("_total"))
    extra = [out] + ([total] if total else [])
    return ranked.select(*[as_column(c) for c in df.columns if c not in extra], *extra)


def _edges(df: DataFrame, cols: Sequence[str], buckets: int) -> dict[str, list[float]]:
    """Approximate quantiles of each column: at most ``buckets`` numbers per column (runs a job)."""
    shares = [i / buckets for i in range(1, buckets)]
    row = df.agg(*[F.percentile_approx(as_column(c).cast("double"), shares, 4 * buckets).alias(f"e{i}")
                   for i, c in enumerate(cols)]).first()
    found = {c: sorted({e for e in (row[f"e{i}"] or []) if abs(e) != float("inf")}) for i, c in enumerate(cols)}
    # a column without a finite value still needs one edge
    return {c: [-float("inf"), *(e or [0.0]), float("inf")] for c, e in found.items()}


def running_totals(df: DataFrame, order: str, measures: Mapping[str, Column], by: Sequence[str] = (),
                   descending: bool = False, ties: Sequence[str] = (), buckets: int = 1024) -> DataFrame:
    """Add inclusive running sums of ``measures`` along numeric column ``order``.

    Runs one quantile sketch that fixes the buckets.
    Rows equal in ``order`` share a bucket, so collapse them first (or name ``ties``).
    """
    def direction(c):
        return F.col(c).desc() if descending else F.col(c).asc()

    sort = [direction(order), *[F.col(t) for t in ties]]
    frame = df.withColumns({f"_m_{n}": e for n, e in measures.items()})
    splits = _edges(frame, [order], buckets)[order]
    frame = frame.withColumn("_order", F.col(order).cast("double"))
    frame = Bucketizer(splits=splits, inputCol="_order", outputCol="_bucket", handleInvalid="keep").transform(frame)
    per_bucket = frame.groupBy(*by, "_bucket").agg(*[F.sum(f"_m_{n}").alias(f"_t_{n}") for n in measures])
    before = Window.partitionBy(*by).orderBy(direction("_bucket")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select(
        *[F.col(c).alias(f"_by_{i}") for i, c in enumerate(by)], F.col("_bucket").alias("_b"),
        *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in measures])
    if not by:
        offsets = F.broadcast(offsets)  # at most `buckets` rows
    condition = frame["_bucket"] == offsets["_b"]
    for i, c in enumerate(by):
        condition = condition & frame[c].eqNullSafe(offsets[f"_by_{i}"])
    inside = Window.partitionBy(*by, "_bucket").orderBy(*sort).rowsBetween(Window.unboundedPreceding, 0)
    inner = frame.withColumns({f"_i_{n}": F.sum(f"_m_{n}").over(inside) for n in measures})
    joined = inner.join(offsets, condition).withColumns(
        {n: F.col(f"_i_{n}") + F.col(f"_o_{n}") for n in measures})
    return joined.select(*[as_column(c) for c in df.columns], *measures)


def quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = (),
              exact: bool = True, buckets: int = 1024) -> DataFrame:
    """Quantiles with linear interpolation: one row (by..., column, q) per column, q an array.

    Exact at any size: one sketch fixes order buckets, rows are counted per bucket, and only those of the buckets
    that hold a wanted rank are put in order. ``exact=False`` uses the mergeable sketch alone.
    """
    def value(c):
        number = as_column(c).cast("double")
        return F.when(~F.isnan(number), number)

    base = df.select(*by, *[value(c).alias(f"_v{i}") for i, c in enumerate(cols)])
    positions = list(enumerate(cols))
    if not exact:
        stats = base.groupBy(*by).agg(*[F.percentile_approx(f"_v{i}", [float(p) for p in probs], 10_000).alias(f"_q{i}")
                                        for i, _ in positions])
        found = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_q{i}").alias("q")) for i, c in positions])
        return stats.select(*by, F.inline(found))

    names = [f"_v{i}" for i, _ in positions]
    edges = _edges(base, names, buckets)
    bucketed = Bucketizer(splitsArray=[edges[n] for n in names], inputCols=names,
                          outputCols=[f"_b{i}" for i, _ in positions], handleInvalid="keep").transform(base)
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_b{i}").alias("_bucket"),
                               F.col(f"_v{i}").alias("_value")) for i, c in positions])
    keys = [*by, "column"]
    cells = bucketed.select(*by, F.inline(cells)).where(F.col("_value").isNotNull())
    totals = cells.groupBy(*keys, "_bucket").agg(F.count("*").alias("_size"))
    whole = Window.partitionBy(*keys)
    totals = totals.select(
        *keys, "_bucket", "_size",
        F.coalesce(F.sum("_size").over(whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_start"),
        F.sum("_size").over(whole).alias("_total"))
    wanted = F.array(*[F.struct(F.lit(i).alias("_i"), F.lit(float(p)).alias("_p")) for i, p in enumerate(probs)])

    def ranks(frame):
        position = (F.col("_total") - 1) * F.col("_p")
        return frame.withColumns({"_lo": F.floor(position), "_hi": F.ceil(position),
                                  "_frac": position - F.floor(position)})

    def holds(rank, start, size):
        return (F.col(rank) >= F.col(start)) & (F.col(rank) < F.col(start) + F.col(size))

    hit = ranks(totals.select("*", F.inline(wanted))).where(
        holds("_lo", "_start", "_size") | holds("_hi", "_start", "_size"))
    hit = hit.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                     F.col("_bucket").alias("_kb"), "_start", "_total").distinct()
    if not by:
        hit = F.broadcast(hit)  # at most two buckets per column and probability
    condition = cells["_bucket"] == hit["_kb"]
    for i, k in enumerate(keys):
        condition = condition & cells[k].eqNullSafe(hit[f"_k{i}"])
    # only the few buckets that hold a wanted rank are counted by value and put in order
    counts = cells.join(hit, condition).groupBy(*keys, "_bucket", "_start", "_total", "_value").agg(F.count("*").alias("_n"))
    inside = Window.partitionBy(*keys, "_bucket").orderBy("_value").rowsBetween(Window.unboundedPreceding, -1)
    placed = counts.withColumn("_first", F.col("_start") + F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    placed = ranks(placed.select("*", F.inline(wanted)))
    found = placed.groupBy(*keys, "_i", "_frac").agg(
        F.max(F.when(holds("_lo", "_first", "_n"), F.col("_value"))).alias("_a"),
        F.max(F.when(holds("_hi", "_first", "_n"), F.col("_value"))).alias("_z"))
    # equal ends are kept as they are: inf - inf would turn into NaN
    mixed = F.when(F.col("_a") == F.col("_z"), F.col("_a")).otherwise(
        F.col("_a") + (F.col("_z") - F.col("_a")) * F.col("_frac"))
    per_prob = found.groupBy(*keys).agg(
        F.array(*[F.max(F.when(F.col("_i") == i, mixed)) for i in range(len(probs))]).alias("q"))
    # a column without any value keeps its row
    names = F.explode(F.array(*[F.lit(c) for c in cols])).alias("column")
    every = base.select(*by).distinct().select(*by, names) if by else base.sparkSession.range(1).select(names)
    same = F.lit(True)
    for k in keys:
        same = same & every[k].eqNullSafe(per_prob[k])
    return every.join(per_prob, same, "left").select(*[every[k] for k in keys], "q")


def quantile_table(df: DataFrame, cols: Sequence[str], probs: Mapping[str, float], by: Sequence[str] = (),
                   **options) -> DataFrame:
    """``quantiles`` with one named output column per probability."""
    found = quantiles(df, cols, list(probs.values()), by, **options)
    return found.select(*by, "column", *[F.col("q")[i].alias(n) for i, n in enumerate(probs)])


def row_ranks(df: DataFrame, order: str, tie: str, out: str = "rank", total: str | None = None,
              descending: bool = False, buckets: int = 1024) -> DataFrame:
    """1-based row number by numeric ``order``, then by numeric ``tie`` ascending.

    The distinct values of ``order`` get their starting rank from running
    totals, and the copies of one value are split by buckets of ``tie``, so one value that
    holds a third of the rows is still ranked by many tasks. Runs the jobs of ``running_totals``.
    """
    extra = [out] + ([total] if total else [])
    kept = [as_column(c) for c in df.columns if c not in extra]
    splits = _edges(df, [tie], buckets)[tie]
    frame = df.withColumn("_tie", F.col(tie).cast("double"))
    frame = Bucketizer(splits=splits, inputCol="_tie", outputCol="_tb", handleInvalid="keep").transform(frame)
    sizes = frame.groupBy(F.col(order).alias("_value"), "_tb").agg(F.count("*").alias("_n"))
    values = sizes.groupBy("_value").agg(F.sum("_n").alias("_rows"))
    starts = running_totals(values, "_value", {"_end": F.col("_rows")}, descending=descending, buckets=buckets)
    starts = starts.select(F.col("_value").alias("_sv"), (F.col("_end") - F.col("_rows")).alias("_start"))
    earlier = Window.partitionBy("_value").orderBy("_tb").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    placed = placed.join(starts, placed["_value"].eqNullSafe(starts["_sv"])).select(
        "_value", F.col("_tb").alias("_ptb"), (F.col("_start") + F.col("_before")).alias("_offset"))
    inside = Window.partitionBy(order, "_tb").orderBy(tie)
    ranked = (frame.withColumn("_inner", F.row_number().over(inside))
              .join(placed, frame[order].eqNullSafe(placed["_value"]) & (F.col("_tb") == F.col("_ptb")))
              .withColumn(out, (F.col("_inner") + F.col("_offset")).cast("long")))
    if total:
        ranked = ranked.withColumn("_all", one_row(df.agg(F.count("*").alias("n")))).withColumn(total, F.col("_all.n"))
    return ranked.select(*kept, *extra)


def with_next(points: DataFrame, rank: str, columns: Sequence[str]) -> DataFrame:
    """Add ``next_<column>`` from the row whose ``rank`` is one higher (an equi-join, no global window)."""
    following = points.select((F.col(rank) - 1).alias("_at"), *[F.col(c).alias(f"next_{c}") for c in columns])
    return points.join(following, points[rank] == following["_at"], "left").drop("_at")
