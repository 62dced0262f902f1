"""Column expressions. All of them stay inside the JVM."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of the Abramowitz-Stegun 7.1.26 approximation of erf.
ERF_P = 0.3275911
ERF_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def as_column(c: str | Column) -> Column:
    """A Column for a name (quoted, so names with spaces work) or a Column."""
    return F.col("`" + c.replace("`", "``") + "`") if isinstance(c, str) else c


# ---- text -------------------------------------------------------------------

def strip_lower(c) -> Column:
    return F.lower(F.trim(as_column(c)))


def slug(c) -> Column:
    """Lower-case, runs of anything but letters and digits become one dash, no outer dashes."""
    dashed = F.regexp_replace(F.lower(as_column(c)), "[^a-z0-9]+", "-")
    return F.regexp_replace(dashed, "^-+|-+$", "")


def safe_name(c) -> Column:
    """Lower-case, blanks and dashes become underscores, ``+`` becomes ``plus``."""
    spaced = F.regexp_replace(F.lower(as_column(c)), "[ -]", "_")
    return F.replace(spaced, F.lit("+"), F.lit("plus"))


def format_count(c) -> Column:
    """Whole number with thousands separators; missing becomes ``0``."""
    number = as_column(c).cast("double")
    whole = F.when(F.isnan(number), F.lit(0)).otherwise(number).cast("long")
    return F.coalesce(F.format_number(whole, 0), F.lit("0"))


def format_cell(c, is_float: bool = True) -> Column:
    """Display text: four decimals for floats, a long dash for missing."""
    value = as_column(c)
    if not is_float:
        return F.coalesce(value.cast("string"), F.lit("—"))
    shown = F.when(value.isNotNull() & ~F.isnan(value), F.format_string("%.4f", value))
    return F.coalesce(shown, F.lit("—"))


def strip_prefix(c, prefixes: Sequence[str]) -> Column:
    pattern = "^(" + "|".join(prefixes) + ")"
    return F.regexp_replace(as_column(c), pattern, "")


# ---- missing values ---------------------------------------------------------

def finite_or_null(c) -> Column:
    """NaN and infinities become NULL, the one missing value used downstream."""
    value = as_column(c)
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(math.inf)), value)


def to_number(c, default: float | None = None) -> Column:
    """Text to double; what is not a number becomes NULL, or ``default``."""
    number = as_column(c).try_cast("double")
    number = F.when(~F.isnan(number), number)
    return number if default is None else F.coalesce(number, F.lit(float(default)))


# ---- numeric ----------------------------------------------------------------

def min_max(c, low, high, scale: float = 1.0) -> Column:
    """(x - low) / (high - low) * scale; a constant or empty column keeps its raw values."""
    value, low, high = as_column(c), as_column(low), as_column(high)
    spread = high - low
    usable = low.isNotNull() & high.isNotNull() & (spread != 0)
    return F.when(usable, (value - low) / F.when(spread != 0, spread) * F.lit(scale)).otherwise(value)


def z_score(c, mean, std, epsilon: float | None = None) -> Column:
    """(x - mean) / std. A zero spread divides by 1, or by ``epsilon`` more than std if given."""
    spread = as_column(std)
    if epsilon is None:
        spread = F.when(spread == 0, F.lit(1.0)).otherwise(spread)
    else:
        spread = spread + F.lit(epsilon)
    return (as_column(c) - as_column(mean)) / spread


def linear_score(weights: Mapping[str, float], intercept: float = 0.0) -> Column:
    score = F.lit(float(intercept))
    for name, weight in weights.items():
        score = score + F.lit(float(weight)) * as_column(name)
    return score


def sigmoid(c) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-as_column(c)))


def clip(c, low, high) -> Column:
    """Keep within [low, high]; NULL stays NULL."""
    value = as_column(c)
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def normal_pdf(z) -> Column:
    z = as_column(z)
    return F.exp(-z * z / F.lit(2.0)) / F.lit(math.sqrt(2.0 * math.pi))


def erf(x) -> Column:
    """Error function, absolute error below 1.5e-7."""
    x = as_column(x)
    t = F.lit(1.0) / (F.lit(1.0) + F.lit(ERF_P) * F.abs(x))
    poly = F.lit(0.0)
    for coefficient in reversed(ERF_A):
        poly = (poly + F.lit(coefficient)) * t
    return F.signum(x) * (F.lit(1.0) - poly * F.exp(-x * x))


def normal_cdf(z) -> Column:
    return F.lit(0.5) * (F.lit(1.0) + erf(as_column(z) / F.lit(math.sqrt(2.0))))


def expected_improvement(mu, sigma, best, xi: float = 0.01) -> Column:
    """Expected improvement over ``best`` of a normal prediction; sigma is floored at 1e-9."""
    spread = F.greatest(as_column(sigma), F.lit(1e-9))
    gain = as_column(mu) - as_column(best) - F.lit(xi)
    z = gain / spread
    return gain * normal_cdf(z) + spread * normal_pdf(z)


def bin_index(c, low, high, bins: int) -> Column:
    """Equal-width bin number 0..bins-1; the last bin is closed on the right."""
    value, low, high = as_column(c), as_column(low), as_column(high)
    spread = high - low
    position = F.floor((value - low) / F.when(spread != 0, spread) * F.lit(bins))
    placed = F.least(position, F.lit(bins - 1).cast("long"))
    return F.when(value.isNull(), None).when(spread == 0, F.lit(bins // 2)).otherwise(placed)


# ---- across the columns of one row, skipping NULL ---------------------------

# sums and means are plain arithmetic, so that they stay inside generated code

def _cells(cols: Sequence[str]) -> list[Column]:
    values = [as_column(c).cast("double") for c in cols]
    return [F.when(~F.isnan(v), v) for v in values]


def _total(parts: Sequence[Column]) -> Column:
    total = F.lit(0.0)
    for p in parts:
        total = total + p
    return total


def row_sum(cols: Sequence[str]) -> Column:
    """Sum of the present values, 0 when there is none."""
    return _total([F.coalesce(v, F.lit(0.0)) for v in _cells(cols)])


def row_count(cols: Sequence[str]) -> Column:
    count = F.lit(0)
    for v in _cells(cols):
        count = count + F.when(v.isNotNull(), 1).otherwise(0)
    return count


def row_mean(cols: Sequence[str]) -> Column:
    n = row_count(cols)
    return F.when(n > 0, row_sum(cols) / n)


def row_std(cols: Sequence[str]) -> Column:
    """Sample standard deviation of the present values; NULL below two of them.

    One running pass over an array: spelled out as arithmetic the mean would be repeated per column.
    """
    values = F.filter(F.array(*_cells(cols)), lambda v: v.isNotNull())
    seed = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def step(acc, v):
        count = acc["n"] + 1.0
        delta = v - acc["mean"]
        mean = acc["mean"] + delta / count
        return F.struct(count.alias("n"), mean.alias("mean"), (acc["m2"] + delta * (v - mean)).alias("m2"))

    return F.aggregate(values, seed, step, lambda acc: F.when(
        acc["n"] > 1, F.sqrt(acc["m2"] / F.when(acc["n"] > 1, acc["n"] - 1))))


# ---- distances --------------------------------------------------------------

def euclidean(left: Sequence, right: Sequence) -> Column:
    """Distance between two equally long lists of columns (or numbers)."""
    total = F.lit(0.0)
    for a, b in zip(left, right, strict=True):
        a = F.lit(float(a)) if isinstance(a, (int, float)) else as_column(a)
        b = F.lit(float(b)) if isinstance(b, (int, float)) else as_column(b)
        total = total + (a - b) * (a - b)
    return F.sqrt(total)


def euclidean_arrays(left, right) -> Column:
    squares = F.zip_with(as_column(left), as_column(right),
                         lambda a, b: (a.cast("double") - b.cast("double")) * (a.cast("double") - b.cast("double")))
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda acc, v: acc + v))
