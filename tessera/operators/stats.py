"""Statistics: Pearson and Spearman correlation, Gaussian kernel density,
regression metrics, a repeatable Monte-Carlo ratio.

All are single-pass aggregates (partial per task, one tiny final merge) except
Spearman, whose ranks need one global order -- computed with a distributed
prefix sum (``tessera.operators.sorting``), never a one-task window.
"""

from __future__ import annotations

import math

from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.sorting import ordered_cumsum

# The two irrational multipliers of the low-discrepancy point set
# (fractional parts of i*alpha give well-spread points in the unit square).
ALPHA_X = 0.7548776662466927
ALPHA_Y = 0.5698402909980532


def pearson(a, b):
    """Pearson correlation of two columns as an aggregate, over the rows where both are
    known; NaN where one of them is constant there or no row is left."""
    a, b = F.col(a).cast("double"), F.col(b).cast("double")
    both = a.isNotNull() & b.isNotNull()
    x, y = F.when(both, a), F.when(both, b)
    constant = (F.min(x) == F.max(x)) | (F.min(y) == F.max(y)) | (F.count(x) == 0)
    # corr divides by the spread of both: a constant column must not reach it
    cov, spread = F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y)
    return F.when(constant, F.lit(float("nan"))).otherwise(F.try_divide(cov, spread))


def corr_pair(df: DataFrame, a: str, b: str, name: str = "r") -> DataFrame:
    """One row: the Pearson correlation, see ``pearson`` for nulls and constant columns."""
    return df.agg(pearson(a, b).alias(name))


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Long-form Pearson matrix ``(i, j, r)``, all ordered pairs, from ONE
    aggregate over the data (upper triangle), mirrored without another pass."""
    pairs = [(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    agg = df.agg(*[pearson(cols[i], cols[j]).alias(f"r_{i}_{j}") for i, j in pairs])
    cells = []
    for i in range(len(cols)):
        for j in range(len(cols)):
            r = F.lit(1.0) if i == j else F.col(f"r_{min(i, j)}_{max(i, j)}")
            cells.append(F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"), r.cast("double").alias("r")))
    return agg.select(F.explode(F.array(*cells)).alias("c")).select("c.i", "c.j", "c.r")


def corr_vector(df: DataFrame, features: str = "features", method: str = "pearson") -> DataFrame:
    """Correlation matrix ``(i, j, r)`` of a vector column, Pearson or Spearman; the
    matrix is bounded by the width of the vector. NaN for a constant dimension."""
    m = Correlation.corr(df.select(features), features, method).first()[0].toArray()
    cells = [(i, j, float(m[i][j])) for i in range(len(m)) for j in range(len(m))]
    return df.sparkSession.createDataFrame(cells, "i int, j int, r double")


def average_ranks(df: DataFrame, col: str, name: str = "rank") -> DataFrame:
    """``(col, rank)`` for every distinct value: 1-based rank in ascending order,
    ties get the average of their positions.

    Rows are first counted per value (partial aggregate), so a value held by a
    third of all rows is one row here; the running count comes from the
    distributed prefix sum."""
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("_cnt"))
    cum = ordered_cumsum(counts, [col], "_cnt", out="_cum")
    return cum.select(col, (F.col("_cum") - (F.col("_cnt") - 1) / 2.0).alias(name))


def corr_spearman(df: DataFrame, a: str, b: str, name: str = "r") -> DataFrame:
    """Spearman correlation = Pearson on average ranks, over the rows where both columns
    are known; NaN where one of them is constant or no row is left.

    Rows are collapsed to distinct ``(a, b)`` pairs with a count first; each pair
    gets its two ranks by equi-join with the rank tables (one row per value), and
    the weighted Pearson sums finish in one aggregate."""
    df = df.select(a, b).dropna()  # before ranking: a rank counts complete pairs only
    pairs = df.groupBy(a, b).agg(F.count(F.lit(1)).cast("double").alias("w"))
    ra = average_ranks(df, a, "ra")
    rb = average_ranks(df, b, "rb")
    p = pairs.join(ra, a).join(rb, b)
    w, x, y = F.col("w"), F.col("ra"), F.col("rb")
    s = p.agg(F.sum(w).alias("n"), F.sum(w * x).alias("sx"), F.sum(w * y).alias("sy"),
              F.sum(w * x * x).alias("sxx"), F.sum(w * y * y).alias("syy"), F.sum(w * x * y).alias("sxy"))
    n = F.col("n")
    cov = F.col("sxy") / n - (F.col("sx") / n) * (F.col("sy") / n)
    vx = F.col("sxx") / n - (F.col("sx") / n) ** 2
    vy = F.col("syy") / n - (F.col("sy") / n) ** 2
    return s.select(F.when((vx > 0) & (vy > 0), F.try_divide(cov, F.sqrt(F.greatest(vx, F.lit(0.0)) * F.greatest(vy, F.lit(0.0)))))
                    .otherwise(F.lit(float("nan"))).alias(name))


def kernel_density(df: DataFrame, col: str, points: list[float], bandwidth: float) -> DataFrame:
    """Gaussian kernel density estimate at each query point: ``(point, density)``.

    One scan of the sample: every value meets the literal array of the stated points
    (exploded, no join) and the kernel values are averaged per point, combined per
    task first, so the shuffle carries one row per point and task. Any number of
    points is exact. Null values are left out; an empty sample has no rows."""
    if not points:
        raise ValueError("no query points")
    h = float(bandwidth)
    norm = h * math.sqrt(2.0 * math.pi)
    x = F.col(col).cast("double")
    each = df.filter(x.isNotNull()).select(
        x.alias("_x"), F.explode(F.array(*[F.lit(float(p)) for p in points])).alias("point"))
    kernel = F.exp(-0.5 * ((F.col("point") - F.col("_x")) / h) ** 2)
    return each.groupBy("point").agg((F.avg(kernel) / norm).alias("density"))


def kernel_density_at(df: DataFrame, col: str, points: DataFrame, point_col: str, bandwidth: float, tail: float = 1e-9,
                      salts: int = 8) -> DataFrame:
    """Gaussian kernel density of ``df[col]`` at every distinct value of ``points[point_col]``, a table of
    any size: ``(point, density, error_bound)``.

    A band join: the kernel is below ``tail`` (of its peak) beyond the radius ``h sqrt(2 ln(1/tail))``, so
    values lie in buckets as wide as that and a point meets its own bucket and the two beside it by an
    equi-join. What is left out adds less than ``error_bound`` = ``tail`` x peak to a density. Equal
    values are counted first and a bucket's values are dealt to ``salts`` parts, each of which every
    point of the bucket meets once, so a bucket with most of the values is not one task. Nulls are
    left out on both sides; an empty sample has no rows."""
    h = float(bandwidth)
    peak, radius = 1.0 / (h * math.sqrt(2.0 * math.pi)), h * math.sqrt(2.0 * math.log(1.0 / tail))
    sample = df.select(F.col(col).cast("double").alias("_x")).filter(F.col("_x").isNotNull()).groupBy("_x").agg(
        F.count(F.lit(1)).alias("_c"))
    values = sample.select("_x", "_c", F.floor(F.col("_x") / radius).alias("_b"), F.pmod(F.xxhash64("_x"), F.lit(salts)).alias("_s"))
    asked = points.select(F.col(point_col).cast("double").alias("point")).filter(F.col("point").isNotNull()).distinct()
    at = F.floor(F.col("point") / radius)
    near = (asked.select("point", F.explode(F.array(at - 1, at, at + 1)).alias("_b"))
            .withColumn("_s", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint")))))
    kernel = F.exp(-0.5 * ((F.col("point") - F.col("_x")) / h) ** 2)
    sums = near.join(values, ["_b", "_s"]).groupBy("point").agg(F.sum(F.col("_c") * kernel).alias("_k"))
    total = df.filter(F.col(col).cast("double").isNotNull()).agg(F.count(F.lit(1)).alias("n")).first()["n"]
    if not total:
        return asked.limit(0).select("point", F.lit(0.0).alias("density"), F.lit(0.0).alias("error_bound"))
    return asked.join(sums, "point", "left").select("point", (F.coalesce("_k", F.lit(0.0)) / total * peak).alias("density"),
                                                    F.lit(tail * peak).alias("error_bound"))


def regression_metrics(df: DataFrame, prediction: str, label: str) -> DataFrame:
    """``(n, rmse, r2, mae)`` in one aggregate; R^2 = 1 - SSE / (n * var_pop(label)), NaN
    for a constant label."""
    e = F.col(prediction) - F.col(label)
    return df.agg(F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(e * e)).alias("rmse"),
                  F.coalesce(1 - F.try_divide(F.sum(e * e), F.count(F.lit(1)) * F.var_pop(label)),
                             F.lit(float("nan"))).alias("r2"),
                  F.avg(F.abs(e)).alias("mae"))


def _limbs(alpha: float) -> tuple[int, int]:
    """``alpha`` as two 31-bit integers: high / 2^31 + low / 2^62."""
    high = int(alpha * (1 << 31))
    return high, int((alpha * (1 << 31) - high) * (1 << 31))


def frac(c, alpha: float):
    """Fractional part of ``i * alpha`` for the integer ``i = c mod 2^31``. The products are
    integers below 2^62, so no digit is lost however large ``c`` is."""
    high, low = _limbs(alpha)
    i = F.pmod(c, F.lit(1 << 31))
    x = F.pmod(i * F.lit(high), F.lit(1 << 31)) / F.lit(float(1 << 31)) + i * F.lit(low) / F.lit(float(1 << 62))
    return x - F.floor(x)


def frac_sql(c: str, alpha: float) -> str:
    """``frac`` of a non-negative integer SQL expression."""
    high, low = _limbs(alpha)
    i = f"(({c}) % {1 << 31})"
    x = f"(({i} * {high} % {1 << 31}) / CAST({1 << 31} AS DOUBLE) + {i} * {low} / CAST({1 << 62} AS DOUBLE))"
    return f"({x} - floor({x}))"


def mc_ratio(df: DataFrame, id_col: str, alpha_x: float = ALPHA_X, alpha_y: float = ALPHA_Y) -> DataFrame:
    """Monte-Carlo ratio over the rows of ``df``: row ``i`` (its integer key) is the
    point ``(2 frac(i*ax) - 1, 2 frac(i*ay) - 1)`` in the square [-1, 1)^2; the
    estimate is 4 x share inside the unit circle. Repeatable, and the same number
    in any engine with IEEE doubles."""
    i = F.col(id_col).cast("bigint")
    x, y = 2.0 * frac(i, alpha_x) - 1.0, 2.0 * frac(i, alpha_y) - 1.0
    inside = F.when(x * x + y * y <= 1.0, 1).otherwise(0)
    return df.agg(F.count(F.lit(1)).alias("n"), (4.0 * F.sum(inside) / F.count(F.lit(1))).alias("estimate"))


def sample_key(id_col: str, alpha: float = ALPHA_X):
    """A repeatable pseudo-random sort key in [0, 1) from an integer key."""
    return frac(F.col(id_col).cast("bigint"), alpha)


def sample_k(df: DataFrame, k: int, id_col: str, alpha: float = ALPHA_X) -> DataFrame:
    """A repeatable sample of exactly ``k`` rows: the ``k`` smallest sample keys
    (top-k per task, then a k-row merge -- ``TakeOrderedAndProject``)."""
    return df.orderBy(sample_key(id_col, alpha), F.col(id_col)).limit(k)
