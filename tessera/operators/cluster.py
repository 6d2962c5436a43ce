"""K-means (Lloyd) for many groups in one job, and silhouette in closed form.

State is a centre table ``(group, cluster, centre)`` with ``k`` rows per group.
Each round:

1. the centres of a group are folded into ONE row holding an array of ``k``
   structs ordered by cluster (bounded by ``k``);
2. points join that row on ``group``: the rows of groups with more than a thousandth
   of all points (fewer than a thousand groups) are broadcast, so those points stay
   spread over all tasks; the other points take an ordinary shuffle join
   (``tessera.operators.skew``);
3. each point takes the least ``(distance, cluster)`` over the ``k`` centres
   (first cluster wins ties) -- plain arithmetic on columns, compiled by
   whole-stage codegen; no cross join, no pairs;
4. new centres are per-dimension means per ``(group, cluster)`` (partial
   aggregates); an empty cluster keeps its old centre;
5. the new centre table is checkpointed (small, cuts the lineage).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.skew import HotKeys, hot_keys, join_by_key
from tessera.session import checkpoint

GROUP = "_g"


def _x(d: int) -> Column:
    return F.col(f"_x{d}")


def _sq_dist(centre: Column, dims: int) -> Column:
    """Squared Euclidean distance of the point to ``centre`` (array), summed in
    dimension order."""
    total = None
    for d in range(dims):
        t = (_x(d) - centre[d]) * (_x(d) - centre[d])
        total = t if total is None else total + t
    return total


def _dot(vec: Column, dims: int) -> Column:
    total = None
    for d in range(dims):
        t = _x(d) * vec[d]
        total = t if total is None else total + t
    return total


def prepare_points(df: DataFrame, features: list[str], group: str | None = None,
                   scales: list[float] | None = None) -> DataFrame:
    """``(_g, _x0.._x{d-1}[, _i0..])`` from feature columns; rows with a null
    feature are skipped.

    With ``scales`` the feature columns hold fixed-point integers and the feature
    value is ``integer / scale``; the integers are kept (``_i*``) so centre means
    are exact integer sums -- the same bits for any partitioning or engine."""
    g = F.col(group) if group else F.lit(0)
    if scales is None:
        cols = [F.col(c).cast("double").alias(f"_x{d}") for d, c in enumerate(features)]
    else:
        cols = [(F.col(c).cast("bigint").cast("double") / F.lit(float(s))).alias(f"_x{d}")
                for d, (c, s) in enumerate(zip(features, scales))]
        cols += [F.col(c).cast("bigint").alias(f"_i{d}") for d, c in enumerate(features)]
    return df.select(g.alias(GROUP), *cols).dropna()


def initial_centres(points: DataFrame, init: list[list[float]]) -> DataFrame:
    """The same ``k`` explicit start centres for every group: ``(_g, cluster, centre)``."""
    cells = [F.struct(F.lit(i).alias("cluster"), F.array(*[F.lit(float(v)) for v in c]).alias("centre"))
             for i, c in enumerate(init)]
    return (points.select(GROUP).distinct()
            .select(GROUP, F.explode(F.array(*cells)).alias("s")).select(GROUP, "s.cluster", "s.centre"))


def sampled_centres(points: DataFrame, k: int, dims: int, hot: HotKeys, seed: int = 42) -> DataFrame:
    """``k`` start centres per group taken from the group's own points, repeatably
    (a seeded ``takeSample``): every point gets the key ``xxhash64(seed, group,
    features)`` and each group contributes its points with the ``k`` smallest keys.

    Picked in ``k`` rounds of ``min_by`` (partial aggregates, one row per group),
    each round keeping only keys above the previous pick -- no window over a hot
    group, no collected list. A group with fewer than ``k`` distinct points repeats
    its first pick (the spare clusters stay empty and keep their centre)."""
    xs = [_x(d) for d in range(dims)]
    keyed = points.select(GROUP, F.xxhash64(F.lit(seed), F.col(GROUP), *xs).alias("_key"), *xs)
    picks, last = [], None
    for j in range(k):
        cand = keyed if last is None else (
            join_by_key(keyed, last, GROUP, hot).filter(F.col("_key") > F.col("_last")))
        pick = checkpoint(cand.groupBy(GROUP).agg(F.min_by(F.array(*xs), "_key").alias("centre"),
                                                   F.min("_key").alias("_last")))
        picks.append(pick.select(GROUP, F.lit(j).alias("cluster"), "centre"))
        last = pick.select(GROUP, "_last")
    found = picks[0]
    for p in picks[1:]:
        found = found.unionByName(p)
    grid = (picks[0].select(GROUP, F.col("centre").alias("_first"))
            .select(GROUP, "_first", F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("cluster")))
    return (grid.join(found, [GROUP, "cluster"], "left")
            .select(GROUP, "cluster", F.coalesce("centre", "_first").alias("centre")))


def _centre_lists(centres: DataFrame) -> DataFrame:
    """One row per group: ``_cs`` = its ``k`` centres ordered by cluster."""
    return centres.groupBy(GROUP).agg(
        F.array_sort(F.collect_list(F.struct("cluster", "centre"))).alias("_cs"))


def assign(points: DataFrame, centres: DataFrame, k: int, dims: int, hot: HotKeys) -> DataFrame:
    """Points plus ``cluster``: the nearest centre; equal distances go to the lower cluster."""
    joined = join_by_key(points, _centre_lists(centres), GROUP, hot)
    cands = [F.struct(_sq_dist(F.col("_cs")[j]["centre"], dims).alias("d"), F.lit(j).alias("c"))
             for j in range(k)]
    best = F.least(*cands) if k > 1 else cands[0]
    return joined.select(*points.columns, best["c"].alias("cluster"))


def update(assigned: DataFrame, centres: DataFrame, dims: int, scales: list[float] | None = None) -> DataFrame:
    """Mean of the members per ``(group, cluster)``; clusters without members keep
    their centre. With ``scales`` the mean is ``(sum of integers / n) / scale``."""
    if scales is None:
        mean = [F.avg(_x(d)) for d in range(dims)]
    else:
        n = F.count(F.lit(1)).cast("double")
        mean = [(F.sum(f"_i{d}").cast("double") / n) / F.lit(float(scales[d])) for d in range(dims)]
    means = assigned.groupBy(GROUP, "cluster").agg(F.array(*mean).alias("_new"))
    return (centres.join(means, [GROUP, "cluster"], "left")
            .select(GROUP, "cluster", F.coalesce("_new", "centre").alias("centre")))


@dataclass
class KMeansFit:
    """A finished Lloyd run. ``centres`` is checkpointed; ``assigned()`` is lazy over
    the cached points, so derive what is needed (sizes, silhouettes), materialise
    it, then ``release()`` the cache."""

    centres: DataFrame
    points: DataFrame
    k: int
    dims: int
    hot: HotKeys  # the groups with more than a thousandth of all points

    def assigned(self) -> DataFrame:
        return assign(self.points, self.centres, self.k, self.dims, self.hot)

    def release(self) -> None:
        self.points.unpersist()


def kmeans_lloyd(df: DataFrame, features: list[str], init: list[list[float]] | int, iterations: int,
                 group: str | None = None, tol: float | None = None,
                 scales: list[float] | None = None, seed: int = 42) -> KMeansFit:
    """Lloyd's K-means per group (one job for all groups).

    ``centres`` = ``(_g, cluster, centre)``. With ``tol`` it stops early once the
    summed squared centre movement is at most ``tol`` (one small extra job per
    round); without it it runs ``iterations`` rounds. ``init`` is either the
    explicit start centres (the same for every group) or ``k``: start from ``k``
    points of each group sampled with ``seed``.
    """
    k, dims = (init if isinstance(init, int) else len(init)), len(features)
    points = prepare_points(df, features, group, scales).persist(StorageLevel.MEMORY_AND_DISK)
    hot = hot_keys(points, GROUP)
    if isinstance(init, int):
        centres = checkpoint(sampled_centres(points, k, dims, hot, seed))
    else:
        centres = checkpoint(initial_centres(points, init))  # groups x k rows
    for _ in range(iterations):
        new = checkpoint(update(assign(points, centres, k, dims, hot), centres, dims, scales))
        if tol is not None:
            moved = (new.alias("n").join(centres.alias("o"), [GROUP, "cluster"])
                     .agg(F.sum(F.aggregate(F.zip_with("n.centre", "o.centre", lambda u, v: (u - v) * (u - v)),
                                            F.lit(0.0), lambda a, t: a + t))).first()[0])
            if moved is not None and moved <= tol:
                centres = new
                break
        centres = new
    return KMeansFit(centres, points, k, dims, hot)


def cluster_sizes(assigned: DataFrame) -> DataFrame:
    return assigned.groupBy(GROUP, "cluster").agg(F.count(F.lit(1)).alias("size"))


def silhouette(assigned: DataFrame, dims: int, k: int, hot: HotKeys) -> DataFrame:
    """Mean silhouette per group with squared Euclidean distance: ``(_g, silhouette, n)``.

    Closed form: the mean squared distance from ``x`` to cluster ``C`` is
    ``|x|^2 + S2_C / n_C - 2 x . S1_C / n_C`` with ``S1`` the sum and ``S2`` the
    summed squared norms of the members, so one aggregate per cluster replaces all
    point pairs. The own-cluster mean is rescaled by ``n / (n - 1)`` to leave the
    point out; a point alone in its cluster, or in a group with one cluster, scores 0.
    ``hot``: the groups with more than a thousandth of all points (``hot_keys``).
    """
    xx = _dot(F.array(*[_x(d) for d in range(dims)]), dims)
    stats = assigned.groupBy(GROUP, "cluster").agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.array(*[F.sum(_x(d)) for d in range(dims)]).alias("s1"),
        F.sum(xx).alias("s2"))
    per_group = stats.groupBy(GROUP).agg(
        F.map_from_entries(F.collect_list(F.struct("cluster", F.struct("n", "s1", "s2")))).alias("_st"))
    joined = join_by_key(assigned, per_group, GROUP, hot)

    def mean_d2(s: Column) -> Column:  # null when the cluster has no members
        return xx + s["s2"] / s["n"] - 2.0 * _dot(s["s1"], dims) / s["n"]

    own = F.col("_st")[F.col("cluster")]
    a = mean_d2(own) * own["n"] / (own["n"] - 1.0)
    others = [F.when(F.col("cluster") != j, mean_d2(F.col("_st")[F.lit(j)])) for j in range(k)]
    b = F.least(*others) if k > 1 else F.lit(None).cast("double")
    sil = (F.when((own["n"] <= 1) | b.isNull(), F.lit(0.0))
           .when(a < b, 1.0 - a / b).when(a > b, b / a - 1.0).otherwise(F.lit(0.0)))
    return joined.select(GROUP, sil.alias("s")).groupBy(GROUP).agg(
        F.avg("s").alias("silhouette"), F.count(F.lit(1)).alias("n"))
