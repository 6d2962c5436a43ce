"""Alternating least squares from normal equations, with the error of every iteration.

A half step joins the ratings with the other side's factors and sums, per row to solve, the
upper triangle of the Gram matrix and the right-hand side: sums that are combined in
each task first, so a user with a third of all ratings is one row per task. The small
systems are solved many at a time in vectorised tasks. Factors never pass through the driver.

The error comes for free: with the row's Gram matrix G, right-hand side b and sum of squared
ratings s, its squared error at the solution x is s - 2 b.x + x.G x.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.skew import HotKeys, hot_keys, join_by_key
from tessera.session import checkpoint

#: Fixed values of the start: a prime and a multiplier that spread the ids over it.
PRIME, MULTIPLIER = 1_000_003, 618_034


def start_vector(key: Column, rank: int) -> Column:
    """A repeatable start in [0, 1) for each entry of an integer key, the same in any engine."""
    return F.array(*[(F.pmod((F.pmod(key.cast("bigint"), F.lit(PRIME)) * rank + f + 1) * MULTIPLIER, F.lit(PRIME)) / float(PRIME))
                     for f in range(rank)])


def _solve_rows(rank: int, reg: float):
    upper = np.triu_indices(rank)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            gram = np.zeros((rows, rank, rank))
            gram[:, upper[0], upper[1]] = batch.column(2).flatten().to_numpy().reshape(rows, -1)
            gram = gram + np.triu(gram, 1).transpose(0, 2, 1)
            rhs = batch.column(3).flatten().to_numpy().reshape(rows, rank)
            n, squares = batch.column(1).to_numpy(), batch.column(4).to_numpy()
            x = np.linalg.solve(gram + (reg * n)[:, None, None] * np.eye(rank), rhs[:, :, None])[:, :, 0]
            error = squares - 2 * (rhs * x).sum(axis=1) + np.einsum("ri,rij,rj->r", x, gram, x)
            vectors = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * rank, pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), vectors, batch.column(1), pa.array(np.maximum(error, 0.0))],
                                             names=["key", "factors", "n", "error"])
    return run


def half_step(ratings: DataFrame, target: str, source: str, factors: DataFrame, hot: HotKeys, rank: int, reg: float) -> DataFrame:
    """(key, factors, n, error) of every ``target``, from the ``source`` side's (key, factors). ``reg`` is
    multiplied by the row's number of ratings."""
    v = [F.get("factors", i) for i in range(rank)]
    joined = join_by_key(ratings, factors.select(F.col("key").alias(source), "factors"), source, hot)
    sums = joined.groupBy(F.col(target).alias("key")).agg(
        F.count(F.lit(1)).alias("n"),
        F.array(*[F.sum(v[i] * v[j]) for i in range(rank) for j in range(i, rank)]).alias("gram"),
        F.array(*[F.sum(v[i] * F.col("rating")) for i in range(rank)]).alias("rhs"),
        F.sum(F.col("rating") * F.col("rating")).alias("squares"))
    key_type = sums.schema["key"].dataType.simpleString()
    return checkpoint(sums.mapInArrow(_solve_rows(rank, reg), f"key {key_type}, factors array<double>, n bigint, error double"))


def als_errors(ratings: DataFrame, rank: int = 10, iterations: int = 5, reg: float = 0.01, user: str = "user_id",
               item: str = "item_id", rating: str = "rating"):
    """(user factors, item factors, errors): factors are tables (key, factors), ``errors`` is
    a list of (iteration, RMSE over the ratings).

    Users start from ``start_vector``; an iteration solves the items, then the users. Rows with a null
    are left out; repeated pairs count as often as they occur. Without ratings there are no errors."""
    rows = checkpoint(ratings.select(F.col(user).alias("user"), F.col(item).alias("item"),
                                     F.col(rating).cast("double").alias("rating")).dropna())
    hot_users, hot_items = hot_keys(rows, "user"), hot_keys(rows, "item")
    users = checkpoint(rows.select("user").distinct().select(F.col("user").alias("key"), start_vector(F.col("user"), rank).alias("factors")))
    items, errors = None, []
    for i in range(iterations):
        items = half_step(rows, "item", "user", users, hot_users, rank, reg)
        users = half_step(rows, "user", "item", items, hot_items, rank, reg)
        total = users.agg(F.sum("error").alias("e"), F.sum("n").alias("n")).first()
        if total["n"]:
            errors.append((i + 1, (total["e"] / total["n"]) ** 0.5))
    return users.select("key", "factors"), items.select("key", "factors"), errors
