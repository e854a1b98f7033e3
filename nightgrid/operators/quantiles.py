"""Exact quantiles of whole columns of a large table.

``percentile`` without a group gathers all distinct values in one task.  Here equal values
are counted first; the distinct ones are then ranged by sampled splitters, each task sorts its
range, and only the ranges' totals are carried on, so the rows of the wanted ranks are known by their running
counts.  No task holds more than its range, wherever the values lie.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from nightgrid.operators.running import running_folds


def exact_percentiles(df: DataFrame, wanted: Mapping[str, Sequence[float]], weight: str | None = None) -> DataFrame:
    """One row with a column <name>_p<i> per column and probability.

    Interpolates linearly between neighbours (type 7).  NULL and NaN are left out.  ``weight``
    names a column that says how often each row counts.  All columns go through one scan; distinct values and
    their running counts are written once.
    """
    cells = [
        F.struct(F.lit(name).alias("k"), F.col(name).cast("double").alias("v"))
        for name in wanted
    ]
    times = F.lit(1) if weight is None else F.col(weight)
    values = (
        df.select(times.cast("long").alias("_times"), F.inline(F.array(*cells)))
        .where(F.col("v").isNotNull() & ~F.isnan("v"))
        .groupBy("k", "v")
        .agg(F.sum("_times").alias("n"))
    )
    placed = running_folds(values, ["k"], ["v"], {"end": (F.col("n"), "sum")}, "value-counts")
    totals = placed.groupBy("k").agg(F.max("end").alias("total"))

    def position(p: float) -> Column:
        return (F.col("total") - 1) * F.lit(float(p))

    def both_ranks(probs: Sequence[float]) -> Column:
        return F.array(*[r for p in probs for r in (F.floor(position(p)), F.ceil(position(p)))])

    ranks = F.lit(None).cast("array<bigint>")
    for column, probs in wanted.items():
        ranks = F.when(F.col("k") == column, F.array_distinct(both_ranks(probs))).otherwise(ranks)
    # One row for each column.
    totals = totals.select("k", "total", ranks.alias("ranks"))
    placed = placed.join(F.broadcast(totals), "k").withColumn("start", F.col("end") - F.col("n"))
    hit = F.filter("ranks", lambda r: (r >= F.col("start")) & (r < F.col("end")))
    found = placed.select("k", "v", "total", F.explode(hit).alias("rank"))

    def quantile(column: str, p: float) -> Column:
        mine = F.col("k") == column

        def at(rank: Column) -> Column:
            return F.max(F.when(mine & (F.col("rank") == rank), F.col("v")))

        exact = (F.max(F.when(mine, F.col("total"))) - 1) * F.lit(float(p))
        weight = exact - F.floor(exact)
        return at(F.floor(position(p))) * (1 - weight) + at(F.ceil(position(p))) * weight

    return found.agg(
        *[
            quantile(column, p).alias(f"{column}_p{i}")
            for column, probs in wanted.items()
            for i, p in enumerate(probs)
        ]
    )


def exact_median(df: DataFrame, column: str) -> Column:
    """The median as a scalar subquery."""
    return exact_percentiles(df, {column: [0.5]}).scalar()
