"""Joins and counts in which one key may hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

#: A key is heavy above one in so many rows, so there are fewer heavy keys than this.
HEAVY_SHARE = 1024


def join_by_weight(facts: DataFrame, dims: DataFrame, on: Sequence[str], weight: str, how: str = "inner") -> DataFrame:
    """``facts`` joined to ``dims``, which has one row per key and says how many facts each key has.

    Rows of heavy keys stay where they are: fewer than ``HEAVY_SHARE`` rows of ``dims`` are
    broadcast for them.  All others meet by a shuffle in which no key is large.  Both sides
    are read twice, so they should be written tables.  ``how`` is inner or left; the column
    ``weight`` is left out.
    """
    total = F.lit(dims.agg(F.sum(weight)).first()[0] or 0)
    is_heavy = F.coalesce(F.col(weight) * HEAVY_SHARE > total, F.lit(False))
    heavy, light = dims.where(is_heavy).drop(weight), dims.where(~is_heavy).drop(weight)
    near = facts.join(F.broadcast(heavy), list(on))
    far = facts.join(F.broadcast(heavy.select(*on)), list(on), "left_anti").join(light, list(on), how)
    return near.unionByName(far)


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[c for k in keys for c in (F.isnull(k), F.col(k))])


def heavy_hashes(df: DataFrame, keys: Sequence[str]) -> list[int]:
    """Hashes that include those of all keys with more than one in ``HEAVY_SHARE`` rows.

    Each task keeps a summary of fixed size, and the summaries are merged; the driver gets at most ``2 * HEAVY_SHARE`` numbers.
    """
    summary = F.call_function("approx_top_k", _key_hash(keys), F.lit(2 * HEAVY_SHARE), F.lit(32 * HEAVY_SHARE))
    row = df.agg(F.count("*").alias("n"), summary.alias("top")).first()
    return [x["item"] for x in row.top or [] if x["count"] * HEAVY_SHARE > row.n]


def count_in_group(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Attach the number of rows that share the key; NULL keys equal each other.

    Rows are read and shuffled once.  Those of heavy keys are dealt out over ``HEAVY_SHARE`` parts by their place and take their
    counts from a broadcast table of at most ``2 * HEAVY_SHARE`` keys; a window counts the others.
    """
    heavy = heavy_hashes(df, keys)
    if not heavy:
        return df.withColumn(name, F.count("*").over(Window.partitionBy(*keys)))
    is_heavy = _key_hash(keys).isin(heavy)
    # NULL and other keys are told apart by the columns beside the hash.
    counts = df.where(is_heavy).groupBy(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)]).agg(F.count("*").alias("_heavy"))
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & df[k].eqNullSafe(counts[f"_key{i}"])
    counted = df.join(F.broadcast(counts), match, "left")
    part = F.when(F.col("_heavy").isNotNull(), F.monotonically_increasing_id() % HEAVY_SHARE).otherwise(-1)
    counted = counted.withColumn("_part", part)
    own = F.count("*").over(Window.partitionBy(*[counted[k] for k in keys], "_part"))
    return counted.withColumn(name, F.coalesce("_heavy", own)).select(*[counted[c] for c in df.columns], name)
