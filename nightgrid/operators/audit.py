"""Row accounting and content fingerprints.

Counts come from aggregates over the data, not from accumulators or observed
metrics: those can count a task twice when a lost executor makes it run again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from nightgrid import constants as K
from nightgrid.functions.numbers import percent, positive_number
from nightgrid.operators.clean import first_row_order
from nightgrid.operators.ingest import positive_n


def cleaning_counts(
    raw: DataFrame,
    keys: Sequence[str] = K.DEDUP_KEYS,
    remove_duplicates: bool = True,
    remove_noid: bool = True,
    remove_zero_pulse: bool = True,
) -> DataFrame:
    """One row with the rows each cleaning step removes.

    Steps: invalid n, duplicates, automatic NoID, zero pulses.  Whether the pulses
    of a key count depends on the copy that is kept, so that copy is found by a
    minimum that is combined before the shuffle.
    """
    valid = positive_n() if "n" in raw.columns else F.lit(True)
    has_pulses = positive_number("pulses")
    is_noid = F.coalesce(F.col("auto_id") == K.AUTO_NOID, F.lit(False))
    rows = raw.withColumns({"_valid": valid, "_pulses": has_pulses, "_noid": is_noid})
    # Invalid rows share one group, so one scan and one shuffle count them too.
    group = [F.col("_valid"), *[F.when(F.col("_valid"), F.col(k)).alias(k) for k in keys]]
    if remove_duplicates:
        order = F.struct(*first_row_order(raw, keys))
        kept = rows.withColumn("_order", order).groupBy(*group).agg(
            F.count("*").alias("_n"), F.min_by("_pulses", "_order").alias("_pulses"),
            F.min_by("_noid", "_order").alias("_noid"),
        )
    else:
        kept = rows.select("_valid", F.lit(1).alias("_n"), "_pulses", "_noid")
    noid = F.col("_noid") if remove_noid else F.lit(False)
    silent = ~noid & ~F.col("_pulses") if remove_zero_pulse else F.lit(False)
    good = F.col("_valid")
    return kept.agg(
        F.coalesce(F.sum(F.when(good, F.col("_n"))), F.lit(0)).alias("rows_valid"),
        F.coalesce(F.sum(F.when(good, F.col("_n") - 1)), F.lit(0)).alias("duplicate"),
        F.count_if(good & noid).alias("filter_noid"),
        F.count_if(good & silent).alias("filter_zero_pulses"),
        F.coalesce(F.sum(F.when(~good, F.col("_n"))), F.lit(0)).alias("rows_removed"),
    )


def row_audit(counts: DataFrame) -> DataFrame:
    """``cleaning_counts`` as one row per step: rows before, removed, after and %."""
    steps = ("rows_removed", "duplicate", "filter_noid", "filter_zero_pulses")
    start = F.col("rows_valid") + F.col("rows_removed")
    entries = []
    for i, step in enumerate(steps):
        removed_so_far: Column = F.lit(0)
        for earlier in steps[:i]:
            removed_so_far = removed_so_far + F.col(earlier)
        entries.append(
            F.struct(
                F.lit(i + 1).alias("step"), F.lit(step).alias("event_type"),
                (start - removed_so_far).alias("rows_before"),
                F.col(step).alias("n_removed"),
            )
        )
    return counts.select(F.inline(F.array(*entries))).select(
        "step", "event_type", "rows_before", "n_removed",
        (F.col("rows_before") - F.col("n_removed")).alias("rows_after"),
        percent("n_removed", "rows_before", 2).alias("pct_removed"),
    )


def unparsed_times(localized: DataFrame) -> DataFrame:
    """One row: rows whose date or time text is present but gave no timestamp.

    Takes the table before ``final_column_select`` drops the texts.
    """
    given = F.col("date").isNotNull() & F.col("time").isNotNull()
    return localized.agg(
        F.count("*").alias("n_rows"),
        F.count_if(given & F.col("DateTime_UTC").isNull()).alias("n_unparsed"),
        F.count_if(~given).alias("n_without_text"),
    )


def _portable_text(df: DataFrame, columns: Sequence[str]) -> Column:
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("\\N")) for c in columns]
    return F.concat_ws("\x1f", *parts)


def content_fingerprint(
    df: DataFrame, columns: Sequence[str] | None = None, portable: bool = False
) -> DataFrame:
    """Row count and a SHA-256 that depends on the rows but not on their order.

    Rows are hashed one by one and the hashes combined by xor and sum, so no sort
    is needed.  ``portable`` hashes the row text with MD5, which other engines can
    repeat; the default xxHash is several times faster.
    """
    columns = sorted(columns or df.columns)
    if portable:
        digest = F.md5(_portable_text(df, columns))
        row_hash = F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")
    else:
        row_hash = F.xxhash64(*columns)
    combined = df.select(row_hash.alias("h")).agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.bit_xor("h"), F.lit(0)).alias("x"),
        F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0)).alias("s"),
    )
    text = F.concat_ws(":", *[F.col(c).cast("string") for c in ("n_rows", "x", "s")])
    return combined.select("n_rows", F.sha2(text, 256).alias("fingerprint"))
