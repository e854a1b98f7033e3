"""Top-n, pivots, unpivots and completing of missing combinations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from nightgrid import constants as K
from nightgrid.functions.numbers import fixed, percent, round_columns, round_nearest
from nightgrid.operators.heavy import count_in_group
from nightgrid.operators.running import running_folds
from nightgrid.sources.scratch import materialize

#: Labels whose presence a left label keeps in one row.
LABEL_BLOCK = 4096


def top_n_per_group(
    df: DataFrame, group: str, n: int, by: str = "n_calls", tie: str = "species"
) -> DataFrame:
    window = Window.partitionBy(group).orderBy(F.desc(by), F.asc(tie))
    ranked = df.withColumn("_place", F.row_number().over(window))
    return ranked.where(F.col("_place") <= n).drop("_place")


def top_n_global(
    counts: DataFrame, n: int, value: str = "n_calls", label: str = "species"
) -> DataFrame:
    """Labels with the n largest totals, as (label, total)."""
    totals = counts.groupBy(label).agg(F.sum(value).alias("total"))
    return totals.orderBy(F.desc("total"), F.asc(label)).limit(n)


def keep_top_n(
    counts: DataFrame, n: int | None, value: str = "n_calls", label: str = "species"
) -> DataFrame:
    if n is None:
        return counts
    return counts.join(top_n_global(counts, n, value, label), label, "left_semi")


def pivot_wide(
    df: DataFrame, rows: str, columns: str, value: str, names: Sequence[str] | None = None
) -> DataFrame:
    """One column per name, missing cells 0.

    Without ``names`` Spark looks up the distinct ones first, and refuses more than
    ``spark.sql.pivotMaxValues``.
    """
    grouped = df.groupBy(rows)
    wide = grouped.pivot(columns, list(names)) if names else grouped.pivot(columns)
    return wide.agg(F.sum(value)).na.fill(0)


def _cell_texts(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    return [F.col(c).cast("string").alias(c) for c in columns]


def one_row_to_pairs(df: DataFrame, key: str = "metric", value: str = "value") -> DataFrame:
    """A one-row table as (name, text) pairs."""
    return df.select(*_cell_texts(df, df.columns)).unpivot([], df.columns, key, value)


def study_overview(study: DataFrame, labels: Mapping[str, str] = K.STUDY_METRIC_LABELS) -> DataFrame:
    """The one-row study summary as (position, Metric, Value) with display formats."""

    def text(name: str) -> Column:
        x = F.col(name)
        if name.startswith("study_") and not name.endswith("days"):
            shown = x.cast("string")
        elif name.startswith("pct_") or name.endswith("_pct"):
            number = round_nearest(x, 1).cast("string")
            shown = F.concat(F.regexp_replace(number, r"\.0$", ""), F.lit("%"))
        elif name.endswith("_cph"):
            shown = fixed(x, 1)
        elif name == "total_hours":
            shown = fixed(x, 1)
        else:
            shown = F.format_number(x, 0)
        return F.coalesce(shown, F.lit(""))

    present = [c for c in labels if c in study.columns]
    cells = [
        F.struct(F.lit(i).alias("position"), F.lit(labels[c]).alias("Metric"), text(c).alias("Value"))
        for i, c in enumerate(present, 1)
    ]
    return study.select(F.inline(F.array(*cells)))


def completed(
    counts: DataFrame, left: str, right: str, fill: Sequence[str] = ("n_calls",)
) -> DataFrame:
    """All combinations of the two labels found in ``counts``; new ones filled with 0.

    Right-hand labels are numbered.  Each left label keeps the numbers it has, block by
    block, and unfolds those it lacks; rows that are there are not joined to anything.
    A row without a right-hand label is left out.
    """
    rows = counts.where(F.col(right).isNotNull())
    distinct = rows.select(right).distinct().withColumn("_all", F.lit(1))
    numbered = running_folds(distinct, ["_all"], [right], {"_code": (F.lit(1), "sum")}, "labels").drop("_all")
    numbered = materialize(numbered, "label-numbers")
    n = numbered.count()
    block = F.floor(F.col("_code") / LABEL_BLOCK)
    rows = materialize(rows.join(numbered, right).select(*counts.columns, "_code"), "label-counts")
    present = rows.groupBy(left, block.alias("_block")).agg(F.collect_set("_code").alias("_present"))
    blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n // LABEL_BLOCK).cast("long"))).alias("_block")
    spine = rows.select(left).distinct().select(left, blocks)
    same = spine[left].eqNullSafe(present[left]) & (spine["_block"] == present["_block"])
    first = F.greatest(F.col("_block") * LABEL_BLOCK, F.lit(1))
    last = F.least((F.col("_block") + 1) * LABEL_BLOCK - 1, F.lit(n))
    every = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    absent = spine.join(present, same, "left").select(spine[left], spine["_block"], "_present").select(
        left, F.explode(F.array_except(every, F.coalesce("_present", F.array().cast("array<bigint>")))).alias("_code")
    )
    new = absent.join(numbered, "_code").select(left, right)
    return rows.drop("_code").unionByName(new, allowMissingColumns=True).na.fill(0, list(fill))


def completed_hours(
    counts: DataFrame, label: str | None = None, fill: Sequence[str] = ("n_calls",)
) -> DataFrame:
    """Hours 0 to 23 for every label (or once), new ones filled with 0."""
    hours = F.explode(F.sequence(F.lit(0), F.lit(23))).alias("Hour_local")
    if label is None:
        spine = counts.sparkSession.range(1).select(hours)
        return spine.join(counts, "Hour_local", "left").na.fill(0, list(fill))
    spine = counts.select(label).distinct().select(label, hours)
    return spine.join(counts, [label, "Hour_local"], "left").na.fill(0, list(fill))


def _rounded(df: DataFrame, name: str, digits: int | None) -> DataFrame:
    """Round by name in a second step: rounding repeats its operand, and the operand
    holds a window or a subquery."""
    return df if digits is None else round_columns(df, {name: digits})


def share_of_group(df: DataFrame, group: str, value: str, name: str, digits: int | None = 1) -> DataFrame:
    """value as a percentage of its group's sum.

    For aggregated tables whose groups are bounded, such as the nights of a detector.
    """
    total = F.sum(value).over(Window.partitionBy(group))
    return _rounded(df.withColumn(name, percent(value, total, None)), name, digits)


def share_of_total(df: DataFrame, value: str, name: str, digits: int | None = 1) -> DataFrame:
    """value as a percentage of the whole sum, which is a scalar subquery."""
    total = df.agg(F.sum(value)).scalar()
    return _rounded(df.withColumn(name, percent(value, total, None)), name, digits)


def peak_flag(hourly: DataFrame) -> DataFrame:
    """Hour label and a flag for the hour(s) with the most calls."""
    most = hourly.agg(F.max("n_calls")).scalar()
    flag = F.coalesce((F.col("n_calls") == most) & (F.col("n_calls") > 0), F.lit(False))
    return hourly.select(
        F.format_string("%02d:00", "Hour_local").alias("Hour"),
        *[c for c in hourly.columns if c != "Hour_local"],
        flag.alias("is_peak"),
    )


def rank_abundance(counts: DataFrame) -> DataFrame:
    """Species numbered by falling count.  The input has one row per species."""
    window = Window.orderBy(F.desc("n_calls"), F.asc("species"))
    return counts.withColumn("rank", F.row_number().over(window))


def rows_in_group(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach the number of rows that share the key; NULL keys equal each other."""
    return count_in_group(df, keys, "n_occurrences")
