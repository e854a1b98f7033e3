"""Differences between the original and the edited effort template."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from nightgrid.functions.numbers import fixed
from nightgrid.functions.times import log_text, parse_month_first, seconds_between
from nightgrid.sources.scratch import materialize

SIDES = ("StartDateTime", "EndDateTime")
KINDS = ("changed", "added", "removed")


def template_edit_diff(original: DataFrame, edited: DataFrame) -> DataFrame:
    """One row per (Detector, Night) in both templates, with a flag per kind of edit.

    A time counts as changed when it moved by more than one second.
    """
    before = original.select(
        "Detector", "Night",
        *[parse_month_first(side).alias(f"{side}_orig") for side in SIDES],
    )
    after = edited.select(
        "Detector", "Night",
        *[parse_month_first(side).alias(f"{side}_edit") for side in SIDES],
        F.col("RecordingHours").alias("RecordingHours_edit"),
    )
    joined = before.join(after, ["Detector", "Night"], "inner")
    flags: dict[str, Column] = {}
    for side in SIDES:
        old, new = F.col(f"{side}_orig"), F.col(f"{side}_edit")
        moved = F.abs(seconds_between(old, new)) > 1
        flags[f"{side}_changed"] = F.coalesce(moved, F.lit(False))
        flags[f"{side}_added"] = old.isNull() & new.isNotNull()
        flags[f"{side}_removed"] = old.isNotNull() & new.isNull()
    joined = joined.withColumns(flags)
    any_change = F.lit(False)
    for name in flags:
        any_change = any_change | F.col(name)
    return joined.withColumn("Any_change", any_change)


def edit_counts(diff: DataFrame) -> DataFrame:
    """One row: the number of rows with any edit, and with each kind."""
    kinds = [f"{side}_{kind}" for side in SIDES for kind in KINDS]
    return diff.agg(
        F.count_if("Any_change").alias("total_edits"),
        *[F.count_if(k).alias(f"n_{k}") for k in kinds],
    )


def _side_text(side: str) -> Column:
    old, new = log_text(f"{side}_orig"), log_text(f"{side}_edit")

    def line(kind: str) -> Column:
        return F.concat(F.lit(f"\n    {side} {kind.upper()}: "), old, F.lit(" -> "), new)

    text = F.lit("")
    for kind in reversed(KINDS):
        text = F.when(F.col(f"{side}_{kind}"), line(kind)).otherwise(text)
    return text


def edit_log(diff: DataFrame) -> DataFrame:
    """Numbered, ordered log entries of the edited rows.

    The rows are ranged over tasks and written once; their numbers are places within
    their range, shifted by the sizes of the ranges before.  Only one count per range is
    ordered in one task.
    """
    ranged = (
        diff.where("Any_change").repartitionByRange("Detector", "Night").sortWithinPartitions("Detector", "Night")
        .withColumn("_id", F.monotonically_increasing_id())
    )
    rows = materialize(ranged, "edit-log").withColumn("_range", F.shiftright("_id", 33))
    sizes = rows.groupBy("_range").agg(F.count("*").alias("_n"), F.min("_id").alias("_first"))
    before = F.sum("_n").over(Window.orderBy("_range")) - F.col("_n")
    # One row per range, as many as shuffle partitions.
    shift = F.broadcast(sizes.select("_range", "_first", before.alias("_before")))
    rows = rows.join(shift, "_range").withColumn("edit_no", F.col("_before") + F.col("_id") - F.col("_first") + 1)
    hours = F.coalesce(fixed("RecordingHours_edit", 2), F.lit("NA"))
    entry = F.concat(
        F.lit("["), F.col("edit_no").cast("string"), F.lit("] "),
        F.col("Detector"), F.lit(" | "), F.col("Night").cast("string"),
        _side_text("StartDateTime"), _side_text("EndDateTime"),
        F.lit("\n    RecordingHours: "), hours, F.lit("\n"),
    )
    return rows.select(
        "edit_no", "Detector", "Night", entry.alias("entry")
    )
