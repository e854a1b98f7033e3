"""Data behind the recording-quality charts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from nightgrid import constants as K
from nightgrid.functions.numbers import fixed, share, thousands
from nightgrid.operators.grid import has_effort, night_span
from nightgrid.operators.summaries import sum_or_zero


def status_rank(status: str = "Status") -> Column:
    """1, 2, 3 for Success, Partial, Fail."""
    return F.array_position(F.array(*[F.lit(s) for s in K.STATUS_LEVELS]), F.col(status))


def status_by_detector(grid: DataFrame) -> DataFrame:
    """Nights and share per detector and status, with the detector's chart position.

    Detectors are ordered by their share of successful nights; one without any
    counts as 0.  Each detector has at most three rows here.
    """
    counts = grid.groupBy("Detector", "Status").agg(F.count("*").alias("n_nights"))
    group = Window.partitionBy("Detector")
    total = F.sum("n_nights").over(group)
    good = F.when(F.col("Status") == "Success", F.col("n_nights"))
    return counts.select(
        "Detector", "Status", "n_nights", total.alias("total_nights"),
        share("n_nights", total).alias("pct"),
        F.coalesce(share(F.max(good).over(group), total), F.lit(0.0)).alias("pct_success"),
    ).orderBy(F.desc("pct_success"), "Detector", status_rank())


def label_midpoint(status: DataFrame) -> DataFrame:
    """Middle of each stacked segment: running nights minus half of the own ones."""
    window = (
        Window.partitionBy("Detector")
        .orderBy(status_rank().desc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    running = F.sum("n_nights").over(window)
    return status.select(
        "Detector", "Status", "n_nights",
        running.alias("cumulative_nights"),
        (running - F.col("n_nights") / 2).alias("label_y"),
    )


def status_overall(grid: DataFrame) -> DataFrame:
    counts = grid.groupBy("Status").agg(F.count("*").alias("n_nights"))
    total = counts.agg(F.sum("n_nights")).scalar()
    shares = counts.withColumn("pct", share("n_nights", total))
    label = F.concat(
        "Status", F.lit("\n"), thousands("n_nights"), F.lit(" ("), fixed("pct", 1), F.lit("%)")
    )
    return shares.withColumn("label", label).orderBy(status_rank())


def effort_by_detector(grid: DataFrame) -> DataFrame:
    hours = grid.groupBy("Detector").agg(
        sum_or_zero("RecordingHours").alias("total_hours"),
        F.count("*").alias("n_nights"),
        F.avg("RecordingHours").alias("mean_hours"),
    )
    mean = hours.agg(F.avg("total_hours")).scalar()
    return hours.withColumn("study_mean_hours", mean)


def nights_by_detector(grid: DataFrame, threshold: int | None = None) -> DataFrame:
    nights = grid.groupBy("Detector").agg(F.count_if(has_effort()).alias("n_nights"))
    if threshold is None:
        return nights
    return nights.withColumn("below_threshold", F.col("n_nights") < threshold)


def missing_nights(
    grid: DataFrame, expected: str = "distinct", drop_silent: bool = False
) -> DataFrame:
    """Nights with data against nights expected, per detector.

    ``expected`` is 'distinct' (nights that occur) or 'span' (first to last).
    ``drop_silent`` leaves out detectors without a single good night.
    """
    if expected == "distinct":
        wanted = grid.where(F.col("Night").isNotNull()).select("Night").distinct()
        wanted = wanted.agg(F.count("*")).scalar()
    elif expected == "span":
        first, last = night_span(grid)
        wanted = F.datediff(last, first) + 1
    else:
        raise ValueError(f"expected must be 'distinct' or 'span', not {expected!r}")
    good = F.when(has_effort(), F.col("Night"))
    nights = grid.groupBy("Detector").agg(F.countDistinct(good).alias("actual_nights"))
    if drop_silent:
        nights = nights.where(F.col("actual_nights") > 0)
    return nights.withColumn("expected_nights", wanted.cast("bigint")).select(
        "Detector", "actual_nights", "expected_nights",
        F.greatest(F.col("expected_nights") - F.col("actual_nights"), F.lit(0)).alias("missing_nights"),
        share("actual_nights", "expected_nights").alias("pct_complete"),
    )
