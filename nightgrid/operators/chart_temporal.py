"""Data behind the temporal charts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from nightgrid.functions.times import iso_week, month_floor, week_floor
from nightgrid.operators.condense import n_calls
from nightgrid.operators.quantiles import exact_percentiles
from nightgrid.operators.reshape import completed_hours
from nightgrid.operators.summaries import sum_or_zero
from nightgrid.sources.scratch import materialize

DEFAULT_BINS = 30
#: Empty bins on end of a histogram.
MAX_BINS = 100_000


def cumulative_calls_by_detector(grid: DataFrame) -> DataFrame:
    """Running calls by night within each detector; a missing count adds nothing."""
    window = (
        Window.partitionBy("Detector")
        .orderBy("Night")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    running = F.sum(F.coalesce("CallsPerNight", F.lit(0))).over(window)
    return grid.select("Detector", "Night", "CallsPerNight", running.alias("cumulative_calls"))


def cumulative_calls_study(grid: DataFrame) -> DataFrame:
    """Nightly totals and their running sum: one row per night is all that is ordered."""
    nightly = grid.groupBy("Night").agg(sum_or_zero("CallsPerNight").alias("daily_total"))
    running = F.sum("daily_total").over(
        Window.orderBy("Night").rowsBetween(Window.unboundedPreceding, 0)
    )
    return nightly.withColumn("cumulative_calls", running)


def hourly_profile(master: DataFrame, metric: str = "total") -> DataFrame:
    """Activity for each of 24 hours and the first hour that reaches the maximum.

    'total' counts calls.  'mean' averages the calls of a calendar date and hour
    over the dates on which that hour had any.
    """
    hour = F.col("Hour_local").cast("int").alias("Hour_local")
    if metric == "total":
        activity = master.groupBy(hour).agg(n_calls(master).alias("activity"))
    elif metric == "mean":
        daily = master.groupBy(F.to_date("DateTime_local").alias("day"), hour).agg(
            n_calls(master).alias("n")
        )
        activity = daily.groupBy("Hour_local").agg(F.avg("n").alias("activity"))
    else:
        raise ValueError(f"metric must be 'total' or 'mean', not {metric!r}")
    full = completed_hours(activity, None, ["activity"])
    first_peak = F.struct("activity", (-F.col("Hour_local")).alias("h"))
    peak = full.agg(-F.max(first_peak)["h"]).scalar()
    return full.withColumn("peak_hour", peak)


def calls_per_hour_histogram(grid: DataFrame, binwidth: float | None = None, empty_bins: bool = True) -> DataFrame:
    """Counts per bin of the hourly rate, with the mean and median of all rates.

    Bins are closed on the right.  A given width centres bins on its multiples;
    without one, 30 bins run from the smallest to the largest rate.  Bins between others
    that have no rate count 0; ``MAX_BINS`` of them are an error, which ``empty_bins=False`` avoids.

    The rates are scanned once and counted per value; all else comes from these counts.
    """
    rates = grid.select(F.col("CallsPerHour").cast("double").alias("x")).where(
        F.col("x").isNotNull() & ~F.isnan("x") & (F.abs("x") != float("inf"))
    )
    values = materialize(rates.groupBy("x").agg(F.count("*").alias("n")), "rates")
    facts = values.agg(F.min("x").alias("low"), F.max("x").alias("high"), (F.sum(F.col("x") * F.col("n")) / F.sum("n")).alias("mean")).first()
    if binwidth is None:
        spread = (facts.high - facts.low) / (DEFAULT_BINS - 1) if facts.low is not None else 0.0
        low, width = F.lit(facts.low).cast("double"), F.lit(spread if spread > 0 else 0.1)
    else:
        low, width = F.lit(0.0), F.lit(float(binwidth))
    step = F.ceil((F.col("x") - low) / width - 0.5)
    bins = values.groupBy(step.alias("bin")).agg(F.sum("n").alias("n"))
    if empty_bins:
        following = F.coalesce(F.lead("bin").over(Window.orderBy("bin")), F.col("bin") + 1)
        gaps = bins.select("bin", "n", following.alias("next"))
        too_many = F.col("next") - F.col("bin") > MAX_BINS
        end = F.when(too_many, F.raise_error(F.lit("too many empty bins; give a larger width"))).otherwise(F.col("next") - 1)
        unfolded = gaps.select(F.col("bin").alias("own"), "n", F.explode(F.sequence("bin", end)).alias("bin"))
        bins = unfolded.select("bin", F.when(F.col("bin") == F.col("own"), F.col("n")).otherwise(0).alias("n"))
    median = exact_percentiles(values, {"x": [0.5]}, weight="n").first()[0]
    return bins.select(
        (low + F.col("bin") * width).alias("bin_center"), "n",
        F.lit(facts["mean"]).cast("double").alias("mean_cph"), F.lit(median).cast("double").alias("median_cph"),
    )


def weekly_activity(
    grid: DataFrame, by_detector: bool = False, week_start: str = "sunday"
) -> DataFrame:
    week = week_floor("Night", week_start)
    keys = (["Detector"] if by_detector else []) + [week.alias("Week")]
    return grid.groupBy(*keys).agg(
        sum_or_zero("CallsPerNight").alias("total_calls"),
        F.count("*").alias("n_nights"),
        F.avg("CallsPerNight").alias("mean_calls"),
        iso_week(F.min("Night")).alias("first_iso_week"),
    )


def monthly_activity(grid: DataFrame, by_detector: bool = False) -> DataFrame:
    keys = (["Detector"] if by_detector else []) + [month_floor("Night").alias("Month")]
    return grid.groupBy(*keys).agg(
        sum_or_zero("CallsPerNight").alias("total_calls"), F.count("*").alias("n_nights")
    )
