"""The dense detector x night grid, its schedule, status and rates.

A grid holds one row per detector and calendar night, so a per-detector group is
bounded by the length of the study and never by the number of detections.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column, DataFrame, Window, functions as F

from nightgrid import constants as K
from nightgrid.config import Schedule
from nightgrid.functions.times import recording_hours, schedule_texts, week_floor
from nightgrid.operators.condense import n_calls

KEYS = ["Detector", "Night"]


def calls_per_night(master: DataFrame) -> DataFrame:
    return master.groupBy(*KEYS).agg(n_calls(master).alias("CallsPerNight"))


def night_span(df: DataFrame, most: int | None = None) -> tuple[Column, Column]:
    """First and last night, both from one scalar subquery; an error where they lie more than ``most`` nights apart."""
    first, last = F.min("Night"), F.max("Night")
    if most is not None:
        text = F.concat(F.lit("nights from "), first.cast("string"), F.lit(" to "), last.cast("string"), F.lit(": give the study dates"))
        last = F.when(F.datediff(last, first) > most, F.raise_error(text).cast("date")).otherwise(last)
    span = df.agg(F.struct(first.alias("first"), last.alias("last"))).scalar()
    return span["first"], span["last"]


def _bounds(
    df: DataFrame, start_date: str | None, end_date: str | None
) -> tuple[Column, Column]:
    """The study dates as literals; a missing one is looked up in the data.

    Dates from the data that lie more than ``MAX_STUDY_NIGHTS`` apart are an error: a single wrong date
    would unfold a night for each day up to it, for every detector.
    """
    first = last = None
    if start_date is None or end_date is None:
        first, last = night_span(df, K.MAX_STUDY_NIGHTS)
    if start_date is not None:
        first = F.lit(start_date).cast("date")
    if end_date is not None:
        last = F.lit(end_date).cast("date")
    return first, last


def night_runs(rows: DataFrame) -> DataFrame:
    """(Detector, first, last, n_nights): nights on end of each detector as one row.

    A study of any length is as many rows as it has interruptions.
    """
    nights = rows.where(F.col("Detector").isNotNull() & F.col("Night").isNotNull()).select(*KEYS).distinct()
    place = F.row_number().over(Window.partitionBy("Detector").orderBy("Night"))
    island = nights.withColumn("_island", F.date_sub("Night", place))
    return island.groupBy("Detector", "_island").agg(
        F.min("Night").alias("first"), F.max("Night").alias("last"), F.count("*").alias("n_nights")
    ).drop("_island")


def nights_outside(rows: DataFrame, start_date: str, end_date: str) -> DataFrame:
    """The parts of runs that lie before or after the study dates: (Detector, first, last, n_nights, side)."""
    start, end = F.lit(start_date).cast("date"), F.lit(end_date).cast("date")
    early = F.struct(F.col("first"), F.least("last", F.date_sub(start, 1)).alias("last"), F.lit("before").alias("side"))
    late = F.struct(F.greatest("first", F.date_add(end, 1)).alias("first"), F.col("last"), F.lit("after").alias("side"))
    parts = night_runs(rows).select("Detector", F.inline(F.array(early, late))).where(F.col("first") <= F.col("last"))
    return parts.select("Detector", "first", "last", (F.datediff("last", "first") + 1).alias("n_nights"), "side")


def missing_runs(rows: DataFrame, start_date: str, end_date: str) -> DataFrame:
    """Nights on end that a detector lacks within the study dates: (Detector, first, last, n_nights).

    Every detector of ``rows`` is there, also one without any night; nothing is unfolded.
    """
    start, end = F.lit(start_date).cast("date"), F.lit(end_date).cast("date")
    detectors = rows.where(F.col("Detector").isNotNull()).select("Detector").distinct()
    inside = night_runs(rows).where((F.col("last") >= start) & (F.col("first") <= end))
    # The study's edges are runs without a night, and gaps lie between neighbours.
    edges = detectors.select("Detector", F.date_sub(start, 1).alias("first"), F.date_sub(start, 1).alias("last"))
    runs = inside.select("Detector", F.greatest("first", start).alias("first"), "last").unionByName(edges)
    following = F.lead("first").over(Window.partitionBy("Detector").orderBy("first"))
    gaps = runs.select("Detector", F.date_add("last", 1).alias("first"), F.least(F.date_sub(following, 1), end).alias("last"))
    gaps = gaps.withColumn("last", F.coalesce("last", end)).where(F.col("first") <= F.col("last"))
    return gaps.withColumn("n_nights", F.datediff("last", "first") + 1)


def detector_nights(
    rows: DataFrame, start_date: str | None = None, end_date: str | None = None
) -> DataFrame:
    """Every detector in ``rows`` with every night from first to last.

    Each detector unfolds its own nights: no join, and the expansion is bounded by
    the calendar.  NULL detectors are left out.
    """
    first, last = _bounds(rows, start_date, end_date)
    detectors = rows.select("Detector").where(F.col("Detector").isNotNull()).distinct()
    return detectors.select("Detector", F.explode(F.sequence(first, last)).alias("Night"))


def fill_nights(
    rows: DataFrame,
    fill: Mapping[str, Any],
    start_date: str | None = None,
    end_date: str | None = None,
) -> DataFrame:
    """Insert the missing nights of every detector, with the given fill values.

    Each row unfolds the gap up to the detector's next night, so the dense grid needs
    neither a join nor a second look at the input.  Nights outside the dates are dropped,
    and so are rows without a night; their detectors are not.  Of repeated rows of a
    night each stays, and the last of them unfolds the gap.
    """
    first, last = _bounds(rows, start_date, end_date)
    nights = Window.partitionBy("Detector").orderBy("Night")
    # Rows without a night come first; one of them may open a detector, the rest go.
    kept = (
        rows.where(F.col("Detector").isNotNull()).select(*KEYS, *fill)
        .withColumn("_place", F.row_number().over(nights))
        .where((F.col("_place") == 1) | F.col("Night").isNotNull())
    )
    found = kept.select(
        *KEYS, *fill, first.alias("_first"), last.alias("_last"), (F.col("_place") == 1).alias("_opens"),
        F.lead("Night").over(nights).alias("_next"),
    )
    start = F.when(F.col("_opens"), F.col("_first")).otherwise(F.greatest("Night", "_first"))
    before_next = F.when(F.col("_next") == F.col("Night"), F.col("Night")).otherwise(F.date_sub("_next", 1))
    end = F.least(F.coalesce(before_next, F.col("_last")), F.col("_last"))
    gaps = found.withColumns({"_start": start, "_end": end}).where(
        F.col("_start") <= F.col("_end")
    )
    unfolded = gaps.withColumn("_night", F.explode(F.sequence("_start", "_end")))
    own = F.col("_night") == F.col("Night")
    values = [F.when(own, F.col(c)).otherwise(F.lit(v)).alias(c) for c, v in fill.items()]
    return unfolded.select("Detector", F.col("_night").alias("Night"), *values)


def attach_counts(grid: DataFrame, counts: DataFrame) -> DataFrame:
    joined = grid.join(counts.select(*KEYS, "CallsPerNight"), KEYS, "left")
    return joined.withColumn("CallsPerNight", F.coalesce("CallsPerNight", F.lit(0)))


def effort_warning(grid: DataFrame) -> DataFrame:
    text = F.when(F.col("CallsPerNight") == 0, F.lit(K.NO_CALLS_WARNING))
    return grid.withColumn("Warning", text)


def attach_schedule(
    grid: DataFrame, schedule: Schedule | None = None, per_detector: DataFrame | None = None
) -> DataFrame:
    """StartTime and EndTime: per detector from a table, else the same for all."""
    if per_detector is not None:
        side = per_detector.select("Detector", "StartTime", "EndTime")
        return grid.join(side, "Detector", "left")
    if schedule is None:
        raise ValueError("give a uniform schedule or a table of schedules")
    return grid.withColumns(
        {"StartTime": F.lit(schedule.start), "EndTime": F.lit(schedule.end)}
    )


def scheduled_hours(grid: DataFrame) -> DataFrame:
    return grid.withColumn("RecordingHours", recording_hours("StartTime", "EndTime"))


def schedule_datetimes(grid: DataFrame) -> DataFrame:
    start, end = schedule_texts("Night", "StartTime", "EndTime")
    return grid.withColumns({"StartDateTime": start, "EndDateTime": end})


def build_template(
    master: DataFrame,
    start_date: str | None,
    end_date: str | None,
    schedule: Schedule | None = None,
    per_detector: DataFrame | None = None,
) -> DataFrame:
    """Counts, grid and schedule in one: the table people edit."""
    grid = fill_nights(calls_per_night(master), {"CallsPerNight": 0}, start_date, end_date)
    grid = scheduled_hours(attach_schedule(grid, schedule, per_detector))
    return schedule_datetimes(grid).select(
        *KEYS, "CallsPerNight", "StartDateTime", "EndDateTime", "RecordingHours"
    )


def sanitize_hours(grid: DataFrame) -> DataFrame:
    hours = F.greatest(F.coalesce(F.col("RecordingHours"), F.lit(0.0)), F.lit(0.0))
    return grid.withColumn("RecordingHours", hours)


def classify_status(
    grid: DataFrame, intended_hours: float | None, own_schedules: bool = False
) -> DataFrame:
    hours = F.col("RecordingHours")
    status = F.when(hours.isNull() | (hours == 0), "Fail")
    if own_schedules:
        status = status.otherwise("Success")
    elif intended_hours is None:
        status = status.otherwise("Partial")
    else:
        close = F.abs(hours - F.lit(float(intended_hours))) < K.STATUS_TOLERANCE_HOURS
        status = status.when(close, "Success").otherwise("Partial")
    return grid.withColumn("Status", status)


def calls_per_hour(grid: DataFrame) -> DataFrame:
    hours = F.col("RecordingHours")
    rate = F.when(hours > 0, F.col("CallsPerNight") / hours)
    return grid.withColumn("CallsPerHour", rate)


def finalize_grid(
    edited: DataFrame, intended_hours: float | None, own_schedules: bool = False
) -> DataFrame:
    """Hours from the edited times, then status and rate."""
    if {"StartDateTime", "EndDateTime"} <= set(edited.columns):
        hours = recording_hours("StartDateTime", "EndDateTime")
        edited = edited.withColumn("RecordingHours", hours)
    grid = classify_status(sanitize_hours(edited), intended_hours, own_schedules)
    return calls_per_hour(grid)


def suspicious_calls(grid: DataFrame, max_calls: int = K.MAX_PLAUSIBLE_CALLS) -> DataFrame:
    """Rows with missing, negative or implausibly many calls, with the reason."""
    calls = F.col("CallsPerNight")
    reason = (
        F.when(calls.isNull(), "missing")
        .when(calls < 0, "negative")
        .when(calls > max_calls, "excessive")
    )
    return grid.withColumn("reason", reason).where(F.col("reason").isNotNull())


def has_effort() -> Column:
    return F.coalesce(F.col("RecordingHours") > 0, F.lit(False))


def complete_grid_coverage(
    grid: DataFrame, week_start: str = "sunday", start_date: str | None = None, end_date: str | None = None
) -> DataFrame:
    """Every detector and night of the study dates, or of the span, with a flag "has data", and its week."""
    known = grid.groupBy(*KEYS).agg(F.bool_or(has_effort()).alias("has_data"))
    week = week_floor("Night", week_start).alias("week")
    return fill_nights(known, {"has_data": False}, start_date, end_date).select(*KEYS, "has_data", week)


def effort_grid(grid: DataFrame, start_date: str | None = None, end_date: str | None = None) -> DataFrame:
    """Every detector and night of the study dates, or of the span, with its hours, NULL where no row is."""
    return fill_nights(grid, {"RecordingHours": None}, start_date, end_date)
