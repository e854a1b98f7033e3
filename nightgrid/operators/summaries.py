"""The summary tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from nightgrid import constants as K
from nightgrid.functions.numbers import as_column, percent, round_columns
from nightgrid.operators.condense import n_calls
from nightgrid.operators.contracts import cpn_contract, master_contract, require_columns
from nightgrid.operators.quantiles import exact_percentiles
from nightgrid.operators.reshape import share_of_group, share_of_total


def sum_or_zero(value) -> Column:
    return F.coalesce(F.sum(as_column(value)), F.lit(0))


def status_percents() -> list[Column]:
    return [
        percent(F.count_if(F.col("Status") == s), F.count("*"), None).alias(f"pct_{s.lower()}")
        for s in K.STATUS_LEVELS
    ]


def _spread(value: str, suffix: str, prefix: str = "", median: bool = True) -> list[Column]:
    pieces = {
        "mean": F.avg(value), "median": F.median(value), "sd": F.stddev_samp(value),
        "min": F.min(value), "max": F.max(value),
    }
    if not median:
        del pieces["median"]
    return [x.alias(f"{prefix}{name}_{suffix}") for name, x in pieces.items()]


def _digits(suffix: str, digits: int, prefix: str = "") -> dict[str, int]:
    return {f"{prefix}{name}_{suffix}": digits for name in ("mean", "median", "sd", "min", "max")}


_PERCENTS = {"pct_success": 1, "pct_partial": 1, "pct_fail": 1}


def detector_activity_summary(grid: DataFrame) -> DataFrame:
    """Effort, activity and variability per detector, one aggregate."""
    cpn_contract(grid, status=True, rate=True)
    rate = F.col("CallsPerHour")
    stats = grid.groupBy("Detector").agg(
        F.count("*").alias("n_nights"),
        sum_or_zero("RecordingHours").alias("total_hours"),
        F.avg("RecordingHours").alias("mean_hours"),
        *status_percents(),
        sum_or_zero("CallsPerNight").alias("total_calls"),
        *_spread("CallsPerNight", "cpn"),
        *_spread("CallsPerHour", "cph"),
        percent(F.stddev_samp(rate), F.avg(rate), None).alias("cv_pct"),
        percent(F.count_if(F.col("CallsPerNight") == 0), F.count("*"), None).alias("pct_zero"),
        F.min("Night").alias("first_night"),
        F.max("Night").alias("last_night"),
    )
    return round_columns(
        stats,
        {
            "total_hours": 1, "mean_hours": 1, **_PERCENTS,
            **_digits("cpn", 1), **_digits("cph", 2), "cv_pct": 1, "pct_zero": 1,
        },
    )


def coefficient_of_variation(grid: DataFrame) -> DataFrame:
    require_columns(grid, ["Detector", "CallsPerNight"])
    mean, sd = F.avg("CallsPerNight"), F.stddev_samp("CallsPerNight")
    return grid.groupBy("Detector").agg(
        mean.alias("mean_calls"), sd.alias("sd_calls"), F.try_divide(sd, mean).alias("cv")
    )


def effort_summary(grid: DataFrame) -> DataFrame:
    require_columns(grid, ["Detector", "Night", "RecordingHours"])
    hours = F.col("RecordingHours")
    with_data = F.count_if(hours > 0)
    stats = grid.groupBy("Detector").agg(
        F.count("*").alias("total_nights"),
        with_data.alias("nights_with_data"),
        sum_or_zero(hours).alias("total_recording_hours"),
        percent(with_data, F.count("*"), None).alias("percent_nights_with_data"),
        F.avg(hours).alias("mean_hours_per_night"),
        F.concat_ws(
            " to ", F.min("Night").cast("string"), F.max("Night").cast("string")
        ).alias("date_range"),
    )
    return round_columns(
        stats,
        {"total_recording_hours": 1, "percent_nights_with_data": 1, "mean_hours_per_night": 2},
    )


def study_summary(grid: DataFrame) -> DataFrame:
    """One row over the whole grid.

    The overall variability divides the already rounded sd and mean.  Medians come
    from a distributed quantile: ``median`` over all rows would need one task.
    """
    cpn_contract(grid, status=True, rate=True)
    medians = exact_percentiles(grid, {"CallsPerNight": [0.5], "CallsPerHour": [0.5]})
    medians = medians.select(
        F.struct(
            F.col("CallsPerNight_p0").alias("cpn"), F.col("CallsPerHour_p0").alias("cph")
        ).alias("m")
    ).scalar()
    row = grid.agg(
        F.countDistinct("Detector").alias("n_detectors"),
        F.count("*").alias("n_detector_nights"),
        F.min("Night").alias("study_start"),
        F.max("Night").alias("study_end"),
        sum_or_zero("CallsPerNight").alias("total_calls"),
        sum_or_zero("RecordingHours").alias("total_hours"),
        *_spread("CallsPerNight", "cpn", "overall_", median=False),
        *_spread("CallsPerHour", "cph", "overall_", median=False),
        *status_percents(),
    ).withColumn("_medians", medians)
    row = row.withColumns(
        {
            "overall_median_cpn": F.col("_medians.cpn"),
            "overall_median_cph": F.col("_medians.cph"),
            "study_duration_days": F.datediff("study_end", "study_start") + 1,
        }
    )
    cpn, cph = _digits("cpn", 1, "overall_"), _digits("cph", 2, "overall_")
    row = round_columns(row, {"total_hours": 1, **_PERCENTS, **cpn, **cph})
    return row.select(
        "n_detectors", "n_detector_nights", "study_start", "study_end", "study_duration_days",
        "total_calls", "total_hours", *cpn, *cph,
        percent("overall_sd_cph", "overall_mean_cph").alias("overall_cv_pct"),
        *_PERCENTS,
    )


def variance_components(grid: DataFrame) -> DataFrame:
    """Total variance, variance of detector means and mean variance within detectors."""
    cpn_contract(grid, rate=True)
    groups = grid.groupBy("Detector").agg(
        F.avg("CallsPerHour").alias("mean"), F.var_samp("CallsPerHour").alias("variance")
    )
    parts = groups.agg(
        F.var_samp("mean").alias("between"), F.avg("variance").alias("within")
    )
    total = grid.agg(F.var_samp("CallsPerHour")).scalar()
    table = parts.withColumn("total", total).select(
        F.col("total").alias("var_total"),
        F.col("between").alias("var_between"),
        F.col("within").alias("var_within"),
        percent("between", "total", None).alias("pct_between"),
        percent("within", "total", None).alias("pct_within"),
    )
    return round_columns(
        table,
        {"var_total": 2, "var_between": 2, "var_within": 2, "pct_between": 1, "pct_within": 1},
    )


def species_by_detector(master: DataFrame) -> DataFrame:
    master_contract(master)
    counts = (
        master.where(F.col("species").isNotNull())
        .groupBy("Detector", "species")
        .agg(n_calls(master).alias("n_calls"))
    )
    return share_of_group(counts, "Detector", "n_calls", "pct_of_detector").orderBy(
        "Detector", F.desc("n_calls"), "species"
    )


def first_detections(master: DataFrame) -> DataFrame:
    return master.groupBy("species").agg(F.min("Night").alias("first_night"))


def species_accumulation(master: DataFrame) -> DataFrame:
    """New species per night and the running number of species."""
    master_contract(master)
    known = master.where(
        F.col("species").isNotNull() & ~F.col("species").isin(*K.ACCUMULATION_EXCLUDED)
    )
    nights = (
        first_detections(known)
        .groupBy(F.col("first_night").alias("Night"))
        .agg(
            F.count("*").alias("new_species"),
            F.array_join(F.array_sort(F.collect_list("species")), ", ").alias("new_species_list"),
        )
    )
    running = F.sum("new_species").over(
        Window.orderBy("Night").rowsBetween(Window.unboundedPreceding, 0)
    )
    return nights.withColumn("cumulative_species", running)


def hourly_activity(master: DataFrame) -> DataFrame:
    master_contract(master)
    counts = master.groupBy("Hour_local").agg(n_calls(master).alias("n_calls"))
    return share_of_total(counts, "n_calls", "pct_of_total").orderBy("Hour_local")


def module_headline_counts(master: DataFrame, grid: DataFrame) -> DataFrame:
    """Totals of a run, one row."""
    species = master.select("species").distinct().agg(F.count("species")).scalar()
    return grid.groupBy("Detector").agg(
        F.count("*").alias("cells"),
        F.sum("CallsPerNight").alias("calls"),
        F.sum("RecordingHours").alias("hours"),
        F.count_if(F.col("Status") == "Fail").alias("dead"),
        F.min("Night").alias("first"), F.max("Night").alias("last"),
    ).agg(
        F.count("Detector").alias("n_detectors"),
        sum_or_zero("cells").alias("n_detector_nights"),
        sum_or_zero("calls").alias("total_calls"),
        sum_or_zero("hours").alias("total_recording_hours"),
        sum_or_zero("dead").alias("dead_nights"),
        F.min("first").alias("first_night"), F.max("last").alias("last_night"),
    ).withColumn("n_species", species)
