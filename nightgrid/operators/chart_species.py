"""Data behind the species charts.

Species codes are a small vocabulary; windows over them come after aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from nightgrid.functions.numbers import percent, share, short_count
from nightgrid.functions.species import is_unidentified
from nightgrid.functions.times import bin_date
from nightgrid.operators.clean import filter_identified
from nightgrid.operators.condense import n_calls, n_calls_where
from nightgrid.operators.grid import night_span
from nightgrid.operators.reshape import completed, completed_hours, keep_top_n, rank_abundance
from nightgrid.operators.summaries import first_detections


def derive_night(df: DataFrame) -> DataFrame:
    """A Night column from Night, else DateTime_local, else DateTime."""
    for name in ("Night", "DateTime_local", "DateTime"):
        if name in df.columns:
            return df.withColumn("Night", F.to_date(name))
    raise ValueError("needs a column Night, DateTime_local or DateTime")


def _rows(master: DataFrame, exclude_noid: bool) -> DataFrame:
    return filter_identified(master) if exclude_noid else master


def species_composition(
    master: DataFrame, top_n: int | None = None, exclude_noid: bool = True
) -> DataFrame:
    """Calls per species and their share of the species kept."""
    counts = _rows(master, exclude_noid).groupBy("species").agg(n_calls(master).alias("TotalCalls"))
    if top_n is not None:
        counts = counts.orderBy(F.desc("TotalCalls"), "species").limit(top_n)
    total = counts.agg(F.sum("TotalCalls")).scalar()
    return counts.withColumn("pct", share("TotalCalls", total)).orderBy(
        F.desc("TotalCalls"), "species"
    )


def species_by_detector_matrix(master: DataFrame, exclude_noid: bool = True) -> DataFrame:
    """Calls for every detector and species, with the species total and a short label."""
    counts = (
        _rows(master, exclude_noid)
        .groupBy("Detector", "species")
        .agg(n_calls(master).alias("n_calls"))
    )
    totals = counts.groupBy("species").agg(F.sum("n_calls").alias("species_total"))
    return completed(counts, "Detector", "species").join(totals, "species").select(
        "Detector", "species", "n_calls", "species_total",
        F.when(F.col("n_calls") > 0, short_count("n_calls")).alias("label"),
    )


def cumulative_species(master: DataFrame, exclude_noid: bool = True) -> DataFrame:
    """Species known by each night, for every night of the span."""
    rows = _rows(derive_night(master), exclude_noid)
    nightly = rows.select("species", "Night").distinct()
    new = first_detections(nightly).groupBy("first_night").agg(F.count("*").alias("new"))
    first, last = night_span(nightly)
    spine = master.sparkSession.range(1).select(F.explode(F.sequence(first, last)).alias("Night"))
    joined = spine.join(new, spine["Night"] == new["first_night"], "left")
    running = F.sum(F.coalesce("new", F.lit(0))).over(
        Window.orderBy("Night").rowsBetween(Window.unboundedPreceding, 0)
    )
    return joined.select("Night", running.alias("cumulative_species"))


def accumulation_labels(master: DataFrame, exclude_noid: bool = True) -> DataFrame:
    """Label of each night that added species: 'Oct 04' and the species below it."""
    rows = _rows(derive_night(master), exclude_noid)
    added = first_detections(rows).groupBy("first_night").agg(
        F.array_join(F.array_sort(F.collect_list("species")), ", ").alias("species_added")
    )
    curve = cumulative_species(master, exclude_noid)
    label = F.concat(F.date_format("Night", "MMM dd"), F.lit("\n"), F.col("species_added"))
    return added.withColumnRenamed("first_night", "Night").join(curve, "Night", "left").select(
        "Night", "cumulative_species", label.alias("label")
    )


def species_hourly_profile(
    master: DataFrame, top_n: int = 6, exclude_noid: bool = True
) -> DataFrame:
    counts = (
        _rows(master, exclude_noid)
        .groupBy("species", F.col("Hour_local").cast("int").alias("Hour_local"))
        .agg(n_calls(master).alias("n_calls"))
    )
    counts = keep_top_n(counts, top_n)
    total = F.sum("n_calls").over(Window.partitionBy("species"))
    shares = counts.withColumn("pct", share("n_calls", total))
    return completed_hours(shares, "species", ["n_calls", "pct"])


def noid_proportion(master: DataFrame) -> DataFrame:
    """Unidentified calls per detector and in the study.

    Takes the table before unidentified rows are dropped.
    """
    counts = master.groupBy("Detector").agg(
        n_calls(master).alias("total_calls"),
        n_calls_where(master, is_unidentified("species")).alias("noid_calls"),
    )
    overall = counts.agg(share(F.sum("noid_calls"), F.sum("total_calls"))).scalar()
    return counts.select(
        "*", share("noid_calls", "total_calls").alias("pct_noid"), overall.alias("study_pct_noid")
    )


def noid_and_richness_by_night(master: DataFrame) -> DataFrame:
    """Per night the share of unidentified calls and the number of species."""
    flag = is_unidentified("species")
    by_species = (
        derive_night(master)
        .groupBy("Night", "species")
        .agg(n_calls(master).alias("n"))
    )
    return by_species.groupBy("Night").agg(
        F.sum("n").alias("total_calls"),
        F.coalesce(F.sum(F.when(flag, F.col("n"))), F.lit(0)).alias("noid_calls"),
        F.count_if(~flag).alias("richness"),
    ).withColumn("pct_noid", share("noid_calls", "total_calls"))


def noid_and_richness_long(nightly: DataFrame) -> DataFrame:
    return nightly.select(
        "Night",
        F.col("pct_noid").alias("NoID %"),
        F.col("richness").cast("double").alias("Species Richness"),
    ).unpivot("Night", ["NoID %", "Species Richness"], "metric", "value")


def species_detector_composition(
    master: DataFrame, top_n: int | None = None, exclude_noid: bool = True, normalize: bool = False
) -> DataFrame:
    counts = (
        _rows(master, exclude_noid)
        .groupBy("Detector", "species")
        .agg(n_calls(master).alias("n_calls"))
    )
    counts = keep_top_n(counts, top_n)
    if not normalize:
        return counts
    total = F.sum("n_calls").over(Window.partitionBy("Detector"))
    return counts.withColumn("pct", percent("n_calls", total, None))


def species_nightly_activity(
    master: DataFrame, top_n: int | None = None, exclude_noid: bool = True
) -> DataFrame:
    counts = (
        _rows(derive_night(master), exclude_noid)
        .groupBy("species", "Night")
        .agg(n_calls(master).alias("n_calls"))
    )
    return keep_top_n(counts, top_n)


def species_phenology(
    master: DataFrame, time_bin: str = "night", top_n: int | None = None, exclude_noid: bool = True
) -> DataFrame:
    """Calls per species and time bin; combinations without calls are 0."""
    counts = (
        _rows(derive_night(master), exclude_noid)
        .groupBy("species", bin_date("Night", time_bin).alias("TimeBin"))
        .agg(n_calls(master).alias("n_calls"))
    )
    return completed(keep_top_n(counts, top_n), "species", "TimeBin")


def species_turnover(
    master: DataFrame, time_bin: str = "night", exclude_noid: bool = True
) -> DataFrame:
    """New species per time bin and the running total."""
    found = first_detections(_rows(derive_night(master), exclude_noid))
    new = found.groupBy(bin_date("first_night", time_bin).alias("TimeBin")).agg(
        F.count("*").alias("new_species")
    )
    running = F.sum("new_species").over(
        Window.orderBy("TimeBin").rowsBetween(Window.unboundedPreceding, 0)
    )
    return new.withColumn("cumulative_species", running)


def species_rank_abundance(master: DataFrame, exclude_noid: bool = True) -> DataFrame:
    counts = _rows(master, exclude_noid).groupBy("species").agg(n_calls(master).alias("n_calls"))
    return rank_abundance(counts)
