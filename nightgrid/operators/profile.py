"""Schema, completeness and duplicate reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from nightgrid import constants as K
from nightgrid.functions.numbers import percent
from nightgrid.functions.times import dashed, matching_date_patterns, parse_dashed
from nightgrid.operators.heavy import count_in_group
from nightgrid.operators.mapping import distinct_values
from nightgrid.operators.reshape import rows_in_group, share_of_total


def schema_distribution(df: DataFrame) -> DataFrame:
    counts = df.groupBy("schema_version").agg(F.count("*").alias("count"))
    return share_of_total(counts, "count", "percent")


def dominant_schema(df: DataFrame) -> DataFrame:
    """The most frequent version; of equals the alphabetically first."""
    counts = df.groupBy("schema_version").agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), "schema_version").limit(1)


def mixed_schema_files(df: DataFrame) -> DataFrame:
    """Rows per version for files that hold more than one version."""
    counts = df.groupBy("source_file", "schema_version").agg(F.count("*").alias("n_rows"))
    versions = F.count("*").over(Window.partitionBy("source_file"))
    mixed = counts.withColumn("n_versions", versions)
    return mixed.where(F.col("n_versions") > 1)


def column_completeness(df: DataFrame) -> DataFrame:
    """Non-NULL counts of all columns in one scan, least complete first."""
    counts = df.agg(F.count(F.lit(1)).alias("n_total"), *[F.count(c).alias(c) for c in df.columns])
    long = counts.unpivot("n_total", df.columns, "column_name", "n_complete")
    return long.select(
        "column_name", "n_total", "n_complete",
        percent("n_complete", "n_total").alias("pct_complete"),
    ).orderBy("pct_complete", "column_name")


def duplicate_report(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row: rows, distinct keys, rows that share their key with another row."""
    groups = df.groupBy(*(keys or df.columns)).agg(F.count("*").alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_total"),
        F.count("*").alias("n_unique"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("n_duplicates"),
    )


def duplicate_rows(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    counted = rows_in_group(df, list(keys or df.columns))
    return counted.where(F.col("n_occurrences") > 1).drop("n_occurrences")


def date_format_profile(df: DataFrame, column: str, n_sample: int = 3) -> DataFrame:
    """Rows per date pattern and the first few distinct values.

    The patterns overlap, so one value can count more than once.
    """
    values = (
        df.select(F.col(column).cast("string").alias("value"))
        .where(F.col("value").isNotNull())
        .groupBy("value")
        .agg(F.count("*").alias("n"))
    )
    matches = values.select("value", "n", F.explode(matching_date_patterns("value")).alias("format"))
    counts = matches.groupBy("format").agg(F.sum("n").alias("n_values"))
    place = F.row_number().over(Window.partitionBy("format").orderBy("value"))
    samples = (
        matches.withColumn("place", place)
        .where(F.col("place") <= n_sample)
        .groupBy("format")
        .agg(F.array_join(F.array_sort(F.collect_list("value")), ", ").alias("examples"))
    )
    return counts.join(samples, "format")


def infer_study_span(df: DataFrame) -> DataFrame:
    """First and last raw date and the number of detector ids, one row."""
    days = df.select("detector_id", dashed("date").alias("text")).select(
        "detector_id", parse_dashed("text", day_first=True).alias("day")
    )
    # Per detector first: one scan, and distinct ids are counted as rows.
    spans = days.groupBy("detector_id").agg(F.min("day").alias("first"), F.max("day").alias("last"))
    return spans.agg(
        F.min("first").alias("start_date"), F.max("last").alias("end_date"),
        F.count("detector_id").alias("n_detector_ids"),
    )


def mapping_quality(df: DataFrame, names: DataFrame) -> DataFrame:
    """Per raw id: its name, detections, and whether the name is a placeholder or shared."""
    per_id = df.groupBy("detector_id").agg(F.count("*").alias("total_detections"))
    joined = per_id.join(names.select("detector_id", "Detector"), "detector_id", "left")
    # Ids without a name share NULL, which may be most of them.
    joined = count_in_group(joined, ["Detector"], "_same")
    placeholder = F.coalesce(F.col("Detector") == K.NAME_PLACEHOLDER, F.lit(False))
    named = F.col("Detector").isNotNull() & ~placeholder
    return joined.select(
        "detector_id", "Detector", "total_detections",
        named.alias("mapped"),
        placeholder.alias("is_placeholder"),
        (named & (F.col("_same") > 1)).alias("duplicate_name"),
    )


def mapping_summary(quality: DataFrame) -> DataFrame:
    return quality.agg(
        F.count_if("is_placeholder").alias("placeholders_remaining"),
        (F.count_if("duplicate_name") > 0).alias("duplicate_names_detected"),
        (F.count_if(~F.col("mapped")) == 0).alias("all_detectors_mapped"),
    )


def temporal_completeness(expected: DataFrame, grid: DataFrame, intended_hours: float) -> DataFrame:
    """Missing and partial detector nights, with expected and actual hours.

    ``expected`` holds the (Detector, Night) pairs that should be there.  A night without a status is Unknown.
    """
    intended = F.lit(float(intended_hours)).alias("expected_hours")
    absent = expected.join(grid, ["Detector", "Night"], "left_anti").select(
        "Detector", "Night", F.lit("NoData").alias("status"), intended,
        F.lit(0.0).alias("actual_hours"),
    )
    status = F.coalesce("Status", F.lit("Unknown"))
    failed = grid.where(status != "Success").select(
        "Detector", "Night",
        F.when(status == "Fail", "NoData").otherwise(status).alias("status"),
        intended, F.col("RecordingHours").alias("actual_hours"),
    )
    return absent.unionByName(failed)


def species_code_quality(df: DataFrame) -> DataFrame:
    """Per species code: rows, share, whether it is unidentified or not a known code."""
    counts = df.groupBy("auto_id").agg(F.count("*").alias("n_rows"))
    known = sorted(set(K.SPECIES_CODES_4_TO_6.values()) | set(K.SPECIES_CODES_4_TO_6))
    code = F.col("auto_id")
    flagged = counts.withColumns(
        {
            "is_unidentified": code.isNull() | code.isin("NoID", "NOID", "UNKNOWN", ""),
            "is_unknown_code": F.coalesce(~code.isin(*known, "NoID"), F.lit(False)),
        }
    )
    return share_of_total(flagged, "n_rows", "pct_rows")
