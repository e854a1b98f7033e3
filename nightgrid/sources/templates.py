"""Effort templates that came back from manual editing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from nightgrid.functions.times import parse_date
from nightgrid.operators.clean import blank_to_null


def normalize_template(df: DataFrame, edited: bool = True) -> DataFrame:
    """Types of an all-text template: ISO nights when original, mixed when edited."""
    night = parse_date("Night") if edited else F.col("Night").try_cast("date")
    df = df.withColumns(
        {
            "Night": night,
            "Detector": F.col("Detector").cast("string"),
            "CallsPerNight": F.col("CallsPerNight").try_cast("double"),
            "RecordingHours": F.col("RecordingHours").try_cast("double"),
        }
    )
    moments = [c for c in ("StartDateTime", "EndDateTime") if c in df.columns]
    return blank_to_null(df, moments)


def read_edited_template(spark: SparkSession, path: str, edited: bool = True) -> DataFrame:
    raw = (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("escape", '"')
        .csv(path)
    )
    return normalize_template(raw, edited)
