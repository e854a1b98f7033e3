"""Detector names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from nightgrid import constants as K

# A map of this many short pairs is a few MB: safe to send to every executor.
BROADCAST_MAX_NAMES = 50_000


def names_table(spark: SparkSession, names: Mapping[str, str]) -> DataFrame:
    """The configured id-to-name map as a table, hinted small only if it is."""
    table = spark.createDataFrame(
        list(names.items()), "detector_id string, Detector string"
    )
    return F.broadcast(table) if len(names) <= BROADCAST_MAX_NAMES else table


def map_detectors(df: DataFrame, names: DataFrame | None) -> DataFrame:
    """Attach Detector names; placeholder or missing names fall back to the raw id.

    ``names`` is (detector_id, Detector).  Without a hint Spark broadcasts it when
    its size allows; else the join shuffles, and AQE splits a hot detector.
    """
    own_id = F.col("detector_id")
    if names is None:
        return df.withColumn("Detector", own_id)
    given = F.when(F.col("_name") != K.NAME_PLACEHOLDER, F.col("_name"))
    side = names.select("detector_id", F.col("Detector").alias("_name"))
    joined = df.join(side, "detector_id", "left")
    return joined.withColumn("Detector", F.coalesce(given, own_id)).drop("_name")


def unmapped_count(df: DataFrame, names: DataFrame) -> DataFrame:
    """One row: how many detections have no entry in the map."""
    per_id = df.groupBy("detector_id").agg(F.count("*").alias("n"))
    lost = per_id.join(names, "detector_id", "left_anti")
    return lost.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_unmapped"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def reconcile_mapping(ids: DataFrame, existing: DataFrame) -> DataFrame:
    """Names for exactly the ids seen now: known ones kept, new ones a placeholder."""
    seen = distinct_values(ids, "detector_id")
    joined = seen.join(existing.select("detector_id", "Detector"), "detector_id", "left")
    name = F.coalesce("Detector", F.lit(K.NAME_PLACEHOLDER)).alias("Detector")
    return joined.select("detector_id", name).orderBy("detector_id")


def set_difference(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``column`` that only the left table has."""
    return distinct_values(left, column).join(
        right.select(column), column, "left_anti"
    )
