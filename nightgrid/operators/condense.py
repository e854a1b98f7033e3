"""One pass over the detections for everything that only counts them.

The species, hourly and detector tables need counts by detector, species, night and
hour.  ``condense`` counts once at that grain; the operators accept the result in
place of the detections, so many tables cost one scan of the large table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from nightgrid.functions.times import hour_floor

WEIGHT = "_weight"
GRAIN = ("Detector", "auto_id", "species", "Night", "DateTime_local", "Hour_local")


def condense(master: DataFrame) -> DataFrame:
    """Detections counted by detector, label, night and clock hour."""
    rows = master.select(*GRAIN).withColumn("DateTime_local", hour_floor("DateTime_local"))
    return rows.groupBy(*GRAIN).agg(F.count("*").alias(WEIGHT))


def n_calls(df: DataFrame) -> Column:
    """Number of detections in a group of rows, condensed or not."""
    return F.sum(WEIGHT) if WEIGHT in df.columns else F.count("*")


def n_calls_where(df: DataFrame, condition: Column) -> Column:
    if WEIGHT not in df.columns:
        return F.count_if(condition)
    return F.coalesce(F.sum(F.when(condition, F.col(WEIGHT))), F.lit(0))
