"""Timestamped and versioned tables, and their text exports.

A snapshot is a Parquet folder below a ``run_ts=`` or ``version=`` partition.
Readers pick the newest finished one by folder name and then open only that folder.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from nightgrid.functions.times import export_text, parse_month_first
from nightgrid.sources.files import claim_file, list_folders

RUN_TS = r"^\d{8}_\d{6}$"


def _newest(spark: SparkSession, root: str, pattern: str) -> str | None:
    return max(list_folders(spark, root, pattern), default=None)


def write_snapshot(df: DataFrame, root: str, run_ts: str) -> str:
    """Write one snapshot.

    No shuffle is added for the file sizes: the last one of the plan is already
    coalesced by AQE, and the dedup keys spread evenly.
    """
    if not re.match(RUN_TS, run_ts):
        raise ValueError(f"run_ts must look like YYYYMMDD_HHMMSS, not {run_ts!r}")
    path = f"{root}/run_ts={run_ts}"
    df.write.parquet(path)
    return path


def read_latest_snapshot(spark: SparkSession, root: str) -> DataFrame:
    """The newest snapshot, with its ``run_ts`` as a text column."""
    latest = _newest(spark, root, r"run_ts=(\d{8}_\d{6})")
    if latest is None:
        raise FileNotFoundError(f"no snapshot below {root}")
    return spark.read.parquet(f"{root}/run_ts={latest}").withColumn("run_ts", F.lit(latest))


def read_snapshot(df: DataFrame, root: str, run_ts: str) -> DataFrame:
    """Write a snapshot and go on from it, whatever other runs have written since."""
    return df.sparkSession.read.schema(df.schema).parquet(write_snapshot(df, root, run_ts))


def next_version(spark: SparkSession, root: str) -> int:
    """Versions are zero-padded in folder names, so text order is number order."""
    taken = list_folders(spark, root, r"version=(\d+)", finished=False)
    return 1 + max(map(int, taken), default=0)


def write_versioned(df: DataFrame, root: str) -> int:
    """Write the next version.  Its number is claimed first, so two writers never share one."""
    spark = df.sparkSession
    version = next_version(spark, root)
    while not claim_file(spark, f"{root}/_claims/{version:06d}"):
        version += 1
    df.write.parquet(f"{root}/version={version:06d}")
    return version


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    return spark.read.parquet(f"{root}/version={version:06d}").withColumn(
        "version", F.lit(version)
    )


def export_columns(df: DataFrame) -> DataFrame:
    """The text form of a master table: DateTime_local as 'MM/DD/YYYY HH:MM:SS'."""
    if "DateTime_local" not in df.columns:
        return df
    return df.withColumn("DateTime_local", export_text("DateTime_local"))


def write_master_csv(df: DataFrame, path: str) -> None:
    export_columns(df).write.option("header", True).csv(path)


def reparse_local_datetime(df: DataFrame) -> DataFrame:
    """Turn the text DateTime_local of an export back into wall-clock time."""
    if "DateTime_local" not in df.columns:
        return df
    if dict(df.dtypes)["DateTime_local"] != "string":
        return df
    return df.withColumn("DateTime_local", parse_month_first("DateTime_local"))


def read_master_csv(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.option("header", True).option("escape", '"').csv(path)
    return reparse_local_datetime(raw)
