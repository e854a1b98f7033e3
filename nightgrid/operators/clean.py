"""Duplicates, optional filters and blank values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from nightgrid import constants as K
from nightgrid.functions.numbers import as_column, positive_number
from nightgrid.functions.species import is_identified, is_unidentified_any_case


def first_row_order(df: DataFrame, keys: Sequence[str]) -> list[Column]:
    """What "first" means: reading order if it is known, else a fixed full order."""
    if "_read_order" in df.columns:
        return [F.col("_read_order")]
    lead = [c for c in ("source_file", "in_file") if c in df.columns and c not in keys]
    rest = sorted(c for c in df.columns if c not in keys and c not in lead)
    return [F.col(c) for c in (*lead, *rest)]


def keep_first(df: DataFrame, keys: Sequence[str] = K.DEDUP_KEYS) -> DataFrame:
    """Keep the first row per key; NULL keys equal each other.

    The filter on row_number lets Spark keep one row per key and task before the
    shuffle, so a key with very many copies costs no more than any other.
    """
    window = Window.partitionBy(*keys).orderBy(*first_row_order(df, keys))
    numbered = df.withColumn("_copy", F.row_number().over(window))
    return numbered.where(F.col("_copy") == 1).drop("_copy", "_read_order")


def filter_noid(df: DataFrame) -> DataFrame:
    return df.where((F.col("auto_id") != K.AUTO_NOID) | F.col("auto_id").isNull())


def filter_zero_pulse(df: DataFrame) -> DataFrame:
    return df.where(positive_number("pulses"))


def drop_unidentified(df: DataFrame) -> DataFrame:
    return df.where(F.col("species") != K.AUTO_NOID)


def filter_identified(df: DataFrame) -> DataFrame:
    return df.where(is_identified("species"))


def noid_handling(df: DataFrame, mode: str = "keep") -> DataFrame:
    """keep, remove or flag unidentified rows (labels in any case)."""
    if mode == "keep":
        return df
    flag = is_unidentified_any_case("species")
    if mode == "remove":
        return df.where(~flag)
    if mode == "show_separate":
        return df.withColumn("is_noid", flag)
    raise ValueError(f"noid handling must be keep, remove or show_separate, not {mode!r}")


def blank_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {', '.join(absent)}")
    return df.withColumns(
        {c: F.when(F.trim(as_column(c)) != "", F.col(c)) for c in columns}
    )
