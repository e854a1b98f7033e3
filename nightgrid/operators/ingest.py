"""First cleaning of raw rows, before the sources are united."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, functions as F

from nightgrid import constants as K
from nightgrid.functions.numbers import positive_number


def positive_n() -> Column:
    """True for a numeric ``n`` above 0; never NULL."""
    return positive_number("n")


def filter_positive_n(df: DataFrame) -> DataFrame:
    if "n" not in df.columns:
        warnings.warn("column 'n' is absent: invalid rows cannot be filtered", stacklevel=2)
        return df
    return df.where(positive_n())


def derive_detector_id(df: DataFrame) -> DataFrame:
    if "in_file" not in df.columns:
        warnings.warn("column 'in_file' is absent: detector_id is NULL", stacklevel=2)
        return df.withColumn("detector_id", F.lit(None).cast("string"))
    return df.withColumn("detector_id", F.substring("in_file", 1, K.DETECTOR_ID_LENGTH))


def detect_schema_version(df: DataFrame, single_column_file: Column | None = None) -> DataFrame:
    """Classify each row by its alternates and the length of its species code.

    A file that has an ``alternates`` column is legacy as a whole.  That is a fact
    about the file, so it is read off the columns here; pass ``single_column_file``
    when the rows of several files are already united.
    """
    if single_column_file is None:
        single_column_file = F.lit("alternates" in df.columns)
    if "auto_id" not in df.columns:
        by_row = F.lit(K.SCHEMA_UNKNOWN)
        listed = F.lit(False)
    else:
        listed = F.lit(False)
        for name in ("alternate_1", "alternate_2"):
            if name in df.columns:
                listed = listed | F.coalesce(F.col(name).contains(";"), F.lit(False))
        size = F.length("auto_id")
        by_row = (
            F.when(size == 4, K.SCHEMA_V2)
            .when(size == 6, K.SCHEMA_V3)
            .otherwise(K.SCHEMA_UNKNOWN)
        )
    legacy = single_column_file | listed
    return df.withColumn("schema_version", F.when(legacy, K.SCHEMA_V1).otherwise(by_row))
