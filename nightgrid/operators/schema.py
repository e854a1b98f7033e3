"""Three historical schemas into one, in a single projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from nightgrid import constants as K
from nightgrid.functions.species import recode_species
from nightgrid.functions.numbers import as_column

ALTERNATES = ("alternate_1", "alternate_2", "alternate_3")


def _column_or_null(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def split_list(text) -> Column:
    """Split on ';' and blanks after it; one trailing separator adds no item."""
    text = as_column(text)
    trimmed = F.regexp_replace(text, r";\s*$", "")
    return F.when(text != "", F.split(trimmed, r";\s*"))


def split_alternates(df: DataFrame) -> DataFrame:
    """Legacy rows: the listed alternates become alternate_1 .. alternate_3."""
    listed = F.coalesce(_column_or_null(df, "alternates"), _column_or_null(df, "alternate_1"))
    items = split_list(listed)
    df = df.withColumns({name: F.get(items, i) for i, name in enumerate(ALTERNATES)})
    return df.drop("alternates")


def recode_species_columns(df: DataFrame) -> DataFrame:
    names = [c for c in ("auto_id", *ALTERNATES) if c in df.columns]
    return df.withColumns({c: recode_species(c) for c in names})


def add_missing_alternate3(df: DataFrame) -> DataFrame:
    if "alternate_3" in df.columns:
        return df
    return df.withColumn("alternate_3", F.lit(None).cast("string"))


def harmonize_out_file(df: DataFrame) -> DataFrame:
    """One output-file column: the modern name, filled from the legacy one."""
    if "out_file" not in df.columns:
        return df
    if "out_file_fs" not in df.columns:
        return df.withColumnRenamed("out_file", "out_file_fs")
    return df.withColumn("out_file_fs", F.coalesce("out_file_fs", "out_file")).drop("out_file")


def unify_schema(df: DataFrame) -> DataFrame:
    """All schema versions to the unified one.

    Legacy rows have their list split, legacy and transitional rows are recoded,
    modern and unknown rows pass through.  One pass: no split and union per version.
    """
    version = F.col("schema_version")
    legacy = version == K.SCHEMA_V1
    recoded = version.isin(K.SCHEMA_V1, K.SCHEMA_V2)
    listed = F.coalesce(_column_or_null(df, "alternates"), _column_or_null(df, "alternate_1"))
    # In steps, so that the list is split once and not once per column.
    items = df.withColumn("_items", F.when(legacy, split_list(listed)))
    df = items.withColumns(
        {
            "auto_id": _column_or_null(df, "auto_id"),
            **{
                name: F.when(legacy, F.get("_items", i)).otherwise(_column_or_null(df, name))
                for i, name in enumerate(ALTERNATES)
            },
        }
    ).drop("_items")
    changes = {
        name: F.when(recoded, recode_species(name)).otherwise(F.col(name))
        for name in ("auto_id", *ALTERNATES)
    }
    if "_read_order" in df.columns:
        # Rows are met version by version, so the version leads the reading order.
        rank = F.array_position(
            F.array(*[F.lit(v) for v in (K.SCHEMA_V1, K.SCHEMA_V2, K.SCHEMA_V3)]), version
        )
        rank = F.when(rank == 0, 4).otherwise(rank)
        changes["_read_order"] = F.struct(rank.alias("version_rank"), "_read_order.*")
    df = harmonize_out_file(df.withColumns(changes))
    return df.drop("alternates", "schema_version")


def enforce_types(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: F.col(c).cast("string") for c in ("Detector", "auto_id")}
    )


def final_column_select(df: DataFrame) -> DataFrame:
    """Drop bookkeeping columns, put the known ones in order, keep extras at the end."""
    kept = [c for c in df.columns if c.lower() not in K.DROPPED_COLUMNS]
    ordered = [c for c in K.MASTER_COLUMNS if c in kept]
    return df.select(*ordered, *[c for c in kept if c not in K.MASTER_COLUMNS])
