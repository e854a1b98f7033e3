"""Raw classifier exports: heterogeneous CSV files into one all-text table.

Files differ in header order and content.  All of them are read by place in one scan,
and each row's fields are put under the names of its own file's header, so neither jobs
nor the plan grow with the number of headers.  The driver sees distinct headers only.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from nightgrid.operators.ingest import (
    derive_detector_id,
    detect_schema_version,
    filter_positive_n,
    positive_n,
)
from nightgrid.sources import quoted
from nightgrid.sources.files import probe_headers, split_header
from nightgrid.sources.names import clean_names

#: Up to this many files, of about 200 bytes each, the layouts are broadcast to the rows.
BROADCAST_FILES = 200_000


@dataclass(frozen=True)
class Exports:
    rows: DataFrame | None
    files: DataFrame


def read_all_string_csv(
    spark: SparkSession, paths: str | list[str], columns: list[str], multi_line: bool = False,
    skip_corrupt: bool = False, glob: str | None = None, recursive: bool = False,
) -> DataFrame:
    """CSV files, every column as text by its place; empty and 'NA' become NULL.

    A file that breaks off or can't be decompressed is an error that names it;
    ``skip_corrupt`` takes its rows up to that place instead.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    reader = spark.read.schema(schema).option("recursiveFileLookup", str(recursive).lower())
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return (
        reader.options(**_FIELDS)
        .option("header", True)
        .option("multiLine", multi_line)
        .option("ignoreCorruptFiles", skip_corrupt)
        .csv(paths)
    )


#: How fields are read, whether by Spark's reader of files or from single records.
_FIELDS = {
    "mode": "PERMISSIVE", "escape": '"', "nullValue": "NA", "emptyValue": "NA",
    "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true",
}


def _read_broken_records(
    spark: SparkSession, root: str, inside: dict, width: int, source_rank: int, skip_corrupt: bool, glob: str, recursive: bool
) -> DataFrame:
    """As ``with_provenance(read_all_string_csv(...))``, for files with line breaks inside quotes."""
    found = quoted.records(spark, root, inside, glob, recursive, skip_corrupt)
    schema = ", ".join(f"_{i} string" for i in range(width))
    fields = F.from_csv("record", schema, {**_FIELDS, "maxCharsPerColumn": "-1"})
    position = F.struct(
        F.lit(source_rank).alias("source_rank"), "path", F.col("split").alias("split_start"), "row",
    )
    return found.select(fields.alias("fields"), F.col("name").alias("source_file"), position.alias("_read_order")).select(
        "fields.*", "source_file", "_read_order"
    )


def with_provenance(df: DataFrame, source_rank: int = 0) -> DataFrame:
    """Add the file's base name and the position of the row in reading order.

    Within one split rows are numbered in file order, so (source, path, split
    start, number) sorts rows the way a sequential reader would meet them.
    """
    position = F.struct(
        F.lit(source_rank).alias("source_rank"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("split_start"),
        F.monotonically_increasing_id().alias("row"),
    )
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("source_file"),
        position.alias("_read_order"),
    )


def bind_rows(parts: list[DataFrame]) -> DataFrame:
    """UNION ALL by name; columns a part lacks are NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _layouts(headers: list[str]) -> tuple[list[str], list[tuple]]:
    """All column names, and per header (text, place of each name, facts about the file)."""
    named = {h: clean_names(split_header(h)) for h in sorted(headers)}
    columns = list(dict.fromkeys(name for names in named.values() for name in names))
    rows = []
    for header, names in named.items():
        place = {name: i for i, name in enumerate(names)}
        rows.append((header, [place.get(c, -1) for c in columns], "n" in place, "alternates" in place))
    return columns, rows


def read_exports(
    spark: SparkSession,
    root: str,
    glob: str = "*.csv",
    recursive: bool = False,
    source_rank: int = 0,
    keep_invalid: bool = False,
    line_breaks: bool = True,
    skip_corrupt: bool = False,
) -> Exports:
    """Read all matching files below ``root``.

    One job looks at the headers; the driver gets each distinct header with its number
    of files.  Files that can't be read are left out, with a warning, and listed.

    Values may hold line breaks inside quotes: one more look at the files finds out whether any
    does (``line_breaks=False`` saves it for files known to have none).  Files stay splittable either way.
    """
    probed = probe_headers(spark, root, glob, recursive)
    files = probed.select("path", "status")
    counts = probed.groupBy("status", "header").agg(F.count("*").alias("n")).collect()
    for row in counts:
        if row.status != "ok":
            warnings.warn(f"skipped {row.n} files below {root}: {row.status}", stacklevel=2)
    headers = [row.header for row in counts if row.status == "ok"]
    if not headers:
        return Exports(None, files)
    columns, layouts = _layouts(headers)
    width = 1 + max(max(places) for _, places, _, _ in layouts)
    inside = quoted.open_splits(spark, root, glob, recursive, skip_corrupt) if line_breaks else None
    if inside is None:
        raw = read_all_string_csv(spark, root, [f"_{i}" for i in range(width)], False, skip_corrupt, glob, recursive)
        raw = with_provenance(raw, source_rank)
    else:
        raw = _read_broken_records(spark, root, inside, width, source_rank, skip_corrupt, glob, recursive)
    if len(counts) == 1:
        _, places, has_n, single = layouts[0]
        facts = {"_has_n": F.lit(has_n), "_single": F.lit(single)}
        named = {c: F.col(f"_{i}") for c, i in zip(columns, places)}
    else:
        table = spark.createDataFrame(layouts, "header string, _places array<int>, _has_n boolean, _single boolean")
        # The layouts are one row per distinct header, which the driver has held.
        of_file = probed.where("status = 'ok'").join(F.broadcast(table), "header").drop("header", "path", "status")
        if sum(row.n for row in counts) <= BROADCAST_FILES:
            of_file = F.broadcast(of_file)
        raw = raw.join(of_file, F.col("_read_order.path") == F.col("uri"))
        facts = {"_has_n": F.col("_has_n"), "_single": F.col("_single")}
        fields = F.array(*[F.col(f"_{i}") for i in range(width)])
        named = {c: F.get(fields, F.get("_places", F.lit(k))) for k, c in enumerate(columns)}
    rows = raw.select(
        *[value.alias(c) for c, value in named.items()], "source_file", "_read_order",
        *[value.alias(c) for c, value in facts.items()],
    )
    if not keep_invalid and "n" in columns:
        rows = rows.where(~F.col("_has_n") | positive_n())
    elif not keep_invalid:
        rows = filter_positive_n(rows)
    rows = detect_schema_version(derive_detector_id(rows), F.col("_single"))
    return Exports(rows.drop("_has_n", "_single"), files)


def load_flat_dir(spark: SparkSession, directory: str, **options) -> Exports:
    """All ``*.csv`` of one directory, without its subdirectories."""
    return read_exports(spark, directory, "*.csv", recursive=False, **options)


def load_recursive_dir(
    spark: SparkSession, root: str, glob: str = "*id.csv", **options
) -> Exports:
    """Matching files anywhere below a root; it is an error when there are none."""
    found = read_exports(spark, root, glob, recursive=True, **options)
    if found.files.isEmpty():
        raise FileNotFoundError(f"no files matching {glob!r} below {root}")
    return found


def union_sources(parts: dict[str, DataFrame | None]) -> DataFrame:
    """Unite named sources, marking each row with its ``source_kind``.

    A source that is None is left out with a warning; no source at all is an error.
    """
    present = []
    for kind, rows in parts.items():
        if rows is None:
            warnings.warn(f"source {kind!r} has no rows", stacklevel=2)
        else:
            present.append(rows.withColumn("source_kind", F.lit(kind)))
    if not present:
        raise ValueError("no source holds any rows")
    return bind_rows(present)


def source_split(df: DataFrame) -> DataFrame:
    return df.groupBy("source_kind").agg(F.count("*").alias("n_rows"))
