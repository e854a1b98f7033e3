"""Listing files and looking at their first lines, on the executors."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

HEADER_SCHEMA = "path string, uri string, status string, header string"
#: Stores that the header probe opens by itself; files elsewhere are scanned by Spark.
_OPENED = ("file", "hdfs", "s3", "s3a", "s3n", "gs", "gcs", "abfs", "abfss")
_UTF16 = (b"\xff\xfe", b"\xfe\xff")


def list_files(
    spark: SparkSession, root: str, glob: str = "*.csv", recursive: bool = False
) -> DataFrame:
    """(path, uri, length, modificationTime) of matching files.

    ``uri`` is the path as ``_metadata.file_path`` writes it.  Only metadata is read:
    the content column is pruned.  Spark leaves out files of zero bytes.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    reader = reader.option("recursiveFileLookup", str(recursive).lower())
    return reader.load(root).select(
        "path", F.col("_metadata.file_path").alias("uri"), "length", "modificationTime"
    )


def open_uri(path: str):
    """Open a file of any filesystem pyarrow knows, as a binary stream."""
    from pyarrow import fs

    uri = re.sub(r"^file:/+", "file:///", path)
    uri = re.sub(r"^s3[an]:", "s3:", uri)
    filesystem, inner = fs.FileSystem.from_uri(uri)
    return filesystem.open_input_stream(inner)


def header_record(lines: Iterator[bytes]) -> tuple[str, str | None]:
    """Status and header text from a file's lines; nothing below the header is looked at.

    The header is the first line that is not blank, and the lines after it while a
    quoted name is open.  Bytes that are no UTF-8 become replacement characters.
    """
    header = b""
    for line in lines:
        if not header and line.startswith(_UTF16):
            return "unreadable: UTF-16 text", None
        if header or line.removeprefix(b"\xef\xbb\xbf").strip():
            header += line
            if header.count(b'"') % 2 == 0:
                break
    if not header:
        return "empty", None
    return "ok", header.decode("utf-8-sig", "replace").rstrip("\r\n")


def _probe_file(path: str) -> tuple[str, str | None]:
    import pyarrow as pa

    try:
        with open_uri(path) as stream:
            return header_record(iter(io.BufferedReader(stream).readline, b""))
    except (OSError, pa.ArrowException) as error:
        return f"unreadable: {type(error).__name__}", None


def _probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = [_probe_file(path) for path in batch["path"]]
        yield pd.DataFrame(
            {
                "path": batch["path"],
                "uri": batch["uri"],
                "status": [status for status, _ in found],
                "header": [header for _, header in found],
            }
        )


def _scan_headers(spark: SparkSession, root: str, glob: str, recursive: bool) -> DataFrame:
    """Headers by Spark's own reader, for stores that only Spark can open.

    Reads the files once; the first line of each is found by a minimum that is
    combined before the shuffle.  Quoted line breaks in a header are not joined.
    """
    lines = (
        spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower())
        .text(root)
        .select(
            F.col("_metadata.file_path").alias("uri"), F.col("value"),
            F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"),
        )
    )
    first = lines.where(F.trim("value") != "").groupBy("uri").agg(F.min_by("value", "place").alias("header"))
    header = F.regexp_replace("header", "^\\uFEFF", "")
    return first.select(F.col("uri").alias("path"), "uri", F.lit("ok").alias("status"), header.alias("header"))


def probe_headers(spark: SparkSession, root: str, glob: str = "*.csv", recursive: bool = False) -> DataFrame:
    """(path, uri, status, header text) per file; status is ok, empty or unreadable: ...

    One read of the first lines of each file, spread over the executors.
    """
    scheme = re.match(r"(\w[\w+.-]+):", root)
    if scheme and scheme.group(1) not in _OPENED:
        return _scan_headers(spark, root, glob, recursive)
    files = list_files(spark, root, glob, recursive)
    return files.select("path", "uri").mapInPandas(_probe, HEADER_SCHEMA)


def split_header(line: str) -> list[str]:
    return next(csv.reader(io.StringIO(line)))


def list_folders(spark: SparkSession, root: str, pattern: str, finished: bool = True) -> list[str]:
    """First groups of ``pattern`` over the names of folders right below ``root``, sorted.

    One listing of one level through Hadoop's file system; ``finished`` leaves out
    folders whose writer has not committed.  A missing root has no folders.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.exists(path):
        return []
    found = []
    for status in store.listStatus(path):
        match = re.fullmatch(pattern, status.getPath().getName())
        if match and status.isDirectory():
            done = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if not finished or store.exists(done):
                found.append(match.group(1))
    return sorted(found)


def claim_file(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if another writer has it already."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(place.getParent())
    return bool(store.createNewFile(place))
