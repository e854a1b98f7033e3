"""CSV records with line breaks inside quotes, from splits of a file.

A split does not know whether it begins inside quotes.  Each line is therefore a map from the
state before it (outside or inside quotes) to the state after it; most lines change nothing.  The
maps of a split's lines are composed in one look at the files, and composing the splits of
a file in order gives the state each one begins in.  Then every split cuts its own records; only
the pieces at its two ends meet those of its neighbours.  Quotes count where a field begins,
so a stray quote within a field opens nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from nightgrid.sources.scratch import materialize

_WITHIN = r'[^"]*+(?:""[^"]*+)*+"'
_QUOTED_FIELD = r'(^|,)[ \t]*+"' + _WITHIN
_OPEN_FIELD = r'(^|,)[ \t]*+"'

_OUTSIDE, _INSIDE = 0, 1


def _opens(text: Column) -> Column:
    """Whether a line that begins outside quotes ends inside."""
    return F.regexp_replace(text, F.lit(_QUOTED_FIELD), F.lit("$1x")).rlike(_OPEN_FIELD)


def _turn(line: Column) -> Column:
    """0 where a line leaves the state as it is; bit 1: outside ends inside; bit 0: inside ends outside."""
    closes = line.rlike("^" + _WITHIN)
    rest = F.regexp_replace(line, F.lit("^" + _WITHIN), F.lit("x"))
    code = F.when(_opens(line), 2).otherwise(0) + F.when(closes & ~_opens(rest), 1).otherwise(0)
    return F.when(F.instr(line, '"') > 0, code).otherwise(0).cast("int")


def _after(turn: int, state: int) -> int:
    return (turn >> 1 & 1) if state == _OUTSIDE else 1 - (turn & 1)


def _lines(spark: SparkSession, root: str, glob: str, recursive: bool, skip_corrupt: bool) -> DataFrame:
    """(value, path, name, split, turn) of every line, in file order within a task."""
    reader = spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", str(recursive).lower())
    return reader.option("ignoreCorruptFiles", skip_corrupt).text(root).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_block_start").alias("split"), _turn(F.col("value")).alias("turn"),
    )


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Neighbouring lines of one split."""
    path, split = batch.column("path").dictionary_encode(), np.asarray(batch.column("split"))
    which = np.asarray(path.indices)
    starts = np.flatnonzero(np.append(True, (which[1:] != which[:-1]) | (split[1:] != split[:-1])))
    for a, b in zip(starts, [*starts[1:], batch.num_rows], strict=True):
        yield (path.dictionary[which[a]].as_py(), int(split[a])), batch.slice(a, b - a)


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per split the states it ends in after having begun outside and inside, and whether any line opens a quote."""
    ends: dict[tuple[str, int], list[int]] = {}
    for batch in batches:
        if batch.num_rows:
            for key, part in _runs(batch):
                found = ends.setdefault(key, [_OUTSIDE, _INSIDE, 0])
                for turn in part.column("turn").to_pylist():
                    found[:] = [_after(turn, found[0]), _after(turn, found[1]), found[2] | turn >> 1]
    if ends:
        columns = zip(*ends.values(), strict=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in ends]), pa.array([k[1] for k in ends], pa.int64()), *[pa.array(c, pa.int32()) for c in columns]],
            names=["path", "split", "outside", "inside", "opens"],
        )


def open_splits(
    spark: SparkSession, root: str, glob: str = "*.csv", recursive: bool = False, skip_corrupt: bool = False
) -> dict[str, list[tuple[int, int]]] | None:
    """None if no record of any file goes over a line's end; else the splits that begin inside quotes.

    They are given per path as (a, b): splits that start after a, and at b at the latest.  One look at the
    files; lines that change nothing never leave the scan.  The driver gets an entry for each split that ends inside quotes.
    """
    turning = _lines(spark, root, glob, recursive, skip_corrupt).where("turn != 0").select("path", "split", "turn")
    schema = "path string, split bigint, outside int, inside int, opens int"
    maps = materialize(turning.mapInArrow(_composed, schema), "quote-states")
    if maps.where("opens = 1").isEmpty():
        return None
    # A file has an entry for each split that turns anything.
    ordered = maps.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("split", "outside", "inside"))).alias("maps"))
    interval = "array<struct<after:bigint,until:bigint>>"
    start = F.struct(F.lit(_OUTSIDE).alias("state"), F.lit(-1).cast("bigint").alias("since"), F.array().cast(interval).alias("found"))

    def extended(acc: Column, until: Column) -> Column:
        new = F.array(F.struct(acc["since"].alias("after"), until.alias("until")))
        return F.when(acc["state"] == _INSIDE, F.concat(acc["found"], new)).otherwise(acc["found"])

    def step(acc: Column, m: Column) -> Column:
        state = F.when(acc["state"] == _OUTSIDE, m["outside"]).otherwise(m["inside"])
        return F.struct(state.alias("state"), m["split"].alias("since"), extended(acc, m["split"]).alias("found"))

    found = F.aggregate("maps", start, step, lambda acc: extended(acc, F.lit((1 << 63) - 1)))
    rows = ordered.select("path", found.alias("found")).where(F.size("found") > 0).collect()
    return {r.path: [(i.after, i.until) for i in r.found] for r in rows}


class _Cutter:
    """Cuts the lines of one task into records."""

    def __init__(self, inside: dict[str, list[tuple[int, int]]]) -> None:
        self.inside, self.key, self.pending, self.out = inside, None, [], []

    def begin(self, key: tuple[str, int], name: str) -> None:
        self.end()
        self.key, self.name, self.row = key, name, 0
        self.opened = False
        self.state = int(any(a < key[1] <= b for a, b in self.inside.get(key[0], ())))
        self.awaits_header = key[1] == 0

    def end(self) -> None:
        """What is left is a record that goes on in the next split, or a whole split within one."""
        if self.pending:
            self.emit(pa.array([b"\n".join(self.pending)], pa.binary()), self.opened)
            self.pending = []

    def emit(self, records: pa.Array, opens: bool | None) -> None:
        n = len(records)
        first = np.zeros(n, bool)
        if self.awaits_header and opens is not False:
            for i in range(n):
                if records[i].as_py().removeprefix(b"\xef\xbb\xbf").strip():
                    first[i], self.awaits_header = True, False
                    break
        rows = np.arange(self.row, self.row + n)
        self.row += n
        self.out.append(
            pa.RecordBatch.from_arrays(
                [
                    records, pa.array([self.key[0]] * n), pa.array([self.name] * n), pa.array(np.full(n, self.key[1])),
                    pa.array(rows), pa.array([opens] * n, pa.bool_()), pa.array(first),
                ],
                names=["record", "path", "name", "split", "row", "opens", "first"],
            )
        )

    def take(self, part: pa.RecordBatch) -> None:
        lines = part.column("value").cast(pa.binary())
        turns = np.asarray(part.column("turn"))
        opening, closing = np.flatnonzero(turns & 2), np.flatnonzero(turns & 1)
        at, n = 0, len(lines)
        while at < n:
            ends = opening if self.state == _OUTSIDE else closing
            k = np.searchsorted(ends, at)
            stop = int(ends[k]) if k < len(ends) else n
            if self.state == _OUTSIDE:
                if stop > at:
                    self.emit(lines.slice(at, stop - at), None)
                if stop < n:
                    self.pending, self.opened, self.state = [lines[stop].as_py()], True, _INSIDE
            else:
                self.pending += lines.slice(at, stop + 1 - at).to_pylist()
                if stop < n:
                    whole = pa.array([b"\n".join(self.pending)], pa.binary())
                    self.emit(whole, None if self.opened else False)
                    self.pending, self.state = [], _OUTSIDE
            at = stop + 1


def _cut(batches: Iterator[pa.RecordBatch], inside: dict[str, list[tuple[int, int]]]) -> Iterator[pa.RecordBatch]:
    cutter = _Cutter(inside)
    for batch in batches:
        if batch.num_rows:
            for key, part in _runs(batch):
                if key != cutter.key:
                    cutter.begin(key, part.column("name")[0].as_py())
                cutter.take(part)
        yield from cutter.out
        cutter.out = []
    cutter.end()
    yield from cutter.out


def records(
    spark: SparkSession, root: str, inside: dict[str, list[tuple[int, int]]], glob: str = "*.csv", recursive: bool = False,
    skip_corrupt: bool = False,
) -> DataFrame:
    """(record, path, name, split, row) of every record below the headers; blank ones are left out.

    A record belongs to the split that it begins in; line breaks within it are line feeds.
    """
    shared = spark.sparkContext.broadcast(inside)
    lines = _lines(spark, root, glob, recursive, skip_corrupt)
    pieces = lines.mapInArrow(
        lambda batches: _cut(batches, shared.value),
        "record binary, path string, name string, split bigint, row bigint, opens boolean, first boolean",
    )
    pieces = pieces.withColumn("record", F.col("record").cast("string"))
    whole = pieces.where(F.col("opens").isNull()).drop("opens")
    # At most two pieces a split: the end of a record and the beginning of another.
    cut = pieces.where(F.col("opens").isNotNull())
    number = F.sum(F.col("opens").cast("int")).over(Window.partitionBy("path").orderBy("split", "row"))
    joined = (
        cut.withColumn("number", number)
        .groupBy("path", "number")
        .agg(
            F.array_sort(F.collect_list(F.struct("split", "row", "record"))).alias("parts"),
            F.min_by("name", "split").alias("name"), F.bool_or("first").alias("first"),
        )
        .select(
            F.array_join(F.transform("parts", lambda p: p["record"]), "\n").alias("record"), "path", "name",
            F.col("parts")[0]["split"].alias("split"), F.col("parts")[0]["row"].alias("row"), "first",
        )
    )
    return whole.unionByName(joined).where(~F.col("first") & (F.trim("record") != "")).drop("first")
