"""Running sums over ordered groups of any size.

A window gathers a group in one task.  Here rows are ranged by (group, order), so a large
group lies in several neighbouring partitions; each partition sums its own rows, and only
the totals of the groups at partition edges are carried on.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import BooleanType, IntegerType, StructField, StructType

from nightgrid.sources.scratch import materialize

_GROUP, _PART, _EDGE = "_run_group", "_run_part", "_run_edge"


def _group_hash(columns: Sequence[str]) -> Column:
    return F.xxhash64(*[c for name in columns for c in (F.isnull(name), F.col(name))])


def _scan(values: np.ndarray, starts: np.ndarray, carried: int, fold: str) -> np.ndarray:
    """Running folds that begin anew at ``starts``; rows before the first go on from ``carried``."""
    step = np.bitwise_xor if fold == "xor" else np.add
    total = step.accumulate(values) if len(values) else values
    before = np.zeros(len(values), np.int64)
    if len(starts):
        base = np.where(starts > 0, total[np.maximum(starts - 1, 0)], 0)
        lengths = np.diff(np.append(starts, len(values)))
        before[starts[0] :] = np.repeat(base, lengths)
    out = total ^ before if fold == "xor" else total - before
    head = int(starts[0]) if len(starts) else len(values)
    out[:head] = step(out[:head], np.int64(carried))
    return out


def _local(batches: Iterator[pa.RecordBatch], folds: dict[str, str]) -> Iterator[pa.RecordBatch]:
    """Folds within this partition.  ``_run_edge`` marks the last rows of its first and last group."""
    part = TaskContext.get().partitionId()
    carried, last, first_group, held = dict.fromkeys(folds, 0), None, True, None
    for batch in batches:
        if not batch.num_rows:
            continue
        group = batch.column(_GROUP).to_numpy(zero_copy_only=False)
        new = np.ones(len(group), bool)
        new[1:] = group[1:] != group[:-1]
        new[0] = last is None or group[0] != last
        starts = np.flatnonzero(new)
        edge = np.zeros(len(group), bool)
        inner = starts[starts > 0] if last is None else starts
        if first_group and len(inner):
            first_group = False
            if inner[0] > 0:
                edge[inner[0] - 1] = True
            else:
                held[1][-1] = True
        if held is not None:
            yield _finished(*held, part)
        columns = {}
        for name, fold in folds.items():
            at = batch.schema.get_field_index(name)
            columns[at] = _scan(batch.column(at).to_numpy(zero_copy_only=False).astype(np.int64), starts, carried[name], fold)
            carried[name] = int(columns[at][-1])
        last = group[-1]
        arrays = [pa.array(columns[i]) if i in columns else c for i, c in enumerate(batch.columns)]
        held = (pa.RecordBatch.from_arrays(arrays, names=batch.schema.names), edge)
    if held is not None:
        held[1][-1] = True
        yield _finished(*held, part)


def _finished(batch: pa.RecordBatch, edge: np.ndarray, part: int) -> pa.RecordBatch:
    arrays = [*batch.columns, pa.array(np.full(len(edge), part, np.int32)), pa.array(edge)]
    return pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, _PART, _EDGE])


def running_folds(
    df: DataFrame, group: Sequence[str], order: Sequence[str | Column], folds: Mapping[str, tuple[Column, str]], label: str = "running"
) -> DataFrame:
    """``df`` with, for each name in ``folds``, the fold of its group's rows up to this one.

    A fold is (long column, "sum" or "xor"); sums wrap beyond 64 bits, NULL counts as 0.
    NULL group keys equal each other.  Rows that tie in ``order`` come in any order.  A group
    may hold any share of the rows; only rows that tie in group and order stay together.
    """
    names = list(folds)
    prepared = df.withColumns(
        {n: F.coalesce(c.cast("long"), F.lit(0).cast("long")) for n, (c, _) in folds.items()} | {_GROUP: _group_hash(group)}
    )
    keys = [*group, *order]
    ranged = prepared.repartitionByRange(*keys).sortWithinPartitions(*keys)
    kinds = {n: kind for n, (_, kind) in folds.items()}
    schema = StructType([*prepared.schema.fields, StructField(_PART, IntegerType()), StructField(_EDGE, BooleanType())])
    summed = materialize(ranged.mapInArrow(lambda batches: _local(batches, kinds), schema), label)
    # At most two rows a partition: what earlier partitions hold of the same group.
    earlier = Window.partitionBy(_GROUP).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    carry = {n: F.bit_xor(n) if kinds[n] == "xor" else F.sum(n) for n in names}
    offsets = summed.where(_EDGE).select(_PART, _GROUP, *names).dropDuplicates([_PART, _GROUP])
    offsets = offsets.select(_PART, _GROUP, *[F.coalesce(c.over(earlier), F.lit(0)).alias(f"{n}_before") for n, c in carry.items()])
    joined = summed.join(F.broadcast(offsets), [_PART, _GROUP], "left")

    def whole(n: str) -> Column:
        before = F.coalesce(f"{n}_before", F.lit(0).cast("long"))
        return F.col(n).bitwiseXOR(before) if kinds[n] == "xor" else F.col(n) + before

    rest = [c for c in prepared.columns if c not in names and c != _GROUP]
    return joined.select(*rest, *[whole(n).alias(n) for n in names])
