"""Embedding whitening by a covariance over distinct vectors with multiplicities.

Vectors become whole numbers, ``floor(scale * c) + shift``.  Identical ones are grouped, the
groups are the rows of the fit with their counts (or one) as weights: centred blocks are
multiplied as matrices per task, the blocks' products are summed by Spark, and only the
covariance, of the size of the dimension squared, reaches the driver for its eigenvectors.
Each distinct vector is whitened once and joined back to its rows.

Cases: rows whose vector is null or empty, or holds a null, non-finite or very large entry (beyond
``LARGEST`` either way), are left out.  Vectors of different lengths are fitted each length for itself.  A component without variance has null
``whitened`` and takes no part in ``identity_error``.  Equal rows, and rows without an id, stay rows of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from nightgrid.llm.common import table, written
from nightgrid.operators.heavy import join_by_weight

#: Entries beyond this have no whole number that a double holds exactly.
LARGEST = float(1 << 38)
#: Rows of a distinct table that are multiplied together.
BLOCK_ROWS = 4096
#: An eigenvalue under this share of the trace counts as no variance.
NO_VARIANCE = 1e-14

_SUMS = "d int, part int, sums array<double>"


def _whole_numbers(vector: Column, scale: int, shift: int) -> Column:
    """The vector as longs; null where it can't be used."""
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) <= LARGEST))
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("long") + shift)
    return F.when((F.size(vector) > 0) & F.coalesce(good, F.lit(False)), x)


def _matrix(column: pa.ListArray, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), d)


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch]]:
    sizes = np.asarray(batch.column("d"))
    for d in np.unique(sizes):
        yield int(d), batch.filter(pa.array(sizes == d))


def _row_sums(parts: dict[tuple[int, int], np.ndarray]) -> pa.RecordBatch:
    keys = list(parts)
    return pa.RecordBatch.from_arrays(
        [
            pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()),
            pa.array([parts[k] for k in keys], pa.list_(pa.float64())),
        ],
        names=["d", "part", "sums"],
    )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of arrays per (d, part): one row of a matrix each."""
    sums: dict[tuple[int, int], np.ndarray] = {}
    for batch in batches:
        for d, part, row in zip(*(batch.column(n) for n in ("d", "part", "sums")), strict=True):
            key = (d.as_py(), part.as_py())
            values = row.values.to_numpy(zero_copy_only=False)
            sums[key] = sums[key] + values if key in sums else values.copy()
    if sums:
        yield _row_sums(sums)


def _summed(partial: DataFrame) -> dict[int, dict[int, np.ndarray]]:
    """Partial matrix rows of all tasks, added up row by row on the executors."""
    rows = partial.repartition("d", "part").mapInArrow(_added, _SUMS).collect()
    out: dict[int, dict[int, np.ndarray]] = {}
    for r in rows:
        out.setdefault(r.d, {})[r.part] = np.array(r.sums)
    return out


class _Fit:
    """Mean and components of the vectors of one length."""

    def __init__(self, n: int, sums: list[int]) -> None:
        self.n, self.sums = n, sums
        self.center = np.array([round(s / n) if abs(s) < 1 << 53 else (2 * s + n) // (2 * n) for s in sums], np.int64)
        self.rest = [s - n * int(m) for s, m in zip(sums, self.center, strict=True)]

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n as doubles; the whole part is taken off exactly first."""
        return (x - self.center).astype(np.float64) - np.array(self.rest, np.float64) / self.n

    def solve(self, covariance: np.ndarray, components: int) -> None:
        values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
        order = np.argsort(-values, kind="stable")[:components]
        self.trace = float(np.trace(covariance))
        self.values, self.vectors = values[order], vectors[:, order]
        self.varies = self.values > NO_VARIANCE * max(self.trace, 0.0)
        if not self.trace > 0:
            self.varies[:] = False

    def whitened(self, x: np.ndarray) -> np.ndarray:
        scores = self.centred(x) @ self.vectors
        return np.where(self.varies, scores / np.sqrt(np.where(self.varies, self.values, 1.0)), np.nan)

    def deviations(self, x: np.ndarray) -> list[int]:
        """sum((n x - S)^2), exact: with y = x - center it is n^2 sum(y^2) - 2n sum(y r) + sum(r^2)."""
        y = x - self.center
        big = int(np.abs(y).max(initial=0)) * max(int(np.abs(y).max(initial=0)), self.n) * max(len(self.sums), 1)
        y = y.astype(object) if big >= 1 << 61 else y
        squares = (y * y).sum(axis=1)
        mixed = (y * np.array(self.rest, object if big >= 1 << 61 else np.int64)).sum(axis=1)
        last = sum(r * r for r in self.rest)
        return [self.n**2 * int(a) - 2 * self.n * int(b) + last for a, b in zip(squares, mixed, strict=True)]


def whiten(
    df: DataFrame, vector: str = "embedding", scale: int = 1024, shift: int = 100_000, components: int = 8, weights: str = "counts"
) -> DataFrame:
    """The rows of ``df`` with a usable vector, and its whitening.

    Adds n (rows or distinct vectors of the fit), deviation (decimal, exact), whitened, eigenvalues,
    explained (arrays, one entry a component, by falling eigenvalue) and identity_error.
    ``weights``: "counts" fits all rows, "one" fits each distinct vector once.
    """
    if weights not in ("counts", "one"):
        raise ValueError("weights must be counts or one")
    x = _whole_numbers(F.col(vector), scale, shift)
    spark = df.sparkSession
    distinct = written(
        df.select(x.alias("__llm_x")).where(F.col("__llm_x").isNotNull())
        .groupBy("__llm_x").agg(F.count("*").alias("__llm_rows"))
        .withColumn("d", F.size("__llm_x")),
        "distinct-vectors",
    )
    by_count = weights == "counts"
    fits = _fitted(distinct, by_count, components)
    shared = spark.sparkContext.broadcast(fits)

    def whitened_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, part in _by_length(batch):
                fit = shared.value[d]
                points = _matrix(part.column("__llm_x"), d)
                scores = fit.whitened(points)
                deviation = [str(v) for v in fit.deviations(points)]
                lists = pa.ListArray.from_arrays(
                    np.arange(len(scores) + 1, dtype=np.int32) * scores.shape[1], pa.array(scores.reshape(-1), from_pandas=True)
                )
                yield pa.RecordBatch.from_arrays(
                    [part.column("__llm_x"), part.column("__llm_rows"), part.column("d"), pa.array(deviation), lists],
                    names=["__llm_x", "__llm_rows", "d", "deviation", "whitened"],
                )

    schema = "__llm_x array<bigint>, __llm_rows bigint, d int, deviation string, whitened array<double>"
    points = written(distinct.mapInArrow(whitened_rows, schema), "whitened-vectors")
    errors = _identity_errors(points, fits, by_count)
    facts = [
        (d, f.n, [float(v) for v in f.values], [float(v) / f.trace if f.trace > 0 else 0.0 for v in f.values], errors.get(d, 0.0))
        for d, f in fits.items()
    ]
    # One row for each length of a vector.
    per_fit = spark.createDataFrame(facts, "d int, n bigint, eigenvalues array<double>, explained array<double>, identity_error double")
    points = points.join(F.broadcast(per_fit), "d").select(
        "__llm_x", "__llm_rows", "n", F.col("deviation").cast("decimal(38,0)").alias("deviation"),
        "whitened", "eigenvalues", "explained", "identity_error",
    )
    results = ["n", "deviation", "whitened", "eigenvalues", "explained", "identity_error"]
    taken = {c.lower() for c in (*results, "__llm_x", "__llm_rows")}
    kept = [c for c in df.columns if c.lower() not in taken]
    rows = df.withColumn("__llm_x", x).where(F.col("__llm_x").isNotNull()).select("__llm_x", *kept)
    return join_by_weight(rows, points, ["__llm_x"], "__llm_rows").drop("__llm_x")


def _fitted(distinct: DataFrame, by_count: bool, components: int) -> dict[int, _Fit]:
    weight = F.col("__llm_rows") if by_count else F.lit(1)
    sums = (
        distinct.select("d", weight.alias("w"), F.posexplode("__llm_x").alias("i", "v"))
        .groupBy("d", "i").agg(F.sum("w").alias("n"), F.sum(F.col("v").cast("decimal(28,0)") * F.col("w")).alias("s"))
        .collect()
    )
    by_length: dict[int, list] = {}
    for r in sums:
        by_length.setdefault(r.d, []).append(r)
    fits = {
        d: _Fit(rows[0].n, [int(r.s) for r in sorted(rows, key=lambda r: r.i)]) for d, rows in by_length.items()
    }
    shared = distinct.sparkSession.sparkContext.broadcast(fits)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """This task's weighted sum of centred x x', row by row."""
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for d, part in _by_length(batch):
                points, counts = _matrix(part.column("__llm_x"), d), np.asarray(part.column("__llm_rows"), np.float64)
                for at in range(0, len(points), BLOCK_ROWS):
                    z = shared.value[d].centred(points[at : at + BLOCK_ROWS])
                    w = counts[at : at + BLOCK_ROWS] if by_count else np.ones(len(z))
                    found[d] = found.get(d, 0.0) + (z * w[:, None]).T @ z
        for d, m in found.items():
            yield _row_sums({(d, i): m[i] for i in range(d)})

    for d, rows in _summed(distinct.mapInArrow(products, _SUMS)).items():
        fits[d].solve(np.stack([rows[i] for i in range(d)]) / fits[d].n, components)
    return fits


def _identity_errors(points: DataFrame, fits: dict[int, _Fit], by_count: bool) -> dict[int, float]:
    """For each length the largest entry of (covariance of the whitened fit list - identity)."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for d, part in _by_length(batch):
                scores = _matrix(part.column("whitened"), len(part.column("whitened")[0]))
                w = np.asarray(part.column("__llm_rows"), np.float64) if by_count else np.ones(len(scores))
                joined = np.column_stack([scores, np.ones(len(scores))])
                m = (joined * w[:, None]).T @ joined
                for i, row in enumerate(m):
                    found[d, i] = found.get((d, i), 0.0) + row
        if found:
            yield _row_sums(found)

    errors = {}
    for d, rows in _summed(points.select("d", "__llm_rows", "whitened").mapInArrow(moments, _SUMS)).items():
        m = np.stack([rows[i] for i in range(len(rows))])
        varies = fits[d].varies
        mean = m[-1, :-1][varies] / fits[d].n
        covariance = m[:-1, :-1][np.ix_(varies, varies)] / fits[d].n - np.outer(mean, mean)
        errors[d] = float(np.abs(covariance - np.eye(len(covariance))).max(initial=0.0))
    return errors


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``embeddings``: up to eight whitened components of every row with a usable vector.

    A deviation beyond 64 bits is null.
    """
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    long = whiten(rows).select(
        "vec_id", "n", F.col("deviation").try_cast("long").alias("deviation"), "identity_error",
        F.posexplode(F.arrays_zip("whitened", "explained")).alias("__llm_at", "__llm_part"),
    )
    return long.select(
        "vec_id", (F.col("__llm_at") + 1).alias("component"), "n", "deviation",
        F.col("__llm_part.whitened").alias("whitened"), F.col("__llm_part.explained").alias("explained"), "identity_error",
    )
