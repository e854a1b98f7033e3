"""Whitening against plain numpy on the same tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from nightgrid.llm.whitening import op11_embedding_whitening, whiten


def usable(rows):
    return [r for r in rows if r.embedding is not None and all(c is not None and np.isfinite(c) and abs(c) < 1e11 for c in r.embedding)]


def expected(vectors):
    """(n, deviations, whitened, explained) of vectors of one length."""
    x = np.floor(1024 * np.array(vectors, float)).astype(np.int64) + 100_000
    n, s = len(x), x.astype(object).sum(0)
    z = x - s.astype(float) / n
    v = z.T @ z / n
    values, vectors = np.linalg.eigh(v)
    order = np.argsort(-values)[:8]
    with np.errstate(all="ignore"):
        scores = z @ vectors[:, order] / np.sqrt(values[order])
    return n, ((n * x.astype(object) - s) ** 2).sum(1), scores, values[order] / np.trace(v)


@pytest.mark.parametrize("copies", [1, 3])
def test_equals_numpy(spark, sf_dir, copies):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id")
    if copies > 1:  # the first fifty vectors again, and one of them very often
        again = table.limit(50).withColumn("vec_id", F.col("vec_id") + 100_000)
        often = table.limit(1).drop("vec_id").crossJoin(spark.range(400).select((F.col("id") + 200_000).alias("vec_id"))).select(table.columns)
        table = table.unionByName(again).unionByName(often)
    rows = usable(table.collect())
    n, deviation, scores, explained = expected([r.embedding for r in rows])
    found = {r.vec_id: r for r in whiten(table.select("vec_id", "embedding")).collect()}
    assert len(found) == len(rows)
    got = np.array([found[r.vec_id].whitened for r in rows])
    signs = np.sign((got * scores).sum(0))
    assert np.abs(got * signs - scores).max() < 1e-8
    assert [int(found[r.vec_id].deviation) for r in rows] == list(deviation)
    assert {r.n for r in found.values()} == {n}
    assert np.allclose(found[rows[0].vec_id].explained, explained, rtol=1e-9)
    assert 0 <= found[rows[0].vec_id].identity_error < 1e-9


def test_each_distinct_vector_once(spark):
    rows = [(i, [0.0, 1.0]) for i in range(50)] + [(50, [1.0, 0.0]), (51, [2.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    by_rows, once = whiten(df), whiten(df, weights="one")
    assert {r.n for r in by_rows.collect()} == {52} and {r.n for r in once.collect()} == {3}
    assert once.count() == 52 and max(r.identity_error for r in once.collect()) < 1e-9
    with pytest.raises(ValueError):
        whiten(df, weights="none")


def test_odd_vectors(spark, odd_dir):
    table = spark.read.parquet(f"{odd_dir}/embeddings.parquet")
    found = whiten(table).collect()
    by_id = {}
    for r in found:
        by_id.setdefault(r.vec_id, []).append(r)
    assert set(by_id) == {0, 1, 6, 8, 9, 12, None} and len(by_id[9]) == 2
    assert found[0].asDict().keys() >= {"vec_id", "label", "n", "whitened"}
    assert by_id[0][0].whitened == by_id[1][0].whitened and by_id[0][0].n == 7
    # One vector of its length has no variance.
    assert by_id[8][0].whitened == [None, None] and by_id[8][0].n == 1 and by_id[8][0].identity_error == 0
    long = op11_embedding_whitening(spark, odd_dir).collect()
    assert sorted({r.component for r in long if r.vec_id == 0}) == [1, 2, 3]


def test_exact_deviation_of_far_values(spark):
    rows = [(i, [float(v), -float(v) / 3]) for i, v in enumerate((2**37, 5, 2**30, -(2**37)))]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    _, deviation, _, _ = expected([r[1] for r in rows])
    assert [int(r.deviation) for r in whiten(table).orderBy("vec_id").collect()] == list(deviation)
