"""Skewed and dirty tables: nothing is gathered in one task, nothing unfolds without bound."""

import datetime as dt
from collections.abc import Iterator

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window, functions as F

from nightgrid.operators import chart_detector, chart_temporal, grid, profile, quantiles, reshape
from nightgrid.operators.heavy import heavy_hashes, join_by_weight
from nightgrid.operators.running import running_folds


def hot(spark):
    """One key with 90 % of the rows, one of NULLs, many single ones."""
    n = 20_000
    key = F.when(F.col("id") % 10 < 9, "hot").when(F.col("id") % 100 == 9, F.lit(None)).otherwise(F.concat(F.lit("k"), (F.col("id") / 3).cast("int")))
    return spark.range(n).repartition(6).select("id", key.alias("k"), (F.col("id") % 2).alias("other"))


def test_rows_in_group_with_a_hot_key(spark):
    df = hot(spark)
    found = reshape.rows_in_group(df, ["k", "other"])
    expected = df.withColumn("n_occurrences", F.count("*").over(Window.partitionBy("k", "other")))
    assert found.columns == expected.columns
    assert found.exceptAll(expected).count() == 0 and found.count() == df.count()
    assert 2 <= len(heavy_hashes(df, ["k"])) < 20
    # The hot key's rows are dealt out over many parts.
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_rows_in_group_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, 2), (1, 3), (None, 4)], "a int, n int")
    assert sorted(map(tuple, reshape.rows_in_group(df, ["a"]).collect()), key=repr) == [(1, 2, 2), (1, 3, 2), (None, 4, 1)]
    assert reshape.rows_in_group(df.limit(0), ["a"]).count() == 0


def test_duplicate_rows_with_a_hot_key(spark):
    assert profile.duplicate_rows(hot(spark), ["k"]).where("k = 'hot'").count() == 18_000


def test_join_by_weight_equals_a_join(spark):
    facts = hot(spark)
    dims = facts.groupBy("k").agg(F.count("*").alias("w"), F.min("id").alias("least")).where("k IS NOT NULL AND k <> 'k4'")
    for how in ("inner", "left"):
        found = join_by_weight(facts, dims, ["k"], "w", how)
        expected = facts.join(dims.drop("w"), "k", how).select(found.columns)
        assert found.exceptAll(expected).count() == 0 and expected.exceptAll(found).count() == 0


@pytest.mark.parametrize("parts", ["1", "7"])
def test_running_folds_over_split_groups(spark, parts):
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.execution.arrow.maxRecordsPerBatch")}
    try:
        for k, v in zip(old, (parts, "false", "333"), strict=True):
            spark.conf.set(k, v)
        df = hot(spark).withColumn("v", F.col("id") * 7 % 101 - 50)
        found = running_folds(df, ["k"], ["id"], {"s": (F.col("v"), "sum"), "x": (F.col("v"), "xor")})
        order = Window.partitionBy("k").orderBy("id")
        expected = df.select("*", F.sum("v").over(order).alias("s"), F.bit_xor("v").over(order).alias("x"))
        assert found.exceptAll(expected).count() == 0 and found.count() == df.count()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_quantiles_of_values_that_lie_close_together(spark):
    """All values within one part in a million, some of them very often."""
    df = spark.range(30_001).select((F.lit(5.0) + F.col("id") % 3001 / 1e9).alias("x"), F.lit(1.5).alias("same"))
    found = quantiles.exact_percentiles(df, {"x": [0, 0.1, 0.5, 0.9, 1], "same": [0.5]}).first()
    values = df.agg(F.percentile("x", F.array(*[F.lit(p) for p in (0.0, 0.1, 0.5, 0.9, 1.0)]))).first()[0]
    assert [found[f"x_p{i}"] for i in range(5)] == pytest.approx(values, abs=1e-15) and found.same_p0 == 1.5


def test_weighted_quantiles(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 1), (float("nan"), 9), (None, 9), (8.0, 2)], "x double, n int")
    found = quantiles.exact_percentiles(df, {"x": [0.5, 1.0]}, weight="n").first()
    assert (found.x_p0, found.x_p1) == (1.5, 8.0)


def test_ranks_with_one_mean_for_most(spark):
    rows = [(f"d{i:03d}", dt.date(2025, 10, 1), 5 if i < 150 else i) for i in range(200)]
    df = spark.createDataFrame(rows, "Detector string, Night date, CallsPerNight int")
    found = {r.Detector: r["rank"] for r in chart_detector.rolling_mean_rank(df, window=1).collect()}
    assert found["d199"] == 1 and found["d150"] == 50 and {found[f"d{i:03d}"] for i in range(150)} == {125.5}


def grid_rows(spark, *nights):
    return spark.createDataFrame([("a", dt.date.fromisoformat(n), 2.0) for n in nights] + [("b", None, 1.0)], "Detector string, Night date, RecordingHours double")


def test_one_wrong_date_changes_no_size(spark):
    good = ("2025-10-02", "2025-10-03", "2025-10-06")
    dirty = grid_rows(spark, "0001-01-01", *good, "9999-12-31")
    for build in (grid.effort_grid, grid.complete_grid_coverage):
        dates = {"start_date": "2025-10-01", "end_date": "2025-10-07"}
        assert build(dirty, **dates).exceptAll(build(grid_rows(spark, *good), **dates)).count() == 0
        assert build(dirty, **dates).count() == 14
        with pytest.raises(Exception, match="study dates"):
            build(dirty).count()
    outside = grid.nights_outside(dirty, "2025-10-01", "2025-10-07").collect()
    assert sorted((r.Detector, str(r.first), r.n_nights, r.side) for r in outside) == [("a", "0001-01-01", 1, "before"), ("a", "9999-12-31", 1, "after")]


def test_runs_and_gaps(spark):
    df = grid_rows(spark, "2025-09-29", "2025-09-30", "2025-10-01", "2025-10-01", "2025-10-03", "2025-10-04", "2025-10-09")
    runs = sorted((str(r.first), str(r.last), r.n_nights) for r in grid.night_runs(df).collect())
    assert runs == [("2025-09-29", "2025-10-01", 3), ("2025-10-03", "2025-10-04", 2), ("2025-10-09", "2025-10-09", 1)]
    gaps = sorted((r.Detector, str(r.first), str(r.last), r.n_nights) for r in grid.missing_runs(df, "2025-09-30", "2025-10-07").collect())
    assert gaps == [("a", "2025-10-02", "2025-10-02", 1), ("a", "2025-10-05", "2025-10-07", 3), ("b", "2025-09-30", "2025-10-07", 8)]
    cut = grid.nights_outside(df, "2025-09-30", "2025-10-07").collect()
    assert sorted((str(r.first), r.n_nights) for r in cut) == [("2025-09-29", 1), ("2025-10-09", 1)]


@pytest.mark.parametrize("block", [3, 4096])
def test_completed_labels(spark, monkeypatch, block):
    monkeypatch.setattr(reshape, "LABEL_BLOCK", block)
    rows = [("a", "s3", 2), ("a", "s1", 1), ("b", "s7", 4), (None, "s1", 9), ("c", None, 5), *[("d", f"s{i}", i) for i in range(9)]]
    found = reshape.completed(spark.createDataFrame(rows, "Detector string, species string, n_calls int"), "Detector", "species")
    got = sorted(map(tuple, found.select("Detector", "species", "n_calls").collect()), key=repr)
    there = {(d, s): n for d, s, n in rows if s}
    assert got == sorted(((d, f"s{i}", there.get((d, f"s{i}"), 0)) for d in ("a", "b", "d", None) for i in range(9)), key=repr)


def test_histogram_shows_empty_bins(spark):
    df = spark.createDataFrame([(0.5,), (0.52,), (3.1,), (None,), (float("inf"),)], "CallsPerHour double")
    bins = {round(r.bin_center, 6): r for r in chart_temporal.calls_per_hour_histogram(df, 1.0).collect()}
    assert {k: r.n for k, r in bins.items()} == {0.0: 1, 1.0: 1, 2.0: 0, 3.0: 1}
    assert bins[0.0].median_cph == 0.52 and bins[0.0].mean_cph == pytest.approx(4.12 / 3)
    far = spark.createDataFrame([(0.5,), (1e12,)], "CallsPerHour double")
    assert chart_temporal.calls_per_hour_histogram(far, 0.1, empty_bins=False).count() == 2
    with pytest.raises(PySparkException, match="empty bins"):
        chart_temporal.calls_per_hour_histogram(far, 0.1).count()


def test_a_night_without_status_is_reported(spark):
    rows = [("a", dt.date(2025, 10, 1), None, 3.0), ("a", dt.date(2025, 10, 2), "Success", 9.0), ("a", dt.date(2025, 10, 3), "Fail", 0.0)]
    df = spark.createDataFrame(rows, "Detector string, Night date, Status string, RecordingHours double")
    found = profile.temporal_completeness(df.select("Detector", "Night"), df, 9.0)
    assert sorted((r.Night.day, r.status) for r in found.collect()) == [(1, "Unknown"), (3, "NoData")]


def test_shared_and_missing_names(spark):
    ids = spark.range(3000).select(F.concat(F.lit("id"), "id").alias("detector_id"))
    names = spark.createDataFrame([("id1", "North"), ("id2", "North"), ("id3", "South"), ("id4", "ENTER_NAME_HERE")], "detector_id string, Detector string")
    found = {r.detector_id: r for r in profile.mapping_quality(ids, names).collect()}
    assert len(found) == 3000 and {k for k, r in found.items() if r.duplicate_name} == {"id1", "id2"}
    assert found["id4"].is_placeholder and not found["id5"].mapped


def test_pairs_of_many_detectors_send_each_vector_to_few_blocks(spark, monkeypatch):
    monkeypatch.setattr(chart_detector, "DETECTORS_PER_BLOCK", 4)
    monkeypatch.setattr(chart_detector, "MOST_BLOCKS", 3, raising=False)
    monkeypatch.setattr(chart_detector, "PAIRS", 16, raising=False)
    n = 60
    cells = spark.range(n * 8).select(
        F.concat(F.lit("d"), F.lpad((F.col("id") % n).cast("string"), 3, "0")).alias("Detector"),
        F.date_add(F.lit(dt.date(2025, 10, 1)), (F.col("id") / n).cast("int")).alias("Night"),
        F.pmod(F.xxhash64("id"), F.lit(7)).alias("CallsPerNight"),
    )
    pairs = chart_detector.pair_statistics(cells)
    found = {(r.Detector1, r.Detector2): r.n_nights for r in pairs.collect()}
    names = [f"d{k:03}" for k in range(n)]
    assert found == {(a, b): 8 for a in names for b in names if a < b}
    # 60 vectors go to 4 blocks of 16 at most, not to 15 of 4 each.
    looked = chart_detector._block_statistics

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_rows = sum(map(len, batches))
        yield pa.RecordBatch.from_pydict({"Detector1": ["a"], "Detector2": ["b"], "n_nights": [n_rows], "Correlation": [0.0]})

    monkeypatch.setattr(chart_detector, "_block_statistics", counted)
    assert chart_detector.pair_statistics(cells).agg(F.sum("n_nights")).first()[0] <= n * 4
    # A task holds the pairs of a few rows, not all of two blocks.
    columns = {"Detector": [f"x{k}" for k in range(8)], "values": [[float(k), 2.0, 1.0] for k in range(8)], "block": [0] * 8, "low": [0] * 8, "high": [0] * 8}
    parts = list(looked(iter([pa.RecordBatch.from_pydict(columns)])))
    assert sum(map(len, parts)) == 28 and max(map(len, parts)) <= 16
