"""Grid, edits, summaries, charts and contracts on literal rows."""

import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from nightgrid.config import Schedule, StudyConfig
from nightgrid.operators import (
    audit, chart_detector, chart_quality, chart_species, chart_temporal, contracts, edits, grid,
    profile, quantiles, reshape, summaries,
)
from nightgrid.operators.condense import condense
from nightgrid.plans import phases
from nightgrid.sources import results, templates

GRID = "Detector string, Night date, CallsPerNight double, RecordingHours double, Status string, CallsPerHour double"


def status_of(hours):
    return "Fail" if hours == 0 else "Success" if abs(hours - 13) < 0.5 else "Partial"


def grid_rows():
    """The golden grid: three detectors, ten nights, 10, 6 and 4 of them with data."""
    data = {
        "DetectorA": ([10, 15, 12, 18, 14, 11, 13, 16, 12, 14], [13] * 10),
        "DetectorB": ([8, 12, 0, 15, 0, 10, 9, 0, 11, 0], [12, 13, 0, 13, 0, 12, 13, 0, 12, 0]),
        "DetectorC": ([5, 0, 0, 7, 0, 0, 0, 6, 0, 8], [11, 0, 0, 10, 0, 0, 0, 9, 0, 12]),
    }
    return [
        (d, dt.date(2025, 1, 1 + i), float(c), float(h), status_of(h), c / h if h else None)
        for d, (calls, hours) in data.items()
        for i, (c, h) in enumerate(zip(calls, hours))
    ]


@pytest.fixture
def golden(spark):
    return spark.createDataFrame(grid_rows(), GRID)


def test_golden_nights_and_missing(golden, rows):
    assert rows(chart_quality.nights_by_detector(golden)) == [("DetectorA", 10), ("DetectorB", 6), ("DetectorC", 4)]
    table = rows(chart_quality.missing_nights(golden), "Detector", "missing_nights", "pct_complete")
    assert table == [("DetectorA", 0, 100.0), ("DetectorB", 4, 60.0), ("DetectorC", 6, 40.0)]
    flagged = chart_quality.nights_by_detector(golden, threshold=6)
    assert rows(flagged, "Detector", "below_threshold")[1:] == [("DetectorB", False), ("DetectorC", True)]


def test_missing_nights_expected_and_silent_detectors(spark, golden, rows):
    silent = spark.createDataFrame([("Quiet", dt.date(2025, 1, 12), 0.0, 0.0, "Fail", None)], GRID)
    both = golden.unionByName(silent)
    by_nights = {r[0]: r for r in rows(chart_quality.missing_nights(both), "Detector", "actual_nights", "expected_nights")}
    assert by_nights["Quiet"] == ("Quiet", 0, 11)
    span = rows(chart_quality.missing_nights(both, "span"), "expected_nights")
    assert set(span) == {(12,)}
    parity = chart_quality.missing_nights(both, drop_silent=True)
    assert "Quiet" not in {r[0] for r in rows(parity, "Detector")}


def test_golden_completeness(golden, rows):
    calendar = grid.complete_grid_coverage(golden)
    present = [r for r in rows(calendar) if r[2]]
    assert calendar.count() == 30 and sum(r[0] == "DetectorB" for r in present) == 6
    assert {r[3] for r in rows(calendar)} == {dt.date(2024, 12, 29), dt.date(2025, 1, 5)}


def test_status_order_and_midpoints(golden):
    table = chart_quality.status_by_detector(golden)
    assert [(r.Detector, r.Status) for r in table.collect()] == [
        ("DetectorA", "Success"), ("DetectorB", "Success"), ("DetectorB", "Partial"),
        ("DetectorB", "Fail"), ("DetectorC", "Partial"), ("DetectorC", "Fail")]
    labels = {(r.Detector, r.Status): r.label_y for r in chart_quality.label_midpoint(table).collect()}
    assert labels["DetectorB", "Fail"] == 2.0 and labels["DetectorB", "Partial"] == 5.5
    assert labels["DetectorB", "Success"] == 8.5


def counts_table(spark, data):
    return spark.createDataFrame(
        [(d, dt.date(2025, 10, day), n) for d, day, n in data], "Detector string, Night date, CallsPerNight bigint")


def brute_fill(data, first, last):
    cells = {(d, day): n for d, day, n in data if d is not None}
    return sorted(
        ((d, dt.date(2025, 10, day), cells.get((d, day), 0))
         for d in {d for d, _ in cells} for day in range(first, last + 1)), key=repr)


@pytest.mark.parametrize("first, last", [(5, 9), (1, 20), (7, 7), (14, 18)])
def test_fill_nights_matches_brute_force(spark, rows, first, last):
    rng = random.Random(first)
    data = [(d, day, rng.randint(1, 9)) for d in "abcd" for day in rng.sample(range(2, 19), 6)]
    data += [("early", 2, 3), ("late", 19, 4), ("mid", 6, 1), ("gap", 3, 1), ("gap", 17, 2), (None, 6, 5)]
    filled = grid.fill_nights(
        counts_table(spark, data), {"CallsPerNight": 0}, f"2025-10-{first:02d}", f"2025-10-{last:02d}")
    assert rows(filled) == brute_fill(data, first, last)


def test_fill_nights_spans_the_data_without_dates(spark, rows):
    data = [("a", 3, 1), ("b", 6, 2)]
    filled = grid.fill_nights(counts_table(spark, data), {"CallsPerNight": 0})
    assert rows(filled) == brute_fill(data, 3, 6)


def test_fill_nights_needs_no_join(spark):
    filled = grid.fill_nights(counts_table(spark, [("a", 3, 1)]), {"CallsPerNight": 0}, "2025-10-01", "2025-10-05")
    assert "Join" not in filled._jdf.queryExecution().executedPlan().toString()


def test_joined_grid_equals_filled_grid(spark, rows):
    counts = counts_table(spark, [("a", 3, 1), ("b", 6, 2), ("b", 4, 2)])
    spine = grid.detector_nights(counts, "2025-10-02", "2025-10-07")
    joined = grid.attach_counts(spine, counts)
    filled = grid.fill_nights(counts, {"CallsPerNight": 0}, "2025-10-02", "2025-10-07")
    assert rows(joined) == rows(filled.select(*joined.columns)) and joined.count() == 12


def test_schedule_per_detector(spark, rows):
    spine = grid.detector_nights(counts_table(spark, [("a", 3, 1), ("b", 3, 1)]), "2025-10-03", "2025-10-03")
    own = spark.createDataFrame([("a", "20:00:00", "06:00:00")], "Detector string, StartTime string, EndTime string")
    hours = grid.scheduled_hours(grid.attach_schedule(spine, per_detector=own))
    assert rows(hours, "Detector", "RecordingHours") == [("a", 10.0), ("b", None)]
    with pytest.raises(ValueError):
        grid.attach_schedule(spine)
    uniform = grid.scheduled_hours(grid.attach_schedule(spine, Schedule()))
    assert {r[0] for r in rows(uniform, "RecordingHours")} == {13.0}


def test_status_and_rate(spark, rows):
    df = spark.createDataFrame([(None,), (-1.0,), (0.0,), (12.5,), (12.6,), (13.4,), (13.5,), (5.0,)], "RecordingHours double")
    df = df.withColumn("CallsPerNight", F.lit(26))
    final = grid.calls_per_hour(grid.classify_status(grid.sanitize_hours(df), 13))
    assert rows(final, "RecordingHours", "Status") == sorted([
        (0.0, "Fail"), (0.0, "Fail"), (0.0, "Fail"), (12.5, "Partial"), (12.6, "Success"),
        (13.4, "Success"), (13.5, "Partial"), (5.0, "Partial")], key=repr)
    assert final.where("RecordingHours = 0 AND CallsPerHour IS NOT NULL").count() == 0
    own = grid.classify_status(df, 13, own_schedules=True)
    assert own.where("RecordingHours = 5").first().Status == "Success"
    assert grid.classify_status(df, None).where("RecordingHours = 13.4").first().Status == "Partial"


def test_suspicious_calls(spark, rows):
    df = spark.createDataFrame([(None,), (-1.0,), (5.0,), (10000.0,), (10001.0,)], "CallsPerNight double")
    assert rows(grid.suspicious_calls(df)) == sorted(
        [(None, "missing"), (-1.0, "negative"), (10001.0, "excessive")], key=repr)


@pytest.fixture
def edited(spark):
    night = dt.date(2025, 10, 4)
    kind = "Detector string, Night date, StartDateTime string, EndDateTime string, RecordingHours double"
    start, end = "10/04/2025 06:00:00 PM", "10/05/2025 07:00:00 AM"
    before = [("a", start, end), ("b", start, end), ("c", None, end), ("d", start, end), ("e", start, end), ("gone", start, end)]
    after = [("a", "10/4/2025 18:00", end), ("b", "10/4/2025 19:00", end), ("c", start, end),
             ("d", start, None), ("e", "10/04/2025 06:00:01 PM", end), ("new", start, end)]
    return [spark.createDataFrame([(d, night, s, e, 13.0) for d, s, e in part], kind) for part in (before, after)]


def test_edit_diff(edited, rows):
    diff = edits.template_edit_diff(*edited)
    assert rows(diff.where("Any_change"), "Detector", "StartDateTime_changed", "StartDateTime_added", "EndDateTime_removed") == [
        ("b", True, False, False), ("c", False, True, False), ("d", False, False, True)]
    assert diff.count() == 5
    counts = edits.edit_counts(diff).first()
    assert (counts.total_edits, counts.n_StartDateTime_changed, counts.n_EndDateTime_removed) == (3, 1, 1)


def test_edit_log(edited):
    log = [r.entry for r in edits.edit_log(edits.template_edit_diff(*edited)).orderBy("edit_no").collect()]
    assert log[0] == ("[1] b | 2025-10-04\n    StartDateTime CHANGED: 10/04/2025 18:00 -> 10/04/2025 19:00"
                      "\n    RecordingHours: 13.00\n")
    assert "StartDateTime ADDED: <blank> -> 10/04/2025 18:00" in log[1]
    assert "EndDateTime REMOVED: 10/05/2025 07:00 -> <blank>" in log[2]


def test_edited_template_reads_mixed_nights_and_formulas(spark, tmp_path, rows):
    (tmp_path / "t.csv").write_text(
        "Detector,Night,CallsPerNight,StartDateTime,EndDateTime,RecordingHours\n"
        "a,2025-10-04,5,10/04/2025 06:00:00 PM,,=(VALUE(E2)-VALUE(D2))*24\n"
        "b,10/5/2025,x, ,10/06/2025 07:00:00 AM,12.5\n")
    found = templates.read_edited_template(spark, str(tmp_path / "t.csv"))
    assert rows(found) == [
        ("a", dt.date(2025, 10, 4), 5.0, "10/04/2025 06:00:00 PM", None, None),
        ("b", dt.date(2025, 10, 5), None, None, "10/06/2025 07:00:00 AM", 12.5)]


def test_detector_summary_against_python(golden):
    row = summaries.detector_activity_summary(golden).where("Detector = 'DetectorB'").first()
    rates = [r[5] for r in grid_rows() if r[0] == "DetectorB" and r[5] is not None]
    assert row.n_nights == 10 and row.total_hours == 75.0 and row.total_calls == 65.0
    assert (row.pct_success, row.pct_partial, row.pct_fail, row.pct_zero) == (30.0, 30.0, 40.0, 40.0)
    assert row.median_cph == round(statistics.median(rates), 2)
    assert row.sd_cph == round(statistics.stdev(rates), 2)
    assert row.cv_pct == round(100 * statistics.stdev(rates) / statistics.mean(rates), 1)


def test_detector_without_hours_has_null_rates(spark):
    df = spark.createDataFrame([("x", dt.date(2025, 1, 1), 0.0, 0.0, "Fail", None)], GRID)
    row = summaries.detector_activity_summary(df).first()
    assert row.mean_cph is None and row.cv_pct is None and row.sd_cpn is None and row.total_hours == 0.0


def test_study_summary_divides_rounded_values(golden):
    row = summaries.study_summary(golden).first()
    rates = [r[5] for r in grid_rows() if r[5] is not None]
    sd, mean = round(statistics.stdev(rates), 2), round(statistics.mean(rates), 2)
    assert row.overall_cv_pct == round(100 * sd / mean, 1)
    assert row.overall_median_cph == round(statistics.median(rates), 2)
    assert row.overall_median_cpn == statistics.median([r[2] for r in grid_rows()])
    assert row.n_detectors == 3 and row.study_duration_days == 10


def test_variance_components_against_python(golden):
    row = summaries.variance_components(golden).first()
    groups = {}
    for r in grid_rows():
        if r[5] is not None:
            groups.setdefault(r[0], []).append(r[5])
    total = statistics.variance([x for g in groups.values() for x in g])
    between = statistics.variance([statistics.mean(g) for g in groups.values()])
    within = statistics.mean([statistics.variance(g) for g in groups.values()])
    assert row.var_total == round(total, 2) and row.var_between == round(between, 2)
    assert row.pct_within == pytest.approx(round(100 * within / total, 1))


@pytest.mark.parametrize("seed", range(4))
def test_exact_percentiles_match_builtin(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([rng.gauss(0, 50), rng.lognormvariate(0, 4), float(rng.randint(0, 5)), -rng.random()]) for _ in range(500)]
    values += [7.0] * (300 * seed) + [None, float("nan")]
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v double, w int").repartition(7)
    probs = [0.0, 0.05, 0.25, 0.5, 0.95, 1.0]
    ours = quantiles.exact_percentiles(df, {"v": probs, "w": [0.5]}).first()
    builtin = df.where("NOT isnan(v)").agg(F.percentile("v", probs).alias("q")).first().q
    assert list(ours)[:6] == pytest.approx(builtin)
    assert ours.w_p0 == (len(values) - 1) / 2


def test_exact_percentiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "v double")
    assert quantiles.exact_percentiles(df, {"v": [0.5]}).first().v_p0 is None


def pearson(x, y):
    pairs = [(a, b) for a, b in zip(x, y) if a is not None and b is not None]
    if len(pairs) < 2:
        return len(pairs), None
    mx, my = (sum(v) / len(pairs) for v in zip(*pairs))
    sxx, syy = sum((a - mx) ** 2 for a, _ in pairs), sum((b - my) ** 2 for _, b in pairs)
    if sxx == 0 or syy == 0:
        return len(pairs), None
    return len(pairs), sum((a - mx) * (b - my) for a, b in pairs) / math.sqrt(sxx * syy)


@pytest.mark.parametrize("per_block", [1, 3, 256])
def test_pair_statistics_match_brute_force(spark, monkeypatch, per_block):
    monkeypatch.setattr(chart_detector, "DETECTORS_PER_BLOCK", per_block)
    rng = random.Random(5)
    data = {f"d{i}": [rng.choice([None, rng.randint(0, 9)]) for _ in range(12)] for i in range(7)}
    data["flat"] = [3] * 12
    data["half"] = [4, 4, 4, 4, 4, 4, 9] + [None] * 5
    data["first"] = [1, 2, 3, 4, 5, 6] + [None] * 6
    df = counts_table(spark, [(d, day, n) for d, v in data.items() for day, n in enumerate(v, 1) if n is not None])
    found = {(r.Detector1, r.Detector2): (r.n_nights, r.Correlation) for r in chart_detector.pair_statistics(df).collect()}
    names = sorted(set(data) - {"flat"})
    assert set(found) == {(a, b) for a in names for b in names if a < b}
    for (a, b), (n, r) in found.items():
        want_n, want_r = pearson(data[a], data[b])
        assert n == want_n
        assert r == (None if want_r is None else pytest.approx(want_r))
    matrix = chart_detector.detector_correlation(df)
    assert matrix.count() == len(names) ** 2
    assert matrix.where("Detector1 = Detector2 AND Correlation = 1").count() == len(names)


def test_outliers_box_and_ci(golden):
    flagged = chart_detector.activity_outliers(golden)
    assert [r.CallsPerNight for r in flagged.where("is_outlier AND Detector = 'DetectorA'").collect()] == [18.0]
    assert chart_detector.without_outliers(flagged).count() == 27
    assert chart_detector.detector_box_stats(golden).first().Detector == "DetectorA"
    ci = chart_detector.detector_mean_ci(golden).where("Detector = 'DetectorA'").first()
    assert ci.upper - ci.lower == pytest.approx(2 * 1.96 * statistics.stdev([10, 15, 12, 18, 14, 11, 13, 16, 12, 14]) / math.sqrt(10))


def test_rolling_rank_averages_ties_and_skips_incomplete_windows(spark, rows):
    df = counts_table(spark, [(d, day, 5) for d in "abc" for day in range(1, 5)] + [("top", day, 9) for day in range(1, 5)])
    ranked = chart_detector.rolling_mean_rank(df, window=3)
    assert {r[1] for r in rows(ranked)} == {dt.date(2025, 10, 3), dt.date(2025, 10, 4)}
    assert {(r[0], r[3]) for r in rows(ranked)} == {("top", 1.0), ("a", 3.0), ("b", 3.0), ("c", 3.0)}


def test_running_sums_treat_null_as_zero(spark):
    df = counts_table(spark, [("a", 1, 2), ("a", 2, None), ("a", 3, 4)])
    found = chart_temporal.cumulative_calls_by_detector(df).orderBy("Night").collect()
    assert [r.cumulative_calls for r in found] == [2, 2, 6]
    study = chart_temporal.cumulative_calls_study(df).orderBy("Night").collect()
    assert [r.cumulative_calls for r in study] == [2, 2, 6]


def detections(spark, data):
    schema = "Detector string, species string, DateTime_local timestamp_ntz, auto_id string, Hour_local int"
    df = spark.createDataFrame(
        [(d, s, dt.datetime(2025, 10, day, hour), s, hour) for d, s, day, hour in data], schema)
    return df.withColumn("Night", F.to_date("DateTime_local"))


@pytest.fixture
def calls(spark):
    return detections(spark, [
        ("a", "LASBOR", 4, 20), ("a", "LASBOR", 4, 20), ("a", "MYOLUC", 5, 21), ("b", "LASBOR", 6, 21),
        ("b", "NoID", 4, 3), ("b", "UNKNOWN", 7, 3), ("b", "", 7, 3), ("a", None, 7, 4), ("b", "NOISE", 9, 4)])


def test_species_accumulation_excludes_noise(calls, rows):
    assert rows(summaries.species_accumulation(calls)) == [
        (dt.date(2025, 10, 4), 1, "LASBOR", 1), (dt.date(2025, 10, 5), 1, "MYOLUC", 2)]


def test_cumulative_species_covers_every_night(calls, rows):
    curve = rows(chart_species.cumulative_species(calls))
    assert [r[1] for r in curve] == [1, 2, 2, 2, 2, 3] and curve[-1][0] == dt.date(2025, 10, 9)
    labels = rows(chart_species.accumulation_labels(calls))
    assert labels[0] == (dt.date(2025, 10, 4), 1, "Oct 04\nLASBOR")


def test_noid_shares(calls, rows):
    table = rows(chart_species.noid_proportion(calls))
    assert [(r[0], r[1], r[2], r[3]) for r in table] == [("a", 4, 1, 25.0), ("b", 5, 3, 60.0)]
    assert [r[4] for r in table] == pytest.approx([400 / 9] * 2)
    nightly = {r.Night.day: (r.noid_calls, r.richness) for r in chart_species.noid_and_richness_by_night(calls).collect()}
    assert nightly[4] == (1, 1) and nightly[7] == (3, 0)


def test_matrix_and_phenology_are_complete(calls, rows):
    matrix = rows(chart_species.species_by_detector_matrix(calls))
    assert len(matrix) == 2 * 3 and ("b", "MYOLUC", 0, 1, None) in matrix
    weekly = rows(chart_species.species_phenology(calls, "week"))
    assert len(weekly) == 3 * 2
    with pytest.raises(ValueError):
        chart_species.species_phenology(calls, "year")


def test_species_profile_fills_the_day(calls):
    profile_rows = chart_species.species_hourly_profile(calls, top_n=1)
    assert profile_rows.count() == 24
    assert profile_rows.agg(F.sum("pct")).first()[0] == pytest.approx(100)


def test_hourly_profiles(calls):
    total = chart_temporal.hourly_profile(calls)
    assert total.count() == 24 and total.first().peak_hour == 3
    mean = {r.Hour_local: r.activity for r in chart_temporal.hourly_profile(calls, "mean").collect()}
    assert mean[20] == 2.0 and mean[21] == 1.0 and mean[3] == 1.5 and mean[0] == 0.0


def test_shares_sum_to_hundred(calls):
    shares = summaries.species_by_detector(calls.where("Detector = 'b'"))
    assert shares.agg(F.sum("pct_of_detector")).first()[0] == pytest.approx(100)
    assert summaries.hourly_activity(calls).agg(F.sum("n_calls")).first()[0] == 9


def test_top_n_ties_go_to_the_first_label(spark, rows):
    df = spark.createDataFrame([("x", "b", 2), ("x", "a", 2), ("x", "c", 1)], "Detector string, species string, n_calls int")
    assert rows(reshape.top_n_per_group(df, "Detector", 1), "species") == [("a",)]
    assert rows(reshape.top_n_global(df, 2), "species") == [("a",), ("b",)]


def test_histogram_default_bins(spark, rows):
    df = spark.createDataFrame([(float(x),) for x in range(30)] + [(None,), (float("nan"),)], "CallsPerHour double")
    bins = rows(chart_temporal.calls_per_hour_histogram(df))
    assert len(bins) == 30 and {r[1] for r in bins} == {1} and bins[0][3] == 14.5
    wide = rows(chart_temporal.calls_per_hour_histogram(df, binwidth=10.0), "bin_center", "n")
    assert wide == [(0.0, 6), (10.0, 10), (20.0, 10), (30.0, 4)]


def test_duplicates_and_row_counts(spark, rows):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", "x"), ("b", "x")], "k string, v string")
    assert rows(profile.duplicate_report(df)) == [(4, 3, 2)]
    assert rows(profile.duplicate_rows(df)) == [("a", None), ("a", None)]
    assert rows(reshape.rows_in_group(df, ["k"]), "k", "n_occurrences") == [("a", 3)] * 3 + [("b", 1)]


def test_mapping_quality_flags(spark, rows):
    ids = spark.createDataFrame([("1",), ("1",), ("2",), ("3",), ("4",)], "detector_id string")
    names = spark.createDataFrame([("1", "N"), ("2", "N"), ("3", "ENTER_NAME_HERE")], "detector_id string, Detector string")
    quality = profile.mapping_quality(ids, names)
    assert rows(quality, "detector_id", "mapped", "is_placeholder", "duplicate_name") == [
        ("1", True, False, True), ("2", True, False, True), ("3", False, True, False), ("4", False, False, False)]
    assert tuple(profile.mapping_summary(quality).first()) == (1, True, False)


def test_contracts(spark, golden):
    assert contracts.cpn_contract(golden, status=True, rate=True) is golden
    with pytest.raises(contracts.ContractError, match="hint: run grid"):
        contracts.require_columns(golden, ["nope"], "grid")
    with pytest.raises(contracts.ContractError):
        contracts.require_types(golden, {"Status": "numeric"})
    with pytest.raises(contracts.ContractError):
        contracts.require_rows(golden.limit(0))
    with pytest.raises(contracts.ContractError):
        contracts.require_rows(golden, exactly=31)
    with pytest.raises(contracts.ContractError, match="12 NULLs|10 NULLs"):
        contracts.require_not_null(golden, ["CallsPerHour"])
    with pytest.raises(contracts.ContractError):
        contracts.master_contract(golden)
    with pytest.raises(contracts.ContractError):
        contracts.require_date_range("2025-10-31", "2025-10-04")


def test_release_problems(golden, calls):
    assert results.release_problems(golden, calls) == []
    broken = golden.withColumn("Night", F.col("Night").cast("string")).withColumn("Detector", F.lit(None).cast("string"))
    assert len(results.release_problems(broken, calls.drop("auto_id"))) == 3


def test_summary_files(spark, golden, tmp_path):
    tables = {"variance_components": summaries.variance_components(golden), "effort": summaries.effort_summary(golden)}
    written = results.write_summary_tables(tables, str(tmp_path / "out"), enabled=["variance_components"])
    assert written == ["variance_components"]
    back = spark.read.option("header", True).csv(str(tmp_path / "out" / "variance_components"))
    assert back.columns == ["component", "value"] and back.count() == 5


def test_fingerprint_ignores_order_and_sees_copies(spark):
    df = spark.range(100).select("id", (F.col("id") % 7).alias("k"))

    def print_of(x, **options):
        return audit.content_fingerprint(x, **options).first().fingerprint

    for options in ({}, {"portable": True}):
        assert print_of(df, **options) == print_of(df.orderBy(F.desc("id")).repartition(5), **options)
        assert print_of(df, **options) != print_of(df.unionAll(df), **options)
        assert print_of(df, **options) != print_of(df.unionAll(df).unionAll(df), **options)
        assert print_of(df, **options) != print_of(df.withColumn("k", F.lit(0)), **options)


def test_audit_adds_up(spark, rows):
    raw = spark.createDataFrame(
        [("d", "t1", "MYOLUC", "1", "f1", "3"), ("d", "t1", "MYOLUC", "1", "f2", "0"), ("d", "t2", "NoID", "1", "f1", "0"),
         ("d", "t3", "MYOLUC", "0", "f1", "3"), ("d", "t4", "MYOLUC", "x", "f1", "3"), ("d", "t5", "MYOLUC", "1", "f1", "0"),
         ("d", "t5", "MYOLUC", "1", "f2", "9"), ("d", "t6", None, "1", "f1", "2")],
        "Detector string, DateTime_local string, auto_id string, n string, source_file string, pulses string")
    table = rows(audit.row_audit(audit.cleaning_counts(raw)).orderBy("step"))
    assert [(r[1], r[2], r[3], r[4]) for r in table] == [
        ("rows_removed", 8, 2, 6), ("duplicate", 6, 2, 4), ("filter_noid", 4, 1, 3), ("filter_zero_pulses", 3, 1, 2)]
    config = StudyConfig("2025-10-04", "2025-10-05", filters=phases.StudyConfig.from_dict({
        "study_parameters": {"start_date": "a", "end_date": "b", "data_filters": {
            "remove_noid": True, "remove_zero_pulse_calls": True}}}).filters)
    valid = raw.where("try_cast(n as double) > 0")
    assert phases.clean_master(valid, config).count() == table[-1][4]
    kept = audit.row_audit(audit.cleaning_counts(raw, remove_duplicates=False, remove_noid=False))
    assert [r.n_removed for r in kept.orderBy("step").collect()] == [2, 0, 0, 3]


def test_condensed_calls_give_the_same_tables(calls, rows):
    small = condense(calls)
    assert small.count() == 8 and small.agg(F.sum("_weight")).first()[0] == 9
    same = [
        summaries.species_by_detector, summaries.species_accumulation, summaries.hourly_activity, grid.calls_per_night,
        chart_detector.total_calls_by_detector, chart_species.species_composition, chart_species.species_by_detector_matrix,
        chart_species.cumulative_species, chart_species.species_hourly_profile, chart_species.noid_proportion,
        chart_species.noid_and_richness_by_night, chart_species.species_detector_composition,
        chart_species.species_nightly_activity, chart_species.species_phenology, chart_species.species_turnover,
        chart_species.species_rank_abundance, chart_temporal.hourly_profile,
        lambda df: chart_temporal.hourly_profile(df, "mean"),
    ]
    for operator in same:
        assert rows(operator(calls)) == rows(operator(small)), operator


def test_edit_numbers_follow_detector_and_night(spark):
    nights = [dt.date(2025, 10, d) for d in (4, 5, 6)]
    kind = "Detector string, Night date, StartDateTime string, EndDateTime string, RecordingHours double"
    cells = [(d, n) for d in "cab" for n in nights]
    before = spark.createDataFrame([(d, n, "10/04/2025 18:00", None, 1.0) for d, n in cells], kind)
    after = spark.createDataFrame([(d, n, "10/04/2025 19:00" if (d, n.day) != ("a", 5) else "10/04/2025 18:00", None, 1.0) for d, n in cells], kind)
    log = edits.edit_log(edits.template_edit_diff(before, after.repartition(4)))
    found = [(r.edit_no, r.Detector, r.Night.day) for r in log.orderBy("edit_no").collect()]
    assert [f[0] for f in found] == list(range(1, 9))
    assert [f[1:] for f in found] == sorted((d, n.day) for d, n in cells if (d, n.day) != ("a", 5))


def test_nights_of_rows_without_a_night(spark, rows):
    """A detector with unparsed times gets each night once; one with nothing else too."""
    night = lambda d: dt.date(2024, 1, d)
    df = spark.createDataFrame(
        [("A", None, 9), ("A", None, 8), ("A", night(3), 2), ("B", None, 1)], "Detector string, Night date, n int")
    filled = grid.fill_nights(df, {"n": 0}, "2024-01-01", "2024-01-04")
    assert rows(filled) == sorted(
        [("A", night(d), 2 if d == 3 else 0) for d in range(1, 5)] + [("B", night(d), 0) for d in range(1, 5)], key=repr)


def test_repeated_nights_stay(spark, rows):
    night = lambda d: dt.date(2024, 1, d)
    df = spark.createDataFrame(
        [("A", night(2), 5), ("A", night(2), 6), ("A", night(4), 7), ("A", night(4), 8)], "Detector string, Night date, n int")
    filled = grid.fill_nights(df, {"n": 0}, "2024-01-01", "2024-01-05")
    assert rows(filled) == sorted([("A", night(1), 0), ("A", night(2), 5), ("A", night(2), 6), ("A", night(3), 0),
                                   ("A", night(4), 7), ("A", night(4), 8), ("A", night(5), 0)], key=repr)
