"""The three phases end to end on files."""

import datetime as dt

from nightgrid.config import DataFilters, StudyConfig
from nightgrid.plans import phases
from nightgrid.sources import templates

CONFIG = StudyConfig(
    start_date="2025-10-04", end_date="2025-10-06",
    detector_names={"AAAA000000000001": "North", "BBBB000000000002": "South"},
    filters=DataFilters(True, True, True),
)


def write_inputs(folder):
    local = folder / "local"
    local.mkdir()
    lines = ["IN FILE,DATE,TIME,AUTO ID*,ALTERNATE 1,N,PULSES"]
    for i in range(6):
        # 02:00 UTC on the 5th is 21:00 on the 4th in Chicago.
        lines.append(f"AAAA000000000001_{i}.wav,2025-10-05,02:00:0{i},MYLU,,1,4")
    lines += ["AAAA000000000001_9.wav,2025-10-05,02:00:00,MYLU,,1,4",
              "AAAA000000000001_a.wav,2025-10-05,03:00:00,NoID,,1,4",
              "AAAA000000000001_b.wav,2025-10-05,03:00:01,MYLU,,1,0"]
    (local / "one.csv").write_text("\n".join(lines) + "\n")
    far = folder / "far" / "night"
    far.mkdir(parents=True)
    (far / "x_id.csv").write_text(
        "AUTO ID*,N,PULSES,IN FILE,DATE,TIME\nLASBOR,1,2,BBBB000000000002_1.wav,10/6/2025,11:30\n")
    return str(local), str(folder / "far")


def test_three_phases(spark, tmp_path):
    local, far = write_inputs(tmp_path)
    config = StudyConfig(**{**CONFIG.__dict__, "external_sources": (far, str(tmp_path / "missing"))})
    out = str(tmp_path / "out")
    master = phases.run_preparation(spark, local, out, config, "20251101_120000")
    assert master.count() == 7
    audit = {name: spark.read.parquet(f"{out}/audit/run_ts=20251101_120000/{name}").collect()
             for name in ("row_audit", "unparsed_times", "unmapped", "files")}
    assert [(r.event_type, r.n_removed) for r in sorted(audit["row_audit"], key=lambda r: r.step)] == [
        ("rows_removed", 0), ("duplicate", 1), ("filter_noid", 1), ("filter_zero_pulses", 1)]
    assert audit["unparsed_times"][0].n_unparsed == 0 and audit["unmapped"][0].n_unmapped == 0
    assert sorted((r.source_kind == "local", r.status) for r in audit["files"]) == [(False, "ok"), (True, "ok")]
    # A later snapshot of another run is there from now on; no phase may take it.
    master.limit(1).write.parquet(f"{out}/master/run_ts=20991231_000000")
    for name in ("master_nights", "template", "calls_per_night", "hourly_counts"):
        spark.range(1).write.parquet(f"{out}/{name}/run_ts=20991231_000000")
    assert {(r.Detector, r.auto_id) for r in master.collect()} == {("North", "MYOLUC"), ("South", "LASBOR")}

    nights, template = phases.run_template(master, out, config, "20251101_120000")
    cells = {(r.Detector, r.Night.day): r.CallsPerNight for r in template.collect()}
    assert cells == {("North", 4): 6, ("North", 5): 0, ("North", 6): 0,
                     ("South", 4): 0, ("South", 5): 1, ("South", 6): 0}
    assert {r.RecordingHours for r in template.collect()} == {13.0}

    edited = templates.read_edited_template(spark, f"{out}/template_edit_this/run_ts=20251101_120000")
    edited = edited.withColumn("EndDateTime", templates.F.when(
        (templates.F.col("Detector") == "South") & (templates.F.col("Night") == dt.date(2025, 10, 5)),
        "10/5/2025 23:00").otherwise(templates.F.col("EndDateTime")))
    result = phases.run_analysis(nights, template, edited, out, config, "20251101_120000")
    final = {(r.Detector, r.Night.day): (r.RecordingHours, r.Status, r.CallsPerHour) for r in result.grid.collect()}
    assert final["South", 5] == (5.0, "Partial", 0.2) and final["North", 4] == (13.0, "Success", 6 / 13)
    assert [r.Detector for r in result.edit_log.collect()] == ["South"]
    study = result.summaries["study_summary"].first()
    assert (study.n_detectors, study.n_detector_nights, study.total_calls) == (2, 6, 7.0)
    assert result.summaries["hourly_summary"].count() == 2
    for name, table in result.summaries.items():
        assert table.count() > 0
        assert spark.read.option("header", True).csv(f"{out}/summaries/run_ts=20251101_120000/{name}").count() > 0
    assert set(result.released) == {"calls_per_night", "master", "summary/detector_summary", "summary/study_summary",
                                    "summary/species_summary", "summary/hourly_summary"}
    assert spark.read.parquet(f"{out}/release/run_ts=20251101_120000/master").count() == 7
    assert result.suspicious.count() == 0 and result.outliers.count() == 6
    few = {r.Detector: (r.n_nights, r.below_threshold) for r in result.detector_nights.collect()}
    assert few and all(low == (n < config.nights_threshold) for n, low in few.values())
    reports = {"edit_log": result.edit_log, "suspicious_nights": result.suspicious, "activity_outliers": result.outliers}
    for name, table in reports.items():
        kept = spark.read.parquet(f"{out}/reports/{name}/run_ts=20251101_120000")
        assert kept.columns == table.columns and sorted(map(repr, kept.collect())) == sorted(map(repr, table.collect()))
    assert spark.read.parquet(f"{out}/template_diff/run_ts=20251101_120000").count() == result.edit_diff.count()


def test_schedules_per_detector(spark):
    config = StudyConfig(**{**CONFIG.__dict__, "detector_specific_schedules": True,
                            "schedule": type(CONFIG.schedule)(per_detector={"North": ("20:00:00", "04:00:00")})})
    master = spark.createDataFrame(
        [("North", dt.date(2025, 10, 4)), ("South", dt.date(2025, 10, 4))], "Detector string, Night date")
    hours = {r.Detector: r.RecordingHours for r in phases.prepare_template(master, config).collect()}
    assert hours == {"North": 8.0, "South": None}


def test_missing_local_folder(spark, tmp_path):
    _, far = write_inputs(tmp_path)
    config = StudyConfig(**{**CONFIG.__dict__, "external_sources": (far,)})
    master = phases.run_preparation(spark, str(tmp_path / "nowhere"), str(tmp_path / "out"), config, "20251101_120000")
    assert [r.Detector for r in master.collect()] == ["South"]


def test_template_input_priority(spark, tmp_path):
    out, manual = str(tmp_path), str(tmp_path / "manual")
    rows = spark.createDataFrame([("North",)], "Detector string")
    rows.write.parquet(f"{out}/master/run_ts=20250101_000000")
    spark.createDataFrame([("Manual", "MYLU")], "Detector string, manual_id string").write.option("header", True).csv(manual)
    memory = spark.createDataFrame([("Memory",)], "Detector string")
    first = lambda **given: phases.template_input(spark, out, **given).first().Detector
    assert first(manual_ids=manual, master=memory) == "Manual"
    assert first(manual_ids=manual + "-missing", master=memory) == "Memory"
    assert first() == "North"
