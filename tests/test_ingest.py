"""Raw CSV fixtures: three schemas, mixed headers, missing columns, bad files."""

import datetime as dt
import warnings

import pytest
from pyspark.sql import functions as F

from nightgrid.config import DataFilters, StudyConfig
from nightgrid.operators import clean, ingest, mapping, schema
from nightgrid.plans import phases
from nightgrid.sources import exports, files, snapshots
from nightgrid.sources.files import split_header
from nightgrid.sources.names import clean_names

ID_A, ID_B = "AAAA000000000001", "BBBB000000000002"

V1 = f"""IN FILE,DATE,TIME,AUTO ID*,ALTERNATES,N
{ID_A}_1.wav,2025-10-05,01:00:00,MYLU,LACI;LABO; LANO,5
{ID_A}_2.wav,2025-10-05,01:00:01,EPFU,LACI;,3
{ID_B}_3.wav,2025-10-05,01:00:02,NoID,,2
{ID_B}_4.wav,2025-10-05,01:00:03,EPFU,LACI,0
"""
V1_IN_ALT1 = f"""ALTERNATE 1,AUTO ID*,IN FILE,DATE,TIME,N
LACI;LABO,MYLU,{ID_A}_5.wav,10/4/2025,23:00,4
LACI,MYLU,{ID_A}_6.wav,10/4/2025,23:01,4
,PIPXX,{ID_A}_7.wav,10/4/2025,23:02,NA
"""
V2 = f"""N,AUTO ID*,ALTERNATE 1,ALTERNATE 2,TIME,DATE,IN FILE,PULSES,OUT FILE
1,MYLU,LACI,ZZZZ,02:00:00,10/05/2025,{ID_B}_8.wav,3,old8.wav
1,NOID,LACI,,02:00:01,10/05/2025,{ID_B}_9.wav,0,old9.wav
x,EPFU,LACI,,02:00:02,10/05/2025,{ID_B}_10.wav,3,old10.wav
"""
V3 = f"""DATE,IN FILE,TIME,N,AUTO ID*,ALTERNATE 1,ALTERNATE 2,OUT FILE FS,Fmax,OrgId
2025-10-05,{ID_A}_11.wav,03:00:00,1,MYOLUC,LASBOR,TABR,new11.wav,"1,5",zz
2025-10-05,{ID_A}_11.wav,03:00:00,1,MYOLUC,LASBOR,,again.wav,9,zz
junk,{ID_A}_12.wav,03:00:00,1,LASBOR,,,new12.wav,9,zz
"""


@pytest.fixture
def raw_dir(tmp_path):
    for name, text in {"a_v1.csv": V1, "b_alt1.csv": V1_IN_ALT1, "c_v2.csv": V2, "d_v3.csv": V3,
                       "e_header.csv": "A,B\n", "f_empty.csv": "", "note.txt": "no"}.items():
        (tmp_path / name).write_text(text)
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "night_id.csv").write_text(V1)
    return str(tmp_path)


def load(spark, path, **options):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        return exports.load_flat_dir(spark, path, **options)


def test_clean_names():
    assert clean_names(["IN FILE", "AUTO ID*", "MATCH RATIO", "Fmax", "FrqMax", "TIME-12", "%",
                        "in_file", "", "1st", "OUT FILE FS", "IN FILE"]) == [
        "in_file", "auto_id", "match_ratio", "fmax", "frq_max", "time_12", "percent",
        "in_file_2", "x", "x1st", "out_file_fs", "in_file_3"]


def test_flat_dir_aligns_differing_headers(spark, raw_dir, rows):
    found = load(spark, raw_dir).rows
    table = rows(found, "source_file", "auto_id", "detector_id", "n", "schema_version")
    v1, v2, v3 = "v1_legacy_single_column", "v2_transitional_4letter", "v3_modern_6letter"
    assert table == sorted([
        ("a_v1.csv", "MYLU", ID_A, "5", v1), ("a_v1.csv", "EPFU", ID_A, "3", v1),
        ("a_v1.csv", "NoID", ID_B, "2", v1),
        ("b_alt1.csv", "MYLU", ID_A, "4", v1), ("b_alt1.csv", "MYLU", ID_A, "4", v2),
        ("c_v2.csv", "MYLU", ID_B, "1", v2), ("c_v2.csv", "NOID", ID_B, "1", v2),
        ("d_v3.csv", "MYOLUC", ID_A, "1", v3), ("d_v3.csv", "MYOLUC", ID_A, "1", v3),
        ("d_v3.csv", "LASBOR", ID_A, "1", v3)], key=repr)
    assert {t for _, t in found.dtypes if not t.startswith("struct")} == {"string"}


def test_file_report_names_skipped_files(spark, raw_dir, rows):
    report = {p.rsplit("/", 1)[1]: s for p, s in rows(load(spark, raw_dir).files)}
    assert report["e_header.csv"] == "ok"  # a header is all that is looked at; its reader finds no rows
    assert "f_empty.csv" not in report  # Spark does not list files of zero bytes
    assert report["a_v1.csv"] == "ok" and "night_id.csv" not in report


HEAD = b"N,IN FILE,AUTO ID\n"


@pytest.mark.parametrize("content, n", [
    (b"N,IN FILE,AUTO ID\n" + b"1,a,M\n" * 10_919 + "1,\u00e9\u00e9\u00e9\u00e9\u00e9\u00e9\u00e9\u00e9,M\n".encode() * 9, 10_928),
    (HEAD + b"1,\xff\xfe\xfa,MYLU\n1,b,MYLU\n", 2),
    (b"N,IN FILE,AUTO ID," + b",".join(b"column %d " % i + b"x" * 9_000 for i in range(9)) + b"\n1,x,MYLU\n", 1),
    (b"\n \nN,IN FILE,AUTO ID\n1,x,MYLU\n", 1),
    (b"\xef\xbb\xbf" + HEAD + b"1,x,MYLU\n", 1),
], ids=["character over 64 KiB", "latin-1 row", "header over 64 KiB", "blank lines first", "byte order mark"])
def test_no_file_is_lost(spark, tmp_path, content, n):
    (tmp_path / "a.csv").write_bytes(content)
    (tmp_path / "b.csv").write_text("AUTO ID,N,IN FILE\nMYLU,1,x\n")
    found = load(spark, str(tmp_path))
    assert {r.status for r in found.files.collect()} == {"ok"}
    counts = {r.source_file: r["count"] for r in found.rows.groupBy("source_file").count().collect()}
    assert counts == {"a.csv": n, "b.csv": 1}
    assert {r.detector_id for r in found.rows.where("source_file = 'b.csv'").collect()} == {"x"}


def test_files_that_cannot_be_read_are_reported(spark, tmp_path):
    (tmp_path / "wide.csv").write_bytes("N,IN FILE\n1,x\n".encode("utf-16"))
    (tmp_path / "good.csv").write_bytes(HEAD + b"1,x,MYLU\n")
    with pytest.warns(UserWarning, match="UTF-16"):
        found = exports.load_flat_dir(spark, str(tmp_path))
    assert found.rows.count() == 1
    assert [r.path.rsplit("/")[-1] for r in found.files.where("status like 'unreadable%'").collect()] == ["wide.csv"]


def test_a_broken_archive_is_an_error_or_skipped(spark, tmp_path):
    import gzip

    data = HEAD + b"".join(b"1,%d,MYLU\n" % (i * 7919) for i in range(50_000))
    packed = gzip.compress(data)
    (tmp_path / "cut.csv.gz").write_bytes(packed[: len(packed) // 2])
    options = {"glob": "*.csv.gz"}
    with pytest.raises(Exception, match="cut.csv.gz"):
        exports.read_exports(spark, str(tmp_path), **options).rows.count()
    assert 0 < exports.read_exports(spark, str(tmp_path), skip_corrupt=True, **options).rows.count() < 50_000


def test_header_with_quoted_line_break(spark, tmp_path):
    assert split_header('"in\nfile",N') == ["in\nfile", "N"]
    (tmp_path / "a.csv").write_text('N,"IN\nFILE",AUTO ID\n1,x,MYLU\n')
    found = exports.load_flat_dir(spark, str(tmp_path))
    assert [(r.n, r.in_file, r.auto_id) for r in found.rows.collect()] == [("1", "x", "MYLU")]


def test_many_headers_one_scan(spark, tmp_path):
    for i in range(60):
        names = ["N", "AUTO ID", "IN FILE", *[f"extra {k}" for k in range(i % 20)]]
        names = names[i % 3 :] + names[: i % 3]
        values = [{"N": "1", "AUTO ID": "MYLU", "IN FILE": f"d{i}"}.get(c, c) for c in names]
        (tmp_path / f"{i}.csv").write_text(",".join(names) + "\n" + ",".join(values) + "\n")
    found = exports.load_flat_dir(spark, str(tmp_path)).rows
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 1
    assert {r.in_file for r in found.where("auto_id = 'MYLU' AND n = '1'").collect()} == {f"d{i}" for i in range(60)}
    assert found.where("extra_5 = 'extra 5'").count() == 42


def test_headers_by_scan(spark, raw_dir):
    scanned = files._scan_headers(spark, raw_dir, "*.csv", False).select("uri", "header")
    probed = files.probe_headers(spark, raw_dir).where("status = 'ok'").select("uri", "header")
    assert sorted(map(tuple, scanned.collect())) == sorted(map(tuple, probed.collect()))


@pytest.mark.parametrize("text, positive", [
    ("1", True), (" 2.5 ", True), ("NaN", False), ("1d", False), ("-1", False), ("0", False), ("1e3", True), (None, False),
    ("Inf", True), ("", False), (".5", True),
])
def test_positive_numbers(spark, text, positive):
    df = spark.createDataFrame([(text,)], "n string")
    assert ingest.filter_positive_n(df).count() == positive


def test_recursive_dir(spark, raw_dir):
    found = exports.load_recursive_dir(spark, raw_dir)
    assert [r.source_file for r in found.rows.select("source_file").distinct().collect()] == ["night_id.csv"]
    with pytest.raises(FileNotFoundError):
        exports.load_recursive_dir(spark, raw_dir, glob="*nothing.csv")


def test_union_sources(spark, raw_dir, rows):
    part = load(spark, raw_dir).rows
    with pytest.warns(UserWarning):
        both = exports.union_sources({"local": part, "gone": None})
    assert rows(exports.source_split(both)) == [("local", 10)]
    with pytest.raises(ValueError), warnings.catch_warnings():
        warnings.simplefilter("ignore")
        exports.union_sources({"gone": None})


def test_missing_columns_warn(spark):
    df = spark.createDataFrame([("a",)], "auto_id string")
    with pytest.warns(UserWarning):
        assert ingest.filter_positive_n(df).count() == 1
    with pytest.warns(UserWarning):
        assert ingest.derive_detector_id(df).first().detector_id is None


@pytest.mark.parametrize(
    "auto_id, alternate, version",
    [("MYLU", "LACI;LABO", "v1_legacy_single_column"), ("MYOLUC", "LASBOR", "v3_modern_6letter"),
     ("EPFU", "MYOSEP", "v2_transitional_4letter"), ("NoID", None, "v2_transitional_4letter"),
     (None, None, "unknown"), ("PIPXX", None, "unknown")],
)
def test_schema_version(spark, auto_id, alternate, version):
    df = spark.createDataFrame([(auto_id, alternate)], "auto_id string, alternate_1 string")
    assert ingest.detect_schema_version(df).first().schema_version == version


@pytest.mark.parametrize(
    "text, items",
    [("LACI;LABO; LANO", ["LACI", "LABO", "LANO"]), ("LACI;", ["LACI"]), ("LACI; ", ["LACI"]),
     ("LACI;;", ["LACI", ""]), (";LACI", ["", "LACI"]), ("", None), (None, None), (";", [""])],
)
def test_split_list_drops_one_trailing_item(spark, text, items):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(schema.split_list("t")).first()[0] == items


def test_unify_schema_mixed_batch(spark, raw_dir, rows):
    unified = schema.unify_schema(load(spark, raw_dir).rows)
    table = {r[0]: r[1:] for r in rows(unified, "in_file", "auto_id", "alternate_1", "alternate_2", "alternate_3", "out_file_fs")
             if not r[0].startswith(f"{ID_A}_11")}
    assert table[f"{ID_A}_1.wav"] == ("MYOLUC", "LASCIN", "LASBOR", "LASNOC", None)
    assert table[f"{ID_A}_2.wav"] == ("EPTFUS", "LASCIN", None, None, None)
    # A list in alternate_1 keeps its values although another file has the single column.
    assert table[f"{ID_A}_5.wav"] == ("MYOLUC", "LASCIN", "LASBOR", None, None)
    assert table[f"{ID_B}_8.wav"] == ("MYOLUC", "LASCIN", "ZZZZ", None, "old8.wav")
    assert table[f"{ID_B}_9.wav"][0] == "UNKNOWN"
    assert "alternates" not in unified.columns and "schema_version" not in unified.columns
    modern = {r for r in rows(unified, "in_file", "alternate_2") if r[0].startswith(f"{ID_A}_11")}
    assert (f"{ID_A}_11.wav", "TABR") in modern  # modern rows are not recoded


def test_final_columns_order_and_drop_list(spark):
    df = spark.createDataFrame([tuple("123456")], "extra string, N string, Detector string, OrgID string, auto_id string, date string")
    df = df.withColumnRenamed("N", "n")
    assert schema.final_column_select(df).columns == ["Detector", "auto_id", "n", "extra"]


def test_keep_first_follows_reading_order(spark, raw_dir):
    config = StudyConfig("2025-10-04", "2025-10-05", detector_names={ID_A: "North", ID_B: "ENTER_NAME_HERE"})
    master = phases.prepare_master(load(spark, raw_dir).rows, config)
    assert master.where("out_file_fs = 'new11.wav'").count() == 1
    assert master.where("out_file_fs = 'again.wav'").count() == 0
    assert {r[0] for r in master.select("Detector").distinct().collect()} == {"North", ID_B}
    assert "_read_order" not in master.columns and "orgid" not in [c.lower() for c in master.columns]
    assert master.columns[:6] == ["Detector", "DateTime_local", "Date_local", "Time_local", "Hour_local", "auto_id"]
    unparsed = master.where("DateTime_local IS NULL").collect()
    assert [r.in_file for r in unparsed] == [f"{ID_A}_12.wav"]


def test_reading_order_puts_versions_first_then_sources(spark):
    order = "struct<source_rank:int,path:string,split_start:bigint,row:bigint>"
    df = spark.createDataFrame(
        [("d", "MYOLUC", "modern", (0, "a", 0, 1), "v3_modern_6letter"),
         ("d", "MYLU", "late", (1, "b", 0, 0), "v2_transitional_4letter"),
         ("d", "MYLU", "early", (0, "c", 0, 7), "v2_transitional_4letter")],
        f"Detector string, auto_id string, tag string, _read_order {order}, schema_version string",
    )
    kept = clean.keep_first(schema.unify_schema(df), ["Detector", "auto_id"])
    assert [r.tag for r in kept.collect()] == ["early"]


def test_keep_first_treats_nulls_as_equal_and_is_idempotent(spark):
    df = spark.createDataFrame(
        [("d", None, "x", "2"), ("d", None, "x", "1"), ("d", "a", None, "3"), ("d", "a", None, "3"), ("d", "a", "x", "4")],
        "Detector string, DateTime_local string, auto_id string, in_file string",
    )
    once = clean.keep_first(df)
    assert sorted(r.in_file for r in once.collect()) == ["1", "3", "4"]
    assert clean.keep_first(once).count() == 3


def test_keep_first_limits_copies_before_the_shuffle(spark):
    copy = (F.col("id") % 3).cast("string")
    df = spark.range(1000).select(copy.alias("Detector"), copy.alias("DateTime_local"), copy.alias("auto_id"), "id")
    plan = clean.keep_first(df)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_filters(spark):
    df = spark.createDataFrame(
        [("NoID", "1"), (None, "0.0"), ("MYOLUC", "2.5"), ("MYOLUC", None), ("MYOLUC", "n/a"), ("noid", "10")],
        "auto_id string, pulses string",
    )
    assert clean.filter_noid(df).count() == 5
    assert [r.pulses for r in clean.filter_zero_pulse(df).collect()] == ["1", "2.5", "10"]


def test_noid_handling_modes(spark):
    df = spark.createDataFrame([("NoID",), ("unknown",), ("MYOLUC",), (None,)], "species string")
    assert clean.noid_handling(df).count() == 4
    assert clean.noid_handling(df, "remove").count() == 1
    assert clean.noid_handling(df, "show_separate").where("is_noid").count() == 3
    with pytest.raises(ValueError):
        clean.noid_handling(df, "hide")


def test_reconcile_mapping(spark, rows):
    ids = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "detector_id string")
    known = spark.createDataFrame([("b", "North"), ("gone", "South")], "detector_id string, Detector string")
    assert rows(mapping.reconcile_mapping(ids, known)) == [("a", "ENTER_NAME_HERE"), ("b", "North")]
    assert rows(mapping.set_difference(known, ids, "detector_id")) == [("gone",)]


def test_small_map_is_broadcast_large_one_is_not(spark, monkeypatch):
    def hints(names):
        return mapping.names_table(spark, names)._jdf.queryExecution().logical().toString()

    assert "broadcast" in hints({"a": "x"})
    monkeypatch.setattr(mapping, "BROADCAST_MAX_NAMES", 1)
    assert "broadcast" not in hints({"a": "x", "b": "y"})


def test_snapshots_and_versions(spark, tmp_path):
    root = str(tmp_path / "s")
    with pytest.raises(FileNotFoundError):
        snapshots.read_latest_snapshot(spark, root)
    df = spark.range(3)
    snapshots.write_snapshot(df, root, "20251001_000000")
    snapshots.write_snapshot(df.limit(1), root, "20251002_000000")
    latest = snapshots.read_latest_snapshot(spark, root)
    assert latest.count() == 1 and latest.first().run_ts == "20251002_000000"
    with pytest.raises(ValueError):
        snapshots.write_snapshot(df, root, "yesterday")
    versions = str(tmp_path / "v")
    assert snapshots.next_version(spark, versions) == 1
    assert [snapshots.write_versioned(df, versions) for _ in range(2)] == [1, 2]
    assert snapshots.read_version(spark, versions, 2).count() == 3


def test_list_files_reads_no_content(spark, raw_dir):
    plan = files.list_files(spark, raw_dir)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_master_csv_round_trip(spark, tmp_path):
    moment = dt.datetime(2025, 11, 2, 1, 30, 5)
    df = spark.createDataFrame([("d", moment, "a, \"b\"")], "Detector string, DateTime_local timestamp_ntz, note string")
    snapshots.write_master_csv(df.coalesce(1), str(tmp_path / "m"))
    back = snapshots.read_master_csv(spark, str(tmp_path / "m"))
    assert tuple(back.first())[:2] == ("d", moment)


def test_config_from_dict():
    config = StudyConfig.from_dict({
        "study_parameters": {
            "start_date": "2025-10-04", "end_date": "2025-10-31", "timezone": "America/Chicago",
            "detector_mapping": {ID_A: "LPI"}, "external_data_sources": "F:/x",
            "data_filters": {"remove_noid": True, "remove_zero_pulse_calls": "yes"}},
        "processing_options": {"advanced_scheduling": False, "recording_start": "18:00:00", "intended_hours": 13}})
    assert config.filters == DataFilters(True, True, True)
    assert config.detector_specific_schedules is False and config.schedule.cutoff_hour == 18
    assert config.external_sources == ("F:/x",)
    with pytest.raises(ValueError):
        StudyConfig.from_dict({"study_parameters": {"start_date": "a", "end_date": "b", "data_filters": {"remove_noid": "maybe"}}})
