"""Column expressions on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from nightgrid.functions import numbers, species, times


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def each(spark, values, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(make("v")).collect()]


def test_round_nearest_ties_to_even(spark):
    values = [2.5, 3.5, 0.15, 0.25, 0.35, -2.5, -0.15, 0.0, 1e17, float("nan"), None, 2.675]
    whole = each(spark, values[:2] + values[5:6], lambda c: numbers.round_nearest(c, 0), "double")
    assert whole == [2.0, 4.0, -2.0]
    tenth = each(spark, values, lambda c: numbers.round_nearest(c, 1), "double")
    assert tenth[2:5] == [0.1, 0.2, 0.3]
    assert tenth[6] == -0.1 and tenth[7] == 0.0 and tenth[8] == 1e17
    assert tenth[9] != tenth[9] and tenth[10] is None
    assert each(spark, [2.675], lambda c: numbers.round_nearest(c, 2), "double") == [2.67]


def test_round_nearest_name_and_column_agree(spark):
    df = spark.range(-3000, 3000).select((F.col("id") / 16).alias("v"))
    pair = df.select(numbers.round_nearest("v", 2).alias("a"), numbers.round_nearest(F.col("v"), 2).alias("b"))
    assert pair.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


def test_number_formats(spark):
    assert one(spark, numbers.thousands(F.lit(12345))) == "12,345"
    assert one(spark, numbers.percent_text(F.lit(0.125))) == "12.5%"
    assert one(spark, numbers.percent_text(F.lit(6.25), already_percent=True)) == "6.2%"
    assert each(spark, [999, 1000, 1250], numbers.short_count, "int") == ["999", "1.0k", "1.2k"]


def test_percent_of_nothing_is_null(spark):
    assert one(spark, numbers.percent(F.lit(1), F.lit(0))) is None


def test_parse_date_orders_and_failures(spark):
    texts = ["2025-10-04", "10/4/2025", "10/04/2025", "25/12/2025", "junk", "", None,
             "2025/10/04", "2025-10-04 12:30:00", "2025-02-30", "2025-10", "2025", "4.10.2025",
             "10/4/2025 18:00", "10-4-5-2025", "10/4/20256", " 2025-10-4 ", "10-2025", "a-b-2025"]
    oct4, christmas = dt.date(2025, 10, 4), dt.date(2025, 12, 25)
    found = each(spark, texts, lambda c: times.parse_date(c, day_first=True))
    assert found == [oct4, oct4, oct4, christmas, None, None, None, oct4, oct4, None, None, None,
                     dt.date(2025, 4, 10), oct4, None, None, oct4, None, None]
    assert each(spark, ["25/12/2025"], times.parse_date) == [None]


def test_local_time_over_the_end_of_dst(spark):
    df = spark.createDataFrame(
        [(1, "2025-11-02", "06:30:00"), (2, "2025-11-02", "07:30:00"), (3, "2025-11-02", "25:00"),
         (4, "11/2/2025", "6:05"), (5, None, "06:00:00")],
        "i int, date string, time string",
    )
    local = times.to_local(times.parse_utc("date", "time"), "America/Chicago")
    found = [r[0] for r in df.orderBy("i").select(local).collect()]
    # The hour from one to two occurs twice; UTC still tells the rows apart.
    assert found[0] == found[1] == dt.datetime(2025, 11, 2, 1, 30)
    assert found[2] is None and found[4] is None
    assert found[3] == dt.datetime(2025, 11, 2, 1, 5)


@pytest.mark.parametrize("zone", ["UTC", "America/Chicago", "Asia/Kolkata"])
def test_wall_clock_does_not_depend_on_the_session(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist in Chicago on 2025-03-09.
        df = spark.sql("SELECT timestamp_ntz'2025-03-09 02:30:15' AS t")
        local = times.to_local("t", "America/New_York")
        found = df.select(
            local.cast("string"), times.clock_text("t"), times.export_text("t"), times.log_text("t"),
            times.hour_floor("t").cast("string"), times.study_night("t").cast("string"),
            times.parse_month_first(F.lit("3/9/2025 2:30:15 AM")).cast("string"),
            times.schedule_texts(F.lit("2025-03-09").cast("date"), F.lit("02:30:00"), F.lit("13:05:00"))[0],
        ).first()
        assert list(found) == [
            "2025-03-08 21:30:15", "02:30:15", "03/09/2025 02:30:15", "03/09/2025 02:30",
            "2025-03-09 02:00:00", "2025-03-08", "2025-03-09 02:30:15", "03/09/2025 02:30:00 AM"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize(
    "text, ok",
    [("6:5", True), ("06:05:09", True), ("06:05:09.75", True), ("06:05:09 PM", False), ("06", False),
     ("6:", False), ("24:00:00", False), ("06:05Z", False), ("", False), (" 06:05 ", True)],
)
def test_clock_texts_in_utc_parsing(spark, text, ok):
    df = spark.createDataFrame([("2025-10-04", text)], "d string, t string")
    assert (df.select(times.parse_utc("d", "t")).first()[0] is not None) == ok


def test_unknown_timezone_is_an_error():
    assert times.is_valid_timezone("America/Chicago")
    with pytest.raises(ValueError):
        times.require_timezone("Mars/Base")


def test_study_night_cutoff(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2025, 10, 5, 17, 59, 59)), (2, dt.datetime(2025, 10, 5, 18, 0))],
        "i int, t timestamp_ntz",
    )
    found = [r[0] for r in df.orderBy("i").select(times.study_night("t", 18)).collect()]
    assert found == [dt.date(2025, 10, 4), dt.date(2025, 10, 5)]


@pytest.mark.parametrize(
    "start, end, hours",
    [
        ("20:00:00", "08:00:00", 12.0),
        ("06:00:00", "18:00:00", 12.0),
        (None, "08:00:00", None),
        ("20:00:00", None, None),
        ("10/25/2025 6:00:00 PM", "10/26/2025 7:00:00 AM", 13.0),
        ("10/4/2025 18:00", "10/5/2025 7:00", 13.0),
        ("10/4/2025 6:00 PM", "10/5/2025 07:00:00", 13.0),
        ("10/5/2025 7:00", "10/4/2025 18:00", -13.0),
        ("10/4/2025 12:00:00 AM", "10/4/2025 12:00:00 PM", 12.0),
        ("10/4/2025 18:00:00 PM", "10/4/2025 19:30", 1.5),
        ("soon", "later", None),
    ],
)
def test_recording_hours(spark, start, end, hours):
    df = spark.createDataFrame([(start, end)], "s string, e string")
    assert df.select(times.recording_hours("s", "e")).first()[0] == hours


def test_schedule_texts_cross_midnight(spark):
    df = spark.createDataFrame(
        [("18:00:00", "07:00:00"), ("01:00:00", "05:00:00"), (None, None)], "s string, e string"
    ).withColumn("Night", F.lit("2025-12-31").cast("date"))
    start, end = times.schedule_texts("Night", "s", "e")
    found = [tuple(r) for r in df.select(start, end).collect()]
    assert found == [
        ("12/31/2025 06:00:00 PM", "01/01/2026 07:00:00 AM"),
        ("12/31/2025 01:00:00 AM", "12/31/2025 05:00:00 AM"),
        (None, None),
    ]


def test_log_and_export_texts(spark):
    moment = F.lit("2025-10-04 18:05:09").cast("timestamp_ntz")
    assert one(spark, times.export_text(moment)) == "10/04/2025 18:05:09"
    assert one(spark, times.log_text(moment)) == "10/04/2025 18:05"
    assert one(spark, times.log_text(F.lit(None).cast("timestamp_ntz"))) == "<blank>"


def test_week_floor_sunday_and_monday(spark):
    days = [dt.date(2025, 10, 4), dt.date(2025, 10, 5), dt.date(2025, 10, 6)]
    assert each(spark, days, times.week_floor, "date") == [
        dt.date(2025, 9, 28), dt.date(2025, 10, 5), dt.date(2025, 10, 5)]
    assert each(spark, days, lambda c: times.week_floor(c, "monday"), "date") == [
        dt.date(2025, 9, 29), dt.date(2025, 9, 29), dt.date(2025, 10, 6)]


def test_recode_is_case_sensitive_and_passes_unknown_codes(spark):
    codes = ["MYLU", "EPFU", "NoID", "NOID", "UNKN", "ZZZZ", "MYOLUC", "mylu", None, ""]
    assert each(spark, codes, species.recode_species) == [
        "MYOLUC", "EPTFUS", "NoID", "UNKNOWN", "UNKNOWN", "ZZZZ", "MYOLUC", "mylu", None, ""]


def test_unified_species_prefers_valid_manual_label(spark):
    df = spark.createDataFrame(
        [(1, "MYOLUC", "LASBOR"), (2, "", "LASBOR"), (3, "NoID", "UNKNOWN"), (4, None, "EPTFUS"),
         (5, "UNKNOWN", None)],
        "i int, m string, a string",
    )
    found = [r[0] for r in df.orderBy("i").select(species.unified_species("m", "a")).collect()]
    assert found == ["MYOLUC", "LASBOR", "NoID", "EPTFUS", "NoID"]


def test_unidentified_sets_differ_by_use(spark):
    labels = ["NoID", "noid", "UNKNOWN", "unknown", "", None, "NOISE", "MYOLUC"]
    chart = each(spark, labels, species.is_unidentified)
    any_case = each(spark, labels, species.is_unidentified_any_case)
    assert chart == [True, False, True, False, True, True, False, False]
    assert any_case == [True, True, True, True, True, True, False, False]


@pytest.mark.parametrize("text, day", [
    ("20251004", "2025-10-04"), ("251004", "2025-10-04"), ("10/4/25", "2010-04-25"), ("99/1/2", "1999-01-02"),
    ("10/31/25", "2025-10-31"), ("31/12/25", None), ("Oct 4 2025", "2025-10-04"), ("October 4, 2025", "2025-10-04"),
    ("4 Oct 2025", "2025-10-04"), ("2025 Oct 4", "2025-10-04"), ("2025-10-04", "2025-10-04"), ("30/4/2025", "2025-04-30"),
    ("x", None), ("", None), ("20251399", None), (None, None),
])
def test_rarer_dates(spark, text, day):
    df = spark.createDataFrame([(text,)], "t string")
    found = df.select(times.parse_date("t", day_first=True).cast("string")).first()[0]
    assert found == day or (text == "31/12/25" and found == "2031-12-25")


@pytest.mark.parametrize("text, clock", [
    ("203000", "20:30:00"), ("2030", "20:30"), ("20-30-00", "20:30:00"), ("20 30", "20:30"), ("20:30:01.5", "20:30:01"),
    ("abc", None), ("2:3 PM", None), (None, None),
])
def test_rarer_clocks(spark, text, clock):
    assert spark.createDataFrame([(text,)], "t string").select(times.clock_or_null("t")).first()[0] == clock
