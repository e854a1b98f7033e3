"""The engine's tables derived from the given ones, in Spark and in checking SQL.

A user stands for a detector, an event for a detection.  Local time is Chicago
time; all events fall in January, so the SQL can subtract six hours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from nightgrid.config import DataFilters, StudyConfig
from nightgrid.functions.numbers import round_nearest
from nightgrid.functions.times import to_local
from nightgrid.operators import grid
from nightgrid.plans.phases import add_species, assign_nights

CONFIG = StudyConfig(
    start_date="2023-12-31",
    end_date="2024-01-29",
    filters=DataFilters(remove_duplicates=True, remove_noid=True, remove_zero_pulse=True),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _zero_padded(column: str, width: int) -> Column:
    return F.lpad(F.col(column).cast("string"), width, "0")


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as localized detections with automatic and manual labels."""
    events = table(spark, sf_dir, "events")
    noid = F.when(F.col("event_type") == "error", "NoID").otherwise(F.col("event_type"))
    local = to_local("ts", CONFIG.timezone)
    return events.select(
        "event_id",
        F.concat(F.lit("D"), _zero_padded("user_id", 6)).alias("Detector"),
        F.col("ts").alias("DateTime_UTC"),
        local.alias("DateTime_local"),
        F.hour(local).alias("Hour_local"),
        noid.alias("auto_id"),
        F.when(F.col("event_id") % 10 == 0, "signup").alias("manual_id"),
        F.col("value").alias("pulses"),
    )


def all_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detections with species and night, unidentified ones included."""
    from nightgrid.functions.times import study_night

    named = add_species(detections(spark, sf_dir))
    return named.withColumn("Night", study_night("DateTime_local", CONFIG.schedule.cutoff_hour))


def master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identified detections with species and night."""
    return assign_nights(detections(spark, sf_dir), CONFIG)


def fixture_hours() -> Column:
    """Recording hours that vary by detector and day: 0, 8.5 or 13."""
    number = F.substring("Detector", 2, 6).cast("int")
    slot = (number * 7 + F.dayofmonth("Night")) % 5
    return F.when(slot == 0, 0.0).when(slot == 1, 8.5).otherwise(13.0)


def plain_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detector x night with counts and hours."""
    counts = grid.calls_per_night(master(spark, sf_dir))
    full = grid.fill_nights(counts, {"CallsPerNight": 0}, CONFIG.start_date, CONFIG.end_date)
    return full.withColumn("RecordingHours", fixture_hours())


def final_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The grid with status and hourly rate."""
    return grid.calls_per_hour(
        grid.classify_status(plain_grid(spark, sf_dir), CONFIG.intended_hours)
    )


def sparse_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the cells of the grid that have calls, so nights are missing."""
    counts = grid.calls_per_night(master(spark, sf_dir))
    return counts.withColumn("RecordingHours", fixture_hours())


def raw_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as all-text raw rows of four kinds of export file."""
    events = table(spark, sf_dir, "events").withColumn("kind", F.expr("(event_id div 4) % 4"))
    eid, uid, kind = F.col("event_id"), F.col("user_id"), F.col("kind")
    kinds4 = {"click": "EPFU", "view": "MYLU", "purchase": "LANO", "signup": "LACI"}
    kinds6 = {"click": "EPTFUS", "view": "MYOLUC", "purchase": "LASNOC", "signup": "LASCIN"}

    def coded(codes: dict[str, str]) -> Column:
        text = F.lit("NoID")
        for label, code in codes.items():
            text = F.when(F.col("event_type") == label, code).otherwise(text)
        return text

    def stamp(pattern: str) -> Column:
        return F.date_format("ts", pattern)

    mixed_code = (
        F.when(eid % 3 == 0, coded(kinds4)).when(eid % 3 == 1, coded(kinds6)).otherwise("PIPXX")
    )
    n = (
        F.when(eid % 11 == 0, "0").when(eid % 13 == 0, None).when(eid % 17 == 0, "n/a")
        .otherwise((eid % 50 + 1).cast("string"))
    )
    record = F.concat(F.lit("r"), eid.cast("string"), F.lit(".wav"))
    return events.select(
        "event_id", "kind",
        F.concat(F.lit("site_"), kind.cast("string"), F.lit(".csv")).alias("source_file"),
        F.concat(
            F.lit("REC0000000"), _zero_padded("user_id", 6), F.lit("_"),
            stamp("yyyyMMdd"), F.lit(".wav"),
        ).alias("in_file"),
        F.when(eid % 97 == 0, "not a date")
        .when(eid % 4 == 0, stamp("yyyy-MM-dd"))
        .when(eid % 4 == 1, stamp("M/d/yyyy"))
        .when(eid % 4 == 2, stamp("MM/dd/yyyy"))
        .otherwise(stamp("yyyy/MM/dd")).alias("date"),
        F.when(eid % 5 == 0, stamp("HH:mm")).otherwise(stamp("HH:mm:ss")).alias("time"),
        F.when(kind <= 1, coded(kinds4)).when(kind == 2, coded(kinds6))
        .otherwise(mixed_code).alias("auto_id"),
        F.when(kind == 0,
               F.when(uid % 4 == 0, "LABO;LANO; EPFU;MYSE").when(uid % 4 == 1, "LABO;")
               .when(uid % 4 == 2, "")).alias("alternates"),
        F.when(kind == 1, F.when(uid % 3 == 0, "LABO;TABR").otherwise("LABO"))
        .when(kind == 2, "LASBOR").when((kind == 3) & (eid % 2 == 0), "TABR").alias("alternate_1"),
        F.when(kind == 1, "ZZZZ").when(kind == 2, "TADBRA").alias("alternate_2"),
        n.alias("n"),
        F.floor("value").cast("string").alias("pulses"),
        F.when(kind <= 1, record).alias("out_file"),
        F.when(kind > 1, record).alias("out_file_fs"),
    )


def versioned_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows with their schema version, as after reading file by file."""
    from nightgrid.operators.ingest import detect_schema_version

    return detect_schema_version(raw_exports(spark, sf_dir), F.col("kind") == 0)


def order_species(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as detections: a customer is a detector, priority and status a species.

    They span several years, and the species appear one after another.
    """
    species = F.concat_ws("/", "o_orderpriority", "o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("Detector"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("DateTime_local"),
        species.alias("auto_id"), species.alias("species"),
        F.to_date("o_orderdate").alias("Night"),
    )


ORDERS_SQL = """WITH ord AS (
  SELECT o_orderpriority || '/' || o_orderstatus AS species, CAST(o_orderdate AS DATE) AS Night FROM orders)"""


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Doubles that differ between engines in the last bits, cut to six digits."""
    return df.withColumns({c: round_nearest(c, digits) for c in columns})


def rr(expression: str, digits: int = 6) -> str:
    """SQL of ``round_nearest``; the expression is evaluated once."""
    s = f"{float(10**digits)!r}"
    down, up = f"(abs(v) - floor(abs(v)*{s})/{s})", f"(ceil(abs(v)*{s})/{s} - abs(v))"
    return (
        f"list_transform([CAST({expression} AS DOUBLE)], lambda v: sign(v) * (CASE WHEN {down} < {up}"
        f" OR ({down} = {up} AND floor(abs(v)*{s}) % 2 = 0)"
        f" THEN floor(abs(v)*{s})/{s} ELSE ceil(abs(v)*{s})/{s} END))[1]"
    )


def pct(part: str, whole: str, digits: int = 1) -> str:
    return rr(f"CAST({part} AS DOUBLE) * 100 / NULLIF({whole}, 0)", digits)


_DETECTIONS = """
det AS (
  SELECT event_id, 'D' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS Detector,
         ts AS DateTime_UTC, ts - INTERVAL 6 HOUR AS DateTime_local,
         CAST(extract(hour FROM ts - INTERVAL 6 HOUR) AS INTEGER) AS Hour_local,
         CASE WHEN event_type = 'error' THEN 'NoID' ELSE event_type END AS auto_id,
         CASE WHEN event_id % 10 = 0 THEN 'signup' END AS manual_id,
         value AS pulses
  FROM events),
allsp AS (
  SELECT *, COALESCE(manual_id, auto_id) AS species,
         CASE WHEN extract(hour FROM DateTime_local) < 18
              THEN CAST(DateTime_local AS DATE) - 1
              ELSE CAST(DateTime_local AS DATE) END AS Night
  FROM det),
master AS (SELECT * FROM allsp WHERE species <> 'NoID')"""

_GRID = """,
counts AS (SELECT Detector, Night, COUNT(*) AS CallsPerNight FROM master GROUP BY ALL),
nights AS (
  SELECT CAST(unnest(generate_series(DATE '2023-12-31', DATE '2024-01-29', INTERVAL 1 DAY)) AS DATE) AS Night),
spine AS (SELECT Detector, Night FROM (SELECT DISTINCT Detector FROM counts) d, nights),
plain AS (
  SELECT s.Detector, s.Night, COALESCE(c.CallsPerNight, 0) AS CallsPerNight,
         CAST(CASE (CAST(substr(s.Detector, 2) AS INTEGER) * 7 + extract(day FROM s.Night)) % 5
              WHEN 0 THEN 0.0 WHEN 1 THEN 8.5 ELSE 13.0 END AS DOUBLE) AS RecordingHours
  FROM spine s LEFT JOIN counts c ON c.Detector = s.Detector AND c.Night = s.Night),
cpn AS (
  SELECT *, CASE WHEN RecordingHours = 0 THEN 'Fail' WHEN RecordingHours = 13 THEN 'Success'
                 ELSE 'Partial' END AS Status,
         CASE WHEN RecordingHours > 0 THEN CallsPerNight / RecordingHours END AS CallsPerHour
  FROM plain),
sparse AS (
  SELECT c.*, p.RecordingHours FROM counts c JOIN plain p
  ON p.Detector = c.Detector AND p.Night = c.Night)"""

_CODES = "CASE event_type WHEN 'click' THEN '{}' WHEN 'view' THEN '{}' WHEN 'purchase' THEN '{}' WHEN 'signup' THEN '{}' ELSE 'NoID' END"
_C4 = _CODES.format("EPFU", "MYLU", "LANO", "LACI")
_C6 = _CODES.format("EPTFUS", "MYOLUC", "LASNOC", "LASCIN")

_RAW = f"""
kinds AS (SELECT *, (event_id // 4) % 4 AS kind FROM events),
raw AS (
  SELECT event_id, kind, ts, user_id,
    'site_' || kind || '.csv' AS source_file,
    'REC0000000' || lpad(CAST(user_id AS VARCHAR), 6, '0') || '_' || strftime(ts, '%Y%m%d') || '.wav' AS in_file,
    CASE WHEN event_id % 97 = 0 THEN 'not a date'
         WHEN event_id % 4 = 0 THEN strftime(ts, '%Y-%m-%d')
         WHEN event_id % 4 = 1 THEN strftime(ts, '%-m/%-d/%Y')
         WHEN event_id % 4 = 2 THEN strftime(ts, '%m/%d/%Y')
         ELSE strftime(ts, '%Y/%m/%d') END AS date,
    CASE WHEN event_id % 5 = 0 THEN strftime(ts, '%H:%M') ELSE strftime(ts, '%H:%M:%S') END AS time,
    CASE WHEN kind <= 1 THEN {_C4} WHEN kind = 2 THEN {_C6}
         WHEN event_id % 3 = 0 THEN {_C4} WHEN event_id % 3 = 1 THEN {_C6} ELSE 'PIPXX' END AS auto_id,
    CASE WHEN kind = 0 THEN CASE user_id % 4 WHEN 0 THEN 'LABO;LANO; EPFU;MYSE'
         WHEN 1 THEN 'LABO;' WHEN 2 THEN '' END END AS alternates,
    CASE WHEN kind = 1 THEN CASE WHEN user_id % 3 = 0 THEN 'LABO;TABR' ELSE 'LABO' END
         WHEN kind = 2 THEN 'LASBOR' WHEN kind = 3 AND event_id % 2 = 0 THEN 'TABR' END AS alternate_1,
    CASE WHEN kind = 1 THEN 'ZZZZ' WHEN kind = 2 THEN 'TADBRA' END AS alternate_2,
    CASE WHEN event_id % 11 = 0 THEN '0' WHEN event_id % 13 = 0 THEN NULL
         WHEN event_id % 17 = 0 THEN 'n/a' ELSE CAST(event_id % 50 + 1 AS VARCHAR) END AS n,
    CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS pulses,
    CASE WHEN kind <= 1 THEN 'r' || event_id || '.wav' END AS out_file,
    CASE WHEN kind > 1 THEN 'r' || event_id || '.wav' END AS out_file_fs
  FROM kinds),
vraw AS (
  SELECT *, CASE WHEN kind = 0 THEN 'v1_legacy_single_column'
                 WHEN contains(coalesce(alternate_1, ''), ';') THEN 'v1_legacy_single_column'
                 WHEN length(auto_id) = 4 THEN 'v2_transitional_4letter'
                 WHEN length(auto_id) = 6 THEN 'v3_modern_6letter'
                 ELSE 'unknown' END AS schema_version
  FROM raw)"""


def on_master(body: str) -> str:
    return f"WITH {_DETECTIONS} {body}"


def on_grid(body: str) -> str:
    return f"WITH {_DETECTIONS}{_GRID} {body}"


def on_raw(body: str) -> str:
    return f"WITH {_RAW} {body}"
