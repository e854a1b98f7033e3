"""Grid, status, schedule and edit queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from nightgrid.catalog.bases import (
    CONFIG, final_grid, master, on_grid, on_master, plain_grid, rounded, rr, sparse_grid, table,
)
from nightgrid.catalog.registry import query
from nightgrid.config import Schedule
from nightgrid.operators import chart_detector, edits, grid, mapping

def _spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid.detector_nights(master(spark, sf_dir), CONFIG.start_date, CONFIG.end_date)


_HALF = Schedule(start="18:30:00", end="07:15:00")


def schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A schedule for every detector with an even number."""
    number = F.col("user_id")
    return table(spark, sf_dir, "events").select("user_id").distinct().where(number % 2 == 0).select(
        F.concat(F.lit("D"), F.lpad(number.cast("string"), 6, "0")).alias("Detector"),
        F.format_string("%02d:30:00", number % 24).alias("StartTime"),
        F.format_string("%02d:00:00", (number * 5) % 24).alias("EndTime"),
    )


_SCHEDULES = """,
sched AS (
  SELECT DISTINCT 'D' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS Detector,
         printf('%02d:30:00', user_id % 24) AS StartTime, printf('%02d:00:00', (user_id * 5) % 24) AS EndTime
  FROM events WHERE user_id % 2 = 0)"""


def templates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The original template and one in which some times were edited."""
    original = grid.schedule_datetimes(grid.attach_schedule(plain_grid(spark, sf_dir), _HALF))
    slot = (F.substring("Detector", 2, 6).cast("int") + F.dayofmonth("Night")) % 7
    day = F.date_format("Night", "M/d/yyyy")
    edited = original.withColumns(
        {
            "StartDateTime": F.when(slot == 1, F.concat(day, F.lit(" 19:00")))
            .when(slot == 2, None).otherwise(F.col("StartDateTime")),
            "EndDateTime": F.when(slot == 3, F.concat(day, F.lit(" 11:00 PM")))
            .when(slot == 2, None).otherwise(F.col("EndDateTime")),
        }
    )
    return original, edited


_TEMPLATES = """,
tpl AS (
  SELECT Detector, Night, CallsPerNight, RecordingHours,
         (CAST(substr(Detector, 2) AS INTEGER) + extract(day FROM Night)) % 7 AS slot,
         CAST(Night AS TIMESTAMP) + INTERVAL 18 HOUR + INTERVAL 30 MINUTE AS s0,
         CAST(Night + 1 AS TIMESTAMP) + INTERVAL 7 HOUR + INTERVAL 15 MINUTE AS e0
  FROM plain),
ed AS (
  SELECT *, CASE slot WHEN 1 THEN CAST(Night AS TIMESTAMP) + INTERVAL 19 HOUR WHEN 2 THEN NULL ELSE s0 END AS s1,
         CASE slot WHEN 3 THEN CAST(Night AS TIMESTAMP) + INTERVAL 23 HOUR WHEN 2 THEN NULL ELSE e0 END AS e1
  FROM tpl)"""

_COUNTS = "SELECT Detector, Night, CallsPerNight FROM counts"


@query("calls_per_night", on_grid(_COUNTS))
def _(spark, sf_dir):
    return grid.calls_per_night(master(spark, sf_dir))


@query("grid_cross_join", on_grid("SELECT Detector, Night FROM spine"))
def _(spark, sf_dir):
    return _spine(spark, sf_dir)


@query("attach_counts", on_grid("SELECT Detector, Night, CallsPerNight FROM plain"))
def _(spark, sf_dir):
    counts = grid.calls_per_night(master(spark, sf_dir))
    return grid.attach_counts(_spine(spark, sf_dir), counts)


@query(
    "attach_schedule",
    on_grid(_SCHEDULES + """
    SELECT s.Detector, s.Night, h.StartTime, h.EndTime FROM spine s LEFT JOIN sched h ON h.Detector = s.Detector"""),
)
def _(spark, sf_dir):
    spine = _spine(spark, sf_dir)
    return grid.attach_schedule(spine, per_detector=schedules(spark, sf_dir))


@query(
    "recording_hours",
    on_grid(_SCHEDULES + """
    SELECT s.Detector, s.Night, CAST(
      (CASE WHEN h.e < h.s THEN h.e - h.s + 86400 ELSE h.e - h.s END) AS DOUBLE) / 3600 AS RecordingHours
    FROM spine s LEFT JOIN (
      SELECT Detector, CAST(substr(StartTime, 1, 2) AS INTEGER) * 3600 + 1800 AS s,
             CAST(substr(EndTime, 1, 2) AS INTEGER) * 3600 AS e FROM sched) h ON h.Detector = s.Detector"""),
)
def _(spark, sf_dir):
    spine = _spine(spark, sf_dir)
    planned = grid.attach_schedule(spine, per_detector=schedules(spark, sf_dir))
    return grid.scheduled_hours(planned).select("Detector", "Night", "RecordingHours")


@query(
    "schedule_datetimes",
    on_grid(_TEMPLATES + """
    SELECT Detector, Night, strftime(s0, '%m/%d/%Y %I:%M:%S %p') AS StartDateTime,
           strftime(e0, '%m/%d/%Y %I:%M:%S %p') AS EndDateTime FROM tpl"""),
)
def _(spark, sf_dir):
    planned = grid.attach_schedule(plain_grid(spark, sf_dir), _HALF)
    return grid.schedule_datetimes(planned).select(
        "Detector", "Night", "StartDateTime", "EndDateTime"
    )


_DIFF = """
  SELECT Detector, Night, RecordingHours AS RecordingHours_edit,
    s0 AS StartDateTime_orig, e0 AS EndDateTime_orig, s1 AS StartDateTime_edit, e1 AS EndDateTime_edit,
    slot = 1 AS StartDateTime_changed, FALSE AS StartDateTime_added, slot = 2 AS StartDateTime_removed,
    slot = 3 AS EndDateTime_changed, FALSE AS EndDateTime_added, slot = 2 AS EndDateTime_removed,
    slot IN (1, 2, 3) AS Any_change
  FROM ed"""


@query("template_edit_diff", on_grid(_TEMPLATES + _DIFF))
def _(spark, sf_dir):
    return edits.template_edit_diff(*templates(spark, sf_dir))


@query(
    "template_edit_counts",
    on_grid(_TEMPLATES + """
    SELECT COUNT(*) FILTER (slot IN (1, 2, 3)) AS total_edits,
      COUNT(*) FILTER (slot = 1) AS n_StartDateTime_changed, CAST(0 AS BIGINT) AS n_StartDateTime_added,
      COUNT(*) FILTER (slot = 2) AS n_StartDateTime_removed, COUNT(*) FILTER (slot = 3) AS n_EndDateTime_changed,
      CAST(0 AS BIGINT) AS n_EndDateTime_added, COUNT(*) FILTER (slot = 2) AS n_EndDateTime_removed
    FROM ed"""),
)
def _(spark, sf_dir):
    return edits.edit_counts(edits.template_edit_diff(*templates(spark, sf_dir)))


@query(
    "template_edit_log",
    on_grid(_TEMPLATES + """
    SELECT row_number() OVER (ORDER BY Detector, Night) AS edit_no, Detector, Night,
      '[' || row_number() OVER (ORDER BY Detector, Night) || '] ' || Detector || ' | ' || strftime(Night, '%Y-%m-%d') ||
      CASE slot WHEN 1 THEN chr(10) || '    StartDateTime CHANGED: ' || strftime(s0, '%m/%d/%Y %H:%M') || ' -> ' || strftime(s1, '%m/%d/%Y %H:%M')
                WHEN 2 THEN chr(10) || '    StartDateTime REMOVED: ' || strftime(s0, '%m/%d/%Y %H:%M') || ' -> <blank>' ELSE '' END ||
      CASE slot WHEN 3 THEN chr(10) || '    EndDateTime CHANGED: ' || strftime(e0, '%m/%d/%Y %H:%M') || ' -> ' || strftime(e1, '%m/%d/%Y %H:%M')
                WHEN 2 THEN chr(10) || '    EndDateTime REMOVED: ' || strftime(e0, '%m/%d/%Y %H:%M') || ' -> <blank>' ELSE '' END ||
      chr(10) || '    RecordingHours: ' || printf('%.2f', RecordingHours) || chr(10) AS entry
    FROM ed WHERE slot IN (1, 2, 3)"""),
)
def _(spark, sf_dir):
    return edits.edit_log(edits.template_edit_diff(*templates(spark, sf_dir)))


@query(
    "finalize_grid",
    on_grid(_TEMPLATES + f""",
    h AS (SELECT *, greatest(coalesce(date_diff('second', s1, e1) / 3600.0, 0.0), 0.0) AS hrs FROM ed)
    SELECT Detector, Night, CallsPerNight, CAST(hrs AS DOUBLE) AS RecordingHours,
      CASE WHEN hrs = 0 THEN 'Fail' WHEN abs(hrs - 13) < 0.5 THEN 'Success' ELSE 'Partial' END AS Status,
      {rr('CASE WHEN hrs > 0 THEN CallsPerNight / hrs END')} AS CallsPerHour FROM h"""),
)
def _(spark, sf_dir):
    _, edited = templates(spark, sf_dir)
    final = grid.finalize_grid(edited, CONFIG.intended_hours)
    return rounded(
        final.select("Detector", "Night", "CallsPerNight", "RecordingHours", "Status", "CallsPerHour"),
        "CallsPerHour",
    )


@query("classify_status", on_grid("SELECT Detector, Night, Status FROM cpn"))
def _(spark, sf_dir):
    return grid.classify_status(plain_grid(spark, sf_dir), CONFIG.intended_hours).select(
        "Detector", "Night", "Status"
    )


@query("calls_per_hour", on_grid(f"SELECT Detector, Night, {rr('CallsPerHour')} AS CallsPerHour FROM cpn"))
def _(spark, sf_dir):
    rates = grid.calls_per_hour(plain_grid(spark, sf_dir))
    return rounded(rates.select("Detector", "Night", "CallsPerHour"), "CallsPerHour")


@query(
    "sanitize_hours",
    on_grid("""SELECT Detector, Night, CASE WHEN RecordingHours = 8.5 OR RecordingHours = 0 THEN 0.0
      ELSE RecordingHours END AS RecordingHours FROM plain"""),
)
def _(spark, sf_dir):
    hours = F.when(F.col("RecordingHours") == 8.5, -8.5).when(F.col("RecordingHours") > 0, F.col("RecordingHours"))
    spoiled = plain_grid(spark, sf_dir).withColumn("RecordingHours", hours)
    return grid.sanitize_hours(spoiled).select("Detector", "Night", "RecordingHours")


@query(
    "effort_warning",
    on_grid("""SELECT Detector, Night, CASE WHEN CallsPerNight = 0
      THEN 'No calls detected - confirm equipment status' END AS Warning FROM plain"""),
)
def _(spark, sf_dir):
    return grid.effort_warning(plain_grid(spark, sf_dir)).select("Detector", "Night", "Warning")


@query(
    "suspicious_calls",
    on_grid("""SELECT Detector, Night, CallsPerNight, 'excessive' AS reason FROM plain WHERE CallsPerNight > 4
      UNION ALL SELECT Detector, Night, NULL, 'missing' FROM plain WHERE CallsPerNight = 0"""),
)
def _(spark, sf_dir):
    spoiled = plain_grid(spark, sf_dir).withColumn(
        "CallsPerNight", F.when(F.col("CallsPerNight") > 0, F.col("CallsPerNight"))
    )
    return grid.suspicious_calls(spoiled, max_calls=4).select(
        "Detector", "Night", "CallsPerNight", "reason"
    )


@query(
    "complete_grid_coverage",
    on_grid("""SELECT s.Detector, s.Night, coalesce(p.RecordingHours > 0, FALSE) AS has_data,
      s.Night - CAST(dayofweek(s.Night) AS INTEGER) AS week
      FROM spine s LEFT JOIN sparse p ON p.Detector = s.Detector AND p.Night = s.Night"""),
)
def _(spark, sf_dir):
    return grid.complete_grid_coverage(sparse_grid(spark, sf_dir))


@query(
    "effort_grid",
    on_grid("""SELECT s.Detector, s.Night, p.RecordingHours
      FROM spine s LEFT JOIN sparse p ON p.Detector = s.Detector AND p.Night = s.Night"""),
)
def _(spark, sf_dir):
    return grid.effort_grid(sparse_grid(spark, sf_dir))


def stray_grid(spark, sf_dir):
    """The sparse grid with rows far outside the study."""
    found = sparse_grid(spark, sf_dir).select("Detector", "Night", "RecordingHours")
    stray = found.where("Detector = 'Detector_1'").select(
        "Detector", F.explode(F.array(F.lit("0001-01-01").cast("date"), F.lit("2999-12-31").cast("date"))).alias("Night"), F.lit(1.0).alias("RecordingHours")
    )
    return found.unionByName(stray.distinct())


_RUNS = """, own AS (SELECT DISTINCT Detector, Night FROM sparse),
    runs AS (SELECT Detector, MIN(Night) AS first, MAX(Night) AS last, COUNT(*) AS n_nights FROM (
      SELECT *, Night - CAST(row_number() OVER (PARTITION BY Detector ORDER BY Night) AS INTEGER) AS island FROM own)
      GROUP BY Detector, island)"""


@query("night_runs", on_grid(_RUNS + " SELECT * FROM runs"))
def _(spark, sf_dir):
    return grid.night_runs(sparse_grid(spark, sf_dir))


@query(
    "nights_outside",
    on_grid("""SELECT Detector, d AS first, d AS last, CAST(1 AS INTEGER) AS n_nights, side FROM
      (SELECT DISTINCT Detector FROM sparse WHERE Detector = 'Detector_1'),
      (VALUES (DATE '0001-01-01', 'before'), (DATE '2999-12-31', 'after')) v(d, side)"""),
)
def _(spark, sf_dir):
    return grid.nights_outside(stray_grid(spark, sf_dir), CONFIG.start_date, CONFIG.end_date)


@query(
    "missing_runs",
    on_grid("""SELECT Detector, MIN(Night) AS first, MAX(Night) AS last, CAST(COUNT(*) AS INTEGER) AS n_nights FROM (
      SELECT s.Detector, s.Night, s.Night - CAST(row_number() OVER (PARTITION BY s.Detector ORDER BY s.Night) AS INTEGER) AS island
      FROM spine s WHERE NOT EXISTS (SELECT 1 FROM sparse p WHERE p.Detector = s.Detector AND p.Night = s.Night))
      GROUP BY Detector, island"""),
)
def _(spark, sf_dir):
    return grid.missing_runs(stray_grid(spark, sf_dir), CONFIG.start_date, CONFIG.end_date)


@query(
    "effort_grid_of_study",
    on_grid("""SELECT s.Detector, s.Night, p.RecordingHours
      FROM spine s LEFT JOIN sparse p ON p.Detector = s.Detector AND p.Night = s.Night"""),
)
def _(spark, sf_dir):
    return grid.effort_grid(stray_grid(spark, sf_dir), CONFIG.start_date, CONFIG.end_date)


@query(
    "pairwise_correlation",
    on_grid(f""", good AS (SELECT Detector FROM sparse GROUP BY 1 HAVING stddev_samp(CallsPerNight) > 0),
      c AS (SELECT x.Detector AS d1, y.Detector AS d2, COUNT(*) AS n,
        CASE WHEN MIN(x.CallsPerNight) < MAX(x.CallsPerNight) AND MIN(y.CallsPerNight) < MAX(y.CallsPerNight)
          THEN corr(x.CallsPerNight, y.CallsPerNight) END AS r
        FROM sparse x JOIN sparse y ON x.Night = y.Night AND x.Detector < y.Detector GROUP BY ALL)
      SELECT a.Detector AS Detector1, b.Detector AS Detector2, COALESCE(c.n, 0) AS n_nights, {rr('c.r')} AS Correlation
      FROM good a JOIN good b ON a.Detector < b.Detector LEFT JOIN c ON c.d1 = a.Detector AND c.d2 = b.Detector"""),
)
def _(spark, sf_dir):
    return rounded(chart_detector.pair_statistics(sparse_grid(spark, sf_dir)), "Correlation")


@query(
    "detector_correlation",
    on_grid(f""", good AS (SELECT Detector FROM cpn GROUP BY 1 HAVING stddev_samp(CallsPerNight) > 0),
      g AS (SELECT c.* FROM cpn c JOIN good USING (Detector))
      SELECT a.Detector AS Detector1, b.Detector AS Detector2,
        {rr('CASE WHEN a.Detector = b.Detector THEN 1.0 ELSE corr(a.CallsPerNight, b.CallsPerNight) END')} AS Correlation
      FROM g a JOIN g b ON a.Night = b.Night GROUP BY 1, 2"""),
)
def _(spark, sf_dir):
    return rounded(chart_detector.detector_correlation(final_grid(spark, sf_dir)), "Correlation")


def nation_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations name the first detectors; one keeps the placeholder."""
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(
        F.concat(F.lit("D"), F.lpad(key.cast("string"), 6, "0")).alias("detector_id"),
        F.when(key == 3, "ENTER_NAME_HERE").otherwise(F.col("n_name")).alias("Detector"),
    )


_NAMES = """,
names AS (
  SELECT 'D' || lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS detector_id,
         CASE WHEN n_nationkey = 3 THEN 'ENTER_NAME_HERE' ELSE n_name END AS name FROM nation)"""


def _ids(spark, sf_dir):
    return master(spark, sf_dir).withColumnRenamed("Detector", "detector_id")


@query(
    "map_detectors",
    on_master(_NAMES + """
    SELECT m.event_id, m.Detector AS detector_id,
      CASE WHEN n.name IS NULL OR n.name = 'ENTER_NAME_HERE' THEN m.Detector ELSE n.name END AS Detector
    FROM master m LEFT JOIN names n ON n.detector_id = m.Detector"""),
)
def _(spark, sf_dir):
    mapped = mapping.map_detectors(_ids(spark, sf_dir), nation_names(spark, sf_dir))
    return mapped.select("event_id", "detector_id", "Detector")


@query(
    "add_detector_fallback",
    on_master(_NAMES + """
    SELECT COUNT(*) AS n_unmapped FROM master m WHERE NOT EXISTS
      (SELECT 1 FROM names n WHERE n.detector_id = m.Detector)"""),
)
def _(spark, sf_dir):
    return mapping.unmapped_count(_ids(spark, sf_dir), nation_names(spark, sf_dir))


@query(
    "reconcile_mapping",
    on_master(_NAMES + """
    SELECT d.Detector AS detector_id, COALESCE(n.name, 'ENTER_NAME_HERE') AS Detector
    FROM (SELECT DISTINCT Detector FROM master) d LEFT JOIN names n ON n.detector_id = d.Detector"""),
)
def _(spark, sf_dir):
    return mapping.reconcile_mapping(_ids(spark, sf_dir), nation_names(spark, sf_dir))


@query(
    "set_difference_ids",
    on_master(_NAMES + """
    SELECT DISTINCT Detector AS detector_id FROM master WHERE Detector NOT IN (SELECT detector_id FROM names)"""),
)
def _(spark, sf_dir):
    return mapping.set_difference(_ids(spark, sf_dir), nation_names(spark, sf_dir), "detector_id")


@query("distinct_values", on_master("SELECT DISTINCT Detector FROM master"))
def _(spark, sf_dir):
    return mapping.distinct_values(master(spark, sf_dir), "Detector")
