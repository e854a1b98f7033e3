"""Scalar-function queries, each over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightgrid.catalog.bases import (
    CONFIG, detections, master, on_master, on_raw, raw_exports, rr, rounded, table,
)
from nightgrid.catalog.registry import query
from nightgrid.functions import numbers, times
from nightgrid.operators.chart_species import derive_night
from nightgrid.operators.contracts import date_order_violations, time_format_violations
from nightgrid.operators.profile import date_format_profile


@query(
    "study_night",
    on_master("SELECT event_id, DateTime_local, Night FROM allsp"),
)
def _(spark, sf_dir):
    night = times.study_night("DateTime_local", CONFIG.schedule.cutoff_hour).alias("Night")
    return detections(spark, sf_dir).select("event_id", "DateTime_local", night)


@query(
    "parse_datetime_flexible",
    on_master("""
    SELECT event_id, CASE WHEN event_id % 4 = 3 THEN NULL WHEN event_id % 4 = 2 THEN date_trunc('minute', DateTime_local)
        ELSE date_trunc('second', DateTime_local) END AS parsed,
      strftime(CASE WHEN event_id % 4 = 3 THEN NULL WHEN event_id % 4 = 2 THEN date_trunc('minute', DateTime_local)
        ELSE date_trunc('second', DateTime_local) END, '%H:%M:%S') AS clock FROM det"""),
)
def _(spark, sf_dir):
    eid = F.col("event_id")
    text = (
        F.when(eid % 4 == 0, F.date_format("DateTime_local", "M/d/yyyy h:mm:ss a"))
        .when(eid % 4 == 1, F.date_format("DateTime_local", "MM/dd/yyyy HH:mm:ss"))
        .when(eid % 4 == 2, F.date_format("DateTime_local", "M/d/yyyy H:mm"))
        .otherwise(F.date_format("DateTime_local", "yyyy-MM-dd HH:mm:ss"))
    )
    rows = detections(spark, sf_dir).select("event_id", text.alias("text"))
    return rows.select(
        "event_id", times.parse_month_first("text").alias("parsed"), times.clock_of("text").alias("clock")
    )


@query(
    "parse_date_flexible",
    on_raw("SELECT event_id, CASE WHEN event_id % 97 <> 0 THEN CAST(ts AS DATE) END AS parsed FROM raw"),
)
def _(spark, sf_dir):
    return raw_exports(spark, sf_dir).select("event_id", times.parse_date("date").alias("parsed"))


@query(
    "format_datetime",
    on_master("""
    SELECT event_id, strftime(DateTime_local, '%m/%d/%Y %H:%M:%S') AS export_text,
      CASE WHEN manual_id IS NULL THEN '<blank>' ELSE strftime(DateTime_local, '%m/%d/%Y %H:%M') END AS log_text FROM det"""),
)
def _(spark, sf_dir):
    moment = F.when(F.col("manual_id").isNotNull(), F.col("DateTime_local"))
    return detections(spark, sf_dir).select(
        "event_id",
        times.export_text("DateTime_local").alias("export_text"),
        times.log_text(moment).alias("log_text"),
    )


_PATTERNS = {
    "YYYY-MM-DD": r"^\d{4}-\d{2}-\d{2}", "YYYY/MM/DD": r"^\d{4}/\d{2}/\d{2}",
    "MM-DD-YYYY": r"^\d{2}-\d{2}-\d{4}", "MM/DD/YYYY": r"^\d{2}/\d{2}/\d{4}",
    "DD-MM-YYYY": r"^\d{2}-\d{2}-\d{4}", "Other": ".*",
}
_PROFILE = " UNION ALL ".join(
    f"SELECT '{name}' AS format, date FROM raw WHERE regexp_matches(date, '{pattern}')"
    for name, pattern in _PATTERNS.items()
)


@query(
    "date_format_profile",
    on_raw(f""", p AS ({_PROFILE})
    SELECT format, SUM(n)::BIGINT AS n_values, string_agg(date, ', ' ORDER BY date) FILTER (k <= 3) AS examples FROM (
      SELECT format, date, COUNT(*) AS n, row_number() OVER (PARTITION BY format ORDER BY date) AS k
      FROM p GROUP BY format, date) GROUP BY format"""),
)
def _(spark, sf_dir):
    return date_format_profile(raw_exports(spark, sf_dir), "date")


@query(
    "derive_night_fallback",
    on_master("SELECT event_id, CAST(DateTime_local AS DATE) AS Night FROM det"),
)
def _(spark, sf_dir):
    return derive_night(detections(spark, sf_dir)).select("event_id", "Night")


@query(
    "week_month_floor",
    """SELECT DISTINCT d, d - CAST(dayofweek(d) AS INTEGER) AS sunday, CAST(date_trunc('week', d) AS DATE) AS monday,
      CAST(date_trunc('month', d) AS DATE) AS month, CAST(weekofyear(d) AS INTEGER) AS iso_week
      FROM (SELECT CAST(o_orderdate AS DATE) AS d FROM orders)""",
)
def _(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("d")).distinct()
    return days.select(
        "d",
        times.week_floor("d").alias("sunday"),
        times.week_floor("d", "monday").alias("monday"),
        times.month_floor("d").alias("month"),
        times.iso_week("d").alias("iso_week"),
    )


@query(
    "number_formats",
    """SELECT o_orderkey, format('{:,}', o_orderkey * 1000) AS thousands, printf('%.1f%%', CAST(o_orderkey % 1000 AS DOUBLE) / 1000 * 100) AS pct,
      CASE WHEN o_orderkey < 1000 THEN CAST(o_orderkey AS VARCHAR) ELSE printf('%.1fk', """
    + rr("o_orderkey / 1000", 1)
    + """) END AS short FROM orders""",
)
def _(spark, sf_dir):
    key = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        numbers.thousands(key * 1000).alias("thousands"),
        numbers.percent_text((key % 1000).cast("double") / 1000).alias("pct"),
        numbers.short_count(key).alias("short"),
    )


@query(
    "round_half_even",
    f"""SELECT event_id, {rr('value', 0)} AS r0, {rr('value', 1)} AS r1, {rr('event_id / 4', 1)} AS quarter,
      {rr('-event_id / 8', 2)} AS eighth FROM events""",
)
def _(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        numbers.round_nearest("value", 0).alias("r0"),
        numbers.round_nearest("value", 1).alias("r1"),
        numbers.round_nearest(F.col("event_id") / 4, 1).alias("quarter"),
        numbers.round_nearest(-F.col("event_id") / 8, 2).alias("eighth"),
    )


@query(
    "string_aggregate",
    on_master("""
    SELECT Detector, string_agg(species, ', ' ORDER BY species) AS species_list,
      strftime(MIN(f), '%Y-%m-%d') || ' to ' || strftime(MAX(l), '%Y-%m-%d') AS span FROM (
      SELECT Detector, species, MIN(Night) AS f, MAX(Night) AS l FROM master GROUP BY ALL) GROUP BY Detector"""),
)
def _(spark, sf_dir):
    per_species = master(spark, sf_dir).groupBy("Detector", "species").agg(
        F.min("Night").alias("f"), F.max("Night").alias("l")
    )
    return per_species.groupBy("Detector").agg(
        F.array_join(F.array_sort(F.collect_list("species")), ", ").alias("species_list"),
        F.concat_ws(" to ", F.min("f").cast("string"), F.max("l").cast("string")).alias("span"),
    )


@query(
    "is_valid_timezone",
    """SELECT tz, tz <> 'Mars/Base' AS is_valid, COUNT(*) AS n_rows FROM (
      SELECT CASE event_id % 3 WHEN 0 THEN 'America/Chicago' WHEN 1 THEN 'Mars/Base' ELSE 'UTC' END AS tz FROM events)
      GROUP BY tz""",
)
def _(spark, sf_dir):
    eid = F.col("event_id")
    zone = F.when(eid % 3 == 0, "America/Chicago").when(eid % 3 == 1, "Mars/Base").otherwise("UTC")
    zones = table(spark, sf_dir, "events").groupBy(zone.alias("tz")).agg(F.count("*").alias("n_rows"))
    return zones.withColumn("is_valid", times.is_known_timezone("tz"))


@query(
    "time_format_check",
    on_raw("SELECT 'time' AS column_name, time AS value, COUNT(*) AS n_rows FROM raw WHERE event_id % 5 = 0 GROUP BY time"),
)
def _(spark, sf_dir):
    return time_format_violations(raw_exports(spark, sf_dir), ["time"])


@query(
    "date_order_check",
    """SELECT l_orderkey, l_linenumber, o_orderdate, l_shipdate FROM lineitem
      JOIN orders ON o_orderkey = l_orderkey WHERE l_shipdate < o_orderdate""",
)
def _(spark, sf_dir):
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    return date_order_violations(items.join(orders, "l_orderkey"), "o_orderdate", "l_shipdate").select(
        "l_orderkey", "l_linenumber", "o_orderdate", "l_shipdate"
    )
