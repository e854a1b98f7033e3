"""Chart-data queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightgrid.catalog.bases import (
    ORDERS_SQL as _ORDERS,
    all_species, final_grid, master, on_grid, on_master, order_species, plain_grid, rounded, rr, sparse_grid, table,
)
from nightgrid.catalog.registry import query
from nightgrid.operators import (
    chart_detector, chart_quality, chart_species, chart_temporal, clean,
)


# Recording quality


@query(
    "status_by_detector",
    on_grid(f"""
    SELECT Detector, Status, n_nights, CAST(t AS BIGINT) AS total_nights, {rr('n_nights / t * 100')} AS pct,
      {rr('g / t * 100')} AS pct_success
    FROM (SELECT *, SUM(n_nights) OVER (PARTITION BY Detector) AS t,
      COALESCE(MAX(CASE WHEN Status = 'Success' THEN n_nights END) OVER (PARTITION BY Detector), 0) AS g FROM
      (SELECT Detector, Status, COUNT(*) AS n_nights FROM cpn GROUP BY ALL))"""),
)
def _(spark, sf_dir):
    return rounded(chart_quality.status_by_detector(final_grid(spark, sf_dir)), "pct", "pct_success")


@query(
    "status_overall",
    on_grid(f"""
    SELECT Status, n_nights, {rr('n_nights / t * 100')} AS pct,
      Status || chr(10) || format('{{:,}}', n_nights) || ' (' || printf('%.1f', {rr('n_nights / t * 100', 1)}) || '%)' AS label
    FROM (SELECT *, SUM(n_nights) OVER () AS t FROM (SELECT Status, COUNT(*) AS n_nights FROM cpn GROUP BY ALL))"""),
)
def _(spark, sf_dir):
    return rounded(chart_quality.status_overall(final_grid(spark, sf_dir)), "pct")


@query(
    "effort_by_detector",
    on_grid(f"""
    SELECT Detector, total_hours, n_nights, {rr('mean_hours')} AS mean_hours,
      {rr('avg(total_hours) OVER ()')} AS study_mean_hours FROM (
      SELECT Detector, SUM(RecordingHours) AS total_hours, COUNT(*) AS n_nights, avg(RecordingHours) AS mean_hours
      FROM cpn GROUP BY Detector)"""),
)
def _(spark, sf_dir):
    return rounded(
        chart_quality.effort_by_detector(final_grid(spark, sf_dir)), "mean_hours", "study_mean_hours"
    )


@query(
    "nights_by_detector",
    on_grid("""
    SELECT Detector, COUNT(*) FILTER (RecordingHours > 0) AS n_nights,
      COUNT(*) FILTER (RecordingHours > 0) < 20 AS below_threshold FROM cpn GROUP BY Detector"""),
)
def _(spark, sf_dir):
    return chart_quality.nights_by_detector(final_grid(spark, sf_dir), threshold=20)


@query(
    "missing_nights",
    on_grid(f"""
    SELECT Detector, a AS actual_nights, e AS expected_nights, greatest(e - a, 0) AS missing_nights,
      {rr('a / e * 100')} AS pct_complete FROM (
      SELECT Detector, COUNT(DISTINCT CASE WHEN RecordingHours > 0 THEN Night END) AS a,
        (SELECT COUNT(DISTINCT Night) FROM sparse) AS e FROM sparse GROUP BY Detector)"""),
)
def _(spark, sf_dir):
    return rounded(chart_quality.missing_nights(sparse_grid(spark, sf_dir)), "pct_complete")


# Detectors


@query(
    "total_calls_by_detector",
    on_master("SELECT Detector, COUNT(*) AS TotalCalls FROM master GROUP BY 1"),
)
def _(spark, sf_dir):
    return chart_detector.total_calls_by_detector(master(spark, sf_dir))


@query(
    "detector_mean_ci",
    on_grid(f"""
    SELECT Detector, {rr('m')} AS mean_calls, {rr('s')} AS sd_calls, n, {rr('s / sqrt(n)')} AS se,
      {rr('m - 1.96 * (s / sqrt(n))')} AS lower, {rr('m + 1.96 * (s / sqrt(n))')} AS upper,
      {rr('avg(m) OVER ()')} AS overall_mean FROM (
      SELECT Detector, avg(CallsPerNight) AS m, stddev_samp(CallsPerNight) AS s, COUNT(CallsPerNight) AS n
      FROM cpn GROUP BY Detector)"""),
)
def _(spark, sf_dir):
    return rounded(
        chart_detector.detector_mean_ci(final_grid(spark, sf_dir)),
        "mean_calls", "sd_calls", "se", "lower", "upper", "overall_mean",
    )


@query(
    "detector_box_stats",
    on_grid("""
    SELECT Detector, CAST(MIN(CallsPerNight) AS DOUBLE) AS lowest, quantile_cont(CallsPerNight, 0.25) AS q1,
      median(CallsPerNight) AS median, quantile_cont(CallsPerNight, 0.75) AS q3,
      CAST(MAX(CallsPerNight) AS DOUBLE) AS highest FROM cpn GROUP BY Detector"""),
)
def _(spark, sf_dir):
    return chart_detector.detector_box_stats(final_grid(spark, sf_dir))


@query(
    "activity_outliers",
    on_grid(f"""
    SELECT c.Detector, c.Night, c.CallsPerNight, {rr('q.t')} AS outlier_threshold, c.CallsPerNight > q.t AS is_outlier
    FROM cpn c JOIN (SELECT Detector, quantile_cont(CallsPerNight, 0.95) AS t FROM cpn GROUP BY 1) q
    ON q.Detector = c.Detector"""),
)
def _(spark, sf_dir):
    flagged = chart_detector.activity_outliers(plain_grid(spark, sf_dir)).drop("RecordingHours")
    return rounded(flagged, "outlier_threshold")


# Species


@query(
    "species_composition",
    on_master(f"""
    SELECT species, n AS TotalCalls, {rr('n / SUM(n) OVER () * 100')} AS pct FROM (
      SELECT species, COUNT(*) AS n FROM master GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3)"""),
)
def _(spark, sf_dir):
    return rounded(chart_species.species_composition(all_species(spark, sf_dir), top_n=3), "pct")


@query(
    "noid_proportion",
    on_master(f"""
    SELECT Detector, t AS total_calls, n AS noid_calls, {rr('n / t * 100')} AS pct_noid,
      {rr('SUM(n) OVER () / SUM(t) OVER () * 100')} AS study_pct_noid FROM (
      SELECT Detector, COUNT(*) AS t, COUNT(*) FILTER (species = 'NoID') AS n FROM allsp GROUP BY 1)"""),
)
def _(spark, sf_dir):
    return rounded(
        chart_species.noid_proportion(all_species(spark, sf_dir)), "pct_noid", "study_pct_noid"
    )


_RICHNESS = f""",
rich AS (
  SELECT Night, t AS total_calls, n AS noid_calls, r AS richness, {rr('n / t * 100')} AS pct_noid FROM (
    SELECT Night, COUNT(*) AS t, COUNT(*) FILTER (species = 'NoID') AS n,
      COUNT(DISTINCT CASE WHEN species <> 'NoID' THEN species END) AS r FROM allsp GROUP BY 1))"""


@query("noid_and_richness_by_night", on_master(_RICHNESS + " SELECT * FROM rich"))
def _(spark, sf_dir):
    nightly = chart_species.noid_and_richness_by_night(all_species(spark, sf_dir))
    return rounded(nightly, "pct_noid")


@query(
    "noid_and_richness_long",
    on_master(_RICHNESS + """
    SELECT Night, 'NoID %' AS metric, pct_noid AS value FROM rich UNION ALL
    SELECT Night, 'Species Richness', CAST(richness AS DOUBLE) FROM rich"""),
)
def _(spark, sf_dir):
    nightly = chart_species.noid_and_richness_by_night(all_species(spark, sf_dir))
    return rounded(chart_species.noid_and_richness_long(nightly), "value")


@query(
    "species_hourly_profile",
    on_master(f""",
    top AS (SELECT species FROM master GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 3),
    c AS (SELECT species, Hour_local, COUNT(*) AS n FROM master WHERE species IN (SELECT species FROM top) GROUP BY ALL),
    p AS (SELECT *, n / SUM(n) OVER (PARTITION BY species) * 100 AS pct FROM c)
    SELECT t.species, CAST(h.h AS INTEGER) AS Hour_local, COALESCE(p.n, 0) AS n_calls, {rr('COALESCE(p.pct, 0)')} AS pct
    FROM top t, (SELECT unnest(range(24)) AS h) h LEFT JOIN p ON p.species = t.species AND p.Hour_local = h.h"""),
)
def _(spark, sf_dir):
    return rounded(chart_species.species_hourly_profile(all_species(spark, sf_dir), top_n=3), "pct")


@query(
    "species_by_detector_matrix",
    on_master("""
    SELECT d.Detector, s.species, COALESCE(c.n, 0) AS n_calls, s.total AS species_total,
      CASE WHEN c.n < 1000 THEN CAST(c.n AS VARCHAR) WHEN c.n IS NOT NULL THEN printf('%.1fk', c.n / 1000) END AS label
    FROM (SELECT DISTINCT Detector FROM master) d, (SELECT species, COUNT(*) AS total FROM master GROUP BY 1) s
    LEFT JOIN (SELECT Detector, species, COUNT(*) AS n FROM master GROUP BY ALL) c
    ON c.Detector = d.Detector AND c.species = s.species"""),
)
def _(spark, sf_dir):
    return chart_species.species_by_detector_matrix(all_species(spark, sf_dir))


@query(
    "species_detector_composition",
    on_master(f"""
    SELECT Detector, species, n AS n_calls, {rr('n * 100 / SUM(n) OVER (PARTITION BY Detector)')} AS pct FROM (
      SELECT Detector, species, COUNT(*) AS n FROM master WHERE species IN
        (SELECT species FROM master GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 2) GROUP BY ALL)"""),
)
def _(spark, sf_dir):
    return rounded(
        chart_species.species_detector_composition(
            all_species(spark, sf_dir), top_n=2, normalize=True
        ),
        "pct",
    )


@query(
    "species_nightly_activity",
    on_master("""
    SELECT species, Night, COUNT(*) AS n_calls FROM master WHERE species IN
      (SELECT species FROM master GROUP BY 1 ORDER BY COUNT(*) DESC, 1 LIMIT 2) GROUP BY ALL"""),
)
def _(spark, sf_dir):
    return chart_species.species_nightly_activity(all_species(spark, sf_dir), top_n=2)


@query(
    "species_phenology",
    _ORDERS + """,
    b AS (SELECT species, Night - CAST(dayofweek(Night) AS INTEGER) AS TimeBin FROM ord),
    c AS (SELECT species, TimeBin, COUNT(*) AS n FROM b GROUP BY ALL)
    SELECT s.species, t.TimeBin, COALESCE(c.n, 0) AS n_calls FROM (SELECT DISTINCT species FROM b) s,
      (SELECT DISTINCT TimeBin FROM b) t LEFT JOIN c ON c.species = s.species AND c.TimeBin = t.TimeBin""",
)
def _(spark, sf_dir):
    return chart_species.species_phenology(order_species(spark, sf_dir), "week")


@query(
    "species_turnover",
    _ORDERS + """,
    f AS (SELECT species, MIN(Night) AS n FROM ord GROUP BY 1)
    SELECT CAST(date_trunc('month', n) AS DATE) AS TimeBin, COUNT(*) AS new_species,
      CAST(SUM(COUNT(*)) OVER (ORDER BY date_trunc('month', n)) AS BIGINT) AS cumulative_species
    FROM f GROUP BY date_trunc('month', n)""",
)
def _(spark, sf_dir):
    return chart_species.species_turnover(order_species(spark, sf_dir), "month")


@query(
    "accumulation_labels",
    _ORDERS + """,
    f AS (SELECT species, MIN(Night) AS n FROM ord GROUP BY 1)
    SELECT n AS Night, CAST(SUM(COUNT(*)) OVER (ORDER BY n) AS BIGINT) AS cumulative_species,
      strftime(n, '%b %d') || chr(10) || string_agg(species, ', ' ORDER BY species) AS label FROM f GROUP BY n""",
)
def _(spark, sf_dir):
    return chart_species.accumulation_labels(order_species(spark, sf_dir))


@query(
    "noid_handling",
    on_master("SELECT event_id, species, species = 'NoID' AS is_noid FROM allsp"),
)
def _(spark, sf_dir):
    flagged = clean.noid_handling(all_species(spark, sf_dir), "show_separate")
    return flagged.select("event_id", "species", "is_noid")


@query("filter_identified", on_master("SELECT event_id, species FROM master"))
def _(spark, sf_dir):
    return clean.filter_identified(all_species(spark, sf_dir)).select("event_id", "species")


# Time


@query(
    "hourly_profile",
    on_master(f""",
    d AS (SELECT CAST(DateTime_local AS DATE) AS day, Hour_local AS h, COUNT(*) AS n FROM master GROUP BY ALL),
    a AS (SELECT x.h, COALESCE(avg(d.n), 0) AS m FROM (SELECT unnest(range(24)) AS h) x LEFT JOIN d ON d.h = x.h GROUP BY x.h)
    SELECT CAST(h AS INTEGER) AS Hour_local, {rr('m')} AS activity,
      CAST((SELECT h FROM a ORDER BY m DESC, h LIMIT 1) AS INTEGER) AS peak_hour FROM a"""),
)
def _(spark, sf_dir):
    return rounded(chart_temporal.hourly_profile(master(spark, sf_dir), "mean"), "activity")


@query(
    "hourly_profile_total",
    on_master(""",
    a AS (SELECT x.h, COUNT(m.event_id) AS n FROM (SELECT unnest(range(24)) AS h) x
      LEFT JOIN master m ON m.Hour_local = x.h GROUP BY x.h)
    SELECT CAST(h AS INTEGER) AS Hour_local, n AS activity,
      CAST((SELECT h FROM a ORDER BY n DESC, h LIMIT 1) AS INTEGER) AS peak_hour FROM a"""),
)
def _(spark, sf_dir):
    return chart_temporal.hourly_profile(master(spark, sf_dir), "total")


@query(
    "calls_per_hour_histogram",
    on_grid(f""",
    bins AS (SELECT CAST(ceil(CallsPerHour / 0.1 - 0.5) AS BIGINT) AS b FROM cpn WHERE CallsPerHour IS NOT NULL)
    SELECT h.b * 0.1::DOUBLE AS bin_center, COALESCE(c.n, 0) AS n,
      (SELECT {rr('avg(CallsPerHour)')} FROM cpn) AS mean_cph,
      (SELECT {rr('median(CallsPerHour)')} FROM cpn) AS median_cph
    FROM (SELECT unnest(generate_series((SELECT MIN(b) FROM bins), (SELECT MAX(b) FROM bins))) AS b) h
    LEFT JOIN (SELECT b, COUNT(*) AS n FROM bins GROUP BY 1) c USING (b)"""),
)
def _(spark, sf_dir):
    bins = chart_temporal.calls_per_hour_histogram(final_grid(spark, sf_dir), binwidth=0.1)
    return rounded(bins, "mean_cph", "median_cph")


def order_grid(spark, sf_dir):
    """Orders per customer and day as calls per detector and night, over several years."""
    return table(spark, sf_dir, "orders").groupBy(
        F.concat(F.lit("C"), F.col("o_custkey").cast("string")).alias("Detector"),
        F.to_date("o_orderdate").alias("Night"),
    ).agg(F.count("*").alias("CallsPerNight"))


_ORDER_GRID = """WITH g AS (
  SELECT 'C' || o_custkey AS Detector, CAST(o_orderdate AS DATE) AS Night, COUNT(*) AS CallsPerNight
  FROM orders GROUP BY ALL)"""


@query(
    "weekly_activity",
    _ORDER_GRID + f"""
    SELECT Night - CAST(dayofweek(Night) AS INTEGER) AS Week, CAST(SUM(CallsPerNight) AS BIGINT) AS total_calls,
      COUNT(*) AS n_nights, {rr('avg(CallsPerNight)')} AS mean_calls,
      CAST(weekofyear(MIN(Night)) AS INTEGER) AS first_iso_week FROM g GROUP BY 1""",
)
def _(spark, sf_dir):
    return rounded(chart_temporal.weekly_activity(order_grid(spark, sf_dir)), "mean_calls")


@query(
    "monthly_activity",
    _ORDER_GRID + """
    SELECT Detector, CAST(date_trunc('month', Night) AS DATE) AS Month,
      CAST(SUM(CallsPerNight) AS BIGINT) AS total_calls, COUNT(*) AS n_nights FROM g GROUP BY 1, 2""",
)
def _(spark, sf_dir):
    return chart_temporal.monthly_activity(order_grid(spark, sf_dir), by_detector=True)
