"""Summary-table, window and reshape queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightgrid.catalog.bases import (
    ORDERS_SQL, all_species, detections, final_grid, master, on_grid, on_master, order_species, pct, plain_grid,
    rounded, rr,
)
from nightgrid.catalog.registry import query
from nightgrid.functions.times import hour_floor
from nightgrid.operators import reshape, summaries
from nightgrid.operators.chart_temporal import cumulative_calls_by_detector, cumulative_calls_study
from nightgrid.operators.chart_detector import rolling_mean_rank
from nightgrid.operators.chart_species import cumulative_species, species_rank_abundance
from nightgrid.operators.chart_quality import label_midpoint, status_by_detector
from nightgrid.operators.clean import keep_first
from nightgrid.operators.condense import condense


def _five(value: str, suffix: str, digits: int, prefix: str = "") -> str:
    functions = {
        "mean": "avg", "median": "median", "sd": "stddev_samp", "min": "min", "max": "max",
    }
    return ", ".join(
        f"{rr(f'{fn}({value})', digits)} AS {prefix}{name}_{suffix}" for name, fn in functions.items()
    )


_STATUS = ", ".join(
    f"{pct(f'''COUNT(*) FILTER (Status = '{s}')''', 'COUNT(*)')} AS pct_{s.lower()}"
    for s in ("Success", "Partial", "Fail")
)


@query(
    "detector_activity_summary",
    on_grid(f"""
    SELECT Detector, COUNT(*) AS n_nights, {rr('SUM(RecordingHours)', 1)} AS total_hours,
      {rr('avg(RecordingHours)', 1)} AS mean_hours, {_STATUS},
      CAST(SUM(CallsPerNight) AS BIGINT) AS total_calls,
      {_five('CallsPerNight', 'cpn', 1)}, {_five('CallsPerHour', 'cph', 2)},
      {pct('stddev_samp(CallsPerHour)', 'avg(CallsPerHour)')} AS cv_pct,
      {pct('COUNT(*) FILTER (CallsPerNight = 0)', 'COUNT(*)')} AS pct_zero,
      MIN(Night) AS first_night, MAX(Night) AS last_night
    FROM cpn GROUP BY Detector"""),
)
def _(spark, sf_dir):
    return summaries.detector_activity_summary(final_grid(spark, sf_dir))


@query(
    "coefficient_of_variation",
    on_grid(f"""
    SELECT Detector, {rr('avg(CallsPerNight)')} AS mean_calls, {rr('stddev_samp(CallsPerNight)')} AS sd_calls,
      {rr('stddev_samp(CallsPerNight) / NULLIF(avg(CallsPerNight), 0)')} AS cv FROM cpn GROUP BY Detector"""),
)
def _(spark, sf_dir):
    table = summaries.coefficient_of_variation(final_grid(spark, sf_dir))
    return rounded(table, "mean_calls", "sd_calls", "cv")


@query(
    "effort_summary",
    on_grid(f"""
    SELECT Detector, COUNT(*) AS total_nights, COUNT(*) FILTER (RecordingHours > 0) AS nights_with_data,
      {rr('SUM(RecordingHours)', 1)} AS total_recording_hours,
      {pct('COUNT(*) FILTER (RecordingHours > 0)', 'COUNT(*)')} AS percent_nights_with_data,
      {rr('avg(RecordingHours)', 2)} AS mean_hours_per_night,
      strftime(MIN(Night), '%Y-%m-%d') || ' to ' || strftime(MAX(Night), '%Y-%m-%d') AS date_range
    FROM cpn GROUP BY Detector"""),
)
def _(spark, sf_dir):
    return summaries.effort_summary(final_grid(spark, sf_dir))


_STUDY = f""",
study AS (
  SELECT *, {pct('overall_sd_cph', 'overall_mean_cph')} AS overall_cv_pct FROM (
    SELECT COUNT(DISTINCT Detector) AS n_detectors, COUNT(*) AS n_detector_nights,
      MIN(Night) AS study_start, MAX(Night) AS study_end,
      CAST(MAX(Night) - MIN(Night) + 1 AS INTEGER) AS study_duration_days,
      CAST(SUM(CallsPerNight) AS BIGINT) AS total_calls, {rr('SUM(RecordingHours)', 1)} AS total_hours,
      {_five('CallsPerNight', 'cpn', 1, 'overall_')}, {_five('CallsPerHour', 'cph', 2, 'overall_')}, {_STATUS}
    FROM cpn))"""


@query("study_summary", on_grid(_STUDY + " SELECT * FROM study"))
def _(spark, sf_dir):
    return summaries.study_summary(final_grid(spark, sf_dir))


_VARIANCE = f""",
va AS (
  SELECT (SELECT var_samp(CallsPerHour) FROM cpn) AS t, var_samp(m) AS b, avg(v) AS w FROM
    (SELECT avg(CallsPerHour) AS m, var_samp(CallsPerHour) AS v FROM cpn GROUP BY Detector)),
vc AS (
  SELECT {rr('t', 2)} AS var_total, {rr('b', 2)} AS var_between, {rr('w', 2)} AS var_within,
    {pct('b', 't')} AS pct_between, {pct('w', 't')} AS pct_within FROM va)"""


@query("variance_components", on_grid(_VARIANCE + " SELECT * FROM vc"))
def _(spark, sf_dir):
    return summaries.variance_components(final_grid(spark, sf_dir))


@query(
    "species_by_detector",
    on_master(f"""
    SELECT Detector, species, n_calls, {pct('n_calls', 'SUM(n_calls) OVER (PARTITION BY Detector)')} AS pct_of_detector
    FROM (SELECT Detector, species, COUNT(*) AS n_calls FROM master GROUP BY ALL)"""),
)
def _(spark, sf_dir):
    return summaries.species_by_detector(master(spark, sf_dir))


@query(
    "species_accumulation",
    ORDERS_SQL + """
    SELECT Night, COUNT(*) AS new_species, string_agg(species, ', ' ORDER BY species) AS new_species_list,
      CAST(SUM(COUNT(*)) OVER (ORDER BY Night) AS BIGINT) AS cumulative_species
    FROM (SELECT species, MIN(Night) AS Night FROM ord GROUP BY 1) GROUP BY Night""",
)
def _(spark, sf_dir):
    return summaries.species_accumulation(order_species(spark, sf_dir))


@query(
    "hourly_activity",
    on_master(f"""
    SELECT Hour_local, COUNT(*) AS n_calls, {pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS pct_of_total
    FROM master GROUP BY Hour_local"""),
)
def _(spark, sf_dir):
    return summaries.hourly_activity(master(spark, sf_dir))


@query(
    "module_headline_counts",
    on_grid("""
    SELECT COUNT(DISTINCT Detector) AS n_detectors, COUNT(*) AS n_detector_nights,
      CAST(SUM(CallsPerNight) AS BIGINT) AS total_calls, SUM(RecordingHours) AS total_recording_hours,
      COUNT(*) FILTER (Status = 'Fail') AS dead_nights, MIN(Night) AS first_night, MAX(Night) AS last_night,
      (SELECT COUNT(DISTINCT species) FROM master) AS n_species FROM cpn"""),
)
def _(spark, sf_dir):
    return summaries.module_headline_counts(master(spark, sf_dir), final_grid(spark, sf_dir))


# Windows


@query(
    "cumulative_calls_by_detector",
    on_grid("""
    SELECT Detector, Night, CallsPerNight,
      CAST(SUM(CallsPerNight) OVER (PARTITION BY Detector ORDER BY Night) AS BIGINT) AS cumulative_calls FROM cpn"""),
)
def _(spark, sf_dir):
    return cumulative_calls_by_detector(plain_grid(spark, sf_dir))


@query(
    "cumulative_calls_study",
    on_grid("""
    SELECT Night, CAST(SUM(CallsPerNight) AS BIGINT) AS daily_total,
      CAST(SUM(SUM(CallsPerNight)) OVER (ORDER BY Night) AS BIGINT) AS cumulative_calls FROM cpn GROUP BY Night"""),
)
def _(spark, sf_dir):
    return cumulative_calls_study(plain_grid(spark, sf_dir))


@query(
    "cumulative_species",
    ORDERS_SQL + """
    SELECT CAST(n.d AS DATE) AS Night, (SELECT COUNT(*) FROM (SELECT species, MIN(Night) AS f FROM ord GROUP BY 1) x
      WHERE x.f <= n.d) AS cumulative_species
    FROM (SELECT unnest(generate_series(MIN(Night), MAX(Night), INTERVAL 1 DAY)) AS d FROM ord) n""",
)
def _(spark, sf_dir):
    return cumulative_species(order_species(spark, sf_dir))


@query(
    "rolling_mean_rank",
    on_grid(f"""
    SELECT Detector, Night, {rr('r')} AS rolling_calls,
      rank() OVER (PARTITION BY Night ORDER BY r DESC) + (COUNT(*) OVER (PARTITION BY Night, r) - 1) / 2 AS rank
    FROM (SELECT Detector, Night, s / 7.0::DOUBLE AS r FROM (SELECT Detector, Night,
        CAST(SUM(CallsPerNight) OVER w AS DOUBLE) AS s, COUNT(*) OVER w AS k FROM cpn
        WINDOW w AS (PARTITION BY Detector ORDER BY Night ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)) WHERE k = 7)"""),
)
def _(spark, sf_dir):
    return rounded(rolling_mean_rank(plain_grid(spark, sf_dir)), "rolling_calls")


@query(
    "share_of_group",
    on_master(f"""
    SELECT Detector, Night, n_calls, {pct('n_calls', 'SUM(n_calls) OVER (PARTITION BY Detector)')} AS pct
    FROM (SELECT Detector, Night, COUNT(*) AS n_calls FROM master GROUP BY ALL)"""),
)
def _(spark, sf_dir):
    counts = master(spark, sf_dir).groupBy("Detector", "Night").agg(F.count("*").alias("n_calls"))
    return reshape.share_of_group(counts, "Detector", "n_calls", "pct")


@query(
    "rank_abundance",
    on_master("""
    SELECT species, n_calls, CAST(row_number() OVER (ORDER BY n_calls DESC, species) AS INTEGER) AS rank
    FROM (SELECT species, COUNT(*) AS n_calls FROM master GROUP BY 1)"""),
)
def _(spark, sf_dir):
    return species_rank_abundance(master(spark, sf_dir))


@query(
    "label_midpoint",
    on_grid("""
    SELECT Detector, Status, n_nights, CAST(c AS BIGINT) AS cumulative_nights, c - n_nights / 2 AS label_y FROM (
      SELECT *, SUM(n_nights) OVER (PARTITION BY Detector ORDER BY o DESC) AS c FROM (
        SELECT Detector, Status, COUNT(*) AS n_nights,
          CASE Status WHEN 'Success' THEN 1 WHEN 'Partial' THEN 2 ELSE 3 END AS o FROM cpn GROUP BY ALL))"""),
)
def _(spark, sf_dir):
    return label_midpoint(status_by_detector(final_grid(spark, sf_dir)))


@query(
    "rows_in_group",
    on_master("""
    SELECT event_id, Detector, manual_id, COUNT(*) OVER (PARTITION BY Detector, manual_id) AS n_occurrences FROM det"""),
)
def _(spark, sf_dir):
    counted = reshape.rows_in_group(detections(spark, sf_dir), ["Detector", "manual_id"])
    return counted.select("event_id", "Detector", "manual_id", "n_occurrences")


def hourly_copies(spark, sf_dir):
    """Detections cut to the hour, so that many share detector, hour and label."""
    return detections(spark, sf_dir).select(
        "event_id", "Detector", hour_floor("DateTime_local").alias("DateTime_local"), "auto_id", "pulses"
    )


HOURLY_COPIES = """,
copies AS (SELECT event_id, Detector, date_trunc('hour', DateTime_local) AS DateTime_local, auto_id, pulses FROM det)"""


@query(
    "dedup_keep_first",
    on_master(HOURLY_COPIES + """
    SELECT * FROM copies QUALIFY row_number() OVER (PARTITION BY Detector, DateTime_local, auto_id ORDER BY event_id) = 1"""),
)
def _(spark, sf_dir):
    return keep_first(hourly_copies(spark, sf_dir))


# Reshaping


@query(
    "top_n_per_group",
    on_master("""
    SELECT Detector, species, n_calls FROM (SELECT Detector, species, COUNT(*) AS n_calls FROM master GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY Detector ORDER BY n_calls DESC, species) <= 2"""),
)
def _(spark, sf_dir):
    counts = master(spark, sf_dir).groupBy("Detector", "species").agg(F.count("*").alias("n_calls"))
    return reshape.top_n_per_group(counts, "Detector", 2)


@query(
    "top_n_global",
    on_master("""
    SELECT species, COUNT(*) AS total FROM master GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3"""),
)
def _(spark, sf_dir):
    counts = master(spark, sf_dir).groupBy("Detector", "species").agg(F.count("*").alias("n_calls"))
    return reshape.top_n_global(counts, 3)


@query(
    "pivot_wide",
    on_master("""
    SELECT Detector, COUNT(*) FILTER (species = 'click') AS click, COUNT(*) FILTER (species = 'purchase') AS purchase,
      COUNT(*) FILTER (species = 'signup') AS signup, COUNT(*) FILTER (species = 'view') AS view
    FROM master GROUP BY Detector"""),
)
def _(spark, sf_dir):
    counts = master(spark, sf_dir).groupBy("Detector", "species").agg(F.count("*").alias("n_calls"))
    return reshape.pivot_wide(counts, "Detector", "species", "n_calls")


@query(
    "unpivot_long",
    on_grid(_STUDY + """
    SELECT CAST(o AS INTEGER) AS position, m AS Metric, v AS Value FROM (
      SELECT unnest([1,2,3,4,5,6,7,8,9,10,11,12,13]) AS o,
        unnest(['Number of Detectors','Total Detector-Nights','Study Start Date','Study End Date','Study Duration (days)',
          'Total Bat Calls','Total Recording Hours','Mean Calls Per Hour','Median Calls Per Hour',
          'Coefficient of Variation (%)','Nights with Full Recording (%)','Nights with Partial Recording (%)',
          'Nights with No Recording (%)']) AS m,
        unnest([format('{:,}', n_detectors), format('{:,}', n_detector_nights), strftime(study_start, '%Y-%m-%d'),
          strftime(study_end, '%Y-%m-%d'), format('{:,}', study_duration_days), format('{:,}', total_calls),
          printf('%.1f', total_hours), printf('%.1f', """ + rr("overall_mean_cph", 1) + """),
          printf('%.1f', """ + rr("overall_median_cph", 1) + """),
          regexp_replace(CAST(overall_cv_pct AS VARCHAR), '\\.0$', '') || '%',
          regexp_replace(CAST(pct_success AS VARCHAR), '\\.0$', '') || '%',
          regexp_replace(CAST(pct_partial AS VARCHAR), '\\.0$', '') || '%',
          regexp_replace(CAST(pct_fail AS VARCHAR), '\\.0$', '') || '%']) AS v FROM study)"""),
)
def _(spark, sf_dir):
    return reshape.study_overview(summaries.study_summary(final_grid(spark, sf_dir)))


@query(
    "transpose_one_row",
    on_grid(_VARIANCE + """
    UNPIVOT (SELECT CAST(var_total AS VARCHAR) AS var_total, CAST(var_between AS VARCHAR) AS var_between,
      CAST(var_within AS VARCHAR) AS var_within, CAST(pct_between AS VARCHAR) AS pct_between,
      CAST(pct_within AS VARCHAR) AS pct_within FROM vc) ON COLUMNS(*) INTO NAME metric VALUE value"""),
)
def _(spark, sf_dir):
    return reshape.one_row_to_pairs(summaries.variance_components(final_grid(spark, sf_dir)))


@query(
    "bind_rows",
    on_master("""
    SELECT event_id, Detector, auto_id, NULL AS manual_id FROM det UNION ALL
    SELECT event_id, Detector, NULL, manual_id FROM det WHERE manual_id IS NOT NULL"""),
)
def _(spark, sf_dir):
    from nightgrid.sources.exports import bind_rows

    rows = detections(spark, sf_dir)
    automatic = rows.select("event_id", "Detector", "auto_id")
    manual = rows.where("manual_id IS NOT NULL").select("manual_id", "Detector", "event_id")
    return bind_rows([automatic, manual])


@query(
    "order_outputs",
    on_master("""
    SELECT Detector, species, COUNT(*) AS n_calls FROM master GROUP BY ALL ORDER BY Detector, n_calls DESC, species"""),
)
def _(spark, sf_dir):
    return summaries.species_by_detector(master(spark, sf_dir)).drop("pct_of_detector")


@query(
    "peak_flag",
    on_master("""
    SELECT printf('%02d:00', Hour_local) AS Hour, n_calls, n_calls = MAX(n_calls) OVER () AS is_peak
    FROM (SELECT Hour_local, COUNT(*) AS n_calls FROM master GROUP BY 1)"""),
)
def _(spark, sf_dir):
    return reshape.peak_flag(summaries.hourly_activity(master(spark, sf_dir)).drop("pct_of_total"))


@query(
    "complete_levels",
    on_master("""
    SELECT d.Detector, s.species, COALESCE(c.n, 0) AS n_calls FROM (SELECT DISTINCT Detector FROM allsp) d,
      (SELECT DISTINCT species FROM allsp) s LEFT JOIN
      (SELECT Detector, species, COUNT(*) AS n FROM allsp GROUP BY ALL) c
      ON c.Detector = d.Detector AND c.species = s.species"""),
)
def _(spark, sf_dir):
    counts = all_species(spark, sf_dir).groupBy("Detector", "species").agg(F.count("*").alias("n_calls"))
    return reshape.completed(counts, "Detector", "species")


@query(
    "condense",
    on_master("""
    SELECT Detector, auto_id, species, Night, date_trunc('hour', DateTime_local) AS DateTime_local, Hour_local,
      COUNT(*) AS _weight FROM master GROUP BY ALL"""),
)
def _(spark, sf_dir):
    return condense(master(spark, sf_dir))
