"""Contract, profile and fingerprint queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightgrid.catalog.bases import (
    CONFIG, detections, final_grid, master, on_grid, on_master, on_raw, pct, raw_exports, rr, sparse_grid,
    table, versioned_raw,
)
from nightgrid.catalog.grid_entries import _ids, nation_names
from nightgrid.catalog.registry import query
from nightgrid.catalog.summary_entries import HOURLY_COPIES, hourly_copies
from nightgrid.operators import contracts, grid, profile
from nightgrid.operators.audit import content_fingerprint
from nightgrid.operators.ingest import derive_detector_id


@query("require_columns", on_master("SELECT auto_id, COUNT(*) AS n_rows FROM det GROUP BY 1"))
def _(spark, sf_dir):
    checked = contracts.require_columns(detections(spark, sf_dir), ["Detector", "auto_id"])
    return checked.groupBy("auto_id").agg(F.count("*").alias("n_rows"))


@query("require_types", on_grid("SELECT MIN(Night) AS first_night, CAST(SUM(CallsPerNight) AS BIGINT) AS calls FROM cpn"))
def _(spark, sf_dir):
    checked = contracts.require_types(
        final_grid(spark, sf_dir), {"Night": "date", "CallsPerNight": "numeric"}
    )
    return checked.agg(F.min("Night").alias("first_night"), F.sum("CallsPerNight").alias("calls"))


@query("require_rows", on_master("SELECT COUNT(*) AS n_rows FROM master"))
def _(spark, sf_dir):
    return contracts.require_rows(master(spark, sf_dir)).agg(F.count("*").alias("n_rows"))


@query(
    "require_not_null",
    on_raw(f"""
    SELECT c AS column_name, t AS n_total, k AS n_null, {pct('k', 't')} AS pct_null FROM (
      SELECT 'n' AS c, COUNT(*) AS t, COUNT(*) FILTER (n IS NULL) AS k FROM raw UNION ALL
      SELECT 'alternate_1', COUNT(*), COUNT(*) FILTER (alternate_1 IS NULL) FROM raw UNION ALL
      SELECT 'in_file', COUNT(*), COUNT(*) FILTER (in_file IS NULL) FROM raw)"""),
)
def _(spark, sf_dir):
    raw = raw_exports(spark, sf_dir)
    contracts.require_not_null(raw, ["in_file"])
    return contracts.null_report(raw, ["n", "alternate_1", "in_file"])


@query("cpn_contract", on_grid("SELECT Status, COUNT(*) AS n_nights FROM cpn GROUP BY 1"))
def _(spark, sf_dir):
    checked = contracts.cpn_contract(final_grid(spark, sf_dir), status=True, rate=True)
    return checked.groupBy("Status").agg(F.count("*").alias("n_nights"))


@query("master_contract", on_master("SELECT COUNT(*) AS n_rows, COUNT(DISTINCT Detector) AS n_detectors FROM master"))
def _(spark, sf_dir):
    checked = contracts.master_contract(master(spark, sf_dir))
    per_detector = checked.groupBy("Detector").agg(F.count("*").alias("n"))
    return per_detector.agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_detectors"))


def shared_names(spark, sf_dir):
    """As ``nation_names``, but the first five detectors share two names, but for the placeholder's."""
    key = F.substring("detector_id", 2, 6).cast("int")
    shared = F.when((key < 5) & (key != 3), F.concat(F.lit("Site "), (key % 2).cast("string")))
    return nation_names(spark, sf_dir).withColumn("Detector", F.coalesce(shared, "Detector"))


_SHARED_NAMES = """,
names AS (
  SELECT 'D' || lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS detector_id,
         CASE WHEN n_nationkey = 3 THEN 'ENTER_NAME_HERE' WHEN n_nationkey < 5 THEN 'Site ' || (n_nationkey % 2) ELSE n_name END AS name
  FROM nation)"""


@query(
    "mapping_quality",
    on_master(_SHARED_NAMES + """
    SELECT m.Detector AS detector_id, n.name AS Detector, m.k AS total_detections,
      n.name IS NOT NULL AND n.name <> 'ENTER_NAME_HERE' AS mapped,
      coalesce(n.name = 'ENTER_NAME_HERE', FALSE) AS is_placeholder,
      n.name IS NOT NULL AND n.name <> 'ENTER_NAME_HERE' AND COUNT(*) OVER (PARTITION BY n.name) > 1 AS duplicate_name
    FROM (SELECT Detector, COUNT(*) AS k FROM master GROUP BY 1) m LEFT JOIN names n ON n.detector_id = m.Detector"""),
)
def _(spark, sf_dir):
    return profile.mapping_quality(_ids(spark, sf_dir), shared_names(spark, sf_dir))


@query(
    "mapping_summary",
    on_master(_SHARED_NAMES + """
    SELECT COUNT(*) FILTER (n.name = 'ENTER_NAME_HERE') AS placeholders_remaining,
      COUNT(DISTINCT n.name) FILTER (n.name <> 'ENTER_NAME_HERE') < COUNT(*) FILTER (n.name <> 'ENTER_NAME_HERE') AS duplicate_names_detected,
      COUNT(*) FILTER (n.name IS NULL OR n.name = 'ENTER_NAME_HERE') = 0 AS all_detectors_mapped
    FROM (SELECT DISTINCT Detector FROM master) m LEFT JOIN names n ON n.detector_id = m.Detector"""),
)
def _(spark, sf_dir):
    return profile.mapping_summary(
        profile.mapping_quality(_ids(spark, sf_dir), shared_names(spark, sf_dir))
    )


@query(
    "temporal_completeness",
    on_grid("""
    SELECT s.Detector, s.Night, CASE WHEN p.RecordingHours = 8.5 THEN 'Partial' ELSE 'NoData' END AS status,
      13.0::DOUBLE AS expected_hours, COALESCE(p.RecordingHours, 0.0)::DOUBLE AS actual_hours
    FROM spine s LEFT JOIN sparse p ON p.Detector = s.Detector AND p.Night = s.Night
    WHERE p.RecordingHours IS NULL OR p.RecordingHours <> 13"""),
)
def _(spark, sf_dir):
    found = grid.classify_status(sparse_grid(spark, sf_dir), CONFIG.intended_hours)
    expected = grid.detector_nights(found, CONFIG.start_date, CONFIG.end_date)
    return profile.temporal_completeness(expected, found, CONFIG.intended_hours)


@query(
    "species_code_quality",
    on_raw(f"""
    SELECT auto_id, n AS n_rows, auto_id = 'NoID' AS is_unidentified, auto_id = 'PIPXX' AS is_unknown_code,
      {pct('n', 'SUM(n) OVER ()')} AS pct_rows FROM (SELECT auto_id, COUNT(*) AS n FROM raw GROUP BY 1)"""),
)
def _(spark, sf_dir):
    return profile.species_code_quality(raw_exports(spark, sf_dir))


@query(
    "mixed_schema_files",
    on_raw("""
    SELECT * FROM (SELECT source_file, schema_version, COUNT(*) AS n_rows,
      COUNT(*) OVER (PARTITION BY source_file) AS n_versions FROM vraw GROUP BY source_file, schema_version)
    WHERE n_versions > 1"""),
)
def _(spark, sf_dir):
    return profile.mixed_schema_files(versioned_raw(spark, sf_dir))


@query(
    "schema_distribution",
    on_raw(f"""
    SELECT schema_version, COUNT(*) AS count, {pct('COUNT(*)', 'SUM(COUNT(*)) OVER ()')} AS percent
    FROM vraw GROUP BY schema_version"""),
)
def _(spark, sf_dir):
    return profile.schema_distribution(versioned_raw(spark, sf_dir))


@query(
    "dominant_schema",
    on_raw("SELECT schema_version, COUNT(*) AS count FROM vraw GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1"),
)
def _(spark, sf_dir):
    return profile.dominant_schema(versioned_raw(spark, sf_dir))


_COMPLETE = " UNION ALL ".join(
    f"SELECT '{c}' AS c, COUNT(*) AS t, COUNT({c}) AS k FROM raw"
    for c in ("event_id", "in_file", "date", "alternates", "alternate_1", "alternate_2", "n", "out_file", "out_file_fs")
)


@query(
    "column_completeness",
    on_raw(f"SELECT c AS column_name, t AS n_total, k AS n_complete, {pct('k', 't')} AS pct_complete FROM ({_COMPLETE})"),
)
def _(spark, sf_dir):
    return profile.column_completeness(
        raw_exports(spark, sf_dir).select(
            "event_id", "in_file", "date", "alternates", "alternate_1", "alternate_2", "n",
            "out_file", "out_file_fs",
        )
    )


@query(
    "duplicate_report",
    on_master(HOURLY_COPIES + """
    SELECT SUM(n)::BIGINT AS n_total, COUNT(*) AS n_unique, SUM(CASE WHEN n > 1 THEN n ELSE 0 END)::BIGINT AS n_duplicates
    FROM (SELECT COUNT(*) AS n FROM copies GROUP BY Detector, DateTime_local, auto_id)"""),
)
def _(spark, sf_dir):
    return profile.duplicate_report(
        hourly_copies(spark, sf_dir), ["Detector", "DateTime_local", "auto_id"]
    )


@query(
    "duplicate_rows",
    on_master(HOURLY_COPIES + """
    SELECT * FROM copies QUALIFY COUNT(*) OVER (PARTITION BY Detector, DateTime_local, auto_id) > 1"""),
)
def _(spark, sf_dir):
    return profile.duplicate_rows(
        hourly_copies(spark, sf_dir), ["Detector", "DateTime_local", "auto_id"]
    )


@query(
    "content_fingerprint",
    """SELECT n AS n_rows, sha256(n || ':' || x || ':' || s) AS fingerprint FROM (
      SELECT COUNT(*) AS n, bit_xor(h) AS x, SUM(h) AS s FROM (
        SELECT CAST('0x' || substr(md5(concat_ws(chr(31), CAST(event_id AS VARCHAR), event_type, COALESCE(props, '\\N'),
          CAST(user_id AS VARCHAR))), 1, 15) AS BIGINT) AS h FROM events))""",
)
def _(spark, sf_dir):
    columns = ["event_id", "user_id", "event_type", "props"]
    return content_fingerprint(table(spark, sf_dir, "events"), columns, portable=True)


@query(
    "infer_study_span",
    on_raw("""
    SELECT MIN(d) AS start_date, MAX(d) AS end_date, COUNT(DISTINCT substr(in_file, 1, 16)) AS n_detector_ids FROM (
      SELECT in_file, CASE WHEN event_id % 97 <> 0 THEN CAST(ts AS DATE) END AS d FROM raw)"""),
)
def _(spark, sf_dir):
    return profile.infer_study_span(derive_detector_id(raw_exports(spark, sf_dir)))
