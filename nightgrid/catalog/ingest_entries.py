"""Source, sink, schema and cleaning queries.

Those about files write the derived rows to the shared scratch folder first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from nightgrid.catalog.bases import (
    CONFIG, detections, final_grid, master, on_grid, on_master, on_raw, pct, plain_grid, raw_exports, rr, table,
    versioned_raw,
)
from nightgrid.catalog.registry import query
from nightgrid.catalog.summary_entries import HOURLY_COPIES, _VARIANCE, hourly_copies
from nightgrid.operators import clean, ingest, schema, summaries
from nightgrid.operators.audit import cleaning_counts, row_audit, unparsed_times
from nightgrid.plans.phases import localize, prepare_master
from nightgrid.sources import exports, results, snapshots, templates
from nightgrid.sources.names import clean_names
from nightgrid.sources.scratch import scratch_path

# Column order of each kind of export file; it differs on purpose.
_FILE_COLUMNS = {
    0: ["in_file", "date", "time", "auto_id", "alternates", "n", "pulses", "out_file"],
    1: ["n", "auto_id", "alternate_1", "alternate_2", "in_file", "time", "date", "pulses", "out_file"],
    2: ["date", "in_file", "auto_id", "alternate_1", "alternate_2", "time", "n", "out_file_fs", "pulses"],
    3: ["auto_id", "alternate_1", "in_file", "date", "time", "n", "pulses", "out_file_fs"],
}


def write_exports(raw: DataFrame, root: str, kinds=(0, 1, 2, 3), nested: bool = False) -> str:
    """The raw rows as CSV files, one header layout per kind."""
    for kind in kinds:
        part = raw.where(F.col("kind") == kind).select(*_FILE_COLUMNS[kind])
        target = f"{root}/site_{kind}/night" if nested else root
        part.write.mode("append").option("header", True).option("escape", '"').csv(target)
    return root


_READ = ["in_file", "detector_id", "auto_id", "alternates", "alternate_1", "alternate_2", "n", "date", "time", "schema_version"]
_READ_SQL = """
  SELECT in_file, substr(in_file, 1, 16) AS detector_id, auto_id, NULLIF(alternates, '') AS alternates,
    alternate_1, alternate_2, n, date, time, schema_version FROM vraw WHERE TRY_CAST(n AS DOUBLE) > 0"""


@query(
    "read_all_string_csv",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(user_id AS VARCHAR) AS user_id,
      CASE event_id % 3 WHEN 2 THEN 'a "b", c' END AS note FROM events""",
)
def _(spark, sf_dir):
    eid = F.col("event_id")
    note = F.when(eid % 3 == 0, "").when(eid % 3 == 1, "NA").otherwise('a "b", c')
    rows = table(spark, sf_dir, "events").select(
        eid.cast("string"), "event_type", F.col("user_id").cast("string"), note.alias("note")
    )
    path = scratch_path(spark, "csv")
    rows.write.option("header", True).option("escape", '"').csv(path)
    return exports.read_all_string_csv(spark, path, rows.columns)


@query("load_flat_dir", on_raw(_READ_SQL))
def _(spark, sf_dir):
    root = write_exports(raw_exports(spark, sf_dir), scratch_path(spark, "flat"))
    return exports.load_flat_dir(spark, root).rows.select(*_READ)


@query("load_recursive_dir", on_raw(_READ_SQL))
def _(spark, sf_dir):
    root = write_exports(raw_exports(spark, sf_dir), scratch_path(spark, "deep"), nested=True)
    return exports.load_recursive_dir(spark, root, glob="*.csv").rows.select(*_READ)


@query(
    "load_broken_lines",
    on_raw("""SELECT in_file, n, date, auto_id || chr(10) || 'checked "twice", ' || chr(10) || in_file AS note
      FROM vraw WHERE kind = 3 AND TRY_CAST(n AS DOUBLE) > 0"""),
)
def _(spark, sf_dir):
    text = F.format_string('%s\nchecked "twice", \n%s', "auto_id", "in_file")
    rows = raw_exports(spark, sf_dir).where("kind = 3").select("in_file", "n", "date", text.alias("note"))
    root = scratch_path(spark, "broken")
    rows.write.option("header", True).option("escape", '"').csv(root)
    return exports.load_flat_dir(spark, root).rows.select("in_file", "n", "date", "note")


@query(
    "union_sources",
    on_raw("""
    SELECT CASE WHEN kind <= 1 THEN 'local' ELSE 'external' END AS source_kind, COUNT(*) AS n_rows
    FROM vraw WHERE TRY_CAST(n AS DOUBLE) > 0 GROUP BY 1"""),
)
def _(spark, sf_dir):
    raw = raw_exports(spark, sf_dir)
    near = write_exports(raw, scratch_path(spark, "near"), (0, 1))
    far = write_exports(raw, scratch_path(spark, "far"), (2, 3), nested=True)
    united = exports.union_sources(
        {
            "local": exports.load_flat_dir(spark, near).rows,
            "external": exports.load_recursive_dir(spark, far, "*.csv", source_rank=1).rows,
        }
    )
    return exports.source_split(united)


@query(
    "source_file_column",
    "SELECT 'events.parquet' AS source_file, COUNT(*) AS n_rows FROM events",
)
def _(spark, sf_dir):
    named = exports.with_provenance(table(spark, sf_dir, "events"))
    return named.groupBy("source_file").agg(F.count("*").alias("n_rows"))


@query(
    "clean_column_names",
    """SELECT event_id, ts AS event_time_utc, user_id AS auto_id, event_type, value AS percent_value,
      event_id AS event_id_2 FROM events""",
)
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "event_id", "ts", "user_id", "event_type", "value", F.col("event_id").alias("again")
    )
    headers = ["Event ID", "event-time (UTC)", "AUTO ID*", "EventType", "% value", "event.id"]
    return events.toDF(*clean_names(headers))


@query(
    "write_master_csv",
    on_master("""
    SELECT CAST(event_id AS VARCHAR) AS event_id, Detector, date_trunc('second', DateTime_local) AS DateTime_local,
      species FROM master"""),
)
def _(spark, sf_dir):
    path = scratch_path(spark, "master-csv")
    rows = master(spark, sf_dir).select("event_id", "Detector", "DateTime_local", "species")
    snapshots.write_master_csv(rows, path)
    return snapshots.read_master_csv(spark, path)


@query(
    "reparse_local_datetime",
    on_master("""
    SELECT event_id, CASE event_id % 3 WHEN 0 THEN date_trunc('second', DateTime_local)
      WHEN 1 THEN date_trunc('minute', DateTime_local) ELSE date_trunc('second', DateTime_local) END AS DateTime_local
    FROM master"""),
)
def _(spark, sf_dir):
    eid = F.col("event_id")
    text = (
        F.when(eid % 3 == 0, F.date_format("DateTime_local", "MM/dd/yyyy HH:mm:ss"))
        .when(eid % 3 == 1, F.date_format("DateTime_local", "M/d/yyyy H:mm"))
        .otherwise(F.date_format("DateTime_local", "M/d/yyyy h:mm:ss a"))
    )
    rows = master(spark, sf_dir).select("event_id", text.alias("DateTime_local"))
    return snapshots.reparse_local_datetime(rows)


@query(
    "read_latest_snapshot",
    on_master("""
    SELECT '20240301_000000' AS run_ts, species, COUNT(*) AS n_rows FROM master GROUP BY species"""),
)
def _(spark, sf_dir):
    root = scratch_path(spark, "snapshots")
    rows = master(spark, sf_dir).select("event_id", "species")
    snapshots.write_snapshot(rows.withColumn("species", F.lit("old")), root, "20240201_120000")
    snapshots.write_snapshot(rows, root, "20240301_000000")
    latest = snapshots.read_latest_snapshot(spark, root)
    return latest.groupBy("run_ts", "species").agg(F.count("*").alias("n_rows"))


@query(
    "versioned_output",
    on_grid("SELECT CAST(2 AS INTEGER) AS version, Detector, Night, CallsPerNight FROM plain"),
)
def _(spark, sf_dir):
    root = scratch_path(spark, "versions")
    rows = plain_grid(spark, sf_dir).drop("RecordingHours")
    snapshots.write_versioned(rows.withColumn("CallsPerNight", F.lit(-1)), root)
    latest = snapshots.write_versioned(rows, root)
    return snapshots.read_version(spark, root, latest)


@query(
    "read_edited_template",
    on_grid("""
    SELECT Detector, Night, CAST(CallsPerNight AS DOUBLE) AS CallsPerNight,
      CASE WHEN extract(day FROM Night) % 2 = 0 THEN strftime(Night, '%m/%d/%Y') || ' 18:00' END AS StartDateTime,
      CASE WHEN extract(day FROM Night) % 3 <> 0 THEN RecordingHours END AS RecordingHours FROM plain"""),
)
def _(spark, sf_dir):
    day = F.dayofmonth("Night")
    edited = plain_grid(spark, sf_dir).select(
        "Detector",
        F.when(day % 2 == 0, F.date_format("Night", "M/d/yyyy"))
        .otherwise(F.col("Night").cast("string")).alias("Night"),
        F.col("CallsPerNight").cast("string").alias("CallsPerNight"),
        F.when(day % 2 == 0, F.concat(F.date_format("Night", "MM/dd/yyyy"), F.lit(" 18:00")))
        .otherwise("  ").alias("StartDateTime"),
        F.when(day % 3 == 0, "=(VALUE(E2)-VALUE(D2))*24")
        .otherwise(F.col("RecordingHours").cast("string")).alias("RecordingHours"),
    )
    path = scratch_path(spark, "edited")
    edited.write.option("header", True).csv(path)
    return templates.read_edited_template(spark, path)


@query(
    "write_summary_tables",
    on_grid(_VARIANCE + " UNPIVOT vc ON COLUMNS(*) INTO NAME component VALUE value"),
)
def _(spark, sf_dir):
    root = scratch_path(spark, "summaries")
    cpn = final_grid(spark, sf_dir)
    tables = {
        "variance_components": summaries.variance_components(cpn),
        "study_summary": summaries.study_summary(cpn),
    }
    results.write_summary_tables(tables, root, fmt="parquet")
    return spark.read.parquet(f"{root}/variance_components")


@query(
    "release_tables",
    on_grid("""
    SELECT 'calls_per_night' AS table_name, COUNT(*) AS n_rows FROM cpn UNION ALL
    SELECT 'master', COUNT(*) FROM master UNION ALL
    SELECT 'summary/detector_summary', COUNT(DISTINCT Detector) FROM cpn UNION ALL
    SELECT 'summary/hourly_summary', COUNT(DISTINCT Hour_local) FROM master"""),
)
def _(spark, sf_dir):
    root = scratch_path(spark, "release")
    cpn, rows = final_grid(spark, sf_dir), master(spark, sf_dir)
    tables = {
        "detector_summary": summaries.detector_activity_summary(cpn),
        "hourly_summary": summaries.hourly_activity(rows),
    }
    written = results.write_release(cpn, rows, tables, root)
    counts = [
        spark.read.parquet(f"{root}/{name}").agg(
            F.lit(name).alias("table_name"), F.count("*").alias("n_rows")
        )
        for name in written
    ]
    return exports.bind_rows(counts)


# Raw rows


@query(
    "filter_positive_n",
    on_raw("SELECT event_id, n FROM raw WHERE TRY_CAST(n AS DOUBLE) > 0"),
)
def _(spark, sf_dir):
    return ingest.filter_positive_n(raw_exports(spark, sf_dir)).select("event_id", "n")


@query("derive_detector_id", on_raw("SELECT event_id, substr(in_file, 1, 16) AS detector_id FROM raw"))
def _(spark, sf_dir):
    return ingest.derive_detector_id(raw_exports(spark, sf_dir)).select("event_id", "detector_id")


@query("detect_schema_version", on_raw("SELECT event_id, auto_id, schema_version FROM vraw"))
def _(spark, sf_dir):
    return versioned_raw(spark, sf_dir).select("event_id", "auto_id", "schema_version")


_SPLIT_SQL = """,
spl AS (
  SELECT *, CASE WHEN listed <> '' THEN
    string_split_regex(regexp_replace(listed, ';\\s*$', ''), ';\\s*') END AS items FROM (
    SELECT *, COALESCE(alternates, alternate_1) AS listed FROM vraw))"""


@query(
    "split_alternates",
    on_raw(_SPLIT_SQL + """
    SELECT event_id, items[1] AS alternate_1, items[2] AS alternate_2, items[3] AS alternate_3
    FROM spl WHERE schema_version = 'v1_legacy_single_column'"""),
)
def _(spark, sf_dir):
    legacy = versioned_raw(spark, sf_dir).where("schema_version = 'v1_legacy_single_column'")
    return schema.split_alternates(legacy).select("event_id", *schema.ALTERNATES)


_RECODE = (
    "CASE {0} WHEN 'EPFU' THEN 'EPTFUS' WHEN 'MYLU' THEN 'MYOLUC' WHEN 'LANO' THEN 'LASNOC'"
    " WHEN 'LACI' THEN 'LASCIN' WHEN 'LABO' THEN 'LASBOR' WHEN 'TABR' THEN 'TADBRA' WHEN 'MYSE' THEN 'MYOSEP'"
    " ELSE {0} END"
)


@query(
    "recode_species_4_to_6",
    on_raw(f"""
    SELECT event_id, {_RECODE.format('auto_id')} AS auto_id, {_RECODE.format('alternate_1')} AS alternate_1,
      {_RECODE.format('alternate_2')} AS alternate_2 FROM raw"""),
)
def _(spark, sf_dir):
    recoded = schema.recode_species_columns(raw_exports(spark, sf_dir))
    return recoded.select("event_id", "auto_id", "alternate_1", "alternate_2")


@query("add_missing_alternate3", on_raw("SELECT event_id, alternate_2, CAST(NULL AS VARCHAR) AS alternate_3 FROM raw"))
def _(spark, sf_dir):
    return schema.add_missing_alternate3(raw_exports(spark, sf_dir)).select(
        "event_id", "alternate_2", "alternate_3"
    )


def _unified(name: str, position: int) -> str:
    own = f"CASE WHEN schema_version LIKE 'v1%' THEN items[{position}] ELSE {name} END"
    return f"CASE WHEN schema_version LIKE 'v1%' OR schema_version LIKE 'v2%' THEN {_RECODE.format(f'({own})')} ELSE {own} END"


@query(
    "unify_schema",
    on_raw(_SPLIT_SQL + f"""
    SELECT event_id, CASE WHEN schema_version LIKE 'v1%' OR schema_version LIKE 'v2%'
        THEN {_RECODE.format('auto_id')} ELSE auto_id END AS auto_id,
      {_unified('alternate_1', 1)} AS alternate_1, {_unified('alternate_2', 2)} AS alternate_2,
      {_unified('CAST(NULL AS VARCHAR)', 3)} AS alternate_3, COALESCE(out_file_fs, out_file) AS out_file_fs FROM spl"""),
)
def _(spark, sf_dir):
    return schema.unify_schema(versioned_raw(spark, sf_dir)).select(
        "event_id", "auto_id", *schema.ALTERNATES, "out_file_fs"
    )


@query("harmonize_out_file", on_raw("SELECT event_id, COALESCE(out_file_fs, out_file) AS out_file_fs FROM raw"))
def _(spark, sf_dir):
    return schema.harmonize_out_file(raw_exports(spark, sf_dir)).select("event_id", "out_file_fs")


@query(
    "final_column_select",
    on_raw("""
    SELECT substr(in_file, 1, 16) AS Detector, auto_id, alternate_1, alternate_2, n, pulses, source_file, in_file,
      out_file_fs, event_id, kind, alternates, out_file FROM raw"""),
)
def _(spark, sf_dir):
    raw = raw_exports(spark, sf_dir).withColumn("Detector", F.substring("in_file", 1, 16))
    return schema.final_column_select(schema.enforce_types(raw))


@query("filter_noid", on_master("SELECT event_id, auto_id FROM det WHERE auto_id <> 'NoID'"))
def _(spark, sf_dir):
    return clean.filter_noid(detections(spark, sf_dir)).select("event_id", "auto_id")


@query("filter_zero_pulse", on_raw("SELECT event_id, pulses FROM raw WHERE CAST(pulses AS DOUBLE) > 0"))
def _(spark, sf_dir):
    return clean.filter_zero_pulse(raw_exports(spark, sf_dir)).select("event_id", "pulses")


@query("unified_species", on_master("SELECT event_id, species FROM allsp"))
def _(spark, sf_dir):
    from nightgrid.plans.phases import add_species

    return add_species(detections(spark, sf_dir)).select("event_id", "species")


@query("drop_unidentified", on_master("SELECT event_id, species FROM master"))
def _(spark, sf_dir):
    from nightgrid.plans.phases import add_species

    named = add_species(detections(spark, sf_dir))
    return clean.drop_unidentified(named).select("event_id", "species")


@query(
    "blank_to_null",
    on_raw("SELECT event_id, CASE WHEN trim(alternates) <> '' THEN alternates END AS alternates FROM raw"),
)
def _(spark, sf_dir):
    return clean.blank_to_null(raw_exports(spark, sf_dir), ["alternates"]).select(
        "event_id", "alternates"
    )


_LOCAL_SQL = """,
loc AS (
  SELECT *, CASE WHEN event_id % 97 <> 0 THEN
    CASE WHEN event_id % 5 = 0 THEN date_trunc('minute', ts) ELSE date_trunc('second', ts) END END AS utc FROM vraw)"""


@query(
    "to_local_time",
    on_raw(_LOCAL_SQL + """
    SELECT event_id, utc AS DateTime_UTC, utc - INTERVAL 6 HOUR AS DateTime_local,
      CAST(utc - INTERVAL 6 HOUR AS DATE) AS Date_local, strftime(utc - INTERVAL 6 HOUR, '%H:%M:%S') AS Time_local,
      CAST(extract(hour FROM utc - INTERVAL 6 HOUR) AS INTEGER) AS Hour_local FROM loc"""),
)
def _(spark, sf_dir):
    local = localize(raw_exports(spark, sf_dir), CONFIG.timezone)
    return local.select(
        "event_id", "DateTime_UTC", "DateTime_local", "Date_local", "Time_local", "Hour_local"
    )


@query(
    "prepare_master",
    on_raw(_SPLIT_SQL + f""",
    loc AS (
      SELECT *, CASE WHEN schema_version LIKE 'v1%' OR schema_version LIKE 'v2%'
          THEN {_RECODE.format('auto_id')} ELSE auto_id END AS code, substr(in_file, 1, 16) AS Detector,
        CASE WHEN event_id % 97 <> 0 THEN CASE WHEN event_id % 5 = 0 THEN date_trunc('minute', ts)
          ELSE date_trunc('second', ts) END - INTERVAL 6 HOUR END AS DateTime_local FROM spl
      WHERE TRY_CAST(n AS DOUBLE) > 0)
    SELECT Detector, DateTime_local, code AS auto_id, event_id, pulses, COALESCE(out_file_fs, out_file) AS out_file_fs
    FROM loc WHERE TRUE QUALIFY row_number() OVER (PARTITION BY Detector, DateTime_local, code ORDER BY
        CASE WHEN schema_version LIKE 'v1%' THEN 1 WHEN schema_version LIKE 'v2%' THEN 2 WHEN schema_version LIKE 'v3%' THEN 3
        ELSE 4 END, source_file, in_file, event_id) = 1
      AND code <> 'NoID' AND CAST(pulses AS DOUBLE) > 0"""),
)
def _(spark, sf_dir):
    raw = ingest.derive_detector_id(ingest.filter_positive_n(versioned_raw(spark, sf_dir)))
    # The file name and the record number stand for the reading order.
    order = F.struct("source_file", "in_file", "event_id")
    ready = prepare_master(raw.withColumn("_read_order", order), CONFIG)
    return ready.select("Detector", "DateTime_local", "auto_id", "event_id", "pulses", "out_file_fs")


@query(
    "row_audit",
    on_master(HOURLY_COPIES + f""",
    k AS (SELECT *, row_number() OVER (PARTITION BY Detector, DateTime_local, auto_id ORDER BY event_id) AS rn FROM copies
      WHERE event_id % 11 <> 0),
    c AS (SELECT (SELECT COUNT(*) FROM copies) AS total, (SELECT COUNT(*) FROM copies WHERE event_id % 11 = 0) AS inv,
      COUNT(*) FILTER (rn > 1) AS dup, COUNT(*) FILTER (rn = 1 AND auto_id = 'NoID') AS noid,
      COUNT(*) FILTER (rn = 1 AND auto_id <> 'NoID' AND pulses < 1) AS zero FROM k),
    s AS (
      SELECT 1 AS step, 'rows_removed' AS event_type, total AS b, inv AS r FROM c UNION ALL
      SELECT 2, 'duplicate', total - inv, dup FROM c UNION ALL
      SELECT 3, 'filter_noid', total - inv - dup, noid FROM c UNION ALL
      SELECT 4, 'filter_zero_pulses', total - inv - dup - noid, zero FROM c)
    SELECT CAST(step AS INTEGER) AS step, event_type, b AS rows_before, r AS n_removed, b - r AS rows_after,
      {pct('r', 'b', 2)} AS pct_removed FROM s"""),
)
def _(spark, sf_dir):
    raw = hourly_copies(spark, sf_dir).withColumns(
        {
            "n": F.when(F.col("event_id") % 11 == 0, "0").otherwise("5"),
            "pulses": F.floor("pulses").cast("string"),
        }
    )
    return row_audit(cleaning_counts(raw))


@query(
    "unparsed_times",
    on_raw("""
    SELECT COUNT(*) AS n_rows, COUNT(*) FILTER (event_id % 97 = 0) AS n_unparsed, CAST(0 AS BIGINT) AS n_without_text FROM raw"""),
)
def _(spark, sf_dir):
    return unparsed_times(localize(raw_exports(spark, sf_dir), CONFIG.timezone))
