"""Raw exports -> master -> effort template -> final grid and summaries.

The ``prepare_*`` functions only build plans.  ``run_*`` write each phase once and
go on from the files: later tables fan out from the master and the grid, and a
written table survives lost executors.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from nightgrid.config import StudyConfig
from nightgrid.functions.species import unified_species
from nightgrid.functions.times import (
    clock_or_null, clock_text, dashed, join_utc, parse_dashed, study_night, to_local,
)
from nightgrid.operators import audit, clean, edits, grid, mapping, summaries
from nightgrid.operators.chart_detector import activity_outliers
from nightgrid.operators.chart_quality import nights_by_detector
from nightgrid.operators.condense import condense
from nightgrid.operators.ingest import filter_positive_n
from nightgrid.operators.schema import enforce_types, final_column_select, unify_schema
from nightgrid.sources.exports import bind_rows, load_flat_dir, load_recursive_dir, union_sources
from nightgrid.sources.results import run_together, write_release, write_summary_tables
from nightgrid.sources.snapshots import read_latest_snapshot, read_master_csv, read_snapshot


def localize(df: DataFrame, timezone: str, date: str = "date", time: str = "time") -> DataFrame:
    """Five time columns from UTC date and time text.

    In steps, each on the column of the one before, so that nothing is parsed twice.
    """
    df = df.withColumns({"_day": dashed(date), "_clock": clock_or_null(time)})
    df = df.withColumn("_day", parse_dashed("_day", day_first=True))
    df = df.withColumn("DateTime_UTC", join_utc("_day", "_clock")).drop("_day", "_clock")
    df = df.withColumn("DateTime_local", to_local("DateTime_UTC", timezone))
    return df.withColumns(
        {
            "Date_local": F.to_date("DateTime_local"),
            "Time_local": clock_text("DateTime_local"),
            "Hour_local": F.hour("DateTime_local"),
        }
    )


def standardize(raw: DataFrame, config: StudyConfig) -> DataFrame:
    """United raw rows to the unified, named, localized table, before any cleaning."""
    unified = unify_schema(raw)
    names = config.detector_names
    table = mapping.names_table(raw.sparkSession, names) if names else None
    named = mapping.map_detectors(unified, table)
    return final_column_select(enforce_types(localize(named, config.timezone)))


def clean_master(df: DataFrame, config: StudyConfig) -> DataFrame:
    """Duplicates first, then the optional filters."""
    filters = config.filters
    df = clean.keep_first(df) if filters.remove_duplicates else df.drop("_read_order")
    if filters.remove_noid:
        df = clean.filter_noid(df)
    if filters.remove_zero_pulse:
        df = clean.filter_zero_pulse(df)
    return df


def prepare_master(raw: DataFrame, config: StudyConfig) -> DataFrame:
    return clean_master(standardize(raw, config), config)


def add_species(master: DataFrame) -> DataFrame:
    if "manual_id" not in master.columns:
        master = master.withColumn("manual_id", F.lit(None).cast("string"))
    return master.withColumn("species", unified_species("manual_id", "auto_id"))


def assign_nights(master: DataFrame, config: StudyConfig) -> DataFrame:
    """Species and night of each identified detection."""
    named = clean.drop_unidentified(add_species(master))
    night = study_night("DateTime_local", config.schedule.cutoff_hour)
    return named.withColumn("Night", night)


def prepare_template(
    master: DataFrame, config: StudyConfig, schedules: DataFrame | None = None
) -> DataFrame:
    if config.detector_specific_schedules and schedules is None:
        own = config.schedule.per_detector
        if not own:
            raise ValueError("detector-specific schedules need a table of schedules")
        rows = [(d, s, e) for d, (s, e) in own.items()]
        schedules = master.sparkSession.createDataFrame(
            rows, "Detector string, StartTime string, EndTime string"
        )
    return grid.build_template(
        master, config.start_date, config.end_date, config.schedule, schedules
    )


def summary_tables(cpn: DataFrame, master: DataFrame) -> dict[str, DataFrame]:
    """The six summaries; ``master`` may be condensed."""
    return {
        "detector_summary": summaries.detector_activity_summary(cpn),
        "study_summary": summaries.study_summary(cpn),
        "species_summary": summaries.species_by_detector(master),
        "species_accumulation": summaries.species_accumulation(master),
        "hourly_summary": summaries.hourly_activity(master),
        "variance_components": summaries.variance_components(cpn),
    }


def _found(load):
    """What ``load`` reads, or None where its folder does not exist."""
    try:
        return load()
    except Exception as error:  # noqa: BLE001 - a missing source must not stop the rest
        if not isinstance(error, FileNotFoundError) and "PATH_NOT_FOUND" not in str(error):
            raise
        return None


def load_sources(
    spark: SparkSession, local_dir: str, config: StudyConfig
) -> tuple[DataFrame, DataFrame | None]:
    """(rows of all sources, status of all files): local exports, then every external source.

    A source that cannot be found is left out.
    """
    found = {"local": _found(lambda: load_flat_dir(spark, local_dir, keep_invalid=True))}
    for i, root in enumerate(config.external_sources, 1):
        found[root] = _found(lambda root=root, i=i: load_recursive_dir(spark, root, source_rank=i, keep_invalid=True))
    rows = union_sources({kind: part.rows if part else None for kind, part in found.items()})
    files = [part.files.withColumn("source_kind", F.lit(kind)) for kind, part in found.items() if part]
    return rows, bind_rows(files)


def audit_tables(raw: DataFrame, files: DataFrame, config: StudyConfig) -> dict[str, DataFrame]:
    """What the preparation removed, could not read and could not name."""
    filters = config.filters
    valid = filter_positive_n(raw)
    rows = standardize(raw, config)
    counts = audit.cleaning_counts(
        rows, remove_duplicates=filters.remove_duplicates, remove_noid=filters.remove_noid,
        remove_zero_pulse=filters.remove_zero_pulse,
    )
    names = mapping.names_table(raw.sparkSession, config.detector_names)
    return {
        "row_audit": audit.row_audit(counts),
        "unparsed_times": audit.unparsed_times(localize(valid, config.timezone)),
        "unmapped": mapping.unmapped_count(valid, names),
        "files": files,
    }


def run_preparation(
    spark: SparkSession, local_dir: str, out: str, config: StudyConfig, run_ts: str
) -> DataFrame:
    """The master, with the audit of its making in ``audit/run_ts=.../``."""
    raw, files = load_sources(spark, local_dir, config)
    valid = filter_positive_n(raw) if "n" in raw.columns else raw
    master = read_snapshot(prepare_master(valid, config), f"{out}/master", run_ts)
    tables = audit_tables(raw, files, config)
    root = f"{out}/audit/run_ts={run_ts}"
    run_together([partial(table.write.parquet, f"{root}/{name}") for name, table in tables.items()])
    return master


def template_input(
    spark: SparkSession, out: str, master: DataFrame | None = None, manual_ids: str | None = None
) -> DataFrame:
    """The detections of phase two: the file with manual ids if there is one, else the
    table in memory, else the newest written master."""
    if manual_ids is not None:
        found = _found(lambda: read_master_csv(spark, manual_ids))
        if found is not None:
            return found
    return master if master is not None else read_latest_snapshot(spark, f"{out}/master").drop("run_ts")


def run_template(
    master: DataFrame, out: str, config: StudyConfig, run_ts: str,
    schedules: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Master with nights and the template.

    The template is written twice: as text for people, and unedited for the diff.
    """
    nights = read_snapshot(assign_nights(master, config), f"{out}/master_nights", run_ts)
    template = read_snapshot(prepare_template(nights, config, schedules), f"{out}/template", run_ts)
    template.write.option("header", True).csv(f"{out}/template_edit_this/run_ts={run_ts}")
    return nights, template


@dataclass(frozen=True)
class StudyResult:
    grid: DataFrame
    calls: DataFrame
    edit_diff: DataFrame
    edit_log: DataFrame
    summaries: dict[str, DataFrame]
    suspicious: DataFrame
    outliers: DataFrame
    detector_nights: DataFrame
    released: list[str]


def run_analysis(
    master: DataFrame, original: DataFrame, edited: DataFrame, out: str,
    config: StudyConfig, run_ts: str,
) -> StudyResult:
    """The final grid, its summaries and release, and the reports on edits, suspicious
    nights, outliers and detectors with few nights.  All are written, and read back from there.
    """
    diff = read_snapshot(edits.template_edit_diff(original, edited), f"{out}/template_diff", run_ts)
    final = grid.finalize_grid(
        edited, config.intended_hours, config.detector_specific_schedules
    )
    cpn = read_snapshot(final, f"{out}/calls_per_night", run_ts)
    master = clean.noid_handling(master, config.noid_handling)
    calls = read_snapshot(condense(master), f"{out}/hourly_counts", run_ts)
    tables = summary_tables(cpn, calls)
    write_summary_tables(tables, f"{out}/summaries/run_ts={run_ts}")
    released = write_release(cpn, master, tables, f"{out}/release/run_ts={run_ts}")
    reports = {
        "edit_log": edits.edit_log(diff),
        "suspicious_nights": grid.suspicious_calls(cpn),
        "activity_outliers": activity_outliers(cpn, config.outlier_percentile),
        "detector_nights": nights_by_detector(cpn, config.nights_threshold),
    }
    log, suspicious, outliers, detector_nights = run_together([
        partial(read_snapshot, table, f"{out}/reports/{name}", run_ts) for name, table in reports.items()
    ])
    return StudyResult(cpn, calls, diff, log, tables, suspicious, outliers, detector_nights, released)
