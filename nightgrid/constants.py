"""Fixed values that results depend on."""

# Four-letter species codes and their six-letter form.
SPECIES_CODES_4_TO_6 = {
    "MYLU": "MYOLUC", "MYSE": "MYOSEP", "MYSO": "MYOSOD", "MYVO": "MYOVOL",
    "MYCA": "MYOCAL", "MYCI": "MYOCIL", "MYEV": "MYOEVO", "MYTH": "MYOTHY",
    "MYYU": "MYOYUM", "MYGR": "MYOGRI", "MYLE": "MYOLEI", "MYKE": "MYOKEE",
    "MYAU": "MYOAUS", "MYAR": "MYOAUR", "MYOC": "MYOOCC", "MYVE": "MYOVEL",
    "LANO": "LASNOC", "LABO": "LASBOR", "LACI": "LASCIN", "LACS": "LACISE",
    "LAEG": "LASEGA", "LAFR": "LASFRA", "LAIN": "LASINT", "LAMI": "LASMIN",
    "LASE": "LASSEM", "LAXA": "LASXAN", "EPFU": "EPTFUS", "PESU": "PERSUB",
    "NYHU": "NYCHUM", "COTO": "CORTOW", "CORA": "CORRAF", "ANPA": "ANTPAL",
    "TABR": "TADBRA", "MACA": "MACCAL", "EUMA": "EUDMAC", "EUFL": "EUMFLO",
    "EUPE": "EUMPER", "EUUN": "EUMUND", "IDPH": "IDIPHY",
    "UNKN": "UNKNOWN", "NOID": "UNKNOWN",
}

# Row-level schema versions of raw exports.
SCHEMA_V1 = "v1_legacy_single_column"
SCHEMA_V2 = "v2_transitional_4letter"
SCHEMA_V3 = "v3_modern_6letter"
SCHEMA_UNKNOWN = "unknown"

# Columns of the unified detection table, in output order.
MASTER_COLUMNS = (
    "Detector", "DateTime_local", "Date_local", "Time_local", "Hour_local",
    "auto_id", "match_ratio",
    "match_dist_1", "match_dist_2", "match_dist_3", "match_dist_4",
    "reject_class_1", "reject_class_2", "reject_class_3",
    "fc", "sc", "slope", "offset", "margin",
    "alternate_1", "alternate_2", "alternate_3",
    "manual_id",
    "n", "pulses", "dur", "frq_max", "frq_min", "frq_bw", "te",
    "pulse_max", "dur_pulse", "frq_max_pulse", "frq_min_pulse",
    "frq_bw_pulse", "frq_ctr_pulse", "frq_knee", "frq_ctr", "body", "toe",
    "calls", "files",
    "channel", "fmax", "fmin", "duration",
    "detector_id", "source_file", "folder", "in_file",
    "out_file_fs", "out_file_zc",
)

# Raw columns that never reach the unified table (any case).
DROPPED_COLUMNS = (
    "orgid", "userid", "review_orig", "review_userid",
    "inpathmd5", "outpathmd5fs", "outpathmd5zc",
    "date", "time", "hour", "date_12", "time_12", "hour_12",
)

# Required columns of each contract.
MASTER_REQUIRED = ("Detector", "DateTime_local", "auto_id")
GRID_REQUIRED = ("Detector", "Night", "CallsPerNight", "RecordingHours")

# One set of "unidentified" labels per use.
AUTO_NOID = "NoID"
INVALID_SPECIES_LABELS = ("", "NoID", "UNKNOWN")
CHART_UNIDENTIFIED = ("NoID", "UNKNOWN", "")
ACCUMULATION_EXCLUDED = ("NoID", "UNKNOWN", "NOISE", "")
UNIDENTIFIED_ANY_CASE = ("noid", "unknown")

# Texts and thresholds.
NAME_PLACEHOLDER = "ENTER_NAME_HERE"
NO_CALLS_WARNING = "No calls detected - confirm equipment status"
STATUS_LEVELS = ("Success", "Partial", "Fail")
DETECTOR_ID_LENGTH = 16
STATUS_TOLERANCE_HOURS = 0.5
MAX_PLAUSIBLE_CALLS = 10000
DEDUP_KEYS = ("Detector", "DateTime_local", "auto_id")

# Labels of the vertical study overview, in output order.
STUDY_METRIC_LABELS = {
    "n_detectors": "Number of Detectors",
    "n_detector_nights": "Total Detector-Nights",
    "study_start": "Study Start Date",
    "study_end": "Study End Date",
    "study_duration_days": "Study Duration (days)",
    "total_calls": "Total Bat Calls",
    "total_hours": "Total Recording Hours",
    "overall_mean_cph": "Mean Calls Per Hour",
    "overall_median_cph": "Median Calls Per Hour",
    "overall_cv_pct": "Coefficient of Variation (%)",
    "pct_success": "Nights with Full Recording (%)",
    "pct_partial": "Nights with Partial Recording (%)",
    "pct_fail": "Nights with No Recording (%)",
}

# Text patterns of the date format profile.  They overlap.
DATE_PATTERNS = {
    "YYYY-MM-DD": r"^\d{4}-\d{2}-\d{2}",
    "YYYY/MM/DD": r"^\d{4}/\d{2}/\d{2}",
    "MM-DD-YYYY": r"^\d{2}-\d{2}-\d{4}",
    "MM/DD/YYYY": r"^\d{2}/\d{2}/\d{4}",
    "DD-MM-YYYY": r"^\d{2}-\d{2}-\d{4}",
    "Other": r".*",
}

#: Nights that a study spans at most where its dates are taken from the data.
MAX_STUDY_NIGHTS = 36_600
