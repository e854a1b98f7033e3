"""Date, time and time-zone expressions.

Wall-clock values are TIMESTAMP_NTZ throughout, so nothing here depends on the
session time zone.  Parsing goes through ``try_cast`` on normalised text: unlike
pattern parsing it raises no exception for a row that does not match, which is
what costs time when a column mixes formats.
"""

from __future__ import annotations

import functools
import zoneinfo

from pyspark.sql import Column, SparkSession, functions as F

from nightgrid.constants import DATE_PATTERNS
from nightgrid.functions.numbers import as_column

_CLOCK = r"^\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?$"
_MONTH_FIRST = (
    r"^\s*(\d{1,2})/(\d{1,2})/(\d{4})\s+(\d{1,2}:\d{1,2}(?::\d{1,2})?)\s*(?:[AaPp][Mm])?\s*$"
)
_UTC_NAMES = {"UTC", "Etc/UTC", "Z", "GMT", "Etc/GMT"}


def dashed(value) -> Column:
    """Date text with '-' for the separators '/' and '.'."""
    text = F.trim(as_column(value))
    return F.replace(F.replace(text, F.lit("/"), F.lit("-")), F.lit("."), F.lit("-"))


_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"


def _full_year(two: Column) -> Column:
    """Two digits to a year: 00-68 are of this century, 69-99 of the last."""
    return F.concat(F.when(two.cast("int") < 69, "20").otherwise("19"), two)


def _month_number(name: Column) -> Column:
    place = F.instr(F.lit(_MONTHS), name)
    return F.when(place % 3 == 1, F.lpad((F.floor(place / 3) + 1).cast("string"), 2, "0"))


def other_date(value) -> Column:
    """The rarer forms: compact digits, years of two digits, names of months; else NULL.

    Orders are tried as year-month-day, month-day-year, day-month-year.  This is for
    rows that the plain forms do not fit, so it may use regular expressions.
    """
    text = F.lower(F.regexp_replace(F.trim(as_column(value)), r"[\s,._/-]+", "-"))
    dash = F.lit("-")

    def taken(pattern: str, year: int, month: int, day: int) -> Column:
        part = [None, *[F.regexp_extract(text, pattern, i) for i in (1, 2, 3)]]
        y, m = part[year], part[month]
        y = F.when(F.length(y) == 2, _full_year(y)).otherwise(y)
        m = F.when(m.rlike("^[0-9]+$"), m).otherwise(_month_number(F.substring(m, 1, 3)))
        return F.when(text.rlike(pattern), F.concat(y, dash, m, dash, part[day])).try_cast("date")

    name, end = "([a-z]{3})[a-z]*", "(?:[-t].*)?$"
    return F.coalesce(
        taken(r"^(\d{4})(\d{2})(\d{2})(?:[-t].*)?$", 1, 2, 3),
        taken(r"^(\d{2})(\d{2})(\d{2})(?:[-t].*)?$", 1, 2, 3),
        taken(rf"^(\d{{4}})-?{name}-?(\d{{1,2}}){end}", 1, 2, 3),
        taken(rf"^{name}-?(\d{{1,2}})(?:st|nd|rd|th)?-(\d{{4}}|\d{{2}}){end}", 3, 1, 2),
        taken(rf"^(\d{{1,2}})(?:st|nd|rd|th)?-?{name}-?(\d{{4}}|\d{{2}}){end}", 3, 2, 1),
        taken(r"^(\d{2})-(\d{1,2})-(\d{1,2})$", 1, 2, 3),
        *[taken(r"^(\d{1,2})-(\d{1,2})-(\d{2})$", *order) for order in ((3, 1, 2), (3, 2, 1))],
    )


def parse_dashed(value, day_first: bool = False) -> Column:
    """``parse_date`` of text that ``dashed`` has prepared.

    The text is used many times here, so give it as a column of its own when it
    comes from a large table.
    """
    text, dash = as_column(value), F.lit("-")
    two = F.substring_index(text, "-", 2)
    first, second = F.substring_index(text, "-", 1), F.substring_index(two, "-", -1)
    rest = F.substring_index(text, "-", -1)
    year = F.substring(rest, 1, 4)
    three_parts = F.concat(two, dash, rest) == text
    ends = (F.length(rest) == 4) | F.substring(rest, 5, 1).isin(" ", "T")
    year_last = three_parts & ends
    candidates = [
        F.when((F.substring(text, 5, 1) == "-") & (two != text), text).try_cast("date"),
        F.when(year_last, F.concat(year, dash, first, dash, second)).try_cast("date"),
    ]
    if day_first:
        candidates.append(
            F.when(year_last, F.concat(year, dash, second, dash, first)).try_cast("date")
        )
    return F.coalesce(*candidates, other_date(text))


def parse_date(value, day_first: bool = False) -> Column:
    """ISO, then month-day-year, then (if asked) day-month-year, then ``other_date``.

    '-', '/' and '.' are accepted as separators and a time of day after the date
    is ignored.  The plain forms need no regular expressions: they run on every detection.
    """
    return parse_dashed(dashed(value), day_first)


def clock_or_null(value) -> Column:
    """'H:M' or 'H:M:S' text, without a fraction; NULL for anything with a zone or half.

    Text without colons is tried in the forms of ``_other_clock``.
    """
    text = F.substring_index(F.trim(as_column(value)), ".", 1)
    digit_last = F.right(text, F.lit(1)).between("0", "9")
    plain = text.contains(":") & ~text.contains("+") & ~text.contains("-") & digit_last
    return F.when(plain, text).when(~text.contains(":"), _other_clock(text))


def _other_clock(text: Column) -> Column:
    """'HHMMSS', 'HHMM', 'H-M-S' and 'H-M' (also with blanks) as 'H:M[:S]'; else NULL."""
    parted, packed = r"^(\d{1,2})[-_ ](\d{1,2})(?:[-_ ](\d{1,2}))?$", r"^(\d{2})(\d{2})(\d{2})?$"

    def joined(pattern: str) -> Column:
        parts = [F.regexp_extract(text, pattern, i) for i in (1, 2, 3)]
        return F.concat_ws(":", parts[0], parts[1], F.nullif(parts[2], F.lit("")))

    return F.when(text.rlike(packed), joined(packed)).when(text.rlike(parted), joined(parted))


def join_utc(day, clock) -> Column:
    return F.concat(as_column(day).cast("string"), F.lit(" "), as_column(clock)).try_cast(
        "timestamp_ntz"
    )


def parse_utc(date_text, time_text) -> Column:
    """Combine date and time text into one wall-clock timestamp (assumed UTC)."""
    return join_utc(parse_date(date_text, day_first=True), clock_or_null(time_text))


def to_local(utc, timezone: str) -> Column:
    """UTC wall clock to the wall clock of a zone.

    ``convert_timezone`` looks both zones up for every row.  In a UTC session the
    same comes from ``from_utc_timestamp``, which looks the zone up once.
    """
    require_timezone(timezone)
    session = SparkSession.getActiveSession()
    if session and session.conf.get("spark.sql.session.timeZone") in _UTC_NAMES:
        moment = as_column(utc).cast("timestamp")
        return F.from_utc_timestamp(moment, timezone).cast("timestamp_ntz")
    return F.convert_timezone(F.lit("UTC"), F.lit(timezone), as_column(utc))


def _digits(timestamp) -> Column:
    """'YYYY-MM-DD HH:MM:SS'.  Unlike ``date_format`` this needs no time zone."""
    return as_column(timestamp).cast("timestamp_ntz").cast("string")


def _date_digits(text: Column) -> Column:
    slash = F.lit("/")
    return F.concat(
        F.substring(text, 6, 2), slash, F.substring(text, 9, 2), slash, F.substring(text, 1, 4)
    )


def clock_text(timestamp) -> Column:
    return F.substring(_digits(timestamp), 12, 8)


def hour_floor(timestamp) -> Column:
    moment = as_column(timestamp)
    return F.timestamp_add("HOUR", F.hour(moment), F.to_date(moment).cast("timestamp_ntz"))


def study_night(local_time, cutoff_hour: int = 18) -> Column:
    """Date of the evening a detection belongs to: before the cutoff, the day before."""
    moment = as_column(local_time)
    day = F.to_date(moment)
    return F.when(F.hour(moment) < cutoff_hour, F.date_sub(day, 1)).otherwise(day)


def parse_month_first(value) -> Column:
    """'10/4/2025 6:05[:09] [PM]' -> timestamp; text without '/' gives NULL.

    Hours of 13 and more are taken as they are, even before a PM.
    """
    text = as_column(value)
    ordered = F.regexp_replace(text, _MONTH_FIRST, "$3-$1-$2 $4")
    moment = F.when(text.contains("/"), ordered).try_cast("timestamp_ntz")
    half = F.upper(F.right(F.rtrim(text), F.lit(2)))
    hour = F.hour(moment)
    twelve = F.expr("INTERVAL 12 HOURS")
    return (
        F.when((half == "PM") & (hour < 12), moment + twelve)
        .when((half == "AM") & (hour == 12), moment - twelve)
        .otherwise(moment)
    )


def clock_of(value) -> Column:
    """Time of day of a month-first datetime text."""
    return clock_text(parse_month_first(value))


def clock_seconds(value) -> Column:
    """'HH:MM:SS' -> seconds after midnight, NULL when it is not a clock text."""
    parts = F.split(F.trim(as_column(value)), ":")
    pieces = [F.get(parts, i).try_cast("int") for i in range(3)]
    ok = F.trim(as_column(value)).rlike(_CLOCK)
    return F.when(
        ok, pieces[0] * 3600 + pieces[1] * 60 + F.coalesce(pieces[2], F.lit(0))
    )


def seconds_between(start, end) -> Column:
    return F.timestamp_diff("SECOND", as_column(start), as_column(end))


def recording_hours(start_text, end_text) -> Column:
    """Hours from start to end.

    Datetime texts (with '/') are subtracted; clock texts wrap over midnight.
    Each side is parsed on its own.  NULL when either side is missing.
    """
    start, end = as_column(start_text), as_column(end_text)
    dated = (
        seconds_between(parse_month_first(start), parse_month_first(end)).cast("double") / 3600
    )
    begin, finish = clock_seconds(start), clock_seconds(end)
    length = finish - begin
    wrapped = F.when(length < 0, length + 86400).otherwise(length)
    clocked = wrapped.cast("double") / 3600
    return F.when(start.contains("/"), dated).otherwise(clocked)


def schedule_texts(night, start_clock, end_clock) -> tuple[Column, Column]:
    """Start and end of a night's schedule as 'MM/DD/YYYY hh:mm:ss AM'."""
    night, start, end = as_column(night), as_column(start_clock), as_column(end_clock)
    last_day = F.when(end < start, F.date_add(night, 1)).otherwise(night)

    def stamp(day, clock):
        joined = F.concat(day.cast("string"), F.lit(" "), clock)
        moment = joined.try_cast("timestamp_ntz")
        text, hour = _digits(moment), F.hour(moment)
        twelve = F.lpad(((hour + 11) % 12 + 1).cast("string"), 2, "0")
        half = F.when(hour < 12, " AM").otherwise(" PM")
        return F.concat(_date_digits(text), F.lit(" "), twelve, F.substring(text, 14, 6), half)

    return stamp(night, start), F.when(start.isNotNull(), stamp(last_day, end))


def export_text(timestamp) -> Column:
    text = _digits(timestamp)
    return F.concat(_date_digits(text), F.lit(" "), F.substring(text, 12, 8))


def log_text(timestamp) -> Column:
    text = _digits(timestamp)
    shown = F.concat(_date_digits(text), F.lit(" "), F.substring(text, 12, 5))
    return F.coalesce(shown, F.lit("<blank>"))


def week_floor(day, week_start: str = "sunday") -> Column:
    day = as_column(day)
    if week_start == "sunday":
        return F.date_sub(day, F.dayofweek(day) - 1)
    if week_start == "monday":
        return F.date_sub(day, F.weekday(day))
    raise ValueError(f"week_start must be 'sunday' or 'monday', not {week_start!r}")


def month_floor(day) -> Column:
    return F.trunc(as_column(day), "month")


def iso_week(day) -> Column:
    return F.weekofyear(as_column(day))


def bin_date(day, time_bin: str) -> Column:
    """Floor a night to the bin of a chart."""
    if time_bin == "night":
        return as_column(day)
    if time_bin == "week":
        return week_floor(day)
    if time_bin == "month":
        return month_floor(day)
    raise ValueError(f"time_bin must be night, week or month, not {time_bin!r}")


def matching_date_patterns(value) -> Column:
    """Names of all date patterns a text matches."""
    text = as_column(value)
    names = [F.when(text.rlike(p), F.lit(name)) for name, p in DATE_PATTERNS.items()]
    return F.array_compact(F.array(*names))


def is_clock_text(value) -> Column:
    return F.coalesce(as_column(value).rlike(r"^\d{2}:\d{2}:\d{2}$"), F.lit(False))


@functools.cache
def _timezone_names() -> frozenset[str]:
    return frozenset(zoneinfo.available_timezones())


def is_valid_timezone(name: str) -> bool:
    return name in _timezone_names()


def require_timezone(name: str) -> None:
    if not is_valid_timezone(name):
        raise ValueError(f"unknown time zone: {name!r}")


def is_known_timezone(value) -> Column:
    """Row-wise form of ``is_valid_timezone``."""
    return F.coalesce(as_column(value).isin(sorted(_timezone_names())), F.lit(False))
