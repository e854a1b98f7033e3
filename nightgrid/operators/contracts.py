"""Data contracts.

``require_*`` return their input unchanged or raise.  Column and type checks look
at the schema only; row and NULL checks run one small aggregate.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from nightgrid import constants as K
from nightgrid.functions.numbers import percent
from nightgrid.functions.times import is_clock_text

NUMERIC = {"tinyint", "smallint", "int", "bigint", "float", "double"}


class ContractError(ValueError):
    """The data do not have the shape an operator needs."""


def missing_columns(df: DataFrame, columns: Iterable[str]) -> list[str]:
    return [c for c in columns if c not in df.columns]


def require_columns(df: DataFrame, columns: Sequence[str], hint: str = "") -> DataFrame:
    absent = missing_columns(df, columns)
    if absent:
        tail = f" (hint: run {hint})" if hint else ""
        raise ContractError(f"missing columns: {', '.join(absent)}{tail}")
    return df


def require_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """``types`` maps a column to a Spark type name or to 'numeric'."""
    require_columns(df, list(types))
    actual = dict(df.dtypes)
    for name, wanted in types.items():
        found = actual[name]
        numeric = found in NUMERIC or found.startswith("decimal")
        if not (numeric if wanted == "numeric" else found == wanted):
            raise ContractError(f"column {name} must be {wanted}, not {found}")
    return df


def require_rows(df: DataFrame, exactly: int | None = None) -> DataFrame:
    if exactly is None:
        if df.isEmpty():
            raise ContractError("no rows")
        return df
    found = df.count()
    if found != exactly:
        raise ContractError(f"expected {exactly} rows, found {found}")
    return df


def null_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, n_total, n_null, pct_null) for each column, in one scan."""
    require_columns(df, columns)
    counts = df.agg(
        F.count("*").alias("n_total"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    long = counts.unpivot("n_total", list(columns), "column_name", "n_null")
    return long.select(
        "column_name", "n_total", "n_null", percent("n_null", "n_total").alias("pct_null")
    )


def require_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    for row in null_report(df, columns).where("n_null > 0").collect():
        raise ContractError(
            f"column {row.column_name} holds {row.n_null} NULLs ({row.pct_null}% of {row.n_total})"
        )
    return df


def cpn_contract(df: DataFrame, status: bool = False, rate: bool = False) -> DataFrame:
    required = [*K.GRID_REQUIRED]
    types = {"Night": "date", "CallsPerNight": "numeric", "RecordingHours": "numeric"}
    if status:
        required.append("Status")
    if rate:
        required.append("CallsPerHour")
        types["CallsPerHour"] = "numeric"
    return require_types(require_columns(df, required), types)


def master_contract(df: DataFrame) -> DataFrame:
    return require_columns(df, K.MASTER_REQUIRED)


def require_date_range(start: str, end: str) -> None:
    if date.fromisoformat(end) < date.fromisoformat(start):
        raise ContractError(f"end date {end} is before start date {start}")


def time_format_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values per column that are not HH:MM:SS, with their row counts."""
    long = df.select(*columns).unpivot([], list(columns), "column_name", "value")
    bad = long.where(~is_clock_text("value"))
    return bad.groupBy("column_name", "value").agg(F.count("*").alias("n_rows"))


def date_order_violations(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.where(F.col(end) < F.col(start))
