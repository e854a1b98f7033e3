"""Rounding, shares and number formats."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

# From here on a scaled double has no fraction left to round.
_NO_FRACTION = float(2**52)


def as_column(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


# v is rounded to a multiple of 1 / s.
_ROUND_SQL = """
CASE WHEN abs({v}) * {s} >= {limit} THEN CAST({v} AS DOUBLE)
     WHEN abs({v}) - floor(abs({v}) * {s}) / {s} < ceil(abs({v}) * {s}) / {s} - abs({v})
       OR (abs({v}) - floor(abs({v}) * {s}) / {s} = ceil(abs({v}) * {s}) / {s} - abs({v})
           AND floor(abs({v}) * {s}) % 2 = 0)
     THEN signum({v}) * (floor(abs({v}) * {s}) / {s})
     ELSE signum({v}) * (ceil(abs({v}) * {s}) / {s}) END"""


def round_nearest(value, digits: int = 0) -> Column:
    """Round to the nearer of the two neighbouring decimals, ties to even.

    Both neighbours are taken as doubles and the distances compared as doubles,
    so 0.15 rounds to 0.1 and 2.5 to 2.  This is how R 4 rounds; ``bround``
    differs where the text form of a double looks like a tie but is none.

    A column name is cheapest: the whole expression is one text for Spark to parse.
    """
    scale = f"{float(10**digits)!r}D"
    if isinstance(value, str):
        name = ".".join(f"`{part}`" for part in value.split("."))
        v = f"CAST({name} AS DOUBLE)"
        return F.expr(_ROUND_SQL.format(v=v, s=scale, limit=f"{_NO_FRACTION!r}D"))
    step = F.lit(float(10**digits))
    x = value.cast("double")
    size = F.abs(x)
    scaled = size * step
    below_units = F.floor(scaled)
    below, above = below_units / step, F.ceil(scaled) / step
    down, up = size - below, above - size
    keep_below = (down < up) | ((down == up) & (below_units % 2 == 0))
    nearest = F.signum(x) * F.when(keep_below, below).otherwise(above)
    return F.when(scaled >= _NO_FRACTION, x).otherwise(nearest)


def round_columns(df: DataFrame, digits: Mapping[str, int]) -> DataFrame:
    """Round the named columns in place."""
    return df.withColumns({c: round_nearest(c, d) for c, d in digits.items()})


def percent(part, whole, digits: int | None = 1) -> Column:
    """100 * part / whole, NULL when the whole is 0; rounded unless digits is None."""
    top = as_column(part).cast("double") * 100
    share = F.try_divide(top, as_column(whole).cast("double"))
    return share if digits is None else round_nearest(share, digits)


def share(part, whole) -> Column:
    """part / whole * 100 without rounding, in that order of operations."""
    ratio = F.try_divide(as_column(part).cast("double"), as_column(whole).cast("double"))
    return ratio * 100


def thousands(value) -> Column:
    """12345 -> '12,345'."""
    return F.format_number(as_column(value), 0)


def fixed(value, digits: int = 1) -> Column:
    """Fixed-point text with half-even rounding, as C printf does."""
    return F.format_string(f"%.{digits}f", round_nearest(value, digits))


def percent_text(value, digits: int = 1, already_percent: bool = False) -> Column:
    x = as_column(value)
    x = x if already_percent else x * 100
    return F.concat(fixed(x, digits), F.lit("%"))


def short_count(value) -> Column:
    """Counts below 1000 as they are, larger ones as '1.2k'."""
    x = as_column(value)
    return F.when(x < 1000, x.cast("string")).otherwise(
        F.concat(fixed(x / 1000, 1), F.lit("k"))
    )


def positive_number(text) -> Column:
    """Whether a text (or number) is a number above 0; never NULL.  NaN is not.

    A cast alone also takes type suffixes such as ``1d``.
    """
    text = as_column(text)
    written = F.trim(text.cast("string")).rlike(r"^(?i)[+]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?$|^(?i)[+]?inf(inity)?$")
    return F.coalesce(written & (text.try_cast("double") > 0), F.lit(False))
