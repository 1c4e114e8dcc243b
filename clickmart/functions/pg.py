"""Scalar helpers that give PostgreSQL results on Spark column expressions.

The models were written for PostgreSQL; where Spark's default differs (NULL
ordering, day-of-week numbering, interval fields, decimal rounding, ANSI
division by zero) the helper here spells out the PostgreSQL behaviour with
built-in functions only, so everything stays inside whole-stage codegen.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
MICROS_PER_DAY = 86_400 * MICROS_PER_SECOND



def hundred() -> Column:
    """The numeric literal ``100.0`` (DECIMAL(4,1)), not a double."""
    return F.lit(Decimal("100.0"))


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


EPOCH = "1970-01-01 00:00:00"


def utc_clock(instant: Column) -> Column:
    """The UTC wall clock of a TIMESTAMP as TIMESTAMP_NTZ, whatever the session's time zone."""
    seconds = (F.unix_micros(instant).cast("decimal(20,0)") / F.lit(MICROS_PER_SECOND)).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.lit(EPOCH).cast("timestamp_ntz") + F.make_dt_interval(zero, zero, zero, seconds)


def utc_instant(clock: Column) -> Column:
    """The TIMESTAMP at which UTC clocks show ``clock`` (a TIMESTAMP_NTZ)."""
    return F.timestamp_micros(micros_between(F.lit(EPOCH).cast("timestamp_ntz"), clock))


def as_of_literal(as_of: str | _dt.datetime | None = None) -> Column:
    """``CURRENT_TIMESTAMP`` made explicit: a zone-less timestamp literal.

    ``None`` means the UTC wall clock (constant within one query, like PostgreSQL).
    """
    if as_of is None:
        return utc_clock(F.current_timestamp())
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(as_of).cast("timestamp_ntz")


def nullif_zero(c: str | Column) -> Column:
    """``NULLIF(x, 0)``: required, Spark's ANSI mode raises on division by zero."""
    return F.nullif(col(c), F.lit(0))


def pct(numerator: str | Column, denominator: str | Column, places: int = 2) -> Column:
    """``ROUND(100.0 * a / NULLIF(b, 0), places)`` in exact decimal arithmetic
    with half-away-from-zero rounding, as a DOUBLE."""
    return F.round(hundred() * col(numerator) / nullif_zero(denominator), places).cast("double")


def ratio(numerator: str | Column, denominator: str | Column, places: int = 2) -> Column:
    """``ROUND(a / NULLIF(b, 0), places)`` over numerics, as a DOUBLE.

    Integer numerators are widened to an exact decimal first (PostgreSQL's
    ``::NUMERIC``) so the division never truncates.
    """
    num = col(numerator)
    return F.round(num.cast("decimal(38,10)") / nullif_zero(denominator), places).cast("double")


def money_ratio(numerator: str | Column, denominator: str | Column, places: int = 2) -> Column:
    """Decimal money divided by a count, rounded half up, as a DOUBLE."""
    return F.round(col(numerator) / nullif_zero(denominator), places).cast("double")


def pg_dow(ts: str | Column) -> Column:
    """``EXTRACT(DOW FROM ts)``: 0 = Sunday (Spark's ``dayofweek`` is 1-based)."""
    return (F.dayofweek(col(ts)) - 1).cast("bigint")


def pg_day_name(ts: str | Column) -> Column:
    """``TO_CHAR(ts, 'Day')``: English day name blank-padded to 9 characters."""
    return F.rpad(F.date_format(col(ts), "EEEE"), 9, " ")


def micros_between(start: str | Column, end: str | Column) -> Column:
    """Whole microseconds from ``start`` to ``end`` (BIGINT).

    Taken from the parts of the interval: ``timestamp_diff`` would read zone-less
    timestamps in the session's time zone, where hours can be skipped or repeated.
    """
    gap = col(end) - col(start)
    day, hour, minute, second = (F.extract(F.lit(part), gap) for part in ("DAY", "HOUR", "MINUTE", "SECOND"))
    minutes = (day.cast("bigint") * 24 + hour) * 60 + minute
    return minutes * (60 * MICROS_PER_SECOND) + (second * MICROS_PER_SECOND).cast("bigint")


def epoch_seconds_between(start: str | Column, end: str | Column) -> Column:
    """``EXTRACT(EPOCH FROM (end - start))`` with fractional seconds, as DOUBLE."""
    return micros_between(start, end).cast("double") / F.lit(float(MICROS_PER_SECOND))


def interval_days(start: str | Column, end: str | Column) -> Column:
    """``EXTRACT(DAY FROM (end - start))``: whole 24-hour periods, truncated
    toward zero.  Not ``datediff``, which counts calendar midnights."""
    return F.extract(F.lit("DAY"), col(end) - col(start)).cast("bigint")


def exact_avg(c: str | Column, cast_to: str | None = None) -> Column:
    """``AVG(x)`` as DOUBLE computed from an exact sum.

    Summing doubles depends on the order rows arrive in; an exact decimal (or
    integer) sum divided once by the count is reproducible on any cluster
    layout.  ``cast_to`` widens the input first (e.g. ``decimal(38,6)`` for
    seconds with microsecond precision).
    """
    x = col(c) if cast_to is None else col(c).cast(cast_to)
    return F.sum(x).cast("double") / F.nullif(F.count(x), F.lit(0)).cast("double")


def count_where(cond: Column) -> Column:
    """``COUNT(*) FILTER (WHERE cond)``: 0, never NULL."""
    return F.count_if(cond)


def sum_where(cond: Column, c: str | Column) -> Column:
    """``SUM(x) FILTER (WHERE cond)``: NULL, not 0, when no row matches."""
    return F.sum(F.when(cond, col(c)))
