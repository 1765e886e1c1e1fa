"""Column expressions for the warehouse's date arithmetic.

All are built-in Catalyst expressions (no UDFs), so they stay inside
whole-stage codegen.  Each mirrors one reference SQL function exactly,
including its edge cases.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference: age bands and their labels, the
# "open" SCD2 end date, the default first-run watermark.
AGE_BANDS = (("0-18", 18), ("19-65", 65))
AGE_BAND_ELSE = "65+"
OPEN_END_DATE = "9999-12-31"
DEFAULT_WATERMARK = "2000-01-01 00:00:00"
REFERENCE_CALENDAR = ("2000-01-01", "2101-01-01")
CALENDAR_EPOCH = "1000-01-01"  # day 1 of the calendar keys; no source date is earlier


def lit_date(d: str | _dt.date) -> Column:
    return F.lit(d if isinstance(d, _dt.date) else _dt.date.fromisoformat(str(d)))


def lit_ts(ts: str | _dt.datetime) -> Column:
    """Zone-less timestamp literal (``timestamp_ntz``), built from its text so
    the session time zone never shifts it."""
    if not isinstance(ts, _dt.datetime):
        ts = _dt.datetime.fromisoformat(str(ts))
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def weekday_mon1(d: Column) -> Column:
    """``WEEKDAY(d) + 1``: Monday = 1 … Sunday = 7 (not ``dayofweek``)."""
    return F.weekday(d) + 1


def completed_years(start: Column, end: Column) -> Column:
    """``TIMESTAMPDIFF(YEAR, start, end)`` on dates: whole years elapsed.

    A birthday on 29 February is reached on 1 March in common years.
    """
    behind = (F.month(end) < F.month(start)) | (
        (F.month(end) == F.month(start)) & (F.dayofmonth(end) < F.dayofmonth(start))
    )
    return F.year(end) - F.year(start) - F.when(behind, 1).otherwise(0)


def age_group(dob: Column, as_of: Column) -> Column:
    """Reference banding; a NULL birth date falls through to ``65+``."""
    age = completed_years(dob, as_of)
    expr = None
    for label, upper in AGE_BANDS:
        expr = F.when(age < upper, label) if expr is None else expr.when(age < upper, label)
    return expr.otherwise(AGE_BAND_ELSE)


def hours_between(start: Column, end: Column) -> Column:
    """``TIMESTAMPDIFF(HOUR, start, end)``: whole hours, truncated toward zero."""
    return F.timestamp_diff("HOUR", start, end).cast("int")


def date_key(d: Column, calendar_start: str | None = None, calendar_end: str | None = None) -> Column:
    """Calendar surrogate key of a date: its day number from ``CALENDAR_EPOCH``
    (1-based), so a calendar can grow at both ends without renumbering.  With
    bounds given, NULL outside them — the same value an inner/left join to
    ``dim_date`` on ``calendar_date`` would return."""
    day = d.cast("date")
    key = (F.datediff(day, lit_date(CALENDAR_EPOCH)) + 1).cast("long")
    if calendar_start is None or calendar_end is None:
        return key
    return F.when(day.between(lit_date(calendar_start), lit_date(calendar_end)), key)


def month_label(d: Column) -> Column:
    """``DATE_FORMAT(d, '%Y-%m')``."""
    return F.date_format(d, "yyyy-MM")


def epoch_day(d: Column) -> Column:
    return F.unix_date(d.cast("date"))
