"""Reporting date windows relative to a report date, as built-in column math.

For a report date ``d``: the previous month runs from ``start_date`` (its first
day) to ``end_date`` (its last day); ``prev_date`` is the last day of the month
before that. Each also comes as a ``yyyyMMdd`` key for tables that store dates
as numbers-in-text.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The key format.
KEY_FORMAT = "yyyyMMdd"


def launch_date() -> _dt.date:
    """Today's date in UTC, computed once on the driver (never inside a plan)."""
    return _dt.datetime.now(_dt.timezone.utc).date()


def end_of_previous_month(d: Column) -> Column:
    return F.date_sub(F.trunc(d, "month"), 1)


def start_of_previous_month(d: Column) -> Column:
    return F.add_months(F.trunc(d, "month"), -1)


def end_of_month_before_previous(d: Column) -> Column:
    return F.date_sub(start_of_previous_month(d), 1)


def date_key(d: Column) -> Column:
    return F.date_format(d, KEY_FORMAT)


def month_window(df: DataFrame, report_date: str = "report_date") -> DataFrame:
    """Add ``end_date, start_date, prev_date`` and their ``*_key`` forms."""
    d = F.col(report_date).cast("date")
    return df.select(
        *df.columns,
        end_of_previous_month(d).alias("end_date"),
        start_of_previous_month(d).alias("start_date"),
        end_of_month_before_previous(d).alias("prev_date"),
        date_key(end_of_previous_month(d)).alias("end_key"),
        date_key(start_of_previous_month(d)).alias("start_key"),
        date_key(end_of_month_before_previous(d)).alias("prev_key"),
    )
