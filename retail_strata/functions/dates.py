"""Run dates and run stamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_folder(when: Column) -> Column:
    """``20250207`` for a date or timestamp column."""
    return F.date_format(when, "yyyyMMdd")


def run_stamp(when: Column) -> Column:
    """``20250207_101500`` for a timestamp column."""
    return F.date_format(when, "yyyyMMdd_HHmmss")


def run_date_column(text: Column) -> Column:
    """Date of a ``yyyy-MM-dd`` string column; NULL where it is not one."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")


def parse_run_date(run_date: str | dt.date) -> dt.date:
    """Run-date parameter as a date; a string must read ``yyyy-MM-dd``."""
    if isinstance(run_date, dt.datetime):
        return run_date.date()
    if isinstance(run_date, dt.date):
        return run_date
    return dt.datetime.strptime(run_date, "%Y-%m-%d").date()
