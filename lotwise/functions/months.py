"""Months as yyyy-MM labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lotwise.functions.clean import col


def year_month(date: Column | str) -> Column:
    return F.date_format(col(date), "yyyy-MM")


def months_between(first: Column | str, last: Column | str) -> Column:
    """Every month label from the first to the last date, both included; none if missing."""
    steps = F.sequence(F.trunc(col(first), "MM"), F.trunc(col(last), "MM"), F.expr("interval 1 month"))
    return F.transform(steps, year_month)


def month_at(first_month: str, index: int) -> str:
    """The label a number of months after another one: turns slider positions into labels."""
    year, month = (int(part) for part in first_month.split("-"))
    total = year * 12 + month - 1 + index
    return f"{total // 12:04d}-{total % 12 + 1:02d}"
