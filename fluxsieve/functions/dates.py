"""Date functions on times without zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans.types import FilterError, V
from .base import Typed, const, convert

#: Names of time intervals.
INTERVALS = ("YEAR", "MONTH", "DAYOFYEAR", "DAY", "WEEK", "WEEKDAY", "HOUR", "MINUTE", "SECOND", "MILLISECOND")


def _interval(a: Typed) -> str:
    name = str(const(a, "an interval")).upper()
    if name not in INTERVALS:
        raise FilterError(f"no interval: {name}")
    return name


def _date(a: Typed) -> Column:
    if a.kind not in (V.DATETIME, V.STRING):
        raise FilterError(f"a date is needed, not {a.kind.name}")
    return convert(a, V.DATETIME).col.cast("timestamp_ntz")


def _micros(d: Column) -> Column:
    return F.unix_micros(d.cast("timestamp"))


def _shifted(d: Column, n: Column, unit: str) -> Column:
    return F.timestamp_add(unit, n, d)


def _date_add(args: list[Typed]) -> Typed:
    d, n, unit = _date(args[0]), convert(args[1], V.INT32).col, _interval(args[2])
    if unit == "WEEKDAY":
        # on to the next day n, Monday being 0
        return Typed(_shifted(d, F.pmod(n - F.weekday(d), F.lit(7)), "DAY"), V.DATETIME)
    if unit == "MILLISECOND":
        return Typed(_shifted(d, n, "MILLISECOND"), V.DATETIME)
    return Typed(_shifted(d, n, "DAY" if unit == "DAYOFYEAR" else unit), V.DATETIME)


def months_between(a: Column, b: Column) -> Column:
    """Complete months from a to b; a month that ends clipped at its last day is complete."""
    m = 12 * (F.year(b) - F.year(a)) + F.month(b) - F.month(a)
    there = _shifted(a, m, "MONTH")
    return F.when(b >= a, m - (b < there).cast("int")).otherwise(m + (b > there).cast("int"))


def _date_diff(args: list[Typed]) -> Typed:
    a, b, unit = _date(args[0]), _date(args[1]), _interval(args[2])
    if unit in ("YEAR", "MONTH"):
        m = months_between(a, b)
        return Typed(m if unit == "MONTH" else F.call_function("div", m, F.lit(12)).cast("int"), V.INT32)
    us = _micros(b) - _micros(a)
    if unit in ("DAY", "DAYOFYEAR", "WEEKDAY"):
        return Typed(F.floor(us / 86_400e6).cast("int"), V.INT32)
    if unit == "WEEK":
        return Typed(F.floor(F.floor(us / 86_400e6) / 7).cast("int"), V.INT32)
    if unit == "MILLISECOND":
        return Typed(F.floor(us / 1000), V.INT64)
    seconds = F.bround(us / 1e6, 0)
    return Typed((seconds if unit == "SECOND" else F.floor(seconds / (3600 if unit == "HOUR" else 60))).cast("int"), V.INT32)


def _date_part(args: list[Typed]) -> Typed:
    d, unit = _date(args[0]), _interval(args[1])
    part = {
        "YEAR": F.year, "MONTH": F.month, "DAYOFYEAR": F.dayofyear, "DAY": F.dayofmonth, "WEEK": F.weekofyear, "HOUR": F.hour, "MINUTE": F.minute, "SECOND": F.second,
        "WEEKDAY": lambda x: F.when(F.dayofweek(x) == 1, F.lit(8)).otherwise(F.dayofweek(x)),  # Monday is 2, Sunday 8
        "MILLISECOND": lambda x: F.floor(F.pmod(_micros(x), F.lit(1_000_000)) / 1000),
    }[unit]
    return Typed(part(d).cast("int"), V.INT32)


FUNCTIONS = {
    "DATEADD": (3, 3, _date_add),
    "DATEDIFF": (3, 3, _date_diff),
    "DATEPART": (2, 2, _date_part),
    "NOW": (0, 0, lambda args: Typed(F.localtimestamp(), V.DATETIME)),
    "UTCNOW": (0, 0, lambda args: Typed(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz"), V.DATETIME)),
}
