"""Typed columns, literals and conversions between value types."""

from __future__ import annotations

import datetime as dt
import decimal
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.types import DECIMAL, INTEGERS, NUMERIC, SPARK, FilterError, V

#: Formats that text is read as a date by, in this order.
DATE_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S][XXX]", "yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSSSS][.SSSS][.SSS][.SS][.S][XXX]",
    "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "M/d/yyyy HH:mm:ss", "M/d/yyyy HH:mm", "M/d/yyyy",
)
_GUID = r"[0-9a-f]{32}"


@dataclass(frozen=True)
class Typed:
    col: Column
    kind: V
    const: object = None  # the value, if it is a literal
    is_const: bool = False


def literal(value: object, kind: V) -> Typed:
    if value is None:
        return Typed(F.lit(None).cast(SPARK[kind]), kind, None, True)
    if kind == V.DECIMAL:
        value = decimal.Decimal(value)
        scale = max(0, -value.as_tuple().exponent)
        return Typed(F.lit(str(value)).cast(T.DecimalType(min(38, max(len(value.as_tuple().digits), scale) + 1), min(scale, 37))), kind, value, True)
    if kind == V.DATETIME:
        return Typed(F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz"), kind, value, True)
    return Typed(F.lit(value).cast(SPARK[kind]), kind, value, True)


def const(t: Typed, what: str) -> object:
    """The value of an argument that must be a literal."""
    if not t.is_const:
        raise FilterError(f"{what} must be a literal")
    return t.const


def as_date(text: Column) -> Column:
    """Text read as a date, by the first format that fits; in UTC, without zone."""
    return F.coalesce(*[F.call_function("try_to_timestamp", F.trim(text), F.lit(f)).cast("timestamp_ntz") for f in DATE_FORMATS])


def as_guid(text: Column) -> Column:
    """Canonical text of a GUID, null if it is none: braces, hyphens and a urn prefix may be there or not."""
    bare = F.regexp_replace(F.lower(F.trim(text)), r"^urn:uuid:|[{}-]", "")
    return F.when(bare.rlike(f"^{_GUID}$"), F.regexp_replace(bare, r"^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5"))


def _text(t: Typed) -> Column:
    if t.kind == V.BOOLEAN:
        return F.when(t.col, F.lit("True")).when(~t.col, F.lit("False"))
    if t.kind == V.DATETIME:
        return F.date_format(t.col, "yyyy-MM-dd'T'HH:mm:ss.SS")
    if t.kind == V.DECIMAL:
        return F.regexp_replace(t.col.cast("string"), r"(\.[0-9]*?)0+$", "$1").substr(F.lit(1), F.lit(80)) if not t.is_const else F.lit(None if t.const is None else str(t.const))
    return t.col.cast("string")


def convert(t: Typed, to: V) -> Typed:
    """Null stays null; what can't be converted becomes null; pairs that never convert raise."""
    if t.kind == to:
        return t
    if t.is_const and t.const is None:
        return literal(None, to)
    c, spark = t.col, SPARK[to]
    if to == V.STRING:
        return Typed(_text(t), to)
    if t.kind in NUMERIC and to in NUMERIC:
        if to == V.BOOLEAN:
            return Typed(c != 0, to)
        if t.is_const and t.kind in (*INTEGERS, V.DECIMAL) and to in (V.INT64, V.DECIMAL, V.DOUBLE) and t.kind < to:
            return literal(float(t.const) if to == V.DOUBLE else t.const, to)
        if t.kind == V.BOOLEAN:
            return Typed(c.cast("int").cast(spark), to)
        return Typed(c.try_cast(spark), to)
    if t.kind == V.STRING:
        if to == V.BOOLEAN:
            return Typed(F.length(c) > 0, to)
        if to in INTEGERS:
            return Typed(F.trim(c).try_cast(DECIMAL).try_cast(spark), to)
        if to in (V.DECIMAL, V.DOUBLE):
            return Typed(F.trim(c).try_cast(spark), to)
        if to == V.GUID:
            return Typed(as_guid(c), to)
        if t.is_const:
            from ..plans.syntax import date

            return literal(date(t.const), to)
        return Typed(as_date(c), to)
    if t.kind == V.DATETIME and to in NUMERIC:
        seconds = F.unix_micros(c.cast("timestamp")) / 1e6
        return convert(Typed(seconds, V.DOUBLE), to)
    raise FilterError(f"{t.kind.name} can't become {to.name}")


def upper(t: Typed) -> Column:
    """For comparisons that ignore case; a literal without cased letters stays as it is."""
    if t.is_const and t.const is not None:
        return F.lit(str(t.const).upper())
    return F.upper(t.col)


def cased(value: object) -> bool:
    return value is None or str(value).upper() != str(value).lower()


def naive(d: dt.datetime) -> dt.datetime:
    return d.astimezone(dt.UTC).replace(tzinfo=None) if d.tzinfo else d
