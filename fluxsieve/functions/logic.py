"""Choice, conversion and tests of kind."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans.types import NUMERIC, FilterError, V, unified
from .base import Typed, as_date, as_guid, const, convert

#: Names of conversion targets beside the value types' own.
ALIASES = {
    "SINGLE": V.DOUBLE, "FLOAT": V.DOUBLE, "FLOAT32": V.DOUBLE, "FLOAT64": V.DOUBLE, "BOOL": V.BOOLEAN, "INT": V.INT64, "INT8": V.INT64, "INT16": V.INT64,
    "UINT": V.INT64, "UINT8": V.INT64, "UINT16": V.INT64, "UINT32": V.INT64, "UINT64": V.INT64, "DATE": V.DATETIME, "TIME": V.DATETIME, "UUID": V.GUID,
}


def target(name: object) -> V:
    key = str(name).strip().upper().removeprefix("SYSTEM.")
    if key in V.__members__:
        return V[key]
    if key in ALIASES:
        return ALIASES[key]
    raise FilterError(f"no type to convert to: {name}")


def _common(args: list[Typed]) -> V:
    """The type of branches; a bare NULL takes that of the others."""
    return unified([a.kind for a in args if not (a.is_const and a.const is None)] or [V.STRING])


def _coalesce(args: list[Typed]) -> Typed:
    kind = _common(args)
    return Typed(F.coalesce(*[convert(a, kind).col for a in args]), kind)


def _iif(args: list[Typed]) -> Typed:
    test = args[0]
    if test.is_const and test.const is None:
        test = convert(test, V.BOOLEAN)
    if test.kind != V.BOOLEAN:
        raise FilterError("IIf needs a BOOLEAN test")
    kind = _common(args[1:])
    a, b = (convert(x, kind).col for x in args[1:])
    return Typed(F.when(F.coalesce(test.col, F.lit(False)), a).otherwise(b), kind)


def _is_null(args: list[Typed]) -> Typed:
    if args[1].is_const and args[1].const is None:
        raise FilterError("IsNull needs a default that isn't null")
    return _coalesce(args)


def _kind_test(by_kind: tuple[V, ...], text: object) -> object:
    def build(args: list[Typed]) -> Typed:
        a = args[0]
        if a.kind == V.STRING:
            return Typed(F.coalesce(text(a.col), F.lit(False)), V.BOOLEAN)
        return Typed(a.col.isNotNull() if a.kind in by_kind else F.lit(False), V.BOOLEAN)

    return build


def _integer_text(c: Column) -> Column:
    return c.rlike(r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$") | c.rlike(r"^\s*[+-]?0[xX][0-9A-Fa-f]+\s*$")


def _number_text(c: Column) -> Column:
    return c.rlike(r"^\s*[+-]?(([0-9]+(_[0-9]+)*)(\.([0-9]+(_[0-9]+)*)?)?|\.[0-9]+(_[0-9]+)*)([eE][+-]?[0-9]+)?\s*$") | F.lower(F.trim(c)).rlike(r"^[+-]?(nan|inf|infinity)$")


FUNCTIONS = {
    "COALESCE": (2, 99, _coalesce),
    "IIF": (3, 3, _iif),
    "ISNULL": (2, 2, _is_null),
    "CONVERT": (2, 2, lambda args: convert(args[0], target(const(args[1], "the type of Convert")))),
    "ISDATE": (1, 1, _kind_test((V.DATETIME,), lambda c: as_date(c).isNotNull())),
    "ISINTEGER": (1, 1, _kind_test((V.BOOLEAN, V.INT32, V.INT64), _integer_text)),
    "ISGUID": (1, 1, _kind_test((V.GUID,), lambda c: as_guid(c).isNotNull())),
    "ISNUMERIC": (1, 1, _kind_test(NUMERIC, _number_text)),
}
