"""Value types of expressions, and how types combine."""

from __future__ import annotations

import enum

from pyspark.sql import types as T


class FilterError(ValueError):
    """A statement that can't be parsed, bound or typed."""


class V(enum.IntEnum):
    """Value types; the numeric ones are in order of width."""

    BOOLEAN = 0
    INT32 = 1
    INT64 = 2
    DECIMAL = 3
    DOUBLE = 4
    STRING = 5
    GUID = 6
    DATETIME = 7


NUMERIC = (V.BOOLEAN, V.INT32, V.INT64, V.DECIMAL, V.DOUBLE)
INTEGERS = (V.INT32, V.INT64)
DECIMAL = T.DecimalType(38, 18)

SPARK: dict[V, T.DataType] = {
    V.BOOLEAN: T.BooleanType(), V.INT32: T.IntegerType(), V.INT64: T.LongType(), V.DECIMAL: DECIMAL,
    V.DOUBLE: T.DoubleType(), V.STRING: T.StringType(), V.GUID: T.StringType(), V.DATETIME: T.TimestampNTZType(),
}

#: Column types of a data set: XSD name, whether it is the extension type of a GUID, Spark type in storage, value
#: type when read, default of a present but empty element.
COLUMN_TYPES: dict[str, tuple[str, T.DataType, V, object]] = {
    "STRING": ("string", T.StringType(), V.STRING, ""),
    "BOOLEAN": ("boolean", T.BooleanType(), V.BOOLEAN, False),
    "DATETIME": ("dateTime", T.TimestampNTZType(), V.DATETIME, None),
    "SINGLE": ("float", T.FloatType(), V.DOUBLE, 0.0),
    "DOUBLE": ("double", T.DoubleType(), V.DOUBLE, 0.0),
    "DECIMAL": ("decimal", DECIMAL, V.DECIMAL, 0),
    "GUID": ("string", T.StringType(), V.GUID, "00000000-0000-0000-0000-000000000000"),
    "INT8": ("byte", T.ByteType(), V.INT32, 0),
    "INT16": ("short", T.ShortType(), V.INT32, 0),
    "INT32": ("int", T.IntegerType(), V.INT32, 0),
    "INT64": ("long", T.LongType(), V.INT64, 0),
    "UINT8": ("unsignedByte", T.ShortType(), V.INT32, 0),
    "UINT16": ("unsignedShort", T.IntegerType(), V.INT32, 0),
    "UINT32": ("unsignedInt", T.LongType(), V.INT64, 0),
    "UINT64": ("unsignedLong", T.DecimalType(20, 0), V.DOUBLE, 0),
}


def value_type(field: T.StructField) -> V:
    """The value type that a column widens to when it is read."""
    logical = (field.metadata or {}).get("logical")
    kind = field.dataType
    if logical == "guid":
        return V.GUID
    if isinstance(kind, T.BooleanType):
        return V.BOOLEAN
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return V.INT32
    if isinstance(kind, T.LongType):
        return V.INT64
    if isinstance(kind, T.DecimalType):
        return V.DOUBLE if kind.precision == 20 and kind.scale == 0 else V.DECIMAL
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return V.DOUBLE
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType, T.DateType)):
        return V.DATETIME
    if isinstance(kind, T.StringType):
        return V.STRING
    raise FilterError(f"column {field.name} has no value type: {kind.simpleString()}")


def arithmetic(op: str, a: V, b: V) -> V:
    """Result type of + - * / and %: the wider number; + with text is text; % is for integers and booleans."""
    if op == "+" and V.STRING in (a, b):
        return V.STRING
    if a not in NUMERIC or b not in NUMERIC:
        raise FilterError(f"{op} isn't defined for {a.name} and {b.name}")
    out = max(a, b)
    if op == "%" and out > V.INT64:
        raise FilterError(f"% isn't defined for {a.name} and {b.name}")
    if op in "*/%" and out == V.BOOLEAN:
        raise FilterError(f"{op} isn't defined for BOOLEAN")
    return out


def bitwise(op: str, a: V, b: V) -> V:
    if a not in (V.BOOLEAN, *INTEGERS) or b not in (V.BOOLEAN, *INTEGERS):
        raise FilterError(f"{op} isn't defined for {a.name} and {b.name}")
    return max(a, b)


def comparison(a: V, b: V) -> V:
    """What both sides are compared as: the left type decides."""
    if a == V.STRING:
        return V.STRING
    if a in NUMERIC and b in NUMERIC:
        return max(a, b)
    if b == V.STRING:
        if a in INTEGERS:
            return V.DECIMAL
        return a
    if a == b:
        return a
    raise FilterError(f"{a.name} can't be compared with {b.name}")


def unified(kinds: list[V]) -> V:
    """One type for branches that may differ: numbers widen, text takes all, others must agree."""
    if len(set(kinds)) == 1:
        return kinds[0]
    if all(k in NUMERIC for k in kinds):
        return max(kinds)
    if V.STRING in kinds:
        return V.STRING
    raise FilterError("branches of types " + ", ".join(k.name for k in kinds))
