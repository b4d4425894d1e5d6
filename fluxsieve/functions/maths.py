"""Arithmetic, bit operations and numeric functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans.types import INTEGERS, NUMERIC, SPARK, FilterError, V, arithmetic, bitwise, comparison
from .base import Typed, convert


def _wrap(wide: Column, bits: int) -> Column:
    """Two's complement of a wider integer."""
    kind = "decimal(20,0)" if bits == 64 else "long"
    half, full = (F.lit(str(1 << n)).cast(kind) for n in (bits - 1, bits))
    return (F.pmod(wide + half, full) - half).cast("long" if bits == 64 else "int")


def _integer(op: str, a: Column, b: Column, kind: V) -> Column:
    """+ - * that wrap around and never raise."""

    def apply(x: Column, y: Column) -> Column:
        return x + y if op == "+" else x - y if op == "-" else x * y

    if kind == V.INT32:
        return _wrap(apply(a.cast("long"), b.cast("long")), 32)
    quick = {"+": F.try_add, "-": F.try_subtract, "*": F.try_multiply}[op](a, b)
    wide = "decimal(19,0)"
    return F.coalesce(quick, _wrap(apply(a.cast(wide), b.cast(wide)), 64))


def double_quotient(a: Column, b: Column) -> Column:
    """IEEE division: infinities and NaN instead of null or an error."""
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))
    zero = F.when((a == 0) | F.isnan(a), nan).when(a > 0, inf).otherwise(-inf)
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).when(b == 0, zero).otherwise(a / F.when(b != 0, b))


def floor_mod(a: Column, b: Column) -> Column:
    """Remainder with the sign of the divisor; null for a divisor of 0."""
    b = F.nullif(b, F.lit(0))
    r = F.when(b == -1, F.lit(0)).otherwise(a % b)
    return F.when((r != 0) & ((r < 0) != (b < 0)), r + b).otherwise(r)


def compute(op: str, a: Typed, b: Typed) -> Typed:
    kind = arithmetic(op, a.kind, b.kind)
    x, y = convert(a, kind).col, convert(b, kind).col
    if kind == V.STRING:
        return Typed(F.concat(x, y), kind)
    if kind == V.BOOLEAN:
        # a sum of truth values is or, a difference is exclusive or
        return Typed(F.when(x.isNull() | y.isNull(), F.lit(None).cast("boolean")).otherwise((x | y) if op == "+" else (x != y)), kind)
    if op == "%":
        return Typed(floor_mod(x, y).cast(SPARK[kind]), kind)
    if kind in INTEGERS:
        if op == "/":
            # least value / -1 would overflow: it wraps
            quotient = F.call_function("div", x, F.when((y != 0) & (y != -1), y))
            return Typed(F.when(y == -1, _integer("-", F.lit(0).cast(SPARK[kind]), x, kind)).otherwise(quotient.cast(SPARK[kind])), kind)
        return Typed(_integer(op, x, y, kind), kind)
    if kind == V.DOUBLE:
        return Typed(double_quotient(x, y) if op == "/" else x + y if op == "+" else x - y if op == "-" else x * y, kind)
    f = {"+": F.try_add, "-": F.try_subtract, "*": F.try_multiply, "/": F.try_divide}[op]
    return Typed(f(x, y), kind)


def bits(op: str, a: Typed, b: Typed) -> Typed:
    kind = bitwise(op, a.kind, b.kind)
    x, y = convert(a, kind).col, convert(b, kind).col
    if kind == V.BOOLEAN:
        out = {"&": x & y, "|": x | y, "^": x != y}[op]
        return Typed(F.when(x.isNull() | y.isNull(), F.lit(None).cast("boolean")).otherwise(out), kind)
    return Typed({"&": x.bitwiseAND, "|": x.bitwiseOR, "^": x.bitwiseXOR}[op](y), kind)


def shift(op: str, a: Typed, b: Typed) -> Typed:
    """A count of the width or more leaves 0, or -1 for >> of a negative; a negative count wraps around the width."""
    if a.kind not in INTEGERS or b.kind not in (V.BOOLEAN, *INTEGERS):
        raise FilterError(f"{op} isn't defined for {a.kind.name} and {b.kind.name}")
    width = 32 if a.kind == V.INT32 else 64
    n = convert(b, V.INT64).col
    n = F.when(n < 0, width - (F.abs(n) % width)).otherwise(n)
    by = F.least(n, F.lit(width - 1)).cast("int")
    if op == "<<":
        out = F.when(n >= width, F.lit(0).cast(SPARK[a.kind])).otherwise(F.call_function("shiftleft", a.col, by))
    else:
        out = F.call_function("shiftright", a.col, by)
    return Typed(F.when(a.col.isNull() | n.isNull(), F.lit(None).cast(SPARK[a.kind])).otherwise(out), a.kind)


def unary(op: str, a: Typed) -> Typed:
    if op == "NOT" or op == "~":
        if a.kind == V.BOOLEAN:
            return Typed(~a.col, V.BOOLEAN)
        if a.kind in INTEGERS:
            return Typed(F.bitwise_not(a.col), a.kind)
        raise FilterError(f"{op} isn't defined for {a.kind.name}")
    if a.kind not in NUMERIC or a.kind == V.BOOLEAN:
        raise FilterError(f"unary {op} isn't defined for {a.kind.name}")
    if op == "+":
        return a
    if a.is_const and a.const is not None:
        from .base import literal

        return literal(-a.const, a.kind)
    if a.kind in INTEGERS:
        return Typed(_integer("-", F.lit(0).cast(SPARK[a.kind]), a.col, a.kind), a.kind)
    return Typed(-a.col, a.kind)


def _number(a: Typed, name: str) -> Typed:
    if a.kind not in NUMERIC:
        raise FilterError(f"{name} needs a number, not {a.kind.name}")
    return a


def _keep(name: str, f: object) -> object:
    """A function of fractions that keeps the type; integers and booleans stay as they are."""

    def build(args: list[Typed]) -> Typed:
        a = _number(args[0], name)
        return Typed(f(a.col).cast(SPARK[a.kind]), a.kind) if a.kind in (V.DECIMAL, V.DOUBLE) else a

    return build


def _abs(args: list[Typed]) -> Typed:
    a = _number(args[0], "Abs")
    if a.kind == V.BOOLEAN:
        return a
    if a.kind in INTEGERS:
        return Typed(F.when(a.col < 0, _integer("-", F.lit(0).cast(SPARK[a.kind]), a.col, a.kind)).otherwise(a.col), a.kind)
    return Typed(F.abs(a.col), a.kind)


def _power(args: list[Typed]) -> Typed:
    a, b = (_number(x, "Power") for x in args)
    kind = max(arithmetic("*", a.kind, b.kind), V.INT32)
    out = F.pow(convert(a, V.DOUBLE).col, convert(b, V.DOUBLE).col)
    return Typed(out if kind == V.DOUBLE else out.try_cast(SPARK[kind]), kind)


def _sqrt(args: list[Typed]) -> Typed:
    a = _number(args[0], "Sqrt")
    out = F.sqrt(convert(a, V.DOUBLE).col)
    return Typed(out.try_cast(SPARK[V.DECIMAL]), V.DECIMAL) if a.kind == V.DECIMAL else Typed(out, V.DOUBLE)


def _extreme(greater: bool) -> object:
    def build(args: list[Typed]) -> Typed:
        """The running value is replaced where the next one is beyond it; nulls are passed over."""
        kind = args[0].kind
        for a in args[1:]:
            kind = comparison(kind, a.kind) if kind != V.STRING else V.STRING
        if len({a.kind for a in args}) > 1:
            kind = max(a.kind for a in args) if all(a.kind in NUMERIC for a in args) else args[0].kind
        cols = [convert(a, kind).col for a in args]
        return Typed((F.greatest if greater else F.least)(*cols), kind)

    return build


FUNCTIONS = {
    "ABS": (1, 1, _abs),
    "CEILING": (1, 1, _keep("Ceiling", F.ceil)),
    "FLOOR": (1, 1, _keep("Floor", F.floor)),
    "ROUND": (1, 1, _keep("Round", lambda c: F.bround(c, 0))),
    "SQRT": (1, 1, _sqrt),
    "POWER": (2, 2, _power),
    "MAXOF": (2, 99, _extreme(True)),
    "MINOF": (2, 99, _extreme(False)),
}
