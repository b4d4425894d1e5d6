"""From syntax trees to typed Spark columns.

Names are looked up without regard to case. Both sides of an operator are converted to the type its rule gives; type errors
raise here, never on executors. AND and OR are null if either side is null; at the root of a filter, where null and false
both drop the row, AND is the plain one so that its parts reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates, logic, maths, text
from ..functions.base import Typed, cased, convert, literal, upper
from . import syntax as S
from .types import DECIMAL, FilterError, V, comparison, value_type

FUNCTIONS = text.FUNCTIONS | maths.FUNCTIONS | dates.FUNCTIONS | logic.FUNCTIONS


class Binder:
    def __init__(self, df: DataFrame | None):
        self.fields = {f.name.upper(): f for f in df.schema.fields} if df is not None else {}

    def column(self, name: str) -> Typed:
        f = self.fields.get(name.upper())
        if f is None:
            raise FilterError(f"no column {name}")
        kind = value_type(f)
        c = F.col(f"`{f.name}`")
        if kind == V.INT32 and f.dataType.typeName() != "integer":
            c = c.cast("int")
        elif kind == V.DOUBLE and f.dataType.typeName() != "double":
            c = c.cast("double")
        elif kind == V.DATETIME and f.dataType.typeName() != "timestamp_ntz":
            c = c.cast("timestamp_ntz")
        elif kind == V.DECIMAL and f.dataType != DECIMAL:
            c = c.cast(DECIMAL)
        return Typed(c, kind)

    def bind(self, node: object, hint: V = V.BOOLEAN) -> Typed:
        """hint: the type of a bare NULL here."""
        if isinstance(node, S.Literal):
            return literal(node.value, node.kind if node.kind is not None else hint)
        if isinstance(node, S.Name):
            return self.column(node.name)
        if isinstance(node, S.Unary):
            return maths.unary(node.op, self.bind(node.arg))
        if isinstance(node, S.IsNull):
            a = self.bind(node.arg)
            return Typed(a.col.isNotNull() if node.negated else a.col.isNull(), V.BOOLEAN)
        if isinstance(node, S.In):
            return self.within(node)
        if isinstance(node, S.Call):
            return self.call(node)
        if isinstance(node, S.Binary):
            return self.binary(node)
        raise FilterError(f"not an expression: {node}")

    def sides(self, a: object, b: object) -> tuple[Typed, Typed]:
        """A bare NULL takes the type of the other side."""
        if isinstance(a, S.Literal) and a.kind is None:
            right = self.bind(b)
            return literal(None, right.kind), right
        left = self.bind(a)
        return left, self.bind(b, left.kind)

    def binary(self, node: S.Binary) -> Typed:
        a, b = self.sides(node.left, node.right)
        if node.op in ("AND", "OR"):
            if a.kind != V.BOOLEAN or b.kind != V.BOOLEAN:
                raise FilterError(f"{node.op} needs BOOLEAN, not {a.kind.name} and {b.kind.name}")
            out = a.col & b.col if node.op == "AND" else a.col | b.col
            return Typed(F.when(a.col.isNotNull() & b.col.isNotNull(), out), V.BOOLEAN)
        if node.op == "LIKE":
            return self.like(a, b, node.negated, node.exact)
        if node.op in ("+", "-", "*", "/", "%"):
            return maths.compute(node.op, a, b)
        if node.op in ("&", "|", "^"):
            return maths.bits(node.op, a, b)
        if node.op in ("<<", ">>"):
            return maths.shift(node.op, a, b)
        return Typed(self.compare(node.op, a, b, node.exact), V.BOOLEAN)

    def compare(self, op: str, a: Typed, b: Typed, exact: bool) -> Column:
        kind = comparison(a.kind, b.kind)
        x, y = convert(a, kind), convert(b, kind)
        if kind == V.STRING and not exact and not (x.is_const and not cased(x.const) or y.is_const and not cased(y.const)):
            left, right = upper(x), upper(y)
        else:
            left, right = x.col, y.col
        op = {"===": "=", "!==": "<>"}.get(op, op)
        if kind == V.BOOLEAN and op not in ("=", "<>"):
            left, right = left.cast("int"), right.cast("int")
        out = {"=": left == right, "<>": left != right, "<": left < right, "<=": left <= right, ">": left > right, ">=": left >= right}[op]
        if kind == V.DOUBLE:
            # a NaN is unequal to everything, itself included, and in no order
            sides = [c for t, c in ((x, left), (y, right)) if not t.is_const]
            for c in sides:
                out = (out | F.isnan(c)) if op == "<>" else (out & ~F.isnan(c))
        return out

    def like(self, a: Typed, b: Typed, negated: bool, exact: bool) -> Typed:
        """Wildcards % and * stand at either end only; without any the pattern never matches."""
        if a.kind != V.STRING:
            raise FilterError(f"LIKE needs text, not {a.kind.name}")
        if not b.is_const or not isinstance(b.const, str):
            raise FilterError("the pattern of LIKE must be a text literal")
        pattern = b.const.replace("*", "%")
        if set(pattern) == {"%"}:
            out = F.lit(True)
        else:
            core = pattern[pattern.startswith("%") :]
            core = core[: len(core) - core.endswith("%")]
            if "%" in core:
                raise FilterError(f"a wildcard within a pattern: {b.const}")
            s = a.col if exact or not cased(core) else F.upper(a.col)
            part = F.lit(core if exact else core.upper())
            if pattern.startswith("%") and pattern.endswith("%") and len(pattern) > 1:
                out = F.contains(s, part)
            elif pattern.startswith("%"):
                out = F.endswith(s, part)
            elif pattern.endswith("%"):
                out = F.startswith(s, part)
            else:
                out = F.lit(False)
        return Typed(F.when(a.col.isNotNull(), ~out if negated else out), V.BOOLEAN)

    def within(self, node: S.In) -> Typed:
        """Null if the source is null; a null item matches nothing."""
        a = self.bind(node.arg)
        found = F.lit(False)
        items = [self.bind(x, a.kind) for x in node.items]
        plain = all(i.is_const and i.const is not None and i.kind == a.kind for i in items) and a.kind != V.DOUBLE
        if plain:
            fold = a.kind == V.STRING and not node.exact and any(cased(i.const) for i in items)
            values = [F.lit(str(i.const).upper()) if fold else i.col for i in items]
            found = (F.upper(a.col) if fold else a.col).isin(*values)
        else:
            for i in items:
                found = found | F.coalesce(self.compare("=", a, i, node.exact), F.lit(False))
        return Typed(F.when(a.col.isNotNull(), ~found if node.negated else found), V.BOOLEAN)

    def call(self, node: S.Call) -> Typed:
        if node.name not in FUNCTIONS:
            raise FilterError(f"no function {node.name}")
        least, most, build = FUNCTIONS[node.name]
        if not least <= len(node.args) <= most:
            raise FilterError(f"{node.name} takes {least} to {most} arguments, not {len(node.args)}")
        args = [self.bind(a, V.STRING) for a in node.args]
        return build(args)

    def predicate(self, node: object, strict: bool = True) -> Column:
        """A filter condition. Not BOOLEAN: an error if strict, else no row passes."""
        if isinstance(node, S.Binary) and node.op == "AND":
            return self.predicate(node.left) & self.predicate(node.right)
        t = self.bind(node)
        if t.kind != V.BOOLEAN:
            if strict:
                raise FilterError(f"a filter must be BOOLEAN, not {t.kind.name}")
            return F.lit(False)
        return t.col


def bind(df: DataFrame | None, node: object) -> Typed:
    return Binder(df).bind(node)
