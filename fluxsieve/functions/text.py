"""Text functions. Offsets are in code points from 0; a last argument of true ignores case."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans.types import FilterError, V
from .base import Typed, const, convert


def _text(a: Typed, name: str) -> Column:
    if a.kind not in (V.STRING, V.GUID) and not (a.is_const and a.const is None):
        raise FilterError(f"{name} needs text, not {a.kind.name}")
    return convert(a, V.STRING).col


def _pair(args: list[Typed], name: str, flag: int) -> tuple[Column, Column]:
    """The first two arguments, in upper case where the flag says so; a null flag is false."""
    s, t = _text(args[0], name), _text(args[1], name)
    if len(args) > flag:
        ignore = convert(args[flag], V.BOOLEAN)
        if ignore.is_const:
            return (F.upper(s), F.upper(t)) if ignore.const else (s, t)
        yes = F.coalesce(ignore.col, F.lit(False))
        return F.when(yes, F.upper(s)).otherwise(s), F.when(yes, F.upper(t)).otherwise(t)
    return s, t


def _test(name: str, f: object) -> object:
    def build(args: list[Typed]) -> Typed:
        s, t = _pair(args, name, 2)
        return Typed(F.when(s.isNull(), F.lit(None).cast("boolean")).otherwise(F.coalesce(f(s, t), F.lit(False))), V.BOOLEAN)

    return build


def index_of(s: Column, t: Column) -> Column:
    return F.call_function("locate", t, s) - 1


def nth_index_of(s: Column, t: Column, n: Column) -> Column:
    """Place of match n, counted from 0; matches may overlap; -1 if there are fewer. One step of the fold is one match."""
    step = lambda at, _: F.when(at == -1, F.lit(-1)).otherwise(F.call_function("locate", t, s, at + 2) - 1)
    first = F.call_function("locate", t, s) - 1
    more = F.when(n >= 1, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.when(n < 0, F.lit(-1)).otherwise(F.aggregate(more, first, step))


def _index(args: list[Typed]) -> Typed:
    s, t = _pair(args, "IndexOf", 2)
    return Typed(index_of(s, t), V.INT32)


def _last_index(args: list[Typed]) -> Typed:
    s, t = _pair(args, "LastIndexOf", 2)
    back = F.call_function("locate", F.reverse(t), F.reverse(s))
    return Typed(F.when(F.length(t) == 0, F.length(s)).when(back == 0, F.lit(-1)).otherwise(F.length(s) - back - F.length(t) + 1), V.INT32)


def _nth_index(args: list[Typed]) -> Typed:
    s, t = _pair(args, "NthIndexOf", 3)
    return Typed(nth_index_of(s, t, convert(args[2], V.INT32).col), V.INT32)


def _split(args: list[Typed]) -> Typed:
    """Piece n between matches of a delimiter; a match at place 0, or none, counts as not found."""
    whole = _text(args[0], "Split")
    s, t = _pair(args, "Split", 3)
    n = convert(args[2], V.INT32).col
    first, second = nth_index_of(s, t, n - 1), nth_index_of(s, t, n)
    begin = first + F.length(t)
    out = (
        F.when((first <= 0) & (second <= 0), F.lit(""))
        .when(first <= 0, F.substring(whole, F.lit(1), second))
        .when(second <= 0, F.substring(whole, begin + 1, F.length(whole)))
        .otherwise(F.substring(whole, begin + 1, F.greatest(second - begin, F.lit(0))))
    )
    return Typed(F.when(s.isNull() | t.isNull() | n.isNull(), F.lit(None).cast("string")).otherwise(out), V.STRING)


def _count(args: list[Typed]) -> Typed:
    s, t = _pair(args, "StrCount", 2)
    n = (F.length(s) - F.length(F.replace(s, t, F.lit("")))) / F.when(F.length(t) > 0, F.length(t))
    return Typed(F.when(s.isNull(), F.lit(None).cast("int")).otherwise(F.coalesce(n.cast("int"), F.lit(0))), V.INT32)


def _compare(args: list[Typed]) -> Typed:
    a, b = _pair(args, "StrCmp", 2)
    return Typed(F.when(a < b, F.lit(-1)).when(a > b, F.lit(1)).when(a == b, F.lit(0)), V.INT32)


def _substr(args: list[Typed]) -> Typed:
    """From place i, n code points or the rest; a place before the start or beyond the end gives empty text."""
    s, i = _text(args[0], "SubStr"), convert(args[1], V.INT32).col
    n = convert(args[2], V.INT32).col if len(args) > 2 else F.lit(None).cast("int")
    size = F.coalesce(n, F.length(s))
    out = F.when((i < 0) | (i >= F.length(s)) | (size <= 0), F.lit("")).otherwise(F.substring(s, i + 1, size))
    return Typed(F.when(s.isNull() | i.isNull(), F.lit(None).cast("string")).otherwise(out), V.STRING)


def java_regex(pattern: str) -> str:
    """The same pattern in Java's dialect: named groups are spelled differently; what Java lacks is refused."""
    try:
        re.compile(pattern)
    except re.error as e:
        raise FilterError(f"bad pattern {pattern!r}: {e}") from e
    if re.search(r"\(\?\((?:\w+)\)", pattern):
        raise FilterError("conditional groups aren't supported")
    return re.sub(r"\(\?P=(\w+)\)", r"\\k<\1>", pattern.replace("(?P<", "(?<"))


def _pattern(args: list[Typed], name: str) -> tuple[str | None, Column]:
    p = const(args[0], f"the pattern of {name}")
    return None if p is None else java_regex(p), _text(args[1], name)


def _match(args: list[Typed]) -> Typed:
    p, s = _pattern(args, "RegExMatch")
    return Typed(F.lit(None).cast("boolean") if p is None else s.rlike(p), V.BOOLEAN)


def _value(args: list[Typed]) -> Typed:
    p, s = _pattern(args, "RegExVal")
    return Typed(F.lit(None).cast("string") if p is None else F.regexp_extract(s, p, 0), V.STRING)


def _replace(args: list[Typed]) -> Typed:
    s, t, r = (_text(a, "Replace") for a in args[:3])
    plain = F.when(F.length(t) == 0, s).otherwise(F.replace(s, t, r))
    if len(args) < 4:
        return Typed(plain, V.STRING)
    quoted = F.concat(F.lit("(?iu)"), F.regexp_replace(t, r"([\\\[\](){}.*+?^$|#&~\-])", r"\\$1"))
    any_case = F.when(F.length(t) == 0, s).otherwise(F.regexp_replace(s, quoted, F.regexp_replace(r, r"([\\$])", r"\\$1")))
    flag = convert(args[3], V.BOOLEAN)
    if flag.is_const:
        return Typed(any_case if flag.const else plain, V.STRING)
    return Typed(F.when(F.coalesce(flag.col, F.lit(False)), any_case).otherwise(plain), V.STRING)


def _one(name: str, f: object, kind: V = V.STRING) -> object:
    return lambda args: Typed(f(_text(args[0], name)), kind)


FUNCTIONS = {
    "CONTAINS": (2, 3, _test("Contains", F.contains)),
    "STARTSWITH": (2, 3, _test("StartsWith", F.startswith)),
    "ENDSWITH": (2, 3, _test("EndsWith", F.endswith)),
    "INDEXOF": (2, 3, _index),
    "LASTINDEXOF": (2, 3, _last_index),
    "NTHINDEXOF": (3, 4, _nth_index),
    "LEN": (1, 1, _one("Len", F.length, V.INT32)),
    "LOWER": (1, 1, _one("Lower", F.lower)),
    "UPPER": (1, 1, _one("Upper", F.upper)),
    "REVERSE": (1, 1, _one("Reverse", F.reverse)),
    "TRIM": (1, 1, _one("Trim", lambda c: F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))),
    "TRIMLEFT": (1, 1, _one("TrimLeft", lambda c: F.regexp_replace(c, r"(?U)^\s+", ""))),
    "TRIMRIGHT": (1, 1, _one("TrimRight", lambda c: F.regexp_replace(c, r"(?U)\s+$", ""))),
    "REGEXMATCH": (2, 2, _match),
    "REGEXVAL": (2, 2, _value),
    "REPLACE": (3, 4, _replace),
    "SPLIT": (3, 4, _split),
    "STRCOUNT": (2, 3, _count),
    "STRCMP": (2, 3, _compare),
    "SUBSTR": (2, 3, _substr),
}
