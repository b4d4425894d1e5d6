import datetime as dt
import decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fluxsieve.operators.dataset import DataSet, field
from fluxsieve.operators.statements import evaluate, evaluate_over
from fluxsieve.plans.syntax import Binary, Literal, parse
from fluxsieve.plans.types import FilterError

VALUES = [
    ("1 + 2 * 3", 7), ("2 ^ 32 ^ 4", 38), ("2147483647 + 1", -2147483648), ("-7 % 3", 2), ("7 % -3", -2), ("7 / 2", 3), ("-7 / 2", -3), ("1 / 0", None), ("5 % 0", None),
    ("9223372036854775807 + 1", -9223372036854775808), ("4611686018427387904 * 4", 0), ("1e0 / 0", float("inf")), ("'a' + 'B' + 3", "aB3"), ("True + False", True), ("True - True", False),
    ("1 << 33", 0), ("1 << -31", 2), ("-8 >> 40", -1), ("12 & 10 | 1", 9), ("6 XOR 3", 5), ("~5", -6), ("!True", False), ("NOT 1 = 2", True), ("-(-3)", 3),
    ("'abc' = 'ABC'", True), ("'abc' === 'ABC'", False), ("'abc' !== 'ABC'", True), ("NULL = 1", None), ("1 = '1.0'", True), ("'5' < 10", False),
    ("'abc' LIKE 'A%'", True), ("'abc' LIKE '*C'", True), ("'abc' LIKE BINARY 'A%'", False), ("'abc' LIKE 'abc'", False), ("'abc' LIKE '%'", True), ("'abc' NOT LIKE '%B%'", False), ("'a_c' LIKE '%_%'", True),
    ("5 IN (1, NULL)", False), ("5 NOT IN (1, NULL)", True), ("NULL IS NULL", True), ("1 IS !NULL", True), ("'x' IN BINARY ('X', 'y')", False),
    ("True AND NULL", None), ("False AND NULL", None), ("True OR NULL", None), ("1 < 2 AND 'a' = 'A' || False", True),
    ("Abs(-3)", 3), ("Ceiling(2.1e0)", 3.0), ("Floor(-2.1e0)", -3.0), ("Round(2.5e0)", 2.0), ("Round(3.5e0)", 4.0), ("Sqrt(9)", 3.0), ("Power(2, 10)", 1024), ("MaxOf(1, 5, 3)", 5), ("MinOf(4, 2e0)", 2.0),
    ("Coalesce(NULL, 'x')", "x"), ("IIf(NULL, 1, 2)", 2), ("IsNull(NULL, 7)", 7), ("Convert('false', 'Boolean')", True), ("Convert(3.9, 'System.Int32')", 3), ("Convert('3.9', 'Int64')", 3), ("Convert(5e0, 'String')", "5.0"),
    ("Contains('Hello', 'ell')", True), ("Contains('Hello', 'ELL', True)", True), ("StartsWith('Hello', 'h')", False), ("EndsWith('Hello', 'LO', True)", True),
    ("IndexOf('hello', 'l')", 2), ("IndexOf('hello', 'z')", -1), ("LastIndexOf('abcabc', 'BC', True)", 4), ("NthIndexOf('aaaa', 'aa', 2)", 2), ("NthIndexOf('aaaa', 'aa', 3)", -1),
    ("Len('añb')", 3), ("Reverse('abc')", "cba"), ("Trim('\t x ')", "x"), ("TrimLeft(' x ')", "x "), ("TrimRight(' x ')", " x"), ("Upper('a')", "A"), ("Lower('A')", "a"),
    ("RegExMatch('^h.*o$', 'hello')", True), ("RegExVal('l+', 'hello')", "ll"), ("RegExVal('z', 'hello')", ""), ("Replace('aBa', 'b', '$', True)", "a$a"), ("Replace('a.b', '.', '')", "ab"),
    ("Split('a,b,c', ',', 0)", "a"), ("Split('a,b,c', ',', 1)", "b"), ("Split('a,b,c', ',', 2)", "c"), ("Split('abc', ',', 0)", ""), ("StrCount('aXa', 'x', True)", 1), ("StrCount('a', '')", 0),
    ("StrCmp('a', 'b')", -1), ("StrCmp('A', 'a', True)", 0), ("SubStr('hello', 1, 3)", "ell"), ("SubStr('hello', 9)", ""), ("SubStr('hello', -1)", ""), ("SubStr('hello', 2)", "llo"),
    ("IsDate('2/4/2019')", True), ("IsDate('x')", False), ("IsInteger('0x1F')", True), ("IsInteger('1.5')", False), ("IsNumeric('1e5')", True), ("IsNumeric('1e')", False), ("IsGuid('{12345678-1234-1234-1234-123456789abc}')", True),
    ("DateAdd(#2024-01-31#, 1, 'Month')", dt.datetime(2024, 2, 29)), ("DateAdd(#2024-02-29#, 1, 'Year')", dt.datetime(2025, 2, 28)), ("DateAdd('2019-02-01 00:30', 3, 'WeekDay')", dt.datetime(2019, 2, 7, 0, 30)),
    ("DateDiff(#2024-01-31#, #2024-02-29#, 'Month')", 1), ("DateDiff(#2024-03-01#, #2024-01-01#, 'Day')", -60), ("DateDiff(#2020-02-29#, #2024-02-28#, 'Year')", 3), ("DateDiff(#2024-01-01#, #2024-01-01 00:00:01.5#, 'Second')", 2),
    ("DatePart(#2024-01-07#, 'WeekDay')", 8), ("DatePart(#2024-01-08#, 'weekday')", 2), ("DatePart(#2024-01-08 01:02:03.456#, 'Millisecond')", 456), ("DatePart(#2019-01-01T03:00:00-05:00#, 'Hour')", 8), ("DatePart(#2024-12-30#, 'Week')", 1),
]


@pytest.fixture(scope="module")
def empty(spark):
    return DataSet(spark)


def test_values(empty):
    from fluxsieve.plans.binder import Binder

    b = Binder(None)
    got = empty.spark.range(1).select(*[b.bind(parse(text)[0].root).col.alias(f"c{i}") for i, (text, _) in enumerate(VALUES)]).first()
    assert {VALUES[i][0]: got[i] for i in range(len(VALUES)) if got[i] != VALUES[i][1]} == {}


def test_literals():
    kinds = [parse(x)[0].root for x in ("1", "0x10", "3000000000", "9223372036854775808", "1.50", "1e3", "'a'", "True", "#2024-01-02#")]
    assert [k.value for k in kinds] == [1, 16, 3000000000, decimal.Decimal(9223372036854775808), decimal.Decimal("1.50"), 1000.0, "a", True, dt.datetime(2024, 1, 2)]
    assert [k.kind.name for k in kinds] == ["INT32", "INT32", "INT64", "DECIMAL", "DECIMAL", "DOUBLE", "STRING", "BOOLEAN", "DATETIME"]


def test_flat_precedence(empty):
    root = parse("1 + 2 * 3", flat=True)[0].root
    assert isinstance(root, Binary) and root.op == "*" and root.right == Literal(3, root.right.kind)


@pytest.mark.parametrize("text", ["Convert(123, 'unknown')", "I-Am-A-bad-Expression", "Foo(1)", "Len()", "1 +", "'a' LIKE 'a%b'", "True * True", "1.5 % 2", "'a' AND True", "-True", "#nonsense#", "IsNull(1, NULL)", "~1.5", "@"])
def test_errors(empty, text):
    with pytest.raises(FilterError):
        evaluate(empty, text)


def test_nan_is_in_no_order(spark):
    d = DataSet(spark)
    df = d.create("t", [field("x", "DOUBLE")], [[float("nan")], [1.0], [None]])
    assert [r.v for r in evaluate_over(df, "x > 0", "v").orderBy("_rid").collect()] == [False, True, None]
    assert [r.v for r in evaluate_over(df, "x <> x", "v").orderBy("_rid").collect()] == [True, False, None]


@settings(max_examples=25, deadline=None)
@given(a=st.integers(-(2**31), 2**31 - 1), b=st.integers(-(2**31), 2**31 - 1), n=st.integers(-70, 70))
def test_integers_against_a_model(spark, a, b, n):
    df = spark.createDataFrame([(a, b, n)], "a int, b int, n int")
    d = DataSet(spark)
    df = d.add("t", df)

    def wrap(x):
        return (x + 2**31) % 2**32 - 2**31

    shift = n if n >= 0 else 32 - (-n % 32)
    want = {
        "a + b": wrap(a + b), "a - b": wrap(a - b), "a * b": wrap(a * b), "a % b": a % b if b else None, "a / b": wrap(int(abs(a) // abs(b) * (1 if (a < 0) == (b < 0) else -1))) if b else None,
        "a & b": a & b, "a | b": a | b, "a ^ b": a ^ b, "a << n": wrap(a << shift) if shift < 32 else 0, "a >> n": a >> min(shift, 31), "-a": wrap(-a), "Abs(a)": wrap(abs(a)),
    }
    from fluxsieve.plans.binder import Binder

    got = df.select(*[Binder(df).bind(parse(x)[0].root).col.alias(x) for x in want]).first().asDict()
    assert got == want
