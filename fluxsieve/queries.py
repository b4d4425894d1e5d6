"""The engine's queries over the driver's tables, and the same in DuckDB SQL.

customer, nation and region stand for device metadata, part and supplier for measurement metadata, events and orders for
streams. A query whose result is a scalar for each row returns the row's key and `v`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import metadata as M
from .operators import statements as Q
from .operators.dataset import RID, DataSet, IdFields, field
from .streaming import measurements as S

Query = Callable[[SparkSession, str], DataFrame]

KEYS = {"customer": ["c_custkey"], "part": ["p_partkey"], "orders": ["o_orderkey"], "events": ["event_id"], "lineitem": ["l_orderkey", "l_linenumber"], "supplier": ["s_suppkey"], "nation": ["n_nationkey"], "region": ["r_regionkey"]}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def data(spark: SparkSession, sf_dir: str, *names: str) -> DataSet:
    out = DataSet(spark)
    for name in names:
        ids = IdFields("c_name", "c_name", "c_name") if name == "customer" else IdFields("p_name", "p_name", "p_name")
        out.add(name, read(spark, sf_dir, name), () if name == "lineitem" else KEYS[name], ids)
    return out


def rows(table: str, text: str) -> Query:
    """Whole rows of a filter."""
    return lambda spark, sf_dir: Q.select_rows(data(spark, sf_dir, table), text, table).drop(RID)


def value(table: str, text: str) -> Query:
    """An expression for every row."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        from .plans.binder import Binder
        from .plans.syntax import parse

        df = read(spark, sf_dir, table)
        return df.select(*KEYS[table], Binder(df).bind(parse(text)[0].root).col.alias("v"))

    return run


#: Filters: name, table, filter text, DuckDB condition (or a whole query).
FILTERS = (
    ("filter_basic", "customer", "FILTER customer WHERE c_mktsegment = 'building' AND c_acctbal > 1000", "upper(c_mktsegment) = 'BUILDING' AND c_acctbal > 1000"),
    ("bare_expression", "part", "p_type LIKE 'eco%'", "starts_with(upper(p_type), 'ECO')"),
    ("like_prefix", "part", "FILTER part WHERE p_type LIKE 'eco%'", "starts_with(upper(p_type), 'ECO')"),
    ("like_suffix", "part", "FILTER part WHERE p_type LIKE '*STEEL'", "ends_with(upper(p_type), 'STEEL')"),
    ("like_contains", "part", "FILTER part WHERE p_name LIKE '%an%'", "contains(upper(p_name), 'AN')"),
    ("like_binary", "part", "FILTER part WHERE p_type LIKE BINARY 'ECO%'", "starts_with(p_type, 'ECO')"),
    ("like_no_wildcard", "part", "FILTER part WHERE p_type LIKE 'ECONOMY'", "false"),
    ("not_like", "part", "FILTER part WHERE p_type NOT LIKE 'eco%'", "NOT starts_with(upper(p_type), 'ECO')"),
    ("not_like_binary", "part", "FILTER part WHERE p_type NOT LIKE BINARY 'eco%'", "NOT starts_with(p_type, 'eco')"),
    ("cmp_lt", "part", "FILTER part WHERE p_size < 10", "p_size < 10"),
    ("cmp_le", "part", "FILTER part WHERE p_size <= '10'", "p_size <= 10"),
    ("cmp_gt", "part", "FILTER part WHERE p_retailprice > 1500", "p_retailprice > 1500"),
    ("cmp_ge", "orders", "FILTER orders WHERE o_orderdate >= #1997-06-01#", "o_orderdate >= TIMESTAMP '1997-06-01'"),
    ("cmp_eq_icase", "customer", "FILTER customer WHERE c_mktsegment == 'Machinery'", "upper(c_mktsegment) = 'MACHINERY'"),
    ("cmp_eq_exact", "customer", "FILTER customer WHERE c_mktsegment === 'Machinery' OR c_mktsegment === 'MACHINERY'", "c_mktsegment = 'MACHINERY' OR c_mktsegment = 'Machinery'"),
    ("cmp_ne_icase", "customer", "FILTER customer WHERE c_mktsegment <> 'machinery'", "upper(c_mktsegment) <> 'MACHINERY'"),
    ("cmp_ne_exact", "customer", "FILTER customer WHERE c_mktsegment !== 'machinery'", "c_mktsegment <> 'machinery'"),
    ("is_null", "customer", "FILTER customer WHERE IIf(c_nationkey > 10, NULL, c_name) IS NULL", "c_nationkey > 10"),
    ("is_not_null", "customer", "FILTER customer WHERE IIf(c_nationkey > 10, NULL, c_name) IS !NULL", "c_nationkey <= 10"),
    ("and_strict_null", "customer", "FILTER customer WHERE NOT (IIf(c_nationkey > 10, NULL, c_nationkey) > 5 AND c_acctbal > 0)", "c_nationkey <= 10 AND NOT (c_nationkey > 5 AND c_acctbal > 0)"),
    ("or_strict_null", "customer", "FILTER customer WHERE IIf(c_nationkey > 10, NULL, c_nationkey) > 5 OR c_acctbal > 0", "c_nationkey <= 10 AND (c_nationkey > 5 OR c_acctbal > 0)"),
    ("in_list", "customer", "FILTER customer WHERE c_mktsegment IN ('building', 'Machinery')", "upper(c_mktsegment) IN ('BUILDING', 'MACHINERY')"),
    ("in_list_binary", "customer", "FILTER customer WHERE c_mktsegment IN BINARY ('building', 'MACHINERY')", "c_mktsegment IN ('building', 'MACHINERY')"),
    ("not_in_list", "customer", "FILTER customer WHERE IIf(c_mktsegment = 'household', NULL, c_mktsegment) NOT IN ('building', NULL)", "c_mktsegment NOT IN ('HOUSEHOLD', 'BUILDING')"),
    ("in_list_numbers", "part", "FILTER part WHERE p_size IN (1, 2 + 3, '7')", "p_size IN (1, 5, 7)"),
    ("order_by_multi", "customer", "FILTER customer WHERE c_acctbal < 0 ORDER BY c_mktsegment, c_acctbal DESC", "c_acctbal < 0"),
    ("order_by_binary", "part", "FILTER TOP 50 part WHERE True ORDER BY BINARY p_name", "SELECT * FROM part ORDER BY p_partkey LIMIT 50"),
    ("top_n", "customer", "FILTER TOP 20 customer WHERE c_acctbal > 0", "SELECT * FROM customer WHERE c_acctbal > 0 ORDER BY c_custkey LIMIT 20"),
    ("top_before_sort", "customer", "FILTER TOP 20 customer WHERE c_mktsegment = 'building' ORDER BY c_name DESC", "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' ORDER BY c_custkey LIMIT 20"),
    ("top_zero", "customer", "FILTER TOP 0 customer WHERE True", "false"),
    ("top_negative", "customer", "FILTER TOP -1 customer WHERE c_nationkey = 3", "c_nationkey = 3"),
    ("union_distinct_statements", "customer", "FILTER customer WHERE c_nationkey < 5; FILTER TOP 10 customer WHERE c_acctbal > 5000 ORDER BY c_acctbal; c_nationkey = 7", "SELECT * FROM customer WHERE c_nationkey < 5 OR c_nationkey = 7 OR c_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000 ORDER BY c_custkey LIMIT 10)"),
    ("identifier_order", "customer", "FILTER customer WHERE c_nationkey = 3; \"customer#000000007\"", "c_nationkey = 3 OR c_name = 'Customer#000000007'"),
    ("identifier_tag", "customer", "\"customer#000000042\"", "c_name = 'Customer#000000042'"),
    ("strict_or_numbers", "orders", "FILTER orders WHERE o_totalprice > 400000 OR o_orderstatus = 'p'", "o_totalprice > 400000 OR upper(o_orderstatus) = 'P'"),
)

_MONTHS = "(CASE WHEN b >= a THEN m - CAST(b < a + to_months(m) AS INTEGER) ELSE m + CAST(b > a + to_months(m) AS INTEGER) END)"


def _months(a: str, b: str) -> str:
    """Complete months in SQL, as the engine defines them."""
    m = f"CAST(12 * (year({b}) - year({a})) + month({b}) - month({a}) AS INTEGER)"
    return f"(SELECT {_MONTHS} FROM (SELECT {a} AS a, {b} AS b, {m} AS m))"


def _us(a: str, b: str) -> str:
    return f"(epoch_us({b}) - epoch_us({a}))"


_D, _D0 = "o_orderdate", "TIMESTAMP '1995-01-31 10:20:30.123456'"
_L0 = "#1995-01-31 10:20:30.123456#"
_I32, _I64, _DBL = "AS INTEGER)", "AS BIGINT)", "AS DOUBLE)"

#: Scalars: name, table, expression, DuckDB expression.
SCALARS = (
    ("op_multiply", "lineitem", "l_linenumber * l_linenumber", "CAST(l_linenumber * l_linenumber AS INTEGER)"),
    ("op_multiply_wrap", "part", "p_size * 100000000", "CAST(((CAST(p_size AS BIGINT) * 100000000 + 2147483648) % 4294967296 + 4294967296) % 4294967296 - 2147483648 AS INTEGER)"),
    ("op_divide_int", "orders", "o_orderkey / 7", "CAST(o_orderkey // 7 AS BIGINT)"),
    ("op_divide_zero", "part", "p_size / (p_size - p_size)", "CAST(NULL AS INTEGER)"),
    ("op_divide_double", "orders", "o_totalprice / 3", "o_totalprice / 3"),
    ("op_modulus", "orders", "(7 - o_orderkey) % 3", "CAST((((7 - o_orderkey) % 3) + 3) % 3 AS BIGINT)"),
    ("op_add", "part", "p_size + p_partkey", "CAST(p_size + p_partkey AS BIGINT)"),
    ("op_add_wrap", "part", "p_size + 2147483640", "CAST((CAST(p_size AS BIGINT) + 2147483640 + 2147483648) % 4294967296 - 2147483648 AS INTEGER)"),
    ("op_concat", "part", "p_brand + '-' + p_size", "p_brand || '-' || p_size"),
    ("op_subtract", "part", "10 - p_size", "CAST(10 - p_size AS INTEGER)"),
    ("op_shift_left", "part", "p_size << 3", "CAST(p_size << 3 AS INTEGER)"),
    ("op_shift_left_over", "part", "p_size << 33", "CAST(0 AS INTEGER)"),
    ("op_shift_right", "part", "(0 - p_size) >> 2", "CAST(floor((0 - p_size) / 4.0) AS INTEGER)"),
    ("op_bit_and", "orders", "o_orderkey & 255", "CAST(o_orderkey & 255 AS BIGINT)"),
    ("op_bit_or", "orders", "o_orderkey | 255", "CAST(o_orderkey | 255 AS BIGINT)"),
    ("op_bit_xor", "orders", "o_orderkey ^ 255", "CAST(xor(o_orderkey, CAST(255 AS BIGINT)) AS BIGINT)"),
    ("unary_minus", "part", "-p_size", "CAST(-p_size AS INTEGER)"),
    ("unary_plus", "part", "+p_retailprice", "p_retailprice"),
    ("unary_not", "part", "!(p_size > 10)", "NOT (p_size > 10)"),
    ("unary_bitnot", "part", "~p_size", "CAST(-p_size - 1 AS INTEGER)"),
    ("precedence", "part", "1 + 2 * p_size & 12 | 3", "CAST(((1 + 2 * p_size) & 12) | 3 AS INTEGER)"),
    ("scalar_eval", "customer", "IIf(c_acctbal > 0 AND c_nationkey IN (1, 2, 3), Upper(c_name), 'none')", "CASE WHEN c_acctbal > 0 AND c_nationkey IN (1, 2, 3) THEN upper(c_name) ELSE 'none' END"),
    ("fn_abs", "customer", "Abs(c_acctbal)", "abs(c_acctbal)"),
    ("fn_ceiling", "lineitem", "Ceiling(l_extendedprice)", "ceil(l_extendedprice)"),
    ("fn_floor", "lineitem", "Floor(l_extendedprice)", "floor(l_extendedprice)"),
    ("fn_round", "lineitem", "Round(l_extendedprice)", "round_even(l_extendedprice, 0)"),
    ("fn_sqrt", "lineitem", "Round(Sqrt(l_extendedprice) * 1000000.0)", "round_even(sqrt(l_extendedprice) * 1000000, 0)"),
    ("fn_power", "part", "Power(p_size, 3)", "CAST(pow(p_size, 3) AS INTEGER)"),
    ("fn_maxof", "part", "MaxOf(p_size, 25, p_size - 3)", "CAST(greatest(p_size, 25, p_size - 3) AS INTEGER)"),
    ("fn_minof", "part", "MinOf(p_retailprice, 1200.0)", "least(p_retailprice, 1200.0::DOUBLE)"),
    ("fn_coalesce", "customer", "Coalesce(IIf(c_nationkey > 10, NULL, c_name), c_mktsegment)", "CASE WHEN c_nationkey > 10 THEN c_mktsegment ELSE c_name END"),
    ("fn_iif", "customer", "IIf(IIf(c_nationkey > 10, NULL, True), 1, 2)", "CAST(CASE WHEN c_nationkey > 10 THEN 2 ELSE 1 END AS INTEGER)"),
    ("fn_isnull", "customer", "IsNull(IIf(c_nationkey > 10, NULL, c_nationkey), -1)", "CAST(CASE WHEN c_nationkey > 10 THEN -1 ELSE c_nationkey END AS INTEGER)"),
    ("fn_isdate", "customer", "IsDate(IIf(c_nationkey > 10, c_name, '2/4/2019'))", "NOT c_nationkey > 10"),
    ("fn_isinteger", "customer", "IsInteger(SubStr(c_name, 9, 9))", "regexp_matches(substr(c_name, 10, 9), '^[0-9]+$')"),
    ("fn_isguid", "customer", "IsGuid(IIf(c_nationkey > 10, c_name, '{12345678123412341234123456789abc}'))", "NOT c_nationkey > 10"),
    ("fn_isnumeric", "customer", "IsNumeric(IIf(c_nationkey > 10, c_name, '-1_0.5e3'))", "NOT c_nationkey > 10"),
    ("fn_convert_boolean", "part", "Convert(p_size - 10, 'Boolean')", "p_size <> 10"),
    ("fn_convert_int32", "part", "Convert(p_retailprice, 'System.Int32')", "CAST(trunc(p_retailprice) AS INTEGER)"),
    ("fn_convert_int64", "customer", "Convert(SubStr(c_name, 9), 'Int64') * 2", "CAST(substr(c_name, 10) AS BIGINT) * 2"),
    ("fn_convert_double", "part", "Convert(p_size, 'Single') / 4", "p_size / 4.0::DOUBLE"),
    ("fn_convert_decimal", "part", "Convert(Convert(p_retailprice, 'Decimal') > 1500.5, 'Int32')", "CAST(p_retailprice > 1500.5 AS INTEGER)"),
    ("fn_convert_string", "part", "Convert(p_size, 'String') + 'x'", "CAST(p_size AS VARCHAR) || 'x'"),
    ("fn_convert_datetime", "orders", "Convert('2024-01-0' + (o_orderkey % 9 + 1), 'DateTime')", "CAST('2024-01-0' || (o_orderkey % 9 + 1) AS TIMESTAMP)"),
    ("fn_convert_guid", "part", "Convert(IIf(p_size > 9, p_name, '12345678123412341234123456789ABC'), 'Guid')", "CASE WHEN p_size > 9 THEN NULL ELSE '12345678-1234-1234-1234-123456789abc' END"),
    ("fn_contains", "part", "Contains(p_type, 'BRASS')", "contains(p_type, 'BRASS')"),
    ("fn_contains_ic", "part", "Contains(p_type, 'brass', True)", "contains(upper(p_type), 'BRASS')"),
    ("fn_startswith", "part", "StartsWith(p_type, 'ECO')", "starts_with(p_type, 'ECO')"),
    ("fn_endswith", "part", "EndsWith(p_type, 'steel', True)", "ends_with(upper(p_type), 'STEEL')"),
    ("fn_indexof", "part", "IndexOf(p_name, 'a')", "CAST(instr(p_name, 'a') - 1 AS INTEGER)"),
    ("fn_indexof_ic", "part", "IndexOf(p_type, 's', True)", "CAST(instr(upper(p_type), 'S') - 1 AS INTEGER)"),
    ("fn_lastindexof", "part", "LastIndexOf(p_name, 'a')", "CAST(CASE WHEN instr(p_name, 'a') = 0 THEN -1 ELSE length(p_name) - instr(reverse(p_name), 'a') END AS INTEGER)"),
    ("fn_nthindexof", "part", "NthIndexOf(p_name, 'a', 1)", "CAST(CASE WHEN instr(p_name, 'a') = 0 OR instr(substr(p_name, instr(p_name, 'a') + 1), 'a') = 0 THEN -1 ELSE instr(p_name, 'a') + instr(substr(p_name, instr(p_name, 'a') + 1), 'a') - 1 END AS INTEGER)"),
    ("fn_len", "part", "Len(p_name)", "CAST(length(p_name) AS INTEGER)"),
    ("fn_lower", "part", "Lower(p_type)", "lower(p_type)"),
    ("fn_upper", "part", "Upper(p_name)", "upper(p_name)"),
    ("fn_reverse", "part", "Reverse(p_name)", "reverse(p_name)"),
    ("fn_regexmatch", "part", "RegExMatch('^[A-M].*[0-9]$', p_brand)", "regexp_matches(p_brand, '^[A-M].*[0-9]$')"),
    ("fn_regexval", "part", "RegExVal('[aeiou]+', p_name)", "regexp_extract(p_name, '[aeiou]+')"),
    ("fn_replace", "part", "Replace(p_type, 'E', 'e')", "replace(p_type, 'E', 'e')"),
    ("fn_replace_ic", "part", "Replace(p_type, 'e', '$', True)", "regexp_replace(p_type, 'e', '$', 'gi')"),
    ("fn_split", "part", "Split(p_type, ' ', 1)", "CASE WHEN instr(p_type, ' ') = 0 THEN '' ELSE split_part(p_type, ' ', 2) END"),
    ("fn_strcount", "part", "StrCount(p_name, 'e')", "CAST(length(p_name) - length(replace(p_name, 'e', '')) AS INTEGER)"),
    ("fn_strcmp", "part", "StrCmp(p_name, p_type, True)", "CAST(CASE WHEN upper(p_name) < upper(p_type) THEN -1 WHEN upper(p_name) > upper(p_type) THEN 1 ELSE 0 END AS INTEGER)"),
    ("fn_substr", "part", "SubStr(p_name, 2, 4)", "substring(p_name, 3, 4)"),
    ("fn_trim", "part", "Trim('  ' + p_name + ' ')", "trim(p_name)"),
    ("fn_trimleft", "part", "TrimLeft(' ' + p_name + ' ')", "ltrim(p_name) || ' '"),
    ("fn_trimright", "part", "TrimRight(' ' + p_name + ' ')", "' ' || rtrim(p_name)"),
    ("fn_dateadd_year", "orders", "DateAdd(o_orderdate, 2, 'Year')", f"{_D} + INTERVAL 2 YEAR"),
    ("fn_dateadd_month", "orders", "DateAdd(o_orderdate, 1, 'Month')", f"{_D} + INTERVAL 1 MONTH"),
    ("fn_dateadd_dayofyear", "orders", "DateAdd(o_orderdate, 40, 'DayOfYear')", f"{_D} + INTERVAL 40 DAY"),
    ("fn_dateadd_day", "orders", "DateAdd(o_orderdate, -3, 'Day')", f"{_D} - INTERVAL 3 DAY"),
    ("fn_dateadd_week", "orders", "DateAdd(o_orderdate, 2, 'Week')", f"{_D} + INTERVAL 14 DAY"),
    ("fn_dateadd_weekday", "orders", "DateAdd(o_orderdate, 2, 'WeekDay')", f"{_D} + to_days(CAST(((2 - (isodow({_D}) - 1)) % 7 + 7) % 7 AS INTEGER))"),
    ("fn_dateadd_hour", "orders", "DateAdd(o_orderdate, 5, 'Hour')", f"{_D} + INTERVAL 5 HOUR"),
    ("fn_dateadd_minute", "orders", "DateAdd(o_orderdate, 61, 'Minute')", f"{_D} + INTERVAL 61 MINUTE"),
    ("fn_dateadd_second", "orders", "DateAdd(o_orderdate, 61, 'Second')", f"{_D} + INTERVAL 61 SECOND"),
    ("fn_dateadd_millisecond", "orders", "DateAdd(o_orderdate, 61, 'Millisecond')", f"{_D} + INTERVAL 61 MILLISECOND"),
    ("fn_datediff_year", "orders", f"DateDiff({_L0}, o_orderdate, 'Year')", f"CAST(trunc({_months(_D0, _D)} / 12.0) AS INTEGER)"),
    ("fn_datediff_month", "orders", f"DateDiff({_L0}, o_orderdate, 'Month')", f"CAST({_months(_D0, _D)} AS INTEGER)"),
    ("fn_datediff_dayofyear", "orders", f"DateDiff({_L0}, o_orderdate, 'DayOfYear')", f"CAST(floor({_us(_D0, _D)} / 86400e6) AS INTEGER)"),
    ("fn_datediff_day", "orders", f"DateDiff({_L0}, o_orderdate, 'Day')", f"CAST(floor({_us(_D0, _D)} / 86400e6) AS INTEGER)"),
    ("fn_datediff_week", "orders", f"DateDiff({_L0}, o_orderdate, 'Week')", f"CAST(floor(floor({_us(_D0, _D)} / 86400e6) / 7) AS INTEGER)"),
    ("fn_datediff_weekday", "orders", f"DateDiff({_L0}, o_orderdate, 'WeekDay')", f"CAST(floor({_us(_D0, _D)} / 86400e6) AS INTEGER)"),
    ("fn_datediff_hour", "orders", f"DateDiff({_L0}, o_orderdate, 'Hour')", f"CAST(floor(round_even({_us(_D0, _D)} / 1e6, 0) / 3600) AS INTEGER)"),
    ("fn_datediff_minute", "orders", f"DateDiff({_L0}, o_orderdate, 'Minute')", f"CAST(floor(round_even({_us(_D0, _D)} / 1e6, 0) / 60) AS INTEGER)"),
    ("fn_datediff_second", "orders", f"DateDiff({_L0}, o_orderdate, 'Second')", f"CAST(round_even({_us(_D0, _D)} / 1e6, 0) AS INTEGER)"),
    ("fn_datediff_millisecond", "orders", f"DateDiff({_L0}, o_orderdate, 'Millisecond')", f"CAST(floor({_us(_D0, _D)} / 1000.0) AS BIGINT)"),
    ("fn_datepart_year", "orders", "DatePart(o_orderdate, 'Year')", f"CAST(year({_D}) {_I32}"),
    ("fn_datepart_month", "orders", "DatePart(o_orderdate, 'Month')", f"CAST(month({_D}) {_I32}"),
    ("fn_datepart_dayofyear", "orders", "DatePart(o_orderdate, 'DayOfYear')", f"CAST(dayofyear({_D}) {_I32}"),
    ("fn_datepart_day", "orders", "DatePart(o_orderdate, 'Day')", f"CAST(day({_D}) {_I32}"),
    ("fn_datepart_week", "orders", "DatePart(o_orderdate, 'Week')", f"CAST(weekofyear({_D}) {_I32}"),
    ("fn_datepart_weekday", "orders", "DatePart(o_orderdate, 'WeekDay')", f"CAST(CASE WHEN dayofweek({_D}) = 0 THEN 8 ELSE dayofweek({_D}) + 1 END {_I32}"),
    ("fn_datepart_hour", "events", "DatePart(ts, 'Hour')", f"CAST(hour(ts) {_I32}"),
    ("fn_datepart_minute", "events", "DatePart(ts, 'Minute')", f"CAST(minute(ts) {_I32}"),
    ("fn_datepart_second", "events", "DatePart(ts, 'Second')", f"CAST(second(ts) {_I32}"),
    ("fn_datepart_millisecond", "events", "DatePart(ts, 'Millisecond')", f"CAST(epoch_us(ts) % 1000000 // 1000 {_I32}"),
    ("cmp_string_left", "part", "p_name > p_size", "upper(p_name) > CAST(p_size AS VARCHAR)"),
    ("cmp_nan", "part", "Sqrt(10 - p_size) > 1", "CASE WHEN 10 - p_size < 0 THEN false ELSE sqrt(10 - p_size) > 1 END"),
    ("op_divide_double_zero", "part", "(p_retailprice - 1000.0) / (p_size - p_size) > 0", "CASE WHEN p_retailprice > 1000 THEN true ELSE false END"),
)


# streams, joins and metadata


def _signal(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("user_id", "signalid")


def grouped_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    out = S.last_wins(e.select("hour", "user_id", "event_id", "value"), ["hour", "user_id"], "event_id")
    return out.select("hour", "user_id", "event_id", "value", "n_replaced")


def active_measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """suppliers as measurements, nations as devices, regions as phasors."""
    m, d, p = _metadata(spark, sf_dir)
    out = M.active_measurements(m, d, p)
    return out.select("ID", "SignalID", "Device", "DeviceID", "FramesPerSecond", "Protocol", "ProtocolType", "SignalType", "EngineeringUnits", "PhasorID", "PhasorType", "Adder", "Multiplier", "Subscribed")


def _metadata(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    s, n, r = (read(spark, sf_dir, t) for t in ("supplier", "nation", "region"))
    kinds = F.array(*[F.lit(x) for x in ("FREQ", "VPHM", "IPHA", "STAT")])
    protocols = F.array(*[F.lit(x) for x in ("Gateway", "IeeeC37_118V1", "DNP3", "Modbus/TCP")])
    m = s.select(
        F.concat(F.lit("PPA:"), F.col("s_suppkey").cast("string")).alias("ID"), F.lpad(F.col("s_suppkey").cast("string"), 12, "0").alias("SignalID"), F.col("s_name").alias("PointTag"),
        F.concat(F.lit("DEV"), F.col("s_nationkey").cast("string")).alias("DeviceAcronym"), F.concat(F.lit("DEV"), (F.col("s_nationkey") % 5).cast("string"), F.lit("-PA"), (F.col("s_suppkey") % 7).cast("string")).alias("SignalReference"),
        (F.col("s_suppkey") % 7).cast("int").alias("PhasorSourceIndex"), F.element_at(kinds, (F.col("s_suppkey") % 4 + 1).cast("int")).alias("SignalAcronym"), F.lit(True).alias("Internal"),
        F.when(F.col("s_suppkey") % 10 == 0, F.lit(False)).when(F.col("s_suppkey") % 10 != 1, F.lit(True)).alias("Enabled"), F.concat(F.lit("about "), "s_name").alias("Description"), F.lit(None).cast("timestamp_ntz").alias("UpdatedOn"), F.col("s_suppkey").alias(RID),
    )
    # nations above 20 have devices of other names
    d = n.select(
        F.lit("node").alias("NodeID"), F.concat(F.when(F.col("n_nationkey") <= 20, F.lit("DEV")).otherwise(F.lit("OTHER")), F.col("n_nationkey").cast("string")).alias("Acronym"), F.col("n_name").alias("Name"), F.col("n_nationkey").alias("AccessID"), F.when(F.col("n_regionkey") > 0, F.lit(60)).alias("FramesPerSecond"),
        F.element_at(protocols, (F.col("n_nationkey") % 4 + 1).cast("int")).alias("ProtocolName"), F.lit("C").alias("CompanyAcronym"), F.lit("V").alias("VendorAcronym"), F.lit("VD").alias("VendorDeviceName"), F.lit("").alias("ParentAcronym"), F.lit(0.0).alias("Longitude"), F.lit(0.0).alias("Latitude"), F.col("n_nationkey").cast("long").alias(RID),
    )
    p = r.select(F.col("r_regionkey").alias("ID"), F.concat(F.lit("DEV"), F.col("r_regionkey").cast("string")).alias("DeviceAcronym"), F.lit("V").alias("Type"), F.lit("A").alias("Phase"), F.col("r_regionkey").alias("SourceIndex"), F.col("r_regionkey").cast("long").alias(RID))
    return m, d, p


_META_SQL = """
m AS (SELECT 'PPA:' || s_suppkey AS ID, lpad(CAST(s_suppkey AS VARCHAR), 12, '0') AS SignalID, s_name AS PointTag, 'DEV' || s_nationkey AS DeviceAcronym,
  'DEV' || (s_nationkey % 5) || '-PA' || (s_suppkey % 7) AS SignalReference, s_suppkey % 7 AS psi, list_extract(['FREQ', 'VPHM', 'IPHA', 'STAT'], CAST(s_suppkey % 4 + 1 AS INTEGER)) AS SignalAcronym,
  CASE WHEN s_suppkey % 10 = 0 THEN false WHEN s_suppkey % 10 <> 1 THEN true END AS Enabled, s_suppkey, 'about ' || s_name AS Description FROM supplier),
d AS (SELECT CASE WHEN n_nationkey <= 20 THEN 'DEV' ELSE 'OTHER' END || n_nationkey AS Acronym, n_name AS Name, n_nationkey AS AccessID, CASE WHEN n_regionkey > 0 THEN 60 END AS fps, list_extract(['Gateway', 'IeeeC37_118V1', 'DNP3', 'Modbus/TCP'], n_nationkey % 4 + 1) AS protocol FROM nation),
p AS (SELECT r_regionkey AS ID, 'DEV' || r_regionkey AS DeviceAcronym, r_regionkey AS si FROM region)"""


def phasor_pair_assoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, _, p = _metadata(spark, sf_dir)
    # every other magnitude has a reference that no phasor has
    other = m.withColumn("SignalReference", F.replace("SignalReference", F.lit("-PA"), F.when(F.col(RID) % 2 == 0, F.lit("-PM")).otherwise(F.lit("-QM"))))
    both = m.unionByName(other.withColumn("SignalID", F.concat(F.lit("M"), "SignalID")))
    return M.phasor_pairs(p, both).select("ID", "angle_id", "magnitude_id")


def signal_index_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").withColumn("signal_index", F.col("user_id") % 100)
    # odd indexes are unknown
    cache = read(spark, sf_dir, "customer").select((F.col("c_custkey") * 2).alias("signal_index"), F.col("c_name").alias("signalid"))
    return S.indexed(e, cache, True).select("event_id", "signal_index", "signalid")


def flags_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("event_id", F.pmod(F.col("event_id") * 2654435761, F.lit(4294967296)).alias("flags"))
    e = e.withColumn("compact", S.to_compact(F.col("flags")).cast("int"))
    return e.withColumn("expanded", S.from_compact(F.col("compact")))


def union_all_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return data(spark, sf_dir, "customer", "part", "orders").row_counts()


def computed_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer").withColumn("ComputedCol", F.lit(None).cast("int").alias("ComputedCol", metadata=field("ComputedCol", "INT32", "IIf(c_nationkey > 20, NULL, c_nationkey + 2)").metadata))
    out = DataSet(spark)
    return out.add("customer", c, ["c_custkey"]).select("c_custkey", "ComputedCol")


def base_time_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("event_id", S.time_to_ticks(F.col("ts")).alias("ticks"))
    base = 638_396_640_000_000_000  # 2024-01-01
    return e.select("event_id", "ticks", S.time_offset(F.col("ticks"), (base, 0), 0).alias("t")).select("event_id", "ticks", F.col("t.size").alias("size"), F.col("t.value").alias("value"))


def lookup_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, _, _ = _metadata(spark, sf_dir)
    return M.lookup(m, "DeviceAcronym", "DEV3").select("ID", "PointTag")


def _e(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "events")


def _ntz(text: str) -> F.Column:
    return F.lit(text).cast("timestamp_ntz")


#: Name, query, DuckDB SQL.
OTHERS: tuple[tuple[str, Query, str], ...] = (
    ("filter_nonboolean_empty", lambda s, d: Q.select_rows(data(s, d, "customer"), "FILTER customer WHERE Len(c_name)", strict=False).drop(RID), "SELECT * FROM customer WHERE false"),
    ("project_signal_ids", lambda s, d: Q.select_signal_ids(data(s, d, "customer"), "FILTER customer WHERE c_nationkey < 3", "customer"), "SELECT DISTINCT lower(c_name) AS signal_id FROM customer WHERE c_nationkey < 3"),
    ("signal_id_set", lambda s, d: Q.select_signal_ids(data(s, d, "customer"), "{12345678-1234-1234-1234-123456789ABC}; \"Customer#000000009\"; c_nationkey = 2", "customer"), "SELECT '12345678-1234-1234-1234-123456789abc' AS signal_id UNION SELECT lower(c_name) FROM customer WHERE c_nationkey = 2 OR c_name = 'Customer#000000009'"),
    ("identifier_guid", lambda s, d: Q.select_signal_ids(data(s, d, "customer"), "12345678-1234-1234-1234-123456789ABC", "customer"), "SELECT '12345678-1234-1234-1234-123456789abc' AS signal_id"),
    ("identifier_key", lambda s, d: _by_key(s, d), "SELECT 'PPA:' || c_custkey AS ID, c_name FROM customer WHERE c_custkey = 12"),
    ("row_set", lambda s, d: Q.select_row_set(data(s, d, "customer"), "FILTER TOP 30 customer WHERE c_acctbal > 0 ORDER BY c_name; c_nationkey = 1", "customer").drop(RID), "SELECT * FROM customer WHERE c_nationkey = 1 OR c_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0 ORDER BY c_custkey LIMIT 30)"),
    ("union_without_key", lambda s, d: Q.select_rows(data(s, d, "lineitem"), "FILTER lineitem WHERE l_quantity < 3; l_linenumber = 7").select("l_orderkey", "l_linenumber", "l_quantity"), "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity < 3 OR l_linenumber = 7"),
    ("union_composite_key", lambda s, d: _by_two_keys(s, d), "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey < 50 OR o_orderkey % 10 = 3"),
    ("lookup_by_signal_id", lambda s, d: M.lookup(_metadata(s, d)[0], "SignalID", "000000000007").select("ID", "PointTag"), f"WITH {_META_SQL} SELECT ID, PointTag FROM m WHERE s_suppkey = 7"),
    ("lookup_by_key", lambda s, d: M.lookup(_metadata(s, d)[0], "ID", "PPA:8").select("ID", "PointTag"), f"WITH {_META_SQL} SELECT ID, PointTag FROM m WHERE s_suppkey = 8"),
    ("lookup_by_reference", lambda s, d: M.lookup(_metadata(s, d)[0], "SignalReference", "DEV2-PA3").select("ID", "PointTag"), f"WITH {_META_SQL} SELECT ID, PointTag FROM m WHERE SignalReference = 'DEV2-PA3' ORDER BY s_suppkey DESC LIMIT 1"),
    ("table_select", lambda s, d: data(s, d, "customer").select("customer", "c_nationkey = 4", "c_name DESC", 7).drop(RID), "SELECT * FROM customer WHERE c_nationkey = 4 ORDER BY c_custkey LIMIT 7"),
    ("rows_where", lambda s, d: data(s, d, "customer").rows_where("customer", F.col("c_acctbal") > 9000, 12).drop(RID), "SELECT * FROM customer WHERE c_acctbal > 9000 ORDER BY c_custkey LIMIT 12"),
    ("computed_column", computed_column, "SELECT c_custkey, CAST(CASE WHEN c_nationkey > 20 THEN 0 ELSE c_nationkey + 2 END AS INTEGER) AS ComputedCol FROM customer"),
    ("table_counts", union_all_counts, "SELECT 'customer' AS table_name, count(*) AS rows FROM customer UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'orders', count(*) FROM orders"),
    ("metadata_summary", lambda s, d: data(s, d, "nation", "region", "supplier").row_counts(), "SELECT 'nation' AS table_name, count(*) AS rows FROM nation UNION ALL SELECT 'region', count(*) FROM region UNION ALL SELECT 'supplier', count(*) FROM supplier"),
    ("total_received", lambda s, d: _e(s, d).agg(F.count(F.lit(1)).alias("total"), F.countDistinct("user_id").alias("signals")), "SELECT count(*) AS total, count(DISTINCT user_id) AS signals FROM events"),
    ("active_measurements", active_measurements, f"WITH {_META_SQL} SELECT m.ID, SignalID, m.DeviceAcronym AS Device, AccessID AS DeviceID, coalesce(fps, 30) AS FramesPerSecond, coalesce(protocol, '') AS Protocol, CASE WHEN upper(protocol) LIKE 'GATEWAY%' OR upper(protocol) LIKE 'MODBUS%' OR upper(protocol) LIKE 'DNP%' THEN 'Measurement' ELSE 'Frame' END AS ProtocolType, SignalAcronym AS SignalType, CASE SignalAcronym WHEN 'FREQ' THEN 'Hz' WHEN 'VPHM' THEN 'Volts' WHEN 'IPHA' THEN 'Degrees' ELSE '' END AS EngineeringUnits, p.ID AS PhasorID, CASE WHEN p.ID IS NOT NULL THEN 'V' END AS PhasorType, 0.0::DOUBLE AS Adder, 1.0::DOUBLE AS Multiplier, 0 AS Subscribed FROM m LEFT JOIN d ON m.DeviceAcronym = Acronym LEFT JOIN p ON m.DeviceAcronym = p.DeviceAcronym AND psi = si WHERE coalesce(Enabled, true)"),
    ("active_measurements_device_join", lambda s, d: M.joined_devices(*_metadata(s, d)[:2]).select("ID", "DeviceAcronym", "device_Name"), f"WITH {_META_SQL} SELECT ID, DeviceAcronym, Name AS device_Name FROM m LEFT JOIN d ON DeviceAcronym = Acronym"),
    ("active_measurements_phasor_join", lambda s, d: M.joined_phasors(_metadata(s, d)[0], _metadata(s, d)[2]).select("ID", "DeviceAcronym", "phasor_ID"), f"WITH {_META_SQL} SELECT m.ID, m.DeviceAcronym, p.ID AS phasor_ID FROM m LEFT JOIN p ON m.DeviceAcronym = p.DeviceAcronym AND psi = si"),
    ("measurement_device_assoc", lambda s, d: M.joined_devices(*_metadata(s, d)[:2]).groupBy("device_Acronym").agg(F.count(F.lit(1)).alias("n")), f"WITH {_META_SQL} SELECT Acronym AS device_Acronym, count(*) AS n FROM m LEFT JOIN d ON DeviceAcronym = Acronym GROUP BY Acronym"),
    ("phasor_pair_assoc", phasor_pair_assoc, f"WITH {_META_SQL}, a AS (SELECT SignalReference, arg_max(SignalID, s_suppkey) AS id FROM m GROUP BY 1), b AS (SELECT replace(SignalReference, '-PA', '-PM') AS SignalReference, arg_max('M' || SignalID, s_suppkey) AS id FROM m WHERE s_suppkey % 2 = 0 GROUP BY 1) SELECT p.ID, CASE WHEN b.id IS NOT NULL THEN a.id END AS angle_id, CASE WHEN a.id IS NOT NULL THEN b.id END AS magnitude_id FROM p LEFT JOIN a ON a.SignalReference = DeviceAcronym || '-PA' || si LEFT JOIN b ON b.SignalReference = DeviceAcronym || '-PM' || si"),
    ("route_measurements", lambda s, d: S.route(read(s, d, "orders").select(F.col("o_custkey").alias("signalid"), "o_orderkey"), read(s, d, "customer").where("c_nationkey < 5").select(F.col("c_custkey").alias("signalid"), F.col("c_nationkey").alias("connection"))), "SELECT o_custkey AS signalid, o_orderkey, c_nationkey AS connection FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey < 5"),
    ("replace_routes", lambda s, d: S.replace_routes(read(s, d, "customer").where("c_nationkey < 5").select(F.col("c_custkey").alias("signalid"), F.col("c_nationkey").cast("string").alias("connection")), "3", read(s, d, "customer").where("c_nationkey = 9").select(F.col("c_custkey").alias("signalid"))), "SELECT c_custkey AS signalid, CASE WHEN c_nationkey = 9 THEN '3' ELSE CAST(c_nationkey AS VARCHAR) END AS connection FROM customer WHERE c_nationkey IN (0, 1, 2, 4, 9)"),
    ("signal_index_lookup", signal_index_lookup, "SELECT event_id, user_id % 100 AS signal_index, coalesce(c_name, '00000000-0000-0000-0000-000000000000') AS signalid FROM events LEFT JOIN customer ON user_id % 100 = c_custkey * 2"),
    ("adjusted_value", lambda s, d: S.adjusted(_signal(_e(s, d)), read(s, d, "customer").select((F.col("c_custkey") * 2).alias("signalid"), F.col("c_nationkey").cast("double").alias("adder"), F.lit(2.0).alias("multiplier"))).select("event_id", "adjusted"), "SELECT event_id, value * CASE WHEN c_custkey IS NULL THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END + coalesce(c_nationkey, 0)::DOUBLE AS adjusted FROM events LEFT JOIN customer ON user_id = c_custkey * 2"),
    ("subscribe_semi_join", lambda s, d: S.subscribed(read(s, d, "orders"), Q.select_rows(data(s, d, "customer"), "FILTER customer WHERE c_mktsegment = 'building'").select("c_custkey"), "o_custkey").select("o_orderkey", "o_custkey"), "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"),
    ("avg_frequency_per_second", lambda s, d: S.windowed_average(_e(s, d), 10, 50, "1 hour").select("start", F.round("average", 6).alias("average"), "n"), "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, round(avg(CASE WHEN value BETWEEN 10 AND 50 THEN value END), 6) AS average, count(CASE WHEN value BETWEEN 10 AND 50 THEN 1 END) AS n FROM events GROUP BY 1"),
    ("downsampled_count", lambda s, d: S.down_sampled(_e(s, d).withColumn("ts", F.date_trunc("day", "ts").cast("timestamp_ntz")), 30, "ts", "user_id"), "SELECT date_trunc('day', ts)::TIMESTAMP AS second, CAST(count(*) - count(DISTINCT user_id) AS BIGINT) AS down_sampled FROM events GROUP BY 1"),
    ("tumbling_1s", lambda s, d: _e(s, d).select(S.second_of(F.col("ts")).alias("second")).groupBy("second").agg(F.count(F.lit(1)).alias("n")), "SELECT date_trunc('second', ts)::TIMESTAMP AS second, count(*) AS n FROM events GROUP BY 1"),
    ("tumbling_1h", lambda s, d: _e(s, d).groupBy(F.window("ts", "1 hour").alias("w")).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "n"), "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS start, count(*) AS n FROM events GROUP BY 1"),
    ("subsecond_align", lambda s, d: _e(s, d).select("event_id", S.frame_index(F.col("ts"), 30).alias("frame"), S.aligned(F.col("ts"), 30).alias("at")), "SELECT event_id, CAST(round_even((epoch_us(ts) % 1000000) * 30.0::DOUBLE / 1e6, 0) AS INTEGER) AS frame, make_timestamp(CAST(epoch_us(ts) // 1000000 * 1000000 + floor(round_even((epoch_us(ts) % 1000000) * 30.0::DOUBLE / 1e6, 0) * 10000000.0::DOUBLE / 30 / 10) AS BIGINT)) AS at FROM events"),
    ("grouped_last_wins", grouped_last_wins, "SELECT date_trunc('hour', ts)::TIMESTAMP AS hour, user_id, max(event_id) AS event_id, arg_max(value, event_id) AS value, count(*) - 1 AS n_replaced FROM events GROUP BY 1, 2"),
    ("lag_lead_filter", lambda s, d: S.reasonable(_e(s, d), _ntz("2024-01-10 00:00:00"), 86400, 3600).select("event_id"), "SELECT event_id FROM events WHERE date_trunc('second', ts) BETWEEN TIMESTAMP '2024-01-09' AND TIMESTAMP '2024-01-10 01:00:00'"),
    ("reasonability_filter", lambda s, d: S.reasonable(_e(s, d), _ntz("2024-01-10 00:00:00"), 10_000, 5_000, by_second=False).select("event_id"), "SELECT event_id FROM events WHERE epoch_us(TIMESTAMP '2024-01-10') - epoch_us(ts) BETWEEN -5000000000 AND 10000000000"),
    ("throttle_latest", lambda s, d: S.throttle(_e(s, d).select("user_id", "event_id", "ts", "value"), "1 day", "ts", "user_id", "event_id"), "SELECT time_bucket(INTERVAL 1 DAY, ts) AS interval_start, user_id, max(event_id) AS event_id, arg_max(ts, event_id) AS ts, arg_max(value, event_id) AS value FROM events GROUP BY 1, 2"),
    ("nan_filter", lambda s, d: S.without_nan(_e(s, d).withColumn("value", F.when(F.col("event_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("value")))).select("event_id", "value"), "SELECT event_id, value FROM events WHERE event_id % 7 <> 0"),
    ("temporal_range", lambda s, d: S.between(_e(s, d), _ntz("2024-01-05"), _ntz("2024-01-06 12:00:00")).select("event_id", "ts"), "SELECT event_id, ts FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-06 12:00:00'"),
    ("sequence_gaps", lambda s, d: S.sequence_gaps(_e(s, d).withColumn("sequence", F.expr("event_id + event_id div 11")), "sequence", "event_type").select("event_id", "event_type", "missing"), "SELECT event_id, event_type, missing FROM (SELECT event_id, event_type, n - lag(n) OVER (PARTITION BY event_type ORDER BY n) - 1 AS missing FROM (SELECT event_id, event_type, event_id + event_id // 11 AS n FROM events)) WHERE missing > 0"),
    ("in_sequence", lambda s, d: S.in_sequence(_e(s, d).selectExpr("event_id", "event_type as channel", "(event_id * 7919) % 50 as sequence"), "event_id"), "WITH n AS (SELECT event_id, event_type AS channel, (event_id * 7919) % 50 AS sequence FROM events), r AS (SELECT *, sum(CASE WHEN sequence = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY channel ORDER BY event_id) AS run FROM n), t AS (SELECT *, max(sequence) OVER (PARTITION BY channel, run ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM r) SELECT event_id, channel, sequence FROM t WHERE top IS NULL OR sequence > top"),
    ("dedupe_sequence", lambda s, d: S.dedupe_sequence(_e(s, d).select((F.col("event_id") % 1000).alias("sequence")), ["sequence"]), "SELECT DISTINCT event_id % 1000 AS sequence FROM events"),
    ("ordered_blocks", lambda s, d: S.ordered_blocks(_e(s, d).selectExpr("event_id % 3 as channel", "event_id div 3 + if(event_id >= 500 and event_id % 3 = 2, 1, 0) as sequence")), "SELECT channel, sequence FROM (SELECT channel, sequence, row_number() OVER (PARTITION BY channel ORDER BY sequence) - 1 AS n FROM (SELECT DISTINCT event_id % 3 AS channel, event_id // 3 + CASE WHEN event_id >= 500 AND event_id % 3 = 2 THEN 1 ELSE 0 END AS sequence FROM events)) WHERE n = sequence"),
    ("flags_compact", flags_compact, "SELECT event_id, flags, compact, CAST((compact & 1) * 252 | (compact & 2) // 2 * 61187 | (compact & 4) // 4 * 12517376 | (compact & 8) // 8 * 3758096384 | (compact & 16) // 16 * 4096 | (compact & 32) // 32 * 4194304 AS BIGINT) AS expanded FROM (SELECT event_id, flags, CAST(CAST(flags & 252 <> 0 AS INTEGER) + 2 * CAST(flags & 61187 <> 0 AS INTEGER) + 4 * CAST(flags & 12517376 <> 0 AS INTEGER) + 8 * CAST(flags & 3758096384 <> 0 AS INTEGER) + 16 * CAST(flags & 4096 <> 0 AS INTEGER) + 32 * CAST(flags & 4194304 <> 0 AS INTEGER) AS INTEGER) AS compact FROM (SELECT event_id, event_id * 2654435761 % 4294967296 AS flags FROM events))"),
    ("flags_quality_filter", lambda s, d: S.good_quality(_e(s, d).withColumn("flags", F.col("event_id") % 4)).select("event_id"), "SELECT event_id FROM events WHERE event_id % 4 = 0"),
    ("base_time_offset", base_time_offset, "SELECT event_id, ticks, CAST(CASE WHEN dt < 0 OR dt >= 4294967296 THEN 8 WHEN dt % 10000 = 0 AND dt // 10000 < 65536 THEN 2 ELSE 4 END AS INTEGER) AS size, CAST(CASE WHEN dt < 0 OR dt >= 4294967296 THEN ticks WHEN dt % 10000 = 0 AND dt // 10000 < 65536 THEN dt // 10000 ELSE dt END AS BIGINT) AS value FROM (SELECT event_id, epoch_us(ts) * 10 + 621355968000000000 AS ticks, epoch_us(ts) * 10 + 621355968000000000 - 638396640000000000 AS dt FROM events)"),
    ("ticks_round_trip", lambda s, d: _e(s, d).select("event_id", S.ticks_to_time(S.time_to_ticks(F.col("ts"))).alias("ts")), "SELECT event_id, ts FROM events"),
    ("protocol_type", lambda s, d: _metadata(s, d)[1].select("Acronym", M.protocol_type(F.col("ProtocolName")).alias("kind")), f"WITH {_META_SQL} SELECT Acronym, CASE WHEN upper(protocol) LIKE 'GATEWAY%' OR upper(protocol) LIKE 'MODBUS%' OR upper(protocol) LIKE 'DNP%' THEN 'Measurement' ELSE 'Frame' END AS kind FROM d"),
    ("engineering_units", lambda s, d: _metadata(s, d)[0].select("ID", M.engineering_units(F.col("SignalAcronym")).alias("units")), f"WITH {_META_SQL} SELECT ID, CASE SignalAcronym WHEN 'FREQ' THEN 'Hz' WHEN 'VPHM' THEN 'Volts' WHEN 'IPHA' THEN 'Degrees' ELSE '' END AS units FROM m"),
    ("filter_metadata", lambda s, d: M.filter_metadata(_metadata(s, d)[0], "SignalAcronym = 'freq' OR DeviceAcronym LIKE '%4'").select("ID", "Source", "Number"), f"WITH {_META_SQL} SELECT ID, 'PPA' AS Source, s_suppkey AS Number FROM m WHERE (SignalAcronym = 'FREQ' OR ends_with(DeviceAcronym, '4')) AND Enabled"),
    ("parse_measurement_key", lambda s, d: _e(s, d).select("event_id", F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("PPA:"), F.col("event_id").cast("string"))).when(F.col("event_id") % 3 == 1, F.lit("a:b:c")).otherwise(F.lit("X:y")).alias("k")).select("event_id", M.key_parts(F.col("k"))[0].alias("source"), M.key_parts(F.col("k"))[1].alias("id")), "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'PPA' ELSE '_' END AS source, CAST(CASE WHEN event_id % 3 = 0 THEN event_id ELSE 0 END AS BIGINT) AS id FROM events"),
    ("lookup_last_wins", lookup_last, f"WITH {_META_SQL} SELECT ID, PointTag FROM m WHERE DeviceAcronym = 'DEV3' ORDER BY s_suppkey DESC LIMIT 1"),
    ("find_by_signal_type", lambda s, d: M.find_by_signal_type(_metadata(s, d)[0], "vphm", "ppa").select("ID"), f"WITH {_META_SQL} SELECT ID FROM m WHERE SignalAcronym = 'VPHM'"),
    ("find_measurements", lambda s, d: M.find_measurements(_metadata(s, d)[0], "DEV2").select("ID"), f"WITH {_META_SQL} SELECT ID FROM m WHERE PointTag = 'DEV2' OR SignalReference = 'DEV2' OR contains(Description, 'DEV2') OR contains(DeviceAcronym, 'DEV2')"),
    ("find_devices", lambda s, d: M.find_devices(_metadata(s, d)[1], "AN").select("Acronym"), f"WITH {_META_SQL} SELECT Acronym FROM d WHERE contains(Name, 'AN') OR contains(Acronym, 'AN')"),
    ("signal_kind", lambda s, d: _kinds(s), "SELECT * FROM (VALUES ('PA', 'Angle', 'VPHA'), ('PM', 'Magnitude', 'VPHM'), ('FQ', 'Frequency', 'FREQ'), ('DF', 'DfDt', 'DFDT'), ('SF', 'Status', 'FLAG'), ('xx', 'Unknown', 'NULL')) t(acronym, kind, mnemonic)"),
    ("signal_type", lambda s, d: _metadata(s, d)[0].select("ID", M.signal_type(F.col("SignalAcronym")).alias("type")), f"WITH {_META_SQL} SELECT ID, CASE SignalAcronym WHEN 'FREQ' THEN 5 WHEN 'VPHM' THEN 3 WHEN 'IPHA' THEN 2 ELSE 11 END AS type FROM m"),
)


def _by_two_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = DataSet(spark)
    out.add("orders", read(spark, sf_dir, "orders"), ["o_custkey", "o_orderkey"])
    return Q.select_rows(out, "FILTER orders WHERE o_custkey < 50; o_orderkey % 10 = 3").select("o_orderkey", "o_custkey")


def _by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = DataSet(spark)
    c = read(spark, sf_dir, "customer")
    out.add("t", c.select(F.concat(F.lit("PPA:"), F.col("c_custkey").cast("string")).alias("ID"), "c_name", "c_custkey"), ["c_custkey"])
    return Q.select_rows(out, "ppa:12").select("ID", "c_name")


def _kinds(spark: SparkSession) -> DataFrame:
    df = spark.createDataFrame([(x,) for x in ("PA", "PM", "FQ", "DF", "SF", "xx")], "acronym string").withColumn("kind", M.signal_kind(F.col("acronym")))
    return df.withColumn("mnemonic", M.type_of_kind(F.col("kind"), F.lit("v")))


def _clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = DataSet(spark)
    return Q.evaluate(d, "Now() > #2000-01-01# AND UtcNow() > #2000-01-01#", "v")


QUERIES: dict[str, Query] = {
    **{name: rows(table, text) for name, table, text, _ in FILTERS},
    **{name: value(table, text) for name, table, text, _ in SCALARS},
    **{name: query for name, query, _ in OTHERS},
    "fn_now_utcnow": _clock,
}

ORACLES: dict[str, str] = {
    **{name: sql if sql.startswith("SELECT") else f"SELECT * FROM {table} WHERE {sql}" for name, table, _, sql in FILTERS},
    **{name: f"SELECT {', '.join(KEYS[table])}, {sql} AS v FROM {table}" for name, table, _, sql in SCALARS},
    **{name: sql for name, _, sql in OTHERS},
    "fn_now_utcnow": "SELECT true AS v",
}
