"""Statements over data sets: filters with limits and order, identifiers, and their distinct union.

TOP takes the first rows in natural order before ORDER BY sorts them. Several statements give the distinct union of their
rows, those of identifiers first wherever they stand. All results are DataFrames; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.binder import Binder
from ..plans.syntax import Expression, Filter, Identifier, Order, parse
from ..plans.types import FilterError, V, value_type
from .dataset import RID, DataSet

ZERO_GUID = "00000000-0000-0000-0000-000000000000"


def order_value(df: DataFrame, o: Order) -> Column:
    """What an order term sorts by: true before false; text without regard to case unless exact."""
    f = {f.name.upper(): f for f in df.schema.fields}.get(o.column.upper())
    if f is None:
        raise FilterError(f"no column {o.column} to order by")
    kind, c = value_type(f), F.col(f"`{f.name}`")
    if kind == V.BOOLEAN:
        return ~c
    return F.upper(c) if kind == V.STRING and not o.exact else c


def directed(c: Column, o: Order) -> Column:
    """Nulls come first going up and last going down."""
    return c.desc_nulls_last() if o.descending else c.asc_nulls_first()


def run_filter(df: DataFrame, f: Filter, strict: bool = True, sort: bool = True, limit: bool = True) -> DataFrame:
    out = df.where(Binder(df).predicate(f.where, strict))
    if limit and f.top >= 0:
        out = out.orderBy(RID).limit(f.top)
    return out.orderBy(*[directed(order_value(df, o), o) for o in f.order], RID) if sort and f.order else out


def run_identifier(data: DataSet, table: str, i: Identifier) -> DataFrame:
    """The first row in natural order that the identifier names."""
    df, ids = data.table(table), data.ids(table)
    by = {"guid": ids.signal_id, "key": ids.key, "tag": ids.tag}[i.kind]
    name = {f.name.upper(): f.name for f in df.schema.fields}.get(by.upper())
    if name is None:
        raise FilterError(f"no column {by} to match {i.value}")
    hit = F.lower(f"`{name}`") == i.value if i.kind == "guid" else F.upper(f"`{name}`") == i.value.upper()
    return df.where(hit).orderBy(RID).limit(1)


def _table_of(statements: list, primary: str | None, data: DataSet) -> str:
    """The table that identifiers and bare expressions are about; the rows of one result must come from one table."""
    named = {s.table.upper() for s in statements if isinstance(s, Filter)}
    if primary is not None:
        named.add(primary.upper())
    if len(named) > 1:
        raise FilterError("statements about several tables have no common rows: " + ", ".join(sorted(named)))
    if named:
        return named.pop()
    if len(data.tables) == 1:
        return next(iter(data.tables))
    raise FilterError("a primary table is needed for identifiers and bare expressions")


def statement_count(text: str) -> int:
    return len(parse(text))


def select_rows(data: DataSet, text: str, primary: str | None = None, *, sort: bool = True, limit: bool = True, strict: bool = True, distinct: bool | None = None) -> DataFrame:
    """Rows in the order of the statements. One statement keeps what it finds; several give each row once."""
    statements = parse(text)
    if not statements:
        raise FilterError("an empty filter")
    table = _table_of(statements, primary, data)
    df = data.table(table)
    if len(statements) == 1:
        s = statements[0]
        if isinstance(s, Identifier):
            return run_identifier(data, table, s)
        return run_filter(df, s if isinstance(s, Filter) else Filter(table, s.root), strict, sort, limit)
    # identifiers come first; within a statement rows keep its order, by columns that are null for the others
    filters = {i: s if isinstance(s, Filter) else Filter(table, s.root) for i, s in enumerate(statements) if not isinstance(s, Identifier)}
    terms = [(i, f"_k{i}_{j}", o) for i, f in filters.items() for j, o in enumerate(f.order)] if sort else []
    parts = []
    for i, s in enumerate(statements):
        part = run_filter(df, filters[i], strict, False, limit) if i in filters else run_identifier(data, table, s)
        rank = i if i in filters else i - len(statements)
        keys = {k: order_value(df, o) if of == i else F.when(F.lit(False), order_value(df, o)) for of, k, o in terms}
        parts.append(part.withColumns({"_statement": F.lit(rank), **keys}))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    if distinct is not False:
        out = out.withColumn("_n", F.row_number().over(Window.partitionBy(RID).orderBy("_statement"))).where("_n = 1").drop("_n")
    return out.orderBy("_statement", *[directed(F.col(k), o) for _, k, o in terms], RID).drop("_statement", *[k for _, k, _ in terms])


def select_row_set(data: DataSet, text: str, primary: str | None = None, *, strict: bool = True) -> DataFrame:
    """Distinct rows, in no order; limits hold."""
    return select_rows(data, text, primary, sort=False, strict=strict).dropDuplicates([RID])


def select_signal_ids(data: DataSet, text: str, primary: str | None = None, *, strict: bool = True) -> DataFrame:
    """Distinct signal ids, not null and not zero, of all rows that the statements find; a GUID that stands as a statement
    is one of them whether the table has it or not. Column: signal_id."""
    statements = parse(text)
    table = _table_of(statements, primary, data)
    df, ids = data.table(table), data.ids(table)
    parts: list[DataFrame] = []
    literals: Sequence[str] = [s.value for s in statements if isinstance(s, Identifier) and s.kind == "guid"]
    if literals:
        parts.append(data.spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in literals])).alias("signal_id")))
    for s in statements:
        if isinstance(s, Identifier):
            if s.kind != "guid":
                parts.append(run_identifier(data, table, s).select(F.lower(f"`{ids.signal_id}`").alias("signal_id")))
        else:
            f = s if isinstance(s, Filter) else Filter(table, s.root)
            parts.append(run_filter(df, f, strict, False).select(F.lower(f"`{ids.signal_id}`").alias("signal_id")))
    if not parts:
        raise FilterError("an empty filter")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out.where(F.col("signal_id").isNotNull() & (F.col("signal_id") != ZERO_GUID)).distinct()


def evaluate_over(df: DataFrame, text: str, name: str = "value") -> DataFrame:
    """The value of the first statement's expression for every row, beside the natural order."""
    first = parse(text)[0]
    if not isinstance(first, Expression):
        raise FilterError("an expression is needed")
    keep = [RID] if RID in df.columns else []
    return df.select(*keep, Binder(df).bind(first.root).col.alias(name))


def evaluate(data: DataSet, text: str, name: str = "value") -> DataFrame:
    """The value of an expression without columns: one row."""
    first = parse(text)[0]
    if not isinstance(first, Expression):
        raise FilterError("an expression is needed")
    return data.spark.range(1).select(Binder(None).bind(first.root).col.alias(name))
