"""Data sets: named tables with a natural order, id fields and computed columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.base import convert
from ..plans.binder import Binder
from ..plans.syntax import Expression, parse
from ..plans.types import COLUMN_TYPES, SPARK, FilterError, value_type

#: The hidden column that gives the natural order of rows.
RID = "_rid"


@dataclass(frozen=True)
class IdFields:
    """Columns that identifiers are matched against."""

    signal_id: str = "SignalID"
    key: str = "ID"
    tag: str = "PointTag"


def field(name: str, kind: str, computed: str | None = None) -> T.StructField:
    """A column of one of the 15 column types."""
    if kind not in COLUMN_TYPES:
        raise FilterError(f"no column type {kind}")
    meta = {"column_type": kind} | ({"logical": "guid"} if kind == "GUID" else {}) | ({"expression": computed} if computed else {})
    return T.StructField(name, COLUMN_TYPES[kind][1], True, meta)


def with_order(df: DataFrame, key: Sequence[str] = ()) -> DataFrame:
    """Adds the natural order. With a unique integer key that is the key itself, else a struct of the key columns; without any
    key, the place of a row in its source, which holds as long as the source's files do."""
    if RID in df.columns:
        return df
    if len(key) == 1 and isinstance(df.schema[key[0]].dataType, (T.LongType, T.IntegerType)):
        return df.withColumn(RID, F.col(key[0]).cast("long"))
    if key:
        return df.withColumn(RID, F.struct(*key))
    return df.withColumn(RID, F.monotonically_increasing_id())


def compute_columns(df: DataFrame) -> DataFrame:
    """Fills columns whose field metadata has an expression; one that comes out null gets its type's default."""
    for f in df.schema.fields:
        text = (f.metadata or {}).get("expression")
        if text:
            df = df.withColumn(f.name, computed(df, text, f).alias(f.name, metadata=f.metadata))
    return df


def computed(df: DataFrame, text: str, f: T.StructField) -> Column:
    statements = parse(text)
    if len(statements) != 1 or not isinstance(statements[0], Expression):
        raise FilterError(f"a computed column needs one expression: {text!r}")
    value = convert(Binder(df).bind(statements[0].root), value_type(f))
    default = COLUMN_TYPES[(f.metadata or {}).get("column_type", "STRING")][3]
    stored = value.col.try_cast(f.dataType)
    return F.coalesce(stored, F.lit(default).cast(f.dataType)) if default is not None else stored


class DataSet:
    """Tables by name, without regard to case."""

    def __init__(self, spark: SparkSession, name: str = "DataSet"):
        self.spark, self.name = spark, name
        self.tables: dict[str, tuple[str, DataFrame, IdFields]] = {}

    def add(self, name: str, df: DataFrame, key: Sequence[str] = (), ids: IdFields = IdFields()) -> DataFrame:  # noqa: B008
        df = with_order(compute_columns(df), key)
        self.tables[name.upper()] = (name, df, ids)
        return df

    def create(self, name: str, fields: Sequence[T.StructField], rows: Sequence[Sequence] = (), ids: IdFields = IdFields()) -> DataFrame:  # noqa: B008
        """A table from rows, in their order."""
        schema = T.StructType([*fields, T.StructField(RID, T.LongType())])
        return self.add(name, self.spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], schema), ids=ids)

    def clone_structure(self, name: str, new: str) -> DataFrame:
        df, ids = self.table(name), self.ids(name)
        return self.add(new, self.spark.createDataFrame([], df.schema), ids=ids)

    def remove(self, name: str) -> bool:
        return self.tables.pop(name.upper(), None) is not None

    def clear(self) -> None:
        self.tables.clear()

    def table(self, name: str) -> DataFrame:
        if name.upper() not in self.tables:
            raise FilterError(f"no table {name}")
        return self.tables[name.upper()][1]

    def ids(self, name: str) -> IdFields:
        return self.tables[name.upper()][2]

    def names(self) -> list[str]:
        return [n for n, _, _ in self.tables.values()]

    def row_counts(self) -> DataFrame:
        """Rows of each table: (table_name, rows)."""
        counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, df, _ in self.tables.values()]
        out = counts[0]
        for c in counts[1:]:
            out = out.unionAll(c)
        return out

    def rows_where(self, name: str, condition: Column | Callable[[DataFrame], DataFrame], limit: int = -1) -> DataFrame:
        """Rows that meet a condition in natural order, `limit` at most; a condition is a column, or a function of the table."""
        df = self.table(name)
        df = condition(df) if callable(condition) else df.where(condition)
        return df.orderBy(RID).limit(limit) if limit >= 0 else df

    def select(self, name: str, expression: str = "", sort: str = "", limit: int = 0) -> DataFrame:
        """An empty expression selects all rows, and so does a limit of 0 or less."""
        from .statements import select_rows

        top = f"TOP {limit} " if limit > 0 else ""
        order = f" ORDER BY {sort}" if sort else ""
        return select_rows(self, f"FILTER {top}[{self.tables[name.upper()][0]}] WHERE {expression or 'True'}{order}")


def widen(df: DataFrame) -> DataFrame:
    """Every column in its value type."""
    b = Binder(df)
    return df.select(*[b.column(f.name).col.cast(SPARK[value_type(f)]).alias(f.name) for f in df.schema.fields])
