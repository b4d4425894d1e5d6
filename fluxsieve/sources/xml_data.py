"""XML data sets: an inline XSD schema, then the records of all tables."""

from __future__ import annotations

import datetime as dt
import decimal
import gzip
import xml.etree.ElementTree as ET

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dataset import RID, DataSet, compute_columns, field
from ..plans.syntax import date
from ..plans.types import COLUMN_TYPES, FilterError

XSD = "http://www.w3.org/2001/XMLSchema"
EXT = "urn:schemas-microsoft-com:xml-msdata"
_BY_XSD = {xsd: kind for kind, (xsd, *_) in COLUMN_TYPES.items() if kind != "GUID"}


def schema_of(root: ET.Element) -> dict[str, list[T.StructField]]:
    """Table name -> fields, from the schema within a document; columns of unknown types are left out."""
    schema = root.find(f"{{{XSD}}}schema")
    if schema is None:
        raise FilterError("the document has no schema")
    tables: dict[str, list[T.StructField]] = {}
    for element in schema.iterfind(f".//{{{XSD}}}element/{{{XSD}}}complexType/{{{XSD}}}choice/{{{XSD}}}element"):
        fields = []
        for c in element.iterfind(f".//{{{XSD}}}sequence/{{{XSD}}}element"):
            xsd = c.get("type", "").rpartition(":")[2]
            kind = "GUID" if xsd == "string" and "System.Guid" in c.get(f"{{{EXT}}}DataType", "") else _BY_XSD.get(xsd)
            if kind:
                fields.append(field(c.get("name"), kind, c.get(f"{{{EXT}}}Expression")))
        tables[element.get("name")] = fields
    return tables


def _value(text: str | None, kind: str) -> object:
    """A present element: empty is the type's default."""
    t = COLUMN_TYPES[kind][1]
    text = text or ""
    if not text.strip() and kind != "STRING":
        return dt.datetime(1, 1, 1) if kind == "DATETIME" else t.fromInternal(COLUMN_TYPES[kind][3]) if not isinstance(t, T.DecimalType) else decimal.Decimal(0)
    if kind == "STRING":
        return text
    if kind == "BOOLEAN":
        return text.strip().lower() in ("true", "1")
    if kind == "DATETIME":
        return date(text)
    if kind == "GUID":
        return text.strip().strip("{}").lower()
    if isinstance(t, T.DecimalType):
        return decimal.Decimal(text.strip())
    return float(text) if isinstance(t, (T.FloatType, T.DoubleType)) else int(text)


def read_xml(spark: SparkSession, data: str | bytes, name: str = "DataSet") -> DataSet:
    """A document that fits in the driver, such as device metadata; gzipped bytes are unpacked. A missing element is null."""
    if isinstance(data, bytes):
        data = (gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data).decode("utf-8-sig")
    try:
        root = ET.fromstring(data)
    except ET.ParseError as e:
        raise FilterError(f"not XML: {e}") from e
    out = DataSet(spark, root.tag.rpartition("}")[2] or name)
    for table, fields in schema_of(root).items():
        rows = []
        for record in root.iterfind(table):
            have = {e.tag: e for e in record}
            rows.append([_value(have[f.name].text, f.metadata["column_type"]) if f.name in have and not f.metadata.get("expression") else None for f in fields])
        out.create(table, fields, rows)
    return out


def scan_xml(spark: SparkSession, path: str, table: str, fields: list[T.StructField]) -> DataFrame:
    """The records of one table in files of any size, read on the executors with a declared schema."""
    stored = [f for f in fields if not (f.metadata or {}).get("expression")]
    df = spark.read.format("xml").option("rowTag", table).schema(T.StructType(stored)).load(path)
    made = df.select(*[F.col(f"`{f.name}`").alias(f.name, metadata=f.metadata) for f in stored])
    for f in fields:
        if (f.metadata or {}).get("expression"):
            made = made.withColumn(f.name, F.lit(None).cast(f.dataType).alias(f.name, metadata=f.metadata))
    return compute_columns(made)


def _written(v: object) -> str:
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, dt.datetime):
        return v.isoformat(timespec="milliseconds")[:-1]
    return str(v)


def write_xml(data: DataSet, name: str | None = None) -> str:
    """The data set as one document with its schema; nulls and computed columns are left out. For sets that fit in the driver;
    larger tables are written by write_table."""
    name = name or data.name
    ET.register_namespace("xs", XSD)
    ET.register_namespace("ext", EXT)
    root = ET.Element(name)
    schema = ET.SubElement(root, f"{{{XSD}}}schema", {"id": name})
    choice = ET.SubElement(ET.SubElement(ET.SubElement(schema, f"{{{XSD}}}element", {"name": name}), f"{{{XSD}}}complexType"), f"{{{XSD}}}choice", {"minOccurs": "0", "maxOccurs": "unbounded"})
    for table, df, _ in data.tables.values():
        sequence = ET.SubElement(ET.SubElement(ET.SubElement(choice, f"{{{XSD}}}element", {"name": table}), f"{{{XSD}}}complexType"), f"{{{XSD}}}sequence")
        for f in df.schema.fields:
            if f.name == RID:
                continue
            kind = (f.metadata or {}).get("column_type") or next((k for k, v in COLUMN_TYPES.items() if v[1] == f.dataType), "STRING")
            attributes = {"name": f.name, "type": f"xs:{COLUMN_TYPES[kind][0]}", "minOccurs": "0"}
            if kind == "GUID":
                attributes[f"{{{EXT}}}DataType"] = "System.Guid"
            if (f.metadata or {}).get("expression"):
                attributes[f"{{{EXT}}}Expression"] = f.metadata["expression"]
            ET.SubElement(sequence, f"{{{XSD}}}element", attributes)
    for table, df, _ in data.tables.values():
        stored = [f.name for f in df.schema.fields if f.name != RID and not (f.metadata or {}).get("expression")]
        for row in df.orderBy(RID).select(*stored).toLocalIterator():
            record = ET.SubElement(root, table)
            for c in stored:
                if row[c] is not None:
                    ET.SubElement(record, c).text = _written(row[c])
    return '<?xml version="1.0" encoding="utf-8"?>\n' + ET.tostring(root, encoding="unicode")


def write_table(df: DataFrame, path: str, table: str, root: str = "DataSet") -> None:
    """One table of any size, by the executors."""
    stored = [f.name for f in df.schema.fields if f.name != RID and not (f.metadata or {}).get("expression")]
    df.select(*stored).write.format("xml").option("rowTag", table).option("rootTag", root).mode("overwrite").save(path)
