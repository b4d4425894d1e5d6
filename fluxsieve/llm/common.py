"""Shared helpers of the training-data operators: table access, lineage cuts, word rules."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_dir

#: ASCII white space that separates words, as a regular-expression class body.
SPACE = r"\x20\x09-\x0D"


CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Write df to the shared folder and read it back: later jobs neither recompute it nor
    depend on the executor that made it. The files go when the session's JVM ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    was = spark.conf.get(CLEAN, "false")
    spark.conf.set(CLEAN, "true")  # the shuffles of this job go when it ends: nothing reads them again
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(CLEAN, was)
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def uncut(df: DataFrame) -> None:
    """Remove the files of a table that cut() gave and nothing reads again."""
    for name in df.inputFiles()[:1]:
        where = df.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(name).getParent()
        where.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def word_count(text: Column) -> Column:
    """Number of maximal runs of non-space characters, as a long; null counts 0. Splitting at runs of
    space leaves one empty piece at either end that has space."""
    pieces = F.size(F.split(text, f"[{SPACE}]+")).cast("long")
    edges = text.rlike(rf"\A[{SPACE}]").cast("long") + text.rlike(rf"[{SPACE}]\z").cast("long")
    return F.when(text.isNull() | (text == ""), F.lit(0).cast("long")).otherwise(pieces - edges)


def utf8_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
