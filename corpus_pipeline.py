"""The corpus pipeline: quality, line dedup, near copies, source mix, sampled pieces.

Each stage takes (spark, docs, sf_dir) and calls one operator of fluxsieve.llm on all that the stage before kept;
all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxsieve.llm import lines, mixing, pieces, quality, shingles
from fluxsieve.llm.common import cut, table
from fluxsieve.session import ship

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    ship(spark)
    return quality.keep_good(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that match an earlier line go, however short; every document stays, if only with an empty text."""
    out = lines.dedup(docs, least=1).withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long"))
    return out.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five words, a similarity of 0.8."""
    ship(spark)
    return shingles.keep_one(docs, 5, 80, 100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document comes as often as the mix takes it."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled segmentations of every document of the mix."""
    ship(spark)
    return pieces.encode(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", keep_good),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources to target weights", mix_sources),
    ("SentencePiece encoding and decoding", encode),
]

#: The learnt scorer and the sampled lattice can't be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
