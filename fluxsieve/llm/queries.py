"""The queries of the training-data operators: each applies its operator with production parameters to
the whole table and returns every row of the result. ORACLES has DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from . import audio, covertree, lines, mixing, pieces, pii, quality, secrets, sharding, shingles
from .common import cut, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    out = sharding.shard(table(spark, sf_dir, "documents"), 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return quality.judge(table(spark, sf_dir, "documents"))


def op3_cover_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return covertree.near_duplicates(table(spark, sf_dir, "embeddings"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What SHARDS shards take of each document, by their quotas."""
    return mixing.mix(table(spark, sf_dir, "documents"), shards=mixing.SHARDS, whole=True).select("doc_id", "size", "source_size", "target", "taken")


def op5_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return audio.audio(table(spark, sf_dir, "documents"), digest=True)


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return pieces.encode(table(spark, sf_dir, "documents"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return pii.find(table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two scans of a history: the ledger of an earlier state, half of the versions, is written and read back, and the scan of the
    whole history takes only the blobs that it lacks."""
    docs = table(spark, sf_dir, "documents")
    ledger = cut(secrets.scan_versions(docs.where(F.xxhash64("text") < 0)))
    ledger = ledger.unionByName(cut(secrets.scan_versions(docs, ledger)))
    return secrets.digest(secrets.findings(docs, ledger))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_removed")


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    return shingles.join(table(spark, sf_dir, "documents"), 4, 85, 100).select("doc_id", "n_shingles", "component_id")


QUERIES: dict[str, Query] = {
    "op1_sharding": op1_sharding,
    "op2_quality": op2_quality,
    "op3_cover_tree": op3_cover_tree,
    "op4_mixing": op4_mixing,
    "op5_audio": op5_audio,
    "op6_pieces": op6_pieces,
    "op7_pii": op7_pii,
    "op8_secrets": op8_secrets,
    "op9_line_dedup": op9_line_dedup,
    "op10_ngram_join": op10_ngram_join,
}

ORACLES: dict[str, str] = {"op3_cover_tree": covertree.ORACLE, "op4_mixing": mixing.ORACLE, "op8_secrets": secrets.ORACLE, "op9_line_dedup": lines.ORACLE, "op10_ngram_join": shingles.ORACLE}
