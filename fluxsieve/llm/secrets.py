"""Secret scans over an incremental blob ledger. Only DataFrame functions.

Every version of a path's text is addressed by its SHA-256. The ledger has a row for each (blob, rule
version) that was scanned, with what was found; only pairs that it lacks are scanned, each text once,
and findings are joined back to all paths whose text is that blob.

Places of matches: a text is split at the matches of a rule; the lengths of the pieces and matches,
summed in order, give code-point offsets. A text takes part in this only if the rule matches it at all.

Scale: the representative of a blob is found by an aggregate over (blob, path), so that copies are
combined before the shuffle and a blob that a third of all paths hold is one row; texts move once, keyed
by path, never by blob. Paths meet findings in a sort-merge join on the blob, which AQE splits where
one blob is hot.

Defined results: a null text is the empty text; an empty table gives no rows; equal texts give equal
findings; rows that repeat path and text are paths of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

RULES_VERSION = 1

#: Kind, pattern, group whose length is checked, least length. The runs of `access` and `hex`
#: are maximal, so that a least length within the pattern finds the same matches as a later check;
#: this is not so for `assign`, whose failing matches still use up their text. The last three go beyond the base kinds.
RULES: tuple[tuple[str, str, int, int], ...] = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
    ("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
    ("hosted", r"(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{20,})", 0, 1),
)
BASE = ("assign", "access", "hex")

FOUND = "array<struct<start:long,rank:int,kind:string,end:long>>"


def _at_least(n: int) -> Callable[[Column], Column]:
    return lambda x: x >= n


def _is(kind: str) -> Callable[[Column], Column]:
    return lambda x: x["kind"] == kind


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def scan(blobs: DataFrame, rules: tuple = RULES) -> DataFrame:
    """blobs(blob, text) -> (blob, found): only blobs with findings; found is in order of start, then rule."""
    text = F.col("text")
    per_rule = []
    for rank, (kind, pattern, group, least) in enumerate(rules):
        hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        kept = F.transform(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), lambda x: F.length(x)), _at_least(least))
        gaps = F.transform(F.split(text, pattern), lambda x: F.length(x))
        found = F.struct(
            F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
            F.arrays_zip(F.transform(hits, lambda x: F.length(x)).alias("len"), gaps.alias("gap"), kept.alias("ok")).alias("hits"),
        )
        per_rule.append(F.when(text.rlike(pattern), found))
    rows = blobs.select("blob", F.explode(F.filter(F.array(*per_rule), lambda x: x.isNotNull())).alias("r"))
    rows = rows.select("blob", "r.rank", "r.kind", F.posexplode("r.hits").alias("i", "h"))
    rows = rows.select("blob", "rank", "kind", "i", "h.len", "h.gap", "h.ok").where("len is not null").distinct()
    end = F.sum(F.col("len") + F.col("gap")).over(Window.partitionBy("blob", "rank").orderBy("i")).cast("long")
    rows = rows.withColumn("end", end).where("ok").withColumn("start", F.col("end") - F.col("len"))
    return rows.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "rank", "kind", "end"))).cast(FOUND).alias("found"))


def scan_versions(paths: DataFrame, ledger: DataFrame | None = None, version: int = RULES_VERSION, rules: tuple = RULES) -> DataFrame:
    """paths(doc_id, text, ...) and the ledger so far -> its new rows (blob, rule_version, found)."""
    key = F.coalesce("doc_id", F.xxhash64("text"))
    versions = paths.select(key.alias("key"), "text", blob_of(F.col("text")).alias("blob"))
    unseen = versions.groupBy("blob").agg(F.min("key").alias("key"))
    if ledger is not None:
        unseen = unseen.join(ledger.where(F.col("rule_version") == version), "blob", "left_anti")
    unseen = cut(unseen)
    texts = versions.join(unseen.hint("shuffle_hash"), ["key", "blob"]).select("blob", F.coalesce("text", F.lit("")).alias("text"))
    found = scan(texts, rules)
    return unseen.join(found, "blob", "left").select("blob", F.lit(version).alias("rule_version"), F.coalesce("found", F.array().cast(FOUND)).alias("found"))


def findings(paths: DataFrame, ledger: DataFrame, version: int = RULES_VERSION) -> DataFrame:
    """-> (doc_id, found) for every path; ledger must hold all their blobs at this version. Blobs without
    findings don't take part in the join."""
    found = ledger.where((F.col("rule_version") == version) & (F.size("found") > 0)).select("blob", "found")
    all_paths = paths.select("doc_id", blob_of(F.col("text")).alias("blob"))
    return all_paths.join(found, "blob", "left").select("doc_id", F.coalesce("found", F.array().cast(FOUND)).alias("found"))


def joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(rows: DataFrame) -> DataFrame:
    """(doc_id, found) -> counts of the base kinds, their digest, and all spans as text."""
    base = F.filter("found", lambda x: x["kind"].isin(*BASE))
    counts = [F.size(F.filter("found", _is(k))).cast("long").alias(f"n_{k}") for k in BASE]
    return rows.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def _oracle() -> str:
    parts = []
    for rank, (kind, pattern, group, least) in enumerate(RULES):
        p = "'" + pattern.replace("'", "''") + "'"
        parts.append(
            f"SELECT doc, {rank} AS rank, '{kind}' AS kind, i, len(regexp_extract_all(t, {p})[i]) AS n,"
            f" list_sum(list_transform(regexp_split_to_array(t, {p})[1:i], lambda x: len(x))) + list_sum(list_transform(regexp_extract_all(t, {p})[1:i], lambda x: len(x))) AS e"
            f" FROM d, range(1, len(regexp_extract_all(t, {p})) + 1) g(i) WHERE len(regexp_extract_all(t, {p}, {group})[i]) >= {least}"
        )
    base = "kind IN ('assign', 'access', 'hex')"
    span = "kind || ':' || CAST(CAST(e AS BIGINT) - n AS VARCHAR) || ':' || CAST(CAST(e AS BIGINT) AS VARCHAR)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS doc, doc_id, coalesce(text, '') AS t FROM documents),
f AS ({" UNION ALL ".join(parts)})
SELECT any_value(d.doc_id) AS doc_id,
  {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)},
  sha256(coalesce(string_agg({span}, ',' ORDER BY e - n, rank) FILTER ({base}), '')) AS base_sha256,
  coalesce(string_agg({span}, ',' ORDER BY e - n, rank) FILTER (kind IS NOT NULL), '') AS spans
FROM d LEFT JOIN f ON d.doc = f.doc GROUP BY d.doc"""


ORACLE = _oracle()
