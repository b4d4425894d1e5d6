"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Only DataFrame functions. The words of a source form one line, its documents in seeded order; the line
is cut into blocks of equal size. Highest quotients give every source an integer quota of blocks for
each shard of the mix, and an arc of blocks from a seeded place takes that many. A source that
needs more than it has goes round again, so a document is taken up to ceil(target / size) times.

Scale: rows move once, keyed by (source, slice of the seeded order), so a source that holds a third of
all rows is spread over many tasks. Positions are a sum within a slice plus the sum of slices before.
What is kept per source (a row each) is small whatever the number of documents.

Defined results: null texts and null sources are kept (size 0, source ordered last); an empty table
gives no rows; repeated rows are documents of their own; other columns are carried or ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, cut, word_count

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (5.0, 2.0, 1.0)
BLOCK = 16
SEED = 20240917
#: Shards of the registered mix.
SHARDS = 8
#: Slices of a source's seeded order: at least this many, and one for each ROWS documents of a table.
SLICES, ROWS = 64, 50_000


def source_targets(sizes: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple = WEIGHTS) -> DataFrame:
    """sizes(source, size) -> (source, source_size, weight, target): share times all words are dealt out
    by weight; no source gets over `most` times its size, what is over goes to the others by weight.

    With the sources in order of size over weight the first k are capped; the level is the highest
    that any k gives. One row a source, in one window."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    per = per.withColumn("k", (rank - 1) % len(weights)).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("k") + 1).cast("int"))
    )
    by_level = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    upto = by_level.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.partitionBy()
    per = (
        per.withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("all_w", F.sum("weight").over(everything))
        .withColumn("cap", F.lit(float(most)) * F.col("source_size"))
        .withColumn("cap_before", F.sum("cap").over(upto) - F.col("cap"))
        .withColumn("w_before", F.sum("weight").over(upto) - F.col("weight"))
        .withColumn("level", (F.lit(float(share)) * F.col("total") - F.col("cap_before")) / (F.col("all_w") - F.col("w_before")))
        .withColumn("level", F.max("level").over(everything))
    )
    return per.select("source", "source_size", "weight", F.least("cap", F.col("level") * F.col("weight")).alias("target"))


def block_quotas(targets: DataFrame, block: int = BLOCK, shards: int = 1) -> DataFrame:
    """targets(source, target) -> (source, shard, quota, first): Sainte-Lague quotas. The first s of
    `shards` shards together get round(s / shards * all / block) blocks; as more blocks never cost a source one,
    differences are the quotas of a shard. `first` counts the source's blocks in the shards before.

    A divisor below or above the right one brackets every source's quota to within the number of sources,
    so that only the quotients in between are ranked: two rows a source on average."""
    everything = Window.partitionBy("shard")
    m, v = F.count(F.lit(1)).over(everything), F.sum("target").over(everything)
    t = targets.withColumn("shard", F.explode(F.sequence(F.lit(1), F.lit(shards))))
    t = t.withColumn("v", v).withColumn("m", m)
    t = t.withColumn("seats", F.floor(F.col("shard") * F.col("v") / (block * shards) + 0.5))

    def at(seats: Column) -> Column:
        return F.when((seats > 0) & (F.col("v") > 0), F.floor(F.col("target") * seats / F.col("v") + 0.5)).otherwise(F.lit(0))

    t = t.withColumn("low", at(F.col("seats") - F.ceil(F.col("m") / 2) - 1)).withColumn("high", at(F.col("seats") + F.ceil(F.col("m") / 2) + 1))
    left = (F.col("seats") - F.sum("low").over(everything)).alias("left")
    open_ = t.select("source", "shard", "target", "low", "high", left).where("high > low")
    tries = open_.select("source", "shard", "left", "target", F.explode(F.sequence(F.col("low") + 1, F.col("high"))).alias("q"))
    best = Window.partitionBy("shard").orderBy((F.col("target") / (2 * F.col("q") - 1)).desc(), F.col("source").asc_nulls_last(), "q")
    won = tries.withColumn("rank", F.row_number().over(best)).where("rank <= left")
    won = won.groupBy(F.col("source").alias("of"), F.col("shard").alias("of_shard")).agg(F.count(F.lit(1)).alias("more"))
    held = t.join(won, F.col("source").eqNullSafe(F.col("of")) & (F.col("shard") == F.col("of_shard")), "left")
    held = held.select("source", "shard", (F.col("low") + F.coalesce("more", F.lit(0))).alias("held"))
    before = F.coalesce(F.lag("held").over(Window.partitionBy("source").orderBy("shard")), F.lit(0).cast("long"))
    return held.select("source", (F.col("shard") - 1).alias("shard"), (F.col("held") - before).alias("quota"), before.alias("first"))


def mix(docs: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple = WEIGHTS, block: int = BLOCK, seed: int = SEED, shards: int = 1, carry: bool = False, whole: bool = False) -> DataFrame:
    """docs(doc_id, text, source, ...) -> doc_id, size, source_size, target, taken, quota (blocks of its
    source), start (its place on the source's line), shard, and with carry all columns of docs, as `row`. With several shards a
    document has a row for each that takes of it, in order of the blocks of the arc, or one without a shard; with whole one row, and
    `parts` says what each shard takes. Order keys hash seed, doc_id and text: reruns agree,
    and rows that tie are copies of one another."""
    more = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    base = docs.select(
        *more, "doc_id", "source", word_count(F.col("text")).alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce("text", F.lit(""))))).alias("order"),
    )
    slim = cut(base.drop("row"))
    base = base if carry else slim
    targets = source_targets(slim.select("source", "size"), share, most, weights)
    dealt = F.array_sort(F.collect_list(F.struct("shard", "first", (F.col("first") + F.col("quota")).alias("upto")))).alias("dealt")
    quotas = block_quotas(targets, block, shards).groupBy(F.col("source").alias("of")).agg(F.sum("quota").alias("quota"), *([dealt] if shards > 1 else []))
    plan = targets.join(quotas, F.col("source").eqNullSafe(F.col("of"))).select("of", "source_size", "target", *quotas.columns[1:])

    slices = max(SLICES, slim.count() // ROWS)
    place = F.floor(F.conv(F.substring("order", 1, 8), 16, 10).cast("double") * slices / float(1 << 32))
    base, slim = base.withColumn("slice", place), slim.withColumn("slice", place)
    sums = slim.groupBy(F.col("source").alias("in_source"), F.col("slice").alias("in_slice")).agg(F.sum("size").alias("sum"))
    ahead = Window.partitionBy("in_source").orderBy("in_slice")
    sums = sums.withColumn("ahead", F.sum("sum").over(ahead) - F.col("sum")).drop("sum")
    per = sums.join(plan, F.col("in_source").eqNullSafe(F.col("of"))).drop("of")
    within = Window.partitionBy("source", "slice").orderBy("order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = base.withColumn("upto", F.sum("size").over(within))
    rows = rows.join(per, F.col("source").eqNullSafe(F.col("in_source")) & (F.col("slice") == F.col("in_slice")))
    rows = rows.withColumn("end", F.col("ahead") + F.col("upto")).withColumn("start", F.col("end") - F.col("size"))

    # whole rounds take every block once; the rest are the blocks of an arc from a seeded place, so that few documents are cut
    rows = rows.withColumn("blocks", F.ceil(F.col("source_size") / block))
    rows = rows.withColumn("quota", F.least("quota", F.floor(F.lit(float(most)) * F.col("blocks"))))
    at_least_1 = F.greatest("blocks", F.lit(1).cast("long"))
    draw = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}#"), F.coalesce("source", F.lit("")))), 1, 8), 16, 10).cast("long")
    rows = rows.withColumn("from", F.pmod(draw, at_least_1))

    def overlap(first: Column, last: Column) -> Column:
        return F.greatest(F.least("end", last * block) - F.greatest("start", first * block), F.lit(0).cast("long"))

    def words(place: Column, number: Column) -> Column:
        """What `number` blocks from a place on, round and round, have of the document."""
        to = place + number % at_least_1
        arc = overlap(place, F.least(to, F.col("blocks"))) + overlap(F.lit(0).cast("long"), F.greatest(to - F.col("blocks"), F.lit(0).cast("long")))
        return (F.col("size") * F.floor(number / at_least_1) + arc).cast("long")

    def part(x: Column) -> Column:
        first, upto = F.least(x["first"], "quota"), F.least(x["upto"], "quota")
        return F.struct(x["shard"].cast("int").alias("shard"), words(F.pmod(F.col("from") + first, at_least_1), upto - first).alias("taken"))

    if shards > 1:
        rows = rows.withColumn("parts", F.filter(F.transform("dealt", part), lambda x: x["taken"] > 0))
        if whole:
            taken = F.aggregate("parts", F.lit(0).cast("long"), lambda n, x: n + x["taken"])
            return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "quota", "start", "parts", *(["row"] if carry else []))
        rows = rows.withColumn("part", F.explode_outer("parts"))
        shard, taken = F.col("part.shard"), F.coalesce("part.taken", F.lit(0).cast("long"))
    else:
        shard, taken = F.lit(0), words(F.col("from"), F.col("quota"))
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "quota", "start", shard.alias("shard"), *(["row"] if carry else []))


def mixed(docs: DataFrame, **options: float) -> DataFrame:
    """The mix itself, with the columns of docs: a document comes as often as it is taken whole, and once more, cut to its
    first words, for what is taken of it beyond that; with several shards in each of them, which is added as `shard`."""
    rows = mix(docs, carry=True, **options)
    whole = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.greatest("size", F.lit(1).cast("long")))).otherwise(F.lit(0)).cast("int")
    rows = rows.withColumn("whole", whole).withColumn("part", (F.col("taken") - F.col("whole") * F.col("size")).cast("int"))
    first = F.array_join(F.slice(F.regexp_extract_all(F.col("row.text"), F.lit(f"[^{SPACE}]+"), F.lit(0)), F.lit(1), F.col("part")), " ")
    texts = F.concat(F.when(F.col("whole") > 0, F.array_repeat(F.col("row.text"), F.col("whole"))).otherwise(F.array().cast("array<string>")), F.when(F.col("part") > 0, F.array(first)).otherwise(F.array().cast("array<string>")))
    out = rows.select("row", "shard", F.explode(texts).alias("taken_text"))
    keep = {"text": F.col("taken_text"), "n_chars": F.length("taken_text").cast("long")}
    more = ["shard"] if options.get("shards", 1) > 1 else []
    return out.select(*[keep.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns], *more)


#: The same figures in plain SQL: quotas by ranking every quotient, places by one running sum a source.
ORACLE = rf"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5('{SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS ord
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM s),
l AS (SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(2.0::DOUBLE * source_size) OVER b, 0)) / ((sum(weight) OVER ()) - coalesce(sum(weight) OVER b, 0)) AS lv
      FROM w WINDOW b AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, least(2.0::DOUBLE * source_size, (max(lv) OVER ()) * weight) AS target FROM l),
q AS (SELECT source, k, target / (2 * k - 1) AS quotient FROM t, range(1, CAST(floor(target / {BLOCK}) AS BIGINT) + 1000) g(k) WHERE target > 0),
r AS (SELECT source, row_number() OVER (ORDER BY quotient DESC, source NULLS LAST, k) AS rank FROM q),
h AS (SELECT source, count(*) AS quota FROM r WHERE rank <= (SELECT floor(sum(target) / {BLOCK} + 0.5) FROM t) GROUP BY source),
p AS (SELECT t.source, t.source_size, t.target, CAST(ceil(t.source_size / {BLOCK}) AS BIGINT) AS blocks,
             least(coalesce(h.quota, 0), 2 * CAST(ceil(t.source_size / {BLOCK}) AS BIGINT)) AS quota,
             CAST('0x' || substr(md5('{SEED}#' || coalesce(t.source, '')), 1, 8) AS BIGINT) AS draw
      FROM t LEFT JOIN h ON t.source IS NOT DISTINCT FROM h.source),
a AS (SELECT *, quota // greatest(blocks, 1) AS rounds, draw % greatest(blocks, 1) AS lo, draw % greatest(blocks, 1) + quota % greatest(blocks, 1) AS hi FROM p),
z AS (SELECT d.*, CAST(sum(size) OVER (PARTITION BY source ORDER BY ord ROWS UNBOUNDED PRECEDING) AS BIGINT) AS e FROM d)
SELECT z.doc_id, z.size, a.source_size, a.target,
  CAST(z.size * rounds + greatest(least(e, least(hi, blocks) * {BLOCK}) - greatest(e - z.size, lo * {BLOCK}), 0)
       + greatest(least(e, greatest(hi - blocks, 0) * {BLOCK}) - (e - z.size), 0) AS BIGINT) AS taken
FROM z JOIN a ON z.source IS NOT DISTINCT FROM a.source
"""
