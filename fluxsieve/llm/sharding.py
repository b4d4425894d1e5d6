"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

Rows with equal texts form a group. A group is placed, largest first, in the shard where the dot product of its
(bytes, tokens, rows), as shares of the whole, with the shard's residual capacity is highest. Then single groups move
or swap between the fullest and the emptiest shards as long as that lowers the sum of squared deviations.

A group stays whole if it fits an empty shard. One that has more than 1 / shards of the bytes, tokens or rows of the
table can't: it is cut by row into FINE pieces for each shard that it would fill, whatever the size of the table.

Scale: two levels, on sizes that are aggregated by group before they are shuffled. Groups with a share of over
1 / LARGE of the table are few by that rule (3 * LARGE at most), and the driver places them. All other groups are
dealt by hash into parts of about PART_GROUPS groups, and each part places its groups into its share of the capacity that is
left. No text is shuffled; rows find their group's shard by a join.

Defined results: a null text has no bytes and no tokens and the check value of no bytes; null texts and
empty texts are one group; an empty table gives no rows; repeated rows get slots of their own; ties go to the first shard.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, utf8_bytes, word_count

SHARDS = 40
OVERHEAD = 16
#: A group with over 1 / LARGE of the bytes, tokens or rows is placed by the driver.
LARGE = 4096
#: Pieces for each shard that a group too large for one would fill.
FINE = 16
#: Groups of a part, about.
PART_GROUPS = 4_000
#: Rows of a slice within which slots are counted, about, and slices at least.
SLICE_ROWS, SLICES_LEAST = 20_000, 32
#: Repairs on the driver and in a part, at most; items of a shard that are tried in one.
REPAIRS, PART_REPAIRS, TRIED = 400, 40, 256


def pack(items: np.ndarray, residual: np.ndarray, turn: int = 0) -> np.ndarray:
    """items (n, 3) as shares, residual (shards, 3), which is used up: the shard of each item. Largest
    items first; ties go to the first shard from `turn` on, so that parts don't all favour one."""
    shards = len(residual)
    ahead = np.roll(np.arange(shards), -turn)
    left = residual[ahead]
    to = np.zeros(len(items), np.int32)
    for i in np.argsort(-items.sum(axis=1), kind="stable"):
        b = int(np.argmax(left @ items[i]))
        left[b] -= items[i]
        to[i] = b
    residual[ahead] = left
    return ahead[to]


def repair(items: np.ndarray, to: np.ndarray, residual: np.ndarray, rounds: int = REPAIRS) -> np.ndarray:
    """Moves an item, or swaps two, between one of the three fullest and one of the three emptiest shards, the best way each time,
    until nothing helps. residual is what pack left, and is kept up."""
    to = to.copy()

    def some(shard: int) -> np.ndarray:
        """Items of the shard, over all sizes if there are too many."""
        own = np.flatnonzero(to == shard)
        if len(own) > TRIED:
            own = own[np.argsort(-items[own].sum(axis=1), kind="stable")[np.linspace(0, len(own) - 1, TRIED).astype(int)]]
        return own

    for _ in range(rounds):
        order = np.argsort(residual.sum(axis=1), kind="stable")
        full, free = order[:3], order[::-1][:3]
        held = {s: some(s) for s in {*full.tolist(), *free.tolist()}}
        best = (1e-12, None)
        for x in full.tolist():
            for y in free.tolist():
                if x == y or not len(held[x]):
                    continue
                d = items[held[x]][:, None] - np.concatenate([np.zeros((1, 3)), items[held[y]]])[None]
                gain = (residual[x] ** 2).sum() + (residual[y] ** 2).sum() - ((residual[x] + d) ** 2).sum(axis=2) - ((residual[y] - d) ** 2).sum(axis=2)
                i, j = np.unravel_index(int(gain.argmax()), gain.shape)
                if gain[i, j] > best[0]:
                    best = (gain[i, j], (x, y, held[x][i], held[y][j - 1] if j else None, d[i, j]))
        if best[1] is None:
            break
        x, y, one, other, d = best[1]
        to[one] = y
        if other is not None:
            to[other] = x
        residual[x] += d
        residual[y] -= d
    return to


def shard(docs: DataFrame, shards: int = SHARDS, overhead: int = OVERHEAD, large: int = LARGE) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, size, tokens, text_crc32, group (a hash of the text), shard, slot
    (from 0 without gaps in each shard, by hash slice and doc_id)."""
    large = max(large, shards)
    text = F.coalesce("text", F.lit(""))
    base = cut(
        docs.select(
            "doc_id", (utf8_bytes(F.col("text")) + overhead).alias("size"), word_count(F.col("text")).alias("tokens"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("group"),
        )
    )
    dims = ("size", "tokens", "rows")
    sums = [F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")]
    total = base.agg(*sums).first()
    whole = np.array([max(1.0, float(total[d] or 0)) for d in dims])

    share = F.greatest(*[F.col(d) / float(w) for d, w in zip(dims, whole)])
    groups = cut(base.groupBy("group").agg(*sums).withColumn("share", share))
    # groups that no shard can hold: fewer than 3 * shards, in 3 * (FINE + 1) * shards pieces at most
    over = groups.where(F.col("share") > 1.0 / shards).select("group", F.ceil(FINE * shards * F.col("share")).cast("int").alias("pieces"))
    base = base.join(F.broadcast(over), "group", "left").withColumn("piece", F.pmod(F.xxhash64("group", "doc_id"), F.coalesce("pieces", F.lit(1))).cast("int")).drop("pieces")
    pieces = base.join(F.broadcast(over), "group", "left_semi").groupBy("group", "piece").agg(*sums)
    big = groups.where((F.col("share") > 1.0 / large) & (F.col("share") <= 1.0 / shards)).select("group", F.lit(0).alias("piece"), *dims)
    big = big.unionAll(pieces).orderBy("group", "piece").toPandas()
    residual = np.full((shards, 3), 1.0 / shards)
    items = big[list(dims)].to_numpy(float) / whole
    big["shard"] = repair(items, pack(items, residual), residual)
    placed = docs.sparkSession.createDataFrame(big[["group", "piece", "shard"]].astype({"group": "int64", "piece": "int32", "shard": "int32"}), "group long, piece int, shard int")

    rest = groups.where(F.col("share") <= 1.0 / large)
    parts = max(1, rest.count() // PART_GROUPS)
    rest = rest.select("group", *dims, F.pmod(F.xxhash64(F.lit(7), "group"), F.lit(parts)).cast("int").alias("part"))
    free = np.maximum(residual, 0)
    free /= np.where(free.sum(axis=0) > 0, free.sum(axis=0), 1)

    def place(rows: pd.DataFrame) -> pd.DataFrame:
        """One part: its groups go into the parts' share of what the large groups left free."""
        rows = rows.sort_values("group", kind="stable")
        items = rows[list(dims)].to_numpy(float)
        items /= np.maximum(items.sum(axis=0), 1)
        left = free.copy()
        to = repair(items, pack(items, left, int(rows["part"].iloc[0]) % shards), left, PART_REPAIRS)
        return pd.DataFrame({"group": rows["group"], "piece": np.zeros(len(rows), np.int32), "shard": to.astype(np.int32)})

    # a group that is met in very many rows is large, so that the join by group has no hot key
    small = cut(rest.groupBy("part").applyInPandas(place, "group long, piece int, shard int"))
    known = F.broadcast(placed)
    large_rows = base.join(known, ["group", "piece"])
    small_rows = base.join(known.select("group").distinct(), "group", "left_anti").join(small, ["group", "piece"])
    out = ["doc_id", "size", "tokens", "text_crc32", "group", "shard"]
    return slots(small_rows.select(*out).unionAll(large_rows.select(*out)), int(whole[2]))


def slots(rows: DataFrame, n: int) -> DataFrame:
    """Adds slot: the rows of a shard are numbered slice by slice, so that no task holds a whole shard."""
    slices = max(SLICES_LEAST, n // SLICE_ROWS)
    rows = cut(rows.withColumn("slice", F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(slices)).cast("int")))
    counts = rows.groupBy("shard", "slice").agg(F.count(F.lit(1)).alias("n"))
    ahead = counts.select("shard", "slice", (F.sum("n").over(Window.partitionBy("shard").orderBy("slice")) - F.col("n")).alias("ahead"))
    within = F.row_number().over(Window.partitionBy("shard", "slice").orderBy("doc_id", "group"))
    out = rows.withColumn("within", within.cast("long")).join(ahead, ["shard", "slice"])
    return out.select("doc_id", "size", "tokens", "text_crc32", "group", "shard", (F.col("ahead") + F.col("within") - 1).alias("slot"))
