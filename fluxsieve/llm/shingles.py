"""N-gram Jaccard join: a blocked sparse matrix product of documents by word n-grams.

A row of the incidence matrix is a document's set of distinct n-grams, as 64-bit hashes; documents with
equal sets are one class. A product of the matrix with its transpose holds the overlap counts of all pairs. It is
never formed whole; only entries that size-derived bounds leave open are accumulated:

1. One pass makes the classes and counts n-grams. Frequent ones (a bounded table, by count) come last in a
   global order of n-grams, the others are ordered by hash.
2. An entry can reach the threshold t only if the two rows share a column among the first n - ceil(t n) + 1 of each (size-derived
   bound), so only these columns are shuffled, and only columns with two classes or more are kept.
3. Stars first: in each column two classes stand for the column, and each class is tried against those it meets
   most often. A few such rounds join large groups of near copies by as many pairs as they have members. Then all pairs that share a kept column, lie in different components so far, and can reach the
   threshold by size and by position in the column order, are tried: none of them is left out.
4. Trying is the product, in blocks: a block gets the texts that its open entries need, and holds them as sorted column numbers. The columns of
   a row are marked, the marks are summed over the columns of all its partners at once, and counts below the bound of the two sizes are
   discarded. A block returns a spanning forest of the links it finds.

Result: n_shingles and component (least doc_id reachable by links). Links between different texts are all found;
copies are not expanded into pairs.

Defined results: null, empty and blank texts have an empty set and link with nothing; texts with fewer words
than n have one n-gram, the whole; an empty table gives no rows; repeated rows are documents of their own; null
doc_ids are ignored when the least id is taken. Other columns are ignored, or carried whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, cut
from .components import components

#: Entries of the table of frequent n-grams, at most; it is broadcast (16 bytes each).
FREQUENT = 1 << 18
#: Hashes counted together in one pass over a task's rows.
CHUNK = 1 << 21
#: Rounds of stars, at most.
ROUNDS = 4
#: Bits of a signature; a power of two.
BITS = 1024
#: Bits of the bitmap of wanted keys.
SLOTS = 1 << 24
#: Classes that a task remembers, so that copies within it are emitted once.
SEEN = 1 << 16
#: Bytes of sets in a block of the product, about.
BLOCK_BYTES = 24 << 20

_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def words(text: str | None) -> list[bytes]:
    """Lower-cases A-Z only and splits at ASCII white space: what bytes methods do."""
    return (text or "").encode().lower().split()


def ngrams(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word k-grams."""
    w = words(text)
    if len(w) <= k:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(w))] if w else [], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    n = len(w) - k + 1
    s = np.zeros(n, np.uint64)
    for i in range(k):
        s ^= s >> np.uint64(29)
        s *= _MIX[0]
        s += h[i : n + i] * _ODD[i % 4]
    s ^= s >> np.uint64(31)
    s *= _MIX[1]
    s ^= s >> np.uint64(32)
    return np.unique(s)


def pack(text: str) -> bytes:
    """A text as it is shuffled to blocks."""
    return zlib.compress(text.encode(), 1)


def unpack(packed: bytes) -> str:
    return zlib.decompress(packed).decode()


def class_of(grams: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(grams.tobytes())


def signature(grams: np.ndarray) -> bytes:
    """Parity of the number of n-grams in each of BITS buckets. Two sets differ in at least as many n-grams as their
    signatures differ in bits."""
    return np.packbits((np.bincount((grams & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS) & 1).astype(np.uint8)).tobytes()


class Order:
    """The global order of n-grams: frequent ones last, by count."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        at = np.argsort(grams)
        self.grams, self.counts = grams[at], counts[at]

    def prefix(self, x: np.ndarray, size: int) -> np.ndarray:
        if not len(self.grams):
            return x[:size]
        at = np.minimum(np.searchsorted(self.grams, x), len(self.grams) - 1)
        often = self.grams[at] == x
        rare = x[~often]
        if len(rare) >= size:
            return rare[:size]
        late = x[often][np.argsort(self.counts[at[often]], kind="stable")]
        return np.concatenate([rare, late])[:size]


_FIRST = pa.schema([("key", pa.int64()), ("text_hash", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("cls", pa.binary()), ("sig", pa.binary()), ("gram", pa.int64()), ("count", pa.int64())])
_POSTING = pa.schema([("gram", pa.int64()), ("cls", pa.binary()), ("n", pa.int32()), ("pos", pa.int32())])
_SET = pa.schema([("part", pa.int32()), ("cls", pa.binary()), ("text", pa.binary())])


def _fixed(cls: pa.ChunkedArray, width: int = 16) -> np.ndarray:
    """Binary values of one width as rows of a matrix."""
    out = []
    for c in cls.chunks:
        start = int(np.frombuffer(c.buffers()[1], np.int32)[c.offset])
        out.append(np.frombuffer(c.buffers()[2], np.uint8)[start : start + width * len(c)].reshape(-1, width))
    return np.concatenate(out) if out else np.zeros((0, width), np.uint8)


def _key() -> Column:
    """Finds a document's text again: its id, or a hash of its text if it has none."""
    return F.coalesce("doc_id", F.xxhash64("text")).alias("key")


def _first_pass(docs: DataFrame, k: int) -> DataFrame:
    """A row for each document (doc_id, n, cls), and rows (gram, count) for n-grams that recur within a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        seen: set[bytes] = set()

        def counted() -> pa.RecordBatch:
            u, c = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            u, c = u[c > 1], c[c > 1]
            held.clear()
            seen.clear()
            none = pa.nulls(len(u))
            return pa.RecordBatch.from_arrays([*[none.cast(pa.int64())] * 4, *[none.cast(pa.binary())] * 2, pa.array(u.view(np.int64)), pa.array(c)], schema=_FIRST)

        size = 0
        for batch in batches:
            ns, cs, sigs = [], [], []
            for text in batch["text"]:
                x = ngrams(text.as_py(), k)
                c = class_of(x) if len(x) else None
                ns.append(len(x))
                cs.append(c)
                sigs.append(signature(x) if len(x) else None)
                if c is not None and c not in seen:
                    seen.add(c)
                    held.append(x)
                    size += len(x)
            none = pa.nulls(len(ns), pa.int64())
            yield pa.RecordBatch.from_arrays([batch["key"], batch["text_hash"], batch["doc_id"].cast(pa.int64()), pa.array(ns, pa.int64()), pa.array(cs, pa.binary()), pa.array(sigs, pa.binary()), none, none], schema=_FIRST)
            if size >= CHUNK:
                yield counted()
                size = 0
        yield counted()

    return docs.select(_key(), F.xxhash64("text").alias("text_hash"), "doc_id", "text").mapInArrow(run, "key long, text_hash long, doc_id long, n long, cls binary, sig binary, gram long, count long")


def _frequent(counts: DataFrame) -> Order:
    """The most frequent n-grams, FREQUENT at most: the count from which on they fit is read off a histogram of
    count levels."""
    per = cut(counts.groupBy("gram").agg(F.sum("count").alias("count")).withColumn("level", F.floor(F.log2("count") * 8)))
    levels = per.groupBy("level").agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values("level", ascending=False)
    fits = levels[levels["n"].cumsum() <= FREQUENT]["level"]
    if not len(fits):
        return Order(np.zeros(0, np.uint64), np.zeros(0, np.int64))
    got = per.where(F.col("level") >= int(fits.min())).select("gram", "count").toPandas()
    return Order(got["gram"].to_numpy(np.int64).view(np.uint64), got["count"].to_numpy(np.int64))


def _postings(docs: DataFrame, k: int, num: int, den: int, order: Order) -> DataFrame:
    """The columns (gram, cls, n, pos) that hold two classes or more."""
    shared = docs.sparkSession.sparkContext.broadcast((order.grams, order.counts))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Order(*shared.value)
        seen: set[bytes] = set()
        for batch in batches:
            if len(seen) > SEEN:
                seen.clear()
            grams, pos, lens, ns, cs = [], [], [], [], []
            for text in batch["text"]:
                x = ngrams(text.as_py(), k)
                n = len(x)
                if n and (c := class_of(x)) not in seen:
                    seen.add(c)
                    p = by.prefix(x, n - -(-num * n // den) + 1)
                    grams.append(p)
                    pos.append(np.arange(len(p), dtype=np.int32))
                    lens.append(len(p))
                    ns.append(n)
                    cs.append(c)
            if lens:
                at = np.repeat(np.arange(len(lens), dtype=np.int32), lens)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(grams).view(np.int64)), pa.array(cs, pa.binary()).take(pa.array(at)), pa.array(np.repeat(np.array(ns, np.int32), lens)), pa.array(np.concatenate(pos))], schema=_POSTING
                )

    def shared_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come in order of gram; the last gram of a batch may go on in the next. A gram passes once two
        classes are seen, so that no more than a batch is held."""
        rest: pa.Table | None = None  # the last row so far
        passing = False  # its gram passes, and it was passed on
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            if rest is not None:
                t = pa.concat_tables([rest, t]).combine_chunks()
            g, cls = t["gram"].to_numpy(), _fixed(t["cls"])
            other = g[1:] != g[:-1]
            edge = np.flatnonzero(np.concatenate([[True], other]))
            new = np.concatenate([[True], other | (cls[1:] != cls[:-1]).any(axis=1)])
            passes = np.add.reduceat(new.astype(np.int64), edge) > 1
            passes[0] |= passing
            good = np.repeat(passes, np.diff(np.concatenate([edge, [len(g)]]))) & new
            if passing:
                good[0] = False
            last = int(edge[-1])
            passing = bool(passes[-1])
            if not passing:
                good[last:] = False
            yield from t.filter(pa.array(good)).to_batches()
            rest = t.slice(t.num_rows - 1)

    rows = docs.select("text").mapInArrow(emit, "gram long, cls binary, n int, pos int")
    # in order of gram and class, the classes of a gram that are equal lie side by side
    return rows.repartition(F.col("gram")).sortWithinPartitions("gram", "cls").mapInArrow(shared_only, "gram long, cls binary, n int, pos int")


def _likely(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows of texts(key, text) whose key may be wanted, so that few others are shuffled: a bitmap of SLOTS hashed keys,
    which is broadcast, lets all wanted ones pass, and more of the rest as it fills."""
    slot = F.pmod(F.xxhash64(F.lit(3), "key"), F.lit(SLOTS))
    word = F.call_function("shiftright", slot, F.lit(6))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(F.lit(63)).cast("int"))
    bitmap = np.zeros(SLOTS // 64, np.int64)
    for row in wanted.groupBy(word.alias("w")).agg(F.bit_or(bit).alias("b")).collect():
        bitmap[row["w"]] = row["b"]
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            at = batch["slot"].to_numpy()
            ok = bits[at >> 6] >> (at & 63) & 1
            yield batch.select(["key", "text"]).filter(pa.array(ok.astype(bool)))

    return texts.withColumn("slot", slot).mapInArrow(run, "key long, text string")


def masked_product(sets: list[np.ndarray], left: list[int], right: list[int], num: int, den: int) -> list[tuple[int, int]]:
    """The entries (left, right) of the product of the incidence matrix with its transpose that reach the threshold, less those that
    join what earlier ones have joined. A negative number names no row."""
    size = np.array([len(x) for x in sets], np.int64)
    column = np.unique(np.concatenate(sets), return_inverse=True)[1].astype(np.int32) if sets else np.zeros(0, np.int32)
    start = np.cumsum(size) - size
    mark = np.zeros(len(column) + 1, np.int8)
    parent = list(range(len(sets)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    partners: dict[int, list[int]] = {}
    # the row with more partners is the one that is marked
    often = np.bincount(np.array([x for x in (*left, *right) if x >= 0], np.int64), minlength=len(sets))
    for a, b in zip(left, right):
        if a >= 0 and b >= 0 and a != b:
            a, b = (a, b) if (often[a], a) >= (often[b], b) else (b, a)
            partners.setdefault(a, []).append(b)
    out = []
    for a, every in partners.items():
        own = column[start[a] : start[a] + size[a]]
        mark[own] = 1
        for lo in range(0, len(every), 256):
            others = np.array([b for b in every[lo : lo + 256] if root(b) != root(a)], np.int64)
            if not len(others):
                continue
            n = size[others]
            ends = np.cumsum(n)
            at = np.arange(int(ends[-1])) + np.repeat(start[others] - (ends - n), n)
            overlap = np.add.reduceat(mark[column[at]].astype(np.int64), ends - n)
            for b in others[den * overlap >= num * (size[a] + n - overlap)].tolist():
                x, y = root(a), root(b)
                if x != y:
                    parent[x] = y
                    out.append((a, b))
        mark[own] = 0
    return out


def _try(docs: DataFrame, reps: DataFrame, pairs: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """pairs(a, b, n_a, n_b) -> the links (a, b) among them, as spanning forests of blocks."""
    for side in "ab":
        pairs = pairs.join(reps.select(F.col("cls").alias(side), F.col("sig").alias(f"sig_{side}")), side)

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Drops pairs whose signatures differ in more bits than sets at the threshold can differ in n-grams."""
        for batch in batches:
            a, b = (_fixed(pa.chunked_array([batch[f"sig_{s}"]]), BITS // 8) for s in "ab")
            both = batch["n_a"].to_numpy().astype(np.int64) + batch["n_b"].to_numpy()
            ok = np.bitwise_count(a ^ b).sum(axis=1, dtype=np.int64) * (den + num) <= both * (den - num)
            yield batch.select(["a", "b", "n_a", "n_b"]).filter(pa.array(ok))

    pairs = pairs.select("a", "b", F.col("n_a").cast("int").alias("n_a"), F.col("n_b").cast("int").alias("n_b"), "sig_a", "sig_b")
    pairs = cut(pairs.mapInArrow(possible, "a binary, b binary, n_a int, n_b int"))
    total = pairs.agg(F.sum(F.col("n_a") + F.col("n_b")).alias("s"), F.count(F.lit(1)).alias("n")).first()
    parts = max(32, int((total["s"] or 0) * 8 // BLOCK_BYTES), int(total["n"]) // 5000)
    # a class with very many partners is spread over blocks, with 128 of them each
    degree = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / 128).alias("chunks"))
    chunk = F.pmod(F.xxhash64("b"), F.col("chunks"))
    pairs = cut(pairs.join(degree, "a").withColumn("part", F.pmod(F.xxhash64("a", chunk), F.lit(parts)).cast("int")))
    wanted = pairs.select("part", F.explode(F.array("a", "b")).alias("cls")).groupBy("cls").agg(F.collect_set("part").alias("parts"))
    wanted = cut(wanted.join(reps, "cls").select("key", "cls", "parts"))
    texts = _likely(docs.select(_key(), "text"), wanted).join(wanted.hint("shuffle_hash"), "key").select("cls", "parts", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part, cls, packed = [], [], []
                for c, ps, text in zip(*(batch.slice(a, 256)[x] for x in ("cls", "parts", "text"))):
                    c, text = c.as_py(), text.as_py()
                    x = ngrams(text, k)
                    if len(x) and class_of(x) == c:
                        text = pack(text)
                        for p in ps.as_py():
                            part.append(p)
                            cls.append(c)
                            packed.append(text)
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(cls, pa.binary()), pa.array(packed, pa.binary())], schema=_SET)

    def product(pairs: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        names = {bytes(c): i for i, c in enumerate(rows["cls"])}
        sets_ = [ngrams(unpack(t), k) for t in rows["text"]]
        links = masked_product(sets_, [names.get(bytes(x), -1) for x in pairs["a"]], [names.get(bytes(x), -1) for x in pairs["b"]], num, den)
        cls = list(map(bytes, rows["cls"]))
        return pd.DataFrame([(cls[a], cls[b]) for a, b in links], columns=["a", "b"])

    # texts, packed, take far less room in the shuffle than their n-grams, which are hashes of eight bytes a word
    incidence = texts.mapInArrow(sets, "part int, cls binary, text binary")
    return cut(pairs.select("part", "a", "b").groupBy("part").cogroup(incidence.groupBy("part")).applyInPandas(product, "a binary, b binary"))


def _stars(at: DataFrame, turn: int, num: int, den: int) -> DataFrame:
    """at(gram, cls, n, root, shared) -> pairs (a, b, n_a, n_b), two a class at most: of the classes of a column that have about
    the same size, the one that shares most columns (an original, rather than a copy with changes of its own) and one by
    lot stand for all; b is tried against the one it meets most often and one more."""
    level = F.floor(F.log(F.col("n") + 0.5 * (turn % 2)) / float(np.log(den / num)) + 0.5 * (turn % 2))
    at = at.withColumn("level", level).withColumn("by", F.xxhash64(F.lit(turn), "cls"))
    ends = at.groupBy("gram", "level").agg(F.max(F.struct("shared", "cls", "n", "root")).alias("lo"), F.max(F.struct("by", "cls", "n", "root")).alias("hi"))
    ends = ends.select("gram", "level", *[F.struct(*[F.col(f"{e}.{c}") for c in ("cls", "n", "root")]).alias(e) for e in ("lo", "hi")])
    met = at.join(ends, ["gram", "level"]).select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("root").alias("root_b"), F.explode(F.array("lo", "hi")).alias("e"))
    met = met.where(F.col("e.root") != F.col("root_b")).select(F.col("e.cls").alias("a"), "b", F.col("e.n").alias("n_a"), "n_b")
    met = met.where((F.least("n_a", "n_b") * den).cast("long") >= F.greatest("n_a", "n_b").cast("long") * num)
    met = met.groupBy("b", "n_b", "a", "n_a").agg(F.count(F.lit(1)).alias("times"))
    best = met.withColumn("r", F.row_number().over(Window.partitionBy("b").orderBy(F.desc("times"), "a")))
    least = met.groupBy("b", "n_b").agg(F.min(F.struct("a", "n_a")).alias("l")).select("l.a", "b", "l.n_a", "n_b")
    return best.where("r = 1").select("a", "b", "n_a", "n_b").unionAll(least).distinct()


def join(docs: DataFrame, k: int = 4, num: int = 85, den: int = 100) -> DataFrame:
    """docs(doc_id, text, ...) -> doc_id, n_shingles, component_id, root (of the component; null without words), text_hash:
    documents link when den * overlap >= num * union of their sets of word k-grams."""
    first = cut(_first_pass(docs, k))
    rows = first.where("n is not null").select("key", "text_hash", "doc_id", "n", "cls", "sig")
    order = _frequent(first.where("gram is not null").select("gram", "count"))
    columns = cut(_postings(docs, k, num, den, order))
    reps = cut(rows.where("cls is not null").groupBy("cls").agg(F.min("key").alias("key"), F.first("sig").alias("sig")))

    # stars, until few pairs of different components share a column or a round hardly helps
    links = tried = None
    columns = cut(columns.join(columns.groupBy("cls").agg(F.count(F.lit(1)).alias("shared")), "cls"))
    at = columns.withColumn("root", F.col("cls"))
    left = 0.0
    for turn in range(ROUNDS):
        per = at.groupBy("gram", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("gram").agg(F.sum("c").alias("s"), F.sum(F.col("c") * F.col("c")).alias("q"))
        now = per.agg(F.sum("s").alias("rows"), F.sum((F.col("s") * F.col("s") - F.col("q")) / 2.0).alias("cross")).first()
        if turn and ((now["cross"] or 0) <= 2 * (now["rows"] or 0) or now["cross"] > 0.8 * left):
            break
        left = now["cross"] or 0
        stars = _stars(at, turn, num, den)
        stars = cut(stars.join(tried, ["a", "b"], "left_anti") if tried is not None else stars)
        got = _try(docs, reps, stars, k, num, den)
        ends = stars.select("a", "b").unionAll(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        links, tried = (got, ends) if links is None else (links.unionAll(got), tried.unionAll(ends))
        known = components(links).withColumnRenamed("id", "cls")
        at = cut(columns.join(known, "cls", "left").withColumn("root", F.coalesce("root", "cls")))

    # every other pair that can reach the threshold
    x, y = (at.select("gram", *[F.col(c).alias(f"{c}_{s}") for c in ("cls", "n", "pos", "root")]) for s in "ab")
    need = F.ceil((F.col("n_a") + F.col("n_b")).cast("long") * num / float(den + num) - 1e-9)
    can = F.lit(1) + F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b")) - 1
    near = x.join(
        y,
        (x["gram"] == y["gram"]) & (F.col("root_a") != F.col("root_b"))
        & ((F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("cls_a") < F.col("cls_b"))))
        & (F.col("n_a").cast("long") * den >= F.col("n_b").cast("long") * num) & (can >= need),
    )
    pairs = near.select(F.col("cls_a").alias("a"), F.col("cls_b").alias("b"), "n_a", "n_b").distinct()
    got = _try(docs, reps, pairs.join(tried, ["a", "b"], "left_anti") if tried is not None else pairs, k, num, den)
    links = got if links is None else links.unionAll(got)

    roots = components(links).withColumnRenamed("id", "cls")
    rows = cut(rows.drop("sig", "key").join(roots, "cls", "left").withColumn("root", F.coalesce("root", "cls")).drop("cls"))
    least = rows.where("root is not null").groupBy("root").agg(F.min("doc_id").alias("least"))
    component = F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id"))
    return rows.join(least, "root", "left").select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), "root", "text_hash")


def keep_one(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of docs without near copies: of each component the document with the least doc_id (null last), then the
    least text hash, stays, once if it is repeated; documents without words all stay."""
    found = cut(join(docs.select("doc_id", "text"), k, num, den)).where("root is not null")
    last = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    stays = found.groupBy("root").agg(F.min(F.struct(last.alias("of"), F.col("text_hash").alias("of_hash"))).alias("s")).select("s.*")
    worded = F.coalesce(F.col("text").rlike(rf"[^{SPACE}]"), F.lit(False))
    rows = docs.select(last.alias("id"), F.xxhash64("text").alias("hash"), worded.alias("worded"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    out = rows.where("worded").join(cut(stays), (F.col("id") == F.col("of")) & (F.col("hash") == F.col("of_hash")), "left_semi")
    if not found.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        out = out.dropDuplicates(["id", "hash"])
    return out.unionAll(rows.where("not worded")).select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


def oracle(k: int = 4, num: int = 85, den: int = 100) -> str:
    """The same by plain SQL: overlaps of all pairs of classes that share an n-gram, then the least doc_id that links reach."""
    gram = " || ' ' || ".join(f"w[i + {j}]" for j in range(k))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS node, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT node, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {k} THEN [array_to_string(w, ' ')]
      ELSE list_sort(list_distinct(list_transform(range(1, len(w) - {k - 2}), lambda i: {gram}))) END AS g FROM d),
c AS (SELECT g, min(node) AS cls, len(g) AS n FROM s WHERE len(g) > 0 GROUP BY g),
t AS (SELECT cls, n, unnest(g) AS x FROM c),
l AS (SELECT a.cls AS a, b.cls AS b FROM t a JOIN t b ON a.x = b.x AND a.cls <> b.cls GROUP BY a.cls, b.cls, a.n, b.n HAVING {den} * count(*) >= {num} * (a.n + b.n - count(*))),
r AS (SELECT cls AS a, cls AS b FROM c UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
o AS (SELECT c.cls, c.g, s.doc_id FROM c JOIN s ON c.g = s.g),
m AS (SELECT r.a AS cls, min(o.doc_id) AS least FROM r JOIN o ON o.cls = r.b GROUP BY r.a)
SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, CASE WHEN len(s.g) > 0 THEN m.least ELSE s.doc_id END AS component_id
FROM s LEFT JOIN c ON c.g = s.g LEFT JOIN m ON m.cls = c.cls
"""


ORACLE = oracle()
