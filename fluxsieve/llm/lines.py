"""Line dedup by an exact set-similarity join. Only DataFrame functions.

A line is the set of its words. Words are ordered by rarity (a table of counts by hash, of fixed size, from all texts:
any order gives the same result, a good one less work). Lines whose sets have a Jaccard similarity of at least t = num / den share a word among the first
n - ceil(t n) + 1 of the larger set and the first n - ceil(2 t n / (1 + t)) + 1 of the smaller one (prefix filter),
at places that leave room for the overlap (positional filter), and have sizes within t of each other (length
filter). Parity signatures of 64 bits, 128 for long lines, bound the symmetric difference from below and rule out most other pairs inside
the join; what is left is verified on the words themselves.

A line goes if any earlier line, in order of (doc_id, line number), matches it, within or across documents.
Lines of under `least` distinct words stay, and blank ones. Equal sets are one class (by 128 bits of hash), reduced to its first line before the join.

A line needs one match only. So groups of near copies are thinned before the join: where more than GROUP classes share a key, each is tried
against the earliest ones (LOTS of them). Fewer have under GROUP / 2 pairs a class, and go into the join as they are. Its four keys pair one of its two least hashes of a word with one of its two
largest, so that near copies have one in common unless edits change both ends: a join of no more than 4 LOTS rows a class.
Classes that this settles take part in the join only as earlier ends of those it doesn't: no pair of two settled ones
is formed, and the pairs of a group don't grow with its square.

Scale: classes are combined before the shuffle, so that a line which a third of all documents share is one row;
of each rarity list only rows move, keyed by word; texts move three times, keyed by row; when words are read back, only those that a bitmap of fixed size lets pass. The table of counts is
2 ** BUCKETS numbers whatever the input.

Defined results: a null text stays null; a document whose lines all go becomes the empty text; null doc_ids order
last; a row is known by its doc_id and a hash of its text, so rows that share an id, or have none, keep their own
lines; lines at the same doc_id and line number are not later than one another; an empty table gives no rows; other columns pass through unchanged,
whatever their names, but for n_removed, which is replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, cut

NUM, DEN = 4, 5
LEAST = 1
#: Lines of so many words have a second signature.
LONG = 64
#: The table of counts has 2 ** BUCKETS places.
BUCKETS = 18
#: Below the level of a word's count, this many bits of its hash order words of one level.
LOW = 56
#: Earliest relatives that a class is tried against before the join.
LOTS = 16
#: Groups of more classes than this are thinned.
GROUP = 64
#: The words of all documents are counted; levels are those of their counts in so many documents.
SAMPLE = 1 << 14
#: So many settled classes, and no more, are hashed by their words; a word has no more entries than there are classes.
FEW = 1 << 18
#: The bitmap of wanted texts has 2 ** BITS places.
BITS = 23
#: Codec of tables of hashes, which hardly compress.
HASHES = "lz4_raw"


def split_lines(text: Column) -> Column:
    return F.split(text, "\n")


def split_words(line: Column) -> Column:
    """The words of a line that has no space at its ends."""
    return F.split(line, f"[{SPACE}]+")


def _pieces(line: Column, odd: Column) -> Column:
    """The words of a line, and empty ones. Only lines of texts that have other space than blanks (odd) need the pattern."""
    return F.when(odd, split_words(line)).otherwise(F.split(line, " "))


def _odd() -> Column:
    """Whether a text has space other than blanks and ends of lines."""
    odd = F.lit(False)
    for c in "\t\x0b\f\r":
        odd = odd | F.contains("text", F.lit(c))
    return odd


def trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\x0b\f\r"))


def _place(hashed: Column) -> Column:
    """A word's place in the table of counts: the high bits of its hash."""
    return F.shiftrightunsigned(hashed, 64 - BUCKETS).cast("int")


def _constant(rows: DataFrame, size: int, made: Column) -> Column:
    """rows(at, value) -> an array of `size` numbers as a constant: each place has what `made` makes of its values and a 0.
    A subquery of one row, so that the driver's Python never holds the numbers and plans name them instead of spelling them out."""
    none = rows.sparkSession.range(size).select(F.col("id").cast("int").alias("at"), F.lit(0).cast("long").alias("value"))
    cells = rows.unionAll(none).groupBy("at").agg(made.alias("value"))
    whole = cells.agg(F.sort_array(F.collect_list(F.struct("at", "value"))).alias("cells"))
    return cut(whole.select(F.col("cells.value").alias("numbers"))).scalar()


def rarity(docs: DataFrame) -> Column:
    """An array of 2 ** BUCKETS levels, the rounded logarithm of the count of words with that place in all texts, as a count
    in SAMPLE documents if there are more; below 0 for words that have under one there."""
    share = F.lit(min(1.0, SAMPLE / max(1, docs.count())))
    text = F.replace(F.col("text"), F.lit("\n"), F.lit(" "))
    words = docs.select(F.explode(_pieces(text, _odd())).alias("w")).where("w <> ''")
    # counted here already: a union's rows are not
    places = words.groupBy(_place(F.xxhash64("w")).alias("at")).agg(F.count(F.lit(1)).alias("value"))
    count = F.sum("value")
    level = F.when(count > 0, F.greatest(F.lit(-127), F.least(F.lit(126), F.floor(F.log2(count * share) * 2) + 1))).otherwise(-128)
    return _constant(places, 1 << BUCKETS, level.cast("tinyint"))


def _flips(spark: SparkSession, levels: Column) -> Column:
    """levels -> for each place the bits in which its level differs from the high bits of hashes with that place, as a constant.
    Worked out once a table, as every step of a lambda is interpreted for every word."""
    flip = F.transform("levels", lambda level, at: F.shiftleft(level.cast("long").bitwiseXOR(F.shiftright(at, BUCKETS + LOW - 64).cast("long")), LOW))
    return spark.range(1).select(levels.alias("levels")).select(flip.alias("flips")).scalar()


def _ranked(flips: Column) -> Callable[[Column], Column]:
    """A word's hash as a number that orders by rarity: the level of its place, then the rest of the hash."""
    # never null, so that arrays of these sort as plain numbers
    return lambda h: h.bitwiseXOR(F.coalesce(F.get(flips, _place(h)), F.lit(0).cast("long")))


def _parity(words: str, half: bool) -> Column:
    """64 bits: whether a bucket holds an odd number of the words, by six bits of their hash; of half of them, by a seventh."""
    one = F.lit(1).cast("long")

    def flip(bits: Column, x: Column) -> Column:
        mark = F.shiftright(x, 6).bitwiseAND(one) if half else one
        return bits.bitwiseXOR(F.call_function("shiftleft", mark, x.bitwiseAND(F.lit(63)).cast("int")))

    return F.aggregate(words, F.lit(0).cast("long"), flip)


def _prefix_size(n: Column, num: int, den: int) -> Column:
    """n - ceil(num n / den) + 1."""
    return n - F.floor((n * num + den - 1) / den).cast("int") + 1


def sets(docs: DataFrame, levels: Column, num: int, den: int, least: int) -> DataFrame:
    """A row for each line that takes part: where it stands, its class (k1, k2), size, signatures and prefix."""
    # hashed below the generator, so that no line carries its text, and split in it, so that no filter splits again
    lines = docs.select("doc_id", _row(), _odd().alias("odd"), "text").select("doc_id", "row", "odd", F.posexplode(split_lines(F.col("text"))).alias("line_no", "line"))
    # held, or the filter on their number would make them a second time; in two steps, as what stands beside a lambda is interpreted
    words = _held(F.transform(_pieces(F.col("line"), F.col("odd")), lambda w: F.xxhash64(w)))
    hashed = lines.where("line <> ''").select("doc_id", "row", "line_no", words.alias("words"))
    hashes = F.sort_array(F.array_except("words", F.array(F.xxhash64(F.lit("")))))
    # flips is named here, as no subquery may stand in a lambda when a plan is analysed; the optimizer then puts it there
    hashed = hashed.select("doc_id", "row", "line_no", _held(hashes).alias("hashes")).withColumn("flips", _flips(docs.sparkSession, levels))
    n = F.size("hashes")
    ends = [(F.get("hashes", a), F.get("hashes", b)) for a in (F.lit(0), F.least(F.lit(1), n - 1)) for b in (n - 1, F.greatest(F.lit(0), n - 2))]
    words = F.sort_array(F.transform("hashes", _ranked(F.col("flips"))))
    return hashed.where(n >= max(1, least)).select(
        "doc_id", "row", "line_no", F.array_distinct(F.array(*[F.hash(a, b) for a, b in ends])).alias("mets"), n.alias("n"),
        F.xxhash64("hashes").alias("k1"), F.xxhash64(F.lit(1), "hashes").alias("k2"),
        _parity("hashes", False).alias("sig"), F.when(n >= LONG, _parity("hashes", True)).otherwise(F.lit(0).cast("long")).alias("sig2"),
        F.slice(words, F.lit(1), _prefix_size(n, num, den)).alias("prefix"),
    )


def _row() -> Column:
    """With doc_id, what tells rows apart."""
    return F.xxhash64("text").alias("row")


class Order:
    """doc_id, null last, and line number as one number: a long where the range of ids allows it, else a decimal."""

    def __init__(self, docs: DataFrame):
        low, high = docs.agg(F.min("doc_id").cast("long"), F.max("doc_id").cast("long")).first()
        self.low, high = (0, -1) if low is None else (low, high)
        self.narrow = high - self.low < (1 << 31) - 1 and high < (1 << 63) - 1
        self.none = high + 1 if self.narrow else (1 << 63) - 1

    def home(self) -> Column:
        """doc_id, or what stands for null."""
        return F.coalesce(F.col("doc_id").cast("long"), F.lit(self.none).cast("long"))

    def at(self) -> Column:
        if self.narrow:
            return F.shiftleft(self.home() - F.lit(self.low).cast("long"), 31).bitwiseOR(F.col("line_no").cast("long"))
        return self.home().cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(12,0)") + F.col("line_no")

    def home_of(self, at: str) -> Column:
        if self.narrow:
            return F.shiftright(at, 31) + F.lit(self.low).cast("long")
        return F.floor(F.col(at) / F.lit(1 << 31)).cast("long")

    def line_of(self, at: str) -> Column:
        if self.narrow:
            return F.col(at).bitwiseAND(F.lit((1 << 31) - 1)).cast("int")
        return F.pmod(at, F.lit(1 << 31).cast("decimal(12,0)")).cast("int")


def _alike(a: str, b: str, num: int, den: int) -> Column:
    """Whether sizes and signatures of two classes allow the similarity."""
    n, m = F.col(f"n_{a}"), F.col(f"n_{b}")
    both = n + m
    flips = F.col(f"sig_{a}").bitwiseXOR(F.col(f"sig_{b}"))
    # the two halves tell 128 buckets apart
    halves = F.col(f"sig2_{a}").bitwiseXOR(F.col(f"sig2_{b}"))
    differ2 = F.bit_count(halves) + F.bit_count(flips.bitwiseXOR(halves))
    sizes = F.least(n, m) * den >= F.greatest(n, m) * num
    return sizes & (F.bit_count(flips) * (num + den) <= both * (den - num)) & ((F.least(n, m) < LONG) | (differ2 * (num + den) <= both * (den - num)))


def _named(rows: DataFrame, side: str, *kept: str) -> DataFrame:
    return rows.select(*kept, *[F.col(c).alias(f"{c}_{side}") for c in rows.columns if c not in kept])


def _relatives(classes: DataFrame, num: int, den: int, over: int = 1) -> DataFrame:
    """(early, late): each class with the earliest LOTS of those that share a key with it, one of each residue of ids, for keys
    that more than `over` classes have."""
    met = classes.select(F.explode("mets").alias("met"), "id", "n", "sig", "sig2", "doc")
    # counted first: most keys are of one class. A smaller group that the bitmap lets pass is thinned too
    many = met.groupBy("met").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") > over)
    met = met.where(_marked(many.select(F.col("met").cast("long").alias("key")))(F.col("met").cast("long")))
    heads = [F.min_by("id", F.when(F.pmod("id", F.lit(LOTS)) == k, F.col("doc"))).alias(f"h{k}") for k in range(LOTS)]
    first = met.groupBy("met").agg(*heads)
    first = first.select("met", F.explode(F.array(*[f"h{k}" for k in range(LOTS)])).alias("id_early")).where("id_early is not null")
    # what a head is goes with it, so that the join by key makes only pairs that may match
    first = first.join(_named(classes.select("id", "n", "sig", "sig2", "doc"), "early"), "id_early")
    pairs = _named(met, "late", "met").join(first, "met")
    alike = pairs.where((F.col("doc_early") <= F.col("doc_late")) & (F.col("id_early") != F.col("id_late")) & _alike("early", "late", num, den))
    return alike.select(F.col("id_early").alias("early"), F.col("id_late").alias("late")).distinct()


def _candidates(open_: DataFrame, settled: DataFrame, num: int, den: int, few: bool) -> DataFrame:
    """(early, late, doc): every pair of classes that may match, of which the later one is open; doc is that of the earlier."""

    def posted(classes: DataFrame) -> DataFrame:
        # said here for all columns, so that joins infer nothing more and share one exchange
        rows = classes.where(" and ".join(f"{c} is not null" for c in ("id", "sig", "sig2", "n", "doc", "prefix")))
        rows = rows.select("id", "sig", "sig2", "n", "doc", F.posexplode("prefix").alias("pos", "word"))
        # words meet by the low half of their hash: what meets by accident is ruled out later
        return rows.withColumn("word", F.col("word").bitwiseAND(F.lit(0xFFFFFFFF)))

    def room(a: str, b: str) -> Column:
        """Whether the places leave room for the overlap; this holds the smaller set to its shorter prefix."""
        return F.least(F.col(f"n_{a}") - F.col(f"pos_{a}"), F.col(f"n_{b}") - F.col(f"pos_{b}")) * (num + den) >= (F.col(f"n_{a}") + F.col(f"n_{b}")) * num

    probe = posted(open_).repartition("word")
    # what room() asks of the smaller set whatever the other; held, or it would move below the exchange, which both sides share
    short = _held((F.col("n") - F.col("pos")) * (num + den) >= F.col("n") * (2 * num))
    smaller, larger = _named(probe.select("*", short.alias("short")).where("short").drop("short"), "a", "word"), _named(probe, "b", "word")
    order = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("id_a") < F.col("id_b")))
    both = smaller.join(larger, "word").where(order & room("a", "b") & _alike("a", "b", num, den))
    # either may be the earlier one; both may where their first lines are of one document
    ways = [F.struct(F.col(f"id_{e}").alias("early"), F.col(f"id_{l}").alias("late"), F.col(f"doc_{e}").alias("doc")) for e, l in ("ab", "ba")]
    either = F.when(F.col("doc_a") < F.col("doc_b"), F.array(ways[0])).when(F.col("doc_a") > F.col("doc_b"), F.array(ways[1])).otherwise(F.array(*ways))
    both = both.select(F.explode(either).alias("p")).select("p.*")
    # an open class and an earlier settled one, of any size
    early, late = _named(posted(settled), "early", "word"), _named(probe, "late", "word")
    # the settled ones, where they are few, are hashed, so that all the open ones aren't sorted once more for them
    if few:
        early = early.hint("shuffle_hash")
    rest = early.join(late, "word").where((F.col("doc_early") <= F.col("doc_late")) & room("early", "late") & _alike("early", "late", num, den))
    rest = rest.select(F.col("id_early").alias("early"), F.col("id_late").alias("late"), F.col("doc_early").alias("doc"))
    return both.unionAll(rest).distinct()


def later_lines(docs: DataFrame, num: int = NUM, den: int = DEN, least: int = LEAST) -> DataFrame:
    """docs(doc_id, text) -> the lines that go: (doc_id, row, line_no)."""
    order = Order(docs)
    lines = cut(sets(docs, rarity(docs), num, den, least), HASHES).withColumn("at", order.at())
    classes = lines.groupBy("k1", "k2", "mets", "n", "sig", "sig2", "prefix").agg(F.min("at").alias("first"), F.min_by("row", "at").alias("row"), F.count(F.lit(1)).alias("times"))
    # numbers are written with the rows, so that they stay what they are
    classes = cut(classes.withColumn("doc", order.home_of("first")).withColumn("id", F.monotonically_increasing_id()), HASHES)

    pairs = cut(_relatives(classes, num, den, GROUP))
    goes = cut(_verified(pairs, _words_of(docs, classes, pairs, order), num, den))

    pairs = cut(_candidates(classes.join(goes, "id", "left_anti"), classes.join(goes, "id", "left_semi"), num, den, goes.count() <= FEW))
    words = _words_of(docs, classes, pairs, order)
    # the earliest candidate is tried first, all others only where that one fails
    nearest = pairs.groupBy("late").agg(F.min(F.struct("doc", "early")).alias("e")).select("late", "e.early")
    found = cut(_verified(nearest, words, num, den))
    open_ = pairs.select("late", "early").join(found.select(F.col("id").alias("late")), "late", "left_anti")
    goes = goes.unionAll(found).unionAll(_verified(open_, words, num, den)).withColumn("goes", F.lit(True))

    # a class that goes, goes whole; of the others all but the first line
    fate = classes.select("id", "k1", "k2", "first", "times").join(goes.hint("shuffle_hash"), "id", "left").where("goes or times > 1").drop("id", "times")
    return lines.join(fate.hint("shuffle_hash"), ["k1", "k2"]).where("goes or at > first").select("doc_id", "row", "line_no")


def _marked(keys: DataFrame) -> Callable[[Column], Column]:
    """Whether a bitmap of 2 ** BITS places has that of a long. True for all of keys(key), and the more other ones the fuller the bitmap."""

    def place(key: Column) -> Column:
        return key.bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")

    one = F.lit(1).cast("long")
    bits = keys.select(place(F.col("key")).alias("p")).select(F.shiftright("p", 6).alias("at"), F.call_function("shiftleft", one, F.col("p").bitwiseAND(F.lit(63))).alias("value"))
    table = _constant(bits, 1 << BITS - 6, F.bit_or("value"))
    return lambda key: F.call_function("shiftright", F.get(table, F.shiftright(place(key), 6)), place(key).bitwiseAND(F.lit(63))).bitwiseAND(one) == 1


def _words_of(docs: DataFrame, classes: DataFrame, pairs: DataFrame, order: Order) -> DataFrame:
    """(id, first, words) of the classes in pairs(early, late), from the first line of each."""
    named = pairs.select(F.col("early").alias("id")).unionAll(pairs.select("late")).distinct()
    named = classes.join(named.hint("shuffle_hash"), "id", "left_semi").select("id", "first", "row", order.home_of("first").alias("home"), order.line_of("first").alias("line_no"))
    named = cut(named)
    marked = _marked(named.select(F.xxhash64("home", "row").alias("key")))
    per_doc = named.groupBy("home", "row").agg(F.collect_list(F.struct("line_no", "id", "first")).alias("wanted"))
    texts = docs.select(order.home().alias("home"), _row(), "text").where(marked(F.xxhash64("home", "row")))
    found = texts.join(per_doc.hint("shuffle_hash"), ["home", "row"]).select("wanted", _held(split_lines(F.col("text"))).alias("ls"))
    at = F.transform("wanted", lambda x: F.struct(F.get("ls", x["line_no"]).alias("line"), x["id"].alias("id"), x["first"].alias("first")))
    found = found.select(F.explode(at).alias("w")).where("w.line is not null")
    return cut(found.select("w.id", "w.first", F.array_distinct(split_words(trimmed(F.col("w.line")))).alias("words")).dropDuplicates(["id"]))


def _verified(pairs: DataFrame, words: DataFrame, num: int, den: int) -> DataFrame:
    """pairs(early, late) -> the ids of the later ones where the words reach the similarity and the first line of one comes before that of
    the other."""
    for side in ("early", "late"):
        pairs = pairs.join(words.select(F.col("id").alias(side), F.col("first").alias(f"first_{side}"), F.col("words").alias(f"words_{side}")), side)
    common = F.size(F.array_intersect("words_early", "words_late"))
    union = F.size("words_early") + F.size("words_late") - common
    return pairs.where((F.col("first_early") < F.col("first_late")) & (common * den >= union * num)).select(F.col("late").alias("id")).distinct()


def _held(value: Column) -> Column:
    """The value worked out once for a row, however often it is used: a generator is never merged into what stands above it."""
    return F.explode(F.array(value))


def dedup(docs: DataFrame, num: int = NUM, den: int = DEN, least: int = LEAST) -> DataFrame:
    """docs(doc_id, text, ...) -> the same columns, the later lines taken out of text, and the number removed."""
    gone = cut(later_lines(docs.select("doc_id", "text"), num, den, least))
    per_doc = gone.groupBy(F.col("doc_id").alias("of"), F.col("row").alias("of_row")).agg(F.array_sort(F.collect_set("line_no")).alias("gone"))
    rows = docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("all"))
    mine = F.col("doc_id").eqNullSafe(F.col("of")) & (F.xxhash64("text") == F.col("of_row"))
    rows = rows.join(per_doc.hint("shuffle_hash"), mine, "left")
    rows = rows.select("all", "text", "gone", _held(F.when(F.col("gone").isNotNull(), split_lines(F.col("text")))).alias("ls"))
    stay = F.array_except(F.sequence(F.lit(0), F.size("ls") - 1), "gone")
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("ls", i)), "\n"))
    out = [text.alias(c) if c == "text" else F.col(f"all.`{c}`").alias(c) for c in docs.columns if c != "n_removed"]
    return rows.select(*out, F.coalesce(F.size("gone"), F.lit(0)).alias("n_removed"))


#: The same lines by plain SQL: pairs that share a prefix word, then the words of both.
ORACLE = rf"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS line_no FROM d),
w AS (SELECT doc_id, line_no, list_sort(list_distinct(string_split_regex(trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+'))) AS ws FROM l),
o AS (SELECT *, CAST(doc_id AS HUGEINT) * 2147483648 + line_no AS occ FROM w WHERE len(ws) >= {LEAST} AND ws <> ['']),
c AS (SELECT ws, min(occ) AS head, len(ws) AS n FROM o GROUP BY ws),
t AS (SELECT head, n, unnest(ws) AS word FROM c),
f AS (SELECT word, count(*) AS df FROM t GROUP BY word),
p AS (SELECT head, n, word FROM (SELECT head, n, t.word, row_number() OVER (PARTITION BY head ORDER BY df, t.word) AS r FROM t JOIN f USING (word)) WHERE r <= n - (n * {NUM} + {DEN} - 1) // {DEN} + 1),
k AS (SELECT DISTINCT a.head AS a, b.head AS b FROM p a JOIN p b ON a.word = b.word AND a.head < b.head AND least(a.n, b.n) * {DEN} >= greatest(a.n, b.n) * {NUM}),
m AS (SELECT k.b AS head, min(k.a) AS prior FROM k JOIN c x ON x.head = k.a JOIN c y ON y.head = k.b
      WHERE len(list_intersect(x.ws, y.ws)) * {DEN} >= {NUM} * (x.n + y.n - len(list_intersect(x.ws, y.ws))) GROUP BY k.b),
e AS (SELECT c.ws, least(c.head, coalesce(m.prior, c.head)) AS earliest FROM c LEFT JOIN m ON c.head = m.head),
g AS (SELECT doc_id, list(line_no) AS gone FROM o JOIN e USING (ws) WHERE occ > earliest GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN gone IS NULL THEN text ELSE coalesce(array_to_string(list_transform(list_filter(range(len(ls)), lambda i: NOT list_contains(gone, i)), lambda i: ls[i + 1]), chr(10)), '') END AS text,
  CAST(coalesce(len(gone), 0) AS INTEGER) AS n_removed
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""
