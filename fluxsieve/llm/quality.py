"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or abstain on every document. Expectation-maximisation over the
counts of vote patterns of all documents estimates the labellers' accuracies and the share of good documents without
any label; the posterior of a document's pattern is its soft label. A linear scorer on hashed features is trained
on the soft labels of all documents and scores every document; documents that score under the threshold are rejected.

Scale: one pass over the texts without a shuffle for votes and features, and one for the scores of rows that are passed on whole. Patterns are counted before they are shuffled, and there are
3 ** labellers at most. Features are written once, and gone when the scorer is trained; a step of training is a pass over them, of which the
driver gets one gradient (2 ** DIM numbers, summed by the executors). Terms of a gradient are rounded to one grid, so that their sum, and the scorer,
don't depend on the order of rows or on partitions.

Defined results: a document without words (null, empty, blank) has score 0 and is rejected; all other rules are
functions of the text, so equal texts get equal results; an empty table gives no rows and no model is trained.
"""

from __future__ import annotations

import operator
import zlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, uncut

DIM = 14
THRESHOLD = 0.5
#: Weight of the squared weights in the loss; training ends where the gradient is no longer than FLAT, or after ROUNDS steps.
DECAY, FLAT, ROUNDS = 1e-5, 1e-4, 100
#: Documents in a task of such a step, about.
ROWS = 1 << 14
#: Terms of the loss and its gradient are whole multiples of 1 / UNIT.
UNIT = float(1 << 28)
GOOD, BAD, ABSTAIN = 1, 0, 2

#: Function words of English, French, German and Spanish; capitalised forms count too.
FUNCTION_WORDS = (
    "the of and to in a is it that for on with as by at from are was this be not or an "
    "le la les de des et un une du en que qui dans pour par sur est au aux avec "
    "der die das und ein eine ist in zu den dem von mit auf nicht im für "
    "el los las y del por con una para es se no lo al como"
).split()
_STOP = frozenset([*FUNCTION_WORDS, *(w.capitalize() for w in FUNCTION_WORDS)])

# classes of bytes: 0 other, 1 lower, 2 upper, 3 digit, 4 space, 5 sentence mark, 6 symbol, 7 beyond ASCII
_CLASS = np.zeros(256, np.uint8)
for _chars, _c in (("abcdefghijklmnopqrstuvwxyz", 1), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 2), ("0123456789", 3), (" \t\n\r\x0b\x0c", 4), (".,;:'\"()-?", 5), ("!#$%&*|<>{}[]=~^_\\/@+", 6)):
    _CLASS[list(_chars.encode())] = _c
_CLASS[128:] = 7


class Stats(NamedTuple):
    """What the labellers look at."""

    words: int
    letters: int
    upper: float
    symbols: float
    pipes: float
    marks: float
    again: float
    distinct: float
    function: float


def stats(words: list[str], text: str, classes: np.ndarray) -> Stats:
    n = len(words)
    kind = np.bincount(classes, minlength=8)
    letters = int(kind[1] + kind[2])
    return Stats(
        n, letters, kind[2] / max(1, letters), kind[6] / max(1, len(classes)), text.count("|") / n,
        (text.count(". ") + text.count(", ") + text.count(".\n") + text.endswith(".")) / n,
        sum(map(operator.eq, words, words[1:])) / max(1, n - 1), len(set(words)) / n, sum(map(_STOP.__contains__, words)) / n,
    )


#: Name and rule of each labeller.
LABELLERS = (
    ("capitals", lambda s: BAD if s.letters >= 20 and s.upper > 0.4 else GOOD if s.upper < 0.08 else ABSTAIN),
    ("symbols", lambda s: BAD if s.symbols > 0.04 else GOOD if s.symbols < 0.01 else ABSTAIN),
    ("tables", lambda s: BAD if s.words >= 5 and s.pipes > 0.2 else GOOD if s.pipes < 0.02 else ABSTAIN),
    ("stutter", lambda s: BAD if s.words >= 10 and s.again > 0.2 else GOOD if s.words >= 10 and s.again < 0.05 else ABSTAIN),
    ("variety", lambda s: BAD if s.words >= 50 and s.distinct < 0.25 else GOOD if s.words >= 50 and s.distinct > 0.5 else ABSTAIN),
    ("sentences", lambda s: GOOD if 0.02 < s.marks < 0.4 else BAD if s.words >= 40 and s.marks < 0.003 else ABSTAIN),
    ("function words", lambda s: GOOD if s.function > 0.05 else BAD if s.words >= 20 and s.function < 0.02 else ABSTAIN),
)


def votes(s: Stats) -> int:
    """All votes as one number, base 3."""
    code = 0
    for _, rule in LABELLERS:
        code = code * 3 + rule(s)
    return code


def features(words: list[str], classes: np.ndarray, s: Stats) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features (sorted indices, values): words, runs of three and four byte classes, and levels of the
    figures; each family has length 1."""
    mask = (1 << DIM) - 1
    parts = []
    c = classes.astype(np.int64)
    for k, salt in ((3, 0x9E3779B1), (4, 0x85EBCA77)):
        if len(c) >= k:
            code = np.zeros(len(c) - k + 1, np.int64)
            for i in range(k):
                code = code * 8 + c[i : len(c) - k + 1 + i]
            count = np.bincount(code, minlength=8**k)
            at = np.flatnonzero(count)
            parts.append((((at + 1) * salt >> 7) & mask, np.sqrt(count[at])))
    hashed = np.fromiter((zlib.crc32(w.encode()) for w in words), np.int64, len(words)) & mask
    at, count = np.unique(hashed, return_counts=True)
    parts.append((at, np.sqrt(count)))
    levels = [f"{k}:{min(12, int(v * 20))}" for k, v in zip(Stats._fields[2:], s[2:])] + [f"size:{int(np.log2(s.words))}"]
    parts.append((np.array([zlib.crc32(x.encode()) & mask for x in levels]), np.ones(len(levels))))
    idx = np.concatenate([p[0] for p in parts])
    val = np.concatenate([p[1] / np.sqrt((p[1] ** 2).sum()) for p in parts])
    at, inverse = np.unique(idx, return_inverse=True)
    return at.astype(np.int32), np.bincount(inverse, val).astype(np.float32)


def look(text: str | None) -> tuple[list[str], np.ndarray, Stats] | None:
    words = (text or "").split()
    if not words:
        return None
    classes = _CLASS[np.frombuffer(text.encode(), np.uint8)]
    return words, classes, stats(words, text, classes)


class LabelModel(NamedTuple):
    good: float  # share of good documents
    rates: np.ndarray  # (labellers, class, vote), of the votes that are cast

    def posterior(self, codes: list[int]) -> np.ndarray:
        """The probability to be good, by vote pattern, met when fitting or not."""
        return _posterior(_ballots(codes), self.good, self.rates)

    def accuracy(self) -> dict[str, float]:
        """Of each labeller, when it votes."""
        share = np.array([1 - self.good, self.good])
        hit = self.rates[:, BAD, BAD] * share[BAD] + self.rates[:, GOOD, GOOD] * share[GOOD]
        miss = self.rates[:, BAD, GOOD] * share[BAD] + self.rates[:, GOOD, BAD] * share[GOOD]
        return {name: float(h / max(h + m, 1e-12)) for (name, _), h, m in zip(LABELLERS, hit, miss)}


def _ballots(codes: list[int]) -> np.ndarray:
    """The votes of each pattern, by labeller."""
    return np.array([[c // 3 ** (len(LABELLERS) - 1 - j) % 3 for j in range(len(LABELLERS))] for c in codes], np.int64).reshape(-1, len(LABELLERS))


def _posterior(v: np.ndarray, good: float, rates: np.ndarray) -> np.ndarray:
    logs = [np.log(rates[np.arange(len(LABELLERS)), y, v]).sum(axis=1) for y in (BAD, GOOD)]
    return 1 / (1 + np.exp(np.clip(logs[0] + np.log(1 - good + 1e-12) - logs[1] - np.log(good + 1e-12), -50, 50)))


def expectation_maximisation(patterns: dict[int, int], rounds: int = 60) -> LabelModel:
    """patterns: documents by vote pattern. Starts from the majority of the votes, any bad vote outweighing the good
    ones; labellers are taken as independent given the class, and to abstain for reasons that say nothing about it,
    so that short texts aren't held to be bad; counts are smoothed by one document a cell."""
    codes = sorted(patterns)
    n = np.array([patterns[c] for c in codes], float)
    v = _ballots(codes)
    bad, good = (v == BAD).sum(axis=1), (v == GOOD).sum(axis=1)
    p = np.clip((good + 1.0 - (bad > 0) * good) / (good + bad + 2.0), 0.02, 0.98)
    share, rates = 0.5, np.ones((len(LABELLERS), 2, 3))
    for _ in range(rounds):
        share = float((n * p).sum() / n.sum())
        for y, w in ((GOOD, n * p), (BAD, n * (1 - p))):
            for x in (BAD, GOOD):
                rates[:, y, x] = (w[:, None] * (v == x)).sum(axis=0) + 1.0
        rates[:, :, :ABSTAIN] /= rates[:, :, :ABSTAIN].sum(axis=2, keepdims=True)
        p = _posterior(v, share, rates)
    return LabelModel(share, rates)


def train(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], size: int, rounds: int = ROUNDS, memory: int = 10) -> np.ndarray:
    """The least of a loss, a function that gives its value and gradient, by L-BFGS from 0."""
    w = np.zeros(size)
    value, grad = loss(w)
    steps: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        if np.linalg.norm(grad) <= FLAT:
            break
        way, used = grad.copy(), []
        for s, y, sy in reversed(steps):
            used.append(s @ way / sy)
            way -= used[-1] * y
        way *= steps[-1][2] / (steps[-1][1] @ steps[-1][1]) if steps else 2.0
        for (s, y, sy), a in zip(steps, reversed(used)):
            way += (a - y @ way / sy) * s
        step = 1.0
        while (got := loss(w - step * way))[0] > value - 1e-4 * step * (grad @ way) and step > 1e-3:
            step /= 2
        s, y = -step * way, got[1] - grad
        if s @ y > 0:
            steps = [*steps, (s, y, s @ y)][-memory:]
        w, (value, grad) = w + s, got
    return w


def _look(docs: DataFrame) -> DataFrame:
    """doc_id, vote pattern and features of each document, null where it has no words: indices of 16 bits and values of 32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for t in batch["text"]:
                x = look(t.as_py())
                at, val = features(*x) if x else (None, None)
                out.append((votes(x[2]), at.astype(np.uint16).tobytes(), val.tobytes()) if x else (None, None, None))
            cols = [pa.array(c, k) for c, k in zip(zip(*out), (pa.int32(), pa.binary(), pa.binary()))] if out else [pa.nulls(0, k) for k in (pa.int32(), pa.binary(), pa.binary())]
            yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.int64()), *cols], ["doc_id", "pattern", "at", "val"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, pattern int, at binary, val binary")


def _summed(seen: DataFrame, w: np.ndarray, codes: np.ndarray, soft: np.ndarray) -> tuple[float, np.ndarray]:
    """Over all rows of seen: the logistic loss of the weights, the last of which is the bias, and its gradient. soft: the labels of the patterns in codes."""
    shared = seen.sparkSession.sparkContext.broadcast((w, codes, soft))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, codes, soft = shared.value
        total = np.zeros(len(w) + 1, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            at = batch["at"].to_pylist()
            n = np.fromiter(map(len, at), np.int64, len(at)) // 2
            at = np.frombuffer(b"".join(at), np.uint16).astype(np.intp)
            val = np.frombuffer(b"".join(batch["val"].to_pylist()), np.float32)
            z = np.add.reduceat(val * w[at], np.cumsum(n) - n) + w[-1]
            y = soft[np.searchsorted(codes, batch["pattern"].to_numpy())]
            slope = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) * UNIT
            # sums of whole numbers, exact in any order
            total[:-2] += np.bincount(at, np.rint(val * np.repeat(slope, n)), len(w) - 1).astype(np.int64)
            total[-2] += int(np.rint(slope).sum())
            total[-1] += int(np.rint((np.logaddexp(0, z) - y * z) * UNIT).sum())
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], ["place", "value"])

    rows = seen.mapInArrow(run, "place int, value long").groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    shared.unpersist()
    total = np.zeros(len(w) + 1)
    total[rows["place"].to_numpy()] = rows["value"].to_numpy() / UNIT
    return float(total[-1]), total[:-1]


def _learnt(seen: DataFrame) -> tuple[LabelModel, np.ndarray] | None:
    seen = seen.where("pattern is not null")
    patterns = {r["pattern"]: r["n"] for r in seen.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not patterns:
        return None
    model = expectation_maximisation(patterns)
    codes, n = sorted(patterns), sum(patterns.values())
    soft = model.posterior(codes)
    # what a task of a pass costs by itself counts, as there are many passes
    seen = seen.select("pattern", "at", "val").coalesce(max(2 * seen.sparkSession.sparkContext.defaultParallelism, n // ROWS))

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        value, grad = _summed(seen, w, np.array(codes), soft)
        return value / n + DECAY / 2 * float(w @ w), grad / n + DECAY * w

    return model, train(loss, (1 << DIM) + 1)


def fit(docs: DataFrame) -> tuple[LabelModel, np.ndarray] | None:
    """docs(doc_id, text, ...) -> the label model and the scorer's weights, both of all documents."""
    seen = cut(_look(docs))
    fitted = _learnt(seen)
    uncut(seen)
    return fitted


SCHEMA = "doc_id long, posterior double, score double, keep boolean"
_ARROW = pa.schema([("doc_id", pa.int64()), ("posterior", pa.float64()), ("score", pa.float64()), ("keep", pa.bool_())])


def _scores(rows: Iterator[tuple[int, np.ndarray, np.ndarray] | None], model: LabelModel, w: np.ndarray) -> tuple[list[float], list[float]]:
    """Posteriors and scores of rows of (vote pattern, indices and values of features), None without words."""
    codes, out = [], []
    for x in rows:
        if x is None:
            codes.append(-1)
            out.append(0.0)
        else:
            codes.append(x[0])
            out.append(1 / (1 + float(np.exp(-np.clip(float((w[x[1]] * x[2]).sum() + w[-1]), -50, 50)))))
    kinds = sorted({c for c in codes if c >= 0})
    known = dict(zip(kinds, model.posterior(kinds).tolist())) | {-1: 0.0}
    return [known[c] for c in codes], out


def _seen(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray] | None]:
    for text in texts:
        x = look(text.as_py())
        yield None if x is None else (votes(x[2]), *features(*x))


def _judged(batch: pa.RecordBatch, p: list[float], s: list[float], threshold: float) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.int64()), pa.array(p, pa.float64()), pa.array(s, pa.float64()), pa.array([x >= threshold for x in s], pa.bool_())], schema=_ARROW)


def score(docs: DataFrame, fitted: tuple[LabelModel, np.ndarray] | None, threshold: float = THRESHOLD) -> DataFrame:
    """docs(doc_id, text, ...) -> SCHEMA, a row for each row; posterior is the label model's, score the scorer's."""
    if fitted is None:
        return docs.select("doc_id", F.lit(0.0).alias("posterior"), F.lit(0.0).alias("score"), F.lit(False).alias("keep"))
    shared = docs.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, w = shared.value
        for batch in batches:
            yield _judged(batch, *_scores(_seen(batch["text"]), model, w), threshold)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def judge(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """score() by what fit() learns of the same rows, with one look at the texts."""
    seen = cut(_look(docs))
    fitted = _learnt(seen)
    if fitted is None:
        uncut(seen)
        return score(docs, None, threshold)
    shared = docs.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, w = shared.value
        for batch in batches:
            rows = zip(*(batch[c].to_pylist() for c in ("pattern", "at", "val")))
            rows = (None if c is None else (c, np.frombuffer(a, np.uint16), np.frombuffer(v, np.float32)) for c, a, v in rows)
            yield _judged(batch, *_scores(rows, model, w), threshold)

    out = cut(seen.mapInArrow(run, SCHEMA))
    uncut(seen)
    return out


def keep_good(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that the classifier keeps, with all their columns."""
    fitted = fit(docs)
    if fitted is None:
        return docs.limit(0)
    shared = docs.sparkSession.sparkContext.broadcast(fitted)
    kinds = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, w = shared.value
        for batch in batches:
            yield batch.filter(pa.array([x >= threshold for x in _scores(_seen(batch["text"]), model, w)[1]], pa.bool_()))

    return docs.mapInArrow(run, kinds)
