"""SentencePiece encoding and decoding, with sampled segmentations without replacement.

The lattice of a text has the pieces of a SentencePiece model as edges. Units, cut before runs of spaces and at line ends,
are independent parts of it: no piece crosses a cut. Long units are cut further between code points that no piece has
side by side. A code point without a piece is spelled in byte pieces. A piece weighs (rank + SHIFT) ** -alpha, Zipf's law for the model's merge ranks, and a
segmentation has the product of its pieces' weights over the sum for all (per unit, by a forward sum).

Gumbel top-k without replacement: every segmentation has its log probability plus Gumbel noise; the k largest are
emitted. A-star search finds them without listing any others. A node is a set of segmentations that agree with a sample
up to a unit and differ there; its bound is the largest perturbed value in it, a Gumbel around the set's log mass, cut
off at its parent's. The root's best is a plain sample; it splits the rest into one node for each unit; the best open node gives
the next sample, and splits in turn. All nodes of a sample come from one vector of draws.

The inclusion score is 1 - exp(-exp(log_prob - kappa)), with kappa the (k + 1)th value: the probability to be among
the k, given kappa. Draws are seeded by (seed, doc_id, text): reruns agree.

Scale: one pass without a shuffle; a worker keeps units it has met, CACHE at most, and what a text needs grows with it.
Defined results: a null text is the empty text, which has one segmentation (the leading space); a text with fewer than k
segmentations emits them all, with score 1 (what has under 1e-12 of a unit's mass beside its best one counts as none); equal rows get equal samples; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import heapq
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
import xxhash
from pyspark.sql import DataFrame

MODEL = "piece_bpe_32k.model"
K = 2
ALPHA = 3.0
SHIFT = 10.0
SEED = 20240917
#: Units of more code points are cut where no piece crosses.
LONG = 16
CACHE = 250_000
#: Texts that are searched together, and their code points, about; a longer text is searched alone.
ROWS, CHARS = 512, 2_000_000
#: Code points in lattices that are built together, about; a longer unit is built alone.
CELLS = 8192 * 10
#: Bits of a slot in the tables of pieces; factor of their hash.
SLOTS, FACTOR = 20, 0x9E3779B97F4A7C15
SPACE = "▁"

_UNITS = re.compile(r" +[^ \n]*|[^ \n]+|\n")


def model_path(name: str = MODEL) -> str:
    """Where the public tokenizer files are on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Model:
    """Pieces, weights and the bytes that each piece stands for; units met so far, with their best segmentation."""

    def __init__(self, path: str, alpha: float):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        #: What ids are stored as: two bytes, or four where the vocabulary needs them.
        self.stored = np.dtype("<u2" if n <= 1 << 16 else "<u4")
        self.byte_ids = [0] * 256
        self.pieces: dict[str, tuple[int, float]] = {}
        spelled = [b""] * n
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_ids[value] = i
                spelled[i] = bytes([value])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.pieces[piece] = (i, (SHIFT - sp.get_score(i)) ** -alpha)
                spelled[i] = piece.replace(SPACE, " ").encode()
        self.byte_weight = (SHIFT + n) ** -alpha
        self.single = frozenset({" ", *(p for p in self.pieces if len(p) == 1)} - {SPACE})
        self.lens = np.array([len(b) for b in spelled], np.int64)
        self.offs = np.cumsum(self.lens) - self.lens
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.longest = max(map(len, self.pieces))
        if alpha * math.log10(SHIFT + n) * self.longest > 300:
            raise ValueError("weights of this alpha leave the range of doubles")
        if any(re.search(f"[^{SPACE}]{SPACE}|{SPACE}{SPACE}[^{SPACE}]|\\n", p) for p in self.pieces) or not self.single.issuperset("".join(self.pieces).replace(SPACE, " ")):
            raise ValueError("a piece of this model crosses words or lines, or has a code point that is no piece")
        self.pairs = frozenset(p[i : i + 2].replace(SPACE, " ") for p in self.pieces for i in range(len(p) - 1))
        #: Code points of each piece.
        self.chars = np.array([len(sp.id_to_piece(i)) for i in range(n)], np.int64)
        self._hash(list(self.pieces))
        self.units = Units(self)

    def _hash(self, pieces: list[str]) -> None:
        """Two tables from the high bits of a piece's hash to its row; what collides in the first is in the second."""
        rows = [(0, 0, 0.0)]
        self.tables = np.zeros((2, 1 << SLOTS), np.int32)
        for p in pieces:
            h = 0
            for ch in p:
                h = (h + ord(ch)) * FACTOR & (1 << 64) - 1
            rows.append((h, *self.pieces[p]))
            for table, slot in zip(self.tables, (h >> 64 - SLOTS, h >> 60 - SLOTS & (1 << SLOTS) - 1)):
                if not table[slot]:
                    table[slot] = len(rows) - 1
                    break
            else:
                raise ValueError("the piece tables need more slots")
        self.keys = np.array([r[0] for r in rows], np.uint64)
        self.ids = np.array([r[1] for r in rows], np.int32)
        self.weights = np.array([r[2] for r in rows])

    def _parts(self, u: str) -> list[str]:
        """A unit that is long or has code points without a piece, cut wherever no piece crosses."""
        at = [0, *(i for i in range(1, len(u)) if u[i - 1 : i + 1] not in self.pairs), len(u)]
        return [u[a:b] for a, b in zip(at, at[1:])]

    def cut(self, texts: list[str]) -> tuple[list[list[str]], set[str]]:
        """The units of each text, and those that may not be known yet. What a unit is cut into is looked up once for all texts."""
        found = [_UNITS.findall(" " + t) for t in texts]
        new = set().union(*found).difference(self.units)
        odd = {u: self._parts(u) for u in new if len(u) > LONG or not self.single.issuperset(u)}
        if odd:
            found = [l if odd.keys().isdisjoint(l) else [p for u in l for p in odd.get(u, (u,))] for l in found]
            new = new.difference(odd).union(*odd.values())
        return found, new

    def edges(self, unit: str) -> list[list[tuple[int, tuple[int, ...], float]]]:
        """For each place in the unit the edges that end there: (start, ids, weight)."""
        s = unit.replace(SPACE, "\uffff").replace(" ", SPACE)
        ends: list[list] = [[] for _ in range(len(s) + 1)]
        for a in range(len(s)):
            for b in range(a + 1, len(s) + 1):
                if (hit := self.pieces.get(s[a:b])) is not None:
                    ends[b].append((a, (hit[0],), hit[1]))
            if s[a] not in self.pieces:
                ids = tuple(self.byte_ids[x] for x in unit[a].encode())
                ends[a + 1].append((a, ids, self.byte_weight ** len(ids)))
        return ends

    def decode(self, ids: np.ndarray) -> str:
        """The text of a segmentation: bytes in order, less the leading space."""
        n = self.lens[ids]
        at = np.arange(int(n.sum())) + np.repeat(self.offs[ids] - (np.cumsum(n) - n), n)
        return self.spelled[at].tobytes()[1:].decode()


class Lattices:
    """The lattices of many units at once; every code point of them has a piece. Arrays by (end, length - 1, unit) hold the
    edges' ids, and their shares of the sum over all paths that end there; by (end, unit) the logarithms of that sum and of the
    best path's part of it, and the length of its last edge. Sums are carried as ratios, so that long units stay in range."""

    def __init__(self, model: Model, units: list[str]):
        n = len(units)
        self.size = np.fromiter(map(len, units), np.int64, n)
        m = int(self.size.max())
        top = min(m, model.longest)
        code = np.frombuffer("".join([u.ljust(m, "\0") for u in units]).replace(" ", SPACE).encode("utf-32-le"), np.uint32).reshape(n, m).astype(np.uint64)
        self.share = np.zeros((m + 1, top, n))
        self.ids = np.zeros((m + 1, top, n), np.int32)
        code = np.ascontiguousarray(code.T)
        h = np.zeros((m, n), np.uint64)
        for k in range(1, top + 1):
            h = (h[: m - k + 1] + code[k - 1 :]) * np.uint64(FACTOR)
            row = model.tables[0][h >> np.uint64(64 - SLOTS)]
            miss = model.keys[row] != h
            row[miss] = model.tables[1][(h[miss] >> np.uint64(60 - SLOTS)) & np.uint64((1 << SLOTS) - 1)]
            row[model.keys[row] != h] = 0
            self.share[k:, k - 1] = model.weights[row]
            self.ids[k:, k - 1] = model.ids[row]
        self.log_total = np.zeros((m + 1, n))
        self.log_best = np.zeros((m + 1, n))
        self.last = np.zeros((m + 1, n), np.int64)
        # by length - 1: the sum over paths, and the best path, at an edge's start over those at the place before
        sums, highs = np.zeros((top, n)), np.zeros((top, n))
        sums[0] = highs[0] = 1.0
        for j in range(1, m + 1):
            c = min(j, top)
            part = sums[:c] * self.share[j, :c]
            path = highs[:c] * self.share[j, :c]
            total, best = part.sum(axis=0), path.max(axis=0)
            total[total == 0] = best[best == 0] = 1.0  # behind a unit's end
            self.share[j, :c] = part / total
            self.last[j] = path.argmax(axis=0) + 1
            self.log_total[j] = self.log_total[j - 1] + np.log(total)
            self.log_best[j] = self.log_best[j - 1] + np.log(best / total)
            sums[1 : c + 1] = (sums[:c] / total)[: top - 1]
            highs[1 : c + 1] = (highs[:c] / best)[: top - 1]

    @property
    def total(self) -> np.ndarray:
        return np.exp(self.log_total)

    def walk(self, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each row its best path: ids from the end, their number, and the product of weights (of units that are short)."""
        ids, count, log_p = self.paths(row)
        return ids, count, np.exp(log_p + self.log_total[self.size[row], row])

    def paths(self, row: np.ndarray, draws: np.ndarray | None = None, at: np.ndarray | None = None, on: np.ndarray | None = None, ruled: list | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each row its best path, or with draws (one a step, from `at` on) one in proportion to its weight, that isn't the
        best one where `on`, nor any of `ruled` (index of row, lengths of edges): ids from the end, their number, and the log
        probability. On a path that is ruled out, an edge counts by what can still leave it."""
        n = len(row)
        out, count, log_p = np.zeros((n, int(self.size[row].max(initial=0))), np.int32), np.zeros(n, np.int64), np.zeros(n)
        place, live, where = self.size[row].copy(), np.arange(n), np.zeros(n, np.int64)
        ruled = ruled or []
        owner = np.array([e for e, _ in ruled], np.int64)
        edge, before = (np.zeros((len(ruled), max([len(k) for _, k in ruled], default=0) + 1), kind) for kind in (np.int64, float))
        for x, (e, k) in enumerate(ruled):
            ends = np.cumsum(k)
            edge[x, : len(k)] = k[::-1]
            before[x, : len(k) - 1] = np.cumsum(np.log(self.share[ends, k - 1, row[e]]))[-2::-1]
        alive = np.ones(len(ruled), bool)
        step = 0
        while len(live):
            r, j = row[live], place[live]
            if draws is None:
                k = self.last[j, r]
            else:
                flow = self.share[j, :, r]
                mass = np.zeros_like(flow)
                stay = np.flatnonzero(on[live])
                k = self.last[j[stay], r[stay]]
                mass[stay, k - 1] = np.exp(self.log_best[j[stay] - k, r[stay]])
                where[live] = np.arange(len(live))
                x = np.flatnonzero(alive)
                if len(x):
                    np.add.at(mass, (where[owner[x]], edge[x, step] - 1), np.exp(before[x, step]))
                flow *= np.where(mass < 1 - 1e-13, 1 - mass, 0.0)
                total = np.cumsum(flow, axis=1)
                k = np.minimum(((draws[at[live] + step] * total[:, -1])[:, None] >= total).sum(axis=1), total.shape[1] - 1) + 1
                on[live] &= k == self.last[j, r]
                if len(x):
                    alive[x] = k[where[owner[x]]] == edge[x, step]
            out[live, step] = self.ids[j, k - 1, r]
            log_p[live] += np.log(self.share[j, k - 1, r])
            count[live] += 1
            place[live] = j - k
            live = live[place[live] > 0]
            step += 1
        return out, count, log_p


def _chunks(size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of units, by ascending size, whose lattices are built together."""
    a = 0
    while a < len(size):
        b = a + max(1, int(np.searchsorted(np.arange(1, len(size) - a + 1) * size[a:], CELLS, side="right")))
        yield a, b
        a = b


class Units(dict):
    """Unit -> index. Arrays hold, for each index, the log probability of its best segmentation, of all others, and its ids."""

    def __init__(self, model: Model):
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.text: list[str] = []
        self.log_p = np.zeros(1024)
        self.chars = np.zeros(1024, np.int64)
        self.rest = np.zeros(1024)
        self.size = np.zeros(1024, np.int64)
        self.off = np.zeros(1024, np.int64)
        self.pool = np.zeros(8192, self.model.stored)
        self.used = 0

    def learn(self, units: set[str]) -> None:
        """Adds units that aren't known yet, all at once; a code point without a piece has one segmentation."""
        new = sorted(units.difference(self), key=len)
        plain, odd = [], []
        for u in new:
            (plain if self.model.single.issuperset(u) else odd).append(u)
        for a, b in _chunks(np.fromiter(map(len, plain), np.int64, len(plain))):
            lat = Lattices(self.model, plain[a:b])
            ids, count, _ = lat.paths(np.arange(b - a))
            flat = np.concatenate([i[:n][::-1] for i, n in zip(ids, count)])
            self._add(plain[a:b], lat.log_best[lat.size, np.arange(b - a)], count, flat)
        spelled = [[self.model.byte_ids[x] for x in u.encode()] for u in odd]
        if spelled:
            self._add(odd, np.zeros(len(spelled)), np.array(list(map(len, spelled))), np.concatenate(spelled))

    def _add(self, units: list[str], log_p: np.ndarray, count: np.ndarray, flat: np.ndarray) -> None:
        k, n = len(self.text), len(units)
        while k + n > len(self.log_p):
            for name in ("log_p", "chars", "rest", "size", "off"):
                setattr(self, name, np.concatenate([getattr(self, name)] * 2))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, self.pool])
        log_p = np.minimum(log_p, 0.0)
        self.log_p[k : k + n] = log_p
        self.chars[k : k + n] = list(map(len, units))
        self.rest[k : k + n] = np.where(log_p < -1e-12, np.log(-np.expm1(np.minimum(log_p, -1e-13))), -np.inf)
        self.size[k : k + n] = count
        self.off[k : k + n] = self.used + np.cumsum(count) - count
        self.pool[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        self.text += units
        self.update(zip(units, range(k, k + n)))

    def best(self, k: int) -> tuple[int, ...]:
        return tuple(self.pool[self.off[k] : self.off[k] + self.size[k]].tolist())


@functools.lru_cache(maxsize=512)
def _ranked(model: Model, unit: str) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """All segmentations of a short unit, best first, and their probabilities: what lattices are tested against."""
    ends = model.edges(unit)
    made: list[list] = [[((), 1.0)]] + [[] for _ in unit]
    for j in range(1, len(unit) + 1):
        made[j] = [(ids + e[1], w * e[2]) for e in ends[j] for ids, w in made[e[0]]]
    every = sorted(made[-1], key=lambda x: (-x[1], x[0]))
    p = np.array([w for _, w in every])
    return [ids for ids, _ in every], p / p.sum()


def _but(model: Model, kinds: np.ndarray, draws: np.ndarray, ruled: list | None = None) -> list[tuple[tuple[int, ...], float]]:
    """For each unit index a segmentation other than those ruled out, by default the unit's best one, and its log probability.
    There are as many draws for each as the unit has code points."""
    units = model.units
    every, row = np.unique(kinds, return_inverse=True)
    order = np.argsort(units.chars[every], kind="stable")
    every, row = every[order], np.argsort(order, kind="stable")[row]
    size = units.chars[kinds]
    at = np.cumsum(size) - size
    out: list = [None] * len(kinds)
    for a, b in _chunks(units.chars[every]):
        lat = Lattices(model, [units.text[k] for k in every[a:b].tolist()])
        mine = np.flatnonzero((row >= a) & (row < b))
        on, paths = np.ones(len(mine), bool), []
        for e, i in enumerate(mine.tolist() if ruled else ()):
            best = units.best(int(kinds[i]))
            on[e] = best in ruled[i]
            paths += [(e, model.chars[list(ids)]) for ids in ruled[i] if ids != best]
        ids, count, log_p = lat.paths(row[mine] - a, draws, at[mine], on, paths)
        for e, i, n, lp in zip(mine.tolist(), ids, count.tolist(), log_p.tolist()):
            out[e] = (tuple(i[:n][::-1].tolist()), lp)
    return out


class Sample:
    """A segmentation: for each unit its best one, but for those in `changed`."""

    def __init__(self, changed: dict[int, tuple[tuple[int, ...], float]], log_p: np.ndarray, value: float):
        self.changed, self.log_p, self.value = changed, log_p, value


class Search:
    """A-star search over the segmentations of one text."""

    def __init__(self, model: Model, t: np.ndarray, rng: np.random.Generator):
        self.model, self.t, self.rng = model, t, rng
        self.out: list[Sample] = []
        # (-bound, order, sample, unit, segmentations ruled out there or None, bounds of the sample's other nodes, their start)
        self.heap: list[tuple] = []
        self.order = 0
        self.left = -math.inf

    def offer(self, s: Sample, bounds: np.ndarray, start: int) -> None:
        if len(bounds):
            i = int(np.argmax(bounds))
            if bounds[i] > -math.inf:
                heapq.heappush(self.heap, (-float(bounds[i]), self.order, s, start + i, None, bounds, start))
                self.order += 1

    def bounds(self, s: Sample, start: int) -> np.ndarray:
        """The largest perturbed value in each node (agree with s before i, differ at i), i from start on."""
        rest = self.model.units.rest[self.t[start:]].copy()
        for i, (_, lp) in s.changed.items():
            if i >= start:
                rest[i - start] = math.log1p(-math.exp(lp)) if lp < -1e-12 else -math.inf
        before = np.cumsum(s.log_p) - s.log_p
        noise = -np.log(self.rng.random(len(rest)) + 1e-300)
        return -np.logaddexp(-s.value, np.log(noise) - (before[start:] + rest))

    def next(self) -> tuple[Sample, int, dict, float] | None:
        """The best open node: its sample, unit, what is ruled out there with log probabilities, and its bound; what is left of it goes back."""
        if not self.heap:
            return None
        bound, _, s, i, ruled_out, bounds, start = heapq.heappop(self.heap)
        if ruled_out is None:  # one of a sample's vector of nodes: the next of them takes its place
            bounds[i - start] = -math.inf
            self.offer(s, bounds, start)
            ruled_out = dict([s.changed[i] if i in s.changed else (self.model.units.best(int(self.t[i])), float(s.log_p[i]))])
        return s, i, ruled_out, -bound

    def begin(self, head: Sample | None, start: int, at: tuple | None, value: float) -> tuple[Sample, np.ndarray]:
        """A sample with head's units before start - 1 and `at` there; and the units from start on that aren't the best."""
        units = self.model.units
        log_p = units.log_p[self.t]
        changed: dict[int, tuple[tuple[int, ...], float]] = {}
        if head is not None:
            log_p[: start - 1] = head.log_p[: start - 1]
            changed = {i: c for i, c in head.changed.items() if i < start - 1}
            changed[start - 1] = at[:2]
            log_p[start - 1] = at[1]
        p = np.exp(log_p[start:])
        p[units.rest[self.t[start:]] == -math.inf] = 2.0
        return Sample(changed, log_p, value), np.flatnonzero(self.rng.random(len(p)) >= p) + start


def _finish(model: Model, begun: list[tuple[Search, Sample, np.ndarray, int]]) -> None:
    """Draws the units that differ from the best for all samples at once, and opens their nodes."""
    kinds = [x.t[e] for x, _, e, _ in begun]
    draws = [x.rng.random(int(model.units.chars[t].sum())) for (x, *_), t in zip(begun, kinds)]
    found = iter(_but(model, np.concatenate(kinds), np.concatenate(draws)) if sum(map(len, kinds)) else ())
    for x, s, events, start in begun:
        for i in events.tolist():
            s.changed[i] = c = next(found)
            s.log_p[i] = c[1]
        x.out.append(s)
        x.offer(s, x.bounds(s, start), start)


def top_k(model: Model, texts: list[str], k: int, rngs: list[np.random.Generator]) -> list[Search]:
    """A finished search for each text: `t` has its units, `out` its samples in order of perturbed value, and `left` is the
    (k + 1)th value."""
    units = model.units
    if len(units) > CACHE:
        units.reset()
    cut, new = model.cut(texts)
    units.learn(new)
    searches = [Search(model, np.fromiter(map(units.__getitem__, c), np.int64, len(c)), r) for c, r in zip(cut, rngs)]
    begun = [(x, *x.begin(None, 0, None, -math.log(-math.log(x.rng.random() + 1e-300))), 0) for x in searches]
    _finish(model, begun)
    for _ in range(1, k):
        nodes = [(x, n) for x in searches if (n := x.next()) is not None]
        kinds = np.array([x.t[n[1]] for x, n in nodes], np.int64)
        drawn = _but(model, kinds, np.concatenate([x.rng.random(int(units.chars[x.t[n[1]]])) for x, n in nodes]), [n[2] for _, n in nodes]) if nodes else []
        begun = []
        for (x, (s, i, ruled_out, bound)), (ids, lp) in zip(nodes, drawn):
            rest = 1 - sum(map(math.exp, ruled_out.values())) - math.exp(lp)
            found = (ids, lp, math.log(rest) if rest > 1e-12 else -math.inf)
            begun.append((x, *x.begin(s, i + 1, found, bound), i + 1))
            if found[2] > -math.inf:  # what else is left at this unit
                mass = float(s.log_p[:i].sum()) + found[2]
                left = -float(np.logaddexp(-bound, math.log(-math.log(x.rng.random() + 1e-300)) - mass))
                heapq.heappush(x.heap, (-left, x.order, s, i, ruled_out | {ids: lp}, None, 0))
                x.order += 1
        if begun:
            _finish(model, begun)
    for x in searches:
        x.left = -x.heap[0][0] if x.heap else -math.inf
    return searches


def ids_of(model: Model, t: np.ndarray, s: Sample) -> np.ndarray:
    """The piece ids of a sample, in order."""
    units = model.units
    size, off = units.size[t], units.off[t]
    at = np.fromiter(s.changed, np.int64, len(s.changed))
    n = np.array([len(ids) for ids, _ in s.changed.values()], np.int64)
    size[at], off[at] = n, 0
    end = np.cumsum(size)
    out = units.pool[np.minimum(np.arange(int(end[-1])) + np.repeat(off - (end - size), size), len(units.pool) - 1)]
    if len(at):
        place = np.arange(int(n.sum())) + np.repeat((end - size)[at] - (np.cumsum(n) - n), n)
        out[place] = [i for ids, _ in s.changed.values() for i in ids]
    return out


@functools.lru_cache(maxsize=2)
def model_of(path: str, alpha: float) -> Model:
    return Model(path, alpha)


def generator(seed: int, doc_id: int | None, text: str) -> np.random.Generator:
    return np.random.Generator(np.random.Philox(key=[xxhash.xxh3_64_intdigest(text.encode(), seed), (doc_id or 0) % (1 << 64)]))


SCHEMA = "doc_id long, rank int, n_pieces int, ids binary, ids_crc32 long, log_prob double, perturbed double, inclusion double, round_trip boolean"
_ARROW = pa.schema([
    ("doc_id", pa.int64()), ("rank", pa.int32()), ("n_pieces", pa.int32()), ("ids", pa.binary()), ("ids_crc32", pa.int64()),
    ("log_prob", pa.float64()), ("perturbed", pa.float64()), ("inclusion", pa.float64()), ("round_trip", pa.bool_()),
])


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[list, list[str]]]:
    """Ids and texts of a batch, so many at a time as are searched together; a null text is empty."""
    ids, texts, size = [], [], 0
    for doc_id, text in zip(batch["doc_id"], batch["text"]):
        text = text.as_py() or ""
        if ids and (len(ids) == ROWS or size + len(text) > CHARS):
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(doc_id.as_py())
        texts.append(text)
        size += len(text)
    if ids:
        yield ids, texts


def encode(docs: DataFrame, k: int = K, alpha: float = ALPHA, seed: int = SEED, path: str | None = None) -> DataFrame:
    """docs(doc_id, text, ...) -> SCHEMA: up to k rows for each row, rank from 1; ids are little-endian, of 16 bits (32 if the model has over 65,536 pieces); round_trip
    says that decoding them gives the text back."""
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path, alpha)
        for batch in batches:
            for ids_, texts in _parts(batch):
                rows: list[tuple] = []
                for doc_id, text, x in zip(ids_, texts, top_k(model, texts, k, [generator(seed, i, t) for i, t in zip(ids_, texts)])):
                    for rank, s in enumerate(x.out, 1):
                        ids = ids_of(model, x.t, s)
                        log_p = float(s.log_p.sum())
                        score = 1.0 if x.left == -math.inf else -math.expm1(-math.exp(min(700.0, log_p - x.left)))
                        raw = ids.astype(model.stored).tobytes()
                        rows.append((doc_id, rank, len(ids), raw, zlib.crc32(raw), log_p, s.value, score, model.decode(ids) == text))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def decode(rows: DataFrame, path: str | None = None) -> DataFrame:
    """rows(doc_id, rank, ids) -> doc_id, rank, text."""
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = model_of(path, ALPHA)
        for batch in batches:
            text = [model.decode(np.frombuffer(x.as_py(), model.stored)) for x in batch["ids"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["rank"], pa.array(text, pa.string())], ["doc_id", "rank", "text"])

    return rows.select("doc_id", "rank", "ids").mapInArrow(run, "doc_id long, rank int, text string")
