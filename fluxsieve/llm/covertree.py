"""Exact near-duplicate embeddings: cover trees and dual traversal.

Vectors with equal labels are compared by cosine, in double precision. On unit vectors a cosine of at least c
is a distance of at most sqrt(2 - 2c), a metric, so that trees of nested balls can bound whole groups.

A cover tree has levels of halving radii: the centres of a level lie further apart than its radius, cover
all points of their parent, and a centre is its own child. Every node keeps its covering radius: the exact
distance to its farthest descendant. The dual traversal takes pairs of nodes: centres further apart than both
radii and the threshold rule all their pairs out; centres so near that even the farthest points link make
all their pairs links, which are counted, not listed; the children of all other pairs are compared in one product.

Scale: vectors with equal entries and label are one point with a multiplicity, combined before the shuffle. A label with more than BLOCK
points is cut into cells by the nearest of some of them (drawn by hash, PIVOTS in all labels together: the centres of an upper level), and a
cell that is still too large by hash. A cell is a tree with its exact root radius; cells whose centres are further apart
than both radii and the threshold are never paired. The other pairs are dealt in tiles of TILE by TILE cells, so that a
cell is copied once a tile. A tile returns, for each point, its number of links and one edge of a spanning forest, so that a group of
n near copies costs n rows, not n * n. Nothing is collected but the pivots.
How many cell pairs are ruled out is up to the data: clustered vectors are pruned well, while no ball bound can rule
out anything among vectors without clusters in many dimensions, where the threshold spans the whole spread of distances; there
the work is that of blocked matrix products.

Defined results: a row for each vector, which is a distinct (vec_id, label, entries): repeated rows are one. Null labels, null vectors and
vectors that are zero or hold nulls or non-finite values link with nothing; vectors of different length neither; ties at the threshold link. A null
vec_id is no name for a component: component_id is null only if all of its vec_ids are. kept is true where vec_id
and component_id are equal, or both null. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .components import components

COSINE = 0.93
#: Points of a block, about.
BLOCK = 2048
LEAF = 16
#: Pivots of all labels together, at most.
PIVOTS = 4096
#: Cells on a side of a tile.
TILE = 8
#: Slack of the bounds: square roots of rounded differences are off by so much near 0.
SLACK = 1e-7
#: Products within this of the threshold are computed again in plain order.
EPS = 1e-9


class Tree:
    """Cover tree of unit vectors. Nodes are in breadth-first order, the children of a node side by side; a node's
    points are the slice [start, end) of `points`."""

    def __init__(self, unit: np.ndarray, **held: np.ndarray):
        self.unit = unit
        if held:
            self.__dict__.update(held)
            return
        order = np.arange(len(unit))
        start, end, centre, radius, kids = [0], [len(unit)], [0], [0.0], []
        at, level = 0, {0: 2.0}
        while at < len(start):
            a, b, c = start[at], end[at], centre[at]
            mine = order[a:b].copy()
            dist = self._dist(mine, c)
            radius[at] = float(dist.max())
            first = len(start)
            r = level.pop(at)
            while r > radius[at] and r > 1e-6:
                r /= 2
            if b - a > LEAF and radius[at] > 1e-6:
                left, lo, net = mine, a, c
                near = dist
                while True:
                    inside = near <= r
                    # the centre itself comes first in its slice
                    members = np.concatenate([[net], left[inside & (left != net)]])
                    order[lo : lo + len(members)] = members
                    start.append(lo)
                    end.append(lo + len(members))
                    centre.append(int(net))
                    radius.append(0.0)
                    level[len(start) - 1] = r / 2
                    lo += len(members)
                    left = left[~inside]
                    if not len(left):
                        break
                    net = int(left[0])
                    near = self._dist(left, net)
            kids.append((first, len(start)))
            at += 1
        self.points, self.start, self.end = order, np.array(start), np.array(end)
        self.centre, self.radius, self.kids = np.array(centre), np.array(radius), np.array(kids)

    def _dist(self, of: np.ndarray, to: int) -> np.ndarray:
        d = np.sqrt(np.maximum(0.0, 2 - 2 * (self.unit[of] @ self.unit[to])))
        d[of == to] = 0.0
        return d

    def children(self, node: int) -> np.ndarray:
        """Node indices; an empty array for a leaf."""
        return np.arange(*self.kids[node])

    def save(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **{k: v for k, v in self.__dict__.items() if k != "unit"})
        return out.getvalue()

    @staticmethod
    def load(unit: np.ndarray, data: bytes) -> Tree:
        with np.load(io.BytesIO(data)) as z:
            return Tree(unit, **{k: z[k] for k in z.files})


class Links:
    """Link counts and a spanning forest over the points of one tree, or of two (the second's after the first's). A link
    counts as often as the point at its other end."""

    def __init__(self, times: np.ndarray):
        self.times = times
        self.count = np.zeros(len(times), np.int64)
        self.parent = np.arange(len(times))
        self.edges: list[tuple[int, int]] = []

    def root(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = int(p[x])
        return x

    def union(self, a: int, b: int) -> None:
        ra, rb = self.root(a), self.root(b)
        if ra != rb:
            self.parent[max(ra, rb)] = min(ra, rb)
            self.edges.append((a, b))

    def all_pairs(self, a: np.ndarray, b: np.ndarray) -> None:
        """Every point of a links with every other point of b; a and b are the same points or have none in common."""
        same = a is b
        self.count[a] += self.times[b].sum() - (self.times[a] if same else 0)
        if not same:
            self.count[b] += self.times[a].sum()
        for q in b[same:]:
            self.union(int(a[0]), int(q))
        if not same:
            for p in a[1:]:
                self.union(int(p), int(b[0]))


def linked(x: np.ndarray, y: np.ndarray, cosine: float) -> np.ndarray:
    """Matrix of booleans: which unit vectors reach the cosine."""
    s = x @ y.T
    out = s >= cosine
    for i, j in np.argwhere(np.abs(s - cosine) < EPS):
        out[i, j] = float(np.sum(x[i] * y[j])) >= cosine
    return out


def dual(a: Tree, b: Tree, cosine: float, links: Links, shift: int) -> None:
    """Adds all links between the points of a and those of b, whose indices are shifted; a may be b, with shift 0."""
    same = a is b
    t = float(np.sqrt(2 - 2 * cosine))
    open_ = [(0, 0)]
    while open_:
        i, j = open_.pop()
        self_pair = same and i == j
        ka, kb = a.children(i), b.children(j)
        pa_, pb_ = a.points[a.start[i] : a.end[i]], b.points[b.start[j] : b.end[j]]
        if self_pair and 2 * a.radius[i] <= t - SLACK:
            links.all_pairs(pa_, pa_)
            continue
        if not len(ka) and not len(kb):
            ok = linked(a.unit[pa_], b.unit[pb_], cosine)
            if self_pair:
                ok = np.triu(ok, 1)
            for x, y in np.argwhere(ok):
                p, q = int(pa_[x]), int(pb_[y]) + shift
                links.count[p] += links.times[q]
                links.count[q] += links.times[p]
                links.union(p, q)
            continue
        # a leaf stands for itself; the larger node of a pair is always opened, here both are
        ka = ka if len(ka) else np.array([i])
        kb = kb if len(kb) else np.array([j])
        for lo in range(0, len(ka), 2048):
            rows = ka[lo : lo + 2048]
            d = np.sqrt(np.maximum(0.0, 2 - 2 * (a.unit[a.centre[rows]] @ b.unit[b.centre[kb]].T)))
            reach = a.radius[rows][:, None] + b.radius[kb][None]
            near = d <= reach + t + SLACK
            if self_pair:
                near &= rows[:, None] <= kb[None]
            every = near & (d + reach <= t - SLACK)
            if self_pair:
                every &= rows[:, None] < kb[None]
            for x, y in np.argwhere(every):
                u, v = rows[x], kb[y]
                links.all_pairs(a.points[a.start[u] : a.end[u]], b.points[b.start[v] : b.end[v]] + shift)
            open_ += [(int(rows[x]), int(kb[y])) for x, y in np.argwhere(near & ~every)]


_VALID = pa.schema([("node", pa.int64()), ("label", pa.int64()), ("dim", pa.int32()), ("vec", pa.binary())])


def _valid(vectors: DataFrame) -> DataFrame:
    """The vectors that can link, as doubles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {f.name: [] for f in _VALID}
            for node, label, v in zip(batch["node"].to_pylist(), batch["label"].to_pylist(), batch["embedding"]):
                if label is None or not v.is_valid or v.values.null_count or not len(v.values):
                    continue
                x = v.values.to_numpy(zero_copy_only=False).astype(float)
                if not np.isfinite(x).all() or not x.any():
                    continue
                for k, one in zip(out, (node, label, len(x), x.tobytes())):
                    out[k].append(one)
            yield pa.RecordBatch.from_pydict(out, schema=_VALID)

    return vectors.select("node", F.col("label").cast("long").alias("label"), "embedding").mapInArrow(run, "node long, label long, dim int, vec binary")


def units(raw: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled first so that squares neither overflow nor vanish."""
    x = raw / np.abs(raw).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _pivots(points: DataFrame, block: int) -> dict[tuple[int, int], np.ndarray]:
    """(label, dim) -> unit vectors, for labels of more than a block: a share of PIVOTS by size, each as far as can be from those
    before it, out of four times as many, the least by hash."""
    per = points.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
    total = per.agg(F.sum("n").alias("n")).first()["n"]
    if not total:
        return {}
    wanted = per.select("label", "dim", "n", F.least(F.ceil(F.col("n") / block), F.floor(F.col("n") * PIVOTS / total)).alias("k")).where("k > 1")
    draw = F.pmod(F.xxhash64(F.lit(5), "h1", "h2"), F.lit(1 << 40)) / float(1 << 40)
    drawn = points.join(wanted, ["label", "dim"]).where(draw <= (4 * F.col("k") + 8 * F.sqrt("k")) / F.col("n"))
    got: dict[tuple[int, int], list] = {}
    size = {}
    for r in drawn.select("label", "dim", "k", draw.alias("draw"), "vec").orderBy("label", "dim", "draw", "vec").toLocalIterator():
        own = got.setdefault((r["label"], r["dim"]), [])
        size[r["label"], r["dim"]] = r["k"]
        if len(own) < 4 * r["k"]:
            own.append(np.frombuffer(r["vec"], float))
    return {k: _spread(units(np.stack(v)), size[k]) for k, v in got.items()}


def _spread(unit: np.ndarray, k: int) -> np.ndarray:
    """k of the vectors, farthest first."""
    chosen, nearest = [0], unit @ unit[0]
    while len(chosen) < min(k, len(unit)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return unit[chosen]


def _cells(points: DataFrame, block: int) -> DataFrame:
    """points plus cell and cut, which with label and dim name a block."""
    pivots = _pivots(points, block)
    if not pivots:
        return points.withColumn("cell", F.lit(0)).withColumn("cut", F.lit(0))
    shared = points.sparkSession.sparkContext.broadcast(pivots)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = shared.value
        for batch in batches:
            kinds = pd.DataFrame({"label": batch["label"].to_numpy(), "dim": batch["dim"].to_numpy()})
            cell = np.zeros(batch.num_rows, np.int32)
            for key, at in kinds.groupby(["label", "dim"]).indices.items():
                if key in of:
                    unit = units(np.frombuffer(b"".join(batch["vec"].take(pa.array(at)).to_pylist()), float).reshape(len(at), -1))
                    cell[at] = (unit @ of[key].T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], [*batch.schema.names, "cell"])

    kinds = ", ".join(f"{n} {t}" for n, t in points.dtypes)
    cells = points.mapInArrow(nearest, kinds + ", cell int")
    sizes = cells.groupBy("label", "dim", "cell").agg(F.ceil(F.count(F.lit(1)) / block).alias("cuts"))
    return cells.join(sizes, ["label", "dim", "cell"]).withColumn("cut", F.pmod(F.xxhash64("h1", "h2"), F.col("cuts")).cast("int")).drop("cuts")


def block_pairs(trees: DataFrame, cosine: float) -> DataFrame:
    """trees(id, label, dim, radius, centre) -> the pairs (id_a, id_b) that may hold links, a block and itself included."""
    slim = trees.select("id", "label", "dim", "radius", "centre")
    a, b = (slim.select("label", "dim", *[F.col(c).alias(f"{c}_{s}") for c in ("id", "radius", "centre")]) for s in "ab")
    dot = F.aggregate(F.zip_with("centre_a", "centre_b", lambda x, y: x * y), F.lit(0.0), lambda x, y: x + y)
    apart = F.sqrt(F.greatest(F.lit(0.0), F.lit(2.0) - 2 * dot))
    pairs = a.join(b, ["label", "dim"]).where("id_a <= id_b")
    return pairs.where(apart <= F.col("radius_a") + F.col("radius_b") + float(np.sqrt(2 - 2 * cosine)) + SLACK).select("label", "id_a", "id_b")


def make_trees(points: DataFrame, block: int) -> DataFrame:
    """points(cls, times, label, dim, vec, h1, h2) -> a row for each block, with its tree."""

    def build(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        label, dim, cell, part = key
        group = group.sort_values("cls", kind="stable")
        unit = units(np.frombuffer(b"".join(group["vec"]), float).reshape(-1, dim))
        tree = Tree(unit)
        return pd.DataFrame({
            "label": [label], "dim": [dim], "cell": [cell], "cut": [part], "radius": [tree.radius[0]], "centre": [unit[tree.centre[0]].tolist()],
            "ids": [group["cls"].to_numpy(np.int64).tobytes()], "times": [group["times"].to_numpy(np.int64).tobytes()], "vecs": [unit.tobytes()], "tree": [tree.save()],
        })

    trees = _cells(points, block).groupBy("label", "dim", "cell", "cut").applyInPandas(
        build, "label long, dim int, cell int, cut int, radius double, centre array<double>, ids binary, times binary, vecs binary, tree binary"
    )
    return cut(trees.withColumn("id", F.xxhash64("label", "dim", "cell", "cut")))


def near_links(points: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """points(cls, times, label, dim, vec, h1, h2) -> (cls, links) sums still to be added up, and forest edges (a, b)."""
    trees = make_trees(points, block)
    tile = [F.pmod(F.xxhash64(F.lit(9), f"id_{s}"), F.col("tiles")) for s in "ab"]
    tiles = trees.groupBy("label").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("tiles"))
    pairs = block_pairs(trees, cosine).join(tiles, "label")
    pairs = cut(pairs.select(F.xxhash64("label", F.least(*tile), F.greatest(*tile)).alias("tile"), "id_a", "id_b"))
    sides = pairs.select(F.col("tile").alias("in_tile"), F.explode(F.array("id_a", "id_b")).alias("id")).distinct()
    sides = sides.join(trees.select("id", "dim", "ids", "times", "vecs", "tree"), "id").withColumnRenamed("tree", "saved")

    def traverse(pairs: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        held = {}
        for r in blocks.itertuples():
            held[r.id] = (Tree.load(np.frombuffer(r.vecs, float).reshape(-1, r.dim), r.saved), np.frombuffer(r.ids, np.int64), np.frombuffer(r.times, np.int64))
        out = []
        for a, b in sorted(zip(pairs["id_a"].tolist(), pairs["id_b"].tolist())):
            both = [held[a]] if a == b else [held[a], held[b]]
            links = Links(np.concatenate([x[2] for x in both]))
            dual(both[0][0], both[-1][0], cosine, links, len(both[0][1]) if a != b else 0)
            every = np.concatenate([x[1] for x in both])
            some = np.flatnonzero(links.count)
            edges = np.array(links.edges, np.int64).reshape(-1, 2)
            out.append(pd.DataFrame({"cls": every[some], "links": links.count[some], "other": pd.array([None] * len(some), dtype="Int64")}))
            out.append(pd.DataFrame({"cls": every[edges[:, 0]], "links": np.zeros(len(edges), np.int64), "other": pd.array(every[edges[:, 1]], dtype="Int64")}))
        return pd.concat(out) if out else pd.DataFrame({"cls": [], "links": [], "other": []})

    found = cut(pairs.groupBy("tile").cogroup(sides.groupBy("in_tile")).applyInPandas(traverse, "cls long, links long, other long"))
    return found.where("other is null").select("cls", "links"), found.where("other is not null").select(F.col("cls").alias("a"), F.col("other").alias("b"))


def near_duplicates(rows: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """rows(vec_id, label, embedding, ...) -> vec_id, n_links, component_id (least vec_id reachable), kept."""
    # numbers are written with the rows, so that they stay what they are
    vectors = cut(rows.select("vec_id", "label", "embedding").distinct().withColumn("node", F.monotonically_increasing_id()))
    valid = cut(_valid(vectors).withColumns({"h1": F.xxhash64("vec"), "h2": F.xxhash64(F.lit(1), "vec")}))
    key = ["label", "dim", "h1", "h2"]
    points = cut(valid.groupBy(*key).agg(F.count(F.lit(1)).alias("times"), F.first("vec").alias("vec")).withColumn("cls", F.monotonically_increasing_id()))
    counts, edges = near_links(points, cosine, block)
    counts = counts.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(edges).withColumnRenamed("id", "cls")
    known = points.select(*key, "cls", "times").join(counts, "cls", "left").join(roots, "cls", "left")
    known = known.select(*key, (F.coalesce("links", F.lit(0).cast("long")) + F.col("times") - 1).alias("n_links"), F.coalesce("root", "cls").alias("root"))
    nodes = valid.select("node", *key).join(known, key).select("node", "n_links", "root")
    out = cut(vectors.select("vec_id", "node").join(nodes, "node", "left"))
    least = out.where("root is not null").groupBy("root").agg(F.min("vec_id").alias("least"))
    component = F.when(F.col("root").isNull(), F.col("vec_id")).otherwise(F.col("least"))
    out = out.join(least, "root", "left").select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


#: The same by plain SQL: every pair of a label, then the least vec_id that links reach.
ORACLE = f"""
WITH RECURSIVE v AS (SELECT row_number() OVER () AS node, * FROM (SELECT DISTINCT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)),
g AS (SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
l AS (SELECT a.node AS a, b.node AS b FROM g a JOIN g b ON a.label = b.label AND len(a.e) = len(b.e) AND a.node <> b.node
      WHERE list_dot_product(a.e, b.e) >= {COSINE} * sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))),
r AS (SELECT node AS a, node AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT r.a AS node, min(v.vec_id) AS component_id FROM r JOIN v ON v.node = r.b GROUP BY r.a),
n AS (SELECT a AS node, count(*) AS n_links FROM l GROUP BY a)
SELECT v.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, c.component_id, v.vec_id IS NOT DISTINCT FROM c.component_id AS kept
FROM v JOIN c USING (node) LEFT JOIN n USING (node)
"""
