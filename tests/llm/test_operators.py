import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fluxsieve.llm import audio, covertree, lines, mixing, pieces, pii, quality, secrets, sharding, shingles
from fluxsieve.llm.components import components
from fluxsieve.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, same

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, root string, word string"
WORDS = [f"w{i}" for i in range(400)]


def docs(spark, rows):
    """Rows of (doc_id, text, source), with columns whose names clash with those the operators use."""
    return spark.createDataFrame([(i, t, "en", s, 0, "x", "y", "z") for i, t, s in rows], DOCS)


def odd(spark):
    """Nulls, empty, blank and very long texts, repeated rows, equal texts, a shared id."""
    long_ = " ".join(WORDS * 40)
    return docs(spark, [
        (1, "one two three four five six", "a"), (1, "one two three four five six", "a"), (2, "one two three four five six", "b"), (3, None, None), (4, "", "a"), (5, "   \n\t ", None),
        (6, long_, "a"), (7, long_ + " end", "a"), (None, "no id at all, just words here", "b"), (8, "ünï cödé ▁ \U0001f600 text", "c"), (2, "another text with the id two", "b"),
    ])


def empty(spark):
    return docs(spark, []).limit(0)


# sharding


def test_shards(spark):
    rows = [(i, " ".join(WORDS[: 1 + i * 7 % 60]), "a") for i in range(600)] + [(1000 + i, "the same text for a third of all rows", "b") for i in range(300)]
    got = sharding.shard(docs(spark, rows), 10).toPandas()
    assert len(got) == 900
    by = got.groupby("shard").agg(size=("size", "sum"), n=("slot", "size"), top=("slot", "max"), kinds=("slot", "nunique"))
    assert len(by) == 10 and (by.top + 1 == by.n).all() and (by.kinds == by.n).all()
    assert by["size"].max() - by["size"].min() < 0.03 * by["size"].mean()
    assert by.n.max() - by.n.min() <= 6
    assert set(got.text_crc32) == {zlib.crc32(t.encode()) for _, t, _ in rows}


def test_shards_keep_groups_whole(spark):
    """At either level, and at any size of the table; only a group that no shard can hold is cut."""
    r = np.random.default_rng(6)
    texts = [" ".join(r.choice(WORDS, int(r.integers(1, 60)))) for _ in range(500)]
    rows = [(i, texts[i // 4], "a") for i in range(2000)] + [(5000 + i, "a third of all rows", "b") for i in range(1000)]
    for large in (sharding.LARGE, 300):
        got = sharding.shard(docs(spark, rows), 10, large=large).toPandas()
        kinds = got.groupby("group").shard.nunique()
        assert len(got) == 3000 and (kinds > 1).sum() == 1 and kinds.max() == 10
        by = got.groupby("shard").agg(size=("size", "sum"), tokens=("tokens", "sum"), n=("slot", "size"))
        assert ((by.max() - by.min()) / by.mean()).max() < 0.05


def test_packing_against_brute_force():
    """Each item goes where the dot product with what is left is highest; ties to the first shard."""
    r = np.random.default_rng(8)
    items = np.round(r.random((40, 3)), 1) / 20
    left = [[0.25] * 3 for _ in range(4)]
    want = [0] * 40
    for i in sorted(range(40), key=lambda i: (-items[i].sum(), i)):
        want[i] = max(range(4), key=lambda b: (round(sum(x * y for x, y in zip(items[i], left[b])), 12), -b))
        left[want[i]] = [x - y for x, y in zip(left[want[i]], items[i])]
    residual = np.full((4, 3), 0.25)
    got = sharding.pack(items, residual)
    assert np.allclose(residual, left) and got.tolist() == want
    before = (residual**2).sum()
    to = sharding.repair(items, got, residual)
    assert (residual**2).sum() <= before and np.allclose(residual, 0.25 - np.stack([items[to == b].sum(axis=0) for b in range(4)]))


def test_shards_of_odd_rows(spark):
    got = sharding.shard(odd(spark), 4).toPandas()
    assert len(got) == 11 and got["size"].min() == 16
    assert sharding.shard(empty(spark), 4).count() == 0


# quality


def test_quality_on_labels(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    fitted = quality.fit(d)
    got = quality.score(d, fitted).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    assert (got.keep == (got.quality == 1)).mean() > 0.97
    assert got[got.quality == 1].keep.mean() > 0.98
    assert all(0.5 < a <= 1 for a in fitted[0].accuracy().values())
    assert quality.keep_good(d).columns == d.columns


def test_expectation_maximisation_finds_accuracies():
    r = np.random.default_rng(3)
    truth = r.random(20000) < 0.7
    acc = np.linspace(0.65, 0.95, len(quality.LABELLERS))
    code = np.zeros(20000, int)
    for a in acc:
        vote = np.where(r.random(20000) < a, truth, ~truth).astype(int)
        code = code * 3 + np.where(r.random(20000) < 0.3, quality.ABSTAIN, vote)
    model = quality.expectation_maximisation(dict(collections.Counter(code.tolist())))
    assert abs(model.good - 0.7) < 0.03
    assert np.abs(np.array(list(model.accuracy().values())) - acc).max() < 0.04


def test_quality_scores_votes_that_fitting_did_not_meet(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    fitted = quality.fit(docs(spark, [(1, "It is a plain text with words, and it ends.", "a"), (2, "| | | x |", "a")]))
    got = quality.score(d, fitted)
    assert got.where("posterior between 0 and 1").count() == d.count()


def test_posteriors_against_bayes():
    model = quality.expectation_maximisation({0: 5, 1093: 20, 2186: 7, 40: 3})
    for code in (0, 1, 40, 1093, 2186):
        good, bad = model.good, 1 - model.good
        for j in range(len(quality.LABELLERS)):
            x = code // 3 ** (len(quality.LABELLERS) - 1 - j) % 3
            if x != quality.ABSTAIN:
                good, bad = good * model.rates[j, quality.GOOD, x], bad * model.rates[j, quality.BAD, x]
        assert model.posterior([code])[0] == pytest.approx(good / (good + bad), abs=1e-6)


def test_quality_of_odd_rows(spark):
    got = quality.score(odd(spark), quality.fit(odd(spark))).toPandas()
    assert len(got) == 11 and (got.score[got.doc_id.isin([3, 4, 5])] == 0).all()
    assert quality.fit(empty(spark)) is None and quality.keep_good(empty(spark)).count() == 0


def weighed(w, texts):
    """Whether each text has moved the weight of every feature it has."""
    return [(w[quality.features(*quality.look(t))[0]] != 0).all() for t in texts]


def test_quality_learns_from_all_documents(spark):
    """Whatever their number, order and partitions; the weights are where the loss of all of them is flat."""
    texts = [f"only{i} is a word of this text, and of no other one." if i % 3 else f"ONLY{i} | | | $$$ ### | | |" for i in range(5000)]
    d = docs(spark, [(i, t, "a") for i, t in enumerate(texts)])
    model, w = quality.fit(d)
    assert all(weighed(w, texts))
    slope = quality.DECAY * w
    for t in texts:
        at, val = quality.features(*(x := quality.look(t)))
        e = 1 / (1 + math.exp(-float(val @ w[at]) - w[-1])) - model.posterior([quality.votes(x[2])])[0]
        slope[at] += e * val / len(texts)
        slope[-1] += e / len(texts)
    assert np.linalg.norm(slope) < 1.01 * quality.FLAT
    assert (quality.fit(d.repartition(7, "text"))[1] == w).all()


def test_quality_in_one_look(spark, sf):
    for d in (spark.read.parquet(f"{sf}/documents.parquet"), odd(spark), empty(spark)):
        want = quality.score(d, quality.fit(d)).collect()
        assert collections.Counter(quality.judge(d).collect()) == collections.Counter(want)


def test_training_finds_the_least():
    a = np.array([1.0, 0.3, 0.05, 0.01])
    w = quality.train(lambda w: (float(a @ (w - 3) ** 2) / 2, a * (w - 3)), 4)
    assert np.linalg.norm(a * (w - 3)) <= quality.FLAT and np.abs(w - 3).max() < 0.02


def test_pipeline_trains_its_classifier_on_all_documents(spark, monkeypatch):
    import corpus_pipeline as cp

    fit, fitted = quality.fit, []
    monkeypatch.setattr(quality, "fit", lambda docs: fitted.append(fit(docs)) or fitted[0])
    texts = [f"word{i} stands in one text, as all of these do." for i in range(4500)]
    cp.keep_good(spark, docs(spark, [(i, t, "a") for i, t in enumerate(texts)]), "").count()
    assert all(weighed(fitted[0][1], texts))


# cover trees


def brute_links(rows, cosine):
    ids, n = [r[0] for r in rows], len(rows)
    ok = [l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v) for _, l, v in rows]
    links, parent = collections.Counter(), {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i + 1, n):
            if ok[i] and ok[j] and rows[i][1] == rows[j][1] and len(rows[i][2]) == len(rows[j][2]):
                a, b = (np.array(rows[k][2], float) for k in (i, j))
                if a @ b / math.sqrt((a @ a) * (b @ b)) >= cosine:
                    links[ids[i]] += 1
                    links[ids[j]] += 1
                    a, b = root(ids[i]), root(ids[j])
                    parent[max(a, b)] = min(a, b)
    return {i: (links[i], root(i)) for i in ids}


@pytest.mark.parametrize("block", [7, 1024])
def test_cover_trees_against_brute_force(spark, block):
    r = np.random.default_rng(block)
    centres = r.standard_normal((9, 8))
    rows = []
    for i in range(160):
        v = (centres[i % 9] + 0.25 * r.standard_normal(8)).astype(np.float32).tolist()
        rows.append((i, int(i % 2), v))
    rows += [(200 + i, 0, rows[4][2]) for i in range(40)]
    rows += [(300, None, [1.0] * 8), (301, 0, None), (302, 0, [0.0] * 8), (303, 0, [float("nan")] + [1.0] * 7), (304, 0, [None] + [1.0] * 7), (305, 0, [1.0, 2.0]), (306, 0, [1.0, 2.0]), (307, 1, [])]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>")
    got = {x.vec_id: (x.n_links, x.component_id) for x in covertree.near_duplicates(df, 0.93, block).collect()}
    assert got == brute_links(rows, 0.93)


def test_cover_trees_of_repeated_rows_and_null_ids(spark):
    a, b, c = [1.0, 0.0, 0.1], [1.0, 0.01, 0.1], [0.0, 1.0, 0.0]
    rows = [(5, 1, a, 0), (5, 1, a, 0), (6, 1, b, 0), (None, 1, a, 0), (7, 1, c, 0), (7, 2, a, 0), (None, 3, c, 0), (None, 3, c, 0), (8, None, a, 0), (9, 2, a, 0)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>, cls int").selectExpr("*", "1 as node", "2 as root", "3 as times")
    got = sorted((tuple(r) for r in covertree.near_duplicates(df).collect()), key=str)
    want = [(5, 2, 5, True), (6, 2, 5, False), (None, 2, 5, False), (7, 0, 7, True), (7, 1, 7, True), (9, 1, 7, False), (None, 0, None, True), (8, 0, 8, True)]
    assert got == sorted(want, key=str)


def test_cover_tree_blocks_are_pruned(spark):
    """One label of 1600 clustered vectors in blocks of 25: few block pairs are tried, and no link is lost."""
    r = np.random.default_rng(12)
    centres = covertree.units(r.standard_normal((40, 16)))
    rows = [(i, 0, (centres[i % 40] + 0.02 * r.standard_normal(16)).tolist()) for i in range(1600)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    points = covertree._valid(df.withColumn("node", F.col("vec_id"))).selectExpr("node as cls", "1L as times", "label", "dim", "vec", "xxhash64(vec) as h1", "0L as h2")
    trees = covertree.make_trees(points, 25)
    n = trees.count()
    assert n >= 40 and covertree.block_pairs(trees, 0.93).count() < 0.1 * n * n
    assert {x.vec_id: (x.n_links, x.component_id) for x in covertree.near_duplicates(df, 0.93, 25).collect()} == brute_links(rows, 0.93)


def test_cover_trees_of_no_rows(spark):
    assert covertree.near_duplicates(spark.createDataFrame([], "vec_id long, label int, embedding array<float>")).count() == 0


def test_tree_levels():
    x = covertree.units(np.random.default_rng(1).standard_normal((300, 5)))
    t = covertree.Tree(x)
    assert sorted(t.points.tolist()) == list(range(300))
    for i in range(len(t.start)):
        members = t.points[t.start[i] : t.end[i]]
        d = np.sqrt(np.maximum(0, 2 - 2 * x[members] @ x[t.centre[i]]))
        assert t.centre[i] in members and d.max() <= t.radius[i] + 1e-7
        kids = t.children(i)
        if len(kids):
            assert t.centre[i] in t.centre[kids] and t.start[kids[0]] == t.start[i] and t.end[kids[-1]] == t.end[i]


def test_components(spark):
    r = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in r.integers(0, 200, (150, 2))] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, None)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if b is not None and a != b:
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
    got = {x.id: x.root for x in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: root(x) for x in list(parent)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# mixing


def test_apportionment_against_highest_quotients(spark):
    targets = {"a": 1000.0, "b": 333.0, "c": 77.0, "d": 0.0, None: 512.0}
    df = spark.createDataFrame(list(targets.items()), "source string, target double")
    got = collections.defaultdict(int)
    for shards in (1, 3):
        quotas = mixing.block_quotas(df, 16, shards).collect()
        total = collections.Counter()
        for q in quotas:
            total[q.source] += q.quota
            assert q.quota >= 0
        seats = math.floor(sum(targets.values()) / 16 + 0.5)
        quotients = sorted(((t / (2 * k - 1), s) for s, t in targets.items() if t for k in range(1, 200)), key=lambda x: (-x[0], x[1] is None, x[1] or ""))
        want = collections.Counter(s for _, s in quotients[:seats])
        assert {k: v for k, v in total.items() if v} == dict(want)
        got[shards] = total
    assert got[1] == got[3]


def test_mix(spark):
    rows = [(i, " ".join(WORDS[: 1 + i * 13 % 90]), "abc"[i % 3] if i % 7 else None) for i in range(400)] + [(5000 + i, "some words here", "a") for i in range(200)]
    d = docs(spark, rows)
    got = mixing.mix(d).toPandas()
    assert got.taken.sum() == pytest.approx(1.5 * got["size"].sum(), rel=0.01)
    assert (got.taken <= 2 * got["size"]).all()
    by = got.groupby("source_size").agg(taken=("taken", "sum"), target=("target", "first"))
    assert (by.taken - by.target).abs().max() <= 3 * mixing.BLOCK
    again = mixing.mix(d.repartition(7)).toPandas()
    key = ["doc_id", "size", "taken"]
    assert got[key].sort_values(key).values.tolist() == again[key].sort_values(key).values.tolist()
    out = mixing.mixed(d).toPandas()
    assert list(out.columns) == d.columns
    assert out.text.str.split().str.len().sum() == got.taken.sum()
    assert (out.n_chars == out.text.str.len()).all()


def test_mix_deals_blocks_to_shards(spark):
    d = docs(spark, [(i, " ".join(WORDS[: 1 + i * 13 % 90]), "abc"[i % 3]) for i in range(300)])
    whole, got = mixing.mix(d).toPandas(), mixing.mix(d, shards=4).toPandas()
    assert set(got["shard"].dropna()) == {0, 1, 2, 3}
    one = mixing.block_quotas(mixing.source_targets(mixing.mix(d).join(d.select("doc_id", "source"), "doc_id").select("source", "size")), shards=4).toPandas()
    assert got.groupby("doc_id").taken.sum().to_dict() == whole.groupby("doc_id").taken.sum().to_dict()
    got["source"] = got.doc_id.map(lambda i: "abc"[i % 3])
    by = got.groupby(["source", "shard"]).taken.sum()
    for r in one.itertuples():
        assert abs(by[r.source, r.shard] - r.quota * mixing.BLOCK) <= 2 * mixing.BLOCK
    out = mixing.mixed(d, shards=4).toPandas()
    assert list(out.columns) == [*d.columns, "shard"]
    assert out.text.str.split().str.len().groupby(out["shard"]).sum().to_dict() == got.groupby("shard").taken.sum().to_dict()


def test_mix_of_odd_rows(spark):
    got = mixing.mix(odd(spark)).toPandas()
    assert len(got) == 11 and (got.taken[got["size"] == 0] == 0).all()
    assert mixing.mix(empty(spark)).count() == 0 and mixing.mixed(empty(spark)).count() == 0


# audio


def test_audio(spark):
    got = {r.doc_id: r for r in audio.audio(odd(spark)).collect()}
    for doc_id, text in ((8, "ünï cödé ▁ \U0001f600 text"), (4, ""), (3, None)):
        data = (text or "").encode()
        want = data + bytes(max(64, -(-len(data) // 64) * 64) - len(data))
        r = got[doc_id]
        rate, back = audio.read_wav(bytes(r.media))
        assert (rate, back) == (audio.RATE, want) and r.n_bytes == len(data) and r.payload_bytes == len(want)
        assert r.payload_sha256 == hashlib.sha256(want).hexdigest() and r.tail_crc32 == zlib.crc32(want[-64:]) and r.media_sha256 == hashlib.sha256(r.media).hexdigest()
    import pyarrow as pa

    batch = pa.ipc.open_stream(got[6].tensors).read_all()
    assert batch.schema.field("patch").type.shape == [audio.PATCH, audio.MELS] and batch.num_rows == got[6].n_patches > 1
    assert batch["start_ms"][0].as_py() == 0 and batch["start_ms"][1].as_py() == audio.PATCH * audio.HOP * 1000 * audio.DOWN // (audio.RATE * audio.UP)
    assert audio.audio(empty(spark)).count() == 0
    d = audio.audio(odd(spark), digest=True).toPandas()
    assert d[d.doc_id == 1].feature.nunique() == 1 and len(d) == 11


def test_resampling_keeps_a_low_tone():
    t = np.arange(4000) / audio.RATE
    y = audio.resample(np.sin(2 * np.pi * 500 * t))
    want = np.sin(2 * np.pi * 500 * np.arange(len(y)) * audio.DOWN / (audio.RATE * audio.UP))
    assert len(y) == 4000 * audio.UP // audio.DOWN
    best = max(np.corrcoef(y[50:-50], np.roll(want, s)[50:-50])[0, 1] for s in range(-3, 4))
    assert best > 0.97
    up = audio._phases(3, 2, 16)
    assert len(audio.resample(np.ones(100), 3, 2, up)) == 150


def test_resampling_against_plain_sums():
    """Each output is the filter's branch times the inputs around it, in one piece or in blocks."""
    x = np.random.default_rng(1).integers(0, 256, 3001).astype(np.uint8)
    f = (x.astype(float) - 128) / 128
    y = audio.resample(f)
    h = audio._phases(audio.UP, audio.DOWN, audio.TAPS)
    for m in (0, 1, 2, 3, 4, 777, len(y) - 1):
        at = m * audio.DOWN // audio.UP - audio.TAPS // 2
        assert y[m] == pytest.approx(sum(h[m * audio.DOWN % audio.UP, k] * f[at + k] for k in range(audio.TAPS) if 0 <= at + k < len(f)), abs=1e-12)
    assert np.allclose(y[100:200], audio.resampled(f, 100, 200), atol=1e-12)


def test_blocks_of_a_long_sound_against_one_piece(monkeypatch):
    data = bytes(np.random.default_rng(2).integers(0, 256, 64 * 4000).astype(np.uint8))
    x = (np.frombuffer(data, np.uint8).astype(float) - 128) / 128
    y = np.concatenate([audio.resample(x), np.zeros(audio.FRAME)])
    mel, energy = audio.log_mel(data)
    assert len(mel) > 2 * audio.BLOCK
    for i in (0, 1, audio.BLOCK - 1, audio.BLOCK, 2 * audio.BLOCK + 5, len(mel) - 1):
        part = y[i * audio.HOP : i * audio.HOP + audio.FRAME]
        power = np.abs(np.fft.rfft(part * audio._WINDOW, audio.NFFT)) ** 2
        assert np.abs(np.log(power @ audio._MEL + 1e-6) * audio.STEP - mel[i]).max() <= 0.5 + 1e-9 and energy[i] == pytest.approx(np.log((part**2).mean() + 1e-6), abs=1 / 128 + 1e-9)
    one = audio.analyse(data.decode("latin-1"))
    values, spans = audio.from_ipc(one["tensors"])
    assert values.shape == (one["n_patches"], audio.PATCH, audio.MELS) and spans.shape == (len(values), 2) and (spans[1:, 0] <= spans[:-1, 1]).all()


def test_segments():
    e = np.array([0, 0, 5, 9, 5, 0, 0, 3.0, 3.0, 0, 0, 9, 9])
    assert audio.segments(e).tolist() == [[2, 5], [11, 13]]
    assert audio.segments(np.zeros(4)).tolist() == [[0, 4]]


# pieces


@pytest.fixture(scope="module")
def model():
    return pieces.model_of(pieces.model_path(), 1.5)


def test_samples_follow_the_lattice(model):
    text, n = "the thin", 4000
    cut = pieces._UNITS.findall(" " + text)
    p = {a + b: x * y for a, x in zip(*pieces._ranked(model, cut[0])) for b, y in zip(*pieces._ranked(model, cut[1]))}
    assert sum(p.values()) == pytest.approx(1)
    first, pairs, horvitz = collections.Counter(), collections.Counter(), collections.Counter()
    for a in range(0, n, 500):
        for x in pieces.top_k(model, [text] * 500, 3, [pieces.generator(1, i, text) for i in range(a, a + 500)]):
            keys = [tuple(pieces.ids_of(model, x.t, s).tolist()) for s in x.out]
            assert len(set(keys)) == 3 and sorted((s.value for s in x.out), reverse=True) == [s.value for s in x.out]
            first[keys[0]] += 1
            pairs[keys[0], keys[1]] += 1
            for k, s in zip(keys, x.out):
                assert float(s.log_p.sum()) == pytest.approx(math.log(p[k]))
                horvitz[k] += p[k] / -math.expm1(-math.exp(math.log(p[k]) - x.left))
    for k, c in first.most_common(3):
        assert c / n == pytest.approx(p[k], abs=4 * math.sqrt(p[k] / n))
        assert horvitz[k] / n == pytest.approx(p[k], rel=0.1)
    for (a, b), c in pairs.most_common(3):
        assert c / n == pytest.approx(p[a] * p[b] / (1 - p[a]), abs=0.03)


def test_lattices_against_single_edges(model):
    units = [" thinking", "the", " a", "zzzzqq", " Überschu"]
    lat = pieces.Lattices(model, units)
    ids, count, weight = lat.walk(np.arange(len(units)))
    for i, u in enumerate(units):
        segs, p = pieces._ranked(model, u)
        assert weight[i] / lat.total[lat.size[i], i] == pytest.approx(p[0])
        assert tuple(ids[i][: count[i]][::-1].tolist()) in [s for s, x in zip(segs, p) if x == pytest.approx(p[0])]


def whole_lattice(model, text):
    """The log sum of the weights of all segmentations, over the whole text without units."""
    ends = model.edges(" " + text)
    total = [0.0] + [-math.inf] * (len(ends) - 1)
    for j in range(1, len(ends)):
        total[j] = float(np.logaddexp.reduce([total[a] + math.log(w) for a, _, w in ends[j] if j - a <= 16]))
    return total[-1]


def test_units_that_are_new_are_found_with_the_cuts(model):
    model.units.reset()
    texts = ["plain words here", "odd \u4e2d\u6587 " + "abcxyz" * 9, "", "plain words again\n\n end"]
    found, new = model.cut(texts)
    assert ["".join(x) for x in found] == [" " + t for t in texts] and new == set().union(*found)
    model.units.learn(new)
    assert set(model.units) == new
    found, new = model.cut([*texts, "one more"])
    assert set().union(*found).difference(model.units) == new.difference(model.units) and len(new) < len(set().union(*found))


def test_units_against_the_whole_lattice(model):
    texts = ["more information on a particular experience", "a  run    of spaces                   and misinformation\n\n  x", "administration|transformation=====================x", "z" * 40 + "\u2581 \u0bf5 \U0001f600ab", "internationalization of representatives", "ab" * 400]
    byte, weight = set(model.byte_ids), dict(model.pieces.values())
    longest = 0
    for t in texts:
        whole = whole_lattice(model, t)
        for x in pieces.top_k(model, [t] * 40, 4, [pieces.generator(3, i, t) for i in range(10)]):
            assert len({tuple(pieces.ids_of(model, x.t, s).tolist()) for s in x.out}) == 4
            for s in x.out:
                ids = pieces.ids_of(model, x.t, s)
                log_w = sum(math.log(model.byte_weight if i in byte else weight[i]) for i in ids.tolist())
                assert model.decode(ids) == t
                assert float(s.log_p.sum()) == pytest.approx(log_w - whole, rel=1e-7, abs=1e-7)
                longest = max(longest, int(model.chars[ids][~np.isin(ids, model.byte_ids)].max()))
    assert longest > 10


def test_samples_of_a_long_word_follow_the_lattice(model):
    text, n = "information", 3000
    every, p = pieces._ranked(model, " " + text)
    first, second = collections.Counter(), collections.Counter()
    for x in pieces.top_k(model, [text] * n, 3, [pieces.generator(7, i, text) for i in range(n)]):
        keys = [tuple(pieces.ids_of(model, x.t, s).tolist()) for s in x.out]
        assert len(set(keys)) == 3
        first[keys[0]] += 1
        second[keys[1]] += 1
    assert len(every[0]) == 1
    want = {k: q * sum(o / (1 - o) for i, o in zip(every, p) if i != k) for k, q in zip(every[:3], p)}
    for k, q in zip(every[:3], p):
        assert first[k] / n == pytest.approx(q, abs=4 * math.sqrt(q / n))
        assert second[k] / n == pytest.approx(want[k], abs=0.04)


def test_pieces_of_odd_rows(spark):
    d = odd(spark)
    got = pieces.encode(d, 3, alpha=1.0).toPandas()
    assert got.round_trip.all()
    per = got.groupby("doc_id", dropna=False)["rank"].agg(["max", "size"])
    assert per.loc[4, "max"] == 1 and got[got.doc_id == 4].inclusion.tolist() == [1.0] and per.loc[1, "max"] == 3
    assert got[got.doc_id == 1].groupby("rank").ids_crc32.nunique().eq(1).all()
    assert got[got.doc_id == 8].ids.map(bytes).nunique() == 3
    text = {(r.doc_id, r["rank"]): r.text for r in pieces.decode(pieces.encode(d, 2)).collect()}
    assert text[8, 1] == "ünï cödé ▁ \U0001f600 text" and text[3, 1] == ""
    assert pieces.encode(empty(spark)).count() == 0
    again = pieces.encode(d.repartition(5), 3, alpha=1.0).toPandas()
    key = ["doc_id", "rank", "ids_crc32"]
    assert sorted(map(str, got[key].values.tolist())) == sorted(map(str, again[key].values.tolist()))


# personal data

_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")


def plain_base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end(), "email") for m in _EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end(), "card") for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m[0])) <= 19 and pii.luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return [(a, b, k) for a, _, b, k in sorted(out)]


def test_base_spans_against_plain_patterns(spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    texts += ["a@b.c@d.e", "@x.y", "a..b@c-d.e.f@g.h+i@j.k", "1.2.3.4.5 999.1.1.1 +1 (269) 555-3296 4524132264652876", "é@b.c x@y", "4111 1111 1111 1111-4111111111111111", "+12345678 +123456789", "a@b.c.d@e.f"]
    for t in texts:
        assert pii.base_spans(t) == plain_base(t)


def test_field_on_held_out_lines():
    w = pii.weights()
    hit = made = true = 0
    for text, want in pii.generated(300, 991):
        got = {(a, b) for a, b, _ in pii.spans(text, w)[1]}
        hit += len(got & {(a, b) for a, b, _ in want})
        made += len(got)
        true += len(want)
    assert hit / made > 0.93 and hit / true > 0.95


def test_field_finds_what_rules_merge(spark):
    w = pii.weights()
    base, every = pii.spans("call +1 (269) 555-3296 4524132264652876 or joe at mail dot example dot com", w)
    assert base == [] and every == [(5, 22, "phone"), (23, 39, "card"), (43, 74, "email_words")]
    assert pii.spans("on 2024-10-11 at 3.4.5, meet at noon dot", w)[1] == []
    assert pii.redact("x a@b.cc y") == "x [EMAIL] y" and pii.redact(None) is None
    got = pii.find(odd(spark)).toPandas()
    assert len(got) == 11 and (got.spans == "").all() and got.base_sha256.eq(hashlib.sha256(b"").hexdigest()).all()
    assert pii.find(empty(spark)).count() == 0


def test_field_decides_on_addresses_in_words():
    w = pii.weights()
    for t in ["jane at example.com", "jane AT example DOT com", "jane (AT) example (DOT) com", "jane [at] example [dot] org", "jane.doe @ example.com", "jane@example dot com"]:
        assert pii.spans(f"note: {t} today", w)[1] == [(6, 6 + len(t), "email_words")], t
    for t in ["They look at anecdotes. Then they go.", "We met at noon. Dotted lines follow.", "It is sold at shops. Ask there", "they look at example.com for it", "at the dot"]:
        assert pii.spans(t, w)[1] == [] and pii.redact(t) == t, t
    assert pii.redact("mail x@y.org or joe at example dot com. Thanks") == "mail [EMAIL] or [EMAIL_WORDS]. Thanks"


def test_field_against_all_segmentations():
    w, several = pii.weights(), 0
    for text in ["555-123-4567", "1 (269) 5", "12-34 5678901", "123-45-6789 1", "joe at b.com", "(555) 123-4567"]:
        for window in pii._windows(text, []):
            def every(i):
                if i == len(window):
                    yield 0.0, []
                    return
                for j, kind, features in window.segments(i):
                    for s, rest in every(j):
                        yield s + sum(w.get(f, 0.0) for f in features), ([(window.bounds[i], window.bounds[j], kind)] if kind else []) + rest
            made = list(every(0))
            top = max(s for s, _ in made)
            assert any(s == pytest.approx(top) and found == window.best(w) for s, found in made)
            several += len(made) > 1
    assert several >= 4


def test_long_runs_take_time_in_proportion():
    """Letters, numbers, signs and words around "at": ten times as long takes about ten times as long."""
    import time

    w = pii.weights()
    for unit in ("x", "dot ", "1 2 3 ", "a@", "j at b.c ", "1.1.1.1 ", "+1 555 555 5555 ", "a at "):
        took = []
        for n in (4_000, 40_000):
            began = time.process_time()
            pii.spans("dot " + unit * (n // len(unit)), w)
            took.append(time.process_time() - began)
        assert took[1] < 30 * took[0] + 0.5, unit
    began = time.process_time()
    pii.spans("dot " + "x" * 100_000, w)
    assert time.process_time() - began < 1


def test_field_finds_personal_data_in_documents(spark, sf):
    """Of the documents with data in the forms that people write them in, by plain patterns that the field doesn't use."""
    forms = [_EMAIL, re.compile(r"\b\d{3}-\d{2}-\d{4}\b"), re.compile(r"\+1 \(\d{3}\) \d{3}-\d{4}"), re.compile(r"(?<!\d)(?:\d{4}[ -]){3}\d{4}(?!\d)"), re.compile(r"\b(?:\d{1,3}\.){3}\d{1,3}\b")]
    texts = [r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    with_data = [t for t in texts if any(f.search(t) for f in forms)]
    assert with_data and sum(bool(pii.spans(t, pii.weights())[1]) for t in with_data) >= 0.9 * len(with_data)


# secrets


def test_secrets(spark):
    text = "A: token='abcdef1' x secret=token: abcdefg\nAKIA" + "A1" * 8 + " é " + "0123456789abcdef" * 2 + " password=abc PASSWD : abcdef"
    d = docs(spark, [(1, text, "a"), (2, text, "b"), (3, None, "a"), (4, "nothing", "a"), (1, text, "a"), (None, "api_key=zzzzzz", "a")])
    ledger = secrets.scan_versions(d)
    assert ledger.count() == 4
    got = secrets.digest(secrets.findings(d, ledger)).toPandas()
    assert len(got) == 6 and got.spans.nunique() == 3
    one = got[got.doc_id == 2].iloc[0]
    want = [("assign", m.start(), m.end()) for m in re.finditer(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[1]) >= 6]
    want += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20] + [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    want.sort(key=lambda x: (x[1], secrets.BASE.index(x[0])))
    assert one.spans == ",".join(f"{k}:{a}:{b}" for k, a, b in want) and (one.n_assign, one.n_access, one.n_hex) == (2, 1, 1)
    assert one.base_sha256 == hashlib.sha256(one.spans.encode()).hexdigest()
    more = docs(spark, [(1, text, "a"), (9, "token = newsecret", "a")])
    new = secrets.scan_versions(more, ledger)
    assert new.count() == 1 and secrets.scan_versions(more, ledger, version=2).count() == 2
    assert secrets.findings(more, ledger.unionByName(new)).where(F.size("found") > 0).count() == 2
    assert secrets.scan_versions(empty(spark)).count() == 0
    assert secrets.digest(secrets.findings(odd(spark), secrets.scan_versions(odd(spark)))).count() == 11


# lines


def brute_lines(rows):
    """rows of (doc_id, text): the (row number, line number) that go."""
    all_ = [((math.inf if i is None else i, k), r, frozenset(x for x in re.split(r"[\x20\x09-\x0D]+", line.strip(" \t\x0b\f\r")) if x)) for r, (i, t) in enumerate(rows) if t is not None for k, line in enumerate(t.split("\n"))]
    all_ = [x for x in all_ if x[2]]
    return {(x[1], x[0][1]) for x in all_ for y in all_ if y[0] < x[0] and 4 * len(x[2]) <= 5 * len(y[2]) and 4 * len(y[2]) <= 5 * len(x[2]) and 5 * len(x[2] & y[2]) >= 4 * len(x[2] | y[2])}


def test_lines_against_brute_force(spark):
    r = np.random.default_rng(2)
    rows = []
    for i in range(60):
        ls = []
        for _ in range(int(r.integers(1, 6))):
            k = int(r.integers(0, 12))
            ws = WORDS[k * 20 : k * 20 + int(r.integers(3, 21))]
            if r.random() < 0.5:
                ws = [*ws[:-1], f"x{int(r.integers(0, 50))}"]
            ls.append(" " * int(r.integers(0, 2)) + " ".join(r.permutation(ws)))
        rows.append((i, "\n".join(ls)))
    rows += [(100 + i, "one very common line of eight words here") for i in range(40)] + [(None, rows[0][1]), (200, None), (201, ""), (202, "\n\n"), (7, rows[3][1])]
    d = docs(spark, [(i, t, "a") for i, t in rows])
    gone = brute_lines(rows)
    got = lines.dedup(d).toPandas()
    assert list(got.columns) == [*d.columns, "n_removed"]
    want = collections.Counter()
    for n, (i, t) in enumerate(rows):
        want[i, None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (n, k) not in gone)] += 1
    have = collections.Counter((None if np.isnan(i) else int(i), t if isinstance(t, str) else None) for i, t in zip(got.doc_id.astype(float), got.text))
    assert have == want


def test_pipeline_drops_short_lines(spark):
    import corpus_pipeline as cp

    texts = ["All rights reserved.\n\none", " reserved. rights All\n\n \nb c d e", "buy now buy now buy now\nb c d e f", "buy now buy now\n\nTwo", None, ""]
    got = cp.dedup_lines(spark, docs(spark, [(i, t, "a") for i, t in enumerate(texts)]), "").select("doc_id", "text").collect()
    assert sorted(map(tuple, got)) == [(0, texts[0]), (1, "\n \nb c d e"), (2, "buy now buy now buy now"), (3, "\nTwo"), (4, None), (5, "")]


def test_lines_of_rows_that_share_an_id_or_have_none(spark):
    common = "a common line of seven words here"
    shared = [*WORDS[:12], "only", "here"]
    texts = [
        (1, common), (1, "this unique line stays under its id"), (None, common + "\nfirst of the lines without any id"), (None, "second of lines that have no id\n" + common),
        (None, "third one\n" + " ".join(shared)), (None, "fourth one\n\n" + " ".join(shared[:-1])), (None, "fifth one\n" + " ".join(WORDS[50:60])), (7, "eins zwei drei vier fünf sechs"), (7, "one\n" + common),
    ]
    got = lines.dedup(docs(spark, [(i, t, "a") for i, t in texts])).select("doc_id", "text", "n_removed").collect()
    want = [
        (1, common, 0), (1, "this unique line stays under its id", 0), (None, "first of the lines without any id", 1), (None, "second of lines that have no id", 1),
        (None, "third one\n" + " ".join(shared), 0), (None, "fourth one\n", 1), (None, "fifth one\n" + " ".join(WORDS[50:60]), 0), (7, "eins zwei drei vier fünf sechs", 0), (7, "one", 1),
    ]
    assert collections.Counter(map(tuple, got)) == collections.Counter(want)


def test_near_copies_of_lines_in_large_groups(spark):
    """Groups whose originals come anywhere, with edits at random places: pairs thinned by the earliest relatives lose nothing."""
    r = np.random.default_rng(4)
    rows = []
    for i in range(400):
        ws = [f"g{i % 3}.{j}" for j in range(40)]
        for _ in range(int(r.integers(0, 8))):
            ws[int(r.integers(0, 40))] = f"e{int(r.integers(0, 400))}"
        rows.append((i, " ".join(ws[: int(r.integers(33, 41))])))
    got = lines.dedup(docs(spark, [(i, t, "a") for i, t in rows])).where("n_removed > 0").select("doc_id").collect()
    assert {x.doc_id for x in got} == {rows[k][0] for k, _ in brute_lines(rows)}


def test_near_copies_of_lines_that_differ_at_an_end(spark):
    """A copy without the word of least or of largest hash is thinned like any other; words are hashed once a line."""
    ws = [f"w{i}" for i in range(40)]
    by_hash = [r.w for r in spark.createDataFrame([(w,) for w in ws], "w string").selectExpr("w", "xxhash64(w) h").orderBy("h").collect()]
    texts = [ws, [w for w in ws if w != by_hash[0]], [w for w in ws if w != by_hash[-1]], by_hash[1:-1], by_hash[2:-2]]
    d = docs(spark, [(i, " ".join(t), "a") for i, t in enumerate(texts)])
    sets = lines.sets(d, lines.rarity(d), 4, 5, 1)
    assert sets._jdf.queryExecution().executedPlan().toString().count("[\\x20\\x09-\\x0D]+") == 1
    classes = sets.withColumns({"id": "doc_id", "doc": "doc_id"})
    assert {(r.early, r.late) for r in lines._relatives(classes, 4, 5).collect()} >= {(0, 1), (0, 2), (0, 3)}
    assert [r.n_removed for r in lines.dedup(d).orderBy("doc_id").collect()] == [0, 1, 1, 1, 1]


def test_lines_order_words_by_a_sample_and_move_wanted_texts_only(spark):
    """The order of words comes from a sample of bounded size, and a bitmap passes every wanted row and few others."""
    d = spark.range(3 * lines.SAMPLE).selectExpr("id doc_id", "'often' text")
    at = spark.createDataFrame([("often",)], "w string").select(lines._place(F.xxhash64("w"))).first()[0]
    level = spark.range(1).select(lines.rarity(d)[at]).first()[0]
    assert 0 < level <= 2 * math.log2(1.1 * lines.SAMPLE) + 1
    keys = spark.range(1000).select(F.xxhash64("id").alias("key"))
    passed = spark.range(100_000).select("id", lines._marked(keys)(F.xxhash64("id")).alias("p")).where("p").collect()
    assert {r.id for r in passed} >= set(range(1000)) and len(passed) < 1100


def test_lines_order_words_by_the_counts_of_all_documents(spark, monkeypatch):
    """No document is left out of the counts, whatever the size of the table; levels are of counts in SAMPLE documents."""
    monkeypatch.setattr(lines, "SAMPLE", 8)
    texts = [f"often w{i} w{i}\nhalf" if i % 2 else f" often\t w{i}\n\n" for i in range(200)] + [None, ""]
    counts = collections.Counter(w for t in texts for w in (t or "").split())
    at = {r.w: r.p for r in spark.createDataFrame([(w,) for w in counts], "w string").select("w", lines._place(F.xxhash64("w")).alias("p")).collect()}
    want = collections.Counter()
    for w, n in counts.items():
        want[at[w]] += n
    levels = spark.range(1).select(lines.rarity(docs(spark, [(i, t, "a") for i, t in enumerate(texts)])).alias("l")).first().l
    assert {p: x for p, x in enumerate(levels) if x > -128} == {p: math.floor(2 * math.log2(n * 8 / 202)) + 1 for p, n in want.items()}


def test_pipeline_counts_the_words_of_all_documents_for_line_dedup(spark, monkeypatch):
    import corpus_pipeline as cp

    counted, made = [], lines._constant

    def constant(rows, size, value):
        if size == 1 << lines.BUCKETS:
            counted.append(rows.agg(F.sum("value")).first()[0])
        return made(rows, size, value)

    monkeypatch.setattr(lines, "SAMPLE", 8)
    monkeypatch.setattr(lines, "_constant", constant)
    d = docs(spark, [(i, f"one line of {i}\nand another\n", "a") for i in range(200)])
    assert cp.dedup_lines(spark, d, "").count() == 200 and counted == [200 * 6]


def test_lines_rank_a_word_by_one_look_and_one_flip(spark):
    """For each place, rare or not and of any high bits, the flip gives the level of its words and keeps the rest of the hash; a line's words are
    made distinct once, without its empty ones."""
    d = docs(spark, [(0, "often  w0\tw1 w1 ", "a"), (1, "often", "a")])
    levels = lines.rarity(d)
    words = spark.createDataFrame([(w,) for w in ("often", "w0", "w1", "unseen")], "w string").select(F.xxhash64("w").alias("h"))
    words = words.withColumn("flips", lines._flips(spark, levels)).withColumn("levels", levels)
    got = words.select("h", F.get("levels", lines._place(F.col("h"))).alias("level"), lines._ranked(F.col("flips"))(F.col("h")).alias("rank")).collect()
    assert len({r.level for r in got}) == 3
    assert all(r.rank == (r.level << lines.LOW) | (r.h & (1 << lines.LOW) - 1) for r in got)
    sets = lines.sets(d, levels, 4, 5, 1)
    plan = sets._jdf.queryExecution().executedPlan().toString()
    assert plan.count("array_except(") == 1 and "array_remove(" not in plan
    assert sorted(r.n for r in sets.collect()) == [1, 3]


def test_lines_plans_name_the_tables_instead_of_spelling_them_out(spark):
    """The driver keeps plans as text, several times over: a table of 2 ** 18 numbers must not be in them."""
    d = docs(spark, [(i, f"often w{i}", "a") for i in range(20)])
    keys = spark.range(50).select(F.xxhash64("id").alias("key"))
    for frame in (lines.sets(d, lines.rarity(d), 4, 5, 1), keys.where(lines._marked(keys)(F.col("key")))):
        assert frame.count() == (50 if "key" in frame.columns else 20)
        assert len(frame._jdf.queryExecution().toString()) < 50_000


def test_lines_with_ids_of_any_range_and_odd_space(spark):
    """The order is a long or a decimal by the range of ids, null last in both; any space separates words."""
    for ids in ([-5, 3, 2**31 - 8, None], [-(2**63), -1, 2**63 - 2, None], [None, None, None, None]):
        d = docs(spark, [(i, t, "a") for i, t in zip(ids, ["x\n  a  b\tc\r\nuno", "c b a\ny", "\x0b b\x0cc a \nz", " \t\r\n\x0b\nb c a"])])
        rows = [(r.doc_id, r.text) for r in d.collect()]
        gone = brute_lines(rows)
        want = ["\n".join(x for k, x in enumerate(t.split("\n")) if (n, k) not in gone) for n, (_, t) in enumerate(rows)]
        assert collections.Counter(r.text for r in lines.dedup(d).collect()) == collections.Counter(want)


def test_lines_keep_columns_of_any_name(spark):
    d = docs(spark, [(1, "a b c", "s"), (2, "c b a\nnew", "s")]).selectExpr("doc_id", "text", "1 as gone", "2 as of", "3 as of_row", "4 as ls", "5 as `all`", "6 as n_removed")
    got = lines.dedup(d).orderBy("doc_id")
    assert got.columns == d.columns and list(map(tuple, got.collect())) == [(1, "a b c", 1, 2, 3, 4, 5, 0), (2, "new", 1, 2, 3, 4, 5, 1)]


def test_lines_of_a_very_long_text(spark):
    text = "\n".join(f"w{i % 7000} only here x{i % 7000}" for i in range(14000)) + "\n" + " ".join(f"v{i}" for i in range(70000))
    got = lines.dedup(docs(spark, [(1, text, "a"), (2, text, "a")])).orderBy("doc_id").collect()
    assert [x.n_removed for x in got] == [7000, 14001] and got[1].text == "" and got[0].text.count("\n") == 7000


def test_lines_of_odd_rows(spark):
    assert lines.dedup(odd(spark)).count() == 11
    assert lines.dedup(empty(spark)).count() == 0


# n-grams


def brute_groups(rows, k, num, den):
    sets = []
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets.append((i, {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and den * len(x & y) >= num * len(x | y):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    least = {}
    for a, (i, s) in enumerate(sets):
        if i is not None:
            least[root(a)] = min(i, least.get(root(a), i))
    return sorted(((i, len(s), least.get(root(a)) if s else i) for a, (i, s) in enumerate(sets)), key=str)


@pytest.mark.parametrize("k,num", [(4, 85), (5, 80), (2, 60)])
def test_ngrams_against_brute_force(spark, k, num):
    r = np.random.default_rng(k)
    base = [list(r.choice(WORDS, 60)) for _ in range(6)]
    rows = []
    for i in range(150):
        w = list(base[i % 6])
        for _ in range(int(r.integers(0, 5))):
            w[int(r.integers(0, 60))] = f"y{int(r.integers(0, 999))}"
        rows.append((i, " ".join(w[: int(r.integers(50, 61))])))
    rows += [(500 + i, rows[0][1].upper()) for i in range(60)] + [(600, "a b"), (601, "A  b\n"), (602, ""), (603, None), (None, rows[2][1]), (3, "the id three again but other words")]
    got = shingles.join(docs(spark, [(i, t, "a") for i, t in rows]), k, num, 100).collect()
    assert sorted(((x.doc_id, x.n_shingles, x.component_id) for x in got), key=str) == brute_groups(rows, k, num, 100)


def test_texts_go_to_blocks_in_less_room_than_their_ngrams(sf):
    texts = [*pd.read_parquet(f"{sf}/documents.parquet").text.dropna(), "", "\n", "A b\u00fc \U0001f600 c"]
    packed = [shingles.pack(t) for t in texts]
    assert all((shingles.ngrams(shingles.unpack(p), 4) == shingles.ngrams(t, 4)).all() for p, t in zip(packed, texts))
    assert sum(map(len, packed)) * 2 < sum(shingles.ngrams(t, 4).nbytes for t in texts)
    assert "grams" not in shingles._SET.names


def test_masked_product_against_sets():
    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 60, int(r.integers(1, 50))).astype(np.uint64)) for _ in range(60)] + [np.arange(50, dtype=np.uint64)] * 3
    left, right = (r.integers(-1, 63, 900).tolist() for _ in range(2))
    links = shingles.masked_product(sets, left, right, 60, 100)
    true = {(a, b) for a, b in zip(left, right) if a >= 0 <= b and a != b and 100 * len(np.intersect1d(sets[a], sets[b])) >= 60 * len(np.union1d(sets[a], sets[b]))}
    assert all((a, b) in true or (b, a) in true for a, b in links)

    def groups(pairs):
        parent = list(range(63))
        for a, b in pairs:
            x, y = a, b
            while parent[x] != x:
                x = parent[x]
            while parent[y] != y:
                y = parent[y]
            parent[max(x, y)] = min(x, y)
        for i in range(63):
            parent[i] = parent[parent[i]]
        return parent

    assert groups(links) == groups(true) and shingles.masked_product([], [-1], [-1], 1, 2) == []


def test_near_copies_keep_columns_and_wordless_rows(spark):
    rows = [(1, "a b c d e f"), (2, "A b c d e f"), (3, " \n\t "), (3, " \n\t "), (None, None), (None, None), (4, "x y z u v w"), (4, "x y z u v w")]
    d = docs(spark, [(i, t, "a") for i, t in rows]).selectExpr("doc_id", "text", "7 as _id", "8 as _hash", "9 as `of`", "1 as id", "2 as hash", "3 as worded", "4 as `row`")
    got = shingles.keep_one(d)
    assert got.columns == d.columns
    assert sorted((tuple(r)[:4] for r in got.collect()), key=str) == sorted([(1, "a b c d e f", 7, 8), (3, " \n\t ", 7, 8), (3, " \n\t ", 7, 8), (None, None, 7, 8), (None, None, 7, 8), (4, "x y z u v w", 7, 8)], key=str)


def test_one_of_each_group_stays(spark):
    d = odd(spark)
    kept = shingles.keep_one(d)
    assert kept.columns == d.columns
    got = sorted(((r.doc_id, (r.text or "")[:12]) for r in kept.collect()), key=str)
    assert got == sorted([(1, "one two thre"), (2, "another text"), (3, ""), (4, ""), (5, "   \n\t "), (6, "w0 w1 w2 w3 "), (8, "ünï cödé ▁ \U0001f600"), (None, "no id at all")], key=str)
    assert shingles.join(empty(spark)).count() == 0 and shingles.keep_one(empty(spark)).count() == 0


# queries and pipeline


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, sf, name):
    same(QUERIES[name](spark, sf).toPandas(), connect(sf).sql(ORACLES[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_whole_tables(spark, sf, name):
    table = "embeddings" if name.startswith("op3") else "documents"
    key = "vec_id" if name.startswith("op3") else "doc_id"
    got = QUERIES[name](spark, sf)
    assert got.select(key).distinct().count() == spark.read.parquet(f"{sf}/{table}.parquet").select(key).distinct().count()


def test_pipeline(spark, sf):
    """Every stage against a brute-force version of it, on what the stage before kept."""
    import corpus_pipeline as cp
    from fluxsieve.llm.common import cut

    d = spark.read.parquet(f"{sf}/documents.parquet")
    columns = d.columns

    def texts(df):
        return {r.doc_id: r.text for r in df.select("doc_id", "text").collect()}

    def stage(i, df):
        out = cut(cp.STAGES[i][1](spark, df, sf))
        assert i == 4 or out.columns == columns
        return out

    scores = quality.score(d, quality.fit(d)).where("keep").select("doc_id").collect()
    good = stage(0, d)
    assert set(texts(good)) == {r.doc_id for r in scores} and good.count() < d.count()

    rows = sorted(texts(good).items())
    gone = brute_lines(rows)
    deduped = stage(1, good)
    assert texts(deduped) == {i: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (n, k) not in gone) for n, (i, t) in enumerate(rows)}

    # near copies of this size go in line dedup: some are put back
    base = max((t for t in texts(deduped).values() if t), key=len)
    planted = deduped.limit(3).withColumns({"doc_id": F.col("doc_id") + 100_000, "text": F.lit(base + " and one more")})
    both = cut(deduped.unionAll(planted))
    found = brute_groups(sorted((r.doc_id, r.text) for r in both.collect()), 5, 80, 100)
    single = stage(2, both)
    want = {c if n else i for i, n, c in found}
    assert set(texts(single)) == want and len(want) <= both.count() - 3 and single.count() == len(want)

    taken = {r.doc_id: (r.taken, r["size"]) for r in mixing.mix(single).collect()}
    mixed = stage(3, single)
    words, times = collections.Counter(), collections.Counter()
    for r in mixed.collect():
        words[r.doc_id] += len(r.text.split())
        times[r.doc_id] += 1
    assert dict(words) == {i: t for i, (t, _) in taken.items() if t} and all(times[i] == -(-t // n) for i, (t, n) in taken.items() if t)

    out = stage(4, mixed)
    assert out.where("not round_trip").count() == 0 and out.where("rank = 1").count() == mixed.count()
    assert cp.ORACLE_SQL is None and len(cp.STAGES) == 5
