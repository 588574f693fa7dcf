"""Classifiers, mixing, shards, secrets and top-k: brute force, laws and odd rows."""

from __future__ import annotations

import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlake.llm.mixing import mix_sources
from claimlake.llm.quality import fit_quality, score_quality
from claimlake.llm.secrets import KINDS, SCOPE, find_secrets
from claimlake.llm.sharding import shuffle_shards, write_shards
from claimlake.llm.topk import resolve, top_k
from claimlake.llm.toxicity import score_toxicity

from .conftest import prose


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full = set()
    while True:
        open_ = [s for s in names if s not in full]
        left = sum(sizes.values()) - sum(most * sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in full else share[s] for s in names}
        full |= above


def test_mix(corpus):
    got = mix_sources(corpus).collect()
    sizes, taken, largest = {}, {}, {}
    for r in got:
        assert r._size == words(r.text) and r._taken == r._copies * r._size <= 3 * r._size
        sizes[r.source] = sizes.get(r.source, 0) + r._size
        taken[r.source] = taken.get(r.source, 0) + r._taken
        largest[r.source] = max(largest.get(r.source, 0), r._size)
    want = targets(sizes)
    for r in got:
        assert r._source_size == sizes[r.source] and r._target == pytest.approx(want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]
    again = mix_sources(corpus.repartition(3)).collect()
    assert sorted((r.label, r._copies) for r in got) == sorted((r.label, r._copies) for r in again)
    assert mix_sources(corpus.limit(0)).collect() == []


def test_mix_is_near_its_targets_and_prefers_long_texts(spark):
    rows = [(i, prose(i, 5 if i % 2 else 80), f"s{i % 5}") for i in range(3000)]
    got = mix_sources(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    for s in {r.source for r in got}:
        own = [r for r in got if r.source == s]
        assert abs(sum(r._taken for r in own) - own[0]._target) <= 40
    drawn = [r for r in got if r.source in ("s2", "s4") and r._copies > 0]
    long, short = sum(r._size == 80 for r in drawn), sum(r._size == 5 for r in drawn)
    assert drawn == [] or long > short


def test_shards(spark, corpus, tmp_path):
    got = shuffle_shards(corpus, bucket_bytes=20_000)
    rows = got.collect()
    assert len(rows) == corpus.count()
    for s in range(8):
        assert sorted(r._slot for r in rows if r._shard == s) == list(range(sum(r._shard == s for r in rows)))
    by_id = {}
    for r in rows:
        assert r._grown_shard in (r._shard, 8)
        assert by_id.setdefault(r.doc_id, r._shard) == r._shard
    nine = {r.doc_id: r._shard for r in shuffle_shards(corpus, shards=9).collect()}
    assert all(nine[r.doc_id] == r._grown_shard for r in rows)
    again = shuffle_shards(corpus.repartition(2), bucket_bytes=20_000).collect()
    place = lambda rs: sorted((r._shard, r._slot, str(r.doc_id), r.text or "") for r in rs)
    assert place(rows) == place(again)
    assert shuffle_shards(corpus.limit(0)).collect() == []
    write_shards(got, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == len(rows)


def test_shuffle_is_uniform(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    rows = shuffle_shards(docs, bucket_bytes=1 << 16).toPandas()
    sizes = rows.groupby("_shard").size()
    assert abs(sizes - 2500).max() < 250
    assert abs(np.corrcoef(rows.doc_id, rows._slot)[0, 1]) < 0.05
    assert abs((rows._grown_shard == 8).mean() - 1 / 9) < 0.02


JUNK = "BUY!! NOW!! | $$$ | CLICK### HERE%%% "


def test_quality(spark):
    rows = [(i, (JUNK * 20 if i % 3 == 0 else prose(i, 150)) + ". ", i) for i in range(240)]
    docs = spark.createDataFrame([*rows, (900, None, 1), (901, "", 1), (None, prose(1, 20), 1), (0, prose(5, 400_0), 1)],
                                 "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in range(240)], "doc_id long, quality int, score int")
    got = score_quality(docs, labels).collect()
    assert len(got) == docs.count()
    right = [r.predicted == (r.doc_id % 3 > 0) for r in got if r.held_out and r.doc_id < 240]
    assert right and np.mean(right) > 0.95
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    assert score_quality(docs.limit(0), labels).collect() == []
    assert {r.score for r in score_quality(docs, labels.limit(0)).collect()} == {0.5}
    # labels of held-out rows are never learned from
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1,
                                                  1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = fit_quality(docs, labels), fit_quality(docs, flipped)
    assert all(np.array_equal(a.weights[k], b.weights[k]) for k in a.weights)


def test_toxicity(spark):
    bad = ["idiot", "grumblefoo", "nastybar"]
    rows = [(i, prose(i, 60) + " you " + (" ".join(bad[(i // 4 + k) % 3] for k in range(4)) if i % 4 == 0 else "friend")
             + " " + prose(i + 1, 40), i) for i in range(400)]
    docs = spark.createDataFrame([*rows, (900, None, 1), (901, "", 1), (None, prose(1, 20), 1), (902, prose(5, 5000), 1)],
                                 "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    got = score_toxicity(docs, labels).collect()
    assert len(got) == docs.count()
    right = [r.predicted == (r.doc_id % 4 == 0) for r in got if r.held_out and r.doc_id < 400]
    assert right and np.mean(right) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert score_toxicity(docs.limit(0), labels).collect() == []
    assert {r.score for r in score_toxicity(docs, labels.limit(0)).collect()} == {0.5}


def base(text):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text, re.I | re.A):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def linked(text, weak, scope=SCOPE):
    """Weak parts with complements in scope, by comparing all pairs."""
    role = {0: "secret", 2: "secret", 4: "secret", 1: "id", 3: "id", 5: "endpoint"}
    parts = [*base(text), *weak]
    out = []
    for s, k, e in weak:
        near = {role[k2] for s2, k2, e2 in parts if max(s2 - e, s - e2, 0) <= scope and (s2, k2, e2) != (s, k, e)}
        if {3: {"secret"}, 4: {"id"}, 5: {"id", "secret"}}[k] <= near:
            out.append((s, k, e))
    return out


def test_secrets(spark):
    h, gap = "0123456789abcdef" * 2, "é漢 " * 40
    texts = [
        None, "", "no secrets", f"Password: 'longenough' {h} AKIA{'A' * 12}", "token=short, Api_Key=\"abcdefgh\"", f"{h}{h}",
        "token: secret=ABCDEFGHIJ", 'token: "secret" = "abcdefghij"', "AKIAAAKIA" + "Z" * 11, "user=alice", "user=alice pwd=hunter22",
        "user=alice " + "x " * 200 + "pwd=hunter22", "https://a.b/c", "see https://a.b/c user=alice passwd=hunter2222",
        f"é user=bob {gap} pass: abcdef9 {gap} host=db.example.org", "漢" * 30 + f" password={h}", "password=" * 400,
        "AKIAABCDEFG secret=abcd", f"{h} " * 700, "user=a12 " * 300 + "pwd=secret99 " * 300,
    ]
    texts += ["user=alice" + " " * n + "pwd=hunter22" for n in (SCOPE - 1, SCOPE, SCOPE + 1, 2 * SCOPE)]
    docs = spark.createDataFrame([(i // 2, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, spans int").repartition(3)
    every = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    from claimlake.llm.secrets import find_parts

    weak = {r.id: sorted({tuple(x) for x in r.weak}) for r in find_parts(every, "doc_id", "text").collect()}
    got = {r.doc_id: r for r in find_secrets(every).collect()}
    assert len(got) == len(texts)
    seen = set()
    for i, t in enumerate(texts):
        assert [tuple(x) for x in got[i].base] == base(t or ""), t
        want = sorted(base(t or "") + linked(t or "", weak[i]))
        assert [tuple(x) for x in got[i].spans] == want, t
        seen |= {k for _, k, _ in want}
    assert seen == set(range(len(KINDS)))
    assert find_secrets(docs).count() == len(texts)
    assert find_secrets(docs.limit(0)).collect() == []


def brute_top(rows, k=5):
    real = [(i, np.floor(256 * np.array(v, float)).astype(object)) for i, v in rows
            if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, (i, x) in enumerate(real):
        if i % 50 == 0:
            scores = sorted((-sum(a * b for a, b in zip(x, y, strict=False)), j) for p, (j, y) in enumerate(real) if p != q)
            out += [(i, r + 1, j, int(-s)) for r, (s, j) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("dims", [1, 3, 16])
def test_top_k(spark, dims):
    rng = np.random.default_rng(dims)
    rows = [(i, [float(x) for x in rng.normal(0, 1, dims)]) for i in range(300)]
    rows += [(1000 + i, rows[50][1]) for i in range(40)] + [(2000, rows[50][1]), (2050, [-x for x in rows[7][1]])]
    rows += [(400, None), (450, [float("nan")] * dims), (401, [None] * dims), (402, [float("inf")] * dims), (None, rows[0][1]),
             (500, []), (501, rows[3][1] + [9.0]), (550, [1e7] * dims), (301, rows[50][1]), (301, rows[51][1])]
    vectors = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, score int, block int")
    got = top_k(vectors, F.col("vec_id") % 50 == 0, rows=64, block_queries=3)
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got.collect()) == brute_top(rows)


def test_top_k_of_few(spark):
    vectors = spark.createDataFrame([(0, [1.0]), (1, [0.5]), (2, [-1.0])], "vec_id long, embedding array<float>")
    got = top_k(vectors, F.col("vec_id") % 50 == 0).collect()
    assert sorted(tuple(r) for r in got) == [(0, 1, 1, 32768), (0, 2, 2, -65536)]
    assert top_k(vectors.limit(0), F.col("vec_id") % 50 == 0).collect() == []


@pytest.mark.parametrize("kind,most", [("alike", 0.9), ("skewed", 0.25), ("short", 1.0)])
def test_most_entries_are_spared(kind, most):
    rng = np.random.default_rng(9)
    x = rng.standard_normal((3000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    if kind == "skewed":
        x *= rng.pareto(1.5, 3000)[:, None] + 0.01
    x, y = np.floor(256 * x).astype(np.int64), np.floor(256 * x[:40]).astype(np.int64)
    score = y @ x.T
    if kind == "short":  # no cutoff is known
        cut = np.full(40, np.iinfo(np.int64).min // 8)
    else:
        cut = np.sort(score, axis=1)[:, -6]
    query, row, found, spent = resolve(x, y, cut, 8)
    want = np.nonzero(score >= cut[:, None])
    assert sorted(zip(query, row)) == sorted(zip(*want)) and (found == score[query, row]).all()
    assert spent <= most * score.size * 8
