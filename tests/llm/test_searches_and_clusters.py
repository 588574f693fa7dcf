"""Ranked search, nearest neighbours and clusters, against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from claimlake.llm import hash_forest, ranked_search as ranking
from claimlake.llm.centroids import cluster
from claimlake.llm.hash_forest import candidates_for, nearest
from claimlake.llm.ranked_search import Best, ranked_search, search_bucket

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_ranking(docs, items, most=50):
    terms = [(d, terms_of(t)) for d, t in docs]
    full = [(d, t) for d, t in terms if t]
    n_docs, length = len(full), sum(len(t) for _, t in full)
    df = {}
    for _, t in full:
        for w in set(t):
            df[w] = df.get(w, 0) + 1
    out = []
    for item, text in items:
        scored = []
        for d, t in full:
            m, score = 50 + (50 * len(t) * n_docs) // length, 0
            for w in set(terms_of(text)):
                if tf := t.count(w):
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1)))
                    score += weight * ((10**9 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        scored.sort(key=lambda r: r[:3])
        out += [(item, k + 1, r[3], -r[0]) for k, r in enumerate(scored[:most])]
    return out


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x) for x in r))


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, "w1 W2, w3 w4;w5"), (2, "ähnlich w7"), (3, None), (4, " ., "), (5, "nowhere"), (6, "end one TWO"),
            (7, " ".join(f"w{k}" for k in range(120))), (7, "w9"), (None, "w11 w12 w11")]
    columns = ["item", "doc", "rank", "uid", "id", "text_", "at", "n"]
    data = [(*r, *([k] * len(columns))) for k, r in enumerate(rows)]
    return spark.createDataFrame(data, "item_id int, text string, " + ", ".join(f"`{c}` int" for c in columns))


@pytest.mark.parametrize("block_terms,bucket", [(200_000, 2048), (40, 16)])
def test_ranked_search_equals_brute_force(corpus, items, monkeypatch, block_terms, bucket):
    monkeypatch.setattr(ranking, "BUCKET", bucket)
    docs = [(r.doc_id, r.text) for r in corpus.collect()]
    asked = [(r.item_id, r.text) for r in items.collect()]
    for most in (3, 50):
        got = [tuple(r) for r in ranked_search(corpus, items, most=most, block_terms=block_terms).collect()]
        assert ordered(got) == ordered(brute_ranking(docs, asked, most))


def test_ranked_search_of_empty_tables(spark, corpus, items):
    none = spark.createDataFrame([], corpus.schema)
    blank = spark.createDataFrame([(1, None), (2, " ")], "doc_id long, text string")
    assert ranked_search(none, items).count() == ranked_search(blank, items).count() == 0
    assert ranked_search(corpus, spark.createDataFrame([], items.schema)).columns == ["item_id", "rank", "doc_id", "score"]


def test_ranked_search_counts_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(ranking, "PIECE", 7)
    rng = random.Random(1)
    docs = [(i, " ".join(rng.choice(["alpha", "b", "gamma9", "dé"]) for _ in range(rng.randrange(30)))) for i in range(40)]
    items = [(1, "b dé"), (2, "gamma9-alpha")]
    got = ranked_search(spark.createDataFrame(docs, "doc_id long, text string"),
                        spark.createDataFrame(items, "item_id long, text string"))
    assert ordered(tuple(r) for r in got.collect()) == ordered(brute_ranking(docs, items))


def test_buckets_and_rows_are_spared():
    rng = np.random.default_rng(2)
    n, asked = 4000, np.arange(18)
    owner = np.repeat(np.arange(n), 8)
    terms = np.concatenate([rng.choice(60, 8, replace=False) for _ in range(n)])
    values = rng.integers(1, 1000, len(owner)) * np.repeat(np.sort(rng.integers(1, 1000, n))[::-1], 8)
    lengths = np.sqrt(np.bincount(owner, weights=values.astype(float) ** 2))
    order = np.argsort(-lengths, kind="stable")
    dense = np.zeros((n, 60), np.int64)
    dense[owner, terms] = values
    dense, lengths = dense[order], lengths[order]
    best = Best(np.zeros(1), 20)
    for low in range(0, n, 500):
        part = dense[low:low + 500]
        at, term = np.nonzero(part)
        search_bucket(best, [asked], np.arange(low, low + 500), np.zeros(500, bool), lengths[low:low + 500], at, term, part[at, term])
    score = dense[:, :18].sum(axis=1)
    want = np.lexsort((np.arange(n), -score))[:20]
    assert best.rows[0][1].tolist() == want.tolist() and best.rows[0][0].tolist() == score[want].tolist()
    assert best.pruned > n / 4 and best.bounded > n / 5 and best.rescored < n / 2
    assert best.pruned + best.bounded + best.rescored == n


def vectors_of(spark, rows):
    extra = ["uid", "v", "id", "asks", "tree", "key", "label", "n", "q", "block", "shard", "cluster", "distance", "ids"]
    data = [(i, x, *([k] * len(extra))) for k, (i, x) in enumerate(rows)]
    return spark.createDataFrame(data, "vec_id long, embedding array<float>, " + ", ".join(f"`{c}` int" for c in extra)).repartition(3)


ODD = [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [1.0, None] * 8),
       (905, [float("inf")] * 16)]


def brute_nearest(rows, divisor, k):
    rows = [(i, [np.float32(x) for x in v]) for i, v in rows
            if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for at, (i, v) in enumerate(rows):
        if i % divisor == 0 and not any(r == (i, v) for r in rows[:at]):
            scored = []
            for other, (j, w) in enumerate(rows):
                if other != at:
                    total = 0.0
                    for a, b in zip(v, w):
                        total += float(a) * float(b)
                    scored.append((-total, j))
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(sorted(scored)[:k])]
    return out


@pytest.mark.parametrize("leaf_bytes", [8 << 20, 2048])
def test_nearest_with_all_rows_as_candidates_is_exact(spark, leaf_bytes):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.standard_normal(16) * rng.uniform(0.2, 3)).tolist()) for i in range(160)]
    rows += [(200 + i, rows[3][1]) for i in range(40)] + [(7, rows[0][1]), (0, rows[0][1]), (None, rows[1][1]), (300, [1.0, 2.0])] + ODD
    got = nearest(vectors_of(spark, rows), F.col("vec_id") % 20 == 0, k=6, recall=1.0, trees=6, leaf_bytes=leaf_bytes, sample=500)
    want = brute_nearest(rows, 20, 6)
    # with a recall of 1 measured on all queries, nothing may be missed
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_nearest_reaches_the_recall_asked_for(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((40, 32))
    rows = [(i, (centres[i % 40] + 0.4 * rng.standard_normal(32)).tolist()) for i in range(3000)]
    want = {(r[0], r[2]) for r in brute_nearest(rows, 20, 10)}
    got = nearest(vectors_of(spark, rows), F.col("vec_id") % 20 == 0, k=10, leaf_bytes=32 * 8 * 300, sample=60).collect()
    assert len({(r.query_id, r.vec_id) for r in got} & want) >= 0.9 * len(want)
    assert len(got) == len(want) and {r["rank"] for r in got} == set(range(1, 11))


def test_nearest_of_hot_leaves(spark, monkeypatch):
    # near copies share all bits: their leaf is dealt, rows and queries, over many tasks
    rng = np.random.default_rng(5)
    base = rng.standard_normal(8)
    rows = [(i, (base + 1e-4 * rng.standard_normal(8)).tolist()) for i in range(300)]
    rows += [(300 + i, rng.standard_normal(8).tolist()) for i in range(100)]
    got = nearest(vectors_of(spark, rows), F.col("vec_id") % 2 == 0, k=4, recall=1.0, trees=4, bits=12, leaf_bytes=8 * 8 * 20, sample=400)
    assert sorted(tuple(r) for r in got.collect()) == sorted(brute_nearest(rows, 2, 4))


def test_nearest_of_empty_tables(spark):
    got = nearest(vectors_of(spark, ODD), F.col("vec_id") > 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"] and got.count() == 0
    one = nearest(vectors_of(spark, [(20, [1.0, 2.0])]), F.col("vec_id") % 20 == 0)
    assert one.count() == 0


def test_candidates_for_a_recall():
    totals = {1: np.array([100, 60, 20, 3, 1])}
    asked = {1: np.array([0b1010, 0b0000])}
    near = [(1, np.array([0b1010, 0b1111])), (1, np.array([0b1000, 0b1111])), (1, np.array([0b0000, 0b0111]))]
    # neighbours share 4, 2 and 1 bits in their better tree
    assert candidates_for(0.0, totals, near, asked, 4) == 1
    assert candidates_for(0.3, totals, near, asked, 4) == 4
    assert candidates_for(1.0, totals, near, asked, 4) == 21


def brute_clusters(rows, k, rounds, dims):
    kept = [(i, [math.floor(1024 * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:k]]

    def assign():
        out = []
        for _, v in kept:
            far = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centres]
            out.append((far.index(min(far)), min(far)))
        return out

    for _ in range(rounds):
        labels = assign()
        for c in range(len(centres)):
            mine = [v for (_, v), (at, _) in zip(kept, labels) if at == c]
            if mine:
                centres[c] = [sum(x) // len(mine) for x in zip(*mine)]
    labels = assign()
    each = [sum(d for at, d in labels if at == c) for c in range(len(centres))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return [(i, at, d, each[at], sum(each), names[at]) for (i, _), (at, d) in zip(kept, labels)]


@pytest.mark.parametrize("k,shard_dims,limit", [(8, 16, 16 << 20), (5, 7, 0), (1, 3, 16 << 20)])
def test_clusters_equal_brute_force(spark, monkeypatch, k, shard_dims, limit):
    from claimlake.llm import centroids

    monkeypatch.setattr(centroids, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(centroids, "BLOCK_ROWS", 16)
    monkeypatch.setattr(centroids, "TASK_BYTES", 4096)
    rng = np.random.default_rng(6)
    rows = [(i, (rng.standard_normal(16) * 2).tolist()) for i in range(150)]
    rows += [(300 + i, rows[0][1]) for i in range(60)] + [(5, rows[9][1]), (5, rows[8][1]), (None, rows[7][1]), (310, [1.0])] + ODD
    got = cluster(vectors_of(spark, rows), k=k, rounds=3, dims=16, shard_dims=shard_dims)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert ordered(tuple(r) for r in got.collect()) == ordered(brute_clusters(rows, k, 3, 16))


def test_clusters_of_few_and_no_rows(spark):
    few = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [-4.0, 0.5])]
    got = cluster(vectors_of(spark, few), k=8, rounds=2, dims=2)
    assert ordered(tuple(r) for r in got.collect()) == ordered(brute_clusters(few, 8, 2, 2))
    assert cluster(vectors_of(spark, ODD[:1]), dims=16).count() == 0


def test_cells_are_not_moved_in_a_round(spark, monkeypatch):
    from claimlake.llm import centroids

    plans, written = [], centroids.stage
    monkeypatch.setattr(centroids, "stage", lambda df, name: plans.append((name, df._jdf.queryExecution().toString())) or written(df, name))
    rng = np.random.default_rng(7)
    cluster(vectors_of(spark, [(i, rng.standard_normal(16).tolist()) for i in range(50)]), k=3, rounds=1, dims=16).count()
    plan = [p for name, p in plans if name == "centroids"][1].split("== Physical Plan ==")[1]
    joined = plan[plan.index("ShuffledHashJoin"):].split("\n")
    assert "Exchange" not in joined[1] and "Bucketed: true" in plan


def test_strings_of_equal_rows_agree_across_batches():
    normals = hash_forest.planes(9, 3, 10)
    x = np.random.default_rng(8).standard_normal((50, 8))
    entry, query = hash_forest._keys_of(x, 10.0, normals, 3)
    assert entry.shape == (50, 3) and entry.max() < 1 << 10 and (entry[7:9] == hash_forest._keys_of(x[7:9], 10.0, normals, 3)[0]).all()
    assert (query == hash_forest._keys_of(x * 0.5, 10.0, normals, 3)[1]).all()
