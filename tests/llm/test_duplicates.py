"""Near duplicates, leaks and repeated strings, against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

from claimlake.llm import suffix_dedup
from claimlake.llm.bwt import repeated
from claimlake.llm.components import connected_components
from claimlake.llm.decontaminate import decontaminate, find_leaks
from claimlake.llm.near_dedup import near_duplicates
from claimlake.llm.suffix_dedup import remove_repeats

from .conftest import edited, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def components(n, pairs):
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def brute_duplicates(rows):
    sets = [shingle_set(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (c := len(sets[i] & sets[j])) and
             100 * c >= 75 * len(sets[i] | sets[j])]
    part = components(len(rows), pairs)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if part[j] == part[i] and rows[j][0] is not None]
        least = min(ids, default=None) if sets[i] else doc
        out.append((doc, len(sets[i]), least, doc == least))
    return out


def key(row):
    return tuple((x is None, x) if not isinstance(x, bytes) else x for x in row)


def test_near_duplicates_equal_brute_force(corpus):
    rows = [(r.doc_id, r.text) for r in corpus.collect()]
    got = [tuple(r) for r in near_duplicates(corpus).collect()]
    assert sorted(got, key=key) == sorted(brute_duplicates(rows), key=key)


def test_near_copies_without_a_common_centre(spark):
    # a chain of texts: neighbours are linked, far ones are not
    base = prose(1, 150).split()
    texts = []
    for i in range(40):
        words = list(base)
        for j in range(i * 3):
            words[j] = f"y{j}"
        texts.append((i, " ".join(words)))
    rng = random.Random(4)
    texts += [(100 + i, edited(texts[20][1], rng.random(), 0.03)) for i in range(60)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = [tuple(r) for r in near_duplicates(docs).collect()]
    assert sorted(got, key=key) == sorted(brute_duplicates(texts), key=key)


def test_no_rows(corpus):
    assert near_duplicates(corpus.limit(0)).collect() == []
    assert remove_repeats(corpus.limit(0)).collect() == []


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(1, 2), (2, 3), (5, 4), (4, 5), (None, 3)],
                                   [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)]])
def test_components(spark, edges):
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [(a, b) for a, b in edges if a is not None and a != b]
    part = components(60, real)
    assert got == {x: part[x] for e in real for x in e}


def test_leaks_equal_brute_force(spark, corpus):
    text = prose(902, 30_000).split()
    items = [(1, " ".join(text[20_000:20_040])), (2, " ".join(text[500:520] + text[900:920])), (3, "one two"),
             (4, None), (5, ""), (6, " ".join(text[100:115] + ["zz"] * 9)), (1, " ".join(text[7:60])), (None, prose(7, 20)),
             (8, prose(12345, 40))]
    bench = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, _bytes int")
    want, leaky = [], set()
    for doc, t, label in [(r.doc_id, r.text, r.label) for r in corpus.collect()]:
        held = shingle_set(t)
        for item, q in items:
            s = shingle_set(q)
            if s and 100 * len(s & held) >= 75 * len(s):
                want.append((doc, item, len(s & held), len(s)))
                leaky.add(label)
    for block in (1, 1 << 20):  # one item a pass, and all at once
        got = [tuple(r)[:4] for r in find_leaks(corpus, bench, block_bytes=block).collect()]
        assert sorted(got, key=key) == sorted(want, key=key)
    # rows go by their own text, whatever their id
    assert sorted(r.label for r in decontaminate(corpus, bench).collect()) == sorted(
        r.label for r in corpus.collect() if r.label not in leaky)
    assert decontaminate(corpus, bench).columns == corpus.columns
    assert find_leaks(corpus, bench.limit(0)).collect() == [] == find_leaks(corpus.limit(0), bench).collect()


def brute_repeats(rows, length):
    seen, out = set(), []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, (rows[i][1] or "").encode()))
    for i in order:
        b = (rows[i][1] or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            gram = hashlib.blake2b(b[p:p + length], digest_size=16).digest()
            if gram in seen:
                gone[p:p + length] = b"\1" * length
            seen.add(gram)
        spans, at = [], 0
        for m in re.finditer(rb"\x01+", bytes(gone)):
            spans.append((m.start(), m.end()))
        out.append((rows[i][0], len(b), tuple(spans), bytes(x for x, y in zip(b, gone, strict=True) if not y)))
    return out


@pytest.mark.parametrize("length", [40, 100])
def test_removed_bytes_equal_brute_force(spark, corpus, length):
    rows = [(r.doc_id, r.text) for r in corpus.collect()]
    passage = prose(77, 60)
    rows += [(500 + i, prose(600 + i, 20) + " " + passage[i % 3:] + " " + prose(700 + i, 20)) for i in range(40)]
    rows += [(600, "ab" * 200), (601, "a" * 500), (602, "z" + "a" * 180 + "b"), (603, passage + passage)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for size in (300, 1 << 20):
        got = [(r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.removed), bytes(r.kept))
               for r in remove_repeats(docs, length, merge_bytes=size).collect()]
        assert sorted(got, key=key) == sorted(brute_repeats(rows, length), key=key)


def test_a_common_passage_is_split_over_merges(spark, monkeypatch):
    most, intervals = 4096, suffix_dedup._intervals

    def bounded(length):
        inner = intervals(length)

        def run(table):
            held = sum(len(x) for x in table.column("bytes").to_pylist())
            assert held <= 8 * most, held
            return inner(table)

        return run

    monkeypatch.setattr(suffix_dedup, "_intervals", bounded)
    passage = prose(78, 50)
    rows = [(i, prose(2000 + i, 8) + passage + prose(4000 + i // 2, 8)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [(r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.removed), bytes(r.kept))
           for r in remove_repeats(docs, merge_bytes=most).collect()]
    assert sorted(got) == sorted(brute_repeats(rows, 100))


def test_documents_are_sent_once_for_the_stretches_of_all_anchors(spark, monkeypatch):
    sent, kind = [], type(spark.range(0))
    run = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda df, f, *a, **k: (sent.append(f), run(df, f, *a, **k))[1])
    passage = prose(78, 50)
    rows = [(i, prose(2000 + i, 8) + passage + prose(4000 + i // 2, 8)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = [(r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.removed), bytes(r.kept))
           for r in remove_repeats(docs, merge_bytes=4096).collect()]
    assert sorted(got) == sorted(brute_repeats(rows, 100))
    assert any("_pieces" in f.__qualname__ for f in sent)  # some anchors were too large for one merge
    assert sent.count(suffix_dedup._cut) == 1


def test_unique_ids_need_no_numbering(spark):
    rows = [(i, prose(i % 7, 40) + prose(50 + i, 10)) for i in range(30)]
    got = [(r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.removed), bytes(r.kept))
           for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert sorted(got) == sorted(brute_repeats(rows, 100))


def test_merged_transforms_equal_brute_force():
    rng = random.Random(2)
    for _ in range(150):
        letters, depth = rng.choice(["a", "ab", "abcdef", "ab\xff\x00"]), rng.choice([1, 2, 5, 9])
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))).encode("latin1") for _ in range(rng.randint(0, 12))]
        texts += texts[:1]
        places = {}
        for i, t in enumerate(texts):
            for p in range(len(t) - depth + 1):
                places.setdefault(t[p:p + depth], []).append((i, p))
        got = {}
        for k, i, p in zip(*repeated(texts, depth, rng.choice([1, 2, 4])), strict=True):
            got.setdefault(k, []).append((int(i), int(p)))
        assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in places.values() if len(v) > 1)
