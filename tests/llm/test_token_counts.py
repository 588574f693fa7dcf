from __future__ import annotations

import os

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimlake.llm.token_counts import (
    LEAF, TokenTree, _counter, edit_trees, edited_counts, read_vocabulary, redactions, searched_redactions, token_trees,
)

VOCABULARY = os.environ.get("VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")
pytestmark = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary")
PARTS = ["a", "Word", " ", "  ", "\n", "\t", "'", "'s", "ll", "12", "é", "漢", ".", "!!", "x1", " the", " ", "t"]
TEXT = st.lists(st.sampled_from(PARTS), max_size=60).map("".join)


@pytest.fixture(scope="module")
def counter():
    return _counter(read_vocabulary(None, VOCABULARY))


def whole(text, counter):
    return len(counter.coder.encode_ordinary(text))


@settings(max_examples=400, deadline=None)
@given(TEXT, st.lists(st.tuples(st.integers(0, 200), st.integers(0, 12), TEXT), max_size=6))
def test_edits_equal_encoding_the_whole(text, edits):
    counter = _counter(read_vocabulary(None, VOCABULARY))
    tree = TokenTree.of(text, counter)
    assert tree.tokens == whole(text, counter)
    for start, width, new in edits:
        start = min(start, len(text))
        end = min(len(text), start + width)
        text, _ = tree.edit(text, start, end, new, counter)
        assert [n for a, _ in tree.leaves for n in a] == [len(p) for p in counter.pieces(text)]
        assert (tree.tokens, tree.length) == (whole(text, counter), len(text))
        assert tree.levels[0] == ([(sum(a), sum(b)) for a, b in tree.leaves] or [(0, 0)])


def test_only_the_touched_region_is_encoded(counter):
    text = " word and another." * 5000
    tree = TokenTree.of(text, counter)
    text, n = tree.edit(text, 40_000, 40_010, "something else", counter)
    assert n < 20
    assert tree.tokens == whole(text, counter)
    assert all(len(a) <= 2 * LEAF for a, _ in tree.leaves)


def test_rows(spark, counter):
    rows = [(1, "mail a.b@c.org now", "x"), (1, "mail a.b@c.org now", "x"), (None, None, None), (3, "", "y"),
            (4, " ".join(f"p{i}@q.net" for i in range(400)), "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    mail = r"[a-z0-9.]+@[a-z0-9.]+"
    got = edited_counts(docs, read_vocabulary(spark, VOCABULARY), redactions(F.col("text"), mail, "<mail>")).collect()
    assert len(got) == 5
    import re
    for r in got:
        text = next(t for i, t, _ in rows if i == r.doc_id) or ""
        after = re.sub(mail, "<mail>", text)
        assert r.n_edits == len(re.findall(mail, text))
        assert (r.n_tokens, r.n_tokens_after, r.n_chars_after) == (whole(text, counter), whole(after, counter), len(after))
        assert r.tree_sums[-1] == r.n_tokens_after
    assert edited_counts(docs.limit(0), read_vocabulary(spark, VOCABULARY), F.lit(None)).count() == 0


def test_odd_edits(spark, counter):
    docs = spark.createDataFrame([(1, "abc"), (2, None)], "doc_id int, text string")
    edits = F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.lit("x ").alias("new")), F.lit(None),
                    F.struct(F.lit(2).alias("start"), F.lit(99).alias("end"), F.lit(None).cast("string").alias("new")))
    got = {r.doc_id: r for r in edited_counts(docs, read_vocabulary(spark, VOCABULARY), edits).collect()}
    assert got[1].n_tokens_after == whole("x ab", counter)
    assert got[2].n_tokens_after == whole("x ", counter)


def spread(text, cuts):
    """Ascending edits that do not meet, from (gap, width, new) triples."""
    out, at = [], 0
    for gap, width, new in cuts:
        start = min(len(text), at + gap)
        at = min(len(text), start + width)
        out.append((start, at, new))
    return out


@settings(max_examples=400, deadline=None)
@given(TEXT, st.lists(st.tuples(st.integers(0, 40), st.integers(0, 12), TEXT), max_size=8), st.integers(1, 5))
def test_lists_of_edits_equal_encoding_the_whole(text, cuts, copies):
    counter = _counter(read_vocabulary(None, VOCABULARY))
    text = text * copies
    tree = TokenTree.of(text, counter)
    for _ in range(2):  # trees are kept, and edited again
        edits = spread(text, cuts)
        want = text
        for start, end, new in reversed(edits):
            want = want[:start] + new + want[end:]
        text, _ = tree.apply(text, edits, counter)
        assert text == want
        assert [n for a, _ in tree.leaves for n in a] == [len(p) for p in counter.pieces(text)]
        assert (tree.tokens, tree.length) == (whole(text, counter), len(text))
        assert tree.levels[0] == ([(sum(a), sum(b)) for a, b in tree.leaves] or [(0, 0)])


def test_long_lists_of_edits_take_linear_time(spark, counter):
    import time

    mail, took = r"[a-z0-9.]+@[a-z0-9.]+", []
    for n in (4_000, 64_000):
        text = " ".join(f"word p{i}@q.net" for i in range(n))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time.perf_counter()
        got = edited_counts(docs, read_vocabulary(spark, VOCABULARY), searched_redactions(F.col("text"), mail, "<mail>")).first()
        took.append(time.perf_counter() - start)
        assert got.n_edits == n and got.n_tokens_after == whole(" ".join(["word <mail>"] * n), counter)
    assert took[1] < 20 * took[0] + 10


def test_kept_trees_encode_only_what_later_edits_touch(spark, counter):
    vocabulary = read_vocabulary(spark, VOCABULARY)
    rows = [(1, " word and another." * 2000), (1, "short"), (None, None), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("lengths", F.lit(1))
    trees = token_trees(docs, vocabulary)
    assert sorted(r.n_tokens for r in trees.collect()) == sorted(whole(t or "", counter) for _, t in rows)

    def edit(start, end, new):
        return F.array(F.struct(F.lit(start).alias("start"), F.lit(end).alias("end"), F.lit(new).alias("new")))

    once = edit_trees(trees, vocabulary, edit(9_000, 9_010, "something else"))
    twice = edit_trees(once, vocabulary, edit(2, 3, "é漢"))
    for frame in (once, twice):
        for r in frame.collect():
            assert r.n_tokens == whole(r.text, counter) and r.n_reencoded < 20
            assert sum(map(sum, r.lengths)) == len(r.text) and sum(map(sum, r.counts)) == r.n_tokens
    texts = sorted(r.text for r in twice.collect())
    long = rows[0][1][:9_000] + "something else" + rows[0][1][9_010:]
    short = "short" + "something else"  # an edit past the end is cut to the text
    want = sorted(t[:2] + "é漢" + t[3:] for t in (long, short, "something else", "something else"))
    assert texts == want
