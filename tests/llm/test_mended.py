"""Words that collided, texts beyond the size of a piece, rows that share ids, names that clash."""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from claimlake.llm import passages, quality, shingles, toxicity
from claimlake.llm.decontaminate import decontaminate, find_leaks
from claimlake.llm.mixing import mix_sources
from claimlake.llm.near_dedup import near_duplicates
from claimlake.llm.sharding import deal, in_slot_order, shuffle_shards, write_shards

from .conftest import prose


def thue_morse(n: int) -> tuple[str, str]:
    word = "".join("ab"[bin(k).count("1") % 2] for k in range(n))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_without_linear_structure(spark):
    x, y = thue_morse(1024)
    docs = spark.createDataFrame([(1, " ".join([x] * 6)), (2, " ".join([y] * 6)), (3, f"{x} b c d e f"), (4, f"{y} b c d e f")],
                                 "doc_id long, text string")
    assert all(r.component_id == r.doc_id and r.kept for r in near_duplicates(docs).collect())
    items = spark.createDataFrame([(1, f"{x} b c d e f")], "item_id long, text string")
    assert [r.doc_id for r in find_leaks(docs, items).collect()] == [3]


def test_word_hashes_tell_all_words_apart():
    rng = np.random.default_rng(1)
    words = {bytes(rng.integers(97, 99, n).astype(np.uint8)) for n in range(1, 80) for _ in range(300)}
    words |= {b"a" * n for n in range(1, 200)} | {t.encode() for n in (8, 32, 64, 4096) for t in thue_morse(n)}
    words = sorted(words)
    offsets = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    found = shingles.word_hash(np.frombuffer(b"".join(words), np.uint8), offsets[:-1], offsets[1:])
    assert len(np.unique(found)) == len(words)
    alone = [shingles.word_hash(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0] for w in words[::50]]
    assert found[::50].tolist() == [int(a) for a in alone]


LONG = " ".join(prose(k, 997) + (" You STUPID idiot! " if k % 3 else "\n\nWHY?? st0pid ") for k in range(9))


@pytest.mark.parametrize("chunk", [50, 333, 5000])
def test_long_texts_have_the_features_of_the_whole(monkeypatch, chunk):
    texts = [LONG, "short one", "", " ", LONG[:7000] + "x" * 9000 + " end", "blankfree" * 900]
    column = pa.array([t.encode() for t in texts])
    hashes, weights = toxicity._word_hashes(["idiot", "stupid", "w17", "w300"]), np.array([6.0, 4.0, 3.0, 7.0])
    order = np.argsort(hashes)
    lexicon = toxicity.Lexicon(hashes[order], weights[order])
    whole = [toxicity.text_features(column, lexicon), *(_passages(t) for t in texts)]
    for module in (toxicity, passages):
        monkeypatch.setattr(module, "slices", lambda offsets: iter((i, i + 1) for i in range(len(offsets) - 1)))
    monkeypatch.setattr(shingles, "CHUNK", chunk)
    cut = [toxicity.text_features(column, lexicon), *(_passages(t) for t in texts)]
    assert np.allclose(whole[0], cut[0]) and whole[0][0, 3] > 0
    for a, b in zip(whole[1:], cut[1:], strict=True):
        assert np.allclose(a, b)


def _passages(text: str) -> np.ndarray:
    flat = np.frombuffer(text.encode(), np.uint8)
    return np.concatenate([f for _, f, _ in passages.passage_features(flat, np.array([0, len(flat)]))])


def test_toxicity_features_equal_plain_counts():
    lexicon_words = {"idiot": 6.0, "stupid": 4.0, "w17": 3.0}
    order = np.argsort(toxicity._word_hashes(list(lexicon_words)))
    lexicon = toxicity.Lexicon(toxicity._word_hashes(list(lexicon_words))[order], np.array(list(lexicon_words.values()))[order])
    got = toxicity.text_features(pa.array([LONG.encode()]), lexicon)[0]
    words = [m.lower() for m in re.findall(r"[A-Za-z]+", LONG)]
    hits = [w in lexicon_words for w in words]
    assert got[0] == pytest.approx(math.log1p(len(words)))
    assert got[1] == pytest.approx(sum(lexicon_words.get(w, 0) >= 5 for w in words) / len(words))
    assert got[4] == pytest.approx(math.log1p(len({w for w in words if w in lexicon_words})))
    assert got[5] == max(sum(hits[i:i + 50]) for i in range(len(hits)))
    you = [w in toxicity.SECOND_PERSON for w in words]
    assert got[7] == pytest.approx(sum(h and any(you[max(0, i - 5):i + 6]) for i, h in enumerate(hits)) / len(words))
    assert got[10] == pytest.approx(LONG.count("!") / len(LONG)) and got[8] == pytest.approx(sum(c.isupper() for c in LONG) / len(LONG))


def test_attention_and_its_gradients_equal_plain_sums():
    rng = np.random.default_rng(2)
    x, bag, y = rng.standard_normal((9, 4)), np.array([0, 0, 0, 1, 2, 2, 2, 2, 3]), np.array([1.0, 0, 1, 0])
    model = quality.train(x, bag, y, width=3, gates=2, steps=3)
    z = (x - model.mean) / model.scale
    w = {k: np.array(v) for k, v in model.weights.items()}

    def scores():
        out = []
        for b in range(4):
            h = [np.tanh(r @ w["encode"] + w["encode_b"]) for r in z[bag == b]]
            e = [math.exp(float((np.tanh(r @ w["tanh"] + w["tanh_b"]) / (1 + np.exp(-(r @ w["gate"] + w["gate_b"])))) @ w["attend"])) for r in h]
            mean = sum(a * r for a, r in zip(e, h)) / sum(e)
            out.append(1 / (1 + math.exp(-float(mean @ w["out"] + w["out_b"]))))
        return np.array(out)

    assert np.allclose(model.score(x, bag, 4), scores())

    def loss():
        p = scores()
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    found = quality._gradients(model, z, bag, y, model.forward(z, bag, 4))
    for name, g in found.items():
        for at in np.ndindex(np.shape(w[name])):
            keep = w[name][at]
            w[name][at] = keep + 1e-6
            up = loss()
            w[name][at] = keep - 1e-6
            slope = (up - loss()) / 2e-6
            w[name][at] = keep
            assert np.asarray(g)[at] == pytest.approx(slope, abs=1e-6)


def test_decontamination_judges_rows_not_ids(spark):
    item = prose(9, 30)
    rows = [(1, f"{prose(1, 40)} {item}"), (1, prose(2, 40)), (None, f"{item} {prose(3, 40)}"), (None, prose(4, 40)), (2, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_leak", F.lit(1))
    items = spark.createDataFrame([(7, item), (8, prose(10, 30)), (None, None)], "item_id long, text string")
    for block in (1, 1 << 20):
        out = decontaminate(docs, items, block_bytes=block)
        assert out.columns == docs.columns
        assert sorted((r.text or "") for r in out.collect()) == sorted((t or "") for _, t in [rows[1], *rows[3:]])


CLASHES = ["s", "b", "first", "order", "_record", "_place", "_bucket", "place", "row", "bucket", "record", "_draw", "_rate",
           "_small_key", "_u", "_key", "_leak", "_gone", "gone", "_again", "again", "shard", "slot", "_row", "key", "count", "n",
           "_copies", "_size", "_shard", "a.b"]


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, prose(i % 30, 40) if i % 7 else None, f"s{i % 3}", *range(i, i + len(CLASHES))) for i in range(60)]
    rows += [(3, "", None, *range(len(CLASHES))), (None, "x y", "s0", *range(len(CLASHES)))]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{c}` int" for c in CLASHES))


def test_clashing_names_are_kept(spark, clashing):
    rows = sorted(map(str, (tuple(r) for r in clashing.collect())))
    for stage in (corpus_pipeline.deduplicate, corpus_pipeline.leaks, corpus_pipeline.mix):
        out = stage(spark, clashing, "/root/testdata/sf0.001")
        assert out.columns == clashing.columns
        assert {str(tuple(r)) for r in out.collect()} <= set(rows)
    out = corpus_pipeline.shard(spark, clashing, "")
    assert out.columns == [*clashing.columns, "shard_", "slot_"]
    assert sorted(str(tuple(r)[:-2]) for r in out.collect()) == rows
    shuffled = shuffle_shards(clashing)
    assert shuffled.columns == [*(c for c in clashing.columns if c != "_shard"), "_shard", "_slot", "_grown_shard"]
    assert shuffled.count() == len(rows)
    mixed = mix_sources(clashing)
    assert mixed.columns == [*(c for c in clashing.columns if c not in ("_copies", "_size")),
                             "_size", "_source_size", "_target", "_copies", "_taken"]
    assert mixed.count() == len(rows)


def test_the_order_in_shards_is_that_of_the_records_alone(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("some text").alias("text"))

    def order():
        return sorted((r.x, r.y, r.doc_id) for r in deal(docs, ("x", "y", "z"), bucket_bytes=2048).collect())

    want, kept = order(), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert order() == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)


def test_files_of_a_shard_read_in_turn_give_slot_order(spark, tmp_path):
    import pyarrow.parquet as pq

    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 40).alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_shards(shuffle_shards(docs, bucket_bytes=4096), str(tmp_path / "out"))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    seen = 0
    for folder in sorted((tmp_path / "out").glob("_shard=*")):
        files = sorted(folder.glob("*.parquet"))
        slots = [s for f in files for s in pq.ParquetFile(f).read(["_slot"]).column(0).to_pylist()]
        assert slots == list(range(len(slots)))
        seen += len(slots)
    assert seen == 4000
    assert in_slot_order(shuffle_shards(docs.limit(0))).count() == 0
