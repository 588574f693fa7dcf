"""Each stage of the pipeline on the smallest tables, against brute force over its own input."""

from __future__ import annotations

import corpus_pipeline
from claimlake.llm.common import stage
from claimlake.llm.quality import score_quality

from .test_duplicates import brute_duplicates, components, shingle_set
from .test_scores_and_mixes import targets, words

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    items = {r.item_id: shingle_set(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()}
    columns, outs = docs.columns, [docs]
    for name, step in corpus_pipeline.STAGES:
        outs.append(stage(step(spark, outs[-1], SF_DIR), f"test-{name}"))
    start, good, single, clean, mixed, shards = [o.collect() for o in outs]
    assert all(o.columns == columns for o in outs[:-1]) and outs[-1].columns == [*columns, "shard", "slot"]

    score = {r.doc_id: r.score for r in score_quality(docs, labels).collect()}
    assert sorted(good) == sorted(r for r in start if score[r.doc_id] >= 0.5) and len(good) < len(start)
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    assert len(bad & {r.doc_id for r in good}) <= 0.1 * len(bad)

    kept = {doc for doc, _, _, k in brute_duplicates([(r.doc_id, r.text) for r in good]) if k}
    assert sorted(single) == sorted(r for r in good if r.doc_id in kept) and len(single) < len(good)

    def leaks(text):
        held = shingle_set(text)
        return any(100 * len(s & held) >= 75 * len(s) for s in items.values() if s)

    assert sorted(clean) == sorted(r for r in single if not leaks(r.text)) and len(clean) < len(single)

    sizes, taken, largest = {}, {}, {}
    for r in clean:
        sizes[r.source] = sizes.get(r.source, 0) + words(r.text)
        largest[r.source] = max(largest.get(r.source, 0), words(r.text))
    for r in mixed:
        taken[r.source] = taken.get(r.source, 0) + words(r.text)
    for s, want in targets(sizes).items():
        assert abs(taken.get(s, 0) - want) <= largest[s]
    assert {tuple(r) for r in mixed} <= {tuple(r) for r in clean}

    assert sorted(tuple(r)[:-2] for r in shards) == sorted(map(tuple, mixed))
    for s in range(8):
        assert sorted(r.slot for r in shards if r.shard == s) == list(range(sum(r.shard == s for r in shards)))


def test_the_whole_run_survives_no_rows(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_one_row_of_each_group_stays_whatever_the_ids(spark, corpus):
    rows = [(r.doc_id, r.text, r.label) for r in corpus.collect()]
    more = [(None, rows[0][1], 1000), (None, "only without ids " * 20, 1001), (None, "only without ids " * 20, 1002)]
    extra = spark.createDataFrame(more, "doc_id long, text string, label int")
    docs = corpus.unionByName(extra, allowMissingColumns=True)
    rows += more
    sets = [shingle_set(text) for _, text, _ in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i)
             if (c := len(sets[i] & sets[j])) and 100 * c >= 75 * len(sets[i] | sets[j])]
    groups = {}
    for i, g in enumerate(components(len(rows), pairs)):
        groups.setdefault(g, []).append(rows[i])
    out = corpus_pipeline.deduplicate(spark, docs, SF_DIR)
    assert out.columns == docs.columns
    got = sorted(r.label for r in out.collect())
    assert len(got) == len(set(got)) == len(groups)
    for group in groups.values():
        kept = [r for r in group if r[2] in got]
        assert len(kept) == 1 and kept[0][0] == min((r[0] for r in group if r[0] is not None), default=None)
