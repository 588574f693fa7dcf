"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Labelled rows are split in three by a hash of their id: a lexicon of words and word beginnings
is learned from the first part, boosted trees over dense features of whole texts from the
second, and the calibration of their scores from the third. Features are densities of lexicon
words, their nearness to second-person pronouns, and rates of capitals, punctuation and
obfuscated spelling.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm import shingles as S
from claimlake.llm.common import held_out, slices, text_bytes
from claimlake.llm.quality import labelled_sample

# Second-person pronouns and possessives in four languages.
SECOND_PERSON = ["you", "your", "yours", "yourself", "u", "ur", "du", "dich", "dir", "dein", "deine", "ihr", "euch",
                 "tu", "te", "toi", "ton", "ta", "tes", "vous", "votre", "vos", "usted", "ustedes", "ti", "tú", "vosotros"]
#: Bytes of a word beginning, words on either side that are near, words of a window.
STEM, NEAR, WINDOW = 5, 5, 50
#: Spellings that stand for a letter.
_LOOKS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"}

NAMES = ["words", "strong", "medium", "hits", "distinct", "peak", "person", "near", "upper", "shout", "bang",
         "question", "other", "odd", "odd_hits", "stem_hits", "weight"]

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_PLAIN = _LOWER.copy()
for _k, _v in _LOOKS.items():
    _PLAIN[ord(_k)] = ord(_v)
_STANDS = np.zeros(256, bool)
_STANDS[[ord(k) for k in _LOOKS if k != "!"]] = True


def _runs(mask: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of a mask, broken where rows begin."""
    before = np.append(False, mask)
    before[offsets] = False
    after = np.append(mask, False)
    after[offsets] = False
    return np.flatnonzero(mask & ~before[:-1]), np.flatnonzero(mask & ~after[1:]) + 1


def _word_hashes(words: list[str]) -> np.ndarray:
    data = [w.encode() for w in words]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    return S.word_hash(np.frombuffer(b"".join(data), np.uint8), offsets[:-1], offsets[1:])


class _Terms:
    """Letter words of some rows: row, hash, and hash of the beginning (0: the word is short)."""

    def __init__(self, flat: np.ndarray, offsets: np.ndarray):
        lower = _LOWER[flat]
        self.starts, self.ends = _runs(_LETTER[flat], offsets)
        self.word = S.word_hash(lower, self.starts, self.ends)
        self.row = np.searchsorted(offsets, self.starts, "right") - 1
        long = self.ends - self.starts > STEM
        self.stem = np.zeros(len(self.starts), np.uint64)
        self.stem[long] = ~S.word_hash(lower, self.starts[long], self.starts[long] + STEM)


@dataclass(frozen=True)
class Lexicon:
    """Hashes of words and beginnings, ascending, and the log odds of each."""

    keys: np.ndarray
    weights: np.ndarray

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Weight of each hash, 0 if it is not listed."""
        if not len(self.keys):
            return np.zeros(len(hashes))
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.weights[at], 0.0)


def _along(row: np.ndarray, hit: np.ndarray, you: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row: hits with a second person near, and the most hits in a window of words."""
    run = np.concatenate([[0], np.cumsum(you)])
    begin, end = np.searchsorted(row, row, "left"), np.searchsorted(row, row, "right")
    at = np.arange(len(row))
    close = run[np.minimum(end, at + NEAR + 1)] > run[np.maximum(begin, at - NEAR)]
    hits = np.concatenate([[0], np.cumsum(hit)])
    peak = np.zeros(rows)
    np.maximum.at(peak, row, hits[np.minimum(end, at + WINDOW)] - hits[at])
    return np.bincount(row, hit & close, rows), peak


def _counts(flat: np.ndarray, offsets: np.ndarray, lexicon: Lexicon, person: np.ndarray,
            later: list | None = None) -> np.ndarray:
    """Sums over each row (and, last, a maximum), from which features follow.

    For a piece of one long row, what depends on other pieces is left at 0 and what it follows
    from goes to ``later``: hits and second persons in the order of the words, and words hit.
    """
    rows = len(offsets) - 1
    t = _Terms(flat, offsets)
    words, stems = lexicon.find(t.word), lexicon.find(t.stem)
    weight = np.maximum(words, stems)
    hit = weight > 0
    n = len(t.row)

    def total(x):
        return np.bincount(t.row, x, rows)

    you = np.isin(t.word, person)
    different = near = peak = np.zeros(rows)
    if later is None:
        near, peak = _along(t.row, hit, you, rows)
        order = np.lexsort((t.word, t.row))
        order = order[hit[order]]
        new = np.append(True, (np.diff(t.row[order]) != 0) | (np.diff(t.word[order]) != 0)) if len(order) else np.zeros(0, bool)
        different = np.bincount(t.row[order][new], minlength=rows)
    else:
        later.append((hit, you, np.unique(t.word[hit])))

    upper = (flat >= 65) & (flat <= 90)
    caps = np.concatenate([[0], np.cumsum(upper)])
    small = np.concatenate([[0], np.cumsum((flat >= 97) & (flat <= 122))])
    shout = (caps[t.ends] - caps[t.starts] > 2) & (small[t.ends] == small[t.starts])
    # letters with look-alikes among them
    stands = _STANDS[flat]
    mixed = _LETTER[flat] | stands | (flat == 33)
    s, e = _runs(mixed, offsets)
    letters = np.concatenate([[0], np.cumsum(_LETTER[flat])])
    looks = np.concatenate([[0], np.cumsum(stands)])
    keep = (looks[e] > looks[s]) & (letters[e] - letters[s] >= 2)
    s, e = s[keep], e[keep]
    odd_row = np.searchsorted(offsets, s, "right") - 1
    odd_hit = lexicon.find(S.word_hash(_PLAIN[flat], s, e)) > 0

    def bytes_of(mask):
        run = np.concatenate([[0], np.cumsum(mask)])
        return run[offsets[1:]] - run[offsets[:-1]]

    return np.stack([
        total(np.ones(n)), total(weight >= 5), total(hit & (weight < 5)), different, total(you), near,
        total(shout), np.bincount(odd_row, minlength=rows), np.bincount(odd_row, odd_hit, rows), total(stems > 0), total(weight),
        bytes_of(upper), bytes_of(flat == 33), bytes_of(flat == 63), bytes_of((flat > 32) & (flat < 48)),
        np.diff(offsets), peak], axis=1)


def _features(c: np.ndarray) -> np.ndarray:
    n, size = np.maximum(1, c[:, 0]), np.maximum(1, c[:, 15])
    hits = c[:, 1] + c[:, 2]
    return np.stack([
        np.log1p(c[:, 0]), c[:, 1] / n, c[:, 2] / n, np.log1p(hits), np.log1p(c[:, 3]), c[:, 16], c[:, 4] / n, c[:, 5] / n,
        c[:, 11] / size, c[:, 6] / n, c[:, 12] / size, c[:, 13] / size, c[:, 14] / size, c[:, 7] / n, c[:, 8] / n,
        c[:, 9] / n, c[:, 10] / n], axis=1)


def text_features(column: pa.Array, lexicon: Lexicon) -> np.ndarray:
    """Features of each text; one longer than some megabytes is read in pieces, with the features
    of the whole."""
    flat, offsets = text_bytes(column)
    person = np.sort(_word_hashes(SECOND_PERSON))
    out = [np.zeros((0, len(NAMES)))]
    for low, high in slices(offsets):
        part = flat[offsets[low]:offsets[high]]
        if high == low + 1 and len(part) > S.CHUNK:
            later: list = []
            c = sum(_counts(p, np.array([0, len(p)]), lexicon, person, later) for p in S.pieces(part))
            hit, you, hashes = (np.concatenate(x) for x in zip(*later, strict=True))
            c[0, 3] = len(np.unique(hashes))
            c[:, 5], c[:, 16] = _along(np.zeros(len(hit), np.int64), hit, you, 1)
        else:
            c = _counts(part, offsets[low:high + 1] - offsets[low], lexicon, person)
        out.append(_features(c))
    return np.concatenate(out)


def learn_lexicon(rows: DataFrame, most: int, least_docs: int = 3, odds: float = 2.5) -> Lexicon:
    """The ``most`` words and beginnings with the highest smoothed log odds between labels, over
    those in at least ``least_docs`` rows of label 1. ``rows``: (_bytes, _label)."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offsets = text_bytes(batch.column("_bytes"))
            label = batch.column("_label").to_numpy(zero_copy_only=False).astype(np.int64)
            for low, high in slices(offsets):
                t = _Terms(flat[offsets[low]:offsets[high]], offsets[low:high + 1] - offsets[low])
                pairs = np.concatenate([np.stack([t.word, t.row.astype(np.uint64)]),
                                        np.stack([t.stem, t.row.astype(np.uint64)])[:, t.stem > 0]], axis=1)
                pairs = np.unique(pairs, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs[0].view(np.int64)), pa.array(label[low + pairs[1].astype(np.int64)])], ["term", "label"])

    sizes = {r["_label"]: r["n"] for r in rows.groupBy("_label").agg(F.count("*").alias("n")).collect()}
    if set(sizes) != {0, 1}:
        return Lexicon(np.zeros(0, np.uint64), np.zeros(0))
    seen = rows.select("_bytes", "_label").mapInArrow(terms, "term long, label long").groupBy("term").agg(
        F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
    ratio = F.log((F.col("toxic") + 0.1) / sizes[1]) - F.log((F.col("clean") + 0.1) / sizes[0])
    best = seen.where(F.col("toxic") >= least_docs).withColumn("weight", ratio).where(F.col("weight") >= odds)
    found = best.orderBy(F.col("weight").desc(), "term").limit(most).collect()
    keys = np.array([r["term"] for r in found], np.int64).view(np.uint64)
    order = np.argsort(keys)
    return Lexicon(keys[order], np.array([r["weight"] for r in found])[order])


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    calibration: IsotonicRegressionModel | None
    constant: float


def fit_toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", sample: int = 9000,
                 lexicon_size: int = 4096, rounds: int = 15, depth: int = 3, id_col: str = "doc_id",
                 text_col: str = "text", seed: int = 5) -> ToxicityModel:
    """Train on at most ``sample`` labelled rows that are not held out: a half of them for the
    lexicon, a third for the trees, a sixth for the calibration."""
    spark = docs.sparkSession
    rows = labelled_sample(docs, labels, label_col, sample, id_col, text_col)
    fold = F.pmod(F.xxhash64(F.lit(seed), F.col("_id")), F.lit(6))
    lexicon = learn_lexicon(rows.where(fold < 3), lexicon_size)

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = text_features(batch.column("_bytes"), lexicon)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_label"), batch.column("_fold"),
                 pa.array(list(found), pa.list_(pa.float64()))], ["_id", "_label", "_fold", "x"])

    kind = rows.schema["_id"].dataType.simpleString()
    dense = rows.withColumn("_fold", fold).where("_fold >= 3").mapInArrow(
        cells, f"_id {kind}, _label int, _fold long, x array<double>").collect()
    dense.sort(key=lambda r: (r["_id"], r["x"]))
    if len({r["_label"] for r in dense}) < 2:
        share = [r["_label"] for r in dense]
        return ToxicityModel(lexicon, None, None, sum(share) / len(share) if share else 0.5)

    def frame(which) -> DataFrame:
        picked = [(float(r["_label"]), Vectors.dense(r["x"])) for r in dense if which(r["_fold"])]
        return spark.createDataFrame(picked, ["label", "features"]).coalesce(2)

    trees = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.3, seed=seed, minInstancesPerNode=2).fit(
        frame(lambda f: f < 5))
    rest = [f for f in (5,) if len({r["_label"] for r in dense if r["_fold"] == f}) == 2]
    margin = trees.transform(frame(lambda f: f in rest or not rest)).select(
        "label", vector_to_array("probability")[1].alias("p"))
    calibration = IsotonicRegression(featuresCol="p", labelCol="label").fit(margin)
    return ToxicityModel(lexicon, trees, calibration, 0.5)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = 0.7, sample: int = 9000) -> DataFrame:
    """One row per document: ``id_col``, held_out, score, predicted (score >= ``threshold``).

    Every text is scored whole, by a model of at most ``sample`` labelled rows that are not held
    out. Null, empty and blank texts have all counts 0 and are scored like others. Rows that
    repeat an id are scored one by one; a null id is not held out and has no label; labels other
    than 0 and 1 are ignored, and of several labels of an id the greatest counts. Without both
    labels in the training rows every score is the share of label 1, or 1/2 without rows. Other
    columns are ignored. No rows give no rows.
    """
    model = fit_toxicity(docs, labels, sample=sample, id_col=id_col, text_col=text_col)
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_bytes"))
    if model.trees is None:
        scored = rows.withColumn("score", F.lit(float(model.constant)))
    else:
        lexicon = model.lexicon

        @F.arrow_udf("array<double>")
        def features(column: pa.Array) -> pa.Array:
            return pa.array(list(text_features(column, lexicon)), pa.list_(pa.float64()))

        dense = rows.select("_id", array_to_vector(features("_bytes")).alias("features"))
        scored = model.trees.transform(dense).withColumn("p", vector_to_array("probability")[1])
        scored = model.calibration.transform(scored.select("_id", "p")).withColumn(
            "score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("prediction"))))
    return scored.select(F.col("_id").alias(id_col), held_out(F.col("_id")).alias("held_out"), "score").withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
