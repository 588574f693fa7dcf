"""Quality classifier: attention-based multiple-instance learning over passages.

A document is a bag of passages of a hundred words, each a vector of dense features. Every
passage is encoded, gated attention weights are learned from the labels of documents alone, and
the document is scored by the weighted sum of its encoded passages.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import held_out, text_bytes
from claimlake.llm.passages import NAMES, passage_features


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass(frozen=True)
class AttentionModel:
    """Scale of the features, weights of the encoder, the two attention gates and the output."""

    mean: np.ndarray
    scale: np.ndarray
    weights: dict[str, np.ndarray]

    def forward(self, x: np.ndarray, bag: np.ndarray, bags: int) -> dict[str, np.ndarray]:
        """``bag`` (ascending, none empty) is the document of each passage."""
        w = self.weights
        h = np.tanh(x @ w["encode"] + w["encode_b"])
        v, u = np.tanh(h @ w["tanh"] + w["tanh_b"]), _sigmoid(h @ w["gate"] + w["gate_b"])
        e = (v * u) @ w["attend"]
        begins = np.searchsorted(bag, np.arange(bags))
        e = np.exp(e - np.maximum.reduceat(e, begins)[bag])
        a = e / np.add.reduceat(e, begins)[bag]
        z = np.add.reduceat(a[:, None] * h, begins)
        return {"h": h, "v": v, "u": u, "a": a, "z": z, "begins": begins,
                "p": _sigmoid(z @ w["out"] + w["out_b"])}

    def score(self, features: np.ndarray, bag: np.ndarray, bags: int) -> np.ndarray:
        return self.forward((features - self.mean) / self.scale, bag, bags)["p"]


def _gradients(model: AttentionModel, x, bag, y, f) -> dict[str, np.ndarray]:
    w, n = model.weights, len(y)
    dlogit = (f["p"] - y) / n
    dz = dlogit[:, None] * w["out"]
    dzp = dz[bag]
    inner = (dzp * f["h"]).sum(1)
    de = f["a"] * (inner - np.add.reduceat(f["a"] * inner, f["begins"])[bag])
    vu = f["v"] * f["u"]
    dv = de[:, None] * w["attend"] * f["u"] * (1 - f["v"] ** 2)
    du = de[:, None] * w["attend"] * f["v"] * f["u"] * (1 - f["u"])
    dh = (f["a"][:, None] * dzp + dv @ w["tanh"].T + du @ w["gate"].T) * (1 - f["h"] ** 2)
    return {"encode": x.T @ dh, "encode_b": dh.sum(0), "tanh": f["h"].T @ dv, "tanh_b": dv.sum(0),
            "gate": f["h"].T @ du, "gate_b": du.sum(0), "attend": vu.T @ de,
            "out": f["z"].T @ dlogit, "out_b": np.array(dlogit.sum())}


def train(features: np.ndarray, bag: np.ndarray, y: np.ndarray, width: int = 16, gates: int = 8,
          steps: int = 200, rate: float = 0.03, decay: float = 1e-4, seed: int = 3) -> AttentionModel:
    """Fit by Adam on all bags at once. Without both labels every score is their share (or 1/2)."""
    rng, d = np.random.default_rng(seed), features.shape[1]
    w = {"encode": rng.normal(0, d**-0.5, (d, width)), "encode_b": np.zeros(width),
         "tanh": rng.normal(0, width**-0.5, (width, gates)), "tanh_b": np.zeros(gates),
         "gate": rng.normal(0, width**-0.5, (width, gates)), "gate_b": np.zeros(gates),
         "attend": rng.normal(0, 0.1, gates), "out": rng.normal(0, 0.1, width), "out_b": np.zeros(())}
    if len(np.unique(y)) < 2:
        w["out"] *= 0
        w["out_b"] = np.array(40.0 * (2 * y.mean() - 1) if len(y) else 0.0)
        return AttentionModel(np.zeros(d), np.ones(d), w)
    mean, scale = features.mean(0), features.std(0)
    scale = np.where(scale > 1e-9, scale, 1)
    model = AttentionModel(mean, scale, w)
    x = (features - mean) / scale
    m, v = ({k: np.zeros_like(p) for k, p in w.items()} for _ in range(2))
    for t in range(1, steps + 1):
        f = model.forward(x, bag, len(y))
        for k, g in _gradients(model, x, bag, y, f).items():
            g = g + decay * w[k]
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            w[k] = w[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return model


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, most: int, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """Texts of at most ``most`` labelled documents that are not held out: (_id, _bytes, _label).

    The labels are chosen by a hash of their id before any text is read, so that what is
    broadcast has at most ``most`` rows.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_label"))
    known = known.where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out(F.col("_id")))
    known = known.groupBy("_id").agg(F.max("_label").alias("_label"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(most)
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("binary").alias("_bytes")).join(
        F.broadcast(known), "_id")


def fit_quality(docs: DataFrame, labels: DataFrame, label_col: str = "quality", sample: int = 2000,
                id_col: str = "doc_id", text_col: str = "text", most_passages: int = 2000) -> AttentionModel:
    """Train on the passages of at most ``sample`` labelled documents, gathered as dense features.

    Of a training text with more than ``most_passages`` passages so many, evenly spaced, are
    gathered; this bounds what reaches the driver. Texts are scored by all their passages.
    """

    def run(batches):
        for batch in batches:
            flat, offsets = text_bytes(batch.column("_bytes"))
            cells = [[] for _ in range(batch.num_rows)]
            for low, found, row in passage_features(flat, offsets):
                for i in np.unique(row):
                    own = found[row == i]
                    own = own[np.linspace(0, len(own) - 1, min(len(own), most_passages)).astype(int)]
                    cells[low + i].append(own.astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_label"), pa.array([b"".join(c) for c in cells], pa.binary())],
                ["_id", "_label", "_cells"])

    chosen = labelled_sample(docs, labels, label_col, sample, id_col, text_col)
    kind = chosen.schema["_id"].dataType.simpleString()
    rows = chosen.mapInArrow(run, f"_id {kind}, _label int, _cells binary").collect()
    rows.sort(key=lambda r: (r["_id"], r["_label"], bytes(r["_cells"])))
    cells = [np.frombuffer(r["_cells"], np.float32).reshape(-1, len(NAMES)) for r in rows]
    y = np.array([r["_label"] for r in rows], float)
    bag = np.repeat(np.arange(len(cells)), [len(c) for c in cells])
    features = np.concatenate(cells).astype(float) if cells else np.zeros((0, len(NAMES)))
    return train(features, bag, y)


def quality_score(model: AttentionModel, text: Column) -> Column:
    """Score in [0, 1] of a whole text; a null text counts as empty."""

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        flat, offsets = text_bytes(column)
        out = np.zeros(len(column))
        for low, found, row in passage_features(flat, offsets):
            n = int(row[-1]) + 1
            out[low:low + n] = model.score(found, row, n)
        return pa.array(out)

    return score(text.cast("binary"))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = 0.5, sample: int = 2000) -> DataFrame:
    """One row per document: ``id_col``, held_out, score, predicted (score >= ``threshold``).

    Trained on at most ``sample`` labelled rows that are not held out; every text is scored
    whole. Null, empty and blank texts are scored as one empty passage. Rows that repeat an id
    are scored one by one. A null id is not held out and has no label; labels other than 0 and
    1 are ignored, and of several labels of an id the greatest counts. Without labels every
    score is 1/2; with one class, 0 or 1. Other columns are ignored.
    """
    model = fit_quality(docs, labels, sample=sample, id_col=id_col, text_col=text_col)
    return docs.select(
        F.col(id_col), held_out(F.col(id_col)).alias("held_out"),
        quality_score(model, F.col(text_col)).alias("score"),
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
