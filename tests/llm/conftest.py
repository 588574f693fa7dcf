from __future__ import annotations

import random

import pytest

WORDS = [f"w{i}" for i in range(400)]


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edited(text: str, seed: int, share: float) -> str:
    rng = random.Random(seed)
    return " ".join("x" + w if rng.random() < share else w for w in text.split())


@pytest.fixture(scope="session")
def corpus(spark):
    """Copies, near copies of all degrees, short, blank, empty and null texts, null and repeated
    ids, one very long text, and columns whose names clash with the operators' own."""
    rows = [(i, prose(i, 30 + i), f"s{i % 4}") for i in range(60)]
    rows += [(100 + i, prose(3, 33), "s0") for i in range(12)]
    rows += [(200 + i, edited(prose(500, 200), i, 0.004 * i), "s1") for i in range(30)]
    rows += [(300, None, "s2"), (301, "", None), (302, " \t\n", "s2"), (303, "one Two", "s2"), (304, "ONE two", None)]
    rows += [(305, prose(7, 37), "s3"), (305, prose(7, 37), "s3"), (305, prose(900, 50), "s3")]
    rows += [(None, prose(8, 38), None), (None, prose(901, 60), None), (None, None, None)]
    rows += [(400, prose(902, 30_000), "s1"), (401, "ähnlich " * 300, "s2"), (402, prose(902, 30_000) + " end", "s9")]
    columns = ["node", "component", "_id", "_bytes", "rid", "size", "score", "n_shingles", "_shard", "label"]
    data = [(*r, *([k] * len(columns))) for k, r in enumerate(rows)]
    schema = "doc_id long, text string, source string, " + ", ".join(f"`{c}` int" for c in columns)
    return spark.createDataFrame(data, schema).repartition(5)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(i, int(i % 5 > 0), int(i % 7 == 0)) for i in range(60)] + [(None, 1, 1), (3, None, 5)],
        "doc_id long, quality int, toxic int")
