import random

import pytest
from pyspark.sql import functions as F

#: Columns that operators might use themselves.
CLASHES = ("id", "key", "text_", "bucket", "at", "lot", "shard", "copy", "size", "sid", "rule", "verdict", "host", "path", "conv", "part", "score", "judged", "n_words")


@pytest.fixture(scope="session")
def documents(spark):
    """Documents with the awkward cases and clashing columns from (doc_id, text[, source]) rows."""

    def build(*rows):
        data = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s1", len(r[1] or "")) for r in rows]
        frame = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
        return frame.withColumns({c: F.lit("x") for c in CLASHES})

    return build


@pytest.fixture(scope="session")
def awkward():
    """Null, empty, blank, repeated, tied and long texts."""
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    shared = " ".join(words[:30])
    return [(1, None), (2, ""), (3, " \t\n"), (4, shared), (5, shared), (5, shared), (None, shared), (None, None), (6, long), (7, "x" * 50_000), (8, shared + "\n" + shared), (9, "é 😀 " * 20), (10, "a\0b c")]
