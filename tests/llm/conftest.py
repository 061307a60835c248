from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed: int, n: int) -> str:
    """Invented words that do not repeat by chance."""
    import random

    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + r.choice(WORDS) + str(r.randrange(97)) for _ in range(n))


LONG = prose(99, 9000)
#: Nulls, empty and very long texts, ties, repeated rows; the last columns clash with names used inside.
NASTY = [
    (5, None, "x"),
    (6, "", None),
    (None, "null id", "x"),
    (7, "same text of some words here to share", "x"),
    (8, "same text of some words here to share", "x"),
    (8, "same text of some words here to share", "x"),
    (9, " \n\t ", "x"),
    (10, "\u0000   İstanbul ﬁ é 👍🏽 <|endoftext|> end", "x"),
    (11, LONG, "x"),
    (12, LONG[:40_000] + " changed " + LONG[40_000:], "x"),
    (13, "!!! ... ???", "x"),
    (13, "another text of a known id", "x"),
    (-4, prose(1, 30), "x"),
]
CLASHES = ["length", "offset", "fill", "open", "root", "digest", "doc", "shard", "slot", "_row", "_id", "_hash", "data", "runs", "first", "print", "size"]


@pytest.fixture(scope="session")
def nasty(spark):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame(NASTY, "doc_id long, text string, source string")
    return rows.withColumns({c: F.lit(i) for i, c in enumerate(CLASHES)})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
