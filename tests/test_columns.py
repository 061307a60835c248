from __future__ import annotations

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import columns as C
from ledgerlake.functions import vectors as V


def one(spark, column, **values):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return frame.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("value", "masked"),
    [("keyholder", "key***"), ("ab", "ab***"), ("", "<empty>"), (None, "<empty>"), ("ñandú", "ñan***")],
)
def test_mask(spark, value, masked):
    frame = spark.createDataFrame([(value,)], "v string")
    assert frame.select(C.mask("v")).first()[0] == masked


def test_stable_id_is_sha256_of_joined_fields(spark):
    row = spark.createDataFrame([("a/b.md", "Título", 0, None)], "p string, t string, i int, x string")
    got = row.select(C.stable_id("p", "t", "i", "x")).first()[0]
    assert got == hashlib.sha256("a/b.md|Título|0|".encode()).hexdigest()


@pytest.mark.parametrize(
    ("text", "sql"),
    [
        ("```sql\nSELECT 1\n```", "SELECT 1"),
        ("```\nSELECT 1```", "SELECT 1"),
        ("SELECT 1", "SELECT 1"),
        ("  ```sql SELECT 1 ```  ", "SELECT 1"),
        ("```sql```SELECT 1", "SELECT 1"),
        ("SELECT '```'", "SELECT '```'"),
        ("SELECT '``` ```sql'", "SELECT '``` ```sql'"),
        ("``` ```", ""),
        ("", ""),
        (" ```sql\nSELECT 1\n```\n\x1f", "SELECT 1"),
        ("```SQL\nSELECT 1\n```", "SQL\nSELECT 1"),
    ],
)
def test_strip_code_fence(spark, text, sql):
    assert one(spark, C.strip_code_fence("v"), v=text) == sql


@pytest.mark.parametrize("text", ["", " a ", "\x1f　a b\x85 ", "a", "\t\n", "a ", "x y"])
def test_strip_knows_unicode_blanks(spark, text):
    assert one(spark, C.strip("v"), v=text) == text.strip()


def test_case_and_initial(spark):
    frame = spark.createDataFrame([("straße",), ("ángel",), (None,)], "name string")
    frame = C.with_initial(C.with_lower(C.with_upper(frame, "name", "up"), "up", "low"), "name")
    got = [tuple(r) for r in frame.select("up", "low", "name_initial").collect()]
    assert got == [("STRASSE", "strasse", "S"), ("ÁNGEL", "ángel", "Á"), (None, None, None)]


def test_ingestion_ts_is_one_value(spark):
    frame = C.with_ingestion_ts(spark.range(1000).repartition(8))
    assert frame.select("ingestion_ts").distinct().count() == 1
    assert str(C.with_ingestion_ts(spark.range(1), "2024-05-01 10:00:00").first()[1]) == "2024-05-01 10:00:00"


def test_source_line(spark):
    column = C.source_line(F.lit(2), F.lit("a.md"), F.lit("Uso"), F.lit(0.12349))
    assert one(spark, column, v=1) == "2. a.md :: Uso (score=0.123)"


def test_cosine(spark):
    rows = [([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 1.0]), ([1.0], [1.0, 1.0]), (None, [1.0, 2.0])]
    got = spark.createDataFrame(rows, "a array<double>, b array<double>").select(V.cosine("a", "b")).collect()
    assert got[0][0] == pytest.approx(math.sqrt(0.5))
    assert [r[0] for r in got[1:]] == [0.0, None, None]


def model_vector(text: str, dim: int) -> list[float]:
    counts = [0] * dim
    for token in filter(None, re.split(r"[ \t\n\x0b\f\r]+", text.lower())):
        counts[int(hashlib.md5(token.encode()).hexdigest()[:4], 16) % dim] += 1
    size = math.sqrt(sum(n * n for n in counts)) or 1.0
    return [n / size for n in counts]


def test_hash_vector_matches_a_plain_count(spark):
    rng = random.Random(1)
    words = [f"w{i}é" for i in range(90)] + ["Straße", "x"]
    texts = ["", " ", "\n a \t"] + [
        " \n".join(rng.choices(words, k=rng.randint(1, 400))) for _ in range(60)
    ]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for dim in (1, 7, 64):
        for text, vector in frame.select("t", V.hash_vector("t", dim)).collect():
            assert vector == pytest.approx(model_vector(text, dim), abs=1e-6)
    assert spark.createDataFrame([(None,)], "t string").select(V.hash_vector("t")).first()[0] is None
