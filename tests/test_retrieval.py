"""Ranking against brute force in numpy, on both ways the questions can travel."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import embedding as E
from ledgerlake.operators import retrieval as R

DIM = 12


def brute_force(questions, chunks, k):
    found = {}
    for qid, q in questions:
        q = np.asarray(q, float)
        scored = []
        for cid, c in chunks:
            c = np.asarray(c, np.float32).astype(float)
            size = np.sqrt((q * q).sum()) * np.sqrt((c * c).sum())
            scored.append((-round(float((q * c).sum() / size) if size else 0.0, 12), cid))
        found[qid] = [(cid, -s) for s, cid in sorted(scored)[:k]]
    return found


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(3)
    chunks = [(f"c{i:04d}", rng.normal(size=DIM).astype(np.float32).tolist()) for i in range(600)]
    # A third of the rows are copies of one chunk, some share a vector under other ids, some are zero.
    chunks += [chunks[0]] * 300
    chunks += [(f"t{i:02d}", chunks[5][1]) for i in range(20)]
    chunks += [(f"z{i}", [0.0] * DIM) for i in range(5)]
    questions = [(i, rng.normal(size=DIM).tolist()) for i in range(40)]
    questions += [(100, [float(x) for x in chunks[0][1]]), (101, [float(x) for x in chunks[5][1]]), (102, [0.0] * DIM)]
    return questions, chunks


def frames(spark, data):
    questions = spark.createDataFrame(data[0], "question_id INT, embedding ARRAY<DOUBLE>")
    chunks = spark.createDataFrame(data[1], "chunk_id STRING, embedding ARRAY<FLOAT>")
    return questions, chunks.withColumn("text", F.concat(F.lit("text of "), "chunk_id")).repartition(6)


@pytest.mark.parametrize("k", [1, 3, 25])
@pytest.mark.parametrize("grid", [False, True])
def test_retrieve(spark, data, monkeypatch, k, grid):
    monkeypatch.setattr(R, "SCORES_AT_ONCE", 700)
    questions, chunks = frames(spark, data)
    if grid:
        found = R.retrieve_grid(questions, chunks, k, ["text"], cell_bytes=2000)
    else:
        found = R.retrieve(questions, chunks, k, ["text"])
    rows = sorted(found.collect(), key=lambda r: (r["question_id"], r["rank"]))
    wanted = brute_force(*data, k)
    for qid, best in wanted.items():
        mine = [r for r in rows if r["question_id"] == qid]
        assert [r["rank"] for r in mine] == list(range(1, len(best) + 1))
        assert [r["chunk_id"] for r in mine] == [cid for cid, _ in best]
        assert [r["score"] for r in mine] == pytest.approx([s for _, s in best], abs=1e-11)
        assert all(r["text"] == f"text of {r['chunk_id']}" for r in mine)


@pytest.mark.parametrize("grid", [False, True])
def test_nan_never_ranks(spark, grid):
    nan, schema = float("nan"), "chunk_id STRING, embedding ARRAY<FLOAT>"
    rows = [("a", [1.0, 0.0]), ("b", [nan, 1.0]), ("c", [0.0, 1.0]), ("d", [nan, nan]), ("e", [1.0, 1.0])]
    chunks = spark.createDataFrame(rows, schema).coalesce(1)
    questions = spark.createDataFrame([(1, [1.0, 0.0])], "question_id INT, embedding ARRAY<DOUBLE>")
    find = R.retrieve_grid if grid else R.retrieve
    for k, wanted in ((2, ["a", "e"]), (5, ["a", "e", "c"])):
        assert [r["chunk_id"] for r in find(questions, chunks, k).orderBy("rank").collect()] == wanted
        assert [r["chunk_id"] for r in R.nearest(chunks, [1.0, 0.0], k).collect()] == wanted


@pytest.mark.parametrize("grid", [False, True])
def test_very_many_equal_chunks_and_questions(spark, grid):
    """Long texts and 20,000 ties for each of 2,400 questions: only ids and vectors are at work."""
    chunks = spark.range(20_000).select(
        F.format_string("c%06d", "id").alias("chunk_id"),
        F.expr("array(1.0f, cast(id % 2 as float), 0.0f)").alias("embedding"),
        F.repeat(F.lit("long "), 400).alias("text"),
    )
    questions = spark.range(2400).select(
        F.col("id").alias("question_id"), F.expr("array(1.0d, 1.0d, id + 1.0d)").alias("embedding")
    )
    rows = (R.retrieve_grid if grid else R.retrieve)(questions, chunks, 3, ["text"]).collect()
    assert len(rows) == 7200
    assert {(r["rank"], r["chunk_id"], len(r["text"])) for r in rows} == {
        (1, "c000001", 2000), (2, "c000003", 2000), (3, "c000005", 2000)
    }


def test_too_many_questions_are_refused(spark, data, monkeypatch):
    monkeypatch.setattr(R, "MAX_QUESTIONS", 10)
    with pytest.raises(ValueError, match="retrieve_grid"):
        R.retrieve(*frames(spark, data), 3)


def test_copies_with_other_columns_keep_them_all(spark):
    rows = [("a", [1.0], t) for t in "xyz"] + [("a", [-1.0], "far"), ("b", [1.0], "w")]
    chunks = spark.createDataFrame(rows, "chunk_id STRING, embedding ARRAY<FLOAT>, text STRING")
    questions = spark.createDataFrame([(1, [2.0])], "question_id INT, embedding ARRAY<DOUBLE>")
    for find in (R.retrieve, R.retrieve_grid):
        found = find(questions, chunks, 5, ["text"]).orderBy("rank").collect()
        assert [(r["chunk_id"], r["text"]) for r in found] == [
            ("a", "x"), ("a", "y"), ("a", "z"), ("b", "w"), ("a", "far")
        ]


def test_fewer_chunks_than_k(spark, data):
    questions, chunks = frames(spark, (data[0], data[1][:2]))
    assert R.retrieve(questions, chunks, 5).count() == 2 * len(data[0])
    assert R.retrieve(questions, chunks.limit(0), 5).count() == 0
    assert R.retrieve(questions.limit(0), chunks, 5).count() == 0


def test_vectors_must_fit(spark, data):
    questions, chunks = frames(spark, data)
    short = spark.createDataFrame([("s", [1.0, 2.0], "x")], chunks.schema)
    missing = spark.createDataFrame([("s", None, "x")], "chunk_id STRING, embedding ARRAY<FLOAT>, text STRING")
    for bad in (short, missing):
        with pytest.raises(Exception, match="a vector is null or does not have 12 values"):
            R.retrieve(questions, chunks.unionByName(bad), 3).collect()


def test_nearest(spark, data):
    _, chunks = frames(spark, data)
    with pytest.raises(Exception, match="not as long as the question"):
        R.nearest(chunks, [1.0, 2.0], 4).collect()
    for qid in (7, 101, 102):
        vector = dict(data[0])[qid]
        rows = R.nearest(chunks, vector, 4).collect()
        wanted = brute_force([(qid, vector)], data[1], 4)[qid]
        assert [r["chunk_id"] for r in rows] == [cid for cid, _ in wanted]


def ranked(spark):
    rows = [(1, 2, "c2", 0.5, "b.md", "Dos", "texto dos"), (1, 1, "c1", 0.91234, "a.md", "Uno", "texto uno")]
    return spark.createDataFrame(
        rows, "question_id INT, rank INT, chunk_id STRING, score DOUBLE, source_path STRING, section_title STRING, chunk_text STRING"
    )


def test_prompts(spark):
    questions = spark.createDataFrame([(1, "¿Qué?"), (2, "¿Nada?")], "question_id INT, question STRING")
    got = dict(R.build_prompts(ranked(spark), questions, instruction="Leé.").collect())
    assert got[1] == (
        "Leé.\n\nContexto recuperado:\nFuente: a.md :: Uno\ntexto uno\n\nFuente: b.md :: Dos\ntexto dos\n\n"
        "Pregunta:\n¿Qué?\n\nRespuesta:"
    )
    assert got[2] == "Leé.\n\nContexto recuperado:\n\n\nPregunta:\n¿Nada?\n\nRespuesta:"
    plain = dict(R.build_plain_prompts(questions, instruction="Respondé.").collect())
    assert plain[1] == "Respondé.\n\nPregunta:\n¿Qué?\n\nRespuesta:"
    lines = [r[2] for r in R.format_sources(ranked(spark)).orderBy("rank").collect()]
    assert lines == ["1. a.md :: Uno (score=0.912)", "2. b.md :: Dos (score=0.500)"]


def test_evaluation(spark):
    expected = spark.createDataFrame([(1, "b.md"), (1, "z.md"), (3, "a.md")], "question_id INT, source STRING")
    got = R.evaluate_retrieval(ranked(spark).withColumnRenamed("source_path", "source"), expected)
    assert sorted(map(tuple, got.collect())) == [(1, 1, 0.5), (3, 0, 0.0)]


def test_compare_index_versions(spark, data):
    questions, chunks = frames(spark, data)
    same = R.compare_retrieval(chunks, chunks, questions).collect()
    assert {r["overlap"] for r in same} == {3}
    other = chunks.withColumn("chunk_id", F.concat(F.lit("x"), "chunk_id"))
    rows = R.compare_retrieval(chunks, other, questions).collect()
    assert {r["overlap"] for r in rows} == {0}
    assert all(r["mean_score_a"] == pytest.approx(r["mean_score_b"]) for r in rows)


def test_embed_column(spark):
    def load():
        def embed(texts):
            assert all(isinstance(t, str) for t in texts)
            return [[float(len(t)), 1.0] for t in texts]

        return embed

    frame = spark.createDataFrame([(1, "abc"), (2, None), (3, "")], "id INT, t STRING")
    assert dict(E.embed_column(frame, "t", load).select("id", "embedding").collect()) == {
        1: [3.0, 1.0], 2: None, 3: [0.0, 1.0]
    }
