"""The neighbour index against retrieval over all vectors."""

from __future__ import annotations

import random
import uuid

import numpy as np
import pytest
from people import plan_of
from pyspark.sql import functions as F

from ledgerlake.operators import neighbours as N
from ledgerlake.operators import retrieval as R

SF = "/root/testdata/sf0.01"


def folder(spark):
    return f"{spark.conf.get('spark.checkpoint.dir')}/{uuid.uuid4().hex}"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, vectors, name="chunk_id"):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in vectors], f"{name} long, embedding array<double>")


def clustered(seed, n, width=8, centres=12):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, width)) * 4
    return [(i, middle[rng.integers(centres)] + rng.normal(size=width) * 0.2) for i in range(n)]


def test_same_rows_as_over_all_vectors(spark):
    chunks = frame(spark, clustered(1, 3000)).withColumn("label", F.col("chunk_id") % 7)
    questions = frame(spark, clustered(2, 25), "question_id")
    index = N.build_neighbour_index(chunks, folder(spark))
    for k in (1, 40):
        assert rows(N.retrieve_index(questions, index, k, ["label"])) == rows(R.retrieve(questions, chunks, k, ["label"]))


def test_most_lists_are_skipped_and_their_folders_not_scanned(spark):
    chunks, questions = frame(spark, clustered(3, 4000, 16, 40)), frame(spark, clustered(3, 4000, 16, 40)[:1], "question_id")
    index = N.build_neighbour_index(chunks, folder(spark))
    visit = N.visits(questions, index)
    assert visit.vectors == 4000 and visit.lists > 30
    assert visit.lists_read <= visit.lists // 4 and visit.vectors_read <= 1000 and visit.question_lists == [visit.lists_read]
    assert "list_no" in plan_of(N.retrieve_index(questions, index)).split("PartitionFilters: [")[1].split("]")[0]


def test_zero_vectors_ties_copies_and_nans(spark):
    r = random.Random(4)
    odd = [[0.0, 0.0, 0.0], [1.0, 0.0, 0.0], [2.0, 0.0, 0.0], [0.0, 1.0, 0.0], [-1.0, 0.0, 0.0], [float("nan"), 1.0, 0.0], [0.5, 0.5, 0.7]]
    chunks = frame(spark, [(i, r.choice(odd)) for i in range(300)])
    questions = frame(spark, list(enumerate([[1.0, 0.0, 0.0], [0.0, 0.0, 0.0], [-1.0, -1.0, 0.0], [0.0, 0.0, 3.0]])), "question_id")
    index = N.build_neighbour_index(chunks, folder(spark))
    for k in (3, 290):
        assert rows(N.retrieve_index(questions, index, k)) == rows(R.retrieve(questions, chunks, k))


def test_rows_added_later_are_found(spark):
    first, later = clustered(5, 500), [(i + 500, v * 3 + 1) for i, v in clustered(6, 500)]
    index = N.build_neighbour_index(frame(spark, first), folder(spark))
    index.append(frame(spark, later))
    questions = frame(spark, clustered(7, 20), "question_id")
    assert rows(N.retrieve_index(questions, index)) == rows(R.retrieve(questions, frame(spark, first + later)))


def test_one_vector_holds_a_third_of_all_rows(spark):
    chunks = frame(spark, clustered(8, 2000) + [(i + 2000, [1.0] * 8) for i in range(1000)])
    questions = frame(spark, [(0, [1.0] * 8), (1, [1.0, 0.9] * 4)], "question_id")
    index = N.build_neighbour_index(chunks, folder(spark), n_lists=20)
    assert rows(N.retrieve_index(questions, index, 5)) == rows(R.retrieve(questions, chunks, 5))


def test_no_vectors_no_questions_and_one_vector(spark):
    none = frame(spark, []).where("chunk_id = 0")
    questions = frame(spark, clustered(2, 2), "question_id")
    index = N.build_neighbour_index(none, folder(spark))
    assert rows(N.retrieve_index(questions, index)) == []
    one = frame(spark, [(1, [1.0] * 8)])
    index = N.build_neighbour_index(one, folder(spark))
    assert rows(N.retrieve_index(questions, index)) == rows(R.retrieve(questions, one))
    assert rows(N.retrieve_index(questions.where("question_id < 0"), index)) == []


def test_clashing_columns_are_refused(spark):
    with pytest.raises(ValueError):
        N.build_neighbour_index(frame(spark, clustered(1, 5)).withColumn("distance", F.lit(1)), folder(spark))


def test_recall_on_the_given_vectors(spark):
    chunks = spark.read.parquet(f"{SF}/embeddings.parquet").withColumnRenamed("vec_id", "chunk_id")
    questions = chunks.where("chunk_id % 20 = 0").select(F.col("chunk_id").alias("question_id"), "embedding")
    index = N.build_neighbour_index(chunks, folder(spark))
    assert rows(N.retrieve_index(questions, index, 10)) == rows(R.retrieve(questions, chunks, 10))
