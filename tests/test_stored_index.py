"""The stored index after updates against one built anew."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans.index import build_index
from ledgerlake.plans.stored_index import StoredIndex

TS = "2024-01-01 00:00:00"


def docs(spark, texts):
    return spark.createDataFrame(list(texts.items()), "source_path string, text string")


def shown(df):
    rows = df.select("chunk_id", "source_path", "section_title", "chunk_index", "chunk_text", F.col("embedding").cast("array<double>")).collect()
    return sorted((*r[:5], tuple(r[5])) for r in rows)


@pytest.fixture
def index(spark):
    return StoredIndex(spark, f"{spark.conf.get('spark.checkpoint.dir')}/{uuid.uuid4().hex}", buckets=8)


def test_updates_equal_an_index_built_anew(spark, index):
    first = {f"d{i}": f"# title {i}\n\nwords of document {i}\n\n## more\n\n{'text ' * i}" for i in range(40)}
    done = index.update(docs(spark, first), TS)
    assert (done.added, done.changed, done.removed) == (40, 0, 0) and done.chunks_made == index.chunks.count()
    assert shown(index.chunks) == shown(build_index(docs(spark, first), ts=TS))
    later = {k: v for k, v in first.items() if k not in ("d3", "d7")} | {"d5": "# other\n\nnew text", "new": "just words", "none": None}
    done = index.update(docs(spark, later), "2024-02-01 00:00:00")
    assert (done.added, done.changed, done.removed) == (2, 1, 2)
    assert shown(index.chunks) == shown(build_index(docs(spark, later), ts=TS))
    assert {r["source_path"] for r in index.chunks.where(F.month("ingestion_ts") == 2).collect()} == {"d5", "new"}


def test_only_new_texts_are_embedded_and_only_their_buckets_written(spark, tmp_path):
    from ledgerlake.operators.embedding import hash_embed

    counter = spark.sparkContext.accumulator(0)
    folder = f"{spark.conf.get('spark.checkpoint.dir')}/{uuid.uuid4().hex}"

    def embed(df, column):
        seen = F.udf(lambda t: (counter.add(1), t)[1], "string").asNondeterministic()
        return hash_embed(df.withColumn(column, seen(column)), column)

    index = StoredIndex(spark, folder, embed, buckets=32)
    texts = {f"d{i}": f"words {i}" for i in range(60)}
    index.update(docs(spark, texts), TS)
    before, files = counter.value, set(index.chunks.inputFiles())
    texts["d9"] = "other words"
    done = index.update(docs(spark, texts), TS)
    assert done.chunks_made == 1 and counter.value - before <= 3 and done.buckets_written == 1
    assert len(files - set(index.chunks.inputFiles())) >= 1
    assert len(files & set(index.chunks.inputFiles())) >= len(files) - 3
    assert index.update(docs(spark, texts), TS).buckets_written == 0


def test_an_index_that_loses_all_documents(spark, index):
    index.update(docs(spark, {"a": "words", "b": "more words"}), TS)
    assert index.update(docs(spark, {"a": "words"}).where("source_path = 'x'"), TS).removed == 2
    assert index.chunks.count() == 0 and index.documents.count() == 0
    assert index.update(docs(spark, {"a": "words"}), TS).added == 1 and index.chunks.count() == 1


def test_an_interrupted_update_is_found_again(spark, index):
    index.update(docs(spark, {"a": "words", "b": "more words"}), TS)

    def broken(df, column):
        return df.withColumn("embedding", F.raise_error(F.lit("model is gone")).cast("array<float>"))

    with pytest.raises(Exception, match="model is gone"):
        StoredIndex(spark, index.folder, broken, index.buckets).update(docs(spark, {"a": "new words", "b": "more words"}), TS)
    assert index.update(docs(spark, {"a": "new words", "b": "more words"}), TS).changed == 1
    assert {r["chunk_text"] for r in index.chunks.collect()} == {"new words", "more words"}
