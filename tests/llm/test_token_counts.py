"""Token counts: few files in the cache, digests stored twice, a hot text."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerlake.llm.queries import vocabulary
from ledgerlake.llm.tokencounts import count_tokens, read_cache, tokenizer_version

BYTES = vocabulary("byte_bpe_50k.json")
#: As on a large table: many shuffle partitions that adaptive execution leaves alone, and no broadcast.
WIDE = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}

SPLIT = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
}


@pytest.fixture
def wide(spark):
    before = {k: spark.conf.get(k, None) for k in (*WIDE, *SPLIT)}
    for k, v in WIDE.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def texts_of(n: int) -> list[tuple[int, str | None]]:
    return [(i, f"text {i % 300} of some words, {i % 300 * 7}") for i in range(n)] + [(-1, None), (-1, ""), (None, "no id")]


def test_few_tasks_write_whatever_the_partitions(wide, tmp_path):
    library, cache, rows = Tokenizer.from_file(BYTES), f"{tmp_path}/cache", texts_of(700)
    docs = wide.createDataFrame(rows, "doc_id long, text string")
    for part in (docs.filter("doc_id % 2 = 0"), docs):
        before = {*Path(cache).rglob("*.parquet")}
        found = count_tokens(part, BYTES, cache).collect()
        assert len({*Path(cache).rglob("*.parquet")} - before) <= 8
    want = [(d, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids), False) for d, t in rows]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))
    assert read_cache(wide, cache, tokenizer_version(BYTES)).count() == 302


def test_digests_stored_twice_count_once(wide, tmp_path):
    cache, docs = f"{tmp_path}/cache", wide.createDataFrame(texts_of(40), "doc_id long, text string")
    count_tokens(docs, BYTES, cache)
    twice = read_cache(wide, cache, tokenizer_version(BYTES)).withColumn("version", F.lit(tokenizer_version(BYTES))).toArrow()
    wide.createDataFrame(twice).write.mode("append").parquet(cache)
    assert count_tokens(docs, BYTES, cache).count() == 43


def test_the_join_is_split_at_a_hot_text(wide, tmp_path):
    for k, v in SPLIT.items():
        wide.conf.set(k, v)
    rows = texts_of(300) + [(i, "one text that comes again and again") for i in range(20_000)]
    found = count_tokens(wide.createDataFrame(rows, "doc_id long, text string"), BYTES, f"{tmp_path}/cache")
    assert len(found.collect()) == len(rows)
    assert "SortMergeJoin(skew=true)" in found._jdf.queryExecution().executedPlan().toString()
