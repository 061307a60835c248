"""Token counts with a cache of digests: every distinct text is encoded once per tokenizer version."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .common import buckets_for, ship, shuffles_freed, text_of
from .tokens import ids_of_all

ship(__name__, tokens.__name__)

#: Bits of the filter of missing digests: 128 KB.
FILTER_BITS = 1 << 20
#: Files that a run adds to the cache, at least; one for each ``ROWS_PER_BUCKET`` counts beyond that.
CACHE_FILES = 8

CACHE = "digest binary, n_tokens long, version string"


def tokenizer_version(path: str) -> str:
    """A digest of the vocabulary file: another file never meets the counts of this one."""
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def read_cache(spark: SparkSession, folder: str, version: str) -> DataFrame:
    """The stored (digest, n_tokens) of one tokenizer version; no rows where nothing is stored."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], "digest binary, n_tokens long")
    return spark.read.schema(CACHE).parquet(folder).filter(F.col("version") == version).select("digest", "n_tokens")


def _filter_bit(digest: Column) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(FILTER_BITS)).cast("int")


def maybe_missing(missing: DataFrame) -> tuple[Column, int]:
    """A condition that holds for the digest of every row of ``missing`` and for few others, worked out in each task,
    and the number of those rows.

    The filter has ``FILTER_BITS`` bits whatever the number of digests; beyond that number it lets most pass.
    """
    bits = missing.groupBy(_filter_bit(F.col("digest")).alias("bit")).agg(F.count("*").alias("n"))
    words = bits.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, bit & 63)")).alias("bits"), F.sum("n").alias("n")
    )
    bitmap, rows = [0] * (FILTER_BITS // 64), 0
    for row in words.collect():
        bitmap[row["word"]] = row["bits"]
        rows += row["n"]
    known = F.split(F.lit(",".join(map(str, bitmap))), ",").cast("array<bigint>")
    mine = _filter_bit(F.col("digest"))
    return F.getbit(F.get(known, F.shiftright(mine, 6)), mine.bitwiseAND(F.lit(63))) == 1, rows


def _with_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, bytes, digest); the digest in hexadecimal digits."""
    keyed = docs.select("doc_id", text_of().cast("binary").alias("bytes"))
    return keyed.withColumn("digest", F.sha2("bytes", 256))


def fill_cache(docs: DataFrame, path: str, cache: str) -> None:
    """Append to the cache the counts of the texts that it lacks, each encoded once.

    Digests alone are joined to the stored ones; a filter of the missing ones then picks, in the task that reads
    them, the texts to shuffle: those that the cache lacks, and few others. Counts are dealt to few tasks before
    they are written: a task that writes asks the file system for folders and rights, which for a local one starts
    processes, and a cache of many small files is slow to read.
    """
    spark = docs.sparkSession
    version = tokenizer_version(path)
    keyed = _with_digests(docs).select(F.unhex("digest").alias("digest"), "bytes")

    def run(batches):
        for batch in batches:
            texts = (str(v, "utf-8") for v in (b.as_buffer() for b in batch.column(1)))
            counts = [len(ids) // 4 for ids in ids_of_all(path, texts)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])

    known = read_cache(spark, cache, version).select("digest")
    with shuffles_freed(spark):
        lacks, rows = maybe_missing(keyed.select("digest").distinct().join(known, "digest", "left_anti"))
        picked = keyed.filter(lacks).groupBy("digest").agg(F.first("bytes").alias("bytes"))
        misses = picked.join(known, "digest", "left_anti").select("digest", "bytes")
        counted = misses.mapInArrow(run, "digest binary, n_tokens long").withColumn("version", F.lit(version))
        counted.repartition(buckets_for(rows, least=CACHE_FILES)).write.mode("append").parquet(cache)


def count_tokens(docs: DataFrame, path: str, cache: str, limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document.

    Texts meet the cache by the sha-256 of their UTF-8 bytes; a null text is the empty text. Those that it lacks
    are counted and appended first, so a run after a failure or over more documents starts from what is there.
    Rows are kept as they are, null and repeated ``doc_id`` too; other columns are not read. Two jobs that append
    at once may store a digest twice, which reading evens out.
    """
    fill_cache(docs, path, cache)
    counts = read_cache(docs.sparkSession, cache, tokenizer_version(path))
    counts = counts.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    # joined by the digits: were the key that of the aggregate, adaptive execution could not split it at a hot digest
    counts = counts.select(F.lower(F.hex("digest")).alias("digest"), "n_tokens")
    slim = _with_digests(docs).select("doc_id", "digest", F.octet_length("bytes").cast("long").alias("n_bytes"))
    return slim.join(counts, "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
