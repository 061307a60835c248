"""A chunk index that is stored once and brought up to date by what changed.

``documents/`` holds the digest of every document in the index, ``chunks/`` its rows, both by ``bucket``, a hash
of the source path. An update compares digests, which are narrow, and so knows which documents were added,
changed or taken away; only the new texts are cut and embedded, and only the buckets that they lie in are
written again. Digests are written last: an update that was interrupted finds the same changes again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..operators.checks import observed_values
from ..operators.history import exists
from ..sources.tables import CHUNK_SCHEMA
from .index import build_index

#: Buckets of a new index; an update writes those again that a changed document lies in.
BUCKETS = 64
STORED_CHUNKS = StructType([*CHUNK_SCHEMA.fields, StructField("bucket", IntegerType())])
DOCUMENTS = "source_path string, digest binary, bucket int"


@dataclass(frozen=True)
class Update:
    """What an update found and wrote: documents, and the chunks that were made anew."""

    added: int
    changed: int
    removed: int
    chunks_made: int
    buckets_written: int


@dataclass(frozen=True)
class StoredIndex:
    """A chunk index in ``folder``; ``embed`` as in ``build_index``."""

    spark: SparkSession
    folder: str
    embed: Callable[[DataFrame, str], DataFrame] | None = None
    buckets: int = BUCKETS

    def _rows(self, name: str, schema) -> DataFrame:
        path = f"{self.folder}/{name}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    @property
    def documents(self) -> DataFrame:
        return self._rows("documents", DOCUMENTS)

    @property
    def chunks(self) -> DataFrame:
        """The rows of the index, as ``build_index`` gives them."""
        return self._stored_chunks().drop("bucket")

    def _stored_chunks(self) -> DataFrame:
        return self._rows("chunks", STORED_CHUNKS)

    def update(self, docs: DataFrame, ts: Column | datetime | str | None = None) -> Update:
        """Make the index hold exactly ``docs`` (source_path, text), whose paths are unique and not null.

        A null text is an empty one. Chunks of documents that did not change keep their time.
        """
        bucket = F.pmod(F.xxhash64("source_path"), F.lit(self.buckets)).cast("int")
        text = F.coalesce("text", F.lit(""))
        given = docs.select("source_path", text.alias("text"))
        now = given.select("source_path", F.unhex(F.sha2(text, 256)).alias("digest"), bucket.alias("bucket"))
        folder = f"{self.folder}/changes"
        known = self.documents.select(F.col("source_path").alias("_path"), F.col("digest").alias("_digest"), F.col("bucket").alias("_bucket"))
        met = now.join(known, F.col("source_path") == F.col("_path"), "full")
        kind = F.when(F.col("_path").isNull(), "added").when(F.col("source_path").isNull(), "removed").when(F.col("digest") != F.col("_digest"), "changed")
        changes = met.select(F.coalesce("source_path", "_path").alias("source_path"), "digest", F.coalesce("bucket", "_bucket").alias("bucket"), kind.alias("kind"))
        changes.where("kind IS NOT NULL").write.mode("overwrite").parquet(folder)
        changes = self.spark.read.schema(f"{DOCUMENTS}, kind string").parquet(folder)
        counts = {r["kind"]: r["n"] for r in changes.groupBy("kind").agg(F.count("*").alias("n")).collect()}
        touched = [r["bucket"] for r in changes.select("bucket").distinct().collect()]  # at most ``buckets``
        made = 0
        if touched:
            made = self._write(given, changes, touched, bucket, ts)
        return Update(counts.get("added", 0), counts.get("changed", 0), counts.get("removed", 0), made, len(touched))

    def _write(self, given: DataFrame, changes: DataFrame, touched: list[int], bucket: Column, ts) -> int:
        seen = Observation()
        new = given.join(changes.where("kind <> 'removed'").select("source_path"), "source_path", "left_semi")
        made = build_index(new, self.embed, ts).observe(seen, F.count(F.lit(1)).alias("n")).withColumn("bucket", bucket)
        in_touched = F.col("bucket").isin(touched)
        kept = self._stored_chunks().where(in_touched).join(changes.select("source_path"), "source_path", "left_anti")
        self._replace(kept.select(*made.columns).unionByName(made), "chunks", touched)
        same = self.documents.where(in_touched).join(changes.select("source_path"), "source_path", "left_anti")
        self._replace(same.unionByName(changes.where("kind <> 'removed'").drop("kind")), "documents", touched)
        return observed_values(seen).get("n") or 0

    def _replace(self, rows: DataFrame, name: str, touched: list[int]) -> None:
        """Write buckets again, and no others; one that has no rows left is emptied.

        Dynamic overwrite moves finished files into place, so the rows may come from the buckets themselves.
        """
        seen = Observation()
        spread = rows.observe(seen, F.collect_set("bucket").alias("written")).hint("rebalance", "bucket")
        spread.write.mode("overwrite").partitionBy("bucket").option("partitionOverwriteMode", "dynamic").parquet(f"{self.folder}/{name}")
        for empty in set(touched) - set(observed_values(seen).get("written") or ()):
            place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}/bucket={empty}")
            place.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(place, True)
