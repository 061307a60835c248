"""Queries on what is stored and kept up to date: the index, a corpus of files, evolving tables, runs with a ledger."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators.embedding import embedder
from ..plans import medallion
from ..plans.ledger import Ledger
from ..plans.stored_index import StoredIndex
from ..sources import corpus as corpus_files
from ..sources import files
from ..sources.evolving import EvolvingTable
from ..workspace import shared_folder
from .corpus import CHUNKS, RUN_TS, entries, hash_vectors_sql, markdown
from .layers import people, run_ts
from .registry import ORACLES, query, table

EDITED = "source_path LIKE 'src1%'"


@query(f"""
WITH {CHUNKS}, each_chunk AS (
    SELECT *, row_number() OVER (ORDER BY source_path, section_no, chunk_index) AS chunk_no FROM chunks),
{hash_vectors_sql("vectors", "each_chunk", "chunk_no", "chunk_text")}
SELECT source_path, chunk_id, chunk_index, dim, round(value::DOUBLE, 6) AS value
FROM each_chunk JOIN vectors USING (chunk_no)""")
def index_update(spark, folder):
    """The stored index after its first build and an update; every entry of every vector is shown.

    The first build saw other texts in some sources, lacked those of another, and had documents that went away.
    """
    docs = markdown(spark, folder)
    older = F.when(F.expr(EDITED), F.concat(F.lit("## older\n\n"), "text")).otherwise(F.col("text"))
    first = docs.where("source_path NOT LIKE 'src2%'").select("source_path", older.alias("text"))
    gone = docs.select(F.concat(F.lit("gone/"), "source_path").alias("source_path"), F.substring("text", 1, 80).alias("text"))
    index = StoredIndex(spark, shared_folder(spark))
    index.update(first.unionByName(gone), RUN_TS)
    index.update(docs, RUN_TS)
    keyed = index.chunks.withColumn("key", F.struct("source_path", "chunk_id", "chunk_index", "section_title"))
    return entries(keyed, "key").select("key.source_path", "key.chunk_id", "key.chunk_index", "dim", "value")


CORPUS_SQL = """
SELECT source || '/' || doc_id || '.md' AS source_path, CASE WHEN doc_id % 10 = 3 THEN '' ELSE text END AS text FROM documents"""


def _written_corpus(spark, folder) -> str:
    path = shared_folder(spark)
    text = F.when(F.col("doc_id") % 10 == 3, "").otherwise(F.col("text"))
    rows = table(spark, folder, "documents").select(F.concat("source", F.lit("/"), "doc_id", F.lit(".md")).alias("source_path"), text.alias("text"))
    corpus_files.write_corpus(rows.repartition(8), path)
    return path


@query(CORPUS_SQL)
def corpus_documents(spark, folder):
    """Every document as a file of its own, a tenth of them empty, read back whole: no file is missed."""
    path = _written_corpus(spark, folder)
    return corpus_files.read_corpus(spark, path, relative=True)


@query(f"SELECT source_path, octet_length(encode(text))::BIGINT AS size FROM ({CORPUS_SQL})")
def corpus_inventory(spark, folder):
    """Paths and sizes of the same files, which are not opened."""
    path = _written_corpus(spark, folder)
    return corpus_files.list_corpus(spark, path, relative=True).select("source_path", "size")


@query("""
SELECT p_partkey, p_name AS title, p_size AS size, CASE WHEN p_size > 25 THEN p_brand END AS maker FROM part""")
def append_renamed(spark, folder):
    """Small parts are written before a column is renamed, another dropped and a third added; the others after."""
    parts = table(spark, folder, "part")
    stored = EvolvingTable.create(spark, shared_folder(spark), "p_partkey bigint, p_name string, p_type string, size int")
    stored.append(parts.where("p_size <= 25").select("p_partkey", "p_name", "p_type", F.col("p_size").alias("size")))
    stored.rename("p_name", "title")
    stored.drop("p_type")
    stored.add("maker", "string")
    stored.append(parts.where("p_size > 25").select("p_partkey", F.col("p_name").alias("title"), F.col("p_size").alias("size"), F.col("p_brand").alias("maker")))
    return stored.read()


@query("""
SELECT p_partkey, CASE WHEN p_size > 25 THEN p_size::BIGINT + 5000000000 ELSE p_size END::BIGINT AS size,
       CASE WHEN p_size > 25 THEN p_retailprice ELSE p_retailprice::FLOAT END::DOUBLE AS price FROM part""")
def append_widened(spark, folder):
    """Files with narrow columns are read by the wider types that came later."""
    parts = table(spark, folder, "part").select("p_partkey", F.col("p_size").alias("size"), F.col("p_retailprice").alias("price"))
    stored = EvolvingTable.create(spark, shared_folder(spark), "p_partkey bigint, size int, price float")
    stored.append(parts.where("size <= 25"))
    stored.widen("size", "bigint")
    stored.widen("price", "double")
    stored.append(parts.where("size > 25").withColumn("size", F.col("size").cast("bigint") + 5000000000))
    return stored.read()


@query(ORACLES["run_layers"])
def run_layers_again(spark, folder):
    """A run that stops after silver, one that goes on from there, and one that finds nothing to do."""
    rows, shared = people(spark, folder), shared_folder(spark)
    files.write_csv(rows, f"{shared}/people.csv")
    ledger = Ledger(spark, f"{shared}/ledger")
    prefix = f"ledgerlake_{uuid.uuid4().hex}_"
    for upto in ("silver", "enriched", "enriched"):
        written = medallion.run_layers(
            spark, f"{shared}/people.csv", upto, run_ts(), embedder(), schema=rows.schema, prefix=prefix, path=shared, ledger=ledger
        )
    if len(ledger.ran) != 5 or len(ledger.skipped) != 8:
        raise RuntimeError(f"ran {ledger.ran}, skipped {ledger.skipped}")
    sizes = written["enriched"].select("id", F.size("embedding").alias("dims"))
    return written["gold"].join(sizes, "id")
