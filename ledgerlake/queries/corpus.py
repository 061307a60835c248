"""Queries on the document corpus: sections, chunks and hashed vectors.

The documents are plain text, so they are first made into Markdown: every line of text becomes a
paragraph, and a short line becomes a heading.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import embedding, sections as S
from ..plans.index import build_index
from ..plans.medallion import enrich
from ..workspace import ship_code
from .registry import query, table

HEADING_CHARS = 40
DIM = 64
RUN_TS = "2024-01-01 00:00:00"

BLANKS = "(' ' || chr(9) || chr(10) || chr(13))"
MARKDOWN = f"""
markdown AS (
    SELECT source || '/' || doc_id AS source_path, array_to_string(list_transform(
        list_filter(string_split(text, chr(10)), lambda l: trim(l) <> ''),
        lambda l: CASE WHEN length(l) < {HEADING_CHARS} THEN '## ' || l ELSE l END),
        chr(10) || chr(10)) AS text
    FROM documents)"""
SECTIONS = f"""{MARKDOWN},
lines AS (
    SELECT source_path, unnest(l) AS line, generate_subscripts(l, 1) AS pos
    FROM (SELECT source_path, string_split(text, chr(10)) AS l FROM markdown)),
marked AS (SELECT *, regexp_matches(line, '^#{{1,6}}\\s.') AS is_heading FROM lines),
numbered AS (
    SELECT *, sum(is_heading::INTEGER) OVER (PARTITION BY source_path ORDER BY pos)::INTEGER
        AS section_no
    FROM marked),
sections AS (
    SELECT * FROM (
        SELECT source_path, section_no,
               coalesce(max(trim(regexp_replace(line, '^#{{1,6}}', ''), {BLANKS}))
                        FILTER (is_heading), 'Introducción') AS section_title,
               trim(string_agg(line, chr(10) ORDER BY pos), {BLANKS}) AS section_text
        FROM numbered GROUP BY source_path, section_no)
    WHERE section_text <> '')"""
CHUNKS = f"""{SECTIONS},
packed AS (
    SELECT source_path, section_no, section_title, list_reduce(
        list_filter(list_transform(regexp_split_to_array(section_text, '\\n\\s*\\n'),
                                   lambda p: trim(p, {BLANKS})), lambda p: p <> ''),
        lambda s, p: CASE
            WHEN s.size > 0 AND s.size + length(p) > {S.MAX_CHARS}
            THEN {{'closed': list_append(s.closed, s.current), 'current': p, 'size': length(p)}}
            ELSE {{'closed': s.closed,
                  'current': CASE WHEN s.size = 0 THEN p
                                  ELSE s.current || chr(10) || chr(10) || p END,
                  'size': s.size + length(p)}} END,
        {{'closed': []::VARCHAR[], 'current': '', 'size': 0::BIGINT}}) AS fold
    FROM sections),
cut AS (
    SELECT source_path, section_no, section_title, unnest(parts) AS chunk_text,
           (generate_subscripts(parts, 1) - 1)::INTEGER AS chunk_index
    FROM (SELECT *, list_append(fold.closed, fold.current) AS parts FROM packed)),
chunks AS (
    SELECT *, sha256(source_path || '|' || section_title || '|' || chunk_index || '|' || chunk_text)
        AS chunk_id
    FROM cut)"""


def hash_vectors_sql(name: str, rows: str, key: str, text: str) -> str:
    """Common table expressions for the non-zero entries of hashed vectors: ``key, dim, value``."""
    return f"""
{name}_counts AS (
    SELECT {key}, ('0x' || md5(token)[1:4])::INTEGER % {DIM} AS dim, count(*)::DOUBLE AS n
    FROM (SELECT {key}, unnest(regexp_split_to_array(lower({text}), '\\s+')) AS token FROM {rows})
    WHERE token <> '' GROUP BY ALL),
{name} AS (
    SELECT {key}, dim, (n / sqrt(sum(n * n) OVER (PARTITION BY {key})))::FLOAT AS value
    FROM {name}_counts)"""


def documents(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    return table(spark, folder, "documents").select(*columns)


def markdown(spark: SparkSession, folder: str) -> DataFrame:
    lines = F.filter(F.split("text", "\n"), lambda l: F.trim(l) != "")
    marked = F.transform(
        lines, lambda l: F.when(F.length(l) < HEADING_CHARS, F.concat(F.lit("## "), l)).otherwise(l)
    )
    return documents(spark, folder, "source", "doc_id", "text").select(
        F.concat_ws("/", "source", F.col("doc_id").cast("string")).alias("source_path"),
        F.array_join(marked, "\n\n").alias("text"),
    )


def entries(df: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """The non-zero values of a vector column, one row each, rounded for comparison.

    The outer form of the generator keeps Spark from also working out the vectors in a filter for
    empty arrays, which it would push down to the scan.
    """
    unfolded = df.select(key, F.posexplode_outer(vector).alias("dim", "value"))
    return unfolded.where(F.col("value") != 0).select(
        key, "dim", F.round(F.col("value").cast("double"), 6).alias("value")
    )


@query(f"WITH {SECTIONS} SELECT * FROM sections")
def sections(spark, folder):
    return S.split_sections(markdown(spark, folder))


@query(f"WITH {CHUNKS} SELECT * FROM chunks")
def chunks(spark, folder):
    return S.chunk_documents(markdown(spark, folder))


@query(f"WITH {CHUNKS} SELECT source_path, count(*) AS chunks FROM chunks GROUP BY source_path")
def chunks_per_source(spark, folder):
    return S.chunks_per_source(S.chunk_documents(markdown(spark, folder)))


DOCUMENT_VECTORS = f"""
WITH {hash_vectors_sql("vectors", "documents", "doc_id", "text")}
SELECT doc_id, dim, round(value::DOUBLE, 6) AS value FROM vectors"""


@query(DOCUMENT_VECTORS)
def hash_embeddings(spark, folder):
    texts = documents(spark, folder, "doc_id", "text")
    return entries(embedding.hash_embed(texts, "text", DIM), "doc_id")


def load_hash_model():
    """A batch function like one a user brings: here, hashed words again, in Python."""

    @functools.lru_cache(maxsize=1 << 16)
    def bucket(token: str) -> int:
        return int(hashlib.md5(token.encode()).hexdigest()[:4], 16) % DIM

    def embed(texts: list[str]) -> list[list[float]]:
        vectors = []
        for text in texts:
            counts = [0.0] * DIM
            for token in re.split(r"\s+", text.lower(), flags=re.ASCII):
                if token:
                    counts[bucket(token)] += 1.0
            size = math.sqrt(sum(n * n for n in counts)) or 1.0
            vectors.append([n / size for n in counts])
        return vectors

    return embed


@query(DOCUMENT_VECTORS)
def embed_hook(spark, folder):
    """The same vectors, from a function the caller supplies."""
    texts = documents(spark, folder, "doc_id", "text")
    embedded = enrich(texts, lambda df, text: embedding.embed_column(df, text, load_hash_model), "text")
    return entries(embedded, "doc_id")


@query(f"""
WITH {CHUNKS}, {hash_vectors_sql("vectors", "chunks", "chunk_id", "chunk_text")}
SELECT chunk_id, source_path, section_title, chunk_index, chunk_text,
       TIMESTAMP '{RUN_TS}' AS ingestion_ts, round(total, 6) AS vector_total
FROM chunks JOIN (SELECT chunk_id, sum(value::DOUBLE) AS total FROM vectors GROUP BY chunk_id)
USING (chunk_id)""")
def chunk_index(spark, folder):
    """The whole index; a vector is shown by the sum of its values."""
    total: Column = F.aggregate("embedding", F.lit(0.0), lambda t, x: t + x.cast("double"))
    return build_index(markdown(spark, folder), ts=RUN_TS).select(
        "chunk_id",
        "source_path",
        "section_title",
        "chunk_index",
        "chunk_text",
        F.col("ingestion_ts").cast("timestamp_ntz").alias("ingestion_ts"),
        F.round(total, 6).alias("vector_total"),
    )


ship_code(__name__)
