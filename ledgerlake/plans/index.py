"""The chunk index: documents to sections to chunks to vectors."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame

from ..functions.columns import with_ingestion_ts
from ..operators.embedding import embedder
from ..operators.sections import MAX_CHARS, chunk_documents
from ..sources.tables import CHUNK_SCHEMA, conform


def build_index(
    docs: DataFrame,
    embed: Callable[[DataFrame, str], DataFrame] | None = None,
    ts: Column | datetime | str | None = None,
    max_chars: int = MAX_CHARS,
) -> DataFrame:
    """Index rows of ``(source_path, text)``, ready to be written as a table.

    ``embed(df, column)`` adds ``embedding``; by default hashed words. No step shuffles, so the
    index is written straight from the scan of the documents.
    """
    chunks = (embed or embedder())(chunk_documents(docs, max_chars), "chunk_text")
    return conform(with_ingestion_ts(chunks, ts), CHUNK_SCHEMA)
