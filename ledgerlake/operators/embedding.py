"""A vector per text: with a function the caller brings, or with hashed words."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import hash_vector
from ..workspace import ship_code

# Texts of one batch to their vectors, in the same order.
Embed = Callable[[list[str]], Sequence[Sequence[float]]]


def embed_column(
    df: DataFrame, text_col: str, load: Callable[[], Embed], out: str = "embedding"
) -> DataFrame:
    """``df`` with a vector of ``text_col``, from a model the caller supplies.

    ``load`` runs once per task and returns the batch function, so a model is loaded once and
    then sees whole Arrow batches. Only the text column goes to Python. A null text has no vector.
    """

    @F.pandas_udf("array<float>")
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        embed = load()
        for texts in batches:
            given = texts.notna()
            found = pd.Series([None] * len(texts), index=texts.index, dtype=object)
            if given.any():
                made = embed(texts[given].tolist())
                found[given] = pd.Series(list(made), index=texts.index[given], dtype=object)
            yield found

    return df.withColumn(out, vectors(F.col(text_col)))


def hash_embed(df: DataFrame, text_col: str, dim: int = 64, out: str = "embedding") -> DataFrame:
    """``df`` with hashed bag-of-words vectors; needs no model and no Python."""
    return df.withColumn(out, hash_vector(text_col, dim))


def embedder(dim: int = 64) -> Callable[[DataFrame, str], DataFrame]:
    """The default embedding step of an index: ``(df, text column) -> df`` with ``embedding``."""
    return lambda df, text_col: hash_embed(df, text_col, dim)


ship_code(__name__)
