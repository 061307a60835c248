"""Vector arithmetic on ``array`` columns, and a hashed bag-of-words vector."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import as_column, let

def dot(a: Column, b: Column) -> Column:
    """Sum of products in double, in array order. Null if the lengths differ."""
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def norm(v: Column | str) -> Column:
    squares = F.aggregate(
        as_column(v), F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double")
    )
    return F.sqrt(squares)


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine similarity in double; 0.0 where either vector is all zeros.

    Vectors of different length have no meaningful angle, so the result is null.
    """
    left, right = as_column(a), as_column(b)
    size = norm(left) * norm(right)
    return F.when(size == 0.0, F.lit(0.0)).otherwise(dot(left, right) / size)


def hash_vector(text: Column | str, dim: int = 64) -> Column:
    """Hashed bag of words: token counts in ``dim`` buckets, scaled to length 1.

    Stands in where no embedding model is at hand. A text is worked on inside its own row: its
    buckets are sorted together with one marker per bucket, so the distance from the start of one
    run to the next is that bucket's count plus one, and no state is carried from token to token.
    """
    words = F.trim(F.regexp_replace(F.lower(as_column(text)), "\\s+", " "))
    tokens = F.when(words != "", F.split(words, " ")).otherwise(
        F.when(words == "", F.expr("cast(array() as array<string>)"))
    )
    buckets = F.transform(
        tokens, lambda t: F.conv(F.substring(F.md5(t), 1, 4), 16, 10).cast("int") % F.lit(dim)
    )
    every = F.sequence(F.lit(0), F.lit(dim - 1))

    def run_starts(buckets: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(buckets) - 1)
        starts = F.filter(
            places, lambda i: (i == 0) | (F.get(buckets, i) != F.get(buckets, i - 1))
        )
        return F.concat(starts, F.array(F.size(buckets)))

    def counts(starts: Column) -> Column:
        return F.transform(
            every, lambda d: (F.get(starts, d + 1) - F.get(starts, d) - 1).cast("double")
        )

    def scaled(counts: Column) -> Column:
        size = F.sqrt(F.aggregate(counts, F.lit(0.0), lambda total, n: total + n * n))
        return let(
            F.when(size == 0.0, F.lit(1.0)).otherwise(size),
            lambda s: F.transform(counts, lambda n: (n / s).cast("float")),
        )

    marked = F.sort_array(F.concat(buckets, every))
    vector = let(let(let(marked, run_starts), counts), scaled)
    return F.when(words.isNotNull(), vector)
