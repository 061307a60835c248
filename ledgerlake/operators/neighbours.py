"""A neighbour index that skips lists of vectors without losing a row.

Vectors of length one are dealt to the nearest of a set of centroids, which Spark trains, and are stored by
list, with their distance to its centroid. Between a question and every vector of a list lies at least the
distance to the centroid less the list's radius (or the inner radius less that distance), and a distance
bounds a cosine. So a question first scores its nearest lists, until they hold k vectors; the k-th score
found is a bar, and of the other lists only those are read whose bound reaches it. The result is that of
``retrieve``, row by row; a list that is skipped is a partition that is not scanned.

A list of any size is written as many files and read by as many tasks. Vectors of length zero, whose cosine
is 0 with everything, have a list of their own, and so have vectors with a NaN or without a length, which never rank.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import collect_vectors, ship_code
from . import retrieval as R
from .history import exists

#: Rows that centroids are trained on at most, lists at most, and rounds of training.
SAMPLE_ROWS, MAX_LISTS, ROUNDS = 100_000, 4096, 8
#: Lists of vectors of length zero, and of vectors with a NaN.
ZERO, NEVER = -1, -2
#: Slack of a bound against rounding.
SLACK = 1e-9


@dataclass(frozen=True)
class NeighbourIndex:
    """An index in a folder: ``centroids``, ``vectors`` (by ``list_no``) and ``sizes``, with a row per list and append."""

    spark: SparkSession
    folder: str
    chunk_id: str = "chunk_id"
    vector: str = "embedding"

    @property
    def vectors(self) -> DataFrame:
        kept = self.spark.read.parquet(f"{self.folder}/columns")
        if not exists(self.spark, f"{self.folder}/vectors"):
            return kept.limit(0)
        return self.spark.read.schema(kept.schema).parquet(f"{self.folder}/vectors")

    @property
    def lists(self) -> DataFrame:
        """(list_no, inner, radius, n) of every list with vectors."""
        sizes = self.spark.read.parquet(f"{self.folder}/sizes").groupBy("list_no")
        return sizes.agg(F.min("inner").alias("inner"), F.max("radius").alias("radius"), F.sum("n").alias("n"))

    def centroids(self) -> np.ndarray:
        """All centroids, in order; at most ``MAX_LISTS``."""
        rows = self.spark.read.parquet(f"{self.folder}/centroids").orderBy("list_no").toArrow()
        return R._matrix(rows.column("centroid")) if rows.num_rows else np.empty((0, 0))

    def append(self, chunks: DataFrame) -> None:
        """Add rows: each goes to the list of its nearest centroid, and the bounds of the lists widen with it."""
        write_vectors(chunks, self)


def train_centroids(chunks: DataFrame, vector: str, n_lists: int | None = None, sample_rows: int = SAMPLE_ROWS) -> list[list[float]]:
    """Centres of the vectors of length one, from the ``sample_rows`` with the smallest hashes at most.

    About the square root of the number of rows, unless ``n_lists`` is given; fewer where vectors are equal.
    """
    unit = unit_vectors(chunks, vector).where("list_no IS NULL").select("unit", F.xxhash64("unit").alias("drawn"))
    n = unit.count()
    if not n:
        return []
    if n > sample_rows:
        share = int(min(1.0, 1.2 * sample_rows / n) * (1 << 64)) - (1 << 63) - 1
        unit = unit.where(F.col("drawn") <= share)
    sample = unit.orderBy("drawn", "unit").limit(sample_rows).select(array_to_vector("unit").alias("features"))
    k = min(n_lists or math.ceil(math.sqrt(n)), MAX_LISTS, n)
    if k < 2:
        return [[float(x) for x in sample.first()["features"]]]
    model = KMeans(k=k, maxIter=ROUNDS, seed=42, initSteps=2).fit(sample.persist())
    sample.unpersist()
    return [[float(x) for x in c] for c in model.clusterCenters()]


def unit_vectors(chunks: DataFrame, vector: str) -> DataFrame:
    """``chunks`` with ``unit``, the vector as doubles of length one, and ``list_no`` for those that have none."""
    doubles = F.col(vector).cast("array<double>")
    size = F.sqrt(F.aggregate(doubles, F.lit(0.0), lambda a, x: a + x * x))
    sized = chunks.withColumn("_size", size)
    special = F.when(F.isnan("_size") | (F.col("_size") == float("inf")), F.lit(NEVER)).when(F.col("_size") == 0, F.lit(ZERO))
    unit = F.transform(doubles, lambda x: x / F.when(F.col("_size") == 0, F.lit(1.0)).otherwise(F.col("_size")))
    return sized.withColumns({"unit": unit, "list_no": special.cast("int")}).drop("_size")


def write_vectors(chunks: DataFrame, index: NeighbourIndex) -> None:
    centroids, vector = index.centroids(), index.vector
    names = chunks.columns

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            special = batch.column(batch.num_columns - 1).to_pylist()
            lists, away = np.full(len(special), ZERO), np.zeros(len(special))
            plain = np.array([s is None for s in special], bool)
            lists[~plain] = [s for s in special if s is not None]
            if plain.any():
                unit = R._matrix(batch.column(batch.num_columns - 2).filter(pa.array(plain)), centroids.shape[1])
                lists[plain], away[plain] = nearest_centroids(unit, centroids)
            found = [pa.array(lists, pa.int32()), pa.array(away)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *found], names=[*names, "list_no", "distance"])

    rows = unit_vectors(chunks, vector).select(*names, "unit", "list_no")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in chunks.schema.fields)
    listed = rows.mapInArrow(nearest, f"{schema}, list_no int, distance double")
    spread = listed.hint("rebalance", "list_no")
    before = index.vectors.select(F.max("append_no")).first()[0] or 0
    spread.withColumn("append_no", F.lit(before + 1)).write.mode("append").partitionBy("append_no", "list_no").parquet(f"{index.folder}/vectors")
    written = index.vectors.where(F.col("append_no") == before + 1)
    sizes = written.groupBy("list_no").agg(F.min("distance").alias("inner"), F.max("distance").alias("radius"), F.count("*").alias("n"))
    sizes.write.mode("append").parquet(f"{index.folder}/sizes")


def nearest_centroids(unit: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row, and how far it is."""
    squares = (centroids * centroids).sum(axis=1)
    lists = np.empty(len(unit), np.int64)
    step = max(1, R.SCORES_AT_ONCE // len(centroids))
    for start in range(0, len(unit), step):
        some = unit[start : start + step]
        lists[start : start + step] = (squares - 2 * some @ centroids.T).argmin(axis=1)
    return lists, np.sqrt(((unit - centroids[lists]) ** 2).sum(axis=1))


def build_neighbour_index(
    chunks: DataFrame, folder: str, n_lists: int | None = None, chunk_id: str = "chunk_id", vector: str = "embedding"
) -> NeighbourIndex:
    """Train centroids on ``chunks`` and store all its rows by list in ``folder``; rows added later keep the centroids.

    Vectors must be present and of one length. No rows give an index that finds nothing.
    """
    spark = chunks.sparkSession
    clash = {"list_no", "distance", "append_no", "unit", "_size"} & set(chunks.columns)
    if clash:
        raise ValueError(f"chunks already have {sorted(clash)}")
    centroids = train_centroids(chunks, vector, n_lists)
    rows = spark.createDataFrame(list(enumerate(centroids)), "list_no int, centroid array<double>")
    rows.write.mode("overwrite").parquet(f"{folder}/centroids")
    kept = chunks.limit(0).withColumns({"distance": F.lit(0.0), "append_no": F.lit(0), "list_no": F.lit(0)})
    kept.write.mode("overwrite").parquet(f"{folder}/columns")
    index = NeighbourIndex(spark, folder, chunk_id, vector)
    index.append(chunks)
    return index


def bounds(questions: np.ndarray, centroids: np.ndarray, lists: Sequence[int], inner: np.ndarray, radius: np.ndarray) -> np.ndarray:
    """The highest cosine that a vector of each list can have with each question."""
    unit = R._scaled(questions)
    plain = np.array([x >= 0 for x in lists], bool)
    out = np.zeros((len(questions), len(lists)))
    if plain.any():
        at = centroids[[x for x in lists if x >= 0]]
        away = np.sqrt(np.maximum(1.0 * (unit * unit).sum(axis=1)[:, None] + (at * at).sum(axis=1) - 2 * unit @ at.T, 0.0))
        least = np.maximum(0.0, np.maximum(away - radius[plain], inner[plain] - away) - SLACK)
        out[:, plain] = 1 - least * least / 2 + SLACK
    out[(questions == 0).all(axis=1)] = 0.0
    return out


def _asked(index: NeighbourIndex, questions: DataFrame, k: int, question_id: str):
    """The questions' vectors and ids, and of all lists that may rank: numbers, sizes and bounds."""
    limit = max(1, min(R.MAX_QUESTIONS, R.MAX_KEPT // k))
    few = collect_vectors(R._asked(questions, question_id, index.vector), index.vector, limit, R.MAX_QUESTION_BYTES)
    if few is None:
        raise ValueError(f"more than {limit} questions, or vectors too large: ask in several calls")
    rows = sorted(tuple(r) for r in index.lists.collect() if r["list_no"] != NEVER)  # a row a list: at most MAX_LISTS + 1
    vectors = R._matrix(few.column(index.vector))
    vectors, ids = vectors[~np.isnan(vectors).any(axis=1)], few.column(question_id).combine_chunks().filter(pa.array(~np.isnan(vectors).any(axis=1)))
    numbers = [r[0] for r in rows]
    inner, radius, sizes = (np.array([r[i] for r in rows]) for i in (1, 2, 3))
    best = bounds(vectors, index.centroids(), numbers, inner, radius) if rows and len(vectors) else np.zeros((len(vectors), len(rows)))
    return vectors, ids, numbers, sizes, best


def _first_lists(best: np.ndarray, sizes: np.ndarray, k: int) -> np.ndarray:
    """Of each question the most promising lists, until they hold k vectors."""
    order = np.argsort(-best, axis=1, kind="stable")
    held = np.cumsum(sizes[order], axis=1) if best.shape[1] else np.empty(best.shape)
    taken = held - (sizes[order] if best.shape[1] else 0) < k
    out = np.zeros(best.shape, bool)
    np.put_along_axis(out, order, taken, axis=1)
    return out


def _partial(index: NeighbourIndex, wanted: np.ndarray, numbers: list[int], vectors: np.ndarray, ids: pa.Array, k: int, question_id: str, questions: DataFrame) -> DataFrame:
    """What tasks rank of the lists that some question wants; other lists are not scanned."""
    read = [n for n, some in zip(numbers, wanted.any(axis=0)) if some]
    rows = index.vectors.where(F.col("list_no").isin(read)) if read else index.vectors.where(F.lit(False))
    offered = rows.select(index.chunk_id, F.xxhash64(index.vector).alias("_vector_no"), index.vector, "list_no")
    schema = R._partial_schema(questions, question_id, offered, index.chunk_id)
    asking = {n: np.flatnonzero(wanted[:, i]) for i, n in enumerate(numbers) if n in set(read)}
    carried, vector = [index.chunk_id, "_vector_no"], index.vector

    def best_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = R._Best(vectors, k, carried, vector)
        for batch in batches:
            lists = batch.column(3).to_numpy(zero_copy_only=False)
            for number in np.unique(lists).tolist():
                some = pa.Table.from_batches([batch]).filter(pa.array(lists == number))
                best.show(some, asking[number])
        found = best.rows(ids, question_id)
        if found is not None:
            yield from found.to_batches()

    return offered.mapInArrow(best_of_task, schema)


@dataclass(frozen=True)
class Visit:
    """What a call of ``retrieve_index`` read: per question and in all."""

    question_lists: list[int]
    lists_read: int
    lists: int
    vectors_read: int
    vectors: int


def _wanted(index: NeighbourIndex, asked, k: int, question_id: str, questions: DataFrame) -> np.ndarray:
    vectors, ids, numbers, sizes, best = asked
    first = _first_lists(best, sizes, k)
    partial = _partial(index, first, numbers, vectors, ids, k, question_id, questions)
    ranked = R._ranked(partial, [question_id], k, index.chunk_id, "_vector_no").where(F.col("rank") == k)
    bar = {r[question_id]: r["score"] for r in ranked.select(question_id, "score").collect()}  # a number a question
    bars = np.array([bar.get(i, -np.inf) for i in ids.to_pylist()])
    return best >= bars[:, None] - SLACK if len(bars) else first


def retrieve_index(
    questions: DataFrame, index: NeighbourIndex, k: int = R.TOP_K, keep: Sequence[str] = (), question_id: str = "question_id"
) -> DataFrame:
    """The k vectors of the index closest to each question, as ``retrieve`` gives them, from the lists that can hold them.

    For a bounded set of questions, like ``retrieve``. Two jobs: the first scores a few lists to set the bar.
    """
    asked = _asked(index, questions, k, question_id)
    vectors, ids, numbers, *_ = asked
    wanted = _wanted(index, asked, k, question_id, questions)
    partial = _partial(index, wanted, numbers, vectors, ids, k, question_id, questions)
    read = [n for n, some in zip(numbers, wanted.any(axis=0)) if some]
    chunks = index.vectors.where(F.col("list_no").isin(read)) if read else index.vectors.where(F.lit(False))
    return R._finalists(partial, chunks, k, keep, question_id, index.chunk_id, index.vector)


def visits(questions: DataFrame, index: NeighbourIndex, k: int = R.TOP_K, question_id: str = "question_id") -> Visit:
    """How many lists and vectors ``retrieve_index`` reads for these questions, out of how many."""
    asked = _asked(index, questions, k, question_id)
    numbers, sizes = asked[2], asked[3]
    wanted = _wanted(index, asked, k, question_id, questions)
    any_ = wanted.any(axis=0)
    return Visit(wanted.sum(axis=1).tolist(), int(any_.sum()), len(numbers), int(sizes[any_].sum()), int(sizes.sum()))


ship_code(__name__)
