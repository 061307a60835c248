"""Nearest chunks per question by cosine similarity, and what is built on them.

Both ways are exact and never form all pairs of questions and chunks as rows. A task scores its
chunks against a block of questions as one matrix product and keeps the k best per question, so
what is shuffled is at most k rows per question and task. ``retrieve`` sends a bounded set of
questions to all tasks and refuses a larger one; ``retrieve_grid`` spreads any number of questions
over a grid of question blocks and chunk blocks. Python sees ids and vectors only; the columns to
keep are joined to the k survivors afterwards.

Scores are rounded to 12 decimals before ranking: equal texts then tie exactly, whatever the order
their terms were summed in, and ties go to the smaller chunk id. A vector with a NaN never ranks.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..functions.columns import source_line
from ..functions.vectors import cosine
from ..workspace import collect_vectors, ship_code

TOP_K = 3
SCORE_DECIMALS = 12
# How many question vectors every task may get, and how many bytes they may take.
MAX_QUESTIONS = 10_000
MAX_QUESTION_BYTES = 64 << 20
# Ranked rows that a task may hold for all its questions together.
MAX_KEPT = 100_000
# Vectors and ids that one side of a grid cell may hold. Both sides alike, as then the least is copied.
CELL_BYTES = 64 << 20
ID_BYTES = 64
# Groups that the finalists of one question are ranked in before the last ranking.
FINAL_GROUPS = 64
# Scores held at once while a task works through its chunks.
SCORES_AT_ONCE = 1_000_000
# Labels and layout of the prompts.
CONTEXT_BLOCK = "Fuente: %s :: %s\n%s"
CONTEXT_CUE = "Contexto recuperado:\n"
QUESTION_CUE = "Pregunta:\n"
ANSWER_CUE = "Respuesta:"


def nearest(
    chunks: DataFrame, vector: Column | Sequence[float], k: int = TOP_K, col: str = "embedding"
) -> DataFrame:
    """The k chunks closest to one vector, which may also come from a scalar subquery.

    A vector with a NaN never ranks, and one of another length is an error.
    """
    question = vector if isinstance(vector, Column) else F.array(*[F.lit(float(x)) for x in vector])
    score = F.round(cosine(col, "_question"), SCORE_DECIMALS)
    fits = F.size(col) == F.size("_question")
    wrong = F.raise_error(F.lit("a vector is null or not as long as the question")).cast("double")
    scored = chunks.withColumn("_question", question).withColumn(
        "score", F.when(fits, score).otherwise(wrong)
    )
    return scored.drop("_question").where(~F.isnan("score")).orderBy(F.desc("score"), "chunk_id").limit(k)


def _matrix(vectors: pa.Array | pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """A list column as a matrix of doubles. Vectors must be present and of one length."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    values = vectors.flatten()
    n = len(vectors)
    width = width if width is not None else (len(values) // n if n else 0)
    lengths = vectors.value_lengths()
    if vectors.null_count or values.null_count or any(x != width for x in lengths.unique().to_pylist()):
        raise ValueError(f"a vector is null or does not have {width} values")
    return values.to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, width)


def _scaled(matrix: np.ndarray) -> np.ndarray:
    """Rows of length 1; zero rows stay zero, so that their cosine is 0."""
    size = np.sqrt((matrix * matrix).sum(axis=1))
    return matrix / np.where(size == 0.0, 1.0, size)[:, None]


class _Best:
    """The k best chunks per question of what it has been shown; one per task.

    Holds at most k rows per question, and of a block at most ``SCORES_AT_ONCE`` pairs as three
    numbers each; ids are taken for the k of them that stay.
    """

    def __init__(self, questions: np.ndarray, k: int, carried: Sequence[str], vector: str):
        self.raw = questions
        self.size = np.sqrt((questions * questions).sum(axis=1))
        self.questions = _scaled(questions)
        self.k, self.carried, self.vector = k, list(carried), vector
        self.bar = np.full(len(questions), -np.inf)
        self.kept: pa.Table | None = None

    def show(self, rows: pa.Table, which: np.ndarray | None = None) -> None:
        """Score rows against all questions, or against ``which`` of them (places, in order)."""
        which = np.arange(len(self.questions)) if which is None else which
        step = max(1, SCORES_AT_ONCE // max(1, len(which)))
        for start in range(0, rows.num_rows if len(which) else 0, step):
            self._show_block(rows.slice(start, step), which)

    def _show_block(self, rows: pa.Table, which: np.ndarray) -> None:
        # In the order of ids, so that among equal scores the place in the block decides.
        by_id = pc.sort_indices(
            rows, sort_keys=[(self.carried[0], "ascending")], null_placement="at_start"
        )
        rows = rows.take(by_id)
        vectors = _matrix(rows.column(self.vector), self.questions.shape[1])
        rough = _scaled(vectors) @ self.questions[which].T
        valid = ~np.isnan(rough)
        rough[~valid] = -np.inf
        # The last digits of a matrix product depend on where a row stands in it. So it only
        # rules rows out, with a margin, and the rest are scored one by one.
        n = len(vectors)
        cut = np.partition(rough, n - self.k, axis=0)[n - self.k] if n > self.k else -np.inf
        row, question = np.nonzero((rough >= np.maximum(cut, self.bar[which]) - 1e-9) & valid)
        if len(row):
            question = which[question]
            score = self._scores(vectors, row, question)
            order = np.lexsort((row, -score, question))
            best = order[_places(question[order]) < self.k]
            found = rows.select(self.carried).take(pa.array(row[best]))
            found = found.append_column("_question", pa.array(question[best], pa.int64()))
            self._keep(found.append_column("score", pa.array(score[best], pa.float64())))

    def _scores(self, vectors: np.ndarray, row: np.ndarray, question: np.ndarray) -> np.ndarray:
        size = np.sqrt((vectors * vectors).sum(axis=1))
        score = np.empty(len(row))
        step = max(1, SCORES_AT_ONCE // max(1, vectors.shape[1]))
        for start in range(0, len(row), step):
            part = slice(start, start + step)
            r, q = row[part], question[part]
            norms = size[r] * self.size[q]
            dots = (vectors[r] * self.raw[q]).sum(axis=1)
            score[part] = np.where(norms == 0.0, 0.0, dots / np.where(norms == 0.0, 1.0, norms))
        return np.round(score, SCORE_DECIMALS)

    def _keep(self, found: pa.Table) -> None:
        table = found if self.kept is None else pa.concat_tables([self.kept, found])
        keys = [("_question", "ascending"), ("score", "descending"), (self.carried[0], "ascending")]
        table = table.take(pc.sort_indices(table, sort_keys=keys, null_placement="at_start"))
        question = table.column("_question").to_numpy()
        place = _places(question)
        self.kept = table.filter(pa.array(place < self.k)).combine_chunks()
        last = place == self.k - 1
        self.bar[question[last]] = table.column("score").to_numpy()[last]

    def rows(self, ids: pa.Array, question_id: str) -> pa.Table | None:
        if self.kept is None:
            return None
        labels = ids.take(self.kept.column("_question").combine_chunks())
        labelled = self.kept.append_column(question_id, labels)
        return labelled.select([question_id, *self.carried, "score"])


def _places(question: np.ndarray) -> np.ndarray:
    """The place of each entry among the equal ones, in a sorted array."""
    return np.arange(len(question)) - np.searchsorted(question, question, side="left")


def _asked(questions: DataFrame, question_id: str, vector: str) -> DataFrame:
    return questions.select(
        question_id, F.col(vector).cast("array<double>").alias(vector)
    ).distinct()


def _offered(chunks: DataFrame, chunk_id: str, vector: str) -> DataFrame:
    """Chunks as they are scored: id, vector, and a number that tells vectors of one id apart."""
    return chunks.select(chunk_id, F.xxhash64(vector).alias("_vector_no"), vector)


def _partial_schema(questions: DataFrame, question_id: str, offered: DataFrame, chunk_id: str):
    return StructType(
        [
            StructField(question_id, questions.schema[question_id].dataType),
            StructField(chunk_id, offered.schema[chunk_id].dataType),
            StructField("_vector_no", LongType()),
            StructField("score", DoubleType()),
        ]
    )


def retrieve(
    questions: DataFrame,
    chunks: DataFrame,
    k: int = TOP_K,
    keep: Sequence[str] = (),
    question_id: str = "question_id",
    chunk_id: str = "chunk_id",
    vector: str = "embedding",
) -> DataFrame:
    """The k chunks closest to each question: ``question_id, rank, chunk_id, score`` and ``keep``.

    For a bounded set of questions: their vectors are read here, once, to ship them to the tasks,
    and more than ``MAX_QUESTIONS`` (or ``MAX_KEPT`` / k, or ``MAX_QUESTION_BYTES``) are an error;
    ``retrieve_grid`` takes any number. Chunks that share an id are ranked one by one, like any others.
    """
    asked, offered = _asked(questions, question_id, vector), _offered(chunks, chunk_id, vector)
    limit = max(1, min(MAX_QUESTIONS, MAX_KEPT // k))
    few = collect_vectors(asked, vector, limit, MAX_QUESTION_BYTES)
    if few is None:
        raise ValueError(f"more than {limit} questions, or vectors too large: use retrieve_grid")
    schema = _partial_schema(questions, question_id, offered, chunk_id)
    ids = few.column(question_id).combine_chunks()
    vectors = _matrix(few.column(vector))

    def best_of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(vectors, k, [chunk_id, "_vector_no"], vector)
        for batch in batches:
            if len(vectors) and batch.num_rows:
                best.show(pa.Table.from_batches([batch]))
        found = best.rows(ids, question_id)
        if found is not None:
            yield from found.to_batches()

    partial = offered.mapInArrow(best_of_task, schema)
    return _finalists(partial, chunks, k, keep, question_id, chunk_id, vector)


def retrieve_grid(
    questions: DataFrame,
    chunks: DataFrame,
    k: int = TOP_K,
    keep: Sequence[str] = (),
    question_id: str = "question_id",
    chunk_id: str = "chunk_id",
    vector: str = "embedding",
    cell_bytes: int = CELL_BYTES,
) -> DataFrame:
    """``retrieve`` for any number of questions.

    Every question meets every chunk in exactly one cell, and no cell grows with the data: a block
    of questions and a block of chunks take ``cell_bytes`` each, so that for a given size of cell the
    fewest vectors are copied. Copies of one chunk are counted first: any number of them is one row.
    """
    asked, offered = _asked(questions, question_id, vector), _offered(chunks, chunk_id, vector)
    counted = offered.groupBy(*offered.columns).agg(F.count(F.lit(1)).alias("_copies"))
    schema = _partial_schema(questions, question_id, offered, chunk_id)

    def blocks(df: DataFrame, rows_at_most: int) -> Column:
        """How many blocks the rows need, as a scalar that is worked out with the query."""
        n_bytes = F.sum(F.size(vector) * F.lit(8) + F.lit(ID_BYTES))
        by_bytes, by_rows = n_bytes / cell_bytes, F.count(F.lit(1)) / rows_at_most
        return df.agg(F.greatest(F.lit(1), F.ceil(by_bytes), F.ceil(by_rows)).cast("int")).scalar()

    def cell(names: Sequence[str], n: Column) -> Column:
        return F.pmod(F.xxhash64(*names), n.cast("bigint")).cast("int")

    def every(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    n_blocks = blocks(asked, max(1, MAX_KEPT // k))
    n_parts = blocks(offered, SCORES_AT_ONCE)
    left = counted.withColumn("_part", cell([chunk_id, "_vector_no"], n_parts))
    left = left.withColumn("_block", every(n_blocks))
    right = asked.withColumn("_block", cell([question_id, vector], n_blocks))
    right = right.withColumn("_part", every(n_parts))

    with_copies = StructType([*schema.fields, StructField("_copies", LongType())])
    empty = pa.table(
        {f.name: pa.array([], f.type) for f in to_arrow_schema(with_copies)}
    )

    def best_of_cell(rows: pa.Table, some: pa.Table) -> pa.Table:
        if not rows.num_rows or not some.num_rows:
            return empty
        best = _Best(_matrix(some.column(vector)), k, [chunk_id, "_vector_no", "_copies"], vector)
        best.show(rows.drop_columns(["_part", "_block"]))
        found = best.rows(some.column(question_id).combine_chunks(), question_id)
        return empty if found is None else found.select(with_copies.fieldNames())

    partial = (
        left.groupBy("_part", "_block")
        .cogroup(right.groupBy("_part", "_block"))
        .applyInArrow(best_of_cell, with_copies)
    )
    # More than k copies of one chunk can never all be ranked.
    each = F.explode(F.sequence(F.lit(1), F.least("_copies", F.lit(k)).cast("int")))
    partial = partial.withColumn("_copy", each).drop("_copies", "_copy")
    return _finalists(partial, chunks, k, keep, question_id, chunk_id, vector)


def _ranked(df: DataFrame, by: Sequence[str], k: int, *tie: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), *tie)
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _finalists(
    partial: DataFrame,
    chunks: DataFrame,
    k: int,
    keep: Sequence[str],
    question_id: str,
    chunk_id: str,
    vector: str,
) -> DataFrame:
    """The last ranking of what the tasks kept, and the columns to keep of the chunks it names.

    The finalists of a question grow with the number of tasks, so they are first cut down in
    groups of tasks; then a few per group meet in one place.
    """
    salted = partial.withColumn("_group", F.pmod(F.spark_partition_id(), F.lit(FINAL_GROUPS)))
    tie = (chunk_id, "_vector_no")
    cut_down = _ranked(salted, [question_id, "_group"], k, *tie).drop("_group", "rank")
    ranked = _ranked(cut_down, [question_id], k, *tie)
    if keep:
        # The n-th rank of a chunk that has copies gets its n-th copy.
        same = Window.partitionBy(question_id, *tie).orderBy("rank")
        ranked = ranked.withColumn("_copy", F.row_number().over(same))
        found = chunks.select(chunk_id, F.xxhash64(vector).alias("_vector_no"), *keep)
        found = found.join(ranked.select(*tie).distinct(), list(tie), "left_semi")
        copies = Window.partitionBy(*tie).orderBy(*keep)
        found = found.withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") <= k)
        ranked = ranked.join(found, [*tie, "_copy"])
    return ranked.select(question_id, "rank", chunk_id, "score", *keep)


def build_prompts(
    ranked: DataFrame,
    questions: DataFrame,
    question_id: str = "question_id",
    path: str = "source_path",
    title: str = "section_title",
    text: str = "chunk_text",
    question: str = "question",
    *,
    instruction: str,
) -> DataFrame:
    """One grounded prompt per question: instruction, the ranked chunks as context, the question.

    A question that found no chunk still gets its prompt, with an empty context.
    """
    block = F.format_string(CONTEXT_BLOCK, path, title, text)
    contexts = ranked.groupBy(question_id).agg(
        F.array_sort(F.collect_list(F.struct("rank", block.alias("block")))).alias("blocks")
    )
    context = F.coalesce(F.array_join(F.col("blocks.block"), "\n\n"), F.lit(""))
    prompt = F.concat(
        F.lit(f"{instruction}\n\n{CONTEXT_CUE}"),
        context,
        F.lit(f"\n\n{QUESTION_CUE}"),
        F.col(question),
        F.lit(f"\n\n{ANSWER_CUE}"),
    )
    return questions.join(contexts, question_id, "left").select(question_id, prompt.alias("prompt"))


def build_plain_prompts(
    questions: DataFrame,
    question_id: str = "question_id",
    question: str = "question",
    *,
    instruction: str,
) -> DataFrame:
    """One prompt per question without any context, to compare against."""
    prompt = F.concat(
        F.lit(f"{instruction}\n\n{QUESTION_CUE}"), F.col(question), F.lit(f"\n\n{ANSWER_CUE}")
    )
    return questions.select(question_id, prompt.alias("prompt"))


def format_sources(
    ranked: DataFrame,
    question_id: str = "question_id",
    path: str = "source_path",
    title: str = "section_title",
) -> DataFrame:
    """The citation line of each ranked chunk."""
    return ranked.select(
        question_id, "rank", source_line("rank", path, title, "score").alias("source_line")
    )


def evaluate_retrieval(
    ranked: DataFrame,
    expected: DataFrame,
    question_id: str = "question_id",
    source: str = "source",
) -> DataFrame:
    """Per question of ``expected``: whether an expected source was ranked, and 1 / its best rank."""
    pairs = expected.select(question_id, source).distinct()
    hits = ranked.join(pairs, [question_id, source], "left_semi")
    first = hits.groupBy(question_id).agg(F.min("rank").alias("first_rank"))
    return (
        pairs.select(question_id)
        .distinct()
        .join(first, question_id, "left")
        .select(
            question_id,
            F.col("first_rank").isNotNull().cast("int").alias("hit"),
            F.coalesce(F.lit(1.0) / F.col("first_rank"), F.lit(0.0)).alias("reciprocal_rank"),
        )
    )


def compare_retrieval(
    a: DataFrame,
    b: DataFrame,
    questions: DataFrame,
    k: int = TOP_K,
    question_id: str = "question_id",
    chunk_id: str = "chunk_id",
    vector: str = "embedding",
) -> DataFrame:
    """Two versions of an index side by side: chunks both rank per question, and mean scores."""

    def ranked(chunks: DataFrame, name: str) -> DataFrame:
        found = retrieve(
            questions, chunks, k, question_id=question_id, chunk_id=chunk_id, vector=vector
        )
        return found.select(question_id, chunk_id, "score", F.lit(name).alias("side"))

    def score_of(name: str) -> Column:
        return F.when(F.col("side") == name, F.col("score"))

    both = ranked(a, "a").unionByName(ranked(b, "b"))
    per_chunk = both.groupBy(question_id, chunk_id).agg(
        F.sum(score_of("a")).alias("sum_a"),
        F.count(score_of("a")).alias("n_a"),
        F.sum(score_of("b")).alias("sum_b"),
        F.count(score_of("b")).alias("n_b"),
    )

    def mean(side: str) -> Column:
        n = F.sum(f"n_{side}")
        return F.when(n > 0, F.sum(f"sum_{side}") / n).alias(f"mean_score_{side}")

    return per_chunk.groupBy(question_id).agg(
        F.sum(F.least("n_a", "n_b")).alias("overlap"), mean("a"), mean("b")
    )


ship_code(__name__)
