"""Retrieval queries, on the given vectors and on the chunk index of the documents.

Questions to the vectors are the mean vectors of the labels; questions to the index are the texts
of ``benchmark``. Scores are rounded for comparison after ranking.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import cosine
from ..operators import changelog as L
from ..operators import retrieval as R
from ..operators.embedding import hash_embed
from ..operators.neighbours import build_neighbour_index
from ..operators.neighbours import retrieve_index as retrieve_by_list
from ..plans.stored_index import StoredIndex
from ..workspace import shared_folder
from .corpus import CHUNKS, DIM, RUN_TS, hash_vectors_sql, markdown
from .registry import query, table

WIDTH = 64
SHOWN = ["source_path", "section_title", "chunk_text"]

# Instructions of the registered prompts.
GROUNDED = "Answer from the context below, and say so where it does not hold the answer."
PLAIN = "Answer the question."

MEANS = f"""
entries AS (
    SELECT vec_id, label, unnest(embedding)::DOUBLE AS value, generate_subscripts(embedding, 1) AS i
    FROM embeddings),
means AS (
    SELECT label, list(mean ORDER BY i) AS question
    FROM (SELECT label, i, avg(value) AS mean FROM entries GROUP BY label, i) GROUP BY label)"""


def cosine_sql(a: str, b: str) -> str:
    size = f"(sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b})))"
    return f"CASE WHEN {size} = 0 THEN 0.0 ELSE list_dot_product({a}, {b}) / {size} END"


def ranked_sql(corpus: str, name: str = "ranked") -> str:
    """Best three rows of ``corpus(vec_id, label, vector)`` per label mean."""
    return f"""
{name} AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, chunk_id) AS rank
        FROM (SELECT means.label AS question_id, c.vec_id AS chunk_id, c.label,
                     round({cosine_sql("means.question", "c.vector")}, {R.SCORE_DECIMALS}) AS score
              FROM means, ({corpus}) AS c))
    WHERE rank <= 3)"""


ALL_VECTORS = "SELECT vec_id, label, embedding::DOUBLE[] AS vector FROM embeddings"


def corpus(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").withColumnRenamed("vec_id", "chunk_id")


def label_means(spark: SparkSession, folder: str) -> DataFrame:
    """The mean vector of each label, in one aggregate without unfolding the vectors."""
    mean = F.array(*[F.avg(F.col("embedding")[i]) for i in range(WIDTH)])
    vectors = table(spark, folder, "embeddings")
    return vectors.groupBy(F.col("label").alias("question_id")).agg(mean.alias("embedding"))


@query(f"""
WITH {MEANS}
SELECT vec_id, label, round({cosine_sql("embedding::DOUBLE[]", "question")}, 6) AS score
FROM embeddings JOIN means USING (label)""")
def cosine_to_mean(spark, folder):
    """How close each vector is to the mean of its label."""
    means = label_means(spark, folder).select(
        F.col("question_id").alias("label"), F.col("embedding").alias("mean")
    )
    return (
        table(spark, folder, "embeddings")
        .join(means, "label")
        .select("vec_id", "label", F.round(cosine("embedding", "mean"), 6).alias("score"))
    )


@query(f"""
WITH {MEANS}, {ranked_sql(ALL_VECTORS)}
SELECT question_id, rank::INTEGER AS rank, chunk_id, label, round(score, 6) AS score FROM ranked""")
def retrieve_top3(spark, folder):
    found = R.retrieve(label_means(spark, folder), corpus(spark, folder), 3, ["label"])
    return found.withColumn("score", F.round("score", 6))


@query(f"""
WITH {MEANS}, {ranked_sql(ALL_VECTORS)}
SELECT question_id, rank::INTEGER AS rank, chunk_id, label, round(score, 6) AS score FROM ranked""")
def retrieve_index(spark, folder):
    """The same from a neighbour index: stored by list, and only lists that can hold a best one are read."""
    index = build_neighbour_index(corpus(spark, folder), shared_folder(spark))
    found = retrieve_by_list(label_means(spark, folder), index, 3, ["label"])
    return found.withColumn("score", F.round("score", 6))


@query(f"""
WITH {MEANS}, overall AS (
    SELECT list(mean ORDER BY i) AS question
    FROM (SELECT i, avg(value) AS mean FROM entries GROUP BY i))
SELECT vec_id AS chunk_id, label, round(score, 6) AS score
FROM (SELECT vec_id, label, round({cosine_sql("embedding::DOUBLE[]", "question")}, 12) AS score
      FROM embeddings, overall)
ORDER BY score DESC, chunk_id LIMIT 5""")
def retrieve_one(spark, folder):
    """One question, the mean of all vectors, against every vector."""
    mean = F.array(*[F.avg(F.col("embedding")[i]) for i in range(WIDTH)])
    question = table(spark, folder, "embeddings").agg(mean.alias("question")).scalar()
    found = R.nearest(corpus(spark, folder), question, 5)
    return found.select("chunk_id", "label", F.round("score", 6).alias("score"))


@query(f"""
WITH {MEANS}, {ranked_sql(ALL_VECTORS)}
SELECT question_id, max((label = question_id)::INTEGER) AS hit,
       coalesce(max(1.0::DOUBLE / rank) FILTER (label = question_id), 0.0) AS reciprocal_rank
FROM ranked GROUP BY question_id""")
def retrieval_eval(spark, folder):
    """Whether the mean of a label finds vectors of that label."""
    questions = label_means(spark, folder)
    ranked = R.retrieve(questions, corpus(spark, folder), 3, ["label"])
    expected = (
        table(spark, folder, "embeddings")
        .select(F.col("label").alias("question_id"), F.col("label").alias("source"))
        .distinct()
    )
    return R.evaluate_retrieval(ranked.withColumnRenamed("label", "source"), expected)


ON_DEV_INDEX = """
SELECT vec_id, label, CASE WHEN label < 3 THEN list_reverse(embedding) ELSE embedding END::DOUBLE[]
       AS vector
FROM embeddings WHERE label <> 9"""


@query(f"""
WITH {MEANS}, {ranked_sql(ALL_VECTORS, "a")}, {ranked_sql(ON_DEV_INDEX, "b")}
SELECT question_id, count(*) FILTER (a.chunk_id IS NOT NULL AND b.chunk_id IS NOT NULL) AS overlap,
       round(avg(a.score), 6) AS mean_score_a, round(avg(b.score), 6) AS mean_score_b
FROM a FULL JOIN b USING (question_id, chunk_id) GROUP BY question_id""")
def compare_retrieval(spark, folder):
    """An index on ``main`` against its ``dev`` branch, where vectors were changed and removed."""
    vectors = corpus(spark, folder)

    def commit(rows: DataFrame, branch: str, version: int, op: str) -> DataFrame:
        return rows.withColumns(
            {L.BRANCH: F.lit(branch), L.VERSION: F.lit(version).cast("bigint"), L.OP: F.lit(op)}
        )

    changed = vectors.where("label < 3").withColumn("embedding", F.reverse("embedding"))
    log = (
        commit(vectors, "main", 1, "I")
        .unionByName(commit(changed, "dev", 2, "U"))
        .unionByName(commit(vectors.where("label = 9"), "dev", 3, "D"))
    )
    forks = spark.sql("SELECT 'dev' AS branch, 1L AS fork_version")
    key = ["chunk_id"]
    compared = R.compare_retrieval(
        L.read_branch(log, key, columns=["embedding"]),
        L.read_branch(log, key, "dev", forks, ["embedding"]),
        label_means(spark, folder),
    )
    return compared.select(
        "question_id",
        "overlap",
        F.round("mean_score_a", 6).alias("mean_score_a"),
        F.round("mean_score_b", 6).alias("mean_score_b"),
    )


# Equal sections of one document share a chunk id, so the SQL tells chunks apart by a number.
RANKED_CHUNKS = f"""{CHUNKS},
each_chunk AS (
    SELECT *, row_number() OVER (ORDER BY source_path, section_no, chunk_index) AS chunk_no
    FROM chunks),
{hash_vectors_sql("c", "each_chunk", "chunk_no", "chunk_text")},
{hash_vectors_sql("q", "benchmark", "item_id", "text")},
c_size AS (SELECT chunk_no, sqrt(sum(value::DOUBLE * value)) AS size FROM c GROUP BY chunk_no),
q_size AS (SELECT item_id, sqrt(sum(value::DOUBLE * value)) AS size FROM q GROUP BY item_id),
dots AS (
    SELECT q.item_id, c.chunk_no, sum(q.value::DOUBLE * c.value) AS dot
    FROM q JOIN c USING (dim) GROUP BY q.item_id, c.chunk_no),
scores AS (
    SELECT benchmark.item_id, each_chunk.chunk_no, each_chunk.chunk_id,
           round(coalesce(dot / (q_size.size * c_size.size), 0.0), {R.SCORE_DECIMALS}) AS score
    FROM benchmark CROSS JOIN each_chunk LEFT JOIN dots USING (item_id, chunk_no)
    LEFT JOIN q_size USING (item_id) LEFT JOIN c_size USING (chunk_no)),
ranked AS (
    SELECT item_id AS question_id, rank, score, source_path, section_title, chunk_text
    FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, chunk_id) AS rank
          FROM scores) JOIN each_chunk USING (chunk_no)
    WHERE rank <= 3)"""


def benchmark_questions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "benchmark").select(
        F.col("item_id").alias("question_id"), F.col("text").alias("question")
    )


_STORED: dict[tuple[str, str], StoredIndex] = {}


def stored_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """The chunk index as a job keeps it: stored once a session, then read by every query."""
    key = spark.sparkContext.applicationId, folder
    if key not in _STORED:
        index = StoredIndex(spark, shared_folder(spark))
        index.update(markdown(spark, folder), RUN_TS)
        _STORED[key] = index
    return _STORED[key].chunks


def ranked_chunks(spark: SparkSession, folder: str) -> DataFrame:
    questions = hash_embed(benchmark_questions(spark, folder), "question", DIM)
    return R.retrieve(questions, stored_chunks(spark, folder), 3, SHOWN)


@query(f"""
WITH {RANKED_CHUNKS}
SELECT question_id, rank::INTEGER AS rank, source_path, section_title, chunk_text,
       round(score, 6) AS score
FROM ranked""")
def retrieve_grid(spark, folder):
    """Every benchmark text against the whole chunk index, in small cells of the grid."""
    questions = hash_embed(benchmark_questions(spark, folder), "question", DIM)
    found = R.retrieve_grid(questions, stored_chunks(spark, folder), 3, SHOWN, cell_bytes=4 << 20)
    return found.select("question_id", "rank", *SHOWN, F.round("score", 6).alias("score"))


@query(f"""
WITH {RANKED_CHUNKS}
SELECT benchmark.item_id AS question_id,
       '{GROUNDED}' || chr(10) || chr(10) ||
       'Contexto recuperado:' || chr(10) || context || chr(10) || chr(10) ||
       'Pregunta:' || chr(10) || text || chr(10) || chr(10) || 'Respuesta:' AS prompt
FROM benchmark JOIN (
    SELECT question_id AS item_id, string_agg(
        'Fuente: ' || source_path || ' :: ' || section_title || chr(10) || chunk_text,
        chr(10) || chr(10) ORDER BY rank) AS context
    FROM ranked GROUP BY question_id) USING (item_id)""")
def grounded_prompts(spark, folder):
    return R.build_prompts(ranked_chunks(spark, folder), benchmark_questions(spark, folder), instruction=GROUNDED)


@query(f"""
SELECT item_id AS question_id, '{PLAIN}' || chr(10) || chr(10) ||
       'Pregunta:' || chr(10) || text || chr(10) || chr(10) || 'Respuesta:' AS prompt
FROM benchmark""")
def plain_prompts(spark, folder):
    return R.build_plain_prompts(benchmark_questions(spark, folder), instruction=PLAIN)


@query(f"""
WITH {RANKED_CHUNKS}
SELECT question_id, rank::INTEGER AS rank,
       format('{{}}. {{}} :: {{}} (score={{:.3f}})', rank, source_path, section_title, score)
           AS source_line
FROM ranked""")
def source_lines(spark, folder):
    return R.format_sources(ranked_chunks(spark, folder))
