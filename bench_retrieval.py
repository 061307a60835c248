"""Top-3 retrieval against collecting the corpus and looping over it, as the corpus grows.

Prints one JSON line. The corpus is the ``embeddings`` table, whole, repeated 1, 10 and 100 times
under new ids; the questions are the mean vectors of its labels.
"""

from __future__ import annotations

import heapq
import json
import math
import time

from pyspark.sql import functions as F

from bench import FOLDER, session
from ledgerlake.operators.retrieval import retrieve
from ledgerlake.queries.retrieval import corpus, label_means
from ledgerlake.workspace import shared_folder


def loop(questions, chunks, k):
    """One driver, one thread, every pair: what a first version of such a job does."""
    corpus = [(row["chunk_id"], row["embedding"]) for row in chunks.collect()]
    found = []
    for question in questions.collect():
        asked = question["embedding"]

        def closeness(chunk):
            lengths = math.hypot(*asked) * math.hypot(*chunk[1])
            return math.sumprod(asked, chunk[1]) / lengths if lengths else 0.0

        best = heapq.nlargest(k, corpus, key=closeness)
        found += [(question["question_id"], chunk_id) for chunk_id, _ in best]
    return found


def main() -> None:
    spark = session()
    questions = label_means(spark, FOLDER)
    seconds = {}
    for copies in (1, 10, 100):
        path = shared_folder(spark)
        many = corpus(spark, FOLDER).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
        many = many.withColumn("chunk_id", F.col("chunk_id") * 1000 + F.col("copy")).drop("copy")
        many.repartition(8).write.parquet(path)
        chunks = spark.read.parquet(path)
        start = time.perf_counter()
        slow = loop(questions, chunks, 3)
        seconds[f"loop_x{copies}"] = round(time.perf_counter() - start, 2)
        times = []
        for _ in range(3):
            start = time.perf_counter()
            fast = retrieve(questions, chunks, 3).collect()
            times.append(time.perf_counter() - start)
        seconds[f"retrieve_x{copies}"] = round(sorted(times)[1], 2)
        assert len(fast) == len(slow)
    print(json.dumps({"metric": "top-3 retrieval", "unit": "sec", "seconds": seconds}))
    spark.stop()


if __name__ == "__main__":
    main()
