"""Quality rules, with an isolation forest over their statistics.

Every text is counted (words, symbols, repeated lines and windows) and fails outright by two fixed rules.
For the others a forest of random splits over rates of these counts gives a path length: what few splits
set apart is anomalous. Trees are grown, as the method has it, on samples of 128 rows, drawn from a bounded
pool of labelled rows whose labels they do not see. The score from which on a document goes is then
calibrated on all labelled rows: the one that catches most of label 0 while it costs at most a set share of
label 1. Rows that are held out lend neither the pool nor the calibration anything.

Repeated lines are counted but are no feature: in the labelled rows they mark good texts as often as poor ones.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored, work_folder
from .quality import held_out

ship(__name__)

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\v\f\r"
#: Each byte as what it is: white space, a symbol, part of a letter or digit, or another mark.
KINDS = bytes(32 if i in SPACES else 35 if i in SYMBOLS else 97 if chr(i).isalnum() or i > 127 else 46 for i in range(256))
UPPER, LETTERS, CALLS = bytes(range(65, 91)), bytes((*range(65, 91), *range(97, 123))), b"!?"
WINDOW = 3
LEAST_WORDS = 50
MOST_REPEATED = 50

TREES, SAMPLE = 100, 128
#: Labelled rows that trees draw their samples from, at most.
POOL = 16_384
#: The share of label 1 that a threshold may cost.
MAX_LOSS = 0.01
STEPS = 4096

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = 7


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of three that the text holds twice or more, the first ones included."""
    n = len(words)
    if n <= WINDOW:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, n)
    window = ids
    for i in range(1, WINDOW):  # numbered anew at each step, so that no product overflows
        _, window = np.unique(window[:-1] * np.int64(len(numbers)) + ids[i:], return_inverse=True)
    repeated = np.flatnonzero(np.bincount(window)[window] > 1)
    inside = np.zeros(n, bool)
    for i in range(WINDOW):
        inside[repeated + i] = True
    return int(inside.sum())


def count(text: str) -> tuple[list[int], list[float]]:
    """The five counts of a text, and the rates that the forest sees: symbols by character, capitals by letter,

    and by word: repeated ones, characters, calls (``!`` and ``?``), words with symbols, and words of marks only.
    """
    data = text.encode()
    words = data.split()
    n = len(words)
    bare = b"".join(words)
    chars = len(bare.decode())
    lines = [line for line in data.split(b"\n") if line.strip()]
    symbols = len(data) - len(data.translate(None, SYMBOLS))
    repeated = repeated_words(words)
    upper = len(data) - len(data.translate(None, UPPER))
    letters = len(data) - len(data.translate(None, LETTERS))
    calls = len(data) - len(data.translate(None, CALLS))
    patterns = Counter(data.translate(KINDS).split())
    marked = sum(k for p, k in patterns.items() if b"#" in p)
    empty = sum(k for p, k in patterns.items() if b"a" not in p)
    counts = [n, chars, symbols, len(lines) - len(set(lines)), repeated]
    by_word = [v / max(n, 1) for v in (repeated, chars, calls, marked, empty)]
    return counts, [symbols / max(chars, 1), upper / max(letters, 1), *by_word]


def rule_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, the five counts, base_failed, x) of every row; ``x`` holds the rates as 64-bit floats."""
    names = ["doc_id", *COUNTS, "x"]

    def run(batches):
        for batch in batches:
            found = [count(v.as_py() or "") for v in batch.column(1)]
            counts = np.array([c for c, _ in found], np.int64).reshape(-1, len(COUNTS))
            x = pa.array([np.array(f).tobytes() for _, f in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c) for c in counts.T.copy()], x], names=names)

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", x binary"
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, schema).withColumn("base_failed", failed)


def expected_path(n: int) -> float:
    """The mean path length of an unsuccessful search among ``n`` rows."""
    if n < 2:
        return 0.0
    return 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n


@dataclass(frozen=True)
class Forest:
    """Trees as arrays: the feature and value of a split, its two children, and at a leaf (feature -1) its path."""

    feature: np.ndarray
    value: np.ndarray
    children: np.ndarray
    path: np.ndarray
    roots: np.ndarray
    sample: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """2 to the minus mean path over expected path: near 1 is anomalous. Without trees, 0."""
        if not len(self.roots):
            return np.zeros(len(x))
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            while True:
                split = self.feature[node]
                inner = split >= 0
                if not inner.any():
                    break
                right = x[rows, split] >= self.value[node]
                node = np.where(inner, self.children[node, right.astype(np.int8)], node)
            total += self.path[node]
        return 2.0 ** (-total / len(self.roots) / max(expected_path(self.sample), 1e-9))


def grow(pool: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = 42) -> Forest:
    """A forest over a pool of rows: random features split at random values, down to the usual depth."""
    rng = np.random.default_rng(seed)
    sample = min(sample, len(pool))
    deepest = int(np.ceil(np.log2(max(sample, 2))))
    nodes: list[list] = []
    roots = []

    def add(rows: np.ndarray, depth: int) -> int:
        at = len(nodes)
        nodes.append([-1, 0.0, 0, 0, depth + expected_path(len(rows))])
        low, high = rows.min(0), rows.max(0)
        usable = np.flatnonzero(high > low)
        if depth < deepest and len(rows) > 1 and len(usable):
            f = int(rng.choice(usable))
            value = float(rng.uniform(low[f], high[f]))
            right = rows[:, f] >= value
            nodes[at][:4] = f, value, add(rows[~right], depth + 1) if not right.all() else at, 0
            if right.all():  # the value drawn was the least one itself
                nodes[at][0] = -1
            else:
                nodes[at][3] = add(rows[right], depth + 1)
        return at

    for _ in range(trees if sample > 1 else 0):
        roots.append(add(pool[rng.choice(len(pool), sample, replace=False)], 0))
    columns = list(zip(*nodes)) or [()] * 5
    return Forest(
        np.array(columns[0], np.int64), np.array(columns[1], float), np.array(columns[2:4], np.int64).reshape(2, -1).T.copy(),
        np.array(columns[4], float), np.array(roots, np.int64), sample,
    )


def _x(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, FEATURES)


def with_anomaly(rows: DataFrame, forest: Forest) -> DataFrame:
    """``rows`` (with ``x`` as the last column) with ``anomaly`` in its place."""
    names = rows.columns[:-1]

    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(forest.scores(_x(batch.column(len(names)))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], scores], names=[*names, "anomaly"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(run, f"{schema}, anomaly double")


def calibrated(labelled: DataFrame, max_loss: float = MAX_LOSS) -> float:
    """The threshold over rows (quality, anomaly), by counts in steps of the score; above 1 where none is worth it."""
    step = F.floor(F.col("anomaly") * STEPS).cast("int").alias("step")
    counts = np.zeros((2, STEPS + 1))
    for r in labelled.groupBy("quality", step).count().collect():
        counts[r["quality"], r["step"]] = r["count"]
    if not counts.sum(1).all():
        return 2.0
    lost, caught = (c[::-1].cumsum()[::-1] / c.sum() for c in counts[::-1])
    gain = np.where(lost <= max_loss, caught - lost, -1.0)
    best = int(gain.argmax())
    return best / STEPS if gain[best] > 0 else 2.0


def judge_documents(docs: DataFrame, labels: DataFrame, max_loss: float = MAX_LOSS) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, anomaly) of every row.

    A null text has no words, so it fails. Without labels of both kinds to calibrate on, only the fixed rules
    decide. Of several labels of one id the smallest counts, other values than 0 and 1 do not; a null id has no
    label. Repeated rows and null ids each have their result; other columns are not read. No rows give no rows.
    """
    folder = work_folder(docs.sparkSession, "rules")
    rows = stored(rule_statistics(docs), folder, "statistics")
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.min("quality").cast("int").alias("quality")
    )
    learnt = rows.where(~F.col("base_failed") & ~held_out(F.col("doc_id"))).select("doc_id", "x").join(known, "doc_id")
    learnt = stored(learnt.select("quality", F.xxhash64("doc_id").alias("drawn"), "x"), folder, "labelled")
    share = min(1.0, 1.2 * POOL / max(learnt.count(), 1))  # so that no task sorts many times the pool
    some = learnt.where(F.col("drawn") <= int(share * (1 << 64)) - (1 << 63) - 1) if share < 1 else learnt
    pool = some.orderBy("drawn", "x").limit(POOL).select("x").toArrow()
    forest = grow(_x(pool.column(0)) if pool.num_rows else np.empty((0, FEATURES)))
    threshold = calibrated(with_anomaly(learnt.select("quality", "x"), forest), max_loss)
    judged = with_anomaly(rows.select("doc_id", *COUNTS, "base_failed", "x"), forest)
    kept = ~F.col("base_failed") & (F.col("anomaly") < threshold)
    return judged.select("doc_id", *COUNTS, "base_failed", kept.alias("kept"), "anomaly")
