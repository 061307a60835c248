"""Best-fit packing of token sequences, by hierarchical residual packing.

Tasks pack their own pieces best-fit decreasing and emit bins that are nearly full. All underfull bins go
on as items: they are dealt anew to as few tasks as ``ITEMS_PER_TASK`` allows, at most an eighth as many as
before, and packed again, and so on up a tree. It ends in one task, or when a round over several tasks
makes no fewer bins than it was given: what is left then cannot be joined, and is emitted as it is.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokens
from .common import buckets_for, ship, stored, work_folder
from .tokens import ids_of_all

ship(__name__, tokens.__name__)

FAN_IN = 8
ITEMS_PER_TASK = 50_000
BATCH_BYTES = 4 << 20

PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids: all but the first have ``size`` ids."""
    first = n % size or min(n, size)
    return [(0, first)] + [(s, size) for s in range(first, n, size)]


def token_pieces(docs: DataFrame, path: str, end_id: int, size: int) -> DataFrame:
    """Every document's ids and the end id, cut into pieces of at most ``size`` ids.

    A null text is empty, so its only piece is the end id; a null ``doc_id`` stays null and repeated
    rows stay apart. Other columns are not read. ``ids`` holds little-endian unsigned 32-bit ids.
    """
    end = int(end_id).to_bytes(4, "little")
    schema = pa.schema(
        [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]
    )

    def run(batches):
        rows, held = [], 0
        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), ids_of_all(path, (v.as_py() for v in batch.column(1)))):
                ids += end
                for piece, (start, length) in enumerate(cut(len(ids) // 4, size)):
                    rows.append((doc, piece, start, length, ids[4 * start : 4 * (start + length)]))
                held += len(ids) + 64
                if held >= BATCH_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: the bin and the place in it of each item, and the fill of each bin."""
    bins, places, fills = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), []
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    some = 0  # bit f: a bin has f free
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fitting = some >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                some &= ~(1 << room)
        else:
            room, b = capacity, len(fills)
            fills.append(0)
        bins[i], places[i] = b, fills[b]
        fills[b] += size
        free[room - size].append(b)
        some |= 1 << (room - size)
    return bins, places, np.array(fills, np.int64)


def _packer(capacity: int, nearly: int, level: int, last: bool):
    """Pack the bins of a task into new ones. Rows of a bin share ``sequence_id`` and ``fill``."""

    def run(batches):
        batches = list(batches)
        if not batches:
            return
        rows = pa.Table.from_batches(batches)
        if not rows.num_rows:
            return
        old = rows["sequence_id"].to_numpy()
        fill = rows["fill"].to_numpy()
        _, first, of = np.unique(old, return_index=True, return_inverse=True)
        bins, places, fills = best_fit(fill[first], capacity)
        is_open = (fills < capacity - nearly) & (not last)
        base = (level << 52) | (TaskContext.get().partitionId() << 32)
        new = {
            "sequence_id": base + bins[of],
            "offset": rows["offset"].to_numpy() + places[of],
            "fill": fills[bins[of]],
            "open": is_open[bins[of]],
        }
        for name, values in new.items():
            i = rows.schema.get_field_index(name)
            rows = rows.set_column(i, rows.schema.field(i), pa.array(values, rows.schema.field(i).type))
        yield from rows.combine_chunks().to_batches(max_chunksize=50_000)

    return run


def pack(pieces: DataFrame, capacity: int, folder: str, nearly: int | None = None) -> DataFrame:
    """Every row of ``pieces`` with ``sequence_id`` and ``offset``: as few sequences as it can.

    ``pieces`` needs ``length`` from 1 to ``capacity`` and may have any other columns; it is read
    more than once, so it should be stored. ``folder`` takes a table for each level of the tree.
    Rows of one sequence follow each other without a gap from offset 0. No rows give no rows.
    """
    clash = {"sequence_id", "offset", "fill", "open"} & set(pieces.columns)
    if clash:
        raise ValueError(f"pieces already have {sorted(clash)}")
    nearly = max(1, capacity // 128) if nearly is None else nearly
    whole = pieces.filter(F.col("length") == capacity)
    parts = pieces.filter(F.col("length") != capacity)
    full = whole.withColumns(
        {"sequence_id": F.monotonically_increasing_id().bitwiseOR(F.lit(1 << 62)), "offset": F.lit(0).cast("long")}
    )
    n = buckets_for(parts.count(), per_bucket=ITEMS_PER_TASK)
    # F.raise_error instead of a silent misfit
    size = F.when(F.col("length").between(1, capacity), F.col("length").cast("long")).otherwise(
        F.raise_error(F.lit("a piece must have 1 to capacity ids")).cast("long")
    )
    items = parts.repartition(n).withColumns(
        {"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("long"), "fill": size, "open": F.lit(True)}
    )
    done, level, given = [], 0, None
    while True:
        run = _packer(capacity, nearly, level, last=n == 1)
        level_rows = stored(items.mapInArrow(run, items.schema), folder, f"level{level}")
        closed, left = level_rows.filter(~F.col("open")), level_rows.filter("open")
        done.append(closed)
        if n == 1:
            break
        bins = level_rows.filter(F.col("offset") == 0).agg(F.count("*").alias("made"), F.count_if("open").alias("open")).first()
        if not bins["open"] or (given is not None and bins["made"] >= given):
            done.append(left)
            break
        given = bins["open"]
        n, level = min(buckets_for(given, per_bucket=ITEMS_PER_TASK), -(-n // FAN_IN)), level + 1
        items = left.repartition(n, F.xxhash64("sequence_id", F.lit(level)))
    out = full
    for rows in done:
        out = out.unionByName(rows.drop("fill", "open"))
    return out


def pack_documents(docs: DataFrame, path: str, end_id: int = 2, size: int = 1024, with_ids: bool = False) -> DataFrame:
    """Documents tokenized, cut and packed: a row for each piece with its place in a sequence.

    ``with_ids`` keeps the ids of each piece; otherwise their crc32 only. Cases as in ``token_pieces``.
    """
    spark = docs.sparkSession
    folder = work_folder(spark, "pack")
    pieces = token_pieces(docs, path, end_id, size).withColumn("ids_crc32", F.crc32("ids"))
    pieces = stored(pieces if with_ids else pieces.drop("ids"), folder, "pieces")
    return pack(pieces, size, folder)
