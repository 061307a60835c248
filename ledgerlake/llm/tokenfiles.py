"""Token ids in files of independent zstandard frames with a seek table.

A file is a run of frames, each a whole zstandard frame with its own content checksum; then a
skippable frame with the directory of documents; then the seek table, a skippable frame in the public
seekable layout (sizes and a checksum for every frame, and a footer), so a reader takes the end of the
file first and then only the frames it wants. A document never crosses frames.

Directory, little-endian: count of documents (u32), bytes of an id (u32), then for each document its
doc_id (i64), whether it is null (u8), its frame (u32), its first id in the frame (u32) and its number
of ids (u32), each as one column.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import tokens
from .common import ship, stored
from .tokens import ids_of_all

ship(__name__, tokens.__name__)

# Fixed values of the public zstandard seekable format.
SEEK_TABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
HAS_CHECKSUMS = 0x80
FOOTER_BYTES = 9
DIRECTORY_MAGIC = 0x184D2A50

FRAME_BYTES = 1 << 20
LEVEL = 1


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI in any store that Arrow knows, or of a local path.

    Hadoop's names of one store, ``s3a`` and ``s3n``, are Arrow's ``s3``.
    """
    scheme, _, rest = uri.partition("://")
    if scheme in ("s3a", "s3n"):
        uri = f"s3://{rest}"
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


class Writer:
    """Appends documents to one file; ``close`` writes directory and seek table."""

    def __init__(self, out, width: int, frame_bytes: int = FRAME_BYTES):
        self.out, self.width, self.frame_bytes = out, width, frame_bytes
        self.zstd = zstandard.ZstdCompressor(level=LEVEL, write_checksum=True, write_content_size=True)
        self.docs: list[tuple] = []
        self.frames: list[tuple[int, int, int]] = []
        self.held: list[bytes] = []
        self.held_ids = 0
        self.n_ids = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((doc_id or 0, doc_id is None, len(self.frames), self.held_ids, len(ids)))
        self.held.append(ids.astype(f"<u{self.width}").tobytes())
        self.held_ids += len(ids)
        self.n_ids += len(ids)
        if self.held_ids * self.width >= self.frame_bytes:
            self._end_frame()

    def _end_frame(self) -> None:
        if not self.held:
            return
        raw = b"".join(self.held)
        packed = self.zstd.compress(raw)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.out.write(packed)
        self.held, self.held_ids = [], 0

    def close(self) -> None:
        self._end_frame()
        columns = list(zip(*self.docs)) or [()] * 5
        kinds = ("<i8", "u1", "<u4", "<u4", "<u4")
        body = struct.pack("<II", len(self.docs), self.width)
        body += b"".join(np.array(c, k).tobytes() for c, k in zip(columns, kinds))
        self.out.write(struct.pack("<II", DIRECTORY_MAGIC, len(body)) + body)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), HAS_CHECKSUMS, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SEEK_TABLE_MAGIC, len(table)) + table)
        self.out.close()


@dataclass
class Reader:
    """Random access to one file: reads its end, then the frames that are asked for."""

    source: object

    def __post_init__(self):
        size = self.source.size()
        self.source.seek(size - FOOTER_BYTES)
        n, flags, magic = struct.unpack("<IBI", self.source.read(FOOTER_BYTES))
        if magic != SEEKABLE_MAGIC or flags != HAS_CHECKSUMS:
            raise ValueError("not a seekable file")
        start = size - FOOTER_BYTES - 12 * n
        self.source.seek(start)
        self.frames = np.frombuffer(self.source.read(12 * n), "<u4").reshape(-1, 3)
        self.places = np.concatenate([[0], np.cumsum(self.frames[:, 0], dtype=np.int64)])
        at = int(self.places[-1])
        self.source.seek(at)
        magic, length = struct.unpack("<II", self.source.read(8))
        if magic != DIRECTORY_MAGIC or at + 8 + length + 8 != start:
            raise ValueError("the directory is damaged")
        body = self.source.read(length)
        count, self.width = struct.unpack_from("<II", body)
        at, columns = 8, []
        for kind in ("<i8", "u1", "<u4", "<u4", "<u4"):
            columns.append(np.frombuffer(body, kind, count, at))
            at += columns[-1].nbytes
        self.doc_ids, self.nulls, self.doc_frames, self.firsts, self.counts = columns

    def frame(self, i: int) -> np.ndarray:
        """The ids of one frame, checked against both of its checksums."""
        self.source.seek(int(self.places[i]))
        raw = zstandard.ZstdDecompressor().decompress(self.source.read(int(self.frames[i, 0])))
        if len(raw) != self.frames[i, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.frames[i, 2]:
            raise ValueError(f"frame {i} is damaged")
        return np.frombuffer(raw, f"<u{self.width}")

    def documents(self, wanted: set[int] | None = None):
        """(doc_id, ids) in file order; with ``wanted`` only the frames of those ids are read."""
        rows = range(len(self.doc_ids))
        if wanted is not None:
            rows = np.flatnonzero(np.isin(self.doc_ids, list(wanted)) & (self.nulls == 0)).tolist()
        at, ids = -1, None
        for row in rows:
            if self.doc_frames[row] != at:
                at = int(self.doc_frames[row])
                ids = self.frame(at)
            first = int(self.firsts[row])
            yield None if self.nulls[row] else int(self.doc_ids[row]), ids[first : first + int(self.counts[row])]


def write_token_files(docs: DataFrame, path: str, end_id: int, folder: str, width: int = 2, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """Write the ids of all documents, in ascending ``doc_id``, and return the table of files.

    A null text is empty, so it has the end id only; a null ``doc_id`` comes first; rows with one
    ``doc_id`` follow each other in the order of their texts; no rows give no files. Other columns are
    not read. Files come from one range of ids each: a task writes under a name of its own attempt, and
    the name goes into the table only if the attempt succeeds, so lost executors leave no half-read file.
    """
    spark = docs.sparkSession
    root = f"{folder}/files"
    end = np.array([end_id], "<u4")

    def run(batches):
        context = TaskContext.get()
        writer, name, first, n_docs = None, "", None, 0
        for batch in batches:
            texts = (v.as_py() for v in batch.column(1))
            for doc, packed in zip(batch.column(0).to_pylist(), ids_of_all(path, texts)):
                if writer is None:
                    fs, base = file_system(root)
                    fs.create_dir(base, recursive=True)
                    name = f"tokens-{context.partitionId():06d}-{context.taskAttemptId()}.zst"
                    writer, first = Writer(fs.open_output_stream(f"{base}/{name}", compression=None), width, frame_bytes), doc
                ids = np.concatenate([np.frombuffer(packed, "<u4"), end])
                if width < 4 and len(ids) and int(ids.max()) >> (8 * width):
                    raise ValueError("the vocabulary needs wider ids")
                writer.add(doc, ids)
                n_docs += 1
        if writer is not None:
            writer.close()
            row = [context.partitionId()], [name], [n_docs], [writer.n_ids]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, (pa.int32(), pa.string(), pa.int64(), pa.int64()))], names=["part", "file", "n_docs", "n_ids"])

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .repartitionByRange(n, F.col("doc_id").asc_nulls_first())
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    )
    files = stored(ordered.mapInArrow(run, "part int, file string, n_docs long, n_ids long"), folder, "manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))


def read_token_files(spark: SparkSession, folder: str, files: DataFrame, doc_ids: list[int] | None = None) -> DataFrame:
    """(doc_id, start, ids) from the files: all documents, or only the frames of some of them.

    ``ids`` is little-endian unsigned 32-bit; ``start`` counts the ids of all documents before.
    """
    root = f"{folder}/files"
    wanted = None if doc_ids is None else set(doc_ids)

    def run(batches):
        for batch in batches:
            for file, start in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                fs, base = file_system(root)
                with fs.open_input_file(f"{base}/{file}") as source:
                    reader = Reader(source)
                    starts = start + np.concatenate([[0], np.cumsum(reader.counts, dtype=np.int64)])
                    keep = range(len(reader.doc_ids))
                    if wanted is not None:
                        keep = np.flatnonzero(np.isin(reader.doc_ids, list(wanted)) & (reader.nulls == 0)).tolist()
                    rows, held = [], 0
                    for row, (doc, ids) in zip(keep, reader.documents(wanted)):
                        rows.append((doc, int(starts[row]), ids.astype("<u4").tobytes()))
                        held += 4 * len(ids) + 64
                        if held >= 4 << 20:
                            yield _batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows)

    def _batch(rows):
        kinds = (pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["doc_id", "start", "ids"])

    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    named = files.select("file", "start").repartition(n, "file")
    return named.mapInArrow(run, "doc_id long, start long, ids binary")
