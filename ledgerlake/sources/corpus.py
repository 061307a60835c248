"""A corpus of files as a Python data source: every file is seen, also one without any bytes.

Files are listed once, in order, and packed into partitions by size, so that many small files are one task and
a large one has its own; a task opens its files one after another and hands out bounded batches. The store is
any that Arrow knows: a local path, or a URI of ``s3`` (also ``s3a``), ``gs``, ``hdfs`` or ``file``.

``register(spark)`` once, then ``spark.read.format("corpus").load(path)``. Options: ``suffix`` (only files that end
so), ``contentless`` (paths, sizes and times only; no file is opened), ``partitionBytes``, ``relative`` (paths below the
folder that is read, in any store).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..workspace import ship_code

PARTITION_BYTES = 64 << 20
#: What opening a file costs, as bytes, so that very many empty files are spread as well.
OPEN_BYTES = 64 << 10
BATCH_BYTES = 8 << 20

TEXTS = "source_path string, size bigint, modified timestamp, text string"
FILES = "source_path string, size bigint, modified timestamp"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a URI, or of a local path."""
    scheme, _, rest = uri.partition("://")
    if scheme in ("s3a", "s3n"):
        uri = f"s3://{rest}"
    if uri.startswith("file:"):
        uri = "/" + uri.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(uri)


@dataclass
class Files(InputPartition):
    """Files of one task: path, size, time."""

    files: list[tuple]


def packed(files: list[tuple], partition_bytes: int) -> list[Files]:
    """Files in order, cut where a partition is full."""
    out, size = [], 0
    for file in files:
        cost = file[1] + OPEN_BYTES
        if not out or size + cost > partition_bytes:
            out.append(Files([]))
            size = 0
        out[-1].files.append(file)
        size += cost
    return out


class CorpusReader(DataSourceReader):
    def __init__(self, options: dict, contentless: bool):
        self.path = options["path"]
        self.suffix = options.get("suffix", "")
        self.relative = str(options.get("relative", "false")).lower() == "true"
        self.partition_bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        self.contentless = contentless

    def partitions(self) -> list[Files]:
        system, base = file_system(self.path)
        found = [system.get_file_info(base)]
        if found[0].type == pafs.FileType.Directory:
            found = system.get_file_info(pafs.FileSelector(base, recursive=True))
        elif found[0].type == pafs.FileType.NotFound:
            raise FileNotFoundError(self.path)
        kept = [f for f in found if f.type == pafs.FileType.File and f.path.endswith(self.suffix)]
        hidden = lambda path: any(p[:1] in "._" for p in path[len(base) :].split("/") if p)
        return packed(sorted((f.path, f.size, f.mtime) for f in kept if not hidden(f.path)), self.partition_bytes) or [Files([])]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        system, base = file_system(self.path)
        cut = len(base.rstrip("/")) + 1 if self.relative else 0
        kinds = [pa.string(), pa.int64(), pa.timestamp("us", "UTC")] + ([] if self.contentless else [pa.string()])
        names = ["source_path", "size", "modified", "text"][: len(kinds)]
        rows, held = [], 0
        for path, size, modified in partition.files:
            row = (path[cut:], size, modified)
            if not self.contentless:
                with system.open_input_stream(path) as file:
                    row += (file.read().decode("utf-8", "replace"),)
            rows.append(row)
            held += 64 + (0 if self.contentless else size)
            if held >= BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


class CorpusSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "corpus"

    def _contentless(self) -> bool:
        return str(self.options.get("contentless", "false")).lower() == "true"

    def schema(self) -> str:
        return FILES if self._contentless() else TEXTS

    def reader(self, schema) -> CorpusReader:
        return CorpusReader(self.options, self._contentless())


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CorpusSource)


def read_corpus(spark: SparkSession, path: str, relative: bool = False, suffix: str = "") -> DataFrame:
    """(source_path, text) of every file below ``path``, empty ones too, in any number per task."""
    register(spark)
    return spark.read.format("corpus").options(relative=relative, suffix=suffix).load(path).select("source_path", "text")


def list_corpus(spark: SparkSession, path: str, relative: bool = False, suffix: str = "") -> DataFrame:
    """(source_path, size, modified) of every file below ``path``; none is opened."""
    register(spark)
    return spark.read.format("corpus").options(relative=relative, suffix=suffix, contentless=True).load(path)


def write_corpus(df: DataFrame, path: str, name: str = "source_path", text: str = "text") -> int:
    """Write each row of ``df`` as a file below ``path``; a null text is an empty file. Returns their number.

    Names must be unique. A file that a lost task had begun is written again under the same name.
    """

    def run(batches):
        system, base = file_system(path)
        made, n = set(), 0
        for batch in batches:
            for file, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                folder = f"{base}/{file}".rpartition("/")[0]
                if folder not in made:
                    system.create_dir(folder, recursive=True)
                    made.add(folder)
                with system.open_output_stream(f"{base}/{file}", compression=None) as out:
                    out.write((content.as_py() or "").encode())
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], names=["n"])

    return df.select(name, text).mapInArrow(run, "n bigint").agg({"n": "sum"}).first()[0] or 0


ship_code(__name__)
