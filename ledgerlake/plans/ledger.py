"""A ledger of runs: what each step was made from, so that a run goes on where the last one stopped.

A step's key is a digest of its name, of its parameters and of the keys of what it reads; the key of files is made
of their names, sizes and times, that of a table of its rows, whatever their order. A step whose key is in the ledger
is up to date and is not run again. The row is written after the step's table, so a run that failed repeats the step
it failed in and those after it, and no others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.history import exists

ROWS = "step string, made_from string, at timestamp"


def digest(*parts: object) -> str:
    return hashlib.sha256("\x1f".join(map(str, parts)).encode()).hexdigest()


def key_of_files(spark: SparkSession, path: str) -> str:
    """A digest of names, sizes and times of the files at a path or below it; a missing path is an error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        raise FileNotFoundError(path)
    files, found = system.listFiles(place, True), []
    while files.hasNext():
        status = files.next()
        found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return digest(*sorted(found))


def key_of_rows(df: DataFrame) -> str:
    """A digest of the rows of ``df`` in any order, in one aggregate."""
    h = F.xxhash64(F.to_json(F.struct("*")))
    total = F.sum(h.cast("decimal(20,0)"))
    row = df.agg(F.count(F.lit(1)).alias("n"), total.alias("total"), F.bit_xor(h).alias("mixed")).first()
    return digest(df.schema.simpleString(), *row)


@dataclass
class Ledger:
    """The ledger in ``folder``; ``ran`` and ``skipped`` tell what this run did."""

    spark: SparkSession
    folder: str
    ran: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)

    def rows(self) -> DataFrame:
        if not exists(self.spark, self.folder):
            return self.spark.createDataFrame([], ROWS)
        return self.spark.read.schema(ROWS).parquet(self.folder)

    def newest(self) -> dict[str, str]:
        """The key of each step's last run; one row a step."""
        last = self.rows().groupBy("step").agg(F.max_by("made_from", "at").alias("made_from"))
        return {r["step"]: r["made_from"] for r in last.collect()}

    def step(self, name: str, made_from: str, run: Callable[[], DataFrame], stored: Callable[[], DataFrame], is_there: bool = True) -> DataFrame:
        """The step's table: as it is ``stored`` where it is there and up to date, else after ``run``."""
        if is_there and self.newest().get(name) == made_from:
            self.skipped.append(name)
            return stored()
        done = run()
        row = (name, made_from, datetime.now(UTC))
        self.spark.createDataFrame([row], ROWS).coalesce(1).write.mode("append").parquet(self.folder)
        self.ran.append(name)
        return done
