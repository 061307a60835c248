"""A table whose columns are added, renamed, widened and dropped without writing its files again.

Every column has a number for life, and files name columns by it. ``columns/`` keeps, for every version of the
schema, the number, name, type and place of each column; a change of schema adds a version there and touches no
data. Files are read with the numbers and types of the version that is asked for: a renamed column is found under
its number, a column that a file lacks is null, a widened one is widened by the Parquet reader, and a dropped one
does not come back when another column takes its name.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.history import exists

COLUMNS = "version int, number int, place int, name string, type string"
# The widenings that a Parquet reader of Spark makes.
WIDER = {
    "tinyint": ("smallint", "int", "bigint", "double"),
    "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
    "date": ("timestamp_ntz",),
}


@dataclass(frozen=True)
class EvolvingTable:
    """A table in ``folder``; see the module. Changes of schema are meant for one job at a time."""

    spark: SparkSession
    folder: str

    @classmethod
    def create(cls, spark: SparkSession, folder: str, schema: str) -> EvolvingTable:
        if exists(spark, f"{folder}/columns"):
            raise ValueError(f"{folder} already holds a table")
        table = cls(spark, folder)
        fields = spark.createDataFrame([], schema).schema.fields
        table._store(1, [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields, 1)])
        return table

    def _history(self) -> DataFrame:
        return self.spark.read.schema(COLUMNS).parquet(f"{self.folder}/columns")

    @property
    def version(self) -> int:
        return self._history().agg(F.max("version")).first()[0]

    def columns(self, version: int | None = None) -> list[tuple[int, str, str]]:
        """(number, name, type) of the columns of a version of the schema, by default the newest."""
        rows = self._history().where(F.col("version") == (self.version if version is None else version)).orderBy("place").collect()
        if not rows:
            raise ValueError(f"unknown schema version {version}")
        return [(r["number"], r["name"], r["type"]) for r in rows]

    def _store(self, version: int, columns: Sequence[tuple[int, str, str]]) -> None:
        rows = [(version, number, place, name, kind) for place, (number, name, kind) in enumerate(columns)]
        self.spark.createDataFrame(rows, COLUMNS).coalesce(1).write.mode("append").parquet(f"{self.folder}/columns")

    def _change(self, name: str, new: tuple[str, str] | None) -> None:
        columns = self.columns()
        if name not in [c[1] for c in columns]:
            raise ValueError(f"no column {name}")
        changed = [(number, *(new if known == name else (known, kind))) for number, known, kind in columns if new or known != name]
        names = [c[1] for c in changed]
        if len(set(names)) < len(names) or not names:
            raise ValueError(f"columns would be {names}")
        self._store(self.version + 1, changed)

    def rename(self, name: str, new: str) -> None:
        kinds = {known: kind for _, known, kind in self.columns()}
        self._change(name, (new, kinds.get(name, "")))

    def widen(self, name: str, kind: str) -> None:
        """Give a column a wider type; a type that could lose values is an error."""
        known = {c: k for _, c, k in self.columns()}.get(name)
        if known is not None and kind not in WIDER.get(known, ()):
            raise ValueError(f"{name} is {known}, which {kind} does not widen")
        self._change(name, (name, kind))

    def add(self, name: str, kind: str) -> None:
        """A new column, null in the rows that are there."""
        if name in [c[1] for c in self.columns()]:
            raise ValueError(f"there is a column {name}")
        newest = self._history().agg(F.max("number")).first()[0]
        self._store(self.version + 1, [*self.columns(), (newest + 1, name, kind)])

    def drop(self, name: str) -> None:
        self._change(name, None)

    def append(self, df: DataFrame) -> None:
        """Append by name under the newest schema. Columns that ``df`` lacks are null, others than the table's an error."""
        columns = self.columns()
        extra = set(df.columns) - {c[1] for c in columns}
        if extra:
            raise ValueError(f"no columns {sorted(extra)}")
        values = [(F.col(f"`{name}`") if name in df.columns else F.lit(None)).cast(kind).alias(f"c{number}") for number, name, kind in columns]
        df.select(*values).write.mode("append").parquet(f"{self.folder}/data/_schema={self.version}")

    def read(self, version: int | None = None) -> DataFrame:
        """The rows under the newest schema, or those that were there while an older one held, under that one."""
        columns = self.columns(version)
        types = ", ".join(f"c{number} {kind}" for number, _, kind in columns)
        if exists(self.spark, f"{self.folder}/data"):
            rows = self.spark.read.schema(f"{types}, _schema int").parquet(f"{self.folder}/data")
            rows = rows if version is None else rows.where(F.col("_schema") <= version)
        else:
            rows = self.spark.createDataFrame([], types)
        return rows.select(*[F.col(f"c{number}").alias(name) for number, name, _ in columns])
