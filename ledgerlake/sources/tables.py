"""Catalog tables: create, replace, append, evolve, list."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    FloatType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The columns of a chunk table.
CHUNK_SCHEMA = StructType(
    [
        StructField("chunk_id", StringType(), False),
        StructField("source_path", StringType(), False),
        StructField("section_title", StringType(), False),
        StructField("chunk_index", IntegerType(), False),
        StructField("chunk_text", StringType(), False),
        StructField("embedding", ArrayType(FloatType()), False),
        StructField("ingestion_ts", TimestampType(), False),
    ]
)


def ensure_namespace(spark: SparkSession, namespace: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}")


def replace_table(
    df: DataFrame,
    name: str,
    partition_by: list[str] | None = None,
    path: str | None = None,
) -> DataFrame:
    """Create the table from ``df``, or replace all of it; returns the stored table.

    Partitioned writes are rebalanced first: adaptive execution splits a partition value that
    holds much of the table over many tasks and joins small ones, so files come out even.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def append_rows(df: DataFrame, name: str) -> DataFrame:
    """Append by position. Too few or too many columns is an error, never filled with null."""
    df.write.insertInto(name)
    return df.sparkSession.table(name)


def append_evolving(df: DataFrame, name: str) -> DataFrame:
    """Append by name. Columns new to the table are added; older files read as null there."""
    spark = df.sparkSession
    known = spark.table(name).columns
    added = [f for f in df.schema.fields if f.name not in known]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({columns})")
    schema = spark.table(name).schema
    df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    ).write.insertInto(name)
    return spark.table(name)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast to ``schema`` and fail the job on a null where the schema forbids one.

    Parquet tables do not keep ``nullable=False``, so the check has to run with the write.
    """

    def field(f: StructField):
        value = F.col(f.name).cast(f.dataType)
        if not f.nullable:
            value = F.coalesce(value, F.raise_error(F.lit(f"null in {f.name}")).cast(f.dataType))
        return value.alias(f.name)

    return df.select(*[field(f) for f in schema.fields])


def list_tables(spark: SparkSession, namespace: str | None = None) -> DataFrame:
    """Namespaces and their tables by name (catalog metadata only)."""
    names = (
        [namespace]
        if namespace
        else [r["namespace"] for r in spark.sql("SHOW NAMESPACES").collect()]
    )
    shown = [
        spark.sql(f"SHOW TABLES IN {n}")
        .where(~F.col("isTemporary"))
        .select("namespace", F.col("tableName").alias("table"))
        for n in names
    ]
    return reduce(DataFrame.unionByName, shown)


def discover_table_dirs(paths: DataFrame, table: str, col: str = "path") -> DataFrame:
    """Folders ``<table>_<uuid>`` among the metadata files in ``paths``, each once.

    The folder name must match as a whole: ``people`` does not find ``people_by_country_<uuid>``.
    """
    folder = F.regexp_replace(col, "/metadata/.*$", "")
    return (
        paths.where(F.col(col).like("%/metadata/%"))
        .select(folder.alias("dir"))
        .where(F.col("dir").rlike(f"(^|/)\\Q{table}\\E_[0-9a-f-]{{36}}$"))
        .distinct()
    )
