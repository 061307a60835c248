"""Files: CSV, JSON records, whole documents, and the inventory of stored objects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, multi_line: bool = False
) -> DataFrame:
    """CSV with a header; a quote inside a quoted value is doubled, and an empty value in quotes is a text.

    Without a schema the types are inferred, at the cost of one more read. ``multi_line`` reads values
    that hold line ends; files can then not be split.
    """
    reader = spark.read.options(header=True, quote='"', escape='"', multiLine=multi_line)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)


def read_json_records(
    spark: SparkSession,
    path: str,
    schema: StructType | str | None = None,
    one_array: bool = True,
    vector: str = "embedding",
) -> DataFrame:
    """JSON records; a vector field comes out as ``array<float>``.

    ``one_array`` reads files that hold a single array of records, which cannot be split;
    turn it off for JSON lines, which can.
    """
    reader = spark.read.option("multiLine", one_array)
    df = (reader.schema(schema) if schema is not None else reader).json(path)
    if vector in df.columns:
        df = df.withColumn(vector, F.col(vector).cast("array<float>"))
    return df


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, one file per task, so that writing and reading stay parallel."""
    df.write.mode("overwrite").json(path)


def read_documents(spark: SparkSession, paths: str | list[str], root: str = "") -> DataFrame:
    """Each file whole, as ``(source_path, text)``; ``root`` is cut off the front of the path.

    Spark skips files without any bytes, which would give no section either.
    """
    files = spark.read.option("recursiveFileLookup", True).text(paths, wholetext=True)
    # The path comes percent-encoded; a plus sign in it stands for itself.
    path = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))
    if root:
        path = F.when(path.startswith(root), F.substring(path, len(root) + 1, 1 << 30)).otherwise(path)
    return files.select(path.alias("source_path"), F.col("value").alias("text"))


def read_files(spark: SparkSession, path: str, file_format: str = "parquet") -> DataFrame:
    return spark.read.format(file_format).load(path)


def list_objects(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Path, size and time of stored files that have any bytes. Their content is never read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return files.select(
        "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified")
    )
