"""What several operators need: stored steps, exact numbering, the columns of documents."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerlake.workspace import shared_folder

#: Settings of the session under which finished queries leave no shuffle files.
CLEANUP = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled",)
#: Rows that one task numbers or packs at a time.
ROWS_PER_BUCKET = 100_000


def ship(*modules: str) -> None:
    """Send the code of these modules to the tasks by value, so executors need no copy of it."""
    for name in modules:
        cloudpickle.register_pickle_by_value(sys.modules[name])


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of the queries run inside when each of them ends."""
    before = {name: spark.conf.get(name, None) for name in CLEANUP}
    try:
        for name in CLEANUP:
            spark.conf.set(name, "true")
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def stored(df: DataFrame, folder: str, name: str, by: str | None = None) -> DataFrame:
    """``df`` written below a shared folder and read again: a lost executor costs one step at most."""
    path = f"{folder}/{name}"
    with shuffles_freed(df.sparkSession):
        (df.write.partitionBy(by) if by else df.write).mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, path: str) -> None:
    """Remove a stored step that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def work_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}-{name}"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def buckets_for(rows: int, least: int = 1, per_bucket: int = ROWS_PER_BUCKET) -> int:
    return max(least, -(-rows // per_bucket))


def numbered(df: DataFrame, by: list[str], bucket: Column, order: list[Column], name: str) -> DataFrame:
    """``df`` with a gapless number from 0 within each value of ``by``, without a task per value.

    Rows are numbered within (``by``, ``bucket``), and the sizes of the buckets before, summed over
    a small table of counts, are added. ``order`` must tell rows apart, or any order of equals holds.
    """
    keyed = df.withColumn("_bucket", bucket)
    counts = keyed.groupBy(*by, "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *[F.col(c).alias(f"_by_{c}") for c in by],
        F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"_by_{c}")) for c in by] + [F.col("_bucket") == F.col("_b")]
    within = Window.partitionBy(*by, "_bucket").orderBy(*order)
    ranked = keyed.withColumn("_place", F.row_number().over(within))
    joined = ranked.join(starts, same, "left")
    return joined.withColumn(name, F.col("_start") + F.col("_place") - 1).drop(
        "_bucket", "_b", "_start", "_place", *[f"_by_{c}" for c in by]
    )
