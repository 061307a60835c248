"""What a job needs around its DataFrames: a shared folder, bounded collects, shipped code."""

from __future__ import annotations

import sys
import uuid

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """A new, empty folder name that every executor can reach.

    It lies under the session's ``spark.checkpoint.dir``. Where that is unset a session on one machine uses its
    warehouse; on a cluster that may be a folder of the driver's machine, so it is an error there.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all machines share")
        root = spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/ledgerlake-{uuid.uuid4().hex}"


def collect_vectors(df: DataFrame, vector: str, max_rows: int, max_bytes: int) -> pa.Table | None:
    """The rows of ``df`` on the driver, or None if there are more, or longer vectors, than the bound.

    Rows are counted and measured first, so that nothing beyond the bound is ever sent.
    """
    some = df.limit(max_rows + 1)
    n, width = some.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size(vector)), F.lit(0))).first()
    return df.limit(max_rows).toArrow() if n <= max_rows and n * width * 8 <= max_bytes else None


def ship_code(module_name: str) -> None:
    """Send the functions of a module to tasks by value, so executors need no copy of it."""
    cloudpickle.register_pickle_by_value(sys.modules[module_name])
