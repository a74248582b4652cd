"""Staged tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.session import shared_dir

# Bytes of a reduced table that every executor may hold.
BROADCAST_BYTES = 16 << 20


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a folder not used before, below ``spark.checkpoint.dir``."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write the rows as Parquet to the shared folder, or to ``path``, and read them back.

    Cuts lineage: what was written survives the loss of executors, and is computed once
    however often it is used. The folder may be removed when its readers are done.
    """
    path = path or new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(columns: list[str], count: int) -> list[str]:
    """Column names that do not clash with those given, whatever their case."""
    taken = {c.lower() for c in columns}
    free = (f"_x{k}" for k in range(len(taken) + count))
    return [name for name in free if name not in taken][:count]


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder made by ``new_folder`` that nothing reads any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def small_side(table: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a staged table for broadcast if its counted rows fit the limit.

    A larger table is returned as it is, and the join shuffles both sides.
    """
    most = max(1, limit // row_bytes)
    return table if table.limit(most + 1).count() > most else F.broadcast(table)
