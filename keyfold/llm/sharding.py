"""Sharding by rendezvous hashing of record keys over weighted shards.

Every shard draws a number from the record's key and its own name, and the record goes to
the shard with the best draw. A draw depends on that one shard alone, so a further shard
takes records only into itself, and a removed one gives away only its own. Weights change
how often a shard wins, in proportion. All expressions are built in.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyfold.llm.store import new_folder, small_side, staged

# Bytes of documents that one task writes to one file.
FILE_BYTES = 256 << 20
# Bytes a document counts beside its text.
OVERHEAD = 8
# Names of a caller's columns that clash with those of the shard files.
_RENAMED = {"shard": "shard_in", "grown_shard": "grown_shard_in"}


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key: number ``i`` wins with probability ``weights[i] / sum(weights)``.

    A draw u in (0, 1) becomes -ln(u) / weight, and the least of these wins. Equal keys go
    together; null is a key like any other. A weight of 0 takes nothing.
    """
    if not any(w > 0 for w in weights) or any(w < 0 for w in weights):
        raise ValueError("weights must not be negative, and one must be over 0")
    text = key.cast("string")
    draws = []
    for shard, weight in enumerate(weights):
        if weight > 0:
            bits = F.shiftrightunsigned(F.xxhash64(F.lit("shard"), F.lit(shard), text), 11)
            cost = -F.log((bits + 0.5) / F.lit(2.0**53)) / F.lit(float(weight))
            draws.append(F.struct(cost.alias("cost"), F.lit(shard).alias("shard")))
    return (F.least(*draws) if len(draws) > 1 else draws[0])["shard"]


def assigned(
    docs: DataFrame, weights: Sequence[float], more: float | None = 1.0, key_col: str = "doc_id",
    prefix: str = "_s_",
) -> DataFrame:
    """Add ``{prefix}shard``, and ``{prefix}grown``: the shard if one of weight ``more`` joined.

    One projection: nothing is moved. ``more=None`` leaves ``grown`` null.
    """
    key = F.col(key_col)
    grown = F.lit(None).cast("int") if more is None else shard_of(key, [*weights, more])
    return docs.withColumn(f"{prefix}shard", shard_of(key, weights)).withColumn(
        f"{prefix}grown", grown
    )


def size_of(text: Column) -> Column:
    """UTF-8 bytes of a text, none for null, and the fixed part of a record."""
    return F.coalesce(F.octet_length(text.cast("string")), F.lit(0)).cast("long") + OVERHEAD


def write_shards(
    docs: DataFrame,
    folder: str,
    weights: Sequence[float],
    more: float | None = 1.0,
    key_col: str = "doc_id",
    text_col: str = "text",
    file_bytes: int = FILE_BYTES,
) -> None:
    """Write all rows and columns below ``folder`` as Parquet, one ``shard=N`` folder a shard.

    Rows are moved once. A shard is dealt over as many tasks as its bytes ask for, row by
    row, so neither a large shard nor one key with most of the rows is a single task's
    work. The columns ``shard`` and ``grown_shard`` are this function's; columns of these
    names in ``docs`` are written as ``shard_in`` and ``grown_shard_in``. An empty table
    writes no shard.
    """
    spark = docs.sparkSession
    taken = {c.lower() for c in docs.columns}
    if any(c in taken and new in taken for c, new in _RENAMED.items()):
        raise ValueError(f"columns {', '.join(_RENAMED.values())} are needed for clashing names")
    rows = assigned(docs, weights, more, key_col)
    total = docs.agg(F.sum(size_of(F.col(text_col)))).first()[0] or 0
    tasks = max(1, -(-total // (len(weights) * file_bytes)))
    rows = rows.select(
        *[F.col(c).alias(_RENAMED.get(c.lower(), c)) for c in docs.columns],
        F.col("_s_grown").alias("grown_shard"),
        F.col("_s_shard").alias("shard"),
        F.pmod(F.monotonically_increasing_id(), F.lit(tasks)).alias("_deal"),
    )
    rows = rows.repartition(len(weights) * tasks, "shard", "_deal").drop("_deal")
    rows.write.partitionBy("shard").parquet(folder)
    spark.createDataFrame(
        [(i, float(w), docs.schema.json()) for i, w in enumerate(weights)],
        "shard int, weight double, columns string",
    ).coalesce(1).write.parquet(f"{folder}/_weights")


def _columns(spark: SparkSession, folder: str):
    """Schema of the shard files, from the folder's own record."""
    record = spark.read.parquet(f"{folder}/_weights").select("columns").first()[0]
    fields = T.StructType.fromJson(json.loads(record)).fields
    fields = [T.StructField(_RENAMED.get(f.name.lower(), f.name), f.dataType) for f in fields]
    return T.StructType(
        [*fields, T.StructField("grown_shard", T.IntegerType()), T.StructField("shard", T.IntegerType())]
    )


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Every row with its columns, ``shard``, ``grown_shard`` and ``slot``.

    ``slot`` numbers a shard's rows from 0 without a gap: the rows in the shard's files
    before this one, and the row's place in its file. Only files are counted and joined,
    so no rows are moved or sorted. The numbers are those of the written files, whoever
    reads them.
    """
    rows = spark.read.schema(_columns(spark, folder)).parquet(folder)
    names = list(rows.columns)
    placed = rows.select(
        *names, F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_row")
    )
    before = Window.partitionBy("_shard").orderBy("_name").rowsBetween(Window.unboundedPreceding, -1)
    files = placed.groupBy(F.col("shard").alias("_shard"), F.col("_file").alias("_name")).agg(
        F.count("*").alias("_rows")
    )
    files = files.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    files = small_side(staged(files.drop("_rows"), "shard-files"), row_bytes=200)
    joined = placed.join(
        files, (F.col("shard") == F.col("_shard")) & (F.col("_file") == F.col("_name"))
    )
    return joined.select(*names, (F.col("_row") + F.col("_before")).cast("long").alias("slot"))


def balance(spark: SparkSession, folder: str, text_col: str = "text") -> DataFrame:
    """``shard, weight, n_rows, n_bytes, share, due``: what each shard holds and is due.

    ``due`` is the shard's part of all weights, ``share`` its part of all rows.
    """
    rows = spark.read.schema(_columns(spark, folder)).parquet(folder)
    held = rows.groupBy(F.col("shard").alias("_shard")).agg(
        F.count("*").alias("n_rows"), F.sum(size_of(F.col(text_col))).alias("n_bytes")
    )
    every = Window.partitionBy()
    found = spark.read.parquet(f"{folder}/_weights").join(held, F.col("shard") == F.col("_shard"), "left")
    n = F.coalesce("n_rows", F.lit(0))
    return found.select(
        "shard",
        "weight",
        n.alias("n_rows"),
        F.coalesce("n_bytes", F.lit(0)).alias("n_bytes"),
        (n / F.sum(n).over(every)).alias("share"),
        (F.col("weight") / F.sum("weight").over(every)).alias("due"),
    )


def report(
    docs: DataFrame,
    shards: int | Sequence[float],
    id_col: str = "doc_id",
    text_col: str = "text",
    folder: str | None = None,
) -> DataFrame:
    """Write the documents into shards and return, per document as read back from them,
    ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``shards`` is a number of equal shards, or their weights. The law is ``key``: the id and
    the shards decide, so rows that repeat an id share a shard, whatever their texts. Null
    ids are one key. A null text has size 8 and the checksum of no bytes. An empty table
    gives no rows.
    """
    weights = [1.0] * shards if isinstance(shards, int) else list(shards)
    folder = folder or new_folder(docs.sparkSession, "shards")
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    write_shards(rows, folder, weights)
    kept = read_shards(docs.sparkSession, folder)
    return kept.select(
        "doc_id",
        size_of(F.col("text")).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        "shard",
        "slot",
        "grown_shard",
    )
