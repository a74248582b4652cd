"""Outgoing events and the tables jobs write."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: the header that names the system an event came from.
SOURCE_HEADER = "source-system"


def tag_source(headers: Column, source_system: str) -> Column:
    """Headers with the source tag set, replacing an earlier tag."""
    kept = F.map_filter(
        F.coalesce(headers, F.create_map().cast("map<string,string>")),
        lambda name, _: name != SOURCE_HEADER,
    )
    return F.map_concat(kept, F.create_map(F.lit(SOURCE_HEADER), F.lit(source_system)))


def outgoing(
    df: DataFrame,
    *,
    topic: str,
    key: Column,
    payload: Column,
    group_id: str,
    source_system: str | None = None,
    headers: Column | None = None,
) -> DataFrame:
    """Rows to send: JSON payload, and the source tag that defaults to the group id.

    ``payload`` is a struct, map or array column and is encoded as JSON. Text that
    is JSON already is passed through.
    """
    encoded = payload if _is_text(df, payload) else F.to_json(payload)
    return df.select(
        F.lit(topic).alias("topic"),
        key.cast("string").alias("key"),
        encoded.alias("payload"),
        tag_source(F.lit(None) if headers is None else headers, source_system or group_id)
        .alias("headers"),
    )


def excise_records(
    df: DataFrame,
    *,
    topic: str,
    key: Column,
    group_id: str,
    source_system: str | None = None,
    headers: Column | None = None,
) -> DataFrame:
    """One deletion record per row: the key with no payload."""
    return outgoing(
        df, topic=topic, key=key, payload=F.lit(None).cast("string"),
        group_id=group_id, source_system=source_system, headers=headers,
    )


def _is_text(df: DataFrame, column: Column) -> bool:
    return df.select(column).schema[0].dataType.typeName() == "string"


def kafka_rows(outgoing_rows: DataFrame) -> DataFrame:
    """Outgoing rows in the shape the Kafka sink takes."""
    headers = F.transform(
        F.map_entries("headers"),
        lambda e: F.struct(e["key"].alias("key"), e["value"].cast("binary").alias("value")),
    )
    return outgoing_rows.select(
        "topic", F.col("key").cast("binary").alias("key"),
        F.col("payload").cast("binary").alias("value"), headers.alias("headers"),
    )


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch so that a replay of it replaces the first try."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def batch_writer(
    outputs: Mapping[str, Callable[[DataFrame], DataFrame]],
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes several views of each micro-batch.

    ``outputs`` maps a folder to the selection written there, for example results
    and dead letters. The micro-batch is persisted so that it is computed once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for path, select in outputs.items():
                write_batch(select(batch), path, batch_id)
        finally:
            batch.unpersist()

    return write
