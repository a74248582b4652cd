"""Running a keyed handler over a batch or a stream of events."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.definitions import Collection, check_collections
from keyfold.functions.times import Duration, duration_us
from keyfold.operators.filters import DEDUP_VERSION, event_id
from keyfold.operators.failures import (
    DEFER_BASE_SECONDS, DEFER_CAP_SECONDS, MAX_RETRIES, MODES, deadline_us,
)
from keyfold.operators.log import lifecycle_rows
from keyfold.operators.published import last_published, publish, publish_changes
from keyfold.session import configure
from keyfold.sources.events import ENTITY
from keyfold.streaming.handles import ENDS_CELL
from keyfold.streaming.lanes import EVENT, run_in_lanes
from keyfold.streaming.messages import check_handler
from keyfold.streaming.processor import OUTPUT_SCHEMA, KeyedProcessor

# What to do about a stream's rows that come after rows behind them.
ORDERS = ("fail", "wait", "take")

# Batch runs must end: tries of a failing call once the input is at its end.
END_ATTEMPTS = 10


def process_keyed(
    events: DataFrame,
    handler: Any,
    collections: Sequence[Collection] = (),
    *,
    mode: str = "pipeline",
    max_retries: int = MAX_RETRIES,
    defer_base: Duration = DEFER_BASE_SECONDS,
    defer_max_delay: Duration = DEFER_CAP_SECONDS,
    max_attempts: int | None = None,
    end_attempts: int = END_ATTEMPTS,
    idempotence_ttl: Duration | None = None,
    idempotence_version: str = DEDUP_VERSION,
    timeout: Duration | None = None,
    subsystem: str | None = None,
    lateness: Duration = 0,
    out_of_order: str = "fail",
    with_state: bool = False,
    telemetry: bool = False,
) -> DataFrame:
    """Call the handler for every event and timer, per key, in order.

    Returns one frame of all rows the run produces; ``kind`` tells them apart and the
    ``*_rows`` functions select them. State changes of a call last only if it
    succeeds. A failing call is retried by a timer while the key's later events wait
    behind it (``pipeline``), retried at once and then dead-lettered
    (``low-latency``), or skipped (``best-effort``).

    Each key's events run one after the other in one task: that order is the contract
    of a handler. Over a long log run it as a stream with a bounded trigger: a task
    then holds one micro-batch of a key, and state carries over. Filter, deduplicate
    and drop columns before this call, or fold with ``keyfold.operators`` where the
    job allows it; those split hot keys.

    A call is retried until it succeeds, unless ``max_attempts`` is given: then it is
    dead-lettered. As a batch must end, what still fails ``end_attempts`` times after the
    last event comes out as ``parked`` rows, with all that waits behind it, in order.

    ``idempotence_ttl`` skips events whose id the key has seen in that time, under the
    same ``idempotence_version``; events without an id always pass. It is the duplicate
    filter for streams, as one watermark serves both steps. A skipped event does not move
    the key's clock.

    ``lateness`` is the watermark delay of a stream. Spark drops events older than
    the watermark, so set it beyond the disorder between partitions, and see
    ``check_no_late_rows``. ``with_state`` adds rows with each key's final state to a
    batch run. ``telemetry`` adds a row for every call, not only for those that fail.
    ``timeout`` cancels ``async`` handlers and interrupts plain ones; such a call fails as
    a transient error. It defaults to 80 % of the stall threshold. In a batch without
    collections and ``idempotence_ttl``, and not in ``pipeline`` mode, keys whose calls wait do
    not hold up the task's other keys; then a handler may run in several processes of a task.

    ``out_of_order`` is for a stream's rows that come in a later micro-batch than one
    behind them, as from files listed out of order. ``fail`` keeps each key's last offset
    per partition and fails the query. ``wait`` holds rows in state until the watermark has
    passed them and handles them in order then; that takes a ``lateness`` beyond the
    disorder, and adds as much delay. ``take`` handles rows as they come, for handlers to
    which order means nothing.
    """
    check_handler(handler)
    check_collections(collections, subsystem)
    if mode not in MODES:
        raise ValueError(f"mode: expected one of {MODES}, got {mode!r}")
    streaming = events.isStreaming
    if with_state and streaming:
        raise ValueError("with_state: a stream's state is read with committed_state")
    if out_of_order not in ORDERS:
        raise ValueError(f"out_of_order: expected one of {ORDERS}, got {out_of_order!r}")
    processor = KeyedProcessor(
        handler, collections,
        mode=mode, max_retries=max_retries,
        backoff_seconds=(_seconds(defer_base), _seconds(defer_max_delay)),
        max_attempts=max_attempts, end_attempts=end_attempts,
        ids=None if idempotence_ttl is None
        else (duration_us(idempotence_ttl, "idempotence_ttl"), str(idempotence_version)),
        timeout_seconds=deadline_us(timeout) / 1e6,
        streaming=streaming, order=out_of_order if streaming else "take", with_state=with_state, telemetry=telemetry,
    )
    spark = configure(events.sparkSession)
    headers = (
        F.col("headers") if "headers" in events.columns
        else F.lit(None).cast("map<string,string>")
    )
    rows = events.select(
        *ENTITY, "partition", "offset", "payload", headers.alias("headers"), "timestamp",
        F.unix_micros("timestamp").alias("us"),
        (F.lit(None).cast("string") if idempotence_ttl is None else event_id(F.col("payload")))
        .alias("event_id"),
    )
    if streaming:
        delay = f"{duration_us(lateness, 'lateness') // 1000} milliseconds"
        rows = rows.withWatermark("timestamp", delay)
    else:
        # With a state store it has one partition per shuffle partition; sorting before it
        # lets the handler read a key's events as they come, with nothing buffered.
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.repartition(partitions, *ENTITY).sortWithinPartitions(
            *ENTITY, "partition", "offset"
        )
        if not collections and mode != "pipeline" and idempotence_ttl is None:
            # Nothing is kept from call to call but timers, so no state store is needed.
            return rows.select(*EVENT).mapInArrow(run_in_lanes(processor), OUTPUT_SCHEMA)
        _ = spark.streams.active  # starts the state store coordinator
    return rows.groupBy(*ENTITY).transformWithState(
        processor, OUTPUT_SCHEMA, "Append", "EventTime"
    )


def _seconds(duration: Duration) -> int:
    return -(-duration_us(duration) // 1_000_000)


def output_rows(rows: DataFrame) -> DataFrame:
    """What handlers emitted: topic, key, call, offset, time, value (JSON text)."""
    return rows.filter("kind = 'output'").select(*ENTITY, "call", "offset", "time", "value")


def dead_letter_rows(rows: DataFrame, failure_topic: str) -> DataFrame:
    """Events given up on, addressed to the failure topic."""
    return rows.filter("kind = 'dead_letter'").select(
        F.lit(failure_topic).alias("topic"), F.col("topic").alias("source_topic"),
        "key", "partition", "offset", F.col("value").alias("payload"), "attempt", "error",
    )


def parked_rows(rows: DataFrame) -> DataFrame:
    """What a batch run left undone, in order per key: run these events again."""
    return rows.filter("kind = 'parked'").select(
        *ENTITY, "call", "partition", "offset", "time", "attempt", F.col("value").alias("payload"),
    )


def response_rows(rows: DataFrame, group_id: str) -> DataFrame:
    """Answers to requests, in the shape ``operators.requests`` reads."""
    return rows.filter("kind = 'response'").select(
        F.col("name").alias("request_id"), F.lit(group_id).alias("group_id"),
        F.col("time").alias("timestamp"), "offset", F.lit("json").alias("content_type"),
        F.col("value").alias("body"), "error",
    )


def call_rows(rows: DataFrame) -> DataFrame:
    """The lifecycle of handler calls: all with ``telemetry``, else the failed ones."""
    return rows.filter("kind = 'call'").select(
        *ENTITY, "call", "partition", "offset", "time", "attempt", "outcome", "category",
        "error", "started", "ended",
    )


def telemetry_rows(rows: DataFrame) -> DataFrame:
    """Handler calls as lifecycle events, with wall-clock times as text."""
    return lifecycle_rows(
        call_rows(rows).withColumn("kind", F.regexp_replace("call", "^on_", ""))
    )


def collection_rows(rows: DataFrame, definition: Collection) -> DataFrame:
    """A collection's final state from a batch run made with ``with_state``."""
    mine = rows.filter((F.col("kind") == "state") & (F.col("name") == definition.name))
    if definition.kind == "value":
        return mine.select(*ENTITY, "value")
    if definition.kind == "map":
        return mine.select(*ENTITY, F.col("cell").alias("map_key"), "value")
    return mine.select(*ENTITY, F.col("cell").cast("long").alias("position"), "size", "value")


def committed_state(
    spark: SparkSession,
    checkpoint: str,
    definition: Collection,
    *,
    as_of: datetime | None = None,
    batch_id: int | None = None,
) -> DataFrame:
    """A collection's committed state, read from a stream's checkpoint.

    Holds what the last finished micro-batch left, or the one asked for, so uncommitted
    changes never show. ``as_of`` leaves out what has expired by then; without it, cells
    that the stream has not purged yet are still there. Expired slots of a deque keep
    their place: the others' positions and the size stay.
    """
    reader = spark.read.format("statestore").option("stateVarName", definition.name)
    if batch_id is not None:
        reader = reader.option("batchId", batch_id)
    raw = reader.load(checkpoint)
    content = "value" if definition.kind == "value" else "user_map_value"
    if as_of is not None:
        expires = F.col(f"{content}.expires")
        raw = raw.filter(expires.isNull() | (expires > F.unix_micros(F.lit(as_of))))
    if definition.kind == "value":
        return raw.select("key.*", F.col("value.v").alias("value"))
    cell = F.col("user_map_key.k" if definition.kind == "map" else "user_map_key.slot")
    cells = raw.select("key.*", cell.alias("cell"), F.col("user_map_value.v").alias("value"))
    if definition.kind == "map":
        return cells.withColumnRenamed("cell", "map_key")
    ends = cells.filter(F.col("cell") == ENDS_CELL).select(
        *ENTITY, F.from_json("value", "array<long>").alias("ends")
    )
    front, back = F.col("ends")[0], F.col("ends")[1]
    return cells.filter(F.col("cell") != ENDS_CELL).join(ends, ENTITY).select(
        *ENTITY, (F.col("cell") - front).alias("position"), (back - front).alias("size"), "value"
    )


def state_changes(
    spark: SparkSession, checkpoint: str, definition: Collection, first: int, last: int
) -> DataFrame:
    """What a stream's micro-batches from ``first`` to ``last`` changed in a collection.

    Rows for ``operators.published.publish_changes``: the newest values, with ``_deleted``
    and the time they expire. Read from the state's change log, so only changes are read; of
    a deque with changes all slots are, from the committed state.
    """
    feed = (
        spark.read.format("statestore").option("stateVarName", definition.name)
        .option("readChangeFeed", True).option("changeStartBatchId", first)
        .option("changeEndBatchId", last).load(checkpoint)
    )
    if definition.kind == "deque":
        slots = committed_state(spark, checkpoint, definition, batch_id=last)
        touched = feed.select("key.*").distinct()
        left = slots.join(touched, ENTITY, "left_semi").withColumn("_deleted", F.lit(False))
        gone = touched.join(slots.select(*ENTITY).distinct(), ENTITY, "left_anti")
        return left.unionByName(gone.withColumn("_deleted", F.lit(True)), allowMissingColumns=True)
    cell, content = [*ENTITY], "value"
    if definition.kind == "map":
        cell, content = [*ENTITY, "map_key"], "user_map_value"
        feed = feed.withColumn("map_key", F.col("user_map_key.k"))
    deleted = F.col("change_type") != "update"
    rows = feed.select(
        "key.*", *cell[2:], "batch_id", deleted.alias("_deleted"),
        F.col(f"{content}.v").alias("value"), F.col(f"{content}.expires").alias("_expires_us"),
    )
    # a cell is written once per micro-batch
    newest = rows.groupBy(*cell).agg(
        F.max_by(F.struct("value", "_expires_us", "_deleted"), "batch_id").alias("_row")
    )
    return newest.select(*cell, "_row.*")


def publish_state(
    spark: SparkSession,
    checkpoint: str,
    path: str,
    definition: Collection,
    *,
    subsystem: str,
    group_id: str,
    as_of: datetime,
    changes: bool = False,
) -> None:
    """Publish a collection as the stream's last finished micro-batch left it at ``as_of``.

    With ``changes``, only what changed since the batch this group published last is read
    and written, if there is one; nothing is done if no micro-batch has ended since.
    """
    batches = spark.read.format("state-metadata").load(checkpoint)
    batch_id = batches.agg(F.max("maxBatchId")).first()[0]
    place = {"subsystem": subsystem, "group_id": group_id}
    before = last_published(spark, path, definition, **place) if changes else None
    if before is None:
        rows = committed_state(spark, checkpoint, definition, as_of=as_of, batch_id=batch_id)
        publish(rows, path, definition, batch_id=batch_id, as_of=as_of, **place)
    elif before < batch_id:
        rows = state_changes(spark, checkpoint, definition, before + 1, batch_id)
        publish_changes(rows, path, definition, batch_id=batch_id, as_of=as_of, **place)


def check_no_late_rows(query: Any) -> None:
    """Raise if the watermark has dropped events of a stream.

    Every event is to be processed, but Spark drops late rows in silence and only
    counts them in the query's progress.
    """
    dropped = sum(
        operator.get("numRowsDroppedByWatermark", 0)
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
    if dropped:
        raise RuntimeError(f"{dropped} late events were dropped; raise the lateness")
