"""Shaping the event log: record kinds, compaction, retention, positions, traces."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyfold.functions.times import Duration, duration_us, utc_text
from keyfold.sources.events import ENTITY, POSITION

SPAN_RELATIONS = ("child", "follows_from")


def record_kind(events: DataFrame) -> DataFrame:
    """Add ``record_kind``: a key without a payload is an excise record."""
    kind = F.when(F.col("payload").isNull(), "excise").otherwise("message")
    return events.withColumn("record_kind", kind)


def route_kinds(events: DataFrame, timers: DataFrame) -> DataFrame:
    """Events and due timers as one list of handler calls.

    ``timers`` has topic, key, time and ``internal``; internal timers belong to the
    engine and call no handler.
    """
    calls = record_kind(events).select(
        *ENTITY,
        F.col("timestamp").alias("time"),
        F.when(F.col("record_kind") == "excise", "on_excise").otherwise("on_message").alias("call"),
    )
    due = timers.filter(~F.col("internal")).select(*ENTITY, "time", F.lit("on_timer").alias("call"))
    return calls.unionByName(due)


def compacted(events: DataFrame) -> DataFrame:
    """What log compaction leaves: the last event per key, deleted keys gone.

    The group limit below the shuffle leaves one row per key and map task.
    """
    latest = Window.partitionBy(*ENTITY).orderBy(F.desc("offset"))
    return (
        events.withColumn("_rank", F.row_number().over(latest))
        .filter((F.col("_rank") == 1) & F.col("payload").isNotNull())
        .select(*events.columns)
    )


def retained(events: DataFrame, as_of: datetime, retention: Duration) -> DataFrame:
    """Events no older than ``retention`` at ``as_of``; a plain pushed-down filter."""
    oldest = as_of - timedelta(microseconds=duration_us(retention, "retention"))
    return events.filter(F.col("timestamp") >= F.lit(oldest))


def resolve_positions(references: DataFrame, log: DataFrame) -> DataFrame:
    """Load the messages that stored positions point to; lost ones have null payload.

    Positions are unique in the log, so this is a plain left join. Many references
    to one message make a skewed left side, which adaptive execution splits.
    """
    messages = log.select(*POSITION, "timestamp", "payload")
    return references.join(messages, POSITION, "left")


def span_links(
    events: DataFrame, relation: str = "child", position: Column | None = None
) -> DataFrame:
    """Add ``trace_id``, ``parent_id`` and ``link_id`` for each handler span.

    The producer's span is read from the ``traceparent`` header. ``child`` stays in
    its trace; ``follows_from`` starts a new trace that links back to it. A new
    trace id derives from the record's position, so a replay gives the same one.
    """
    if relation not in SPAN_RELATIONS:
        raise ValueError(f"span relation: expected one of {SPAN_RELATIONS}, got {relation!r}")
    parent = F.try_element_at(F.col("headers"), F.lit("traceparent"))
    parts = F.split(parent, "-")
    trace, span = F.get(parts, 1), F.get(parts, 2)
    place = position if position is not None else F.concat_ws(":", *POSITION)
    fresh = F.md5(place)
    if relation == "child":
        ids = (F.coalesce(trace, fresh), span, F.lit(None).cast("string"))
    else:
        ids = (fresh, F.lit(None).cast("string"), span)
    return events.withColumns(dict(zip(("trace_id", "parent_id", "link_id"), ids)))


def lifecycle_rows(calls: DataFrame) -> DataFrame:
    """Telemetry rows for handler calls.

    ``calls`` has topic, key, kind, attempt, outcome, started and ended; times leave
    as UTC text with milliseconds.
    """
    return calls.select(
        *ENTITY, "kind", "attempt", "outcome",
        utc_text(F.col("started")).alias("started"),
        utc_text(F.col("ended")).alias("ended"),
    )
