"""Which events reach a handler: type, origin, duplicates and position."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyfold.functions.payload import field
from keyfold.functions.times import Duration, duration_seconds, second_of
from keyfold.plans.greedy import greedy_periods
from keyfold.plans.joins import broadcast_if_small
from keyfold.sources.events import ENTITY, POSITION
from keyfold.sources.sinks import SOURCE_HEADER

# Defaults of duplicate detection.
DEDUP_TTL_SECONDS = 604_800
DEDUP_VERSION = "1"


def allowed_types(events: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Keep events whose payload ``type`` starts with one of the prefixes.

    Events without a type, and excise records, always pass.
    """
    if not prefixes:
        return events
    # One pattern, so that the payload is read once per event.
    pattern = "^(?:" + "|".join(re.escape(prefix) for prefix in prefixes) + ")"
    event_type = field(F.col("payload"), "type")
    return events.filter(F.coalesce(event_type.rlike(pattern), F.lit(True)))


def drop_own(events: DataFrame, group_id: str) -> DataFrame:
    """Drop events that carry this consumer group's own source tag."""
    source = F.try_element_at(F.col("headers"), F.lit(SOURCE_HEADER))
    return events.filter(~source.eqNullSafe(F.lit(group_id)))


def event_id(payload: Column) -> Column:
    """The id duplicates are recognised by; ids are compared as text."""
    return field(payload, "id")


def _identity(events: DataFrame) -> DataFrame:
    # A row without an id is its own identity, so such rows neither match each
    # other nor pile up in one group.
    by_id = event_id(F.col("payload"))
    own = F.when(by_id.isNull(), F.concat_ws(":", "partition", "offset"))
    return events.withColumns({"_id": by_id, "_own": own})


def first_by_id(events: DataFrame) -> DataFrame:
    """Process each (topic, key, id) once: keep the first in log order.

    ``row_number() = 1`` is pushed below the shuffle as a group limit, so every
    map task sends at most one row per identity, also for an id that repeats
    without bound.
    """
    first = Window.partitionBy(*ENTITY, "_id", "_own").orderBy("partition", "offset")
    return (
        _identity(events)
        .withColumn("_rank", F.row_number().over(first))
        .filter("_rank = 1")
        .select(*events.columns)
    )


def first_by_id_within(events: DataFrame, ttl: Duration = DEDUP_TTL_SECONDS) -> DataFrame:
    """As ``first_by_id``, but an id is forgotten ``ttl`` after its kept event.

    The next copy at or after that second is processed and starts a new period.
    Copies are first reduced to one per identity and second, and only these
    positions are walked in order; payloads are read once and travel only in the last
    join.
    """
    identity = [*ENTITY, "_id", "_own"]
    place = F.struct(F.unix_micros("timestamp").alias("us"), "partition", "offset")
    per_second = (
        _identity(events)
        .groupBy(*identity, second_of(F.col("timestamp")).alias("second"))
        .agg(F.min(place).alias("first"))
    )
    candidates = per_second.select(
        *identity, "second", F.col("first.us").alias("first_us"), "first.partition", "first.offset"
    )
    kept = greedy_periods(candidates, identity, ttl).filter("opens").select(*POSITION)
    return events.join(kept, POSITION, "left_semi")


def with_version(processed: DataFrame, version: str = DEDUP_VERSION) -> DataFrame:
    """Stamp remembered ids with the version they were recorded under."""
    return processed.withColumn("version", F.lit(version))


def not_processed(
    events: DataFrame, processed: DataFrame, version: str = DEDUP_VERSION
) -> DataFrame:
    """Drop events whose (topic, key, id) is remembered under this version.

    Records of another version are ignored, so a new version forgets all ids.
    ``processed`` has columns topic, key, id and version.
    """
    remembered = (
        processed.filter(F.col("version") == F.lit(version))
        .select(*ENTITY, F.col("id").alias("_id"))
        .distinct()
    )
    probe = events.withColumn("_id", event_id(F.col("payload")))
    return probe.join(remembered, [*ENTITY, "_id"], "left_anti").select(*events.columns)


def after_offsets(events: DataFrame, progress: DataFrame) -> DataFrame:
    """Skip events at or before the last processed offset of their partition.

    ``progress`` has topic, partition and last_offset. There is one row per partition
    after the aggregate, so it is broadcast once counted, and a partition that holds
    much of the log stays spread.
    """
    last = progress.groupBy("topic", "partition").agg(F.max("last_offset").alias("last_offset"))
    return (
        events.join(broadcast_if_small(last), ["topic", "partition"], "left")
        .filter(F.col("last_offset").isNull() | (F.col("offset") > F.col("last_offset")))
        .select(*events.columns)
    )


def first_by_id_stream(events: DataFrame, ttl: Duration = DEDUP_TTL_SECONDS) -> DataFrame:
    """Streaming duplicate filter for streams without a handler.

    An id is remembered for at least ``ttl`` after its newest event, up to the next
    micro-batch whose watermark passes that. ``process_keyed(idempotence_ttl=...)``
    forgets at exactly ``ttl``, and a stream with a handler must use that: Spark allows
    one watermark.
    Events without an id and excise records bypass the state store.
    """
    marked = _identity(events)
    with_id = (
        marked.filter("_id IS NOT NULL")
        .withWatermark("timestamp", _seconds_text(ttl))
        .dropDuplicatesWithinWatermark([*ENTITY, "_id"])
    )
    return with_id.select(*events.columns).unionByName(
        marked.filter("_id IS NULL").select(*events.columns)
    )


def _seconds_text(duration: Duration) -> str:
    return f"{duration_seconds(duration)} seconds"


def incoming(
    events: DataFrame,
    *,
    group_id: str,
    allowed_events: Sequence[str] = (),
    idempotence_ttl: Duration | None = None,
) -> DataFrame:
    """The events a consumer group handles: by type, not its own, each id once.

    Cheap filters come first, so that only what is left is shuffled. A batch without
    ``idempotence_ttl`` keeps the first of each id for good. A stream without it is
    filtered by type and origin only; duplicates are then skipped by ``process_keyed``,
    which remembers ids beside the handler's state.
    """
    wanted = drop_own(allowed_types(events, allowed_events), group_id)
    if events.isStreaming:
        return wanted if idempotence_ttl is None else first_by_id_stream(wanted, idempotence_ttl)
    if idempotence_ttl is None:
        return first_by_id(wanted)
    return first_by_id_within(wanted, idempotence_ttl)
