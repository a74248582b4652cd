"""Keyed collections folded from a log of writes.

A write log has ``topic, key, offset, timestamp, op`` and, by kind, ``value`` and
``map_key``. Ops are ``set`` and ``clear`` for values; ``set``, ``remove`` and
``clear`` for maps; ``append``, ``appendleft`` and ``clear`` for deques. Pops depend
on the deque's content at that moment and belong to ``keyfold.streaming``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyfold.functions.payload import is_json, is_json_null
from keyfold.functions.times import Duration, duration_us
from keyfold.plans.chunked import CHUNK_ROWS, with_rank, with_scan, with_tail
from keyfold.plans.joins import after_last_mark
from keyfold.sources.events import ENTITY, POSITION

DIRECTIONS = ("forward", "backward")


def _check_direction(direction: str) -> None:
    if direction not in DIRECTIONS:
        raise ValueError(f"direction: expected one of {DIRECTIONS}, got {direction!r}")


def _latest(writes: DataFrame, cell: Sequence[str], columns: Sequence[str]) -> DataFrame:
    last = F.struct(*[F.col(c) for c in columns])
    return (
        writes.groupBy(*cell)
        .agg(F.max_by(last, "offset").alias("_last"), F.max("offset").alias("offset"))
        .select(*cell, "offset", "_last.*")
    )


def value_snapshot(writes: DataFrame) -> DataFrame:
    """Present values: the last write of each key, unless it was a clear."""
    return (
        _latest(writes, ENTITY, ["op", "value", "timestamp"])
        .filter("op = 'set'")
        .drop("op")
    )


def map_snapshot(writes: DataFrame) -> DataFrame:
    """Present map entries, one row per (key, map_key).

    Writes are reduced to the last one per cell first. A cell survives if that is a
    set, and comes after the key's last clear.
    """
    cells = _latest(
        writes.filter("op != 'clear'"), [*ENTITY, "map_key"], ["op", "value", "timestamp"]
    )
    alive = after_last_mark(
        cells.filter("op = 'set'"), ENTITY, "offset", F.col("op") == "clear", marks_from=writes
    )
    return alive.drop("op")


def map_items(entries: DataFrame, direction: str = "forward") -> DataFrame:
    """Map entries in scan order: by key, then by map key in code point order.

    The sort is range partitioned, so a map of any size spreads over the cluster.
    """
    _check_direction(direction)
    place = F.col("map_key")
    return entries.orderBy(*ENTITY, place.desc() if direction == "backward" else place.asc())


def map_positions(entries: DataFrame, direction: str = "forward") -> DataFrame:
    """Add ``position``: the place of an entry in the ordered scan of its map."""
    _check_direction(direction)
    return with_rank(entries, ENTITY, "map_key", "position", descending=direction == "backward")


def map_get_many(entries: DataFrame, requests: DataFrame) -> DataFrame:
    """Look up several map keys per key; one row per requested position.

    ``requests`` has topic, key and ``map_keys``. Repeats stay, absent keys give a
    null value, an empty list gives no rows.
    """
    asked = requests.select(*ENTITY, F.posexplode("map_keys").alias("position", "map_key"))
    return asked.join(
        entries.select(*ENTITY, "map_key", "value"), [*ENTITY, "map_key"], "left"
    )


def map_get(entries: DataFrame, requests: DataFrame, default: Column | None = None) -> DataFrame:
    """Look up one map key per request; the default stands in for absence only."""
    found = requests.join(
        entries.select(*ENTITY, "map_key", "value"), [*ENTITY, "map_key"], "left"
    )
    return found if default is None else found.withColumn("value", F.coalesce("value", default))


def map_contains(entries: DataFrame, requests: DataFrame) -> DataFrame:
    """Add ``present`` to each (key, map_key); reads no values."""
    cells = entries.select(*ENTITY, "map_key", F.lit(True).alias("present"))
    return requests.join(cells, [*ENTITY, "map_key"], "left").withColumn(
        "present", F.coalesce("present", F.lit(False))
    )


def deque_slots(writes: DataFrame, *, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Deque contents: one row per slot with ``position`` from the front and ``size``."""
    alive = after_last_mark(writes, ENTITY, "offset", F.col("op") == "clear")
    pushes = alive.filter(F.col("op").isin("append", "appendleft"))
    left = F.when(F.col("op") == "appendleft", 1).otherwise(0).cast("long")
    counted = with_scan(
        pushes, ENTITY, "offset",
        running={"_left": ("sum", left), "_seen": ("sum", F.lit(1).cast("long"))},
        totals={"_lefts": ("sum", left), "size": ("sum", F.lit(1).cast("long"))},
        chunk_rows=chunk_rows,
    )
    right_place = F.col("_lefts") + F.col("_seen") - F.col("_left") - 1
    place = F.when(F.col("op") == "appendleft", F.col("_lefts") - F.col("_left"))
    return counted.withColumn("position", place.otherwise(right_place)).drop(
        "_left", "_seen", "_lefts", "op"
    )


def deque_values(slots: DataFrame, direction: str = "forward") -> DataFrame:
    """Number the slots in scan order as ``scan_position``."""
    _check_direction(direction)
    place = F.col("position")
    if direction == "backward":
        place = F.col("size") - 1 - place
    return slots.withColumn("scan_position", place)


def deque_get(slots: DataFrame, indexes: Sequence[int]) -> DataFrame:
    """Values at front-relative indexes; negative ones count from the back.

    One row per key and index, null when out of range. Indexes are a short literal
    list, so they become conditional aggregates: one shuffle of partial results and
    no join.
    """
    for index in indexes:
        if isinstance(index, bool) or not isinstance(index, int):
            raise TypeError(f"deque index must be an int, got {index!r}")
    picks = []
    for number, index in enumerate(indexes):
        place = F.lit(index) if index >= 0 else F.col("size") + F.lit(index)
        hit = F.when(F.col("position") == place, F.col("value"))
        picks.append(F.max(hit).alias(f"_at_{number}"))
    wide = slots.groupBy(*ENTITY).agg(*picks)
    pairs = F.array(
        *[
            F.struct(F.lit(index).cast("long").alias("index"), F.col(f"_at_{n}").alias("value"))
            for n, index in enumerate(indexes)
        ]
    )
    return wide.select(*ENTITY, F.explode(pairs).alias("_p")).select(*ENTITY, "_p.*")


def deque_ends(slots: DataFrame, asked: DataFrame) -> DataFrame:
    """Front, back, size and emptiness of the deque of each asked key.

    ``asked`` has topic and key. Slots are aggregated before the join.
    """
    ends = slots.groupBy(*ENTITY).agg(
        F.min_by("value", "position").alias("front"),
        F.max_by("value", "position").alias("back"),
        F.max("size").alias("size"),
    )
    size = F.coalesce("size", F.lit(0).cast("long"))
    return asked.join(ends, ENTITY, "left").withColumns(
        {"size": size, "is_empty": F.col("size").isNull()}
    )


def write_position(offset: Column, seq: Column) -> Column:
    """One order for the writes of all attempts: the event's offset, then ``seq``."""
    return F.struct(offset.cast("long").alias("offset"), seq.cast("long").alias("seq"))


def bounded_deque(writes: DataFrame, capacity: int) -> DataFrame:
    """The last ``capacity`` appended items per key since its last clear.

    Each push over capacity evicts the front, so an append-only deque is the tail of
    its pushes; see ``with_tail`` for how a hot key's history is kept out of one task.
    """
    if isinstance(capacity, bool) or not isinstance(capacity, int) or capacity < 1:
        raise ValueError("capacity: must be a whole number of at least 1")
    cleared = writes.filter("op = 'clear'").groupBy(*ENTITY).agg(
        F.max("offset").alias("_cleared")
    )
    tail = with_tail(writes.filter("op = 'append'"), ENTITY, "offset", capacity, "_from_back")
    alive = F.col("_cleared").isNull() | (F.col("offset") > F.col("_cleared"))
    kept = tail.join(cleared, ENTITY, "left").filter(alive)
    size = F.max("_from_back").over(Window.partitionBy(*ENTITY)).cast("long")
    return kept.select(
        *ENTITY, "offset", "timestamp", "value",
        (size - F.col("_from_back")).alias("position"), size.alias("size"),
    )


def unexpired(cells: DataFrame, ttl: Duration, as_of: datetime) -> DataFrame:
    """Cells whose last write is younger than ``ttl`` at ``as_of``; 0 keeps them forever."""
    micros = duration_us(ttl, "ttl")
    if not micros:
        return cells
    oldest = as_of - timedelta(microseconds=micros)
    return cells.filter(F.col("timestamp") > F.lit(oldest))


def committed_writes(attempt_ops: DataFrame, *, read_uncommitted: bool = False) -> DataFrame:
    """The writes of handler attempts that reach the state.

    ``attempt_ops`` has the attempt's ``topic, partition, offset``, a ``seq`` inside
    the attempt, ``op`` (a write, ``commit`` or ``rollback``) and the attempt's
    ``outcome``. A write lasts if the next control after it is a commit, or if none
    follows and the attempt succeeded. ``read_uncommitted`` collections write through,
    so they keep what failed attempts wrote and have nothing to roll back.
    """
    is_control = F.col("op").isin("commit", "rollback")
    if read_uncommitted:
        return attempt_ops.filter(~is_control)
    # Walked backwards, so that the frame only grows and each row is read once.
    later = (
        Window.partitionBy(*POSITION).orderBy(F.desc("seq"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    at_end = F.when(F.col("outcome") == "ok", "commit").otherwise("rollback")
    next_control = F.last(F.when(is_control, F.col("op")), ignorenulls=True).over(later)
    decided = F.coalesce(next_control, at_end)
    return (
        attempt_ops.withColumn("_decided", decided)
        .filter(~is_control & (F.col("_decided") == "commit"))
        .drop("_decided")
    )


def after_excise(events: DataFrame) -> DataFrame:
    """Messages that are left of each key once its excise records have taken effect."""
    return after_last_mark(events, ENTITY, "offset", F.col("payload").isNull()).filter(
        F.col("payload").isNotNull()
    )


def rejected_writes(writes: DataFrame) -> DataFrame:
    """Add ``reject_reason`` to writes a collection refuses; null when accepted.

    ``writes`` has ``payload_kind`` (``json`` or ``message``) of the collection, the
    written ``value`` text and ``is_message``, whether a delivered message was given.
    """
    to_json = F.col("payload_kind") == "json"
    value = F.col("value")
    reason = (
        F.when(to_json & F.col("is_message"), "message in a JSON collection")
        .when(~to_json & ~F.col("is_message"), "not a delivered message")
        .when(to_json & (value.isNull() | is_json_null(value)), "null is not storable")
        .when(to_json & ~is_json(value), "not representable as JSON")
    )
    return writes.withColumn("reject_reason", reason)
