"""Published state: committed snapshots that other jobs look up by key.

A publication is a folder tree of parquet and a small log of the batches. A batch is a list
of segments: a base, and changes to it, each with the rows it replaces and the cells it
deletes. Publishing changes writes only them and merges small segments into larger ones, so
that each is at least twice as large as the next: a row is rewritten a logarithmic number
of times, and a reader merges a logarithmic number of segments. Readers pick one group and
its newest batch, then read by join.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from keyfold.definitions import Collection, check_collections, check_read_cache
from keyfold.functions.times import Duration, duration_us
from keyfold.operators import state
from keyfold.plans.joins import broadcast_if_small
from keyfold.session import delete_folder, folder_names
from keyfold.sources.events import ENTITY

# Fixed value: how long a reader may go on with the batch it resolved.
READ_CACHE_SECONDS = 5

_LOG_SCHEMA = (
    "subsystem string, collection string, kind string, group_id string, "
    "batch_id long, as_of timestamp, retired boolean, segments array<struct<folder string, rows long>>"
)

# Batches of a collection and group that stay readable.
BATCHES_KEPT = 8

# What a published row replaces: a value, a map's entry, a key's whole deque.
_CELLS = {"value": [*ENTITY], "map": [*ENTITY, "map_key"], "deque": [*ENTITY]}

_DELETED, _EXPIRES, _SEGMENT = "_deleted", "_expires_us", "_segment"


def newest_snapshot(
    snapshots: DataFrame, as_of: datetime, staleness: Duration | None = None
) -> DataFrame:
    """The newest batch at ``as_of`` per (subsystem, collection), from one group.

    ``snapshots`` are state rows with subsystem, collection, group_id, batch_id and
    ``batch_time``. Adds ``stale``: the batch is older than the bound. The choice is
    one small aggregate per collection and group.
    """
    usable = snapshots.filter(F.col("batch_time") <= F.lit(as_of))
    chosen = one_group(
        usable.groupBy("subsystem", "collection", "group_id").agg(
            F.max(F.struct("batch_time", "batch_id")).alias("_newest")
        )
    ).select("subsystem", "collection", "group_id", F.col("_newest.batch_id").alias("batch_id"))
    rows = usable.join(broadcast_if_small(chosen), ["subsystem", "collection", "group_id", "batch_id"])
    limit = F.lit(None) if staleness is None else F.lit(
        as_of - timedelta(microseconds=duration_us(staleness, "staleness"))
    )
    return rows.withColumn("stale", F.coalesce(F.col("batch_time") < limit, F.lit(False)))


def one_group(publications: DataFrame) -> DataFrame:
    """Keep one publishing group per (subsystem, collection): the first by name."""
    names = [c for c in publications.columns if c not in ("subsystem", "collection", "group_id")]
    return (
        publications.groupBy("subsystem", "collection")
        .agg(F.min("group_id").alias("group_id"),
             *[F.min_by(c, "group_id").alias(c) for c in names])
    )


def lookup(snapshot: DataFrame, asked: DataFrame) -> DataFrame:
    """Values for the asked keys, null where the snapshot has none."""
    return asked.join(snapshot.select(*ENTITY, "value"), ENTITY, "left")


def publish(
    snapshot: DataFrame,
    path: str,
    definition: Collection,
    *,
    subsystem: str,
    group_id: str,
    batch_id: int,
    as_of: datetime,
    kept: int = BATCHES_KEPT,
) -> None:
    """Write a committed snapshot as a new base; writing a batch again replaces it.

    Only a batch whose rows are complete enters the log, so readers never see a
    half-written one. ``published=False`` retires the collection; where ``published`` was
    not set, what other runs published stays as it is. Of the batches, the last ``kept``
    stay; what only older ones refer to is deleted.
    """
    check_collections([definition], subsystem)
    if definition.published is None:
        return
    place = _Place(snapshot.sparkSession, path, definition, subsystem, group_id)
    # published=False retires the collection: the log says so, no rows are written.
    segments = [place.write(snapshot)] if definition.published else []
    place.enter(batch_id, as_of, segments, not definition.published)
    place.clean(kept)


def publish_changes(
    changes: DataFrame,
    path: str,
    definition: Collection,
    *,
    subsystem: str,
    group_id: str,
    batch_id: int,
    as_of: datetime,
    kept: int = BATCHES_KEPT,
) -> None:
    """Publish the rows that changed since the batch before; writing a batch again replaces it.

    ``changes`` has a snapshot's columns and, if anything is deleted, a boolean ``_deleted``.
    A row replaces the value or map entry it names; a deque's rows replace the key's whole
    deque. A deleted row removes what it names, and one with a null ``map_key`` all entries
    of its key that the same batch does not set. Without a batch before, or after a
    retirement, the changes are all there is. Null keys are a key like any other. An empty
    table publishes the state before at the new time. Two rows for one cell in a batch have
    no order, so they are an error of the caller; one of them is taken.
    """
    check_collections([definition], subsystem)
    if not definition.published:
        return publish(
            changes, path, definition, subsystem=subsystem, group_id=group_id,
            batch_id=batch_id, as_of=as_of, kept=kept,
        )
    check_collections([definition], subsystem)
    place = _Place(changes.sparkSession, path, definition, subsystem, group_id)
    entries = place.entries()
    if any(entry.batch_id > batch_id for entry in entries):
        raise ValueError(f"batch_id: {batch_id} is behind a published batch; changes come in order")
    before = next((e for e in entries if e.batch_id < batch_id), None)
    segments = [] if before is None or before.retired else place.segments(before)
    if _DELETED not in changes.columns:
        changes = changes.withColumn(_DELETED, F.lit(False))
    fresh = place.write(changes)
    if fresh[1] or not segments:
        segments = [*segments, fresh]
    # merge from the newest back until each segment is twice as large as the next
    first, rows = len(segments) - 1, segments[-1][1]
    while first and segments[first - 1][1] < 2 * rows:
        first -= 1
        rows += segments[first][1]
    if first < len(segments) - 1 or (not first and fresh in segments):
        merged = place.merged(segments[first:], whole=first == 0)
        segments = [*segments[:first], place.write(merged)]
    place.enter(batch_id, as_of, segments, False)
    place.clean(kept)


def last_published(
    spark: SparkSession, path: str, definition: Collection, *, subsystem: str, group_id: str
) -> int | None:
    """The newest batch this group published; None without one or if it is a retirement."""
    entries = _Place(spark, path, definition, subsystem, group_id).entries()
    return entries[0].batch_id if entries and not entries[0].retired else None


def rewrite_segments(
    spark: SparkSession,
    path: str,
    hit: Callable[[DataFrame], DataFrame],
    left: Callable[[DataFrame], DataFrame],
) -> int:
    """Replace the segments that hold rows of ``hit`` by what ``left`` keeps of them.

    Covers every batch of every collection and group; returns the number of segments. A
    batch changes when its log entry does, so readers see it before or after. What was
    replaced is deleted at the end.
    """
    if not folder_names(spark, f"{path}/log"):
        return 0
    log = spark.read.schema(_LOG_SCHEMA).parquet(f"{path}/log/*")
    places = log.select("subsystem", "collection", "kind", "group_id").distinct().collect()
    done = 0
    for found in places:
        named = Row(name=found.collection, kind=found.kind)
        place = _Place(spark, path, named, found.subsystem, found.group_id)
        entries = place.entries()
        live = {segment[0] for entry in entries for segment in place.segments(entry)}
        new = {}
        for folder in sorted(live):
            rows = place.read(folder)
            if not hit(rows).isEmpty():
                new[folder] = place.write(left(rows))
        for entry in entries if new else []:
            segments = place.segments(entry)
            if any(folder in new for folder, _ in segments):
                segments = [new.get(segment[0], segment) for segment in segments]
                place.enter(entry.batch_id, entry.as_of, segments, entry.retired)
        if new:
            place.clean(len(entries))
        done += len(new)
    return done


class _Place:
    """Where one group publishes one collection."""

    def __init__(
        self, spark: SparkSession, path: str, definition: Collection, subsystem: str, group_id: str
    ) -> None:
        self._spark, self._path, self._kind = spark, path, definition.kind
        self._names = (subsystem, definition.name, group_id)
        self._folder = f"{path}/state/{subsystem}/{definition.name}/{group_id}"

    def _log_of(self, batch_id: int) -> str:
        return f"{self._path}/log/{'.'.join(self._names)}.{batch_id}"

    def entries(self) -> list:
        """The log of this place, newest first: at most the batches kept and one."""
        if not folder_names(self._spark, f"{self._path}/log"):
            return []
        subsystem, collection, group_id = self._names
        log = self._spark.read.schema(_LOG_SCHEMA).parquet(f"{self._path}/log/*").filter(
            (F.col("subsystem") == subsystem) & (F.col("collection") == collection)
            & (F.col("group_id") == group_id)
        )
        return log.orderBy(F.desc("as_of"), F.desc("batch_id")).collect()

    @staticmethod
    def segments(entry) -> list[tuple[str, int]]:
        if entry.segments is None:  # a log from before there were segments
            return [] if entry.retired else [(f"batch_id={entry.batch_id}", 0)]
        return [(segment.folder, segment.rows) for segment in entry.segments]

    def read(self, folder: str) -> DataFrame:
        return self._spark.read.parquet(f"{self._folder}/{folder}")

    def write(self, rows: DataFrame) -> tuple[str, int]:
        """A new segment: its folder and its number of rows, which the files' footers hold."""
        name = uuid.uuid4().hex
        rows.write.parquet(f"{self._folder}/{name}")
        return name, self._spark.read.schema(rows.schema).parquet(f"{self._folder}/{name}").count()

    def merged(self, segments: Sequence[tuple[str, int]], whole: bool, asked: DataFrame | None = None) -> DataFrame:
        """The rows left of consecutive segments, with deletions unless they are ``whole``.

        ``asked`` narrows every segment to its keys before rows are compared.
        """
        parts = []
        for k, (folder, _) in enumerate(segments):
            part = self.read(folder).withColumn(_SEGMENT, F.lit(k))
            if asked is not None:
                part = part.join(asked.select(*ENTITY).distinct(), ENTITY, "left_semi")
            parts.append(part)
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part, allowMissingColumns=True)
        if _DELETED not in rows.columns:
            rows = rows.withColumn(_DELETED, F.lit(False))
        rows = rows.withColumn(_DELETED, F.coalesce(_DELETED, F.lit(False)))
        if len(segments) > 1:
            rows = self._newest(rows)
        if whole:
            return rows.filter(~F.col(_DELETED)).drop(_DELETED, _SEGMENT)
        return rows.drop(_SEGMENT)

    def _newest(self, rows: DataFrame) -> DataFrame:
        """Of the rows for one cell those of its newest segment."""
        cell = _CELLS[self._kind]
        if self._kind == "deque":
            last = rows.groupBy(*cell).agg(F.max(_SEGMENT).alias("_last"))
            return _beside(rows, last, cell).filter(F.col(_SEGMENT) == F.col("_last")).drop("_last")
        others = [c for c in rows.columns if c not in cell]
        newest = rows.groupBy(*cell).agg(F.max_by(F.struct(*others), _SEGMENT).alias("_row"))
        newest = newest.select(*cell, "_row.*")
        if self._kind == "value":
            return newest
        # a deletion without a map key clears what older segments hold of the map
        cleared = newest.filter(F.col("map_key").isNull() & F.col(_DELETED)).select(
            *ENTITY, F.col(_SEGMENT).alias("_cleared")
        )
        left = _beside(newest, cleared, ENTITY)
        return left.filter(F.col("_cleared").isNull() | (F.col(_SEGMENT) >= F.col("_cleared"))).drop("_cleared")

    def enter(self, batch_id: int, as_of: datetime, segments: Sequence[tuple[str, int]], retired: bool) -> None:
        """Put the batch into the log, in place of an earlier writing of it."""
        subsystem, collection, group_id = self._names
        entry = (subsystem, collection, self._kind, group_id, batch_id, as_of, retired, list(segments))
        self._spark.createDataFrame([entry], _LOG_SCHEMA).coalesce(1).write.mode("overwrite").parquet(
            self._log_of(batch_id)
        )

    def clean(self, kept: int) -> None:
        """Forget all but the newest batches, then delete segments that none refers to."""
        if kept < 1:
            raise ValueError(f"kept: at least one batch, got {kept}")
        entries = self.entries()
        for entry in entries[kept:]:
            delete_folder(self._spark, self._log_of(entry.batch_id))
        live = {folder for entry in entries[:kept] for folder, _ in self.segments(entry)}
        # one query publishes here, so what no batch refers to was merged or never finished
        for name in folder_names(self._spark, self._folder):
            if name not in live:
                delete_folder(self._spark, f"{self._folder}/{name}")


def _beside(rows: DataFrame, found: DataFrame, cell: Sequence[str]) -> DataFrame:
    """Rows with what was found for their cell, if anything; null keys match null keys."""
    names = {name: f"_of_{name}" for name in cell}
    found = found.withColumnsRenamed(names)
    same = None
    for name, other in names.items():
        equal = F.col(name).eqNullSafe(F.col(other))
        same = equal if same is None else same & equal
    return rows.join(found, same, "left").drop(*names.values())


def publisher(
    path: str, definition: Collection, *, subsystem: str, group_id: str, changes: bool = False
):
    """A ``foreachBatch`` function that publishes each micro-batch.

    The micro-batches of a query in complete mode hold all keys: each is a new base. Those
    of a query in update mode hold what changed: set ``changes``. State of handlers is
    published with ``keyfold.streaming.publish_state``.
    """
    put = publish_changes if changes else publish

    def write(rows: DataFrame, batch_id: int) -> None:
        put(
            rows, path, definition, subsystem=subsystem, group_id=group_id,
            batch_id=batch_id, as_of=datetime.now(),
        )

    return write


class PublishedReader:
    """Read-only access to one published collection; every read takes its keys."""

    def __init__(
        self, spark: SparkSession, path: str, subsystem: str, definition: Collection
    ) -> None:
        if definition.payload != "json":
            raise TypeError("only JSON collections can be read by other groups")
        if not subsystem:
            raise ValueError("subsystem: a name must not be empty")
        cache = READ_CACHE_SECONDS if definition.read_cache is None else definition.read_cache
        check_read_cache(cache)
        self._cache_seconds = 0.0 if cache is False else duration_us(cache) / 1e6
        self._spark, self._path = spark, path
        self._subsystem, self._definition = subsystem, definition
        self._resolved: tuple[float, Any] | None = None

    def snapshot(self, asked: DataFrame | None = None) -> DataFrame:
        """Rows of the newest batch, which is reused within the cache window.

        With ``asked``, only the rows of its keys, picked before segments are merged.
        """
        now = time.monotonic()
        if self._resolved is None or now - self._resolved[0] >= self._cache_seconds:
            self._resolved = (now, self._resolve())
        entry = self._resolved[1]
        place = _Place(self._spark, self._path, self._definition, self._subsystem, entry.group_id)
        rows = place.merged(place.segments(entry), True, asked)
        if _EXPIRES not in rows.columns:
            return rows
        valid = F.col(_EXPIRES).isNull() | (F.col(_EXPIRES) > F.unix_micros(F.lit(entry.as_of)))
        return rows.filter(valid).drop(_EXPIRES)

    def _resolve(self) -> Any:
        """The log entry of the newest batch of the first group that has one."""
        log = self._spark.read.schema(_LOG_SCHEMA).parquet(f"{self._path}/log/*")
        mine = log.filter(
            (F.col("subsystem") == self._subsystem)
            & (F.col("collection") == self._definition.name)
        )
        newest = mine.groupBy("subsystem", "collection", "group_id").agg(
            F.max_by(F.struct("batch_id", "as_of", "kind", "retired", "segments"), F.struct("as_of", "batch_id"))
            .alias("newest")
        )
        live = newest.filter(~F.col("newest.retired"))
        chosen = one_group(live).head()
        if chosen is None:
            raise LookupError(
                f"{self._subsystem}/{self._definition.name}: not published, or retired"
            )
        if chosen.newest.kind != self._definition.kind:
            raise TypeError(
                f"{self._definition.name}: published as {chosen.newest.kind}, "
                f"read as {self._definition.kind}"
            )
        return Row(group_id=chosen.group_id, **chosen.newest.asDict())

    def _of_kind(self, kind: str, asked: DataFrame) -> DataFrame:
        if self._definition.kind != kind:
            raise TypeError(f"{self._definition.name} is a {self._definition.kind}, not a {kind}")
        return self.snapshot(asked)

    def get(self, asked: DataFrame) -> DataFrame:
        """Values by key (``topic, key``), or map values by ``topic, key, map_key``."""
        if self._definition.kind == "map":
            return state.map_get(self.snapshot(asked), asked)
        return lookup(self._of_kind("value", asked), asked)

    def get_many(self, asked: DataFrame) -> DataFrame:
        return state.map_get_many(self._of_kind("map", asked), asked)

    def contains(self, asked: DataFrame) -> DataFrame:
        return state.map_contains(self._of_kind("map", asked), asked)

    def items(self, asked: DataFrame, direction: str = "forward") -> DataFrame:
        mine = self._of_kind("map", asked).join(asked.select(*ENTITY).distinct(), ENTITY, "left_semi")
        return state.map_items(mine, direction)

    def keys(self, asked: DataFrame, direction: str = "forward") -> DataFrame:
        return self.items(asked, direction).select(*ENTITY, "map_key")

    def values(self, asked: DataFrame, direction: str = "forward") -> DataFrame:
        """Map values in key order, or deque values in scan order."""
        if self._definition.kind == "map":
            return self.items(asked).select(*ENTITY, "value")
        mine = self._of_kind("deque", asked).join(asked.select(*ENTITY).distinct(), ENTITY, "left_semi")
        return state.deque_values(mine, direction).orderBy(*ENTITY, "scan_position").select(
            *ENTITY, "scan_position", "value"
        )

    def at(self, asked: DataFrame, indexes: Sequence[int]) -> DataFrame:
        """Deque values at front-relative (or negative) indexes."""
        mine = self._of_kind("deque", asked).join(asked.select(*ENTITY).distinct(), ENTITY, "left_semi")
        return state.deque_get(mine, indexes)

    def ends(self, asked: DataFrame) -> DataFrame:
        """Front, back, size and emptiness of the asked deques."""
        return state.deque_ends(self._of_kind("deque", asked), asked)
