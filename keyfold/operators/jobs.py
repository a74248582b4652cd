"""Whole jobs on keyed events: counters, carts, schema checks, state machines."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyfold.functions.payload import field, json_type
from keyfold.functions.times import Duration, duration_us
from keyfold.operators.state import after_excise
from keyfold.plans.chunked import CHUNK_ROWS, with_scan, with_tail
from keyfold.sources.events import ENTITY


def counters(
    events: DataFrame, ttl: Duration, as_of: datetime, *, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Event counter per key that expires when the key stays silent for ``ttl``.

    An excise record, or a silence of ``ttl``, starts the count anew. Columns: topic,
    key, ``counter`` (null once expired or excised), ``starts`` (times it began) and
    ``highest`` (the largest count it reached).
    """
    ttl_us = duration_us(ttl, "ttl")
    narrow = events.select(
        *ENTITY, "offset", F.unix_micros("timestamp").alias("us"),
        F.col("payload").isNull().alias("excised"),
    )
    stepped = with_scan(
        narrow, ENTITY, "offset", chunk_rows=chunk_rows, keep_chunk=True,
        previous={"_was_us": F.col("us"), "_was_excised": F.col("excised")},
    )
    restart = (
        F.col("_was_us").isNull()
        | F.col("_was_excised")
        | (F.col("us") - F.col("_was_us") >= F.lit(ttl_us))
    )
    spans = with_scan(
        stepped.withColumn("_restart", restart.cast("long")).drop("_was_us", "_was_excised"),
        ENTITY, "offset", chunk=F.col("_chunk"), running={"span": ("sum", F.col("_restart"))},
    )
    counts = spans.groupBy(*ENTITY, "span").agg(
        F.sum(F.when(F.col("excised"), 0).otherwise(1)).alias("n"),
        F.max("us").alias("last_us"),
        F.max("excised").alias("ended"),
    )
    as_of_us = F.unix_micros(F.lit(as_of))
    last = F.max_by(F.struct("n", "last_us", "ended"), "span")
    alive = ~F.col("last.ended") & (as_of_us - F.col("last.last_us") < F.lit(ttl_us))
    return (
        counts.groupBy(*ENTITY)
        .agg(
            last.alias("last"),
            F.sum((F.col("n") > 0).cast("long")).alias("starts"),
            F.max("n").alias("highest"),
        )
        .select(*ENTITY, F.when(alive, F.col("last.n")).alias("counter"), "starts", "highest")
    )


def cart_items(
    events: DataFrame,
    item: str,
    schema: dict[str, str] | None = None,
    *,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Item ids each key gathered, in order: topic, key, ``place`` from 0, ``item``.

    One row per item instead of a list, so a cart may grow without bound. Payloads
    that do not fit ``schema`` are left out.
    """
    items = _accepted(events, schema).select(
        *ENTITY, "offset", field(F.col("payload"), item).alias("item")
    )
    placed = with_scan(
        items, ENTITY, "offset", chunk_rows=chunk_rows,
        running={"place": ("sum", F.lit(1).cast("long"))},
    )
    return placed.withColumn("place", F.col("place") - 1).drop("offset")


def cart_summary(
    events: DataFrame,
    item: str,
    total: str,
    capacity: int,
    schema: dict[str, str] | None = None,
) -> DataFrame:
    """Per key: items gathered, the last total, and the ends of the bounded backlog.

    The backlog is the last ``capacity`` items, so counts and ends come out of partial
    aggregates and a tail; no list is built.
    """
    alive = _accepted(events, schema).select(
        *ENTITY, "offset",
        field(F.col("payload"), item).alias("item"),
        field(F.col("payload"), total).cast("long").alias("total"),
    )
    oldest = (
        with_tail(alive, ENTITY, "offset", capacity, "_back")
        .groupBy(*ENTITY)
        .agg(F.max_by("item", "_back").alias("oldest"), F.count("*").alias("backlog"))
    )
    whole = alive.groupBy(*ENTITY).agg(
        F.count("*").alias("items"),
        F.max_by(F.struct("total", "item"), "offset").alias("last"),
    )
    return whole.join(oldest, ENTITY).select(
        *ENTITY, "items", F.col("last.total").alias("last_total"), "oldest",
        F.col("last.item").alias("newest"), "backlog",
    )


def _accepted(events: DataFrame, schema: dict[str, str] | None) -> DataFrame:
    alive = after_excise(events)
    if schema is None:
        return alive
    return check_schema(alive, schema).filter("reject_reason IS NULL")


def check_schema(events: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Add ``reject_reason`` where a payload lacks a field of the declared JSON type.

    ``fields`` maps a name to ``string``, ``integer``, ``number``, ``boolean``,
    ``array`` or ``object``. A rejected payload is a permanent failure. Excise
    records carry no payload and pass.
    """
    def problem_of(parsed: Column) -> Column:
        problem = F.lit(None).cast("string")
        for name, wanted in reversed(fields.items()):
            fits = F.coalesce(json_type(parsed, name).rlike(_VARIANT_TYPES[wanted]), F.lit(False))
            problem = F.when(~fits, F.lit(f"{name} must be {wanted}")).otherwise(problem)
        return problem

    # The lambda binds the decoded payload, so that it is decoded once for all fields.
    decoded = F.array(F.try_parse_json("payload"))
    problem = F.transform(decoded, problem_of)[0]
    return events.withColumn("reject_reason", F.when(F.col("payload").isNotNull(), problem))


_VARIANT_TYPES = {
    "string": "^STRING$",
    "integer": "^(TINYINT|SMALLINT|INT|BIGINT|DECIMAL\\([0-9]+,0\\))$",
    "number": "^(TINYINT|SMALLINT|INT|BIGINT|FLOAT|DOUBLE|DECIMAL.*)$",
    "boolean": "^BOOLEAN$",
    "array": "^ARRAY<.*$",
    "object": "^OBJECT<.*$",
}


def transitions(
    events: DataFrame,
    state: str,
    allowed: Sequence[tuple[str, str]],
    *,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Each key's moves between states: ``from_state``, ``to_state``, ``allowed``.

    The first event of a key enters from a null state and is always allowed.
    """
    named = events.select(*ENTITY, "offset", F.col(state).alias("to_state"))
    moved = with_scan(
        named, ENTITY, "offset", chunk_rows=chunk_rows,
        previous={"from_state": F.col("to_state")},
    )
    pairs = F.array(*[F.concat_ws("\u0001", F.lit(a), F.lit(b)) for a, b in allowed])
    legal = F.col("from_state").isNull() | F.array_contains(
        pairs, F.concat_ws("\u0001", "from_state", "to_state")
    )
    return moved.withColumn("allowed", legal)
