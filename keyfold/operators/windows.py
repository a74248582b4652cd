"""Burst windows: act on a key's first event at once, gather the rest, sum them up.

A window opens with the first event of a key that finds none open and closes a
fixed time later, on a whole second. Events in between are held; the summary leaves
when the window closes. An excise record drops the key's window and held events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyfold.functions.times import SECOND_US, Duration
from keyfold.plans.chunked import CHUNK_ROWS, with_scan, with_tail
from keyfold.plans.greedy import greedy_periods
from keyfold.sources.events import ENTITY

# Defaults of the burst window.
BURST_SECONDS = 300
BURST_CAPACITY = 100

_PERIOD = [*ENTITY, "epoch"]


def _messages(events: DataFrame, chunk_rows: int) -> DataFrame:
    """Messages with ``epoch``, the key's excise records so far, and ``second``.

    A key's clock is the latest timestamp it has seen, so it never runs back.
    """
    narrow = events.select(
        *ENTITY, "offset",
        F.unix_micros("timestamp").alias("us"),
        F.col("payload").isNull().cast("long").alias("excised"),
    )
    scanned = with_scan(
        narrow, ENTITY, "offset",
        running={"epoch": ("sum", F.col("excised")), "clock": ("max", F.col("us"))},
        chunk_rows=chunk_rows,
    )
    return scanned.filter("excised = 0").select(
        *_PERIOD, "offset", "clock",
        F.call_function("div", F.col("clock"), F.lit(SECOND_US)).alias("second"),
    )


def _seconds(messages: DataFrame) -> DataFrame:
    return messages.groupBy(*_PERIOD, "second").agg(
        F.min("clock").alias("first_us"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
        F.count("*").alias("n"),
    )


def burst_windows(
    events: DataFrame,
    length: Duration = BURST_SECONDS,
    capacity: int = BURST_CAPACITY,
    *,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """One row per window: its opening event and the size of its summary.

    ``held`` counts the events gathered after the opening one, ``summarised`` those
    that a deque of ``capacity`` still holds, ``last_offset`` is the window's newest
    event. Columns: topic, key, epoch, open_us, open_offset, close_second, held,
    summarised, last_offset.
    """
    seconds = greedy_periods(_seconds(_messages(events, chunk_rows)), _PERIOD, length)
    opening = F.col("opens")
    return (
        seconds.groupBy(*_PERIOD, "open_second", "close_second")
        .agg(
            F.max(F.when(opening, F.col("first_us"))).alias("open_us"),
            F.max(F.when(opening, F.col("first_offset"))).alias("open_offset"),
            (F.sum("n") - 1).alias("held"),
            F.max("last_offset").alias("last_offset"),
        )
        .withColumn("summarised", F.least(F.col("held"), F.lit(capacity).cast("long")))
        .select(
            *_PERIOD, "open_us", "open_offset", "close_second", "held", "summarised",
            "last_offset",
        )
    )


def burst_held(
    events: DataFrame,
    length: Duration = BURST_SECONDS,
    capacity: int = BURST_CAPACITY,
    *,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The messages each summary lists: the last ``capacity`` held ones of a window.

    Of one second only the last ``capacity`` events can be among them, so a crowded
    second is cut down before its events meet their window. Tails up to Spark's limit
    for ranks run before their shuffle, and the join keeps the first one's partitioning.
    """
    messages = _messages(events, chunk_rows)
    periods = greedy_periods(_seconds(messages), _PERIOD, length).select(
        *_PERIOD, "second", "open_second", "close_second",
        F.when(F.col("opens"), F.col("first_offset")).alias("_opening"),
    )
    tails = with_tail(
        messages, [*_PERIOD, "second"], "offset", capacity, "_tail", chunk_rows=chunk_rows
    )
    held = tails.join(periods, [*_PERIOD, "second"]).filter(
        F.col("_opening").isNull() | (F.col("offset") != F.col("_opening"))
    )
    return (
        with_tail(
            held, [*_PERIOD, "open_second"], "offset", capacity, "from_back",
            chunk_rows=chunk_rows,
        )
        .select(*_PERIOD, "open_second", "close_second", "offset", "from_back")
    )
