"""Timers as a table of commands.

``commands`` has ``topic, key, offset, timestamp, op`` and ``time``. Ops are
``schedule``, ``clear_and_schedule``, ``unschedule`` and ``clear_scheduled``. Times
are rounded to whole seconds; a timer is a (key, second), so scheduling it twice
leaves one.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.functions.times import SECOND_US, timer_second
from keyfold.plans.chunked import CHUNK_ROWS, DAY_SECONDS, with_scan
from keyfold.sources.events import ENTITY

_CLEARING = ("clear_scheduled", "clear_and_schedule")
_SETTING = ("schedule", "clear_and_schedule")


def scheduled_timers(commands: DataFrame, *, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Timers left per key after all commands, ignoring firing: topic, key, second.

    Commands are reduced to the last one per (key, second), with a key's clears as
    the cell without a second, before anything is compared across a key.
    """
    def last(*ops: str) -> Column:
        return F.max(F.when(F.col("op").isin(*ops), F.col("offset")))

    second = F.when(F.col("op") != "clear_scheduled", timer_second(F.col("time")))
    cells = (
        commands.withColumn("second", second)
        .groupBy(*ENTITY, "second")
        .agg(
            last(*_SETTING).alias("set_at"),
            last("unschedule").alias("removed_at"),
            last(*_CLEARING).alias("cleared_at"),
        )
        .withColumn("place", F.greatest("set_at", "removed_at", "cleared_at"))
    )
    scanned = with_scan(
        cells, ENTITY, "place",
        totals={"last_clear": ("max", F.col("cleared_at"))}, chunk_rows=chunk_rows,
    )
    return scanned.filter(_waits()).select(*ENTITY, "second")


def _waits() -> Column:
    # clear_and_schedule clears before it schedules, so its own timer stays.
    return (
        F.col("set_at").isNotNull()
        & (F.col("set_at") > F.coalesce("removed_at", F.lit(-1)))
        & (F.col("set_at") >= F.coalesce("last_clear", F.lit(-1)))
    )


def due_timers(timers: DataFrame, as_of: datetime) -> DataFrame:
    """Timers whose second has come at ``as_of``."""
    return timers.filter(F.col("second") <= F.unix_seconds(F.lit(as_of)))


def fired_timers(commands: DataFrame, *, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """How often each (key, second) fires while the key's clock runs along its commands.

    Due timers fire before the next command, and all that still wait fire at the end
    of input. So of the commands a key gives before a timer's second, only the last
    one that touches the timer counts; a command that sets a second already past
    fires each time. Columns: topic, key, second, firings.
    """
    clocked = with_scan(
        commands.select(
            *ENTITY, "offset", "op", F.unix_micros("timestamp").alias("us"),
            F.when(F.col("op") != "clear_scheduled", timer_second(F.col("time"))).alias("second"),
        ),
        ENTITY, "offset", running={"clock": ("max", F.col("us"))}, chunk_rows=chunk_rows,
    ).withColumn("clock_second", F.call_function("div", F.col("clock"), F.lit(SECOND_US)))

    # A command touches its timer at the timer's second, and a clear touches the whole
    # key at the clock's second. Both kinds of touch become one row per key, second and
    # kind, so that one ordered pass finds the last clear before each timer's second. A
    # clear in the timer's own second comes too late and sorts behind it.
    sets, early = F.col("op").isin(*_SETTING), F.col("clock_second") < F.col("second")
    nothing = F.lit(None).cast("long")
    on_timer = F.struct(
        F.col("second"), F.lit(0).alias("kind"),
        F.when(sets & early, F.col("offset")).alias("set_at"),
        F.when((F.col("op") == "unschedule") & early, F.col("offset")).alias("removed_at"),
        (sets & ~early).cast("long").alias("late"), nothing.alias("cleared_at"),
    )
    on_key = F.struct(
        F.when(F.col("op").isin(*_CLEARING), F.col("clock_second")).alias("second"),
        F.lit(1).alias("kind"), nothing.alias("set_at"), nothing.alias("removed_at"),
        nothing.alias("late"), F.col("offset").alias("cleared_at"),
    )
    touches = (
        clocked.select(*ENTITY, F.explode(F.array(on_timer, on_key)).alias("_t"))
        .select(*ENTITY, "_t.*")
        .filter("second IS NOT NULL")
        .groupBy(*ENTITY, "second", "kind")
        .agg(
            F.max("set_at").alias("set_at"), F.max("removed_at").alias("removed_at"),
            F.sum("late").alias("late"), F.max("cleared_at").alias("cleared_at"),
        )
        .withColumn("place", F.col("second") * 2 + F.col("kind"))
    )
    seen = with_scan(
        touches, ENTITY, "place",
        running={"last_clear": ("max", F.col("cleared_at"))}, chunk_rows=2 * DAY_SECONDS,
    ).filter("kind = 0")
    return seen.select(
        *ENTITY, "second", (F.col("late") + _waits().cast("long")).alias("firings")
    ).filter("firings > 0")
