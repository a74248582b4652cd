"""Ordered per-key computation that stays balanced when one key is hot.

``Window.partitionBy(key).orderBy(offset)`` sends all rows of a key to one task.
When a key may hold a third of the log that task never ends. The helpers here cut
a key's rows into chunks that are a pure function of the row, so recomputed tasks
agree, and work in three steps:

1. one summary row per (key, chunk), partially aggregated before its shuffle;
2. a window per key over the summaries only;
3. an equi-join that hands each chunk what came before it, and a window inside
   the chunk.

The chunk number is ``offset div CHUNK_ROWS``. An offset occurs once in a
partition and a key lives in one partition, so a chunk never holds more than
``CHUNK_ROWS`` rows, however hot the key is. Tables with one row per key and
second use ``second div DAY_SECONDS`` and are bounded the same way.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyfold.session import pinned

CHUNK_ROWS = 1 << 22
DAY_SECONDS = 86_400

_CHUNK = "_chunk"
_REDUCERS = {"sum": F.sum, "max": F.max, "min": F.min}

Reduction = tuple[str, Column]


def _chunk_of(order: str, chunk_rows: int) -> Column:
    # Integer division: a double quotient would lose large offsets.
    return F.call_function("div", F.col(order).cast("long"), F.lit(chunk_rows))


def _combine(how: str, left: Column, right: Column) -> Column:
    if how == "sum":
        return F.coalesce(left, F.lit(0)) + F.coalesce(right, F.lit(0))
    # greatest and least skip nulls, as max and min do.
    return (F.greatest if how == "max" else F.least)(left, right)


def with_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    *,
    chunk: Column | None = None,
    descending: bool = False,
    running: Mapping[str, Reduction] | None = None,
    totals: Mapping[str, Reduction] | None = None,
    previous: Mapping[str, Column] | None = None,
    chunk_rows: int = CHUNK_ROWS,
    keep_chunk: bool = False,
) -> DataFrame:
    """Add running values, key totals and previous-row values to every row.

    ``running[name] = (how, column)`` reduces the key's rows up to and including
    this one, ``totals[name]`` all rows of the key, with ``how`` one of ``sum``,
    ``max`` or ``min``. ``previous[name] = column`` is the value on the key's row
    just before, null on its first row. ``order`` must be unique within a key.
    ``chunk`` replaces the chunk number for orders that are no offsets; chunk numbers
    must ascend in the order asked for. ``keep_chunk`` leaves the chunk number in
    ``_chunk``: a second scan that is given it finds its rows already in place.
    """
    running, totals, previous = dict(running or {}), dict(totals or {}), dict(previous or {})
    if previous and descending:
        raise ValueError("previous values are defined for ascending order only")
    columns = [name for name in df.columns if name != _CHUNK]
    numbered = df.withColumn(_CHUNK, _chunk_of(order, chunk_rows) if chunk is None else chunk)
    # Stated here, so that both uses below filter alike and may share a shuffle.
    chunked = numbered.filter(F.col(_CHUNK).isNotNull())

    aggs = [
        _REDUCERS[how](column).alias(f"_sum_{name}")
        for name, (how, column) in {**running, **totals}.items()
    ]
    if previous:
        last = F.struct(*[column.alias(name) for name, column in previous.items()])
        aggs.append(F.max_by(last, F.col(order)).alias("_last"))
    summaries = chunked.groupBy(*keys, _CHUNK).agg(*aggs)

    per_key = Window.partitionBy(*keys)
    ordered = per_key.orderBy(_CHUNK)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    handed = [
        _REDUCERS[how](f"_sum_{name}").over(before).alias(f"_before_{name}")
        for name, (how, _) in running.items()
    ]
    handed += [
        _REDUCERS[how](f"_sum_{name}").over(per_key).alias(name)
        for name, (how, _) in totals.items()
    ]
    if previous:
        handed.append(F.lag("_last").over(ordered).alias("_prev_chunk"))
    carry = summaries.select(*keys, _CHUNK, *handed)

    joined = chunked.join(carry, [*keys, _CHUNK])
    in_order = F.col(order).desc() if descending else F.col(order).asc()
    in_chunk = Window.partitionBy(*keys, _CHUNK).orderBy(in_order)
    so_far = in_chunk.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    added = {
        name: _combine(how, F.col(f"_before_{name}"), _REDUCERS[how](column).over(so_far))
        for name, (how, column) in running.items()
    }
    if previous:
        before_row = F.coalesce(F.lag(last).over(in_chunk), F.col("_prev_chunk"))
        added.update({name: before_row[name] for name in previous})
    out = joined.withColumns(added) if added else joined
    kept = [_CHUNK] if keep_chunk else []
    return out.select(*columns, *running, *totals, *previous, *kept)


def with_tail(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    length: int,
    name: str,
    *,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """The last ``length`` rows of each key, numbered from 1 at the newest.

    Spark runs short rank limits below the shuffle too, so a map task sends at most
    ``length`` rows of a key. It does not for limits over its threshold: these are
    counted from the back chunk by chunk, so no task gets a hot key's whole history.
    """
    threshold = df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    if length <= int(threshold):
        newest = Window.partitionBy(*keys).orderBy(F.desc(order))
        ranked = df.withColumn(name, F.row_number().over(newest))
    else:
        ranked = with_scan(
            df, keys, order, descending=True, chunk=-_chunk_of(order, chunk_rows),
            running={name: ("sum", F.lit(1))},
        )
    return ranked.filter(F.col(name) <= length)


def with_rank(
    df: DataFrame, keys: Sequence[str], order: str, name: str, *, descending: bool = False
) -> DataFrame:
    """Add the 0-based rank of each row within its key, for an order of any type.

    Rows are range partitioned on (keys, order), which balances a key of any size,
    and the range number becomes the chunk. Ranges come from sampling, so the ranged
    rows are checkpointed once: both uses below, and any recomputed task, then see
    the same ranges.
    """
    place = F.col(order).desc() if descending else F.col(order).asc()
    ranged = df.repartitionByRange(*keys, place).withColumn("_range", F.spark_partition_id())
    staged = pinned(ranged)
    ranked = with_scan(
        staged, keys, order,
        chunk=F.col("_range"), descending=descending,
        running={name: ("sum", F.lit(1).cast("long"))},
    )
    return ranked.withColumn(name, F.col(name) - 1).drop("_range")


def rolling_sums(
    df: DataFrame,
    keys: Sequence[str],
    second: Column,
    window_seconds: int,
    sums: Mapping[str, Column],
) -> DataFrame:
    """Sums over the trailing ``window_seconds``, one row per key and second seen.

    The window at second ``s`` covers ``(s - window_seconds, s]``. What a second adds is
    taken back ``window_seconds`` later, so the rolling sum is a running sum and costs
    the same for any window length. Rows are aggregated to one per key and second
    before the ordered step, whose two passes share that shuffle.
    """
    per_second = df.groupBy(*keys, second.alias("second")).agg(
        *[F.sum(column).alias(name) for name, column in sums.items()]
    )
    # Even places take back and odd ones add, so that a second's leavers go first.
    leave, enter = (F.col("second") + window_seconds) * 2, F.col("second") * 2 + 1
    steps = per_second.withColumn("place", F.explode(F.array(enter, leave)))
    enters = F.col("place") % 2 == 1
    return (
        with_scan(
            steps, keys, "place", chunk_rows=2 * DAY_SECONDS,
            running={
                f"_rolling_{name}": ("sum", F.when(enters, F.col(name)).otherwise(-F.col(name)))
                for name in sums
            },
        )
        .filter(enters)
        .select(*keys, "second", *[F.col(f"_rolling_{name}").alias(name) for name in sums])
    )
