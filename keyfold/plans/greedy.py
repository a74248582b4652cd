"""Fixed-length periods anchored at the first event that finds none open.

A period opens with an event, lasts a fixed length, and the next event at or after
its end opens the next one. Where a period starts depends on the one before, so
neither tumbling nor session windows express it. Ends are whole seconds, which
bounds the ordered part: within a second only the first event can open a period.
The input is therefore one row per key and second (at most 86,400 per key and
day, whatever the event rate), and a task walks its sorted rows in Arrow batches
and holds two numbers, never a group.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from keyfold.functions.times import HALF_SECOND_US, SECOND_US, Duration, duration_us


def greedy_periods(
    candidates: DataFrame, keys: Sequence[str], length: Duration
) -> DataFrame:
    """Add ``opens``, ``open_second`` and ``close_second`` to each candidate.

    ``candidates`` has one row per key and ``second``, with ``first_us``, the time
    of its first event in epoch microseconds.
    """
    length_us = duration_us(length, "length")
    if length_us < SECOND_US:
        raise ValueError("length: periods shorter than a second are not supported")
    schema = T.StructType(
        [
            *candidates.schema.fields,
            T.StructField("opens", T.BooleanType()),
            T.StructField("open_second", T.LongType()),
            T.StructField("close_second", T.LongType()),
        ]
    )
    names = list(keys)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: tuple | None = None
        opened, closes = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
            seconds = batch.column(batch.schema.get_field_index("second")).to_numpy()
            first_us = batch.column(batch.schema.get_field_index("first_us")).to_numpy()
            # A key with one row here opens with it. Only longer stretches are walked,
            # and the first and last one, which may go on in the batch before or after.
            open_at, opens = seconds.copy(), np.ones(len(seconds), bool)
            close_at = (first_us + (length_us + HALF_SECOND_US)) // SECOND_US
            edges = _edges(columns, len(seconds))
            walked = np.diff(edges) > 1
            walked[[0, -1]] = True
            for run in np.flatnonzero(walked):
                at, stop = int(edges[run]), int(edges[run + 1])
                key = tuple(column[at].as_py() for column in columns)
                if key != current:
                    current, closes = key, None
                while at < stop:
                    if closes is not None and seconds[at] < closes:
                        inside = at + int(np.searchsorted(seconds[at:stop], closes))
                        open_at[at:inside], close_at[at:inside] = opened, closes
                        opens[at:inside] = False
                        at = inside
                    else:
                        opened, closes = int(seconds[at]), int(close_at[at])
                        at += 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(opens), pa.array(open_at), pa.array(close_at)],
                names=[*batch.schema.names, "opens", "open_second", "close_second"],
            )

    return (
        candidates.repartition(*keys)
        .sortWithinPartitions(*keys, "second")
        .mapInArrow(walk, schema)
    )


def _edges(columns: Sequence[pa.Array], length: int) -> np.ndarray:
    """Where the stretches of equal keys in a sorted batch begin, and the end."""
    changed = np.zeros(length - 1, bool)
    for column in columns:
        codes = column.dictionary_encode(null_encoding="encode").indices.to_numpy()
        changed |= codes[1:] != codes[:-1]
    return np.concatenate([[0], np.flatnonzero(changed) + 1, [length]])
