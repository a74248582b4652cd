"""Joins of a whole log with a per-key table that is usually tiny."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.session import pinned

# One row per marked key: a key, a topic and an offset, so well under 100 bytes each.
BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Compute a reduced table once, and mark it for broadcast if it proves small.

    The rows go to the checkpoint folder, so that neither the count nor the join reads
    the source again. Counting stops at the limit. A larger table is returned as it is;
    the join then shuffles both sides, and adaptive execution splits skewed partitions.
    """
    if df.isStreaming:
        return df
    table = pinned(df)
    return table if table.limit(max_rows + 1).count() > max_rows else F.broadcast(table)


def after_last_mark(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    marked: Column,
    marks_from: DataFrame | None = None,
) -> DataFrame:
    """Rows that come after their key's last marked row; all rows of unmarked keys.

    Marks, such as excise records and clears, touch few keys. Their table is
    broadcast when it is proven small, so that the log itself need not be shuffled.
    ``marks_from`` is where the marks are, if not in ``df`` itself.
    """
    source = df if marks_from is None else marks_from
    marks = source.filter(marked).groupBy(*keys).agg(F.max(order).alias("_mark"))
    joined = df.join(broadcast_if_small(marks), list(keys), "left")
    return joined.filter(F.col("_mark").isNull() | (F.col(order) > F.col("_mark"))).select(
        *df.columns
    )
