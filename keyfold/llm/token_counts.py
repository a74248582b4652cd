"""Exact histogram of encoded lengths, and what it answers for every context limit."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyfold.llm.store import staged
from keyfold.llm.tokens import ByteTokens

# Lengths that share a block of the two-level sums.
_BLOCK = 1024


def lengths(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens``: exact encoded length of every text; 0 for null and empty ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteTokens.shared(path, pattern)
        for batch in batches:
            counts = [len(encoder.ids(text.as_py())) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64())], ["doc_id", "n_tokens"]
            )

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long")


def histogram(counts: DataFrame, length_col: str = "n_tokens") -> DataFrame:
    """``n_tokens, n_docs``: documents by length, summed before the shuffle.

    Null lengths count as 0. An empty table gives no rows.
    """
    length = F.coalesce(F.col(length_col), F.lit(0)).cast("long")
    return counts.select(length.alias("n_tokens")).groupBy("n_tokens").agg(
        F.count("*").alias("n_docs")
    )


def suffix_sums(hist: DataFrame) -> DataFrame:
    """The histogram with sums over all documents at least as long, and what follows.

    For a row of length L: ``docs_from`` and ``tokens_from`` count documents of length L or
    more; ``docs_to`` those of length L or less. ``next_below`` is the next shorter length.
    ``truncated_tokens`` is the corpus's size if every document is cut at L. These hold for
    each limit between two lengths as well, see ``at_limits``.

    Sums go over blocks of lengths first and then within each block, so no task sees more
    than 1,024 lengths, or one row per block. The histogram is used twice, so it is staged:
    its documents are encoded once.
    """
    rows = staged(hist, "lengths").withColumn("_block", F.floor(F.col("n_tokens") / _BLOCK))
    tokens = F.col("n_tokens") * F.col("n_docs")
    blocks = rows.groupBy("_block").agg(
        F.sum("n_docs").alias("_docs"),
        F.sum(tokens).alias("_tokens"),
        F.max("n_tokens").alias("_longest"),
    )
    after = Window.orderBy(F.col("_block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    ahead = Window.orderBy("_block")
    blocks = blocks.select(
        F.col("_block").alias("_b"),
        F.coalesce(F.sum("_docs").over(after), F.lit(0)).alias("_docs_after"),
        F.coalesce(F.sum("_tokens").over(after), F.lit(0)).alias("_tokens_after"),
        F.lag("_longest").over(ahead).alias("_below"),
        F.sum("_docs").over(Window.partitionBy()).alias("_all_docs"),
        F.sum("_tokens").over(Window.partitionBy()).alias("_all_tokens"),
    )
    inside = Window.partitionBy("_block").orderBy(F.col("n_tokens").desc())
    order = Window.partitionBy("_block").orderBy("n_tokens")
    found = rows.join(blocks, F.col("_block") == F.col("_b"))
    found = found.select(
        "n_tokens",
        "n_docs",
        (F.sum("n_docs").over(inside) + F.col("_docs_after")).alias("docs_from"),
        (F.sum(tokens).over(inside) + F.col("_tokens_after")).alias("tokens_from"),
        F.coalesce(F.lag("n_tokens").over(order), F.col("_below")).alias("next_below"),
        "_all_docs",
        "_all_tokens",
    )
    return found.select(
        "n_tokens",
        "n_docs",
        "docs_from",
        "tokens_from",
        (F.col("_all_docs") - F.col("docs_from") + F.col("n_docs")).alias("docs_to"),
        "next_below",
        (
            F.col("_all_tokens") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")
        ).alias("truncated_tokens"),
        F.col("_all_docs").alias("all_docs"),
        F.col("_all_tokens").alias("all_tokens"),
    )


def at_limits(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """``context, docs_over, truncated_tokens`` for any limits, from the sums alone.

    ``docs_over`` counts documents longer than the limit. The smallest length above the
    limit carries all that is needed: those from there on are cut, the rest is whole.
    """
    spark = sums.sparkSession
    asked = spark.createDataFrame([(int(c),) for c in limits], "context long")
    longest = F.col("docs_from") == F.col("n_docs")
    first_over = (F.col("n_tokens") > F.col("context")) & (
        F.coalesce(F.col("next_below"), F.lit(-1)) <= F.col("context")
    )
    found = asked.join(sums, first_over | (longest & (F.col("n_tokens") <= F.col("context"))), "left")
    over = F.when(F.col("n_tokens") > F.col("context"), F.col("docs_from")).otherwise(0)
    kept = F.col("all_tokens") - F.col("tokens_from") + F.col("context") * F.col("docs_from")
    return found.select(
        "context",
        over.cast("long").alias("docs_over"),
        F.when(over > 0, kept).otherwise(F.coalesce(F.col("all_tokens"), F.lit(0))).alias(
            "truncated_tokens"
        ),
    )


def quantile(sums: DataFrame, share: float) -> DataFrame:
    """``n_tokens``: the smallest length that at least this share of documents do not exceed."""
    need = F.ceil(F.lit(float(share)) * F.col("all_docs"))
    return sums.filter(F.col("docs_to") >= need).agg(F.min("n_tokens").alias("n_tokens"))
