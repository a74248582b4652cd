"""Harmonic packing of token sequences into bins of a fixed capacity."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyfold.llm.store import staged
from keyfold.llm.tokens import WordTokens

# Document ids that share a block when pieces are numbered.
_ID_BLOCK = 4096

_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cuts(tokens: int, capacity: int) -> list[int]:
    """Lengths of a document's pieces, in order; each is the capacity divided by a number.

    Whole bins come first. Of what is left, the largest reciprocal class that fits is cut
    off, until nothing remains. What remains falls with its square over the capacity, so
    this takes about three cuts.
    """
    found = [capacity] * (tokens // capacity)
    left = tokens % capacity
    while left:
        found.append(capacity // (capacity // (left + 1) + 1))
        left -= found[-1]
    return found


def pieces(
    docs: DataFrame,
    path: str,
    end_id: int,
    capacity: int,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode every text, add the end id, and cut the ids by ``cuts``.

    Returns ``doc_id, start, length, ids_crc32, doc_tokens``. Null and empty texts are one
    piece with the end id alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = WordTokens.shared(path), int(end_id).to_bytes(4, "little")
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.ids(batch.column(1))):
                ids, start = ids + end, 0
                for length in cuts(len(ids) // 4, capacity):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    rows.append((doc_id, start, length, crc, len(ids) // 4))
                    start += length
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            columns = zip(*rows) if rows else [()] * len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, pa.int64()) for column in columns], names
            )

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(run, _PIECES)


def _numbered(found: DataFrame) -> DataFrame:
    """Add ``_rank``: the piece's number in its class, by document id and start.

    Pieces are counted by class and block of document ids, the counts are summed along the
    blocks, and rows are numbered within a block. No class is ever gathered in one task.
    """
    block = F.coalesce(
        F.floor(F.col("doc_id") / _ID_BLOCK), -1 - F.pmod(F.col("ids_crc32"), F.lit(_ID_BLOCK))
    )
    rows = found.withColumn("_block", block)
    along = Window.partitionBy("_length").orderBy("_at").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        rows.groupBy(F.col("length").alias("_length"), F.col("_block").alias("_at"))
        .agg(F.count("*").alias("_n"))
        .select(
            "_length", "_at", F.coalesce(F.sum("_n").over(along), F.lit(0)).alias("_before")
        )
    )
    inside = Window.partitionBy("length", "_block").orderBy("doc_id", "start", "ids_crc32")
    ranked = rows.withColumn("_row", F.row_number().over(inside) - 1)
    joined = ranked.join(
        offsets, (F.col("length") == F.col("_length")) & (F.col("_block") == F.col("_at"))
    )
    return joined.select(
        *found.columns, (F.col("_row") + F.col("_before")).cast("long").alias("_rank")
    )


def _first_fit(capacity: int):
    """Place the bounded rest of all classes, longest pieces first."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(
            ["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True]
        ).reset_index(drop=True)
        free = np.zeros(0, np.int64)
        bins, offsets = [], []
        for length in rows["length"]:
            fits = np.flatnonzero(free >= length)
            if not len(fits):
                free, fits = np.append(free, capacity), [len(free)]
            bins.append(int(fits[0]))
            offsets.append(int(capacity - free[fits[0]]))
            free[fits[0]] -= length
        return rows.assign(sequence_id=rows["_first"] + np.array(bins, "int64"), offset=offsets)[
            ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        ].astype({"doc_id": "Int64", "sequence_id": "int64", "offset": "int64"})

    return run


def pack(found: DataFrame, capacity: int) -> DataFrame:
    """Assign pieces whose lengths are reciprocal classes to sequences.

    Input as from ``pieces``. A class of length L fills its bins with ``capacity // L``
    pieces each, by the piece's number alone, so bins are filled in any number of tasks at
    once. Only a class's last, incomplete bin is left over: fewer than ``capacity // L``
    pieces, for at most two square roots of the capacity classes, whatever the input's
    size. These are placed together by first fit.

    Adds ``sequence_id`` (gapless from 0) and ``offset`` (gapless from 0 in a sequence).
    Null and repeated document ids are pieces like any other. No rows give no rows.
    """
    ranked = staged(_numbered(found), "packing-ranks")
    in_bin = F.floor(F.lit(capacity) / F.col("length")).cast("long")
    longer = Window.orderBy(F.col("_length").desc())
    classes = (
        ranked.groupBy(F.col("length").alias("_length"))
        .agg(F.count("*").alias("_pieces"))
        .withColumn("_in_bin", F.floor(F.lit(capacity) / F.col("_length")).cast("long"))
        .withColumn("_bins", F.floor(F.col("_pieces") / F.col("_in_bin")).cast("long"))
        .select(
            "_length",
            "_bins",
            (F.sum("_bins").over(longer) - F.col("_bins")).alias("_base"),
            F.sum("_bins").over(Window.partitionBy()).alias("_first"),
        )
    )
    placed = ranked.join(F.broadcast(classes), F.col("length") == F.col("_length"))
    whole = F.col("_rank") < F.col("_bins") * in_bin
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    full = placed.filter(whole).select(
        *columns,
        (F.col("_base") + F.floor(F.col("_rank") / in_bin)).cast("long").alias("sequence_id"),
        (F.pmod(F.col("_rank"), in_bin) * F.col("length")).cast("long").alias("offset"),
    )
    rest = placed.filter(~whole).select(*columns, "_first")
    return full.unionByName(
        rest.groupBy("_first").applyInPandas(
            _first_fit(capacity), f"{_PIECES}, sequence_id long, offset long"
        )
    )


def pack_documents(
    docs: DataFrame,
    path: str,
    end_id: int = 2,
    capacity: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Encode, cut and pack every text; one row per piece.

    Texts are read and encoded once. The pieces, a few numbers each, are staged in the
    shared folder, since they are counted before they are placed.
    """
    found = staged(pieces(docs, path, end_id, capacity, id_col, text_col), "packing-pieces")
    return pack(found, capacity)
