"""Byte-level BPE: ids of whole texts, and bytes of ids."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyfold.llm.tokens import ByteTokens


def encode(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, ids``: the token ids of every text. Null and empty texts have no ids.

    One pass over the input without a shuffle; a worker holds one text's ids at a time
    beside its batch. Repeated rows give repeated rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteTokens.shared(path, pattern)
        for batch in batches:
            ids = [encoder.ids(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"]
            )

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, data``: the raw bytes behind ``doc_id, ids``. Null ids give no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteTokens.shared(path, pattern)
        for batch in batches:
            data = [encoder.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(data, pa.binary())], ["doc_id", "data"]
            )

    rows = tokens.select(F.col("doc_id").cast("long"), F.col("ids").cast("array<int>"))
    return rows.mapInArrow(run, "doc_id long, data binary")


def digests(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text.

    Encodes, hashes the ids as little-endian unsigned 32-bit integers, decodes the ids and
    hashes the bytes, all in one pass, so that no ids leave the worker. Null texts count
    as empty: no tokens, and the hashes of no bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = ByteTokens.shared(path, pattern)
        for batch in batches:
            counts, hashes, decoded = [], [], []
            for text in batch.column(1):
                ids = encoder.ids(text.as_py())
                counts.append(len(ids))
                hashes.append(hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
                decoded.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(hashes, pa.string()),
                    pa.array(decoded, pa.string()),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    return rows.mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
