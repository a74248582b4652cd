"""Ranked lexical search of a stated set of items over all documents, exactly.

A document is a sparse vector of term weights, an item the set of its terms, and a score
their inner product, in whole numbers. Tasks build ball trees over blocks of documents and
prune subtrees that cannot reach an item's best so far (``ball_tree``). A task passes on no
more than the wanted number of documents an item.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyfold.llm.ball_tree import BallTree, Best, Queries
from keyfold.llm.store import staged

# Letters and digits of ASCII, A-Z lower-cased, and all bytes of other characters.
_LOWERED = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 0x80 else 32
    for b in range(256)
)
# Groups into which candidates are dealt before an item's best are taken.
_DEALS = 256


@dataclass(frozen=True)
class Bounds:
    """What one pass and one tree hold at most; more items take more passes.

    None of these changes results.
    """

    items: int = 256
    terms: int = 1 << 15
    tree_rows: int = 4096
    tree_cells: int = 1 << 20
    leaf: int = 32


def terms_of(text: str | None) -> list[bytes]:
    """A text's terms in order, as UTF-8. A null text has none."""
    return text.encode().translate(_LOWERED).split() if text else []


def item_blocks(items: DataFrame, bounds: Bounds) -> Iterator[dict]:
    """Sets of terms by item id, a bounded number of items and terms at a time.

    Rows that repeat an item id are one item with the terms of all of them. Items are read
    in the order of their ids, one partition at a time.
    """
    block, terms = {}, 0
    for item, text in items.orderBy("item_id").toLocalIterator():
        held = set(terms_of(text))
        if item not in block and block and (len(block) == bounds.items or terms + len(held) > bounds.terms):
            yield block
            block, terms = {}, 0
        terms += len(held - block.get(item, set()))
        block.setdefault(item, set()).update(held)
    if block:
        yield block


def index(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """``doc_id, n, terms, counts`` of every document with at least one term.

    ``n`` counts all of its terms with repeats. ``terms`` are places in ``vocabulary``, with
    how often each occurs; terms outside it add nothing to any item's score.
    """
    places = {term: k for k, term in enumerate(vocabulary)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, terms, counts, lengths = [], [], [], [], [0]
            for k, text in enumerate(batch.column(1)):
                words = terms_of(text.as_py())
                if not words:
                    continue
                found = [(places[w], n) for w, n in Counter(words).items() if w in places]
                kept.append(k)
                sizes.append(len(words))
                terms += [t for t, _ in found]
                counts += [n for _, n in found]
                lengths.append(len(terms))
            offsets = pa.array(lengths, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(kept, pa.int64())),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                    pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
                ],
                ["doc_id", "n", "terms", "counts"],
            )

    return docs.mapInArrow(run, "doc_id long, n long, terms array<int>, counts array<long>")


def weight(documents: int, holding: int) -> int:
    """The weight of a term that ``holding`` of ``documents`` hold."""
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def impacts(
    starts: np.ndarray, counts: np.ndarray, sizes: np.ndarray, documents: int, tokens: int
) -> np.ndarray:
    """What counts add to a score, before the terms' weights. Row i has ``starts[i]:starts[i + 1]``."""
    lengths = np.array([10 + 90 * n * documents // tokens for n in sizes.tolist()], np.int64)
    return (1_000_000_000 * counts) // (1000 * counts + 8 * np.repeat(lengths, np.diff(starts)))


def _blocks(batch: pa.RecordBatch, bounds: Bounds) -> Iterator[tuple[np.ndarray, ...]]:
    """Rows with terms of the vocabulary, a bounded number of rows and cells at a time."""
    offsets = batch.column(2).offsets.to_numpy()
    terms = batch.column(2).values.to_numpy()
    counts = batch.column(3).values.to_numpy()
    filled = np.flatnonzero(np.diff(offsets))
    ids = batch.column(0)
    null = np.asarray(ids.is_null())
    ids, sizes = ids.fill_null(0).to_numpy(), batch.column(1).to_numpy()
    at = 0
    while at < len(filled):
        end = at + 1
        first = offsets[filled[at]]
        while end < len(filled) and end - at < bounds.tree_rows:
            if offsets[filled[end] + 1] - first > bounds.tree_cells:
                break
            end += 1
        rows = filled[at:end]
        # rows between these hold nothing, so the cells lie side by side
        starts = np.append(offsets[rows], offsets[rows[-1] + 1]) - first
        cells = slice(first, first + starts[-1])
        yield ids[rows], null[rows], sizes[rows], starts, terms[cells], counts[cells]
        at = end


def candidates(
    rows: DataFrame,
    sets: list[list[int]],
    weights: list[int],
    documents: int,
    tokens: int,
    k: int,
    bounds: Bounds,
) -> DataFrame:
    """``item, doc_id, score``: of every task, each item's ``k`` best documents."""
    # a tree's means are dense: fewer leaves where the vocabulary is wide
    leaves = max(1, (bounds.terms * 64) // max(1, len(weights)))
    tree_rows = min(bounds.tree_rows, bounds.leaf * leaves)
    bounds = Bounds(bounds.items, bounds.terms, tree_rows, bounds.tree_cells, bounds.leaf)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = Queries(sets, len(weights))
        best, weigh = Best(len(sets), k), np.array(weights, np.int64)
        for batch in batches:
            for ids, null, sizes, starts, terms, counts in _blocks(batch, bounds):
                per_cell = impacts(starts, counts, sizes, documents, tokens)
                tree = BallTree(starts, terms, weigh[terms] * per_cell, queries, bounds.leaf)
                tree.search(best, ids, null)
        found = list(best.rows())
        columns = list(zip(*found)) if found else [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())],
            ["item", "doc_id", "score"],
        )

    return rows.mapInArrow(run, "item int, doc_id long, score long")


def best_of(found: DataFrame, k: int) -> DataFrame:
    """Each item's ``k`` best rows with their ``rank``: of deals of them first, then of all."""
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    dealt = found.withColumn("_deal", F.pmod(F.xxhash64("doc_id", "score"), F.lit(_DEALS)))
    first = Window.partitionBy("item", "_deal").orderBy(*order)
    dealt = dealt.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= k)
    last = Window.partitionBy("item").orderBy(*order)
    return (
        dealt.select("item", "doc_id", "score")
        .withColumn("rank", F.row_number().over(last))
        .filter(F.col("rank") <= k)
    )


def rank(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    bounds: Bounds = Bounds(),
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents with a score above 0.

    Whole texts of all documents are indexed and searched. Equal scores go by ascending id,
    null ids last; rows that repeat an id are documents of their own. Null and empty texts
    of documents count nowhere; items without terms, or with an id of null, have no rows.
    Empty tables give no rows.

    Items are searched in blocks of bounded size, each in two passes: one reads the texts
    and stages, per document, its counts of the block's terms; one searches these.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )
    asked = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    spark = docs.sparkSession
    schema = f"item int, item_id {asked.schema['item_id'].dataType.simpleString()}"
    found = None
    for block in item_blocks(asked.filter("item_id is not null"), bounds):
        vocabulary = sorted(set().union(*block.values()))
        places = {term: at for at, term in enumerate(vocabulary)}
        sets = [sorted(places[t] for t in held) for held in block.values()]
        held = staged(index(rows, vocabulary), "lexical-index")
        documents, tokens = held.agg(F.count("*"), F.sum("n")).first()
        if not documents:
            continue
        holding = [0] * len(vocabulary)
        for term, n in held.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            holding[term] = n
        weights = [weight(documents, n) for n in holding]
        names = spark.createDataFrame(list(enumerate(block)), schema)
        part = best_of(candidates(held, sets, weights, documents, tokens, k, bounds), k)
        part = part.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame(
            [], f"item_id {asked.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long"
        )
    return found
