"""Spelling variants: words one edit apart, by an asymmetric join on chunks.

Of two words one edit apart, the shorter (of equal ones the lesser) is cut into two
disjoint chunks. One edit touches one of them, so the other stands in the second word,
moved by no more than one place. The second word contributes its positional grams; both
lengths fix how far a chunk has moved, so only the grams at that place can meet a chunk and
only they are sent. Words that meet are then compared in full.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.llm.store import new_folder, removed, small_side, staged

# Bytes of words that a task counts before it passes the counts on.
_TABLE_BYTES = 64 << 20
# What a word takes in the table beside its letters.
_WORD_BYTES = 160
# Pairs of words that one task compares for one chunk; larger buckets are split.
BUCKET_PAIRS = 4_000_000

# Letters are A-Z, a-z and the code points C0 to FF, which Latin-1 holds in one byte each.
_LOWERED = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256)
)


@dataclass(frozen=True)
class Wanted:
    """Words of at least ``length`` code points that occur at least ``times`` times."""

    length: int = 5
    times: int = 3
    # a run loses a letter where this divides its checksum; 0 leaves all runs as they are
    spoil: int = 97


def runs(text: str) -> list[bytes]:
    """A text's letter runs, A-Z lower-cased, as Latin-1: a byte is a code point."""
    return text.encode("latin-1", "replace").translate(_LOWERED).split()


def spoiled(run: bytes, prefix: int, by: int) -> bytes:
    """The run, without one letter if ``by`` divides the checksum of ``<doc_id>:<run>``."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), prefix)
    if h % by:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def word_counts(
    docs: DataFrame, wanted: Wanted = Wanted(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``word, n``: wanted words of all whole texts and how often they occur.

    Null and empty texts have none; a null id counts as empty text. Tasks count words in a
    table of bounded size before anything is shuffled, and Spark sums the counts.
    """
    length, by = wanted.length, wanted.spoil

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> pa.RecordBatch:
            words = [w.decode("latin-1") for w in counts]
            return pa.RecordBatch.from_arrays(
                [pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())],
                ["word", "n"],
            )

        counts: Counter[bytes] = Counter()
        held = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                found = Counter(runs(text.as_py() or ""))
                if not found:
                    continue
                prefix = zlib.crc32(f"{'' if doc_id.as_py() is None else doc_id.as_py()}:".encode())
                before = len(counts)
                for word, n in found.items():
                    if by:
                        word = spoiled(word, prefix, by)
                    if len(word) >= length:
                        counts[word] += n
                        if len(word) > 256:
                            held += len(word)
                held += (len(counts) - before) * _WORD_BYTES
                if held > _TABLE_BYTES:
                    yield rows()
                    counts, held = Counter(), 0
        if counts:
            yield rows()

    rows = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"))
    counted = rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.filter(F.col("n") >= wanted.times)


def _key(which: int, length: Column, other: Column, gram: Column) -> Column:
    """Where a chunk of a word and a gram of a longer or equal one meet."""
    return F.xxhash64(F.lit(which), length, other, gram)


def _chunks(words: DataFrame) -> DataFrame:
    """``a, key``: each word's two disjoint chunks, for partners as long and one longer."""
    size, half = F.length("word"), F.floor(F.length("word") / 2).cast("int")
    first, second = F.substring("word", F.lit(1), half), F.substring("word", half + 1, size)
    keys = [
        _key(which, size, size + more, gram)
        for more in (0, 1)
        for which, gram in ((0, first), (1, second))
    ]
    return words.select(F.col("word").alias("a"), F.explode(F.array(*keys)).alias("key"))


def _grams(words: DataFrame) -> DataFrame:
    """``b, key``: each word's grams at the places that chunks of a word as long, or one
    shorter, can have moved to: none, or one."""
    size = F.length("word")
    keys = []
    for less in (0, 1):
        other = size - less
        half = F.floor(other / 2).cast("int")
        keys.append(_key(0, other, size, F.substring("word", F.lit(1), half)))
        keys.append(_key(1, other, size, F.substring("word", half + 1 + less, other)))
    return words.select(F.col("word").alias("b"), F.explode(F.array(*keys)).alias("key"))


def near_pairs(words: DataFrame, bucket_pairs: int = BUCKET_PAIRS) -> DataFrame:
    """``a, b``: all pairs of different words that are one insertion, deletion or replacement
    apart, each once, the shorter or lesser word first.

    ``words`` has distinct words of two code points or more in ``word`` and is read several
    times, so pass a staged table. A chunk with very many words is split: its words are
    dealt over as many tasks as its pairs ask for, and their partners sent to each.
    """
    chunks, grams = _chunks(words), _grams(words)
    counted = (
        chunks.select("key", F.lit(1).alias("x"), F.lit(0).alias("y"))
        .unionByName(grams.select("key", F.lit(0).alias("x"), F.lit(1).alias("y")))
        .groupBy("key")
        .agg(F.sum("x").alias("x"), F.sum("y").alias("y"))
    )
    parts = F.ceil(F.col("x") * F.col("y") / F.lit(float(bucket_pairs)))
    large = counted.filter(F.col("x") * F.col("y") > bucket_pairs)
    folder = new_folder(words.sparkSession, "spelling-large")
    large = staged(large.select(F.col("key").alias("_key"), parts.cast("int").alias("_parts")), "", folder)
    large = small_side(large, row_bytes=16)
    split = F.coalesce("_parts", F.lit(1))
    same = F.col("key") == F.col("_key")
    left = chunks.join(large, same, "left").select(
        "a", "key", F.pmod(F.xxhash64("a", F.lit("part")), split).cast("int").alias("part")
    )
    right = grams.join(large, same, "left").select(
        "b", "key", F.explode(F.sequence(F.lit(0), split - 1)).alias("part")
    )
    met = left.join(right, ["key", "part"]).filter(
        ((F.length("a") < F.length("b")) | (F.col("a") < F.col("b")))
        & (F.levenshtein("a", "b", 1) == 1)
    )
    return met.select("a", "b").distinct()


def forms(words: DataFrame, pairs: DataFrame, times: int = 2) -> DataFrame:
    """``word, n, n_near, form, form_n``: each word's most frequent near word, if it occurs at
    least ``times`` times as often; of equally frequent ones the first in code-point order."""
    sides = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    known = words.select(F.col("word").alias("b"), F.col("n").alias("m"))
    best = (
        sides.join(known, "b")
        .groupBy("a")
        .agg(F.count("*").alias("k"), F.min(F.struct((-F.col("m")).alias("m"), "b")).alias("top"))
        .select(F.col("a"), "k", (-F.col("top.m")).alias("m"), F.col("top.b").alias("b"))
    )
    found = words.join(best, F.col("word") == F.col("a"), "left")
    enough = F.col("m") >= F.col("n") * times
    return found.select(
        "word",
        "n",
        F.coalesce("k", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("b")).alias("form"),
        F.when(enough, F.col("m")).alias("form_n"),
    )


def roots(links: DataFrame) -> DataFrame:
    """``word, root`` of each row of ``word, form``: the end of its chain of forms.

    Each round doubles the steps taken, and a form is at least twice as frequent as its
    word, so chains are short: seven rounds end any chain of counts below 2^63.
    """
    spark = links.sparkSession
    folder = new_folder(spark, "spelling-roots")
    now = staged(links.select("word", F.col("form").alias("root")), "", folder)
    for _ in range(7):
        step = now.select(F.col("word").alias("_at"), F.col("root").alias("_next"))
        moved = now.join(step, F.col("root") == F.col("_at"), "left")
        following = new_folder(spark, "spelling-roots")
        now = staged(
            moved.select("word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("_on")),
            "",
            following,
        )
        removed(spark, folder)
        folder = following
        if now.filter("_on").limit(1).count() == 0:
            return now.select("word", "root")
        now = now.select("word", "root")
    raise RuntimeError("a chain of forms does not end")


def report(
    docs: DataFrame,
    wanted: Wanted = Wanted(),
    times: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every wanted word.

    Null, empty and blank texts have no words; a run of any length is one word. Repeated
    rows count again. Tables without wanted words give no rows.
    """
    words = staged(word_counts(docs, wanted, id_col, text_col), "spelling-words")
    pairs = staged(near_pairs(words), "spelling-pairs")
    found = staged(forms(words, pairs, times), "spelling-forms")
    ends = roots(found.filter("form is not null")).select(F.col("word").alias("_word"), "root")
    joined = found.join(ends, F.col("word") == F.col("_word"), "left")
    return joined.select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
