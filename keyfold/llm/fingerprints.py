"""Homomorphic multiset fingerprints of documents.

A fingerprint is a vector of 512 sums modulo 2^32 and a count. Each paragraph is hashed to a
vector, and a document's is the sum over its paragraphs, so order has no effect, and
inserting or deleting a paragraph adds or subtracts its vector. Sixteen sums take part in
every paragraph and tell multisets apart. Of the others, sixteen each count half, a quarter,
an eighth of all paragraphs, and so on down to one in 2^31, more than a text can hold: from
how many of them agree, the number of different paragraphs in which two documents differ can
be told, whatever it is.

Paragraphs are the non-empty lines of a text. All expressions are built in.
"""

from __future__ import annotations

import math
from functools import cache

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GROUPS = 32
PER_GROUP = 16
LANES = GROUPS * PER_GROUP
# Groups summed over every paragraph; the others only over paragraphs that count in one.
_DENSE = 8
_MASK = (1 << 32) - 1


def paragraphs(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda p: p != "")


def _lane_list(first: int, end: int) -> Column:
    """For each lane of some groups: its draw, and the low bits that let a paragraph count.

    A draw's trailing zeros choose one of the groups that share it, so that group g counts
    one paragraph in 2^g. The first group has draws of its own and counts all.
    """
    return F.array(
        *[
            F.struct(
                F.lit(k + PER_GROUP * (g > 0)).alias("draw"),
                F.lit((1 << g) - 1).cast("long").alias("bits"),
                F.lit((1 << g) >> 1 if g else 0).cast("long").alias("are"),
            )
            for g in range(first, end)
            for k in range(PER_GROUP)
        ]
    )


def _sums(draws: Column, first: int, end: int) -> Column:
    """Sums of the lanes of some groups over an array of paragraphs' draws."""
    zero = F.array_repeat(F.lit(0).cast("long"), (end - first) * PER_GROUP)

    def add(sums: Column, own: Column) -> Column:
        def one(s: Column, lane: Column) -> Column:
            x = F.get(own, lane["draw"])
            part = F.when(x.bitwiseAND(lane["bits"]) == lane["are"], F.shiftrightunsigned(x, 32))
            return (s + part.otherwise(F.lit(0).cast("long"))).bitwiseAND(F.lit(_MASK))

        return F.zip_with(sums, _lane_list(first, end), one)

    return F.aggregate(draws, zero, add)


def vector(paras: Column) -> Column:
    """Sums of an array of paragraphs: 512 lanes, then their number. No paragraphs: zeros."""
    hashes = F.transform(
        paras, lambda p: F.struct(F.xxhash64(p).alias("a"), F.xxhash64(p, F.lit(1)).alias("b"))
    )
    drawn = F.transform(
        hashes, lambda h: F.array(*[F.xxhash64(h["a"], h["b"], F.lit(i)) for i in range(2 * PER_GROUP)])
    )
    sparse = F.lit((1 << (_DENSE - 1)) - 1).cast("long")

    def lanes(draws: Column) -> Column:
        few = F.filter(
            draws,
            lambda own: F.exists(
                F.slice(own, PER_GROUP + 1, PER_GROUP), lambda x: x.bitwiseAND(sparse) == 0
            ),
        )
        return F.concat(_sums(draws, 0, _DENSE), _sums(few, _DENSE, GROUPS))

    # an array of one, so that the draws are made once
    return F.concat(
        F.get(F.transform(F.array(drawn), lanes), F.lit(0)),
        F.array(F.size(paras).cast("long").bitwiseAND(F.lit(_MASK))),
    )


def inserted(sums: Column, paras: Column) -> Column:
    """The vector after inserting an array of paragraphs."""
    return F.zip_with(sums, vector(paras), lambda a, b: (a + b).bitwiseAND(F.lit(_MASK)))


def deleted(sums: Column, paras: Column) -> Column:
    """The vector after deleting an array of paragraphs that it holds."""
    return F.zip_with(
        sums, vector(paras), lambda a, b: (a - b + F.lit(_MASK + 1)).bitwiseAND(F.lit(_MASK))
    )


def as_text(sums: Column) -> Column:
    return F.array_join(F.transform(sums, lambda v: F.lpad(F.lower(F.hex(v)), 8, "0")), "")


@cache
def _differences() -> tuple[float, ...]:
    """Paragraphs that differ, by the number of lanes that agree: the mean's inverse."""

    def agreeing(q: float) -> float:
        return sum(PER_GROUP * math.exp(q * math.log1p(-(2.0**-g))) for g in range(1, GROUPS))

    found = []
    for equal in range(LANES + 1):
        low, high = 0.0, 2.0 ** (GROUPS + 3)
        for _ in range(80):
            middle = (low + high) / 2
            low, high = (middle, high) if agreeing(middle) > equal else (low, middle)
        found.append(low)
    return tuple(found)


def likeness(a: Column, b: Column) -> Column:
    """1 for equal vectors, else the estimated share of paragraphs that both have, 0 to 1."""
    equal = F.size(F.filter(F.zip_with(F.slice(a, 1, LANES), F.slice(b, 1, LANES), lambda x, y: x == y), lambda e: e))
    apart = F.element_at(F.array(*[F.lit(d) for d in _differences()]), equal + 1)
    n, m = F.element_at(a, LANES + 1), F.element_at(b, LANES + 1)
    differ = F.greatest(apart, F.abs(n - m).cast("double"), F.lit(1.0))
    share = F.greatest(F.lit(0.0), 1 - differ / F.greatest(n + m, F.lit(1)))
    return F.when(a == b, F.lit(1.0)).otherwise(share)


def _blocks(rows: DataFrame) -> tuple[list[int], bool]:
    """First ids of ranges of documents, and whether there are null ids.

    The ids are ones that occur, as many as a few per shuffle partition, and rows of the
    same id share a range.
    """
    count = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [k / count for k in range(1, count)]
    least, ids, every, cuts = rows.agg(
        F.min("doc_id"),
        F.count("doc_id"),
        F.count("*"),
        F.percentile_approx("doc_id", shares, 10 * count),
    ).first()
    return sorted({least, *cuts} if ids else set()), every > ids


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text, sums, next_text, next_sums``: every document with the one after it.

    The order is by id, nulls first, then text; the first document follows the last. Texts
    are dealt once, by range of ids. The first document of each range is also sent to the
    range before it, so each range is complete by itself. Null texts are empty.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    bounds, nulls = _blocks(rows)
    starts = F.array(*[F.lit(b) for b in bounds]).cast("array<long>")
    place = F.greatest(
        F.lit(0), F.size(F.filter(starts, lambda b: b <= F.coalesce("doc_id", F.lit(-(1 << 63))))) - 1
    )
    first = F.col("doc_id").isNull() if nulls else F.col("doc_id") == F.lit(bounds[0] if bounds else 0)
    opens = F.array_contains(starts, F.col("doc_id")) & (F.col("_place") > 0)
    own = F.struct(F.col("_place").alias("at"), F.lit(0).alias("copy"))
    before = F.struct(
        F.when(F.col("_place") > 0, F.col("_place") - 1).otherwise(max(0, len(bounds) - 1)).alias("at"),
        F.lit(1).alias("copy"),
    )
    sent = F.when(F.coalesce(first | opens, F.lit(False)), F.array(own, before)).otherwise(F.array(own))
    rows = rows.withColumn("_place", place).withColumn("sums", vector(paragraphs(F.col("text"))))
    rows = rows.select("doc_id", "text", "sums", F.explode(sent).alias("_to"))
    # plain columns, so that both windows below share one shuffle
    rows = rows.select(
        "doc_id", "text", "sums", F.col("_to.at").alias("_at"), F.col("_to.copy").alias("_copy")
    )
    order = Window.partitionBy("_at").orderBy(
        "_copy", F.col("doc_id").asc_nulls_first(), "text"
    )
    return (
        rows.withColumn("next_text", F.lead("text").over(order))
        .withColumn("next_sums", F.lead("sums").over(order))
        .filter("_copy = 0")
        .drop("_at", "_copy")
    )


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness.

    The edited text is the text with its last half replaced by as much, or all, of the
    start of the next document.
    """
    rows = with_next(docs, id_col, text_col).withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
        F.substring("next_text", F.lit(1), half),
    )
    rows = rows.withColumn("edited", edited)
    rows = rows.withColumn("edited_sums", vector(paragraphs(F.col("edited"))))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("sums")).alias("fingerprint"),
        as_text(F.col("edited_sums")).alias("edited_fingerprint"),
        likeness(F.col("sums"), F.col("edited_sums")).alias("near_edited"),
        likeness(F.col("sums"), F.col("next_sums")).alias("near_next"),
    )
