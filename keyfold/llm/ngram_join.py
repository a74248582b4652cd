"""Exact Jaccard self-join of documents' word n-gram sets, by vertical partitioning.

The n-grams have one global order, rare ones first, which is cut into fragments. A
document's set is cut along with it. The overlap of two documents is counted in every
fragment on its own, and the partial counts are summed per pair.

What makes this bearable on a large corpus:

* Documents with equal sets are one class, and only classes are joined.
* A first filter reads a small part of every set. Under any fixed order, two linked sets
  share at least k of their first (allowed misses + k) n-grams. Ordered by hash, a set in
  whose first part too few n-grams occur in any other class has no link at all.
* The sets that remain are ordered by how many of them hold an n-gram. Two linked sets
  share one of their first (allowed misses + 1) in that order, where n-grams are rarest.
  Position and length bounds drop most other pairs.
* Pairs are not formed within a group of mutual copies. In every bucket of a shared n-gram,
  each class is first compared with one class only, and what proves connected is merged.
  Only classes of a bucket that are still apart are then compared with each other.

The result is exact: which documents are connected by links, whatever the hash. N-grams are
64-bit hashes and sets 128-bit hashes; two that differ are taken for different. While lists
are made, a class goes by a 64-bit hash of its set's hash together with its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.llm.components import components
from keyfold.llm.store import new_folder, removed, small_side, staged, unused

# Bytes of word hashes kept by a task, about; a full table is emptied.
_TABLE_BYTES = 48 << 20
# What a word takes in the table beside its letters.
_WORD_BYTES = 170
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_MIXER = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Likeness:
    """Sets of ``n`` words; linked when ``over * intersection >= part * union``."""

    n: int = 5
    part: int = 80
    over: int = 100
    fragments: int = 8

    def misses(self, size: int) -> int:
        """How many of a set's n-grams a linked set may lack."""
        return size - -(-self.part * size // self.over)

    def shared(self, size: int) -> int:
        """The k of the first filter, in proportion to what a linked set must share. A larger
        k leaves fewer classes, but more is read before it."""
        return max(1, (size - self.misses(size)) // 12)

    def misses_of(self, size: Column) -> Column:
        return size - F.ceil(size * self.part / F.lit(float(self.over))).cast("long")

    def least_shared_of(self, size: Column) -> Column:
        """The smallest k that any linked set has, the smallest linked sets having the least."""
        least = F.ceil(size * self.part / F.lit(float(self.over))).cast("long")
        return F.greatest(F.lit(1), F.floor((least - self.misses_of(least)) / 12)).cast("long")


def ngrams(text: bytes, n: int, table: dict[bytes, int]) -> np.ndarray:
    """Sorted distinct hashes of a text's word n-grams; fewer words are one n-gram."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    for word in words:
        if word not in table:
            table[word] = xxhash.xxh3_64_intdigest(word)
    hashes = np.fromiter(map(table.__getitem__, words), np.uint64, len(words))
    width = min(n, len(words))
    mixed = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        mixed = (mixed ^ hashes[k : len(hashes) - width + 1 + k]) * _MULTIPLIER
        mixed ^= mixed >> np.uint64(32)
        mixed *= _MIXER
        mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def _sets(rows: DataFrame, rule: Likeness, whole: bool) -> DataFrame:
    """``doc_id, mark, n_shingles, set_key, grams`` of ``doc_id, mark, text``.

    ``grams`` is the whole set, or the part that the first filter reads. Lower-casing of
    bytes changes A-Z alone, and splitting them cuts at ASCII white space alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table: dict[bytes, int] = {}
        held = 0
        for batch in batches:
            sizes, keys, parts = [], [], []
            for text in batch.column(2):
                known = len(table)
                data = (text.as_py() or "").encode()
                grams = ngrams(data, rule.n, table)
                held += (len(table) - known) * _WORD_BYTES
                # a text of few long words may fill the table as well
                if held > _TABLE_BYTES or len(data) > _TABLE_BYTES:
                    table, held = {}, 0
                sizes.append(len(grams))
                keys.append(xxhash.xxh3_128_digest(grams.tobytes()) if len(grams) else None)
                if not whole:
                    grams = grams[: rule.misses(len(grams)) + rule.shared(len(grams))]
                parts.append(grams.view(np.int64))
            lengths = np.array([0, *map(len, parts)], np.int64).cumsum().astype(np.int32)
            flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(lengths), pa.array(flat)),
                ],
                ["doc_id", "mark", "n_shingles", "set_key", "grams"],
            )

    return rows.mapInArrow(
        run, "doc_id long, mark long, n_shingles long, set_key binary, grams array<long>"
    )


def _suspects(parts: DataFrame, rule: Likeness) -> DataFrame:
    """``set_key`` of classes that may have a link, by the first filter."""
    own = F.xxhash64("set_key").alias("c")
    held = parts.filter("n_shingles > 0").select(own, F.explode("grams").alias("gram"))
    shared = held.groupBy("gram").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
    shared = shared.filter("lo <> hi").select("gram")
    counted = held.join(shared, "gram").groupBy("c").agg(F.count_distinct("gram").alias("k"))
    classes = parts.filter("n_shingles > 0").select("set_key", "n_shingles", own).distinct()
    enough = classes.join(counted, "c")
    return enough.filter(F.col("k") >= rule.least_shared_of(F.col("n_shingles"))).select("set_key")


def _ordered(sets: DataFrame, rule: Likeness) -> DataFrame:
    """``c, n, grams``: classes with their shared n-grams as ``(df, gram)``, rarest first.

    Classes with more own n-grams than a link allows are left out.
    """
    # a hash and the size stand for the class until its list is whole, to move less
    own = F.xxhash64("set_key").alias("h")
    n = F.col("n_shingles").alias("n")
    grams = sets.select(own, n, F.explode("grams").alias("gram"))
    known = grams.groupBy("gram").agg(F.count("*").alias("df")).filter("df > 1")
    lists = (
        grams.join(known, "gram")
        .groupBy("h", "n")
        .agg(F.sort_array(F.collect_list(F.struct("df", "gram"))).alias("grams"))
        .join(sets.select(own, n, F.col("set_key").alias("c")), ["h", "n"])
        .select("c", "n", "grams")
    )
    return lists.filter(F.size("grams") >= F.col("n") - rule.misses_of(F.col("n")))


def _fragments(lists: DataFrame, count: int) -> DataFrame:
    """``c, f, part``: each class's n-grams in each fragment of the global order.

    The order is cut where the n-grams' occurrences are evenly divided. Cuts are values of
    an n-gram's place in the order: how often it occurs, then its hash.
    """
    place = lambda g: g["df"].cast("double") + F.shiftrightunsigned(g["gram"], 12) / F.lit(2.0**52)
    every = lists.select(F.explode("grams").alias("g")).select(place(F.col("g")).alias("at"))
    shares = [k / count for k in range(1, count)]
    cuts = sorted(set(every.agg(F.percentile_approx("at", shares, 1000)).first()[0] or []))
    fragment = lambda g: F.size(
        F.filter(F.array(*[F.lit(c) for c in cuts]).cast("array<double>"), lambda c: c <= place(g))
    )
    tagged = lists.select(
        "c", F.transform("grams", lambda g: F.struct(fragment(g).alias("f"), g["gram"].alias("gram"))).alias("t")
    )
    split = tagged.select("c", "t", F.explode(F.array_distinct(F.transform("t", lambda x: x["f"]))).alias("f"))
    part = F.transform(F.filter("t", lambda x: x["f"] == F.col("f")), lambda x: x["gram"])
    return split.select("c", "f", part.alias("part"))


def _verified(pairs: DataFrame, parts: DataFrame, rule: Likeness) -> DataFrame:
    """The linked ones of ``a, b, na, nb``: overlaps per fragment, summed per pair."""
    left = parts.select(F.col("c").alias("a"), "f", F.col("part").alias("pa"))
    right = parts.select(F.col("c").alias("b"), "f", F.col("part").alias("pb"))
    counts = (
        pairs.join(left, "a")
        .join(right, ["b", "f"])
        .select("a", "b", "na", "nb", F.size(F.array_intersect("pa", "pb")).alias("k"))
        .groupBy("a", "b", "na", "nb")
        .agg(F.sum("k").alias("k"))
    )
    union = F.col("na") + F.col("nb") - F.col("k")
    return counts.filter(F.col("k") * rule.over >= union * rule.part).select("a", "b")


def _possible(x: str, y: str, rule: Likeness) -> Column:
    """Whether sizes and places of the first common n-gram leave room for a link."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    most = F.least(n - F.col(f"{x}.pos"), m - F.col(f"{y}.pos"))
    return most * rule.over >= (n + m - most) * rule.part


def _as_pairs(joined: DataFrame) -> DataFrame:
    x, y = F.col("x.c"), F.col("y.c")
    first = x < y
    return joined.select(
        F.least(x, y).alias("a"),
        F.greatest(x, y).alias("b"),
        F.when(first, F.col("x.n")).otherwise(F.col("y.n")).alias("na"),
        F.when(first, F.col("y.n")).otherwise(F.col("x.n")).alias("nb"),
    ).distinct()


def class_links(sets: DataFrame, rule: Likeness) -> DataFrame:
    """``a, b``: links that connect whatever classes are connected.

    Every pair of linked classes that these links leave apart was compared; pairs already
    connected need not be.
    """
    spark = sets.sparkSession
    folders = {name: new_folder(spark, f"ngram-{name}") for name in ("lists", "parts", "buckets", "apart")}
    lists = staged(_ordered(sets, rule), "", folders["lists"])
    parts = staged(_fragments(lists, rule.fragments), "", folders["parts"])
    own = F.col("n") - F.size("grams")
    front = F.slice("grams", F.lit(1), (rule.misses_of(F.col("n")) - own + 1).cast("int"))
    buckets = lists.select("c", "n", own.alias("own"), F.posexplode(front).alias("k", "g"))
    buckets = staged(
        buckets.select("c", "n", (F.col("own") + F.col("k")).alias("pos"), F.col("g.gram").alias("gram")),
        "",
        folders["buckets"],
    )
    removed(spark, folders["lists"])

    # each class with the bucket's class in which the n-gram comes first
    hubs = buckets.groupBy("gram").agg(F.min(F.struct("pos", "c", "n")).alias("hub"))
    hubs = hubs.select("gram", "hub.*").alias("y")
    joined = buckets.alias("x").join(hubs, "gram")
    joined = joined.filter((F.col("x.c") != F.col("y.c")) & _possible("x", "y", rule))
    tried = staged(_as_pairs(joined), "ngram-pairs")
    links = staged(_verified(tried, parts, rule), "ngram-links")

    # then those of each bucket that are still apart
    labels = components(links)
    marked = buckets.join(labels, F.col("c") == F.col("node"), "left").select(
        "gram", "c", "n", "pos", F.coalesce("component", "c").alias("group")
    )
    mixed = marked.groupBy("gram").agg(F.min("group").alias("lo"), F.max("group").alias("hi"))
    marked = staged(marked.join(mixed.filter("lo <> hi").select("gram"), "gram"), "", folders["apart"])
    removed(spark, folders["buckets"])
    apart = marked.alias("x").join(
        marked.alias("y"),
        (F.col("x.gram") == F.col("y.gram"))
        & (F.col("x.group") < F.col("y.group"))
        & _possible("x", "y", rule),
    )
    rest = _as_pairs(apart).join(tried.select("a", "b"), ["a", "b"], "left_anti")
    every = staged(links.unionByName(_verified(rest, parts, rule)), "ngram-all-links")
    for name in ("apart", "parts"):
        removed(spark, folders[name])
    return every


def classes_of(docs: DataFrame, rule: Likeness, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Documents with their set keys, and the component of each set key that has links."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text_col).cast("string")).alias("mark"),
        F.col(text_col).cast("string").alias("text"),
    )
    spark = docs.sparkSession
    first = new_folder(spark, "ngram-parts")
    parts = staged(_sets(rows, rule, whole=False), "ngram-parts", first)
    suspects = _suspects(parts, rule)
    # one document of each suspect class, to read its whole set; ``same`` rows repeat it
    chosen = (
        parts.filter("n_shingles > 0")
        .groupBy("set_key", "doc_id", "mark")
        .agg(F.count("*").alias("same"))
        .groupBy("set_key")
        .agg(F.min(F.struct("doc_id", "mark", "same")).alias("r"))
        .join(suspects, "set_key")
        .select(F.col("r.doc_id").alias("_id"), F.col("r.mark").alias("_mark"), F.col("r.same").alias("_same"))
        .distinct()
    )
    chosen = small_side(staged(chosen, "ngram-suspects"), row_bytes=40)
    found = staged(parts.drop("grams"), "ngram-documents")
    removed(spark, first)
    again = rows.join(
        chosen, rows["doc_id"].eqNullSafe(chosen["_id"]) & (rows["mark"] == chosen["_mark"])
    )
    columns = ["doc_id", "mark", "text"]
    # only rows that repeat an id and a text make a set twice; no others are moved
    once = again.filter("_same = 1").select(*columns)
    once = once.unionByName(again.filter("_same > 1").select(*columns).dropDuplicates(["doc_id", "mark"]))
    whole = new_folder(spark, "ngram-sets")
    sets = staged(_sets(once, rule, whole=True).select("set_key", "n_shingles", "grams"), "", whole)
    links = class_links(sets, rule)
    removed(spark, whole)
    return found, components(links)


def document_components(
    docs: DataFrame, rule: Likeness = Likeness(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id``: the least document that links lead to.

    Null, empty and blank texts have no n-grams and are linked with nothing. Repeated rows
    and repeated ids are documents of their own; null ids never name a component unless it
    has no other.
    """
    found, groups = classes_of(docs, rule, id_col, text_col)
    filled = found.filter("n_shingles > 0")
    least = filled.groupBy("set_key").agg(F.min("doc_id").alias("least"))
    grouped = least.join(groups, F.col("set_key") == F.col("node"), "left").select(
        "set_key", "least", F.coalesce("component", "set_key").alias("group")
    )
    grouped = staged(grouped, "ngram-classes")
    ids = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    named = grouped.join(ids, "group").select("set_key", "component_id")
    return filled.join(named, "set_key").select("doc_id", "n_shingles", "component_id").unionByName(
        found.filter("n_shingles = 0").select(
            "doc_id", "n_shingles", F.col("doc_id").alias("component_id")
        )
    )


def keep_one(
    docs: DataFrame, rule: Likeness = Likeness(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of each component, that with the least id, with all columns.

    Documents without n-grams all stay. Of rows that repeat an id and its text one stays.
    """
    found, groups = classes_of(docs, rule, id_col, text_col)
    filled = found.filter("n_shingles > 0")
    rows = filled.groupBy("set_key", "doc_id", "mark").agg(F.count("*").alias("same"))
    best = rows.groupBy("set_key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("z"), "doc_id", "mark", "same")).alias("r"))
    grouped = best.join(groups, F.col("set_key") == F.col("node"), "left")
    kept = grouped.groupBy(F.coalesce("component", "set_key")).agg(F.min("r").alias("r"))
    blank = found.filter("n_shingles = 0").select(
        F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), F.lit(1).cast("long").alias("_same")
    )
    kept = kept.select(
        F.col("r.doc_id").alias("_id"), F.col("r.mark").alias("_mark"), F.col("r.same").alias("_same")
    ).unionByName(blank.distinct())
    kept = small_side(staged(kept, "ngram-kept"), row_bytes=40)
    columns = list(docs.columns)
    key = F.col(id_col).cast("long")
    mark = F.xxhash64(F.col(text_col).cast("string"))
    names = dict(zip(("_id", "_mark", "_same"), unused(columns, 3)))
    kept = kept.withColumnsRenamed(names)
    at, of, same = names.values()
    joined = docs.join(kept, key.eqNullSafe(F.col(at)) & (mark == F.col(of)))
    once = joined.filter(F.col(same) == 1).select(*columns)
    repeated = joined.filter(F.col(same) > 1).dropDuplicates([at, of]).select(*columns)
    return once.unionByName(repeated)
