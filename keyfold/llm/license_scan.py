"""License texts in documents: MinHash bands over text windows, then exact containment.

Texts are cut into overlapping windows of words, so that a passage of half a window's words
lies whole in one of them. Each window's shingles are MinHashed; a window that shares a
band with a window of a template retrieves that template, and the words around it are then
compared with the template shingle by shingle. All expressions are built in.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Notices as their licenses word them.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    (
        "Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "GPL-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    ),
]

SHINGLE = 3
# Words of a window; windows start at every half.
WINDOW = 10
_STEP = WINDOW // 2
_SHINGLES = WINDOW - SHINGLE + 1

# Words of all templates together, at most: their keys go to every task.
MAX_TEMPLATE_WORDS = 5_000


def bands_needed(similarity: float, rows: int, probability: float) -> int:
    """Bands by which two sets this similar share one with at least this probability."""
    return math.ceil(math.log(1 - probability) / math.log(1 - similarity**rows))


_MARKS = "()\"'.,;:!?*#/"


def words(text: Column) -> Column:
    """Lower-case words; spaces and these punctuation marks separate them, also unspaced."""
    plain = F.translate(F.lower(F.coalesce(text, F.lit(""))), "\t\n\x0b\x0c\r", "     ")
    plain = F.translate(plain, _MARKS, " " * len(_MARKS))
    return F.array_remove(F.split(plain, " "), "")


def _shingle_hashes(col: str) -> Column:
    return F.when(
        F.size(col) >= SHINGLE,
        F.transform(
            F.sequence(F.lit(0), F.size(col) - SHINGLE),
            lambda i: F.xxhash64(*[F.get(F.col(col), i + k) for k in range(SHINGLE)]),
        ),
    ).otherwise(F.array().cast("array<long>"))


def least_similarity(sizes: Sequence[int], containment: float) -> float:
    """The least Jaccard similarity by which a window meets a held template's window.

    ``sizes`` are the templates' numbers of shingles. A template may start at any place
    between two windows, and the shingles that containment allows to be missing may all be
    in the window that holds most of it; those of a longer one are spread over its windows.
    """

    def least(size: int) -> float:
        held = min(
            max(min(size, _SHINGLES - late), min(_SHINGLES, size - _STEP + late)) for late in range(_STEP)
        )
        missing = size - math.ceil(containment * size - 1e-9)
        apart = max(1, (size - _STEP + 1) // WINDOW)
        shared = max(1, held - missing // apart)
        return shared / (_SHINGLES + min(size, _SHINGLES) - shared)

    return min(map(least, sizes))


def _band_keys(window: Column, bands: int) -> Column:
    """For each band, the smallest of a window's shingles by a hash of the band's own."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(bands - 1)),
        lambda band: F.array_min(F.transform(window, lambda h: F.xxhash64(h, band))),
    )


def template_table(spark: SparkSession, templates: Sequence[tuple[str, str]]) -> DataFrame:
    """``template, license, words, hashes``; one row per template that has a shingle."""
    if sum(len(text.split()) for _, text in templates) > MAX_TEMPLATE_WORDS:
        raise ValueError("the templates' table must fit into every task")
    rows = spark.createDataFrame(
        [(k, name, text) for k, (name, text) in enumerate(templates)],
        "template int, license string, text string",
    )
    rows = rows.select("template", "license", words(F.col("text")).alias("_words"))
    rows = rows.select("template", "license", "_words", _shingle_hashes("_words").alias("_hashes"))
    return rows.filter(F.size("_hashes") > 0)


def _template_keys(table: DataFrame, bands: int) -> list[tuple[int, int]]:
    """``template, key`` of every band of every window of every template, a bounded table."""
    last = F.greatest(F.lit(0), F.size("_hashes") - _SHINGLES)
    windows = table.select(
        "template",
        F.explode(F.sequence(F.lit(0), last)).alias("_at"),
        "_hashes",
    ).select("template", F.slice("_hashes", F.col("_at") + 1, _SHINGLES).alias("_window"))
    found = windows.select(
        "template",
        F.explode(_band_keys(F.col("_window"), bands)).alias("key"),
    ).distinct()
    return [tuple(row) for row in found.collect()]


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = tuple(TEMPLATES),
    containment: float = 0.8,
    probability: float = 0.9999,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, license, containment, n_windows``: licenses that a document's text holds.

    ``containment`` is the largest share of a template's shingles found in a stretch of
    text of the template's length around a retrieved window, at least the parameter;
    ``n_windows`` counts the windows that show it. Bands have one row each, hash every
    shingle anew, and are as many as find the template that a window meets worst with the
    given probability; a verbatim longer template is found by each window inside it. A band
    can only agree on a template's shingle, so windows that hold none are not banded.

    The templates are a bounded table and are the only thing broadcast. Windows are
    filtered in the pass that makes them, so only matches are shuffled, summed per document
    and license beforehand. Null, empty and short texts give no rows, and rows of one
    document id count together.
    """
    spark = docs.sparkSession
    table = template_table(spark, templates)
    sizes = [r[0] for r in table.select(F.size("_hashes")).collect()]
    empty = "doc_id long, license string, containment double, n_windows long"
    if not sizes:
        return spark.createDataFrame([], empty)
    similarity = least_similarity(sizes, containment)
    bands = bands_needed(min(1.0 - 1e-9, similarity), 1, probability)
    keys = _template_keys(table, bands)

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), words(F.col(text_col)).alias("_text")
    ).filter(F.size("_text") >= SHINGLE)
    rows = rows.withColumn("_all", _shingle_hashes("_text"))
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.size("_all") - 1), F.lit(_STEP))
    known_keys = sorted({key for _, key in keys})
    known_hashes = sorted({h for row in table.select("_hashes").collect() for h in row[0]})

    def window(start: Column) -> Column:
        return F.struct(start.alias("start"), F.slice(F.col("_all"), start + 1, _SHINGLES).alias("hashes"))

    def retrieved(w: Column) -> Column:
        keys_of = F.filter(_band_keys(w["hashes"], bands), lambda k: k.isin(known_keys))
        return F.struct(w["start"].alias("start"), keys_of.alias("keys"))

    # only retrieved windows leave the text's row, with the words that may hold a template
    near = F.filter(
        F.transform(starts, window), lambda w: F.exists(w["hashes"], lambda h: h.isin(known_hashes))
    )
    found = F.filter(F.transform(near, retrieved), lambda w: F.size(w["keys"]) > 0)
    rows = rows.select("doc_id", "_text", found.alias("_found"))
    most = max(table.select(F.size("_words")).collect())[0]
    near = F.transform(
        "_found",
        lambda w: F.struct(
            w["start"].alias("start"),
            w["keys"].alias("keys"),
            F.slice(F.col("_text"), F.greatest(F.lit(1), w["start"] + 1 - most), 2 * most + WINDOW).alias("near"),
        ),
    )
    rows = rows.select("doc_id", F.explode(near).alias("_w"))
    rows = rows.select(
        "doc_id", F.col("_w.start").alias("_start"), F.col("_w.near").alias("_near"), F.explode("_w.keys").alias("_k")
    )

    lookup = spark.createDataFrame(keys, "_template int, _key long")
    lookup = lookup.groupBy("_key").agg(F.collect_set("_template").alias("_templates"))
    rows = rows.join(F.broadcast(lookup), F.col("_k") == F.col("_key"))
    rows = rows.select("doc_id", "_start", "_near", F.explode("_templates").alias("_t"))
    known = F.broadcast(table.withColumnsRenamed({"_words": "_their", "_hashes": "_theirs"}))
    rows = rows.join(known, F.col("_t") == F.col("template"))

    length = F.size("_their")
    first = lambda size: F.greatest(F.lit(1), F.col("_start") + 1 - size)
    around = F.slice("_near", first(length) - first(F.lit(most)) + 1, length * 2 + WINDOW)
    rows = rows.withColumn("_around", around)

    def strings(col: str) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.greatest(F.lit(0), F.size(col) - SHINGLE)),
            lambda i: F.concat_ws(" ", *[F.get(F.col(col), i + k) for k in range(SHINGLE)]),
        )

    wanted = F.array_distinct(strings("_their"))
    rows = rows.withColumn("_wanted", wanted)
    share = F.size(F.array_intersect("_wanted", strings("_around"))) / F.size("_wanted")
    rows = rows.withColumn("_share", share).filter(F.col("_share") >= containment)
    return rows.groupBy("doc_id", "license").agg(
        F.max("_share").alias("containment"), F.count_distinct("_start").alias("n_windows")
    )
