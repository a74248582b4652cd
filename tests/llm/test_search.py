"""Shards, spelling variants and ranked search against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyfold.llm import ball_tree, lexical, sharding, spelling
from conftest import SCHEMA, row, sentence

CRC_HOT = 40


def rows_of(df):
    return [tuple(r) for r in df.collect()]


@pytest.fixture(scope="session")
def hot(spark, odd_rows):
    """A third of the rows are one text, and a third of the ids one id."""
    source = random.Random(9)
    text = sentence(source, 30)
    rows = [row(100 + i, text) for i in range(CRC_HOT)]
    rows += [row(7, sentence(source, 8)) for _ in range(CRC_HOT)]
    rows += [row(500 + i, sentence(source, 20)) for i in range(CRC_HOT)]
    return rows + odd_rows


# shards


def test_shards_hold_every_row_without_gaps(spark, hot):
    docs = spark.createDataFrame(hot, SCHEMA).repartition(4)
    found = rows_of(sharding.report(docs, shards=5))
    expected = Counter(
        (r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in hot
    )
    assert Counter(r[:3] for r in found) == expected
    assert {r[3] for r in found} == {"key"}
    for shard in range(5):
        slots = sorted(r[5] for r in found if r[4] == shard)
        assert slots == list(range(len(slots)))
    assert len({(r[0], r[4], r[6]) for r in found}) == len({r[0] for r in found})
    assert all(r[6] in (r[4], 5) for r in found)


def test_one_shard_is_dealt_over_tasks_and_still_gapless(spark, hot, tmp_path):
    docs = spark.createDataFrame(hot, SCHEMA).repartition(4)
    folder = str(tmp_path / "dealt")
    sharding.write_shards(docs, folder, [1.0, 1.0], file_bytes=20_000)
    kept = sharding.read_shards(spark, folder)
    assert len(list((tmp_path / "dealt").glob("shard=*/*.parquet"))) > 2
    for shard, slots in rows_of(kept.groupBy("shard").agg(F.sort_array(F.collect_list("slot")))):
        assert slots == list(range(len(slots)))
    assert set(docs.columns) <= set(kept.columns)


def test_weights_decide_shares_and_a_new_shard_takes_only_for_itself(spark):
    keys = spark.range(60_000).withColumnRenamed("id", "doc_id")
    weights = [1.0, 2.0, 0.0, 5.0]
    found = sharding.assigned(keys, weights, more=2.0)
    count = {s: n for s, n in rows_of(found.groupBy("_s_shard").count())}
    assert set(count) == {0, 1, 3}
    for shard, n in count.items():
        assert abs(n / 60_000 - weights[shard] / 8) < 0.01
    moved = found.filter("_s_shard <> _s_grown")
    assert moved.filter("_s_grown <> 4").count() == 0
    assert abs(moved.count() / 60_000 - 0.2) < 0.01


def test_clashing_names_and_balance(spark, tmp_path):
    docs = spark.createDataFrame(
        [(1, "a", 9, None), (None, None, 8, "x")], "doc_id long, text string, shard int, Grown_Shard string"
    )
    folder = str(tmp_path / "names")
    sharding.write_shards(docs, folder, [1.0, 3.0])
    kept = sharding.read_shards(spark, folder)
    assert sorted(rows_of(kept.select("shard_in", "grown_shard_in"))) == [(8, "x"), (9, None)]
    held = rows_of(sharding.balance(spark, folder).select("n_rows", "n_bytes", "due").orderBy("shard"))
    assert sum(r[0] for r in held) == 2 and sum(r[1] for r in held) == 17
    assert [r[2] for r in held] == [0.25, 0.75]
    with pytest.raises(ValueError):
        sharding.shard_of(F.col("doc_id"), [0.0])


def test_no_rows_make_no_shards(spark, none):
    assert sharding.report(none, shards=3).count() == 0


# spelling


def brute_words(rows, spoil=97):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if spoil and h % spoil == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def apart(a, b):
    """Whether one insertion, deletion or replacement makes a of b."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def brute_forms(words):
    found, forms = [], {}
    near = {w: [v for v in words if apart(w, v)] for w in words}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * n else None
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        found.append((w, forms[w], root, n, len(near[w]), words.get(forms[w])))
    return found


def misspelt(seed, count):
    """Texts of words of few letters, so that many are one edit apart."""
    source = random.Random(seed)
    words = ["".join(source.choice("abé") for _ in range(source.randint(4, 7))) for _ in range(150)]
    for _ in range(count):
        some = [source.choice(words[: source.choice((8, 40, 150))]) for _ in range(60)]
        yield " ".join(w.upper() if source.random() < 0.2 else w for w in some)


def test_spelling_variants_against_brute_force(spark, odd_rows):
    rows = [row(i, text) for i, text in enumerate(misspelt(3, 60))] + odd_rows
    rows += [row(90 + k, "x" * 3000 + "y" * k + " þórðar×÷ðó") for k in (0, 0, 0, 1, 1, 1, 1, 1, 1, 1)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    expected = brute_forms(brute_words(rows))
    assert sum(r[1] is not None for r in expected) > 20
    key = lambda r: r[0]
    assert sorted(rows_of(spelling.report(docs)), key=key) == sorted(expected, key=key)


def test_large_chunks_are_split_without_loss(spark):
    words = {w for text in misspelt(4, 30) for w in re.findall(r"\w{5,}", text.lower())}
    table = spark.createDataFrame([(w,) for w in words], "word string").cache()
    expected = {
        (a, b)
        for a in words
        for b in words
        if apart(a, b) and ((len(a), a) < (len(b), b))
    }
    found = rows_of(spelling.near_pairs(table, bucket_pairs=20))
    assert len(found) == len(set(found)) and set(found) == expected
    assert set(rows_of(spelling.near_pairs(table))) == expected


def test_chains_of_forms_end_at_their_root(spark):
    chain = [(f"w{k:02d}", f"w{k + 1:02d}") for k in range(60)]
    links = spark.createDataFrame(chain, "word string, form string")
    assert set(rows_of(spelling.roots(links))) == {(w, "w60") for w, _ in chain}


def test_no_words_no_variants(spark, none):
    assert spelling.report(none).count() == 0
    docs = spark.createDataFrame([row(1, "a bb ccc"), row(2, None)], SCHEMA)
    assert spelling.report(docs).count() == 0


# ranked search


def brute_rank(docs, items, k):
    terms = lambda text: re.findall(
        r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+",
        "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""),
    )
    held = [(r[0], Counter(t)) for r in docs if (t := terms(r[1]))]
    total, count = sum(sum(c.values()) for _, c in held), len(held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for item, text in items:
        if item is not None:
            asked.setdefault(item, set()).update(terms(text))
    found = []
    for item, wanted in asked.items():
        scored = []
        for doc_id, c in held:
            m = 100 - 90 + (90 * sum(c.values()) * count) // total
            score = 0
            for t in wanted:
                if t in c:
                    w = math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for place, (score, null, doc_id) in enumerate(sorted(scored)[:k], 1):
            found.append((item, place, None if null else doc_id, -score))
    return sorted(found, key=lambda r: r[:2])


ITEMS = "item_id long, text string, doc_id string, rank string"


def test_ranked_search_against_brute_force(spark, hot):
    source = random.Random(2)
    texts = [r[1] for r in hot if r[1]]
    items = [(i, " ".join(source.choice(texts).split()[:12])) for i in range(25)]
    items += [(30, None), (31, " ?! "), (32, "not there at all"), (None, texts[0]), (33, texts[0]), (33, texts[-2])]
    docs = spark.createDataFrame(hot, SCHEMA).repartition(3)
    asked = spark.createDataFrame([(*i, "x", "y") for i in items], ITEMS)
    expected = brute_rank(hot, items, 10)
    assert len(expected) > 150
    for bounds in (
        lexical.Bounds(),
        lexical.Bounds(items=4, terms=60, tree_rows=9, tree_cells=40, leaf=2),
    ):
        found = lexical.rank(docs, asked, k=10, bounds=bounds)
        assert sorted(rows_of(found), key=lambda r: r[:2]) == expected


def test_ranked_search_of_nothing(spark, none, odd):
    asked = spark.createDataFrame([(1, "one two", "x", "y")], ITEMS)
    assert lexical.rank(none, asked).count() == 0
    assert lexical.rank(odd, asked.limit(0)).count() == 0


def test_tree_prunes_and_loses_nothing():
    random_ = np.random.default_rng(4)
    # clusters of rows with terms of their own
    rows = [
        {int(t): int(random_.integers(10**9, 10**10)) for t in 50 * (i % 20) + random_.choice(50, 25, False)}
        for i in range(2000)
    ]
    sets = [sorted(50 * c + random_.choice(50, 20, False)) for c in range(20)]
    queries = ball_tree.Queries(sets, 1000)
    starts = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    terms = np.concatenate([list(r) for r in rows])
    values = np.concatenate([list(r.values()) for r in rows])
    tree, best = ball_tree.BallTree(starts, terms, values, queries, leaf=16), ball_tree.Best(20, 5)
    scored = tree.search(best, np.arange(2000), np.zeros(2000, bool))
    assert scored < 0.5 * 20 * 128
    found = list(best.rows())
    for q, held in enumerate(sets):
        scores = sorted(((-sum(r.get(t, 0) for t in held), i) for i, r in enumerate(rows)))[:5]
        assert [(i, s) for k, i, s in found if k == q] == [(i, -s) for s, i in scores]
