"""N-gram join, components, fingerprints, quality and licenses against brute force."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
from collections import Counter

import pytest
from conftest import SCHEMA, row, sentence
from pyspark.sql import functions as F

from keyfold.llm import fingerprints, license_scan, ngram_join, quality
from keyfold.llm.components import components
from keyfold.llm.ngram_join import Likeness

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def ngram_set(text, n):
    words = WORD.findall((text or "").translate(UPPER))
    if len(words) < n:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def expected_components(rows, rule):
    """Component of every row's place, by comparing all pairs."""
    sets = [ngram_set(text, rule.n) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x, y in itertools.combinations(range(len(rows)), 2):
        k = len(sets[x] & sets[y])
        if k and k * rule.over >= rule.part * len(sets[x] | sets[y]):
            parent[root(x)] = root(y)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        ids = [doc_id, least.get(root(k))]
        least[root(k)] = min((i for i in ids if i is not None), default=None)
    return [(d, len(s), least[root(k)]) for k, ((d, _), s) in enumerate(zip(rows, sets))]


def near_copies(seed, count, words, most):
    """Copies of one text with up to ``most`` words replaced, and chains of small changes."""
    source = random.Random(seed)
    base = sentence(source, words).split()
    rows, last = [], base
    for k in range(count):
        text = list(last if k % 3 == 0 else base)
        for _ in range(source.randint(0, most)):
            text[source.randrange(words)] = sentence(source, 1)
        last = text
        rows.append(" ".join(text))
    return rows


@pytest.mark.parametrize("n, part", [(3, 90), (5, 80), (1, 50), (2, 100)])
def test_components_of_near_copies(spark, n, part):
    rule = Likeness(n=n, part=part, fragments=3)
    texts = near_copies(1, 60, 150, 6) + near_copies(2, 30, 40, 2) + near_copies(3, 20, 4, 1)
    passage = sentence(random.Random(9), 60)
    texts += [sentence(random.Random(100 + k), 20) + " " + passage for k in range(40)]
    rows = list(enumerate(texts + texts[:10]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = ngram_join.document_components(docs, rule).collect()
    assert sorted(map(tuple, found)) == sorted(expected_components(rows, rule))
    kept = sorted(r.doc_id for r in ngram_join.keep_one(docs, rule).collect())
    assert kept == sorted({c for _, _, c in expected_components(rows, rule)})


def test_join_of_odd_rows(odd, none, odd_rows):
    rule = Likeness(n=3, part=90)
    rows = [(r[0], r[1]) for r in odd_rows]
    found = Counter(map(tuple, ngram_join.document_components(odd, rule).collect()))
    expected = Counter(
        (d, n, d if not n else c) for d, n, c in expected_components(rows, rule)
    )
    assert found == expected
    assert ngram_join.document_components(none, rule).count() == 0
    kept = ngram_join.keep_one(odd, rule)
    assert kept.columns == odd.columns
    texts = Counter((r.doc_id, r.text) for r in kept.collect())
    assert max(texts.values()) == 1
    assert ngram_join.keep_one(none, rule).count() == 0


def test_components_of_paths_and_stars(spark):
    links = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(1000, 1300)]
    links += [(7, 7), (None, 3), (160, 100), (160, 100)]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    named = {r.node: r.component for r in found}
    assert len(named) == len(found) == 61 + 301
    assert {named[k] for k in range(100, 161)} == {100}
    assert {named[k] for k in range(1000, 1300)} == {5}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_fingerprints(spark, odd_rows, none):
    source = random.Random(3)
    rows = [(k, r[1]) for k, r in enumerate(odd_rows)]
    rows += [(100 + k, "\n".join(sentence(source, 9) for _ in range(40))) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r.doc_id: r for r in fingerprints.report(docs).collect()}
    assert len(found) == len(rows)
    named = {}
    for k, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        r = found[doc_id]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert named.setdefault(text, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if doc_id >= 100 and k + 1 < len(rows):
            assert r.near_edited > 0.15 and r.near_next < 0.4
    assert fingerprints.report(none).count() == 0


def test_fingerprints_of_null_and_repeated_ids(odd, odd_rows):
    found = fingerprints.report(odd).collect()
    assert len(found) == len(odd_rows)
    order = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    expected = Counter()
    for k, r in enumerate(order):
        text, after = r[1] or "", order[(k + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        expected[r[0], hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.edited_sha256) for r in found) == expected


def test_fingerprints_are_homomorphic(spark):
    source = random.Random(4)
    lines = [sentence(source, 5) for _ in range(50)]
    shuffled = random.Random(1).sample(lines, len(lines))
    data = [("\n".join(lines), "\n".join(shuffled), "\n".join(lines[:30]), lines[30:])]
    docs = spark.createDataFrame(data, "a string, b string, c string, rest array<string>")
    vector = lambda c: fingerprints.vector(fingerprints.paragraphs(F.col(c)))
    docs = docs.select(vector("a").alias("a"), vector("b").alias("b"), vector("c").alias("c"), "rest")
    row = docs.select(
        (F.col("a") == F.col("b")).alias("order"),
        (fingerprints.inserted(F.col("c"), F.col("rest")) == F.col("a")).alias("inserted"),
        (fingerprints.deleted(F.col("a"), F.col("rest")) == F.col("c")).alias("deleted"),
        fingerprints.likeness(F.col("a"), F.col("c")).alias("near"),
        (F.col("a") == F.col("c")).alias("same"),
    ).first()
    assert row.order and row.inserted and row.deleted and not row.same
    assert 0.5 < row.near < 0.95


@pytest.mark.parametrize("lines, texts", [(40, 12), (1_000, 12), (10_000, 3)])
def test_likeness_keeps_its_scale(spark, lines, texts):
    source = random.Random(lines)
    data, exact = [], []
    for k in range(texts):
        text = [f"{k} {i} {source.random()}" for i in range(lines)]
        # the share that stays differs from text to text; the rest is replaced by a few lines
        stays = lines * (1 + k % 3) // 4
        other = text[:stays] + [f"other {k} {i}" for i in range(10)]
        a, b = Counter(text), Counter(other)
        exact.append(1 - ((a - b) + (b - a)).total() / (a + b).total())
        data.append((k, text, other))
    rows = spark.createDataFrame(data, "k int, a array<string>, b array<string>").repartition(4)
    near = fingerprints.likeness(fingerprints.vector(F.col("a")), fingerprints.vector(F.col("b")))
    found = [r.near for r in rows.select("k", near.alias("near")).orderBy("k").collect()]
    # the number of differences has a relative error of about 0.17
    assert all(abs(f - e) < 0.6 * (1 - e) for f, e in zip(found, exact))
    assert abs(sum(found) - sum(exact)) < 0.6 * texts**0.5 * (1 - min(exact))
    assert fingerprints._differences()[0] > 2**31


def measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            covered.update(range(i, i + 8))
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)),
        len(covered),
    )


def test_quality_measures(odd, none, odd_rows):
    found = Counter(tuple(r)[:7] for r in quality.report(odd).collect())
    expected = Counter()
    for doc_id, text, *_ in odd_rows:
        m = measures(text)
        expected[doc_id, *m, m[0] < 20 or 100 * m[4] > 30 * m[0]] += 1
    assert found == expected
    assert quality.report(none).count() == 0
    assert quality.keep(none).columns == none.columns


def test_hosts_are_shrunk_and_rejected(spark):
    source = random.Random(8)
    rows, doc_id = [], 0
    for host, bad, count in [("good", 0.05, 200), ("bad", 0.97, 200), ("tiny", 1.0, 1), (None, 0.0, 50)]:
        for k in range(count):
            text = "too short" if k < bad * count else sentence(source, 30)
            rows.append(row(doc_id, text, "en", host))
            doc_id += 1
    rows += [row(doc_id + k, sentence(source, 30), "en", f"small{k}") for k in range(20)]
    docs = spark.createDataFrame(rows, SCHEMA)
    hosts = quality.host_verdicts(quality.measured(docs), "source", quality.Limits())
    rate = {r.host: (r.rate, r.rejected) for r in hosts.collect()}
    assert rate["bad"][1] and not rate["good"][1] and not rate[None][1]
    assert rate["tiny"][0] < 1.0
    kept = {r.doc_id for r in quality.keep(docs).collect()}
    by_id = {r[0]: r for r in rows}
    assert not any(by_id[i][3] == "bad" for i in kept)
    clean = {r[0] for r in rows if r[3] in ("good", None) and r[1] != "too short"}
    assert clean <= kept


def test_license_scan(spark, odd, none):
    source = random.Random(6)
    rows = []
    for k in range(120):
        name, notice = license_scan.TEMPLATES[k % len(license_scan.TEMPLATES)]
        before = sentence(source, source.randint(0, 30))
        rows.append((k, f"{before}\n{notice} {sentence(source, 12)}", name))
    rows += [(1000 + k, sentence(source, 200), None) for k in range(60)]
    rows.append((2000, "Licensed under the Apache tree, by the river", None))
    docs = spark.createDataFrame(rows, "doc_id long, text string, license string")
    found = license_scan.scan(docs).collect()
    got = {(r.doc_id, r.license) for r in found}
    wanted = {(i, name) for i, _, name in rows if name}
    assert wanted <= got
    # the long Apache notice holds the short one; nothing else is found
    assert {i for i, _ in got} == {i for i, _ in wanted}
    assert all(0.8 <= r.containment <= 1 and r.n_windows >= 1 for r in found)
    assert license_scan.scan(odd).count() == 0
    assert license_scan.scan(none).count() == 0
    assert license_scan.scan(docs, []).count() == 0


def test_bands_find_what_they_promise():
    assert 1 - (1 - 0.375) ** license_scan.bands_needed(0.375, 1, 0.9999) >= 0.9999
    assert license_scan.bands_needed(0.5, 4, 0.99) == 72


def test_short_notices_are_found(spark):
    source = random.Random(8)
    rows = []
    for k in range(4_000):
        before, after = sentence(source, source.randint(0, 25)), sentence(source, source.randint(0, 25))
        rows.append((k, f"{before} {license_scan.TEMPLATES[0][1]} {after}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert license_scan.scan(docs).filter("license = 'MIT'").count() == len(rows)


def test_least_similarity():
    assert license_scan.least_similarity([3, 100], 1.0) == 3 / 8
    # four of five shingles in a window, and one of them missing
    assert license_scan.least_similarity([5], 0.8) == 3 / 10


def test_notices_next_to_unspaced_punctuation_are_found(spark):
    source = random.Random(9)
    rows = []
    for k, mark in enumerate(license_scan._MARKS):
        before, after = sentence(source, 12), sentence(source, 12)
        rows.append((k, f"{before}{mark}Released under the MIT License{mark}{after}", "MIT"))
        rows.append((100 + k, f"{before}{mark}Licensed under the Apache License,Version 2.0{mark}{after}", "Apache-2.0"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, license string")
    found = {(r.doc_id, r.license) for r in license_scan.scan(docs).collect()}
    assert found == {(k, name) for k, _, name in rows}
