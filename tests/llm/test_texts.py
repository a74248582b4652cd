"""Pseudonyms, language identification and the pipeline."""

from __future__ import annotations

import datetime
import itertools
import random
import re
import zlib

import numpy as np
import pytest
from conftest import SCHEMA, row, sentence
from pyspark.sql import functions as F

from keyfold.llm import language, pii


def luhn(digits):
    total = 0
    for k, digit in enumerate(reversed(digits)):
        d = int(digit) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def pseudonyms(spark, values, key="k"):
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    made = {r.v: r.p for r in rows.select("v", pii.pseudonym(F.col("v"), key).alias("p")).collect()}
    return [made[v] for v in values]


def test_formats_are_kept(spark):
    values = [
        "jo.smith42@mail3.example.com",
        "+1 (555) 123-4567",
        "(555) 123-4567",
        "4111111111111111",
        "4111 1111 1111 1111",
        "192.168.10.250",
        "1999-02-28",
        "28.2.1999",
        "12/25/2003",
        "123-45-6789",
        "password=abc123DEF456",
        'token = "0123456789abcdef',
    ]
    made = pseudonyms(spark, values)
    assert all(a != b for a, b in zip(values, made))
    shape = lambda v: re.sub("[A-Z]", "A", re.sub("[a-z]", "a", re.sub("[0-9]", "9", v)))
    for value, new in list(zip(values, made))[:3] + list(zip(values, made))[9:]:
        assert shape(value)[-8:] == shape(new)[-8:] and len(value) == len(new)
    assert made[1].startswith("+1 (")
    assert luhn(made[3]) and made[4].replace(" ", "") == made[3] and made[4][4] == " "
    assert all(0 <= int(p) <= 255 for p in made[5].split("."))
    day = datetime.date.fromisoformat(made[6])
    assert made[7].split(".") == [str(day.day), str(day.month), f"{day.year:04d}"]
    month, day, year = map(int, made[8].split("/"))
    datetime.date(year, month, day)
    assert pseudonyms(spark, values) == made
    assert pseudonyms(spark, values, "other") != made


def test_values_that_are_not_valid_stay(spark):
    values = ["4111111111111112", "300.1.2.3", "1999-02-30", "31.4.1999", "1500-01-01"]
    assert pseudonyms(spark, values) == values


def test_permutations_are_one_to_one(spark):
    numbers = spark.range(189 * 773).select(
        pii._permuted_number(F.col("id"), "k", "date", 189, 773).alias("p")
    )
    found = numbers.agg(F.count_distinct("p"), F.min("p"), F.max("p")).first()
    assert tuple(found) == (189 * 773, 0, 189 * 773 - 1)
    chars = ["".join(c) for c in itertools.product("0123456789", "abcdefghijklmnopqrstuvwxyz", "01234")]
    rows = spark.createDataFrame([(c,) for c in chars], "v string")
    made = {r.p for r in rows.select(pii._permuted_chars(F.col("v"), "k", "x").alias("p")).collect()}
    assert len(made) == len(chars)
    assert all(re.fullmatch("[0-9][a-z][0-9]", p) for p in made)


def test_texts(spark, odd, none, odd_rows):
    text = (
        "mail a.b1@x.example.org, or +1 (555) 123-4567. Card 4111111111111111! "
        "Not 4111111111111112. On 2001-03-04 from 10.0.0.1\npassword=s3cretvalue99 end"
    )
    rows = [row(1, text), row(2, "again " + text + " " + text), row(3, "plain text: none = 5 @ 7")]
    docs = spark.createDataFrame(rows, SCHEMA)
    found = {r.doc_id: r for r in pii.report(docs, "k").collect()}
    for kept in ("mail ", "@x.example.org, or +1 (", "! Not 4111111111111112. On ", "\npassword=", " end"):
        assert kept in found[1].text
    for gone in ("a.b1@", "123-4567", "4111111111111111", "2001-03-04", "10.0.0.1", "s3cretvalue99"):
        assert gone not in found[1].text
    assert found[2].text == f"again {found[1].text} {found[1].text}"
    assert found[3].text == rows[2][1]
    assert [found[2][f"n_{k}"] for k in ("email", "phone", "card", "date", "ip", "secret")] == [2] * 6
    replaced = pii.replace(docs, "k")
    assert replaced.columns == docs.columns
    assert all(r.n_chars == len(r.text) for r in replaced.collect())
    unchanged = pii.report(odd, "k").collect()
    assert sorted(map(repr, ((r.doc_id, r.text) for r in unchanged))) == sorted(
        repr((r[0], r[1])) for r in odd_rows
    )
    assert pii.report(none, "k").count() == 0


LANGS = {
    "aa": ["ba", "be", "bi", "bo", "tan"],
    "bb": ["kra", "krü", "schä", "ung", "eit"],
    "cc": ["oux", "eau", "éle", "mont", "aire"],
}


def speech(source, lang, words):
    parts = LANGS[lang]
    return " ".join(
        "".join(source.choice(parts) for _ in range(source.randint(1, 3))) for _ in range(words)
    )


def spoken(count, seed=1):
    source = random.Random(seed)
    return [
        row(k, speech(source, lang := source.choice(list(LANGS)), source.randint(5, 60)), lang)
        for k in range(count)
    ]


def test_languages(spark, odd, none):
    rows = spoken(400)
    docs = spark.createDataFrame(rows, SCHEMA)
    found = {r.doc_id: r for r in language.report(docs).collect()}
    assert len(found) == len(rows)
    truth = {r[0]: r[2] for r in rows}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in found.items())
    held = [r for r in found.values() if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in held)
    source = random.Random(2)
    mixed = [
        row(1, speech(source, "aa", 30) + " " + speech(source, "bb", 10)),
        row(2, "12 34 !?"), row(3, None), row(4, ""), row(5, speech(source, "cc", 20_000)),
    ]
    model = language.train(docs)
    label = {
        r.doc_id: (r.lang_pred, r.score)
        for r in language.labelled(spark.createDataFrame(mixed, SCHEMA).drop("score"), model).collect()
    }
    assert label[1][0] == "aa" and 0.6 < label[1][1] < 0.9
    assert label[2] == label[3] == label[4] == ("und", 0.0)
    assert label[5][0] == "cc" and label[5][1] > 0.99
    assert language.report(none).count() == 0
    assert {r.lang_pred for r in language.report(odd).collect()} <= {"en", "fr", "und"}
    assert language.keep(docs).columns == docs.columns


def test_forward_backward_against_all_paths():
    random_numbers = np.random.default_rng(0)
    scores = random_numbers.normal(size=(7, 3))
    steps = random_numbers.normal(size=(3, 3))
    model = language.Model(["a", "b", "c"], {}, np.zeros((0, 3)), steps)
    lengths = np.array([2, 4, 1])
    found = model.posteriors(scores, lengths)
    at = 0
    for n in lengths:
        part, total = np.zeros((n, 3)), 0.0
        for path in itertools.product(range(3), repeat=int(n)):
            weight = sum(scores[at + t, k] for t, k in enumerate(path))
            weight = np.exp(weight + sum(steps[a, b] for a, b in zip(path, path[1:])))
            total += weight
            for t, k in enumerate(path):
                part[t, k] += weight
        assert np.allclose(found[at : at + n], part / total)
        at += n


def test_transitions_are_learned():
    model = language.fit([(r[2], r[1]) for r in spoken(200)])
    assert (model.steps.argmax(axis=1) == np.arange(3)).all()
    assert language.fit([("aa", "12"), ("bb", "")]) is None


def test_pipeline(spark, odd, none, tmp_path):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    source = random.Random(3)
    rows = []
    for k in range(120):
        lang = list(LANGS)[k % 3]
        rows.append(row(k, speech(source, lang, 60), lang))
    copy = rows[5][1].split()
    copy[30] = "changed"
    rows += [row(200, rows[5][1], "cc"), row(201, " ".join(copy), "cc"), row(202, "short", "aa")]
    rows.append(row(203, speech(source, "aa", 60) + " me@mail.example.com", "aa"))
    rows.append(row(204, None, "aa"))
    folder = str(tmp_path)
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        assert kept.columns == docs.columns, name
        assert stage(spark, none, folder).count() == 0
        stage(spark, odd, folder).count()
        docs = kept
    left = {r.doc_id: r.text for r in docs.collect()}
    assert set(range(120)) | {203} == set(left)
    assert "me@mail" not in left[203]
    found = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in found} == set(left)


def test_sentences_have_words():
    assert len(sentence(random.Random(1), 5).split()) == 5


def test_very_long_values_cost_in_proportion(spark):
    source = random.Random(3)
    secret = "".join(source.choice("abcXYZ019_/-+") for _ in range(100_000))
    values = [
        f"api_key = {secret}",
        "a@b" + ".c" * 50_000,
        "ab.c-" * 20_000 + "x@example.org",
        "h" * 100_000 + "@example.org",
    ]
    docs = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "doc_id long, text string")
    found = dict(pii.report(docs, "k").select("doc_id", "text").collect())
    for k, value in enumerate(values):
        shape = lambda t: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", t)))
        assert found[k] != value and shape(found[k]) == shape(value)
