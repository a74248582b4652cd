"""Requests on streams: one outcome per pair for any split, and no late row unseen."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from keyfold.operators import requests
from keyfold.streaming import LateRowGuard, correlate

START = datetime(2024, 3, 1, tzinfo=timezone.utc)
ASK = "request_id string, subsystem string, timestamp timestamp"
ANSWER = ASK + ", offset long, content_type string, body string, error string"
COLUMNS = ("request_id", "subsystem", "status", "value", "error_kind", "error_message")
END = START + timedelta(days=30)


def slices(spark, folder, rows, schema, files):
    """One file per slice of the rows, named and written in order."""
    size = -(-len(rows) // files)
    for n in range(files):
        part = spark.createDataFrame(rows[n * size : (n + 1) * size], schema)
        part.coalesce(1).write.mode("append").parquet(str(folder))


def stream(spark, folder, schema):
    return (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    )


def written(query_df, folder):
    return (
        query_df.writeStream.format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True)
    )


@pytest.fixture(scope="module")
def log():
    """Requests and answers: none, several, early, late, repeated and to nothing."""
    source = random.Random(8)
    asked, answers = [], []
    for n in range(80):
        sent = START + timedelta(seconds=7 * n)
        asked += [(f"r{n}", "stock", sent)] * (2 if n % 9 == 0 else 1)
        asked.append((f"r{n}", "bill", sent))
        for m in range(source.choice([0, 1, 1, 4])):
            at = sent + timedelta(seconds=source.choice([-30, -1, 0, 1, 9, 10, 11, 40]))
            answers.append(
                (f"r{n}", source.choice(["stock", "bill"]), at, 10 * n + m,
                 source.choice(["json", "json", "other"]), source.choice(['{"a":1}', str(m), "{bad"]),
                 source.choice([None, None, "no"]))
            )
    answers += [("nobody", "stock", START + timedelta(seconds=5), 1, "json", "1", None)]
    answers += [(None, "stock", START, 2, "json", "1", None), ("r1", None, START, 3, "json", "1", None)]
    asked.append((None, "stock", START))
    answers.sort(key=lambda a: a[2])
    # each stream ends with a row far ahead, so that every deadline passes
    return [*asked, ("end", "x", END)], [*answers, ("end", "y", END, 0, "json", "1", None)]


def batch_outcomes(spark, log):
    asked = spark.createDataFrame(log[0], ASK).dropDuplicates().filter("request_id is not null")
    us = F.unix_micros("timestamp")
    wanted = asked.select("request_id", "subsystem", us.alias("sent_us"), (us + 10_000_000).alias("deadline_us"))
    groups = spark.createDataFrame([(s, s) for s in ("stock", "bill")], "group_id string, subsystem string")
    answers = spark.createDataFrame(log[1], ANSWER).withColumnRenamed("subsystem", "group_id")
    found = requests.request_outcomes(wanted, requests.first_responses(answers, groups, wanted))
    return sorted(found.filter("request_id != 'end'").select(*COLUMNS).collect(), key=str)


@pytest.mark.parametrize("files", [(1, 1), (6, 2), (3, 7)])
def test_one_outcome_per_pair_for_any_split(spark, tmp_path, log, files):
    for name, rows, schema, n in (("q", log[0], ASK, files[0]), ("a", log[1], ANSWER, files[1])):
        slices(spark, tmp_path / name, rows, schema, n)
    found = correlate(
        stream(spark, tmp_path / "q", ASK), stream(spark, tmp_path / "a", ANSWER),
        timeout=timedelta(seconds=10), lateness=timedelta(hours=1),
    )
    with LateRowGuard(spark) as guard:
        guard.finish(guard.watch(written(found, tmp_path).start()), 300)
    live = spark.read.schema(found.schema).parquet(f"{tmp_path}/out").filter("request_id != 'end'")
    got = sorted(live.select(*COLUMNS).collect(), key=str)
    assert got == batch_outcomes(spark, log) and len(got) == 160


def test_state_is_empty_once_all_is_answered(spark, tmp_path, log):
    for name, rows, schema in (("q", log[0], ASK), ("a", log[1], ANSWER)):
        slices(spark, tmp_path / name, rows, schema, 1)
    found = correlate(
        stream(spark, tmp_path / "q", ASK), stream(spark, tmp_path / "a", ANSWER),
        timeout=10, lateness=0,
    )
    written(found, tmp_path).start().awaitTermination()
    for name in ("span", "answers"):
        state = spark.read.format("statestore").option("stateVarName", name)
        left = state.load(f"{tmp_path}/checkpoint").select("key.request_id").distinct().collect()
        assert {r[0] for r in left} <= {"end"}


def test_tables_are_refused(spark, log):
    table = spark.createDataFrame(log[0], ASK)
    with pytest.raises(ValueError):
        correlate(table, table, timeout=1, lateness=0)


def test_one_late_row_in_a_long_run_fails_the_stream(spark, tmp_path):
    size = 110
    rows = [(f"r{n}", "s", START + timedelta(minutes=n)) for n in range(size)]
    rows[5] = ("late", "s", START - timedelta(days=1))
    slices(spark, tmp_path / "q", rows, ASK, size)
    asked = stream(spark, tmp_path / "q", ASK).withWatermark("timestamp", "0 seconds")
    counted = asked.groupBy(F.window("timestamp", "1 minute")).count()
    with LateRowGuard(spark) as guard:
        query = guard.watch(written(counted, tmp_path).start())
        with pytest.raises(RuntimeError, match="1 late events"):
            guard.finish(query, 600)
    # the query was stopped when it was seen, not at the end of the log
    assert len(query.recentProgress) < size


def test_pairs_of_a_request_share_one_state_value(spark, tmp_path):
    """one value and one timer per request, not several cells per pair."""
    asked = [(f"r{n}", s, START) for n in range(20) for s in ("stock", "bill", "ship")]
    answers = [
        (f"{kind}{n}", s, START + timedelta(seconds=1), 1, "json", "1", None)
        for n in range(20) for kind in ("r", "nobody") for s in ("stock", "bill")
    ]
    slices(spark, tmp_path / "q", asked, ASK, 1)
    slices(spark, tmp_path / "a", answers, ANSWER, 1)
    found = correlate(
        stream(spark, tmp_path / "q", ASK), stream(spark, tmp_path / "a", ANSWER), timeout=10, lateness=60
    )
    written(found, tmp_path).start().awaitTermination()
    held = {
        name: spark.read.format("statestore").option("stateVarName", name)
        .load(f"{tmp_path}/checkpoint").count() for name in ("span", "answers")
    }
    assert held == {"span": 40, "answers": 0}


def test_many_answers_that_wait_for_their_request(spark, tmp_path):
    """Answers beyond those that the value holds are found when the request comes, and go."""
    at = lambda n: START + timedelta(seconds=n)
    many = [("r", "stock", at(100 - n), n, "json", str(n), None) for n in range(100)]
    many += [("r", "bill", at(60), n, "json", str(n), None) for n in (7, 3)]
    many += [("nobody", "stock", at(n), n, "json", "1", None) for n in range(50)]
    late = [("r", "stock", at(50), 1000, "json", '"last"', None), ("end", "y", END, 0, "json", "1", None)]
    for part in (many, late):
        spark.createDataFrame(part, ANSWER).coalesce(1).write.mode("append").parquet(str(tmp_path / "a"))
    for part in ([("other", "x", at(0))], [("r", "stock", at(45)), ("r", "bill", at(45)), ("r", "ship", at(45)), ("end", "x", END)]):
        spark.createDataFrame(part, ASK).coalesce(1).write.mode("append").parquet(str(tmp_path / "q"))
    found = correlate(
        stream(spark, tmp_path / "q", ASK), stream(spark, tmp_path / "a", ANSWER), timeout=20, lateness=120
    )
    with LateRowGuard(spark) as guard:
        guard.finish(guard.watch(written(found, tmp_path).start()), 300)
    live = spark.read.schema(found.schema).parquet(f"{tmp_path}/out").filter("request_id = 'r'")
    # of answers at one time the lowest offset is first
    assert {(r.subsystem, r.value, r.error_kind) for r in live.collect()} == {
        ("stock", "55", None), ("bill", "3", None), ("ship", None, "timeout")
    }
    left = spark.read.format("statestore").option("stateVarName", "answers").load(f"{tmp_path}/checkpoint")
    assert left.count() == 0
