"""Batch runs without state: calls that wait overlap, and nothing else changes."""

from __future__ import annotations

import os
import sys
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from keyfold.errors import PermanentError
from keyfold.streaming import EventHandler, call_rows, output_rows, process_keyed

# Workers cannot import a test module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

START = datetime(2024, 3, 1, tzinfo=timezone.utc)
SCHEMA = "topic string, partition int, offset long, timestamp timestamp, key string, payload string, headers map<string,string>"


class Handler(EventHandler):
    """Sleeps, computes, fails or sets a timer, as it is told."""

    def on_message(self, context, message):
        kind, seconds = message.payload["do"], message.payload.get("seconds")
        if kind == "sleep":
            time.sleep(seconds)
        if kind == "compute":
            until = time.process_time() + seconds
            while time.process_time() < until:
                pass
        if kind == "fail":
            raise PermanentError("no")
        if kind == "later":
            context.schedule(context.now + timedelta(seconds=seconds))
        if kind == "die":
            os._exit(1)
        context.emit({"offset": message.offset, "pid": os.getpid()})
        return {"done": kind}

    def on_excise(self, context, message):
        context.emit({"gone": message.offset})
        context.clear_scheduled()

    def on_timer(self, context, timer):
        context.emit({"timer": timer.time.timestamp()})


@pytest.fixture
def one_task(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def log(spark, rows):
    """Events from (key, payload text or None), a second apart."""
    return spark.createDataFrame(
        [("t", n % 3, n, START + timedelta(seconds=n), key, body, {"request-id": str(n)} if n % 4 == 0 else None)
         for n, (key, body) in enumerate(rows)], SCHEMA,
    )


def test_calls_that_wait_do_not_hold_up_other_keys(spark, one_task):
    """one task spent each deadline of 0.25 s after the other."""
    rows = [(f"k{n % 4000}", '{"do": "sleep", "seconds": 60}' if n % 100 == 0 else '{"do": "x"}') for n in range(12000)]
    found = process_keyed(log(spark, rows), Handler(), mode="best-effort", timeout=0.25, telemetry=True)
    began = time.monotonic()
    calls = {
        (r.outcome, r.timed_out): r["count"] for r in call_rows(found)
        .groupBy("outcome", F.coalesce(F.col("error").startswith("timeout"), F.lit(False)).alias("timed_out"))
        .count().collect()
    }
    assert calls == {("skipped", True): 120, ("ok", False): 11880}
    assert time.monotonic() - began < 20  # 30 s of waiting


@pytest.mark.parametrize("mode", ["best-effort", "low-latency"])
def test_same_rows_as_with_a_state_store(spark, rows, mode):
    does = ['{"do": "x"}', '{"do": "fail"}', '{"do": "later", "seconds": 40}', None, "{bad", '{"do": "later", "seconds": 9000}']
    events = log(spark, [(f"k{n % 7}" if n % 11 else None, does[n * n % 13 % 6]) for n in range(400)])
    # emitted process ids differ
    values = F.regexp_replace("value", ', "pid": [0-9]+', "").alias("value")
    columns = ["kind", "topic", "key", "call", "partition", "offset", "time", "attempt", "outcome", "category", "name", "cell", "size", values, "error"]
    free = process_keyed(events, Handler(), mode=mode, max_retries=1, telemetry=True)
    # remembered ids take the state store; no event has an id
    kept = process_keyed(events, Handler(), mode=mode, max_retries=1, telemetry=True, idempotence_ttl=60)
    assert free.schema == kept.schema
    assert rows(free, *columns) == rows(kept, *columns) and free.count() > 400


def test_a_key_with_very_many_rows_stays_in_order(spark, one_task):
    events = log(spark, [("hot" if n % 8 else f"k{n}", '{"do": "x"}') for n in range(20000)])
    found = output_rows(process_keyed(events, Handler(), mode="best-effort"))
    hot = [(r.value, r.offset) for r in found.collect() if r.key == "hot"]
    assert len(hot) == 17500 and len({v.split('"pid"')[1] for v, _ in hot}) == 1
    order = [offset for _, offset in hot]
    assert order == sorted(order, key=lambda n: (n % 3, n))


def test_calls_that_compute_run_one_at_a_time(spark, one_task):
    events = log(spark, [(f"k{n}", '{"do": "compute", "seconds": 0.01}') for n in range(600)])
    found = process_keyed(events, Handler(), mode="best-effort", timeout=5, telemetry=True)
    assert call_rows(found).filter("outcome != 'ok'").count() == 0
    values = output_rows(found).select("value").collect()
    assert len(values) == 600 and len({v.value.split('"pid"')[1] for v in values}) <= 3


def test_a_process_that_dies_fails_the_run(spark):
    events = log(spark, [("k", '{"do": "die"}')])
    with pytest.raises(Exception, match="a process that handles events has died"):
        process_keyed(events, Handler(), mode="best-effort").collect()
