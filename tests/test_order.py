"""Order over micro-batches, and deadlines of plain handlers."""

from __future__ import annotations

import sys
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from keyfold import definitions as d
from keyfold.sources.events import EVENT_SCHEMA, read_log
from keyfold.streaming import EventHandler, LateRowGuard, call_rows, output_rows, process_keyed
from keyfold.streaming.processor import watchdog

cloudpickle.register_pickle_by_value(sys.modules[__name__])

START = datetime(2024, 5, 1, tzinfo=timezone.utc)
SEEN = d.value("seen")


class Chain(EventHandler):
    """Emits each event with the one handled before it; wakes itself in between."""

    def on_message(self, context, message):
        seen = context.state(SEEN)
        context.emit({"offset": message.offset, "after": seen.get()})
        seen.set(message.offset)
        context.schedule(message.timestamp + timedelta(seconds=90))

    def on_excise(self, context, message):
        context.state(SEEN).clear()

    def on_timer(self, context, timer):
        seen = context.state(SEEN)
        seen.set((seen.get() or 0) + 1000)


@pytest.fixture(scope="module")
def log():
    rows = [
        ("t", n % 2, n, START + timedelta(minutes=n), f"k{n % 2}", None if n % 11 == 0 else '{"n":%d}' % n, {})
        for n in range(1, 60)
    ]
    return [*rows, ("t", 0, 60, START + timedelta(days=9), "end", None, {})]


def files(spark, folder, rows, order):
    """Twelve files of five rows, written, and so listed, in the order given."""
    for n in order:
        part = spark.createDataFrame(rows[5 * n : 5 * n + 5], EVENT_SCHEMA)
        part.coalesce(1).write.mode("append").parquet(str(folder))
        time.sleep(0.05)


def chained(rows):
    body = F.from_json("value", "offset long, after long")
    found = output_rows(rows).select("key", body.alias("b")).select("key", "b.*")
    return sorted(map(tuple, found.collect()), key=str)


def started(rows, folder):
    return (
        rows.writeStream.format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )


# neighbours change places; the last file, with the end of time, stays last
SHUFFLED = [1, 0, 3, 2, 5, 4, 7, 6, 9, 8, 10, 11]


def test_files_out_of_order_are_put_in_order(spark, tmp_path, log):
    expected = chained(process_keyed(spark.createDataFrame(log, EVENT_SCHEMA), Chain(), [SEEN]))
    assert len(expected) > 40
    files(spark, tmp_path / "in", log, SHUFFLED)
    events = read_log(spark, str(tmp_path / "in"), stream=True, max_files_per_trigger=1)
    rows = process_keyed(events, Chain(), [SEEN], lateness=timedelta(minutes=30), out_of_order="wait")
    with LateRowGuard(spark) as guard:
        guard.finish(guard.watch(started(rows, tmp_path)), 300)
    assert chained(spark.read.schema(rows.schema).parquet(f"{tmp_path}/out")) == expected


def test_files_out_of_order_fail_without_reordering(spark, tmp_path, log):
    files(spark, tmp_path / "in", log, SHUFFLED)
    events = read_log(spark, str(tmp_path / "in"), stream=True, max_files_per_trigger=1)
    rows = process_keyed(events, Chain(), [SEEN], lateness=timedelta(minutes=30))
    query = started(rows, tmp_path)
    with pytest.raises(Exception, match="out of order"):
        query.awaitTermination(300)


class Sleeper(EventHandler):
    def on_message(self, context, message):
        context.state(SEEN).set(message.offset)
        if message.offset % 2:
            time.sleep(30)
        context.emit(message.offset)

    def on_excise(self, context, message):
        pass

    def on_timer(self, context, timer):
        pass


def test_plain_handlers_are_cut_off_and_rolled_back(spark):
    log = [("t", 0, n, START, "k", "{}", {}) for n in range(4)]
    began = time.monotonic()
    rows = process_keyed(
        spark.createDataFrame(log, EVENT_SCHEMA), Sleeper(), [SEEN], mode="best-effort", timeout=0.3
    ).cache()
    assert sorted(r.value for r in output_rows(rows).collect()) == ["0", "2"]
    failed = call_rows(rows).select("offset", "category", "error").collect()
    assert sorted((r[0], r[1]) for r in failed) == [(1, "transient"), (3, "transient")]
    assert all(r[2].startswith("timeout") for r in failed)
    assert time.monotonic() - began < 30


def test_a_call_that_cannot_be_interrupted_is_still_too_long():
    with pytest.raises(TimeoutError):
        with watchdog(0.01):
            try:
                time.sleep(0.1)
            except TimeoutError:
                pass
    with watchdog(5), watchdog(None):
        pass
