"""Publishing changes: against plain dictionaries, over streams, and what is left on disk."""

from __future__ import annotations

import os
import random
import sys
from datetime import datetime, timedelta, timezone

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from keyfold import definitions as d
from keyfold.operators import published
from keyfold.sources.events import EVENT_SCHEMA, read_log
from keyfold.streaming import EventHandler, output_rows, process_keyed, publish_state

cloudpickle.register_pickle_by_value(sys.modules[__name__])

START = datetime(2024, 7, 1, tzinfo=timezone.utc)
PLACE = {"subsystem": "shop", "group_id": "g"}
ENTRY = "topic string, key string, map_key string, value string, _deleted boolean"


def when(batch):
    return START + timedelta(minutes=batch)


def put(spark, path, definition, batch, data, schema=ENTRY, **how):
    published.publish_changes(
        spark.createDataFrame(data, schema), path, definition, batch_id=batch, as_of=when(batch), **PLACE, **how
    )


def reader(spark, path, definition):
    return published.PublishedReader(spark, path, "shop", definition)


def segments(path, name):
    return os.listdir(f"{path}/state/shop/{name}/g")


def test_map_changes_against_a_dictionary(spark, tmp_path):
    path, carts = str(tmp_path), d.map("carts", published=True, read_cache=False)
    random_ = random.Random(5)
    held: dict[tuple, str] = {}
    for batch in range(12):
        fresh, gone, cleared = {}, set(), set()
        for _ in range(60 if batch == 0 else 6):
            key = random_.choice(["hot", "hot", "a", "b", None])
            cell = (key, f"m{random_.randrange(30)}")
            if random_.random() < 0.7:
                fresh[cell] = f"{batch}"
                gone.discard(cell)
            elif cell not in fresh:
                gone.add(cell)
        if batch in (4, 9):
            cleared.add("hot" if batch == 4 else None)
        held = {c: v for c, v in held.items() if c not in gone and c[0] not in cleared} | fresh
        data = [("t", *cell, value, None) for cell, value in fresh.items()]
        data += [("t", *cell, None, True) for cell in gone]
        data += [("t", key, None, None, True) for key in cleared]
        put(spark, path, carts, batch, data, kept=2)
        if batch == 6:
            put(spark, path, carts, batch, data, kept=2)  # a replay changes nothing
        if batch in (0, 4, 6, 9, 11):
            found = reader(spark, path, carts).snapshot().collect()
            assert {(r.key, r.map_key): r.value for r in found} == held
            assert len(found) == len(held)
    keys = spark.createDataFrame([("t", "a")], "topic string, key string")
    assert [r.map_key for r in reader(spark, path, carts).keys(keys).collect()] == sorted(
        m for k, m in held if k == "a"
    )
    assert len(os.listdir(f"{path}/log")) == 2
    assert len(segments(path, "carts")) <= 8
    with pytest.raises(ValueError, match="in order"):
        put(spark, path, carts, 3, [])


def test_values_deques_empty_changes_and_retirement(spark, tmp_path):
    path = str(tmp_path)
    total, queue = d.value("total", published=True, read_cache=False), d.deque("queue", published=True, read_cache=False)
    schema = "topic string, key string, value string, _deleted boolean"
    put(spark, path, total, 1, [("t", "a", "1", False), ("t", "b", "1", False), ("t", "gone", None, True)], schema)
    put(spark, path, total, 2, [("t", "b", None, True), ("t", "c", "2", False)], schema)
    put(spark, path, total, 3, [], schema)
    asked = spark.createDataFrame([("t", k) for k in "abc"], "topic string, key string")
    found = {r.key: r.value for r in reader(spark, path, total).get(asked).collect()}
    assert found == {"a": "1", "b": None, "c": "2"}
    put(spark, path, total, 4, [("t", k, None, True) for k in "abc"], schema)
    assert reader(spark, path, total).snapshot().count() == 0
    put(spark, path, d.value("total", published=False), 5, [], schema)
    with pytest.raises(LookupError, match="retired"):
        reader(spark, path, total).snapshot()
    put(spark, path, total, 6, [("t", "z", "6", False)], schema)  # starts anew
    assert [r.key for r in reader(spark, path, total).snapshot().collect()] == ["z"]
    with pytest.raises(ValueError, match="kept"):
        put(spark, path, total, 7, [], schema, kept=0)

    slots = "topic string, key string, position long, size long, value string, extra string, _deleted boolean"
    first = [("t", k, n, 5, f"{k}{n}", "x", False) for k in ("p", "q", "r") for n in range(5)]
    put(spark, path, queue, 1, first, slots)
    put(spark, path, queue, 2, [("t", "p", 0, 1, "new", None, False), ("t", "q", None, None, None, None, True)], slots)
    found = sorted((r.key, r.position, r.value) for r in reader(spark, path, queue).snapshot().collect())
    assert found == [("p", 0, "new")] + [("r", n, f"r{n}") for n in range(5)]


class Tally(EventHandler):
    """Counts per key; a third event ends the entry, an excise clears all."""

    COUNT = d.value("count", published=True, read_cache=False)
    LAST = d.map("last", published=True, read_cache=False, ttl=timedelta(days=2))
    TAIL = d.deque("tail", capacity=3, published=True, read_cache=False)
    ALL = [COUNT, LAST, TAIL]

    def on_message(self, context, message):
        count = context.state(self.COUNT)
        count.set((count.get() or 0) + 1)
        entries = context.state(self.LAST)
        if count.get() % 3:
            entries.set(f"m{message.offset % 4}", message.offset)
        else:
            entries.clear()
        context.state(self.TAIL).append(message.offset)

    def on_excise(self, context, message):
        for definition in self.ALL:
            context.state(definition).clear()

    def on_timer(self, context, timer):
        pass


def test_state_changes_of_a_stream(spark, tmp_path):
    """Publishing changes after each run gives what publishing the whole state gives."""
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    random_ = random.Random(2)
    for step in range(3):
        rows = [
            ("t", 0, n, START + timedelta(hours=n), random_.choice(["hot", "a", "b", "c"]),
             None if random_.random() < 0.15 else "{}", {})
            for n in range(step * 15, step * 15 + 15)
        ]
        spark.createDataFrame(rows, EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
        out = output_rows(process_keyed(
            read_log(spark, folder, stream=True), Tally(), Tally.ALL, lateness=timedelta(days=30), out_of_order="take",
            subsystem="shop",
        ))
        query = (
            out.writeStream.format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination(240)
        assert query.exception() is None
        at = rows[-1][3]
        for definition in Tally.ALL:
            for part, changes in (("changes", True), ("whole", False)):
                publish_state(
                    spark, checkpoint, str(tmp_path / part), definition, as_of=at, changes=changes, **PLACE
                )
            changed, whole = (
                reader(spark, str(tmp_path / part), definition).snapshot() for part in ("changes", "whole")
            )
            names = whole.columns
            key = lambda r: tuple(map(str, r))
            assert sorted(map(tuple, changed.select(*names).collect()), key=key) == sorted(
                map(tuple, whole.collect()), key=key
            )


def test_update_mode_publishes_changes(spark, tmp_path):
    folder, path = str(tmp_path / "in"), str(tmp_path / "pub")
    latest = d.value("latest", published=True, read_cache=False)
    for n in range(3):
        rows = [("t", 0, n, START + timedelta(hours=n), f"k{n % 2}", "{}", {})]
        spark.createDataFrame(rows, EVENT_SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    events = read_log(spark, folder, stream=True, max_files_per_trigger=1)
    query = (
        events.groupBy("topic", "key").agg(F.max("offset").cast("string").alias("value"))
        .writeStream.outputMode("update").foreachBatch(published.publisher(path, latest, changes=True, **PLACE))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination(240)
    assert query.exception() is None
    found = {(r.key, r.value) for r in reader(spark, path, latest).snapshot().collect()}
    assert found == {("k0", "2"), ("k1", "1")}
