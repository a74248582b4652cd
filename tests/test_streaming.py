"""Streams: the same results for any split, restarts, and the streaming operators."""

import random
import sys
from datetime import datetime, timedelta, timezone

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from keyfold import definitions as d
from keyfold.operators import failures, filters, published, requests
from keyfold.sources.events import EVENT_SCHEMA, read_log
from keyfold.sources.sinks import batch_writer
from keyfold.streaming import (
    EventHandler, call_rows, check_no_late_rows, committed_state, dead_letter_rows, output_rows,
    process_keyed, publish_state,
)

# Workers cannot import test modules, so the handlers below travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def make_log(n=240, seed=3):
    rng = random.Random(seed)
    rows, now = [], START
    for offset in range(n):
        now += timedelta(seconds=rng.choice([1, 20, 90]))
        key = "hot" if rng.random() < 1 / 3 else f"k{rng.randrange(6)}"
        payload = None if rng.random() < 0.03 else '{"id":"%d","n":%d}' % (offset % 150, offset)
        rows.append(("t", 0, offset, now, key, payload, {}))
    # A row far ahead lets the watermark pass every timer.
    rows.append(("t", 0, n, now + timedelta(days=9), "end", None, {}))
    return rows


def write_files(spark, path, rows, files):
    """One file per slice; names and times ascend, so a stream reads them in order."""
    size = -(-len(rows) // files)
    for n in range(files):
        part = spark.createDataFrame(rows[n * size:(n + 1) * size], EVENT_SCHEMA)
        part.coalesce(1).write.mode("append").parquet(str(path))


def run(query):
    query.awaitTermination(240)
    assert not query.isActive and query.exception() is None


class Sessions(EventHandler):
    """Counts a key's messages until five minutes after the first."""

    COUNT = d.value("count", ttl=timedelta(days=30))
    SEEN = d.map("seen")
    LOG = d.deque("log", capacity=4)
    ALL = [COUNT, SEEN, LOG]

    def on_message(self, context, message):
        count = context.state(self.COUNT)
        if count.get() is None:
            context.clear_and_schedule(context.now + timedelta(minutes=5))
        count.set((count.get() or 0) + 1)
        context.state(self.SEEN).set(f"{message.payload['n'] % 7}", message.offset)
        context.state(self.LOG).append(message.offset)

    def on_timer(self, context, timer):
        context.emit([int(timer.time.timestamp()), context.state(self.COUNT).get()])
        context.state(self.COUNT).clear()

    def on_excise(self, context, message):
        for definition in self.ALL:
            context.state(definition).clear()
        context.clear_scheduled()


@pytest.fixture(scope="module")
def batch_result(spark):
    log = spark.createDataFrame(make_log(), EVENT_SCHEMA)
    found = process_keyed(log, Sessions(), Sessions.ALL)
    return sorted((r.key, r.value) for r in output_rows(found).collect())


@pytest.mark.parametrize("per_trigger", [1, 2, 5])
def test_stream_equals_batch_for_any_split(spark, tmp_path, batch_result, per_trigger):
    write_files(spark, tmp_path / "in", make_log(), 5)
    events = read_log(
        spark, str(tmp_path / "in"), "t", stream=True, max_files_per_trigger=per_trigger
    )
    found = output_rows(process_keyed(events, Sessions(), Sessions.ALL))
    query = (
        found.writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    run(query)
    check_no_late_rows(query)
    out = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.key, r.value) for r in out) == batch_result


def test_restart_resumes_from_committed_state(spark, tmp_path, batch_result):
    rows = make_log()
    folder, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def once():
        events = read_log(spark, folder, stream=True)
        query = (
            output_rows(process_keyed(events, Sessions(), Sessions.ALL))
            .writeStream.format("parquet").option("path", out)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        run(query)

    write_files(spark, folder, rows[:100], 1)
    once()
    seen = committed_state(spark, checkpoint, Sessions.SEEN)
    expected, log = {}, {}
    for _, _, offset, _, key, payload, _ in rows[:100]:
        if payload is None:
            expected[key], log[key] = {}, []
        else:
            expected.setdefault(key, {})[str(offset % 7)] = str(offset)
            log[key] = (log.get(key, []) + [str(offset)])[-4:]
    assert {(r.key, r.map_key, r.value) for r in seen.collect()} == {
        (k, c, v) for k, cells in expected.items() for c, v in cells.items()
    }
    slots = committed_state(spark, checkpoint, Sessions.LOG)
    assert {(r.key, r.position, r["size"], r.value) for r in slots.collect()} == {
        (k, n, len(items), v) for k, items in log.items() for n, v in enumerate(items)
    }
    shared = d.map("seen", published=True, read_cache=False)
    publish_state(
        spark, checkpoint, str(tmp_path / "pub"), shared,
        subsystem="shop", group_id="g", as_of=START,
    )
    reader = published.PublishedReader(spark, str(tmp_path / "pub"), "shop", shared)
    assert reader.snapshot().count() == sum(map(len, expected.values()))

    write_files(spark, folder, rows[100:], 1)
    once()
    found = spark.read.parquet(out).collect()
    assert sorted((r.key, r.value) for r in found) == batch_result


def test_late_rows_are_reported(spark, tmp_path):
    rows = make_log()[:-1]
    mixed = [rows[n::4] for n in range(4)]
    for part in mixed:
        write_files(spark, tmp_path / "in", part, 1)
    events = read_log(spark, str(tmp_path / "in"), stream=True, max_files_per_trigger=1)

    def start(lateness, name):
        rows_ = call_rows(
            # the files' times are mixed; this is about lateness alone
            process_keyed(
                events, Sessions(), Sessions.ALL, lateness=lateness, out_of_order="take", telemetry=True
            )
        )
        query = (
            rows_.writeStream.format("parquet").option("path", str(tmp_path / name))
            .option("checkpointLocation", str(tmp_path / f"{name}-cp"))
            .trigger(availableNow=True).start()
        )
        run(query)
        return query

    with pytest.raises(RuntimeError, match="late events"):
        check_no_late_rows(start(0, "strict"))
    check_no_late_rows(start(timedelta(days=1), "wide"))
    calls = spark.read.parquet(str(tmp_path / "wide")).filter("call != 'on_timer'")
    assert calls.count() == len(rows)


def test_pipeline_retry_survives_micro_batches(spark, tmp_path):
    class Recovering(Sessions):
        TRIES = d.value("tries", read_uncommitted=True)

        def on_message(self, context, message):
            tries = context.state(self.TRIES)
            tries.set((tries.get() or 0) + 1)
            if message.offset == 3 and tries.get() < 6:
                raise OSError("not yet")
            context.emit(message.offset)

    rows = [
        ("t", 0, n, START + timedelta(seconds=2 * n), f"k{n % 2}", '{"n":1}', {}) for n in range(20)
    ]
    rows.append(("t", 0, 20, START + timedelta(days=1), "end", None, {}))
    write_files(spark, tmp_path / "in", rows, 7)
    events = read_log(spark, str(tmp_path / "in"), stream=True, max_files_per_trigger=1)
    found = process_keyed(
        events, Recovering(), [*Sessions.ALL, Recovering.TRIES], telemetry=True
    )
    query = (
        found.writeStream.foreachBatch(
            batch_writer(
                {
                    str(tmp_path / "out"): output_rows,
                    str(tmp_path / "lost"): lambda df: dead_letter_rows(df, "failed"),
                    str(tmp_path / "calls"): call_rows,
                }
            )
        )
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    run(query)
    out = spark.read.parquet(str(tmp_path / "out"))
    by_key = {
        k: [int(r.value) for r in out.filter(F.col("key") == k).orderBy("offset").collect()]
        for k in ("k0", "k1")
    }
    assert by_key == {"k0": list(range(0, 20, 2)), "k1": list(range(1, 20, 2))}
    assert spark.read.parquet(str(tmp_path / "lost")).count() == 0
    calls = spark.read.parquet(str(tmp_path / "calls")).filter("offset = 3")
    outcomes = [r.outcome for r in calls.orderBy("attempt").collect()]
    assert outcomes[-1] == "ok" and set(outcomes[:-1]) == {"deferred"} and len(outcomes) == 5


def memory_stream(spark, df, name, mode="append"):
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).trigger(
        availableNow=True
    ).start()
    run(query)
    return spark.table(name)


def test_streaming_dedup_equals_batch(spark, tmp_path, rows):
    write_files(spark, tmp_path / "in", make_log(), 4)
    events = read_log(spark, str(tmp_path / "in"), stream=True, max_files_per_trigger=1)
    kept = memory_stream(
        spark, filters.incoming(events, group_id="me", idempotence_ttl=timedelta(days=7)), "kept"
    )
    batch = filters.incoming(read_log(spark, str(tmp_path / "in")), group_id="me")
    # The two runs may keep different copies, but as many of each id.
    def count(df):
        return df.groupBy("key", filters.event_id(F.col("payload")).alias("id")).count()

    assert rows(count(kept)) == rows(count(batch))


class Kept(EventHandler):
    """Emits what reaches it and remembers it for two hours."""

    SHORT = d.map("short", ttl=timedelta(hours=2))

    def on_message(self, context, message):
        context.state(self.SHORT).set(str(message.offset), message.offset)
        context.emit(message.offset)

    def on_excise(self, context, message):
        pass

    def on_timer(self, context, timer):
        pass


def test_filters_and_handler_share_one_stream(spark, tmp_path):
    def day(offset, days, kind="order.new", **where):
        body = '{"id":"a","type":"%s"}' % kind
        return ("t", 0, offset, START + timedelta(days=days), "k", body, where)

    log = [day(0, 0), day(1, 1), day(2, 2, "other"), day(3, 8), day(4, 9), day(5, 16)]
    for n, row in enumerate(log):
        write_files(spark, tmp_path / "in", [row], 1)

    def kept(events, version="1", **options):
        wanted = filters.incoming(events, group_id="g", allowed_events=["order."], **options)
        return process_keyed(
            wanted, Kept(), [Kept.SHORT], lateness=timedelta(hours=1),
            idempotence_ttl=timedelta(days=7), idempotence_version=version,
        )

    def once(version):
        events = read_log(spark, str(tmp_path / "in"), stream=True, max_files_per_trigger=1)
        query = (
            output_rows(kept(events, version)).writeStream.format("parquet")
            .option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        )
        run(query)
        return sorted(r.offset for r in spark.read.parquet(str(tmp_path / "out")).collect())

    assert once("1") == [0, 3, 5]
    batch = filters.incoming(
        read_log(spark, str(tmp_path / "in")), group_id="g", allowed_events=["order."],
        idempotence_ttl=timedelta(days=7),
    )
    assert sorted(r.offset for r in batch.collect()) == [0, 3, 5]

    # Two hours on, what the handler stored has expired; readers do not see it.
    def stored(**when):
        found = committed_state(
            spark, str(tmp_path / "cp"), Kept.SHORT, as_of=START + timedelta(days=16, **when)
        )
        return [r.map_key for r in found.collect()]

    assert stored(hours=1) == ["5"] and stored(hours=2) == []

    # An id recorded under another version counts for nothing.
    write_files(spark, tmp_path / "in", [day(6, 17), day(7, 18)], 1)
    assert once("2") == [0, 3, 5, 6]


def test_answers_before_the_request_do_not_count(spark):
    asked = requests.requested(
        spark.createDataFrame([("t", "k", START)], "topic string, key string, timestamp timestamp"),
        F.lit("r"), ["stock"], timedelta(seconds=10),
    )
    groups = spark.createDataFrame([("g", "stock")], "group_id string, subsystem string")

    def value(*seconds):
        answers = spark.createDataFrame(
            [("r", "g", START + timedelta(seconds=s), n, "json", str(s), None)
             for n, s in enumerate(seconds)],
            "request_id string, group_id string, timestamp timestamp, offset long, "
            "content_type string, body string, error string",
        )
        first = requests.first_responses(answers, groups, asked)
        return requests.request_outcomes(asked, first).first().value

    assert value(-86_400, 5, 7) == "5"
    assert value(-1) is None and value(11) is None and value(0, 10) == "0"


def test_streaming_reports_equal_batch_windows(spark, tmp_path, rows):
    log = make_log()
    write_files(spark, tmp_path / "in", log, 3)

    def calls(events):
        return events.select(
            "topic", "key", "timestamp", (F.col("offset") % 3 == 0).alias("failed"),
            (F.col("offset") * 1_000_000).alias("duration_us"),
        )

    stream = read_log(spark, str(tmp_path / "in"), stream=True, max_files_per_trigger=1)
    whole = calls(read_log(spark, str(tmp_path / "in")))
    for name, report in (
        ("rates", lambda c: failures.failure_rates_stream(c, 300, 60, 0.3)),
        ("hot", lambda c: failures.hot_keys_stream(c, 300, 60, 0.9)),
    ):
        live = memory_stream(spark, report(calls(stream)), name)
        closed = F.col("window.end") < F.lit(log[-1][3])
        found, expected = rows(live.filter(closed)), rows(report(whole).filter(closed))
        assert found and found == expected


def test_streaming_requests_equal_batch(spark, tmp_path, rows):
    rng = random.Random(4)
    asked = [(f"r{n}", "stock", START + timedelta(seconds=5 * n)) for n in range(60)]
    asked.append(("end", "stock", START + timedelta(days=2)))
    answers = [("end", "stock", START + timedelta(days=2), 0, "json", "1", None)]
    for n in range(60):
        for m in range(rng.choice([0, 1, 3])):
            at = asked[n][2] + timedelta(seconds=rng.choice([1, 8, 10, 11, 50]))
            answers.append((f"r{n}", "stock", at, n * 10 + m, "json", str(m), rng.choice([None, "no"])))
    answers.sort(key=lambda a: a[2])
    ask_schema = "request_id string, subsystem string, timestamp timestamp"
    answer_schema = ask_schema + ", offset long, content_type string, body string, error string"
    for name, data, schema in (("q", asked, ask_schema), ("a", answers, answer_schema)):
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(tmp_path / name))
    live = [
        spark.readStream.schema(schema).parquet(str(tmp_path / name))
        for name, schema in (("q", ask_schema), ("a", answer_schema))
    ]
    pairs = memory_stream(
        spark, requests.stream_outcomes(*live, timedelta(seconds=10)), "pairs"
    )
    columns = ("request_id", "status", "value", "error_kind", "error_message")
    found = rows(requests.first_of_pairs(pairs).filter("request_id != 'end'"), *columns)
    events = spark.createDataFrame(asked, ask_schema).withColumns(
        {"topic": F.lit("t"), "key": F.lit("k")}
    )
    groups = spark.createDataFrame([("g", "stock")], "group_id string, subsystem string")
    wanted = requests.requested(events, F.col("request_id"), ["stock"], timedelta(seconds=10))
    first = requests.first_responses(
        spark.createDataFrame(answers, answer_schema).drop("subsystem").withColumn("group_id", F.lit("g")),
        groups, wanted,
    )
    expected = rows(requests.request_outcomes(wanted, first).filter("request_id != 'end'"), *columns)
    assert found == expected and len(found) == 60


def test_published_state(spark, tmp_path, rows):
    path = str(tmp_path / "pub")
    totals = d.map("totals", published=True, read_cache=False)
    entries = "topic string, key string, map_key string, value string"

    def put(batch, group, data, definition=totals):
        published.publish(
            spark.createDataFrame(data, entries), path, definition, subsystem="shop",
            group_id=group, batch_id=batch, as_of=START + timedelta(minutes=batch),
        )

    reader = published.PublishedReader(spark, path, "shop", totals)
    put(1, "g1", [("t", "k", "a", "1")])
    put(2, "g1", [("t", "k", "a", "2"), ("t", "k", "b", "3")])
    put(2, "g1", [("t", "k", "a", "2"), ("t", "k", "b", "4")])  # a replay replaces
    put(9, "g2", [("t", "k", "a", "other group")])
    asked = spark.createDataFrame([("t", "k", "b"), ("t", "k", "z")], "topic string, key string, map_key string")
    assert rows(reader.get(asked), "map_key", "value") == [("b", "4"), ("z", None)]
    assert rows(reader.contains(asked), "map_key", "present") == [("b", True), ("z", False)]
    keys = asked.select("topic", "key").distinct()
    many = keys.withColumn("map_keys", F.array(F.lit("b"), F.lit("z"), F.lit("b")))
    assert rows(reader.get_many(many), "position", "value") == [(0, "4"), (1, None), (2, "4")]
    assert [r.map_key for r in reader.items(keys, "backward").collect()] == ["b", "a"]
    assert [r.map_key for r in reader.keys(keys).collect()] == ["a", "b"]
    assert [r.value for r in reader.values(keys).collect()] == ["2", "4"]

    cached = published.PublishedReader(spark, path, "shop", d.map("totals", read_cache=3600))
    cached.snapshot()
    put(3, "g1", [("t", "k", "a", "5")])
    assert rows(cached.snapshot(), "value") == [("2",), ("4",)]  # within the cache window
    assert rows(reader.snapshot(), "value") == [("5",)]

    put(10, "g1", [("t", "k", "a", "6")], d.map("totals"))  # not set: nothing changes
    assert rows(reader.snapshot(), "value") == [("5",)]

    for group in ("g1", "g2"):
        put(10, group, [], d.map("totals", published=False))
    with pytest.raises(LookupError, match="retired"):
        reader.snapshot()


def test_published_kinds(spark, tmp_path, rows):
    path = str(tmp_path / "pub")
    queue = d.deque("queue", published=True)
    slots = spark.createDataFrame(
        [("t", "k", 0, 2, "a"), ("t", "k", 1, 2, "b")],
        "topic string, key string, position long, size long, value string",
    )
    published.publish(
        slots, path, queue, subsystem="shop", group_id="g", batch_id=1, as_of=START
    )
    reader = published.PublishedReader(spark, path, "shop", queue)
    asked = spark.createDataFrame([("t", "k"), ("t", "other")], "topic string, key string")
    assert rows(reader.at(asked, [0, -1, 5]), "index", "value") == [(-1, "b"), (0, "a"), (5, None)]
    assert rows(reader.ends(asked), "key", "front", "back", "size", "is_empty") == [
        ("k", "a", "b", 2, False), ("other", None, None, 0, True)
    ]
    assert [r.value for r in reader.values(asked, "backward").collect()] == ["b", "a"]
    with pytest.raises(TypeError):
        published.PublishedReader(spark, path, "shop", d.message_value("m"))
    with pytest.raises(TypeError, match="published as deque"):
        published.PublishedReader(spark, path, "shop", d.value("queue")).snapshot()
    with pytest.raises(TypeError, match="not a map"):
        reader.get_many(asked)
    with pytest.raises(ValueError, match="True"):
        published.PublishedReader(spark, path, "shop", d.value("v", read_cache=True))
    with pytest.raises(ValueError, match="subsystem"):
        published.publish(slots, path, queue, subsystem="", group_id="g", batch_id=1, as_of=START)


def test_stream_publishes_committed_snapshots(spark, tmp_path, rows):
    write_files(spark, tmp_path / "in", make_log(), 2)
    events = read_log(spark, str(tmp_path / "in"), stream=True)
    count = d.value("latest", published=True)
    latest = events.groupBy("topic", "key").agg(F.max(F.col("offset")).cast("string").alias("value"))
    path = str(tmp_path / "pub")
    query = (
        latest.writeStream.outputMode("complete")
        .foreachBatch(published.publisher(path, count, subsystem="shop", group_id="g"))
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    run(query)
    reader = published.PublishedReader(spark, path, "shop", count)
    asked = spark.createDataFrame([("t", "hot"), ("t", "none")], "topic string, key string")
    expected = max(r[2] for r in make_log() if r[4] == "hot")
    assert rows(reader.get(asked), "key", "value") == [("hot", str(expected)), ("none", None)]


def test_expired_state_is_dropped_by_the_watermark(spark, tmp_path):
    class Remember(Sessions):
        SHORT, FOREVER = d.map("short", ttl=60), d.value("forever")

        def on_message(self, context, message):
            context.state(self.SHORT).set("a", 1)
            if message.key == "kept":
                context.state(self.FOREVER).set(message.offset)

    def message(offset, key, **later):
        return ("t", 0, offset, START + timedelta(**later), key, '{"n":1}', {})

    def cells(definition):
        found = committed_state(spark, str(tmp_path / "cp"), definition).collect()
        return sorted((r.key, r.value) for r in found)

    def once(rows):
        write_files(spark, tmp_path / "in", rows, 1)
        events = read_log(spark, str(tmp_path / "in"), stream=True)
        declared = [*Sessions.ALL, Remember.SHORT, Remember.FOREVER]
        run(
            process_keyed(events, Remember(), declared).writeStream.format("noop")
            .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        )

    once([message(0, "gone", seconds=0), message(1, "kept", seconds=1)])
    assert cells(Remember.SHORT) == [("gone", "1"), ("kept", "1")]
    once([message(2, "kept", hours=3)])
    once([message(3, "end", hours=9)])
    assert cells(Remember.SHORT) == [("end", "1")]
    assert cells(Remember.FOREVER) == [("kept", "2")]
    keys = spark.read.format("statestore").option("stateVarName", "engine-key").load(
        str(tmp_path / "cp")
    )
    assert sorted(r.key.key for r in keys.select("key").collect()) == ["end", "kept"]
