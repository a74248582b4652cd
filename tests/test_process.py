"""The keyed processor in batch: modes, order, timers, requests, and state."""

import random
import sys
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from keyfold import definitions as d
from keyfold.errors import PermanentError, TransientError
from keyfold.operators import filters, requests, state
from keyfold.streaming import (
    EventHandler, call_rows, collection_rows, dead_letter_rows, output_rows, parked_rows, process_keyed,
    response_rows,
)

# Workers cannot import test modules, so the handlers below travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
EVENT = (
    "topic string, partition int, offset long, timestamp timestamp, key string, "
    "payload string, headers map<string,string>"
)


def events(spark, *items):
    """Rows from (second, key, payload) or (second, key, payload, headers)."""
    rows = [
        ("t", 0, n, START + timedelta(seconds=item[0]), item[1], item[2],
         item[3] if len(item) > 3 else {})
        for n, item in enumerate(items)
    ]
    return spark.createDataFrame(rows, EVENT).repartition(4)


class Base(EventHandler):
    def on_message(self, context, message):
        return None

    def on_excise(self, context, message):
        return None

    def on_timer(self, context, timer):
        return None


def test_handlers_need_all_methods(spark):
    class Partial(EventHandler):
        def on_message(self, context, message):
            pass

    with pytest.raises(TypeError, match="on_excise"):
        process_keyed(events(spark, (0, "k", "{}")), Partial())
    with pytest.raises(ValueError, match="mode"):
        process_keyed(events(spark, (0, "k", "{}")), Base(), mode="fast")


def test_keys_run_in_order(spark, rows):
    class Echo(Base):
        def on_message(self, context, message):
            context.emit([message.payload["n"], message.offset, message.partition, context.key])

        def on_excise(self, context, message):
            context.emit("gone")

    rng = random.Random(2)
    items = [(n // 3, f"k{rng.randrange(4)}", '{"n":%d}' % n) for n in range(200)]
    items.append((99, "k1", None))
    out = output_rows(process_keyed(events(spark, *items), Echo())).collect()
    by_key = defaultdict(list)
    for row in out:
        by_key[row.key].append(row.value)
    assert sum(map(len, by_key.values())) == 201
    for key, values in by_key.items():
        expected = [f'[{n}, {n}, 0, "{key}"]' for n, item in enumerate(items[:-1]) if item[1] == key]
        assert values == expected + (['"gone"'] if key == "k1" else [])


class Flaky(Base):
    """Fails until the attempt named in the payload; -1 never succeeds, -2 permanently."""

    TRIES = d.value("tries", read_uncommitted=True)
    SEEN = d.deque("seen")

    def on_message(self, context, message):
        context.state(self.SEEN).append(message.payload["id"])
        tries = context.state(self.TRIES)
        count = (tries.get() or 0) + 1
        tries.set(count)
        good = message.payload["good"]
        if good == -2:
            raise PermanentError("never")
        if good == -1 or count < good:
            raise TransientError(f"try {count}")
        tries.clear()
        context.emit(list(context.state(self.SEEN).values()))


FLAKY = [Flaky.TRIES, Flaky.SEEN]


def flaky(spark, **options):
    rows = process_keyed(
        events(
            spark, (0, "a", '{"id":1,"good":1}'), (1, "a", '{"id":2,"good":3}'),
            (2, "a", '{"id":3,"good":1}'), (3, "b", '{"id":4,"good":-2}'),
            (4, "b", '{"id":5,"good":2}'),
        ),
        Flaky(), FLAKY, telemetry=True, **options,
    )
    calls = [
        (r.key, r.offset, r.attempt, r.outcome, r.category) for r in call_rows(rows).collect()
    ]
    return calls, [(r.key, r.value) for r in output_rows(rows).collect()], rows


def test_pipeline_defers_a_failing_key_and_keeps_its_order(spark):
    calls, out, _ = flaky(spark)
    assert [c[1:] for c in calls if c[0] == "a"] == [
        (0, 1, "ok", None), (1, 1, "deferred", "transient"), (1, 2, "deferred", "transient"),
        (1, 3, "ok", None), (2, 1, "ok", None),
    ]
    # The failed attempts left no trace in the transactional collection.
    assert [v for k, v in out if k == "a"] == ["[1]", "[1, 2]", "[1, 2, 3]"]
    assert [c[1:] for c in calls if c[0] == "b"][0] == (3, 1, "permanent", "permanent")


def test_pipeline_batch_ends_with_a_call_that_never_succeeds(spark):
    rows = process_keyed(
        events(spark, (0, "a", '{"id":1,"good":-1}'), (1, "a", '{"id":2,"good":1}')),
        Flaky(), FLAKY, max_attempts=4,
    )
    lost = dead_letter_rows(rows, "failed").collect()
    assert [(r.topic, r.source_topic, r.key, r.offset, r.attempt, r.error) for r in lost] == [
        ("failed", "t", "a", 0, 4, "try 4")
    ]
    assert [r.offset for r in output_rows(rows).collect()] == [1]


def test_pipeline_batch_hands_back_what_never_succeeds(spark):
    rows = process_keyed(
        events(
            spark, (0, "a", '{"id":1,"good":1}'), (1, "a", '{"id":2,"good":-1}'),
            (2, "a", '{"id":3,"good":1}'), (3, "a", None), (4, "b", '{"id":4,"good":1}'),
        ),
        Flaky(), FLAKY, end_attempts=3,
    )
    waiting = [(r.key, r.offset, r.call, r.payload) for r in parked_rows(rows).collect()]
    assert waiting == [
        ("a", 1, "on_message", '{"id":2,"good":-1}'), ("a", 2, "on_message", '{"id":3,"good":1}'),
        ("a", 3, "on_excise", None),
    ]
    assert sorted(r.offset for r in output_rows(rows).collect()) == [0, 4]
    assert dead_letter_rows(rows, "failed").count() == 0


def test_an_undecodable_payload_fails_for_good(spark):
    rows = process_keyed(events(spark, (0, "a", "{no json"), (1, "a", '{"id":1,"good":1}')),
                         Flaky(), FLAKY)
    assert [(r.offset, r.outcome, r.category) for r in call_rows(rows).collect()] == [
        (0, "permanent", "permanent")
    ]
    assert [r.offset for r in output_rows(rows).collect()] == [1]


def test_remembered_ids_skip_events_until_they_expire(spark):
    class Offsets(Base):
        def on_message(self, context, message):
            context.emit(message.offset)

    log = events(
        spark, (0, "a", '{"id":"x"}'), (1, "a", '{"id":"x"}'), (1, "b", '{"id":"x"}'),
        (2, "a", '{"n":1}'), (3, "a", '{"n":1}'), (5, "a", '{"id":"x"}'), (6, "a", '{"id":"x"}'),
    )
    rows = process_keyed(log, Offsets(), idempotence_ttl=5)
    kept = sorted(r.offset for r in output_rows(rows).collect())
    batch = filters.incoming(log, group_id="g", idempotence_ttl=5)
    assert kept == [0, 2, 3, 4, 5] == sorted(r.offset for r in batch.collect())


def test_low_latency_retries_then_dead_letters(spark):
    calls, _, rows = flaky(spark, mode="low-latency", max_retries=1)
    assert [c[1:4] for c in calls if c[0] == "a"] == [
        (0, 1, "ok"), (1, 1, "retry"), (1, 2, "dead_letter"), (2, 1, "ok"),
    ]
    assert [c[1:4] for c in calls if c[0] == "b"] == [(3, 1, "permanent"), (4, 1, "ok")]
    lost = dead_letter_rows(rows, "failed").collect()
    assert [(r.offset, r.payload) for r in lost] == [(1, '{"id":2,"good":3}')]


def test_low_latency_without_retries(spark):
    calls, _, _ = flaky(spark, mode="low-latency", max_retries=0)
    assert [c[3] for c in calls if c[0] == "a"] == ["ok", "dead_letter", "ok"]


def test_best_effort_skips(spark):
    calls, out, _ = flaky(spark, mode="best-effort")
    assert [c[1:4] for c in calls if c[0] == "a"] == [(0, 1, "ok"), (1, 1, "skipped"), (2, 1, "ok")]
    assert [v for k, v in out if k == "a"] == ["[1]", "[1, 3]"]


def test_timers(spark):
    class Timed(Base):
        def on_message(self, context, message):
            at = {n: message.timestamp + timedelta(seconds=n) for n in (10, 20, 30)}
            step = message.payload["step"]
            if step == "many":
                for n in (30, 10, 20, 20):
                    context.schedule(at[n])
                context.unschedule(at[20])
            elif step == "replace":
                context.schedule(at[10])
                context.clear_and_schedule(at[30])
            elif step == "round":
                context.schedule(message.timestamp + timedelta(milliseconds=1499))
                context.schedule(message.timestamp + timedelta(milliseconds=2500))
            elif step == "fail":
                context.schedule(at[10])
                raise PermanentError("timers outlive the call")
            context.emit([int((t - START).total_seconds()) for t in context.scheduled()])

        def on_excise(self, context, message):
            context.clear_scheduled()

        def on_timer(self, context, timer):
            context.emit([timer.key, int((timer.time - START).total_seconds())])

    rows = process_keyed(
        events(
            spark, (0, "many", '{"step":"many"}'), (0, "replace", '{"step":"replace"}'),
            (0, "round", '{"step":"round"}'), (0, "fail", '{"step":"fail"}'),
            (0, "gone", '{"step":"many"}'), (5, "gone", None),
            # A timer due at a row's time fires before that row.
            (10, "many", '{"step":"none"}'),
        ),
        Timed(),
    )
    found = defaultdict(list)
    for row in output_rows(rows).collect():
        found[row.key].append((row.call, row.value))
    assert found["many"] == [
        ("on_message", "[10, 30]"), ("on_timer", '["many", 10]'), ("on_message", "[30]"),
        ("on_timer", '["many", 30]'),
    ]
    assert found["replace"][1:] == [("on_timer", '["replace", 30]')]
    assert found["round"] == [
        ("on_message", "[1, 3]"), ("on_timer", '["round", 1]'), ("on_timer", '["round", 3]')
    ]
    assert found["fail"] == [("on_timer", '["fail", 10]')]
    assert found["gone"] == [("on_message", "[10, 30]")]


def test_async_handlers_and_scans(spark):
    COUNT, TOTALS, LOG = d.value("count"), d.map("totals"), d.message_deque("log", capacity=2)

    class Awaited(Base):
        async def on_message(self, context, message):
            count = context.state(COUNT)
            await count.set((await count.get() or 0) + 1)
            await context.state(TOTALS).set(str(message.offset), message.payload["n"])
            log = context.state(LOG)
            await log.append(message)
            names = [name async for name in context.state(TOTALS)]
            items = [item async for item in context.state(TOTALS).items(d.Direction.BACKWARD)]
            kept = [m.payload["n"] async for m in log.values()]
            await context.emit([await count.get(), names, items, kept])
            return {"ok": True}

    rows = process_keyed(
        events(spark, *[(n, "k", '{"n":%d}' % (n * 10)) for n in range(3)]),
        Awaited(), [COUNT, TOTALS, LOG],
    )
    assert output_rows(rows).collect()[-1].value == (
        '[3, ["0", "1", "2"], [["2", 20], ["1", 10], ["0", 0]], [10, 20]]'
    )


def test_async_handlers_are_cancelled_at_the_deadline(spark):
    class Slow(Base):
        async def on_message(self, context, message):
            import asyncio

            await asyncio.sleep(30)

    rows = process_keyed(
        events(spark, (0, "k", "{}")), Slow(), mode="best-effort", timeout=0.05
    )
    assert [(r.outcome, r.category) for r in call_rows(rows).collect()] == [("skipped", "transient")]


def test_requests_are_answered(spark, rows):
    class Answer(Base):
        def on_message(self, context, message):
            if message.payload["n"] == 1:
                raise PermanentError("out of stock")
            return {1, 2} if message.payload["n"] == 2 else {"accepted": message.key}

    tagged = events(
        spark, *[(n, f"k{n}", '{"n":%d}' % n, {"request-id": f"r{n}"}) for n in range(3)],
        (4, "k4", None, {"request-id": "r4"}), (5, "k5", '{"n":5}'),
    )
    answers = response_rows(process_keyed(tagged, Answer()), "stock-1")
    groups = spark.createDataFrame([("stock-1", "inventory")], "group_id string, subsystem string")
    asked = requests.requested(
        tagged.filter("headers['request-id'] IS NOT NULL"), F.col("headers")["request-id"],
        ["inventory", "billing"], timedelta(seconds=2),
    )
    outcomes = requests.request_outcomes(asked, requests.first_responses(answers, groups))
    found = rows(outcomes.filter("subsystem = 'inventory'"), "request_id", "status", "value", "error_kind")
    assert found == [
        ("r0", "success", '{"accepted": "k0"}', None), ("r1", "failure", None, "handler_error"),
        ("r2", "failure", None, "handler_error"), ("r4", "success", "null", None),
    ]
    late = rows(outcomes.filter("subsystem = 'billing'"), "error_message")
    assert late == [("no response arrived before the deadline",)] * 4


class Collections(Base):
    """Applies a write log to one collection of each kind."""

    V, M, Q, B = d.value("v"), d.map("m"), d.deque("q"), d.deque("b", capacity=3)
    ALL = [V, M, Q, B]

    def on_message(self, context, message):
        op, cell, item = message.payload
        if op in ("set", "remove"):
            {"set": lambda: context.state(self.M).set(cell, item),
             "remove": lambda: context.state(self.M).remove(cell)}[op]()
            context.state(self.V).set(item)
        else:
            getattr(context.state(self.Q), op)(item)
            context.state(self.B).append(item)

    def on_excise(self, context, message):
        for definition in self.ALL:
            context.state(definition).clear()


def test_processor_state_equals_table_folds(spark, rows):
    rng = random.Random(9)
    items = []
    for n in range(600):
        key = "hot" if rng.random() < 1 / 3 else f"k{rng.randrange(9)}"
        op = rng.choice(["set"] * 3 + ["remove", "append", "append", "appendleft"])
        payload = None if rng.random() < 0.03 else f'["{op}","c{rng.randrange(9)}","{n}"]'
        items.append((n, key, payload))
    log = events(spark, *items)
    ran = process_keyed(log, Collections(), Collections.ALL, with_state=True).cache()
    parts = F.from_json("payload", "array<string>")
    writes = log.select(
        "topic", "key", "offset", "timestamp",
        F.coalesce(parts[0], F.lit("clear")).alias("op"), parts[1].alias("map_key"),
        parts[2].alias("value"),
    )
    quoted = F.concat(F.lit('"'), F.col("value"), F.lit('"'))
    pushed = writes.filter("op IN ('append', 'appendleft', 'clear')")
    mapped = writes.filter("op IN ('set', 'remove', 'clear')")
    set_only = mapped.withColumn("op", F.when(F.col("op") == "clear", "clear").otherwise("set"))
    appended = pushed.withColumn("op", F.when(F.col("op") == "clear", "clear").otherwise("append"))
    pairs = [
        (Collections.V, state.value_snapshot(set_only), ["key", "value"]),
        (Collections.M, state.map_snapshot(mapped), ["key", "map_key", "value"]),
        (Collections.Q, state.deque_slots(pushed), ["key", "position", "size", "value"]),
        (Collections.B, state.bounded_deque(appended, 3), ["key", "position", "size", "value"]),
    ]
    for definition, folded, columns in pairs:
        expected = rows(folded.withColumn("value", quoted), *columns)
        assert expected and rows(collection_rows(ran, definition), *columns) == expected
