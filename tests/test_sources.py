"""Logs in and out: topics, Kafka row shapes, outgoing events, sinks, telemetry."""

import sys
from datetime import datetime, timedelta, timezone

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from keyfold.operators import failures, filters, log, requests, state
from keyfold.session import shared_dir
from keyfold.sources.events import EVENT_SCHEMA, decode_kafka, read_log, select_topics
from keyfold.sources.sinks import excise_records, kafka_rows, outgoing, write_batch
from keyfold.streaming import EventHandler, call_rows, process_keyed, telemetry_rows

cloudpickle.register_pickle_by_value(sys.modules[__name__])

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def events(spark, *items):
    rows = [
        ("t", 0, n, START + timedelta(seconds=n), key, payload, headers)
        for n, (key, payload, headers) in enumerate(items)
    ]
    return spark.createDataFrame(rows, EVENT_SCHEMA)


def test_topic_choices(spark, rows):
    names = spark.createDataFrame([("a",), ("ab",), ("b",)], "topic string")
    assert rows(select_topics(names, "a")) == [("a",)]
    assert rows(select_topics(names, ["a", "b"])) == [("a",), ("b",)]
    assert rows(select_topics(names, "^a.*")) == [("a",), ("ab",)]
    # A pattern has to match the whole name.
    assert rows(select_topics(names, "^a|b$")) == [("a",), ("b",)]
    with pytest.raises(ValueError):
        select_topics(names, [])


def test_type_filter_matches_from_the_start(spark, rows):
    types = ["user.created", "account.deleted", "admin.user.created", "my.account.deleted", "notification"]
    log_ = events(
        spark, *[(t, '{"type":"%s"}' % t, {}) for t in types], ("none", '{"x":1}', {}), ("gone", None, {})
    )
    kept = filters.allowed_types(log_, ["user.", "account."])
    assert rows(kept, "key") == [("account.deleted",), ("gone",), ("none",), ("user.created",)]
    assert filters.allowed_types(log_, []).count() == 7


def test_loop_filter_and_source_tag(spark, rows):
    sent = outgoing(
        events(spark, ("k", '{"a":1}', {"source-system": "old", "x": "y"})),
        topic="out", key=F.col("key"), payload=F.col("payload"), group_id="me", headers=F.col("headers"),
    )
    assert sent.first().headers == {"source-system": "me", "x": "y"} and sent.first().payload == '{"a":1}'
    back = events(
        spark, ("own", "{}", {"source-system": "me"}), ("other", "{}", {"source-system": "you"}),
        ("untagged", "{}", {}), ("bare", "{}", None),
    )
    assert rows(filters.drop_own(back, "me"), "key") == [("bare",), ("other",), ("untagged",)]
    tagged = outgoing(
        back, topic="out", key=F.col("key"), payload=F.struct("offset"), group_id="me", source_system="alias"
    )
    assert {r.headers["source-system"] for r in tagged.collect()} == {"alias"}


def test_dedup_example(spark, rows):
    log_ = events(
        spark, ("key1", '{"id":"msg-123","content":"Hello!"}', {}),
        ("key1", '{"id":"msg-123","content":"again"}', {}), ("key2", '{"id":"msg-123"}', {}),
        ("key1", '{"content":"no id"}', {}), ("key1", '{"content":"no id"}', {}), ("key1", None, {}),
    )
    assert rows(filters.first_by_id(log_), "offset") == [(0,), (2,), (3,), (4,), (5,)]
    assert rows(filters.incoming(log_, group_id="g", idempotence_ttl=3600), "offset") == [
        (0,), (2,), (3,), (4,), (5,)
    ]


def test_kafka_rows_round_trip(spark):
    sent = outgoing(
        events(spark, ("k", "{}", {})), topic="t", key=F.col("key"),
        payload=F.struct(F.lit("café 😀").alias("s")), group_id="g",
        headers=requests.request_header(F.lit(7)),
    )
    raw = kafka_rows(sent).select(
        "topic", F.lit(0).alias("partition"), F.lit(5).cast("long").alias("offset"),
        F.lit(START).alias("timestamp"), "key", "value", "headers",
    )
    assert raw.schema["key"].dataType.typeName() == "binary"
    back = decode_kafka(raw).first()
    assert (back.key, back.payload) == ("k", '{"s":"café 😀"}')
    assert back.headers == {"request-id": "7", "source-system": "g"}
    gone = decode_kafka(
        kafka_rows(excise_records(sent, topic="t", key=F.col("key"), group_id="g")).select(
            "topic", F.lit(0).alias("partition"), F.lit(6).cast("long").alias("offset"),
            F.lit(START).alias("timestamp"), "key", "value",
            # A header name may repeat; the last one stands.
            F.concat("headers", "headers").alias("headers"),
        )
    ).first()
    assert gone.payload is None and gone.headers == {"source-system": "g"}


def test_replayed_batch_replaces_itself(spark, tmp_path):
    for _ in range(2):
        write_batch(spark.range(3), str(tmp_path), 4)
    write_batch(spark.range(2), str(tmp_path), 5)
    assert spark.read.parquet(str(tmp_path)).count() == 5


def test_read_log_selects_topics(spark, tmp_path):
    events(spark, ("k", "{}", {})).write.parquet(str(tmp_path / "log"))
    assert read_log(spark, str(tmp_path / "log"), "t").count() == 1
    assert read_log(spark, str(tmp_path / "log"), ["u"]).count() == 0


def test_shared_dir_comes_from_the_session(spark, monkeypatch):
    class Cluster:
        sparkContext = type("C", (), {"master": "spark://host"})()

        class conf:
            get = staticmethod(lambda name, default=None: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Cluster)
    Cluster.conf.get = staticmethod(lambda name, default=None: "hdfs://shared/")
    assert shared_dir(Cluster) == "hdfs://shared"


class Plain(EventHandler):
    def on_message(self, context, message):
        if message.payload.get("bad"):
            raise KeyError("bad")

    def on_excise(self, context, message):
        return None

    def on_timer(self, context, timer):
        return None


def test_telemetry_covers_every_call(spark, rows):
    log_ = events(spark, ("a", "{}", {}), ("a", '{"bad":true}', {}), ("b", None, {}))
    quiet = call_rows(process_keyed(log_, Plain(), mode="best-effort"))
    assert rows(quiet, "offset", "outcome") == [(1, "skipped")]
    loud = telemetry_rows(process_keyed(log_, Plain(), mode="best-effort", telemetry=True))
    assert rows(loud, "key", "kind", "attempt", "outcome") == [
        ("a", "message", 1, "ok"), ("a", "message", 1, "skipped"), ("b", "excise", 1, "ok")
    ]
    text = loud.first()
    assert text.started.endswith("Z") and len(text.started) == 24 and text.started <= text.ended


def test_span_links(spark):
    log_ = events(spark, ("k", "{}", {"traceparent": "00-abc-def-01"}), ("k", "{}", {}))
    child, rootless = log.span_links(log_, "child").orderBy("offset").collect()
    assert (child.trace_id, child.parent_id, child.link_id) == ("abc", "def", None)
    assert rootless.parent_id is None and len(rootless.trace_id) == 32
    after = log.span_links(log_, "follows_from").orderBy("offset").first()
    assert after.trace_id != "abc" and (after.parent_id, after.link_id) == (None, "def")
    with pytest.raises(ValueError):
        log.span_links(log_, "sibling")


def test_backoff_is_capped_and_adds_up(spark, rows):
    calls = spark.createDataFrame([(1, "transient", 7)], "offset long, category string, failures long")
    routed = failures.route_calls(calls, "pipeline")
    schedule = failures.retry_schedule(routed, base=1, cap=10)
    assert rows(schedule, "retry", "delay_us", "wait_us") == [
        (1, 1_000_000, 1_000_000), (2, 2_000_000, 3_000_000), (3, 4_000_000, 7_000_000),
        (4, 8_000_000, 15_000_000), (5, 10_000_000, 25_000_000), (6, 10_000_000, 35_000_000),
        (7, 10_000_000, 45_000_000),
    ]
    with pytest.raises(ValueError):
        failures.route_calls(calls, "fast")
    with pytest.raises(ValueError):
        failures.route_calls(calls, "low-latency", -1)
    assert failures.deadline_us(stall_threshold=60) == 48_000_000 and failures.deadline_us(30) == 30_000_000


def test_state_arguments_are_checked(spark):
    slots = spark.createDataFrame([("t", "k", 0, 1, "a")], "topic string, key string, position long, size long, value string")
    for bad in (1.5, True, "0"):
        with pytest.raises(TypeError):
            state.deque_get(slots, [bad])
    with pytest.raises(ValueError):
        state.deque_values(slots, "sideways")
    with pytest.raises(ValueError):
        state.bounded_deque(slots, 0)


def test_ttl_of_zero_keeps_cells(spark):
    cells = events(spark, ("k", "{}", {}))
    late = START + timedelta(days=400)
    assert state.unexpired(cells, 0, late).count() == 1
    assert state.unexpired(cells, timedelta(days=400), late).count() == 0
    assert state.unexpired(cells, timedelta(days=401), late).count() == 1
