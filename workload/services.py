"""Requests and published state."""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from keyfold.operators import published, requests, state
from keyfold.session import shared_dir
from keyfold.streaming import LateRowGuard, correlate
from workload import inputs
from workload.inputs import (
    DEQUE_SLOTS, EV, MAP_WRITES, ORDER_EVENTS, RESPONSES, VALUE_WRITES,
)

QUERIES, ORACLES = {}, {}

_SUBSYSTEMS = ["inventory", "billing", "shipping"]
_READ_AT = datetime(2024, 1, 20, 12, tzinfo=timezone.utc)


def _outcomes(spark, sf_dir, asked, subsystems):
    wanted = requests.requested(
        asked, F.col("offset"), subsystems, timedelta(days=365)
    )
    first = requests.first_responses(
        inputs.responses(spark, sf_dir), inputs.groups(spark), wanted
    )
    return requests.request_outcomes(wanted, first)


def r1_request_outcomes(spark, sf_dir):
    asked = inputs.order_events(spark, sf_dir)
    outcomes = _outcomes(spark, sf_dir, asked, _SUBSYSTEMS)
    return outcomes.select("request_id", "subsystem", "status", "value", "error_message")


def r2_request_excise(spark, sf_dir):
    asked = inputs.order_events(spark, sf_dir).filter("payload IS NULL")
    outcomes = _outcomes(spark, sf_dir, asked, ["billing"])
    return outcomes.select("request_id", "subsystem", "status", "error_kind")


def _live_outcomes(spark, sf_dir, asked, subsystems):
    """The same outcomes over two streams, run until all input is processed."""
    folder = f"{shared_dir(spark)}/requests-{uuid.uuid4().hex}"
    names = F.array(*[F.lit(s) for s in requests.subsystem_names(subsystems)])
    sides = {
        "asked": asked.select(F.col("offset").alias("request_id"), F.explode(names).alias("subsystem"), "timestamp"),
        "answers": inputs.responses(spark, sf_dir).join(inputs.groups(spark), "group_id").drop("group_id"),
    }
    streams = {}
    for name, rows in sides.items():
        # the last row of each stream is far ahead, so that every deadline passes
        ahead = spark.range(1).select(
            F.lit(-1).cast("long").alias("request_id"), F.lit(name).alias("subsystem"),
            F.lit(datetime(2200, 1, 1, tzinfo=timezone.utc)).alias("timestamp"),
        )
        ahead.unionByName(rows, allowMissingColumns=True).write.parquet(f"{folder}/{name}")
        streams[name] = spark.readStream.schema(
            spark.read.parquet(f"{folder}/{name}").schema
        ).parquet(f"{folder}/{name}")
    found = correlate(
        streams["asked"], streams["answers"], timeout=timedelta(days=365), lateness=timedelta(days=3650)
    )
    with LateRowGuard(spark) as guard:
        query = guard.watch(
            found.writeStream.format("parquet").option("path", f"{folder}/out")
            .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
        )
        guard.finish(query)
    kept = spark.read.schema(found.schema).parquet(f"{folder}/out").filter("request_id <> '-1'")
    return kept.withColumn("request_id", F.col("request_id").cast("long"))


def r1_request_stream(spark, sf_dir):
    asked = inputs.order_events(spark, sf_dir)
    outcomes = _live_outcomes(spark, sf_dir, asked, _SUBSYSTEMS)
    return outcomes.select("request_id", "subsystem", "status", "value", "error_message")


def r2_request_excise_stream(spark, sf_dir):
    asked = inputs.order_events(spark, sf_dir).filter("payload IS NULL")
    outcomes = _live_outcomes(spark, sf_dir, asked, ["billing"])
    return outcomes.select("request_id", "subsystem", "status", "error_kind")


def r3_outcome_types(spark, sf_dir):
    first = requests.first_responses(
        inputs.responses(spark, sf_dir), inputs.groups(spark)
    )
    typed = requests.outcome_columns(first)
    return typed.groupBy("subsystem", "status", "error_kind", "error_message").agg(
        F.count("*").alias("n")
    )


def r4_handler_responses(spark, sf_dir):
    calls = inputs.handler_calls(spark, sf_dir)
    answered = requests.handler_responses(
        calls.select(
            F.when(F.col("offset") % 3 == 0, F.col("offset")).alias("request_id"),
            "timestamp", "offset",
            F.when(~F.col("failed"), F.to_json(F.struct("duration_us"))).alias("returned"),
            F.col("error_type").alias("error"),
        ),
        "workers",
    )
    body = F.from_json("body", "duration_us long")
    return answered.select(
        "request_id", "group_id", "content_type", body["duration_us"].alias("duration_us"), "error"
    )


def r6_subsystem_groups(spark, sf_dir):
    first = requests.first_responses(
        inputs.responses(spark, sf_dir), inputs.groups(spark)
    )
    return first.select(
        "request_id", "subsystem", F.col("answer.answered_us").alias("answered_us")
    )


def p3_value_lookup(spark, sf_dir):
    snapshot = state.value_snapshot(inputs.value_writes(spark, sf_dir))
    asked = inputs.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("caller"), F.lit("events").alias("topic"),
        F.col("o_custkey").cast("string").alias("key"),
    )
    return published.lookup(snapshot, asked).select("caller", "key", "value")


def p4_map_reads(spark, sf_dir):
    entries = state.map_snapshot(inputs.map_writes(spark, sf_dir))
    asked = inputs.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("caller"), F.lit("events").alias("topic"),
        F.col("o_custkey").cast("string").alias("key"),
        F.concat_ws(":", F.lit("view"), F.col("o_orderkey") % 8).alias("map_key"),
    )
    return state.map_get(entries, asked).select("caller", "key", "map_key", "value")


def p5_map_scan(spark, sf_dir):
    entries = state.map_snapshot(inputs.map_writes(spark, sf_dir))
    return state.map_positions(entries, "forward").select("key", "position", "map_key", "value")


def p6_deque_reads(spark, sf_dir):
    slots = state.deque_slots(inputs.deque_writes(spark, sf_dir))
    asked = inputs.table(spark, sf_dir, "customer").select(
        F.lit("events").alias("topic"), F.col("c_custkey").cast("string").alias("key")
    )
    return state.deque_ends(slots, asked).select("key", "front", "back", "size", "is_empty")


def p7_staleness(spark, sf_dir):
    rows = published.newest_snapshot(
        inputs.daily_batches(spark, sf_dir), _READ_AT, timedelta(hours=18)
    )
    return rows.select("key", "value", "batch_id", "group_id", "stale")


def p10_one_group(spark, sf_dir):
    batches = inputs.daily_batches(spark, sf_dir).groupBy(
        "subsystem", "collection", "group_id"
    ).agg(F.max("batch_id").alias("batch_id"))
    return published.one_group(batches).select("subsystem", "collection", "group_id", "batch_id")


def _register(function, sql):
    QUERIES[function.__name__] = function
    ORACLES[function.__name__] = sql


_MESSAGES = """CASE error_kind WHEN 'timeout' THEN 'no response arrived before the deadline'
    WHEN 'format_mismatch' THEN 'the responder answered in another format'
    WHEN 'handler_error' THEN 'returned'
    WHEN 'malformed_response' THEN 'the response did not decode' END"""

# The first answer between sending and deadline.
_IN_TIME = """in_time AS (
  SELECT r.* FROM resp r JOIN oe ON oe.off = r.request_id
  WHERE r.us BETWEEN oe.us AND oe.us + 365 * 86400000000
  QUALIFY row_number() OVER (
    PARTITION BY r.request_id, r.subsystem ORDER BY r.us, r.off) = 1)"""

_register(r1_request_outcomes, f"""
WITH {ORDER_EVENTS}, {RESPONSES}, {_IN_TIME}, asked(subsystem) AS (
  VALUES ('inventory'), ('billing'), ('shipping')
), o AS (
  SELECT oe.off AS request_id, a.subsystem, f.body,
    CASE WHEN f.us IS NULL THEN 'timeout' ELSE f.error_kind END AS error_kind
  FROM oe CROSS JOIN asked a
  LEFT JOIN in_time f ON f.request_id = oe.off AND f.subsystem = a.subsystem)
SELECT request_id, subsystem, CASE WHEN error_kind IS NULL THEN 'success' ELSE 'failure' END AS status,
  CASE WHEN error_kind IS NULL THEN body END AS value, {_MESSAGES} AS error_message FROM o""")
_register(r2_request_excise, f"""
WITH {ORDER_EVENTS}, {RESPONSES}, {_IN_TIME}, o AS (
  SELECT oe.off AS request_id, 'billing' AS subsystem,
    CASE WHEN f.us IS NULL THEN 'timeout' ELSE f.error_kind END AS error_kind
  FROM oe LEFT JOIN in_time f ON f.request_id = oe.off AND f.subsystem = 'billing' WHERE oe.tomb)
SELECT request_id, subsystem, CASE WHEN error_kind IS NULL THEN 'success' ELSE 'failure' END AS status,
  error_kind FROM o""")
_register(r1_request_stream, ORACLES["r1_request_outcomes"])
_register(r2_request_excise_stream, ORACLES["r2_request_excise"])
_register(r3_outcome_types, f"""
WITH {RESPONSES}
SELECT subsystem, CASE WHEN error_kind IS NULL THEN 'success' ELSE 'failure' END AS status,
  error_kind, {_MESSAGES} AS error_message, count(*) AS n FROM first GROUP BY 1, 2, 3, 4""")
_register(r4_handler_responses, """
SELECT event_id AS request_id, 'workers' AS group_id, 'json' AS content_type,
  CASE WHEN event_type <> 'error' THEN CAST(round(value * 1000000) AS BIGINT) END AS duration_us,
  CASE WHEN event_type = 'error' THEN
    CASE WHEN event_id % 2 = 0 THEN 'TimeoutError' ELSE 'ValueError' END END AS error
FROM events WHERE event_id % 3 = 0""")
_register(r6_subsystem_groups, f"""
WITH {RESPONSES} SELECT request_id, subsystem, us AS answered_us FROM first""")
_register(p3_value_lookup, f"""
WITH {VALUE_WRITES}, snap AS (
  SELECT key, arg_max(k, off) AS value FROM vw GROUP BY key HAVING arg_max(op, off) = 'set')
SELECT o_orderkey AS caller, CAST(o_custkey AS VARCHAR) AS key, snap.value
FROM orders LEFT JOIN snap ON snap.key = CAST(o_custkey AS VARCHAR)""")
_register(p4_map_reads, f"""
WITH {MAP_WRITES} SELECT o_orderkey AS caller, CAST(o_custkey AS VARCHAR) AS key,
  'view:' || (o_orderkey % 8) AS map_key, e.value
FROM orders LEFT JOIN entries e ON e.key = CAST(o_custkey AS VARCHAR)
  AND e.map_key = 'view:' || (o_orderkey % 8)""")
_register(p5_map_scan, f"""
WITH {MAP_WRITES} SELECT key, map_key, value,
  row_number() OVER (PARTITION BY key ORDER BY map_key) - 1 AS position FROM entries""")
_register(p6_deque_reads, f"""
WITH {DEQUE_SLOTS}, ends AS (
  SELECT key, arg_min(value, position) AS front, arg_max(value, position) AS back,
    count(*) AS size FROM slots GROUP BY key)
SELECT CAST(c_custkey AS VARCHAR) AS key, front, back, coalesce(size, 0) AS size,
  size IS NULL AS is_empty
FROM customer LEFT JOIN ends ON ends.key = CAST(c_custkey AS VARCHAR)""")

_BATCHES = f"""{VALUE_WRITES}, b AS (
  SELECT key, us // 86400000000 AS batch_id, arg_max(k, off) AS value,
    'publisher-' || ((us // 86400000000) % 2) AS group_id
  FROM vw WHERE op = 'set' GROUP BY key, us // 86400000000)"""
_register(p7_staleness, f"""
WITH {_BATCHES}, usable AS (
  SELECT * FROM b WHERE (batch_id + 1) * 86400000000 <= epoch_us(TIMESTAMP '2024-01-20 12:00:00')
), pick AS (SELECT group_id, max(batch_id) AS batch_id FROM usable GROUP BY group_id
            ORDER BY group_id LIMIT 1)
SELECT key, value, usable.batch_id, usable.group_id,
  (usable.batch_id + 1) * 86400000000 < epoch_us(TIMESTAMP '2024-01-19 18:00:00') AS stale
FROM usable JOIN pick ON usable.group_id = pick.group_id AND usable.batch_id = pick.batch_id""")
_register(p10_one_group, f"""
WITH {_BATCHES} SELECT 'checkout' AS subsystem, 'latest' AS collection, group_id,
  max(batch_id) AS batch_id FROM b GROUP BY group_id ORDER BY group_id LIMIT 1""")
