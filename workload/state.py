"""Keyed collections, transactions, expiry, excision and timers."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from keyfold.operators import log, state, timers
from workload import inputs
from workload.inputs import AS_OF, DEQUE_SLOTS, EV, MAP_WRITES, TIMER_COMMANDS, VALUE_WRITES

QUERIES, ORACLES = {}, {}


def v_value_latest(spark, sf_dir):
    snapshot = state.value_snapshot(inputs.value_writes(spark, sf_dir))
    return snapshot.select("topic", "key", "offset", "value")


def m_map_snapshot(spark, sf_dir):
    entries = state.map_snapshot(inputs.map_writes(spark, sf_dir))
    return entries.select("topic", "key", "map_key", "offset", "value")


def m1_get_default(spark, sf_dir):
    entries = state.map_snapshot(inputs.map_writes(spark, sf_dir))
    asked = _keys(spark, sf_dir).withColumn("map_key", F.lit("view:3"))
    return state.map_get(entries, asked, F.lit("none")).select("key", "map_key", "value")


def m2_get_many(spark, sf_dir):
    entries = state.map_snapshot(inputs.map_writes(spark, sf_dir))
    names = ["view:1", "absent", "click:2", "view:1"]
    asked = _keys(spark, sf_dir).withColumn("map_keys", F.array(*[F.lit(n) for n in names]))
    return state.map_get_many(entries, asked).select("key", "position", "map_key", "value")


def m3_contains(spark, sf_dir):
    entries = state.map_snapshot(inputs.map_writes(spark, sf_dir))
    asked = _keys(spark, sf_dir).select(
        "*", F.explode(F.array(F.lit("purchase:0"), F.lit("none:5"))).alias("map_key")
    )
    return state.map_contains(entries, asked).select("key", "map_key", "present")


def m7_items_desc(spark, sf_dir):
    entries = state.map_snapshot(inputs.map_writes(spark, sf_dir))
    placed = state.map_positions(entries, "backward")
    return placed.select("key", "map_key", "value", "position")


def d_deque_values(spark, sf_dir):
    slots = state.deque_slots(inputs.deque_writes(spark, sf_dir))
    listed = state.deque_values(slots, "backward")
    return listed.select("key", "value", "position", "size", "scan_position")


def d_deque_bounded(spark, sf_dir):
    pushes = inputs.deque_writes(spark, sf_dir)
    pushes = pushes.withColumn("op", F.when(F.col("op") == "clear", "clear").otherwise("append"))
    tail = state.bounded_deque(pushes, 3)
    return tail.select("key", "offset", "value", "position", "size")


def d7_deque_index(spark, sf_dir):
    slots = state.deque_slots(inputs.deque_writes(spark, sf_dir))
    return state.deque_get(slots, [0, 1, -1, -2, 40, -200]).select("key", "index", "value")


def d8_deque_ends(spark, sf_dir):
    slots = state.deque_slots(inputs.deque_writes(spark, sf_dir))
    return state.deque_ends(slots, _keys(spark, sf_dir)).select(
        "key", "front", "back", "size", "is_empty"
    )


def m8_keys(spark, sf_dir):
    entries = state.map_snapshot(inputs.map_writes(spark, sf_dir)).select("topic", "key", "map_key")
    forward = state.map_positions(entries).withColumn("direction", F.lit("forward"))
    backward = state.map_positions(entries, "backward").withColumn("direction", F.lit("backward"))
    return forward.unionByName(backward).select("direction", "key", "map_key", "position")


def _messages(spark, sf_dir, place):
    """Stored positions back as messages: the log is read by position."""
    events = inputs.events(spark, sf_dir)
    found = log.resolve_positions(place, events)
    return found.withColumn("id", F.get_json_object("payload", "$.id"))


def v_message_value(spark, sf_dir):
    stored = state.value_snapshot(_message_writes(inputs.value_writes(spark, sf_dir)))
    return _messages(spark, sf_dir, _positions(stored)).select("key", "offset", "id")


def m_message_map(spark, sf_dir):
    stored = state.map_snapshot(_message_writes(inputs.map_writes(spark, sf_dir)))
    return _messages(spark, sf_dir, _positions(stored, "map_key")).select(
        "key", "map_key", "offset", "id"
    )


def d_message_deque(spark, sf_dir):
    stored = state.deque_slots(_message_writes(inputs.deque_writes(spark, sf_dir)))
    return _messages(spark, sf_dir, _positions(stored, "position")).select(
        "key", "position", "offset", "id"
    )


def _message_writes(writes):
    """Message collections keep the delivered message's position, not its payload."""
    place = F.concat_ws(":", "partition", "offset")
    return writes.withColumn("value", F.when(F.col("op") != "clear", place))


def _positions(stored, *columns):
    place = F.split("value", ":")
    return stored.select(
        "topic", "key", *columns,
        place[0].cast("int").alias("partition"), place[1].cast("long").alias("offset"),
    )


def _keys(spark, sf_dir):
    """Every user that ever had an event, the excised ones too."""
    return inputs.events(spark, sf_dir).select("topic", "key").distinct()


def _attempts(spark, sf_dir):
    """Handler attempts with several writes, an explicit commit and a rollback."""
    calls = inputs.handler_calls(spark, sf_dir)
    number = F.col("offset")

    def step(seq, op, value):
        return F.struct(F.lit(seq).cast("long").alias("seq"), op.alias("op"), value.alias("value"))

    nothing = F.lit(None).cast("long")
    steps = F.array(
        step(0, F.lit("set"), number),
        step(1, F.when(number % 3 == 0, "commit"), nothing),
        step(2, F.lit("set"), number + 1_000_000),
        step(3, F.when(number % 5 == 0, "rollback"), nothing),
        step(4, F.when(number % 4 == 0, "set"), number + 2_000_000),
    )
    return calls.select(
        "topic", "partition", "offset", "key", "timestamp",
        F.when(F.col("failed"), "failed").otherwise("ok").alias("outcome"),
        F.explode(steps).alias("_s"),
    ).select("*", "_s.*").drop("_s").filter("op IS NOT NULL")


def k2_commit_fold(spark, sf_dir):
    return _committed(spark, sf_dir, read_uncommitted=False)


def k3_read_uncommitted(spark, sf_dir):
    return _committed(spark, sf_dir, read_uncommitted=True)


def _committed(spark, sf_dir, read_uncommitted):
    lasting = state.committed_writes(_attempts(spark, sf_dir), read_uncommitted=read_uncommitted)
    placed = lasting.withColumn("offset", state.write_position(F.col("offset"), F.col("seq")))
    return state.value_snapshot(placed).select("key", "value")


def k4_ttl_expire(spark, sf_dir):
    snapshot = state.value_snapshot(inputs.value_writes(spark, sf_dir))
    return state.unexpired(snapshot, timedelta(hours=60), AS_OF).select("key", "offset", "value")


def k8_write_guards(spark, sf_dir):
    log = inputs.writes(spark, sf_dir)
    number = F.col("offset")
    tried = log.select(
        "key", "offset",
        F.when(number % 2 == 0, "json").otherwise("message").alias("payload_kind"),
        (number % 3 == 0).alias("is_message"),
        F.when(number % 5 == 0, "null").when(number % 7 == 0, "{bad").otherwise(F.col("value"))
        .alias("value"),
    )
    return state.rejected_writes(tried).select("key", "offset", "reject_reason")


def k12_excise(spark, sf_dir):
    return state.after_excise(inputs.events(spark, sf_dir)).select("key", "offset")


def t_timers_due(spark, sf_dir):
    waiting = timers.scheduled_timers(inputs.timer_commands(spark, sf_dir))
    return timers.due_timers(waiting, AS_OF).select("key", "second")


def t5_timers_scheduled(spark, sf_dir):
    waiting = timers.scheduled_timers(inputs.timer_commands(spark, sf_dir))
    return waiting.groupBy("key").agg(
        F.count("*").alias("timers"), F.min("second").alias("next"), F.max("second").alias("last")
    )


def t6_timers_fired(spark, sf_dir):
    fired = timers.fired_timers(inputs.timer_commands(spark, sf_dir))
    return fired.select("key", "second", "firings")


def _register(function, sql):
    QUERIES[function.__name__] = function
    ORACLES[function.__name__] = sql


_register(v_value_latest, f"""
WITH {VALUE_WRITES} SELECT topic, key, max(off) AS "offset", arg_max(k, off) AS value
FROM vw GROUP BY topic, key HAVING arg_max(op, off) = 'set'""")
_register(m_map_snapshot, f"""
WITH {MAP_WRITES} SELECT topic, key, map_key, off AS "offset", value FROM entries""")
_register(m1_get_default, f"""
WITH {MAP_WRITES} SELECT u.key, 'view:3' AS map_key, coalesce(value, 'none') AS value
FROM (SELECT DISTINCT key FROM ev) u LEFT JOIN entries e ON e.key = u.key AND map_key = 'view:3'""")
_register(m2_get_many, f"""
WITH {MAP_WRITES}, asked(position, map_key) AS (
  VALUES (0, 'view:1'), (1, 'absent'), (2, 'click:2'), (3, 'view:1'))
SELECT u.key, CAST(a.position AS INTEGER) AS position, a.map_key, e.value
FROM (SELECT DISTINCT key FROM ev) u CROSS JOIN asked a
LEFT JOIN entries e ON e.key = u.key AND e.map_key = a.map_key""")
_register(m3_contains, f"""
WITH {MAP_WRITES}, asked(map_key) AS (VALUES ('purchase:0'), ('none:5'))
SELECT u.key, a.map_key, EXISTS (
  SELECT 1 FROM entries e WHERE e.key = u.key AND e.map_key = a.map_key) AS present
FROM (SELECT DISTINCT key FROM ev) u CROSS JOIN asked a""")
_register(m7_items_desc, f"""
WITH {MAP_WRITES} SELECT key, map_key, value,
  row_number() OVER (PARTITION BY key ORDER BY map_key DESC) - 1 AS position FROM entries""")
_register(d_deque_values, f"""
WITH {DEQUE_SLOTS} SELECT key, value, position, size, size - 1 - position AS scan_position
FROM slots""")
_register(d_deque_bounded, f"""
WITH {DEQUE_SLOTS}, tail AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY off DESC) AS back FROM alive
  QUALIFY back <= 3)
SELECT key, off AS "offset", k AS value, row_number() OVER (PARTITION BY key ORDER BY off) - 1 AS position,
  count(*) OVER (PARTITION BY key) AS size FROM tail""")
_register(d7_deque_index, f"""
WITH {DEQUE_SLOTS}, asked("index") AS (VALUES (0), (1), (-1), (-2), (40), (-200))
SELECT u.key, CAST(a."index" AS BIGINT) AS "index", s.value
FROM (SELECT DISTINCT key, size FROM slots) u CROSS JOIN asked a
LEFT JOIN slots s ON s.key = u.key
  AND s.position = CASE WHEN a."index" >= 0 THEN a."index" ELSE u.size + a."index" END""")
_register(d8_deque_ends, f"""
WITH {DEQUE_SLOTS}, ends AS (
  SELECT key, arg_min(value, position) AS front, arg_max(value, position) AS back,
    count(*) AS size FROM slots GROUP BY key)
SELECT u.key, front, back, coalesce(size, 0) AS size, size IS NULL AS is_empty
FROM (SELECT DISTINCT key FROM ev) u LEFT JOIN ends ON ends.key = u.key""")

_register(m8_keys, f"""
WITH {MAP_WRITES} SELECT 'forward' AS direction, key, map_key,
  row_number() OVER (PARTITION BY key ORDER BY map_key) - 1 AS position FROM entries
UNION ALL SELECT 'backward', key, map_key,
  row_number() OVER (PARTITION BY key ORDER BY map_key DESC) - 1 FROM entries""")
_register(v_message_value, f"""
WITH {VALUE_WRITES} SELECT key, max(off) AS "offset", CAST(max(off) AS VARCHAR) AS id
FROM vw GROUP BY key HAVING arg_max(op, off) = 'set'""")
_register(m_message_map, f"""
WITH {MAP_WRITES} SELECT key, map_key, off AS "offset", CAST(off AS VARCHAR) AS id FROM entries""")
_register(d_message_deque, f"""
WITH {DEQUE_SLOTS} SELECT key, position, off AS "offset", CAST(off AS VARCHAR) AS id FROM slots""")

_ATTEMPT_SQL = """a AS (
  SELECT CAST(user_id AS VARCHAR) AS key, event_id AS off, event_type <> 'error' AS ok FROM events
), lasting AS (
  SELECT key, off, 0 AS seq, off AS value FROM a WHERE {first}
  UNION ALL SELECT key, off, 2, off + 1000000 FROM a WHERE {second}
  UNION ALL SELECT key, off, 4, off + 2000000 FROM a WHERE off % 4 = 0 AND {third})
SELECT key, arg_max(value, off * 8 + seq) AS value FROM lasting GROUP BY key"""
_register(k2_commit_fold, "WITH " + _ATTEMPT_SQL.format(
    first="off % 3 = 0 OR (ok AND off % 5 <> 0)", second="ok AND off % 5 <> 0", third="ok"))
_register(k3_read_uncommitted, "WITH " + _ATTEMPT_SQL.format(
    first="TRUE", second="TRUE", third="TRUE"))
_register(k4_ttl_expire, f"""
WITH {VALUE_WRITES} SELECT key, max(off) AS "offset", arg_max(k, off) AS value
FROM vw GROUP BY key
HAVING arg_max(op, off) = 'set' AND max(us) > epoch_us(TIMESTAMP '2024-01-28 12:00:00')""")
_register(k8_write_guards, f"""
WITH {EV}, t AS (
  SELECT key, off, off % 2 = 0 AS json, off % 3 = 0 AS msg,
    CASE WHEN off % 5 = 0 THEN 'null' WHEN off % 7 = 0 THEN 'bad' WHEN tomb THEN 'null'
         ELSE 'good' END AS v FROM ev)
SELECT key, off AS "offset",
  CASE WHEN json AND msg THEN 'message in a JSON collection'
       WHEN NOT json AND NOT msg THEN 'not a delivered message'
       WHEN json AND v = 'null' THEN 'null is not storable'
       WHEN json AND v = 'bad' THEN 'not representable as JSON' END AS reject_reason FROM t""")
_register(k12_excise, f"""
WITH {EV} SELECT a.key, a.off AS "offset" FROM ev a
WHERE NOT a.tomb AND NOT EXISTS (
  SELECT 1 FROM ev b WHERE b.key = a.key AND b.tomb AND b.off > a.off)""")

_WAITING = f"""{TIMER_COMMANDS}, waiting AS (
  SELECT DISTINCT a.key, a.sec AS second FROM tc a
  WHERE a.op IN ('schedule', 'clear_and_schedule') AND NOT EXISTS (
    SELECT 1 FROM tc b WHERE b.key = a.key AND b.off > a.off
      AND (b.op IN ('clear_scheduled', 'clear_and_schedule')
           OR (b.op = 'unschedule' AND b.sec = a.sec))))"""
_register(t_timers_due, f"""
WITH {_WAITING} SELECT key, second FROM waiting
WHERE second <= epoch_us(TIMESTAMP '2024-01-31 00:00:00') // 1000000""")
_register(t5_timers_scheduled, f"""
WITH {_WAITING} SELECT key, count(*) AS timers, min(second) AS next, max(second) AS last
FROM waiting GROUP BY key""")
_register(t6_timers_fired, f"""
WITH {TIMER_COMMANDS}, s AS (
  SELECT * FROM tc WHERE op IN ('schedule', 'clear_and_schedule')
), fired AS (
  SELECT key, sec FROM s WHERE clock_s >= sec
  UNION ALL
  -- The last set before the timer's second, if nothing removes it in time.
  SELECT key, sec FROM s a WHERE clock_s < sec AND NOT EXISTS (
    SELECT 1 FROM tc b WHERE b.key = a.key AND b.off > a.off AND b.clock_s < a.sec
      AND (b.op IN ('clear_scheduled', 'clear_and_schedule') OR b.sec = a.sec)))
SELECT key, sec AS second, count(*) AS firings FROM fired GROUP BY key, sec""")
