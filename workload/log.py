"""Log shaping and filters."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from keyfold.operators import filters, log
from keyfold.sources import events as source
from keyfold.sources import sinks
from workload import inputs
from workload.inputs import AS_OF, DAY, EV, EV_COPIES

QUERIES, ORACLES = {}, {}


def _us():
    return F.unix_micros("timestamp").alias("us")


def _two_topics(spark, sf_dir):
    """Events and orders in one log."""
    events = inputs.events(spark, sf_dir).drop("headers")
    return events.unionByName(inputs.order_events(spark, sf_dir))


def s1_subscribe(spark, sf_dir):
    chosen = source.select_topics(_two_topics(spark, sf_dir), ["orders"])
    return chosen.groupBy("topic", "partition").agg(F.count("*").alias("n"))


def s2_topic_regex(spark, sf_dir):
    chosen = source.select_topics(_two_topics(spark, sf_dir), "^ev.*s$")
    return chosen.groupBy("topic", "partition").agg(F.count("*").alias("n"))


def s3_record_kind(spark, sf_dir):
    kinds = log.record_kind(inputs.events(spark, sf_dir))
    return kinds.select("key", "offset", "record_kind")


def s4_send(spark, sf_dir):
    calls = inputs.handler_calls(spark, sf_dir)
    sent = sinks.outgoing(
        calls, topic="done", key=F.col("key"), group_id="workers",
        payload=F.struct("offset", "duration_us", "failed"),
    )
    body = F.from_json("payload", "offset long, duration_us long, failed boolean")
    return sent.select(
        "topic", "key", body["offset"].alias("offset"), body["duration_us"].alias("duration_us"),
        body["failed"].alias("failed"),
        F.col("headers")["source-system"].alias("source"),
    )


def s5_excise_write(spark, sf_dir):
    customers = inputs.table(spark, sf_dir, "customer")
    gone = sinks.excise_records(customers, topic="customers", key=F.col("c_custkey"), group_id="crm")
    return gone.select(
        "topic", "key", F.col("payload").isNull().alias("tombstone"),
        F.col("headers")["source-system"].alias("source"),
    )


def s6_source_tag(spark, sf_dir):
    events = inputs.events(spark, sf_dir)
    tagged = events.withColumn("headers", sinks.tag_source(F.col("headers"), "relay"))
    return tagged.select(
        "key", "offset", F.col("headers")["source-system"].alias("source"),
        F.size("headers").alias("n_headers"),
    )


def s8_compact(spark, sf_dir):
    return log.compacted(inputs.events(spark, sf_dir)).select("topic", "key", "offset")


def s9_retention(spark, sf_dir):
    kept = log.retained(inputs.events(spark, sf_dir), AS_OF, timedelta(days=10))
    return kept.select("topic", "partition", "offset", _us())


def s10_resolve_messages(spark, sf_dir):
    events = inputs.events(spark, sf_dir)
    references = events.select(
        F.col("key").alias("owner"), "topic", "partition",
        # Every ninth reference points to a record that is not in the log.
        F.when(F.col("offset") % 9 == 0, F.col("offset") + 10_000_000)
        .otherwise(F.col("offset")).alias("offset"),
    )
    found = log.resolve_positions(references, events)
    body = F.from_json("payload", "id string")
    return found.select("owner", "partition", "offset", _us(), body["id"].alias("id"))


def s11_lifecycle(spark, sf_dir):
    calls = inputs.handler_calls(spark, sf_dir)
    ended = F.timestamp_micros(F.unix_micros("timestamp") + F.col("duration_us"))
    rows = log.lifecycle_rows(
        calls.withColumns(
            {
                "kind": F.lit("message"), "attempt": F.lit(1), "started": F.col("timestamp"),
                "ended": ended, "outcome": F.when(F.col("failed"), "failed").otherwise("ok"),
            }
        )
    )
    return rows


def s12_span_links(spark, sf_dir):
    events = inputs.events(spark, sf_dir)
    child = log.span_links(events, "child").withColumn("relation", F.lit("child"))
    after = log.span_links(events, "follows_from").withColumn("relation", F.lit("follows_from"))
    return child.unionByName(after).select(
        "relation", "offset", "trace_id", "parent_id", "link_id"
    )


def f1_type_filter(spark, sf_dir):
    kept = filters.allowed_types(inputs.events(spark, sf_dir), ["cl", "purchase"])
    return kept.select("key", "offset")


def f2_loop_filter(spark, sf_dir):
    return filters.drop_own(inputs.events(spark, sf_dir), "self").select("key", "offset")


def f3_dedup(spark, sf_dir):
    kept = filters.first_by_id(inputs.with_copies(inputs.events(spark, sf_dir)))
    return kept.select("key", "offset", _us())


def f4_dedup_ttl(spark, sf_dir):
    copies = inputs.with_copies(inputs.events(spark, sf_dir))
    return filters.first_by_id_within(copies, timedelta(days=7)).select("key", "offset", _us())


def f5_dedup_version(spark, sf_dir):
    copies = inputs.with_copies(inputs.events(spark, sf_dir))
    seen = copies.filter("offset < 1000000000 AND payload IS NOT NULL")
    old = filters.with_version(
        seen.select("topic", "key", filters.event_id(F.col("payload")).alias("id"))
    ).withColumn("version", F.when(F.col("id").cast("long") % 3 == 0, "1").otherwise("2"))
    return filters.not_processed(copies, old, "2").select("key", "offset")


def f6_route(spark, sf_dir):
    # every command's time, or the command's own where it names none
    timers = inputs.timer_commands(spark, sf_dir).select(
        "topic", "key", F.coalesce("time", "timestamp").alias("time"),
        (F.col("offset") % 4 == 0).alias("internal"),
    )
    calls = log.route_kinds(inputs.events(spark, sf_dir), timers)
    return calls.groupBy("key", "call").agg(
        F.count("*").alias("n"), F.max(F.unix_micros("time")).alias("last_us")
    )


def j6_offset_skip(spark, sf_dir):
    events = inputs.events(spark, sf_dir)
    noon = F.lit(datetime(2024, 1, 16, 12, tzinfo=timezone.utc))
    # Partition 3 has no progress yet, so all of it is processed.
    progress = events.filter((F.col("timestamp") < noon) & (F.col("partition") < 3)).select(
        "topic", "partition", F.col("offset").alias("last_offset")
    )
    return filters.after_offsets(events, progress).select("partition", "offset")


def _register(function, sql):
    QUERIES[function.__name__] = function
    ORACLES[function.__name__] = sql


_register(s1_subscribe, """
SELECT 'orders' AS topic, CAST(o_custkey % 4 AS INTEGER) AS partition, count(*) AS n
FROM orders GROUP BY 2""")
_register(s2_topic_regex, """
SELECT 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS partition, count(*) AS n
FROM events GROUP BY 2""")
_register(s3_record_kind, f"""
WITH {EV} SELECT key, off AS "offset",
  CASE WHEN tomb THEN 'excise' ELSE 'message' END AS record_kind FROM ev""")
_register(s4_send, """
SELECT 'done' AS topic, CAST(user_id AS VARCHAR) AS key, event_id AS "offset",
  CAST(round(value * 1000000) AS BIGINT) AS duration_us, event_type = 'error' AS failed,
  'workers' AS source FROM events""")
_register(s5_excise_write, """
SELECT 'customers' AS topic, CAST(c_custkey AS VARCHAR) AS key, TRUE AS tombstone,
  'crm' AS source FROM customer""")
_register(s6_source_tag, f"""
WITH {EV} SELECT key, off AS "offset", 'relay' AS source,
  CAST(CASE WHEN off % 5 <> 0 THEN 2 ELSE 1 END AS INTEGER) AS n_headers FROM ev""")
_register(s8_compact, f"""
WITH {EV} SELECT topic, key, max(off) AS "offset" FROM ev GROUP BY topic, key
HAVING NOT arg_max(tomb, off)""")
_register(s9_retention, f"""
WITH {EV} SELECT topic, part AS partition, off AS "offset", us FROM ev
WHERE ts >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 10 DAY""")
_register(s10_resolve_messages, f"""
WITH {EV} SELECT key AS owner, part AS partition,
  CASE WHEN off % 9 = 0 THEN off + 10000000 ELSE off END AS "offset",
  CASE WHEN off % 9 <> 0 THEN us END AS us, CASE WHEN off % 9 <> 0 THEN id END AS id FROM ev""")
_register(s11_lifecycle, """
SELECT 'events' AS topic, CAST(user_id AS VARCHAR) AS key, 'message' AS kind,
  CAST(1 AS INTEGER) AS attempt,
  CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS outcome,
  strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS started,
  strftime(make_timestamp(epoch_us(ts) + CAST(round(value * 1000000) AS BIGINT)),
           '%Y-%m-%dT%H:%M:%S.%gZ') AS ended
FROM events""")
_register(s12_span_links, f"""
WITH {EV}, sp AS (
  SELECT off, md5('events:' || part || ':' || off) AS fresh,
    CASE WHEN off % 5 <> 0 THEN md5(CAST(off AS VARCHAR)) END AS trace,
    CASE WHEN off % 5 <> 0 THEN substr(md5('s' || off), 1, 16) END AS span FROM ev)
SELECT 'child' AS relation, off AS "offset", coalesce(trace, fresh) AS trace_id,
  span AS parent_id, CAST(NULL AS VARCHAR) AS link_id FROM sp
UNION ALL SELECT 'follows_from', off, fresh, NULL, span FROM sp""")
_register(f1_type_filter, f"""
WITH {EV} SELECT key, off AS "offset" FROM ev
WHERE etype IS NULL OR etype IN ('click', 'purchase')""")
_register(f2_loop_filter, f"""
WITH {EV} SELECT key, off AS "offset" FROM ev WHERE off % 7 <> 0""")
_register(f3_dedup, f"""
WITH {EV_COPIES} SELECT key, off AS "offset", us FROM copies
QUALIFY tomb OR row_number() OVER (PARTITION BY topic, key, id ORDER BY part, off) = 1""")
_register(f4_dedup_ttl, f"""
WITH RECURSIVE {EV_COPIES}, c AS (
  SELECT *, row_number() OVER (PARTITION BY key, id ORDER BY us, part, off) AS rn
  FROM copies WHERE NOT tomb
), w AS (
  SELECT key, id, off, us, rn, TRUE AS kept, (us + {7 * DAY * 1_000_000} + 500000) // 1000000 AS ends
  FROM c WHERE rn = 1
  UNION ALL
  SELECT c.key, c.id, c.off, c.us, c.rn, c.us // 1000000 >= w.ends,
    CASE WHEN c.us // 1000000 >= w.ends
         THEN (c.us + {7 * DAY * 1_000_000} + 500000) // 1000000 ELSE w.ends END
  FROM w JOIN c ON c.key = w.key AND c.id = w.id AND c.rn = w.rn + 1
)
SELECT key, off AS "offset", us FROM w WHERE kept
UNION ALL SELECT key, off, us FROM copies WHERE tomb""")
_register(f5_dedup_version, f"""
WITH {EV_COPIES} SELECT key, off AS "offset" FROM copies
WHERE id IS NULL OR CAST(id AS BIGINT) % 3 = 0""")
_register(f6_route, f"""
WITH {inputs.TIMER_COMMANDS}, calls AS (
  SELECT key, CASE WHEN tomb THEN 'on_excise' ELSE 'on_message' END AS call, us FROM ev
  UNION ALL
  SELECT key, 'on_timer', coalesce(time_us, us) FROM tc WHERE off % 4 <> 0)
SELECT key, call, count(*) AS n, max(us) AS last_us FROM calls GROUP BY key, call""")
_register(j6_offset_skip, f"""
WITH {EV}, done AS (
  SELECT part, max(off) AS last FROM ev
  WHERE ts < TIMESTAMP '2024-01-16 12:00:00' AND part < 3 GROUP BY part)
SELECT ev.part AS partition, off AS "offset" FROM ev LEFT JOIN done ON ev.part = done.part
WHERE last IS NULL OR off > last""")
