"""The given tables in the shapes the operators take.

``events`` stands in for a topic: key = user, offset = event id. Cases the table
lacks are derived from the ids by fixed rules, and ``EV`` and ``EV_COPIES`` state
the same rules in SQL.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyfold.session import configure

# The data covers January 2024; reports are as of its end.
AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)
DAY = 86_400
HOUR = 3_600


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def instant(column: str) -> Column:
    """Zone-less times in the files are UTC."""
    return F.col(column).cast("timestamp")


def _json(*fields: Column) -> Column:
    # Encoding never gives null; saying so lets null checks skip the encoding.
    return F.coalesce(F.to_json(F.struct(*fields)), F.lit("{}"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log, without redelivered copies."""
    return event_log(table(spark, sf_dir, "events"))


def event_log(raw: DataFrame) -> DataFrame:
    """Rows of the events table, batch or stream, as events."""
    number = F.col("event_id")
    body = _json(
        number.cast("string").alias("id"),
        F.when(number % 13 != 0, F.col("event_type")).alias("type"),
        F.col("value"),
        F.get_json_object("props", "$.k").cast("long").alias("k"),
    )
    text = number.cast("string")
    trace = F.concat_ws(
        "-", F.lit("00"), F.md5(text), F.substring(F.md5(F.concat(F.lit("s"), text)), 1, 16),
        F.lit("01"),
    )
    source = F.create_map(
        F.lit("source-system"), F.when(number % 7 == 0, "self").otherwise("other")
    )
    headers = F.when(
        number % 5 != 0, F.map_concat(source, F.create_map(F.lit("traceparent"), trace))
    ).otherwise(source)
    return raw.select(
        F.lit("events").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        number.alias("offset"),
        instant("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("key"),
        F.when(number % 97 != 0, body).alias("payload"),
        headers.alias("headers"),
    )


def with_copies(log: DataFrame) -> DataFrame:
    """The log with redelivered copies of some events, at later offsets and times."""
    number = F.col("offset")

    def delivery(round_: int, days: Column) -> Column:
        return F.struct(F.lit(round_).cast("long").alias("round"), days.alias("days"))

    first = delivery(0, F.lit(0))
    second = delivery(1, F.when(number % 20 == 0, 3).otherwise(10))
    third = delivery(2, F.lit(20))
    rounds = (
        F.when(number % 30 == 0, F.array(first, second, third))
        .when(number % 10 == 0, F.array(first, second))
        .otherwise(F.array(first))
    )
    return log.withColumn("_d", F.explode(rounds)).select(
        "topic", "partition",
        (F.col("offset") + F.col("_d.round") * 1_000_000_000).alias("offset"),
        (F.col("timestamp") + F.make_dt_interval(days=F.col("_d.days"))).alias("timestamp"),
        "key", "payload", "headers",
    )


def handler_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One handler call per event: how it ended and how long it took."""
    raw = table(spark, sf_dir, "events")
    number, fails = F.col("event_id"), F.col("event_type") == "error"
    return raw.select(
        F.lit("events").alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        number.alias("offset"),
        instant("ts").alias("timestamp"),
        F.col("user_id").cast("string").alias("key"),
        F.when(fails, F.when(number % 2 == 0, "TimeoutError").otherwise("ValueError"))
        .alias("error_type"),
        F.when(fails, number % 6).alias("failures"),
        fails.alias("failed"),
        F.round(F.col("value") * 1_000_000).cast("long").alias("duration_us"),
    )


def writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as writes to collections, before an op is chosen."""
    number = F.col("event_id")
    kept = number % 97 != 0
    return table(spark, sf_dir, "events").select(
        F.lit("events").alias("topic"),
        F.col("user_id").cast("string").alias("key"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        number.alias("offset"),
        instant("ts").alias("timestamp"),
        (~kept).alias("excised"),
        F.when(kept & (number % 13 != 0), F.col("event_type")).alias("type"),
        F.when(kept, F.get_json_object("props", "$.k")).alias("value"),
    )


def value_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = writes(spark, sf_dir)
    clears = F.col("excised") | F.col("type").eqNullSafe("signup")
    return log.withColumn("op", F.when(clears, "clear").otherwise("set"))


def map_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = writes(spark, sf_dir)
    op = (
        F.when(F.col("excised"), "clear")
        .when(F.col("type").eqNullSafe("error"), "remove")
        .otherwise("set")
    )
    name = F.when(F.col("type").eqNullSafe("error"), "purchase").otherwise(
        F.coalesce("type", F.lit("none"))
    )
    cell = F.concat_ws(":", name, F.col("offset") % 8)
    return log.withColumns({"op": op, "map_key": F.when(~F.col("excised"), cell)})


def deque_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = writes(spark, sf_dir)
    op = (
        F.when(F.col("excised"), "clear")
        .when(F.col("type").eqNullSafe("signup"), "appendleft")
        .otherwise("append")
    )
    return log.withColumn("op", op)


def timer_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timer commands; times sit on a coarse grid so that they meet again.

    Half of the times are to be rounded up to a second, half down.
    """
    log = writes(spark, sf_dir)
    op = (
        F.when(F.col("excised"), "clear_scheduled")
        .when(F.col("type") == "click", "clear_and_schedule")
        .when(F.col("type") == "purchase", "unschedule")
        .otherwise("schedule")
    )
    grid = F.date_trunc("day", F.col("timestamp")) + F.make_dt_interval(
        days=F.col("offset") % 3, hours=F.lit(12), secs=F.when(F.col("offset") % 2 == 0, 0.4).otherwise(0.6)
    )
    return log.select(
        "topic", "key", "offset", "timestamp", op.alias("op"),
        F.when(~F.col("excised"), grid).alias("time"),
    )


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as events: key = customer, offset = order; some payloads are malformed."""
    raw = table(spark, sf_dir, "orders")
    number = F.col("o_orderkey")
    total = F.round("o_totalprice").cast("long")
    text = number.cast("string")
    payload = (
        F.when(number % 41 == 0, F.lit(None).cast("string"))
        .when(number % 11 == 0, _json(total.alias("total")))
        .when(number % 13 == 0, _json(number.alias("order_id"), total.alias("total")))
        .when(
            F.col("o_orderstatus") == "P",
            _json(text.alias("order_id"), total.cast("string").alias("total")),
        )
        .otherwise(_json(text.alias("order_id"), total.alias("total")))
    )
    return raw.select(
        F.lit("orders").alias("topic"),
        (F.col("o_custkey") % 4).cast("int").alias("partition"),
        number.alias("offset"),
        instant("o_orderdate").alias("timestamp"),
        F.col("o_custkey").cast("string").alias("key"),
        payload.alias("payload"),
    )


def conversation_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as events: key = conversation, offset = turn, state = role."""
    return table(spark, sf_dir, "conversations").select(
        F.lit("conversations").alias("topic"), F.col("conv_id").cast("string").alias("key"),
        F.col("turn").alias("offset"), "role",
    )


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as responses to requests; some fail, some are in another format."""
    raw = table(spark, sf_dir, "lineitem")
    line = F.col("l_linenumber")
    place = F.col("l_partkey") * 1_000_000 + F.col("l_suppkey") * 10 + line
    body = F.to_json(F.struct(F.col("l_partkey").alias("accepted")))
    return raw.select(
        F.col("l_orderkey").alias("request_id"),
        F.concat(F.lit("group-"), F.col("l_suppkey") % 5).alias("group_id"),
        instant("l_shipdate").alias("timestamp"),
        place.alias("offset"),
        F.when(line == 7, "cbor").otherwise("json").alias("content_type"),
        F.when(line == 6, "{not json").otherwise(body).alias("body"),
        F.when(F.col("l_returnflag") == "R", F.lit("returned")).alias("error"),
    )


def groups(spark: SparkSession) -> DataFrame:
    """Which subsystem each consumer group belongs to: a configuration table."""
    rows = [
        ("group-0", "inventory"), ("group-1", "inventory"),
        ("group-2", "billing"), ("group-3", "billing"), ("group-4", "shipping"),
    ]
    return spark.createDataFrame(rows, "group_id string, subsystem string")


def daily_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Published value rows, one batch per day, written by two groups in turn."""
    sets = value_writes(spark, sf_dir).filter("op = 'set'")
    day = F.date_trunc("day", "timestamp")
    number = F.unix_date(F.to_date("timestamp")).cast("long")
    return (
        sets.withColumns({"batch_id": number, "batch_time": day + F.make_dt_interval(days=F.lit(1))})
        .groupBy("topic", "key", "batch_id", "batch_time")
        .agg(F.max_by("value", "offset").alias("value"))
        .withColumns(
            {
                "subsystem": F.lit("checkout"),
                "collection": F.lit("latest"),
                "group_id": F.concat(F.lit("publisher-"), F.col("batch_id") % 2),
            }
        )
    )


# The same rules in SQL.

EV = """ev AS (
  SELECT 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS part, event_id AS off, ts,
         epoch_us(ts) AS us, CAST(user_id AS VARCHAR) AS key, event_id % 97 = 0 AS tomb,
         CASE WHEN event_id % 97 <> 0 THEN CAST(event_id AS VARCHAR) END AS id,
         CASE WHEN event_id % 97 <> 0 AND event_id % 13 <> 0 THEN event_type END AS etype,
         CASE WHEN event_id % 97 <> 0 THEN regexp_extract(props, '[0-9]+') END AS k
  FROM events)"""

EV_COPIES = EV + """, copies AS (
  SELECT topic, part, off, us, key, tomb, id, etype FROM ev
  UNION ALL
  SELECT topic, part, off + 1000000000,
         us + CASE WHEN off % 20 = 0 THEN 3 ELSE 10 END * 86400000000, key, tomb, id, etype
  FROM ev WHERE off % 10 = 0
  UNION ALL
  SELECT topic, part, off + 2000000000, us + 20 * 86400000000, key, tomb, id, etype
  FROM ev WHERE off % 30 = 0)"""

CALLS = """calls AS (
  SELECT 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS part, event_id AS off, ts,
         epoch_us(ts) AS us, CAST(user_id AS VARCHAR) AS key, event_type = 'error' AS failed,
         CASE WHEN event_type = 'error' THEN
           CASE WHEN event_id % 2 = 0 THEN 'transient' ELSE 'permanent' END END AS category,
         CASE WHEN event_type = 'error' THEN event_id % 6 END AS failures,
         CAST(round(value * 1000000) AS BIGINT) AS duration_us
  FROM events)"""

MAP_WRITES = EV + """, mw AS (
  SELECT topic, key, off, k,
         CASE WHEN tomb THEN 'clear' WHEN etype = 'error' THEN 'remove' ELSE 'set' END AS op,
         CASE WHEN tomb THEN NULL
              WHEN etype = 'error' THEN 'purchase:' || (off % 8)
              ELSE coalesce(etype, 'none') || ':' || (off % 8) END AS map_key
  FROM ev), entries AS (
  SELECT a.topic, a.key, a.map_key, a.off, a.k AS value FROM mw a
  WHERE a.op = 'set' AND NOT EXISTS (
    SELECT 1 FROM mw b WHERE b.key = a.key AND b.off > a.off
      AND (b.op = 'clear' OR b.map_key = a.map_key)))"""

DEQUE_SLOTS = EV + """, dw AS (
  SELECT topic, key, off, k,
         CASE WHEN tomb THEN 'clear' WHEN etype = 'signup' THEN 'appendleft' ELSE 'append' END AS op
  FROM ev), alive AS (
  SELECT * FROM dw a WHERE op <> 'clear'
    AND NOT EXISTS (SELECT 1 FROM dw b WHERE b.key = a.key AND b.op = 'clear' AND b.off > a.off)
), slots AS (
  SELECT topic, key, k AS value, off,
         row_number() OVER (PARTITION BY key
           ORDER BY CASE WHEN op = 'appendleft' THEN -off ELSE off END) - 1 AS position,
         count(*) OVER (PARTITION BY key) AS size
  FROM alive)"""

VALUE_WRITES = EV + """, vw AS (
  SELECT topic, key, off, us, k, CASE WHEN tomb OR etype = 'signup' THEN 'clear' ELSE 'set' END AS op
  FROM ev)"""

TIMER_COMMANDS = EV + """, tc AS (
  SELECT topic, key, off, us, us // 1000000 AS clock_s,
         CASE WHEN tomb THEN 'clear_scheduled' WHEN etype = 'click' THEN 'clear_and_schedule'
              WHEN etype = 'purchase' THEN 'unschedule' ELSE 'schedule' END AS op,
         CASE WHEN NOT tomb THEN
           (us // 86400000000) * 86400 + (off % 3) * 86400 + 43200 + off % 2 END AS sec,
         CASE WHEN NOT tomb THEN ((us // 86400000000) + off % 3) * 86400000000
           + 43200000000 + CASE WHEN off % 2 = 0 THEN 400000 ELSE 600000 END END AS time_us
  FROM ev)"""

ORDER_EVENTS = """oe AS (
  SELECT 'orders' AS topic, CAST(o_custkey % 4 AS INTEGER) AS part, o_orderkey AS off,
         epoch_us(o_orderdate) AS us, CAST(o_custkey AS VARCHAR) AS key,
         o_orderkey % 41 = 0 AS tomb, CAST(round(o_totalprice) AS BIGINT) AS total,
         CASE WHEN o_orderkey % 41 = 0 THEN NULL
              WHEN o_orderkey % 11 = 0 THEN 'no_id' WHEN o_orderkey % 13 = 0 THEN 'wrong_id'
              WHEN o_orderstatus = 'P' THEN 'wrong_total' ELSE 'right' END AS shape
  FROM orders)"""

RESPONSES = """resp AS (
  SELECT l_orderkey AS request_id,
         CASE WHEN l_suppkey % 5 < 2 THEN 'inventory' WHEN l_suppkey % 5 < 4 THEN 'billing'
              ELSE 'shipping' END AS subsystem,
         epoch_us(l_shipdate) AS us, l_partkey * 1000000 + l_suppkey * 10 + l_linenumber AS off,
         CASE WHEN l_linenumber = 7 THEN 'format_mismatch'
              WHEN l_returnflag = 'R' THEN 'handler_error'
              WHEN l_linenumber = 6 THEN 'malformed_response' END AS error_kind,
         '{"accepted":' || l_partkey || '}' AS body
  FROM lineitem), first AS (
  SELECT * FROM resp QUALIFY row_number() OVER (
    PARTITION BY request_id, subsystem ORDER BY us, off) = 1)"""
