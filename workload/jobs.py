"""Whole jobs, and the keyed processor checked against them."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from keyfold.operators import jobs, windows
from workload import inputs
from workload.inputs import AS_OF, DAY, EV, ORDER_EVENTS

QUERIES, ORACLES = {}, {}

_ORDER = {"order_id": "string", "total": "integer"}


def j1_counter(spark, sf_dir):
    counts = jobs.counters(inputs.events(spark, sf_dir), timedelta(days=4), AS_OF)
    return counts.select("key", "counter", "starts", "highest")


def j2_burst_window(spark, sf_dir):
    found = windows.burst_windows(inputs.events(spark, sf_dir), timedelta(days=1), capacity=3)
    return found.select(
        "key", "open_us", "open_offset", "close_second", "held", "summarised", "last_offset"
    )


def j2_burst_held(spark, sf_dir):
    held = windows.burst_held(inputs.events(spark, sf_dir), timedelta(days=1), capacity=3)
    return held.select("key", "close_second", "offset", "from_back")


def j3_cart(spark, sf_dir):
    orders = inputs.order_events(spark, sf_dir)
    carts = jobs.cart_summary(orders, "order_id", "total", 5, _ORDER)
    return carts.select("key", "items", "last_total", "oldest", "newest", "backlog")


def j3_cart_items(spark, sf_dir):
    items = jobs.cart_items(inputs.order_events(spark, sf_dir), "order_id", _ORDER)
    return items.select("key", "place", "item")


def j4_schema_check(spark, sf_dir):
    checked = jobs.check_schema(inputs.order_events(spark, sf_dir), _ORDER)
    return checked.select("key", "offset", "reject_reason")


def j5_state_machine(spark, sf_dir):
    log = inputs.table(spark, sf_dir, "events").select(
        F.lit("events").alias("topic"), F.col("user_id").cast("string").alias("key"),
        F.col("event_id").alias("offset"), "event_type",
    )
    allowed = [
        ("signup", "view"), ("view", "view"), ("view", "click"),
        ("click", "purchase"), ("click", "view"), ("purchase", "view"),
    ]
    moves = jobs.transitions(log, "event_type", allowed)
    return moves.select("key", "offset", "from_state", "to_state", "allowed")


def j5_conversation_turns(spark, sf_dir):
    turns = inputs.conversation_events(spark, sf_dir)
    moves = jobs.transitions(
        turns, "role", [("system", "user"), ("user", "assistant"), ("assistant", "user")]
    )
    return moves.groupBy("from_state", "to_state", "allowed").agg(F.count("*").alias("n"))


def _register(function, sql):
    QUERIES[function.__name__] = function
    ORACLES[function.__name__] = sql


_register(j1_counter, f"""
WITH {EV}, p AS (
  SELECT *, lag(us) OVER w AS was_us, lag(tomb) OVER w AS was_tomb FROM ev
  WINDOW w AS (PARTITION BY key ORDER BY off)
), s AS (
  SELECT *, sum(CASE WHEN was_us IS NULL OR was_tomb OR us - was_us >= {4 * DAY * 1_000_000}
    THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY off) AS span FROM p
), c AS (
  SELECT key, span, count(*) FILTER (NOT tomb) AS n, max(us) AS last_us, bool_or(tomb) AS ended
  FROM s GROUP BY key, span)
SELECT key,
  CASE WHEN NOT arg_max(ended, span)
    AND epoch_us(TIMESTAMP '2024-01-31 00:00:00') - arg_max(last_us, span) < {4 * DAY * 1_000_000}
    THEN arg_max(n, span) END AS counter,
  count(*) FILTER (n > 0) AS starts, max(n) AS highest
FROM c GROUP BY key""")

# Walks each key's events one by one, carrying the end of the open window.
BURSTS = f"""{EV}, c AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY off) AS rn FROM ev
), w AS (
  SELECT key, off, us, rn, tomb, CASE WHEN tomb THEN NULL ELSE off END AS open_off,
    CASE WHEN tomb THEN NULL ELSE us END AS open_us,
    CASE WHEN tomb THEN NULL ELSE (us + {DAY * 1_000_000} + 500000) // 1000000 END AS close
  FROM c WHERE rn = 1
  UNION ALL
  SELECT c.key, c.off, c.us, c.rn, c.tomb,
    CASE WHEN c.tomb THEN NULL WHEN w.close > c.us // 1000000 THEN w.open_off ELSE c.off END,
    CASE WHEN c.tomb THEN NULL WHEN w.close > c.us // 1000000 THEN w.open_us ELSE c.us END,
    CASE WHEN c.tomb THEN NULL WHEN w.close > c.us // 1000000 THEN w.close
         ELSE (c.us + {DAY * 1_000_000} + 500000) // 1000000 END
  FROM w JOIN c ON c.key = w.key AND c.rn = w.rn + 1
)"""
_register(j2_burst_window, f"""
WITH RECURSIVE {BURSTS}
SELECT key, open_us, open_off AS open_offset, close AS close_second, count(*) - 1 AS held,
  least(count(*) - 1, 3) AS summarised, max(off) AS last_offset
FROM w WHERE NOT tomb GROUP BY key, open_us, open_off, close""")
_register(j2_burst_held, f"""
WITH RECURSIVE {BURSTS}
SELECT key, close AS close_second, off AS "offset",
  CAST(row_number() OVER (PARTITION BY key, open_off ORDER BY off DESC) AS INTEGER) AS from_back
FROM w WHERE NOT tomb AND off <> open_off QUALIFY from_back <= 3""")

_GOOD = f"""{ORDER_EVENTS}, good AS (
  SELECT a.* FROM oe a WHERE shape = 'right' AND NOT EXISTS (
    SELECT 1 FROM oe b WHERE b.key = a.key AND b.tomb AND b.off > a.off))"""
_register(j3_cart, f"""
WITH {_GOOD}, r AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY off DESC) AS back FROM good)
SELECT key, count(*) AS items, arg_max(total, off) AS last_total,
  CAST(min(off) FILTER (back <= 5) AS VARCHAR) AS oldest, CAST(max(off) AS VARCHAR) AS newest,
  least(count(*), 5) AS backlog FROM r GROUP BY key""")
_register(j3_cart_items, f"""
WITH {_GOOD} SELECT key, row_number() OVER (PARTITION BY key ORDER BY off) - 1 AS place,
  CAST(off AS VARCHAR) AS item FROM good""")
_register(j4_schema_check, f"""
WITH {ORDER_EVENTS} SELECT key, off AS "offset",
  CASE WHEN shape IN ('no_id', 'wrong_id') THEN 'order_id must be string'
       WHEN shape = 'wrong_total' THEN 'total must be integer' END AS reject_reason FROM oe""")
_register(j5_state_machine, """
WITH m AS (
  SELECT CAST(user_id AS VARCHAR) AS key, event_id,
    lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS from_state, event_type
  FROM events)
SELECT key, event_id AS "offset", from_state, event_type AS to_state,
  coalesce(from_state IS NULL OR (from_state, event_type) IN (
    ('signup', 'view'), ('view', 'view'), ('view', 'click'),
    ('click', 'purchase'), ('click', 'view'), ('purchase', 'view')), FALSE) AS allowed FROM m""")
_register(j5_conversation_turns, """
WITH m AS (
  SELECT lag(role) OVER (PARTITION BY conv_id ORDER BY turn) AS from_state, role AS to_state
  FROM conversations)
SELECT from_state, to_state,
  coalesce(from_state IS NULL OR (from_state, to_state) IN (
    ('system', 'user'), ('user', 'assistant'), ('assistant', 'user')), FALSE) AS allowed,
  count(*) AS n FROM m GROUP BY 1, 2, 3""")
