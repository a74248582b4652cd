"""The keyed processor on the given tables, checked against the table operators."""

from __future__ import annotations

import time
import uuid
from datetime import timedelta

from pyspark.sql import functions as F

from keyfold.definitions import deque, message_deque, value
from keyfold.errors import PermanentError
from keyfold.session import shared_dir
from keyfold.streaming import (
    EventHandler, call_rows, check_no_late_rows, output_rows, process_keyed,
)
from workload import inputs, jobs
from workload.inputs import EV

QUERIES, ORACLES = {}, {}

LENGTH = timedelta(days=1)
# A burst runs for LENGTH from its first event: the tally, and the last events after the first.
TALLY = value("tally")
LATEST = message_deque("latest", capacity=3)
QUEUE = deque("queue")
# Counts tries across failed attempts, so it must not be part of their transaction.
TRIES = value("tries", read_uncommitted=True)


class BurstHandler(EventHandler):
    """Tallies a burst of a key's events; its end, a timer, reports and forgets it."""

    def on_message(self, context, message):
        tally = context.state(TALLY)
        burst = tally.get()
        if burst:
            burst |= {"held": burst["held"] + 1, "last_offset": message.offset}
            context.state(LATEST).append(message)
        else:
            burst = {"open_offset": message.offset, "held": 0, "last_offset": message.offset}
            context.clear_and_schedule(context.now + LENGTH)
        tally.set(burst)

    def on_timer(self, context, timer):
        ended = {
            "close_second": int(timer.time.timestamp()),
            "summarised": context.state(LATEST).size(),
        }
        context.emit(context.state(TALLY).get() | ended)
        self._forget(context)

    def on_excise(self, context, message):
        # A burst that excision cuts short leaves no report.
        self._forget(context)
        context.clear_scheduled()

    def _forget(self, context):
        for collection in (TALLY, LATEST):
            context.state(collection).clear()


def _summaries(outputs):
    summary = F.from_json(
        "value",
        "open_offset long, held long, last_offset long, close_second long, summarised long",
    )
    return outputs.select("key", summary.alias("s")).select("key", "s.*")


def b_process_keyed_batch(spark, sf_dir):
    events = inputs.events(spark, sf_dir).drop("headers")
    return _summaries(output_rows(process_keyed(events, BurstHandler(), [TALLY, LATEST])))


def b_process_keyed_stream(spark, sf_dir):
    """The same handler over a file stream, run until all input is processed."""
    source = inputs.table(spark, sf_dir, "events").schema
    raw = (
        spark.readStream.schema(source).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )
    events = inputs.event_log(raw).drop("headers")
    rows = process_keyed(events, BurstHandler(), [TALLY, LATEST])
    folder = f"{shared_dir(spark)}/burst-{uuid.uuid4().hex}"
    query = (
        output_rows(rows).writeStream.format("parquet").outputMode("append")
        .option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/checkpoint")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    check_no_late_rows(query)
    return _summaries(spark.read.parquet(f"{folder}/out"))


class QueueHandler(EventHandler):
    """Pushes and pops a queue at both ends; every pop is an output."""

    def on_message(self, context, message):
        queue = context.state(QUEUE)
        kind = message.payload.get("type")
        if kind in ("purchase", "signup"):
            item = queue.popleft() if kind == "purchase" else queue.pop()
            context.emit({"item": item, "left": queue.size()})
        elif kind == "error":
            queue.appendleft(message.offset)
        else:
            queue.append(message.offset)

    def on_excise(self, context, message):
        context.state(QUEUE).clear()

    def on_timer(self, context, timer):
        pass


def d3_queue_pops(spark, sf_dir):
    events = inputs.events(spark, sf_dir).drop("headers")
    popped = output_rows(process_keyed(events, QueueHandler(), [QUEUE]))
    body = F.from_json("value", "item long, left long")
    return popped.select("key", "offset", body.alias("b")).select("key", "offset", "b.*")


class FailingHandler(EventHandler):
    """Fails some events for good and some for a number of tries."""

    def on_message(self, context, message):
        if message.payload.get("type") != "error":
            return
        if message.offset % 2:
            raise PermanentError("cannot be handled")
        tries = context.state(TRIES)
        count = tries.get() or 0
        if count < message.offset % 6:
            tries.set(count + 1)
            raise TimeoutError(f"failure {count + 1}")
        tries.clear()

    def on_excise(self, context, message):
        pass

    def on_timer(self, context, timer):
        pass


class SlowHandler(EventHandler):
    """A plain handler that takes far too long over some events."""

    def on_message(self, context, message):
        if message.offset % 499 == 0:
            time.sleep(60)

    def on_excise(self, context, message):
        pass

    def on_timer(self, context, timer):
        pass


def e11_deadline_calls(spark, sf_dir):
    """Calls cut off at their deadline, and all others, by how they ended."""
    events = inputs.events(spark, sf_dir).drop("headers")
    rows = process_keyed(events, SlowHandler(), mode="best-effort", timeout=0.25, telemetry=True)
    timed_out = F.coalesce(F.col("error").startswith("timeout"), F.lit(False)).alias("timed_out")
    return call_rows(rows).groupBy("call", "outcome", "category", timed_out).agg(
        F.count("*").alias("n")
    )


def e5_low_latency_calls(spark, sf_dir):
    events = inputs.events(spark, sf_dir).drop("headers")
    rows = process_keyed(
        events, FailingHandler(), [TRIES], mode="low-latency", max_retries=1, telemetry=True
    )
    ended = call_rows(rows).filter("outcome != 'retry'")
    return ended.groupBy("call", "attempt", "outcome", "category").agg(F.count("*").alias("n"))


QUERIES["d3_queue_pops"] = d3_queue_pops
QUERIES["e5_low_latency_calls"] = e5_low_latency_calls
QUERIES["e11_deadline_calls"] = e11_deadline_calls
QUERIES["b_process_keyed_batch"] = b_process_keyed_batch
QUERIES["b_process_keyed_stream"] = b_process_keyed_stream
# Windows whose key was excised before they closed send no summary.
_CLOSED = f"""
WITH RECURSIVE {jobs.BURSTS}
SELECT key, open_off AS open_offset, close AS close_second, count(*) - 1 AS held,
  least(count(*) - 1, 3) AS summarised, max(off) AS last_offset
FROM w WHERE NOT tomb AND NOT EXISTS (
  SELECT 1 FROM ev t WHERE t.key = w.key AND t.tomb AND t.off > w.open_off
    AND t.us // 1000000 < w.close)
GROUP BY key, open_off, close"""
ORACLES["b_process_keyed_batch"] = _CLOSED
# A stream closes windows up to its watermark: the newest event, in milliseconds.
ORACLES["b_process_keyed_stream"] = (
    _CLOSED + " HAVING close * 1000 <= (SELECT max(us) // 1000 FROM ev)"
)

# Carries each key's queue as a list from event to event.
ORACLES["d3_queue_pops"] = f"""
WITH RECURSIVE {EV}, c AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY off) AS rn FROM ev
), w AS (
  SELECT key, CAST(0 AS BIGINT) AS off, CAST(0 AS BIGINT) AS rn, FALSE AS pops,
    CAST(NULL AS BIGINT) AS item, CAST([] AS BIGINT[]) AS q FROM (SELECT DISTINCT key FROM ev)
  UNION ALL
  SELECT c.key, c.off, c.rn, coalesce(c.etype IN ('purchase', 'signup'), FALSE),
    CASE WHEN c.etype = 'purchase' THEN w.q[1] WHEN c.etype = 'signup' THEN w.q[-1] END,
    CASE WHEN c.tomb THEN CAST([] AS BIGINT[])
         WHEN c.etype = 'purchase' THEN w.q[2:]
         WHEN c.etype = 'signup' THEN w.q[:-2]
         WHEN c.etype = 'error' THEN list_prepend(c.off, w.q)
         ELSE list_append(w.q, c.off) END
  FROM w JOIN c ON c.key = w.key AND c.rn = w.rn + 1
)
SELECT key, off AS "offset", item, CAST(len(q) AS BIGINT) AS "left" FROM w WHERE pops"""
ORACLES["e11_deadline_calls"] = f"""
WITH {EV} SELECT CASE WHEN tomb THEN 'on_excise' ELSE 'on_message' END AS call,
  CASE WHEN NOT tomb AND off % 499 = 0 THEN 'skipped' ELSE 'ok' END AS outcome,
  CASE WHEN NOT tomb AND off % 499 = 0 THEN 'transient' END AS category,
  NOT tomb AND off % 499 = 0 AS timed_out, count(*) AS n FROM ev GROUP BY 1, 2, 3, 4"""
# A failed event's tries stay counted for the key's next one.
ORACLES["e5_low_latency_calls"] = f"""
WITH RECURSIVE {EV}, c AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY off) AS rn FROM ev
), w AS (
  SELECT key, CAST(0 AS BIGINT) AS rn, CAST(0 AS BIGINT) AS tries, FALSE AS tomb,
    CAST(0 AS INTEGER) AS attempt, '' AS outcome, CAST(NULL AS VARCHAR) AS category
  FROM (SELECT DISTINCT key FROM ev)
  UNION ALL
  SELECT c.key, c.rn,
    CASE WHEN c.etype IS DISTINCT FROM 'error' OR c.off % 2 = 1 THEN w.tries
         WHEN w.tries + 1 < c.off % 6 THEN w.tries + 2 ELSE 0 END,
    c.tomb,
    CASE WHEN c.etype IS DISTINCT FROM 'error' OR c.off % 2 = 1 THEN 1
         WHEN w.tries < c.off % 6 THEN 2 ELSE 1 END,
    CASE WHEN c.etype IS DISTINCT FROM 'error' THEN 'ok' WHEN c.off % 2 = 1 THEN 'permanent'
         WHEN w.tries + 1 < c.off % 6 THEN 'dead_letter' ELSE 'ok' END,
    CASE WHEN c.etype IS DISTINCT FROM 'error' THEN NULL WHEN c.off % 2 = 1 THEN 'permanent'
         WHEN w.tries + 1 < c.off % 6 THEN 'transient' END
  FROM w JOIN c ON c.key = w.key AND c.rn = w.rn + 1
)
SELECT CASE WHEN tomb THEN 'on_excise' ELSE 'on_message' END AS call, attempt, outcome, category,
  count(*) AS n FROM w WHERE rn > 0 GROUP BY 1, 2, 3, 4"""
