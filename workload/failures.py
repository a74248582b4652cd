"""Failure handling and health reports."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from keyfold.operators import failures
from workload import inputs
from workload.inputs import AS_OF, CALLS, DAY, HOUR

QUERIES, ORACLES = {}, {}


def _calls(spark, sf_dir):
    calls = inputs.handler_calls(spark, sf_dir)
    return calls.withColumn("category", failures.classify(F.col("error_type"), ["ValueError"]))


def e1_classify(spark, sf_dir):
    return _calls(spark, sf_dir).select("offset", "category")


def e4_pipeline_retry(spark, sf_dir):
    routed = failures.route_calls(_calls(spark, sf_dir), "pipeline")
    waits = failures.retry_schedule(
        routed, failures.DEFER_BASE_SECONDS, failures.DEFER_CAP_SECONDS
    )
    return waits.select("offset", "retry", "delay_us", "wait_us")


def e5_retry_route(spark, sf_dir):
    routed = failures.route_calls(_calls(spark, sf_dir), "low-latency")
    return routed.select("offset", "attempts", "outcome")


def e6_best_effort(spark, sf_dir):
    routed = failures.route_calls(_calls(spark, sf_dir), "best-effort")
    return routed.groupBy("key", "outcome").agg(F.count("*").alias("n"))


def s7_dead_letter_split(spark, sf_dir):
    routed = failures.route_calls(_calls(spark, sf_dir), "low-latency", max_retries=2)
    lost = failures.dead_letters(routed, "failed-events")
    return lost.select("topic", "source_topic", "key", "offset", "attempts")


def e8_backoff(spark, sf_dir):
    attempts = _calls(spark, sf_dir).select(
        "offset", (F.col("offset") % 24 + 1).alias("attempt")
    )
    return attempts.withColumn("delay_us", failures.backoff_us(F.col("attempt")))


def e9_failure_rate(spark, sf_dir):
    rates = failures.failure_rates(_calls(spark, sf_dir), timedelta(hours=6), threshold=0.25)
    return rates.select("topic", "second", "calls", "failures", "defer_enabled")


def e10_hot_keys(spark, sf_dir):
    hot = failures.hot_keys(_calls(spark, sf_dir), timedelta(days=1), threshold=0.002)
    return hot.select("key", "second", "busy_us")


def e11_deadline(spark, sf_dir):
    cut = failures.past_deadline(_calls(spark, sf_dir), stall_threshold=30)
    return cut.select("offset", "category", "reason", "duration_us")


def e12_stall(spark, sf_dir):
    calls = _calls(spark, sf_dir)
    # Partition 2 runs two days behind the others.
    behind = F.make_dt_interval(days=F.when(F.col("partition") == 2, 2).otherwise(0))
    calls = calls.withColumn("timestamp", F.col("timestamp") - behind)
    report = failures.stalled_partitions(calls, AS_OF, timedelta(hours=6))
    return report.select(
        "topic", "partition", F.unix_micros("last_progress").alias("last_us"), "stalled"
    )


def e12_ready(spark, sf_dir):
    assigned = _calls(spark, sf_dir).select(
        F.concat(F.lit("group-"), F.col("key").cast("long") % 6).alias("group_id"), "topic",
        F.when(F.col("key").cast("long") % 6 < 5, F.col("partition")).alias("partition"),
    )
    return failures.readiness(assigned)


def _register(function, sql):
    QUERIES[function.__name__] = function
    ORACLES[function.__name__] = f"WITH {CALLS} {sql}"


_register(e1_classify, 'SELECT off AS "offset", category FROM calls')
_register(e4_pipeline_retry, """
, r AS (SELECT off, unnest(generate_series(1, failures)) AS retry FROM calls
        WHERE category = 'transient')
SELECT off AS "offset", retry, CAST(least(1000000 * pow(2, retry - 1), 86400000000) AS BIGINT) AS delay_us,
  CAST(sum(least(1000000 * pow(2, retry - 1), 86400000000))
    OVER (PARTITION BY off ORDER BY retry) AS BIGINT) AS wait_us FROM r""")
_register(e5_retry_route, """
SELECT off AS "offset", CAST(CASE WHEN category = 'transient' THEN least(failures, 3) + 1 ELSE 1 END AS BIGINT) AS attempts,
  CASE WHEN category = 'permanent' THEN 'permanent'
       WHEN category = 'transient' AND failures > 3 THEN 'dead_letter' ELSE 'ok' END AS outcome
FROM calls""")
_register(e6_best_effort, """
SELECT key, CASE WHEN category = 'permanent' THEN 'permanent'
  WHEN category = 'transient' AND failures > 0 THEN 'skipped' ELSE 'ok' END AS outcome,
  count(*) AS n FROM calls GROUP BY 1, 2""")
_register(s7_dead_letter_split, """
SELECT 'failed-events' AS topic, topic AS source_topic, key, off AS "offset",
  CAST(3 AS BIGINT) AS attempts
FROM calls WHERE category = 'transient' AND failures > 2""")
_register(e8_backoff, """
SELECT off AS "offset", off % 24 + 1 AS attempt,
  CAST(least(20000 * pow(2, off % 24), 300000000) AS BIGINT) AS delay_us FROM calls""")
_register(e9_failure_rate, f"""
, s AS (SELECT topic, us // 1000000 AS second, count(*) AS n, count(*) FILTER (failed) AS f
        FROM calls GROUP BY 1, 2),
r AS (SELECT topic, second,
  CAST(sum(n) OVER w AS BIGINT) AS calls, CAST(sum(f) OVER w AS BIGINT) AS failures FROM s
  WINDOW w AS (PARTITION BY topic ORDER BY second RANGE BETWEEN {6 * HOUR - 1} PRECEDING AND CURRENT ROW))
SELECT topic, second, calls, failures, failures <= 0.25 * calls AS defer_enabled FROM r""")
_register(e10_hot_keys, f"""
, s AS (SELECT key, us // 1000000 AS second, sum(duration_us) AS d FROM calls GROUP BY 1, 2),
r AS (SELECT key, second, CAST(sum(d) OVER (PARTITION BY key ORDER BY second
  RANGE BETWEEN {DAY - 1} PRECEDING AND CURRENT ROW) AS BIGINT) AS busy_us FROM s)
SELECT key, second, busy_us FROM r WHERE busy_us > 172800000""")
_register(e11_deadline, """
SELECT off AS "offset", 'transient' AS category, 'timeout' AS reason,
  CAST(24000000 AS BIGINT) AS duration_us FROM calls WHERE duration_us > 24000000""")
_register(e12_stall, """
SELECT topic, part AS partition, max(late_us) AS last_us,
  max(late_us) < epoch_us(TIMESTAMP '2024-01-30 18:00:00') AS stalled
FROM (SELECT topic, part, us - CASE WHEN part = 2 THEN 2 ELSE 0 END * 86400000000 AS late_us FROM calls)
WHERE late_us <= epoch_us(TIMESTAMP '2024-01-31 00:00:00') GROUP BY topic, part""")
_register(e12_ready, """
, a AS (SELECT 'group-' || CAST(key AS BIGINT) % 6 AS group_id,
    CASE WHEN CAST(key AS BIGINT) % 6 < 5 THEN part END AS part FROM calls)
SELECT group_id, count(DISTINCT part) AS partitions, count(part) > 0 AS ready FROM a GROUP BY 1""")
