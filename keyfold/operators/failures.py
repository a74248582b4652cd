"""Failures: categories, routes per mode, backoff, and health reports.

Call tables have one row per handler call with ``topic, key, partition, timestamp``
and, by report, ``failed``, ``duration_us`` or ``category``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.functions.times import Duration, duration_seconds, duration_us, second_of
from keyfold.plans.chunked import rolling_sums

MODES = ("pipeline", "low-latency", "best-effort")

# Defaults of retry, deferral, monopolization and stall detection.
MAX_RETRIES = 3
RETRY_BASE_SECONDS, RETRY_CAP_SECONDS = 0.02, 300
DEFER_BASE_SECONDS, DEFER_CAP_SECONDS = 1, 86_400
FAILURE_THRESHOLD, FAILURE_WINDOW_SECONDS = 0.9, 300
MONOPOLY_THRESHOLD, MONOPOLY_WINDOW_SECONDS = 0.9, 300
STALL_SECONDS = 300
DEADLINE_SHARE = 0.8


def classify(error_type: Column, permanent_types: Sequence[str]) -> Column:
    """Category of an error by its type name; anything not named is transient."""
    return F.when(error_type.isNull(), F.lit(None).cast("string")).otherwise(
        F.when(error_type.isin(*permanent_types), "permanent").otherwise("transient")
    )


def route_calls(calls: DataFrame, mode: str, max_retries: int = MAX_RETRIES) -> DataFrame:
    """Add ``attempts`` and ``outcome`` to events, given how their handler fails.

    ``category`` is null for a handler that succeeds. ``failures`` is how many
    transient failures come before success. A permanent failure is never retried;
    pipeline retries until success; low-latency gives up after ``max_retries``
    retries and dead-letters; best-effort skips at the first failure.
    """
    if mode not in MODES:
        raise ValueError(f"mode: expected one of {MODES}, got {mode!r}")
    if max_retries < 0:
        raise ValueError("max_retries: must not be negative")
    failures = F.coalesce("failures", F.lit(0)).cast("long")
    permanent = F.col("category") == "permanent"
    fails = (F.col("category") == "transient") & (failures > 0)
    retries = {"pipeline": None, "low-latency": max_retries, "best-effort": 0}[mode]
    exhausted = F.lit(False) if retries is None else fails & (failures > F.lit(retries))
    lost = {"low-latency": "dead_letter", "best-effort": "skipped"}.get(mode, "ok")
    return calls.withColumns(
        {
            "attempts": F.when(permanent | F.col("category").isNull(), F.lit(1).cast("long"))
            .when(exhausted, F.lit((retries or 0) + 1).cast("long"))
            .otherwise(failures + 1),
            "outcome": F.when(permanent, "permanent").when(exhausted, lost).otherwise("ok"),
        }
    )


def dead_letters(routed: DataFrame, failure_topic: str) -> DataFrame:
    """Rows for the failure topic, which keep the original topic in ``source_topic``."""
    return (
        routed.filter("outcome = 'dead_letter'")
        .withColumn("source_topic", F.col("topic"))
        .withColumn("topic", F.lit(failure_topic))
    )


def backoff_us(
    attempt: Column,
    base: Duration = RETRY_BASE_SECONDS,
    cap: Duration = RETRY_CAP_SECONDS,
) -> Column:
    """Delay in microseconds before retry ``attempt`` (1, 2, ...): doubling, capped."""
    doubled = F.lit(float(duration_us(base, "base"))) * F.pow(F.lit(2.0), attempt - 1)
    return F.least(doubled, F.lit(float(duration_us(cap, "cap")))).cast("long")


def retry_schedule(
    routed: DataFrame, base: Duration = RETRY_BASE_SECONDS, cap: Duration = RETRY_CAP_SECONDS
) -> DataFrame:
    """One row per retry with its ``delay_us`` and the total ``wait_us`` up to it.

    Each event expands on its own; no shuffle.
    """
    retries = F.when(F.col("attempts") > 1, F.sequence(F.lit(1).cast("long"), F.col("attempts") - 1))
    return (
        routed.withColumn("retry", F.explode(retries))
        .withColumn("delay_us", backoff_us(F.col("retry"), base, cap))
        .withColumn("wait_us", _backoff_total_us(F.col("retry"), base, cap))
    )


def _backoff_total_us(retry: Column, base: Duration, cap: Duration) -> Column:
    # Doubling delays sum to base * (2**n - 1) until the cap; then each adds the cap.
    base_us, cap_us = duration_us(base, "base"), duration_us(cap, "cap")
    below = 0
    while base_us and base_us << below <= cap_us:
        below += 1
    doubling = F.least(retry, F.lit(below)).cast("double")
    capped = F.greatest(retry - F.lit(below), F.lit(0)).cast("double")
    total = F.lit(float(base_us)) * (F.pow(F.lit(2.0), doubling) - 1) + F.lit(float(cap_us)) * capped
    return total.cast("long")


def failure_rates(
    calls: DataFrame,
    window: Duration = FAILURE_WINDOW_SECONDS,
    threshold: float = FAILURE_THRESHOLD,
) -> DataFrame:
    """Per topic and second: calls and failures in the trailing window, and the gate.

    ``defer_enabled`` is off while the failure share is above the threshold.
    """
    rates = rolling_sums(
        calls, ["topic"], second_of(F.col("timestamp")), duration_seconds(window, "window"),
        {"calls": F.lit(1).cast("long"), "failures": F.col("failed").cast("long")},
    )
    return rates.withColumn(
        "defer_enabled", F.col("failures") <= F.lit(threshold) * F.col("calls")
    )


def hot_keys(
    calls: DataFrame,
    window: Duration = MONOPOLY_WINDOW_SECONDS,
    threshold: float = MONOPOLY_THRESHOLD,
) -> DataFrame:
    """Seconds at which a key's handler time exceeds its share of the trailing window."""
    seconds = duration_seconds(window, "window")
    busy = rolling_sums(
        calls, ["topic", "key"], second_of(F.col("timestamp")), seconds,
        {"busy_us": F.col("duration_us")},
    )
    return busy.filter(F.col("busy_us") > F.lit(int(threshold * seconds * 1_000_000)))


def failure_rates_stream(
    calls: DataFrame,
    window: Duration = FAILURE_WINDOW_SECONDS,
    slide: Duration = 60,
    threshold: float = FAILURE_THRESHOLD,
    lateness: Duration = 0,
) -> DataFrame:
    """The failure gate on a stream: one row per topic and sliding window."""
    return (
        _in_windows(calls, window, slide, lateness)
        .groupBy("topic", "window")
        .agg(
            F.count("*").alias("calls"), F.sum(F.col("failed").cast("long")).alias("failures")
        )
        .withColumn("defer_enabled", F.col("failures") <= F.lit(threshold) * F.col("calls"))
    )


def hot_keys_stream(
    calls: DataFrame,
    window: Duration = MONOPOLY_WINDOW_SECONDS,
    slide: Duration = 60,
    threshold: float = MONOPOLY_THRESHOLD,
    lateness: Duration = 0,
) -> DataFrame:
    """Keys over their share of handler time, per sliding window of a stream."""
    limit = int(threshold * duration_us(window, "window"))
    return (
        _in_windows(calls, window, slide, lateness)
        .groupBy("topic", "key", "window")
        .agg(F.sum("duration_us").alias("busy_us"))
        .filter(F.col("busy_us") > limit)
    )


def _in_windows(
    calls: DataFrame, window: Duration, slide: Duration, lateness: Duration
) -> DataFrame:
    texts = [f"{duration_us(d) // 1000} milliseconds" for d in (window, slide, lateness)]
    return calls.withWatermark("timestamp", texts[2]).withColumn(
        "window", F.window("timestamp", texts[0], texts[1])
    )


def deadline_us(timeout: Duration | None = None, stall_threshold: Duration = STALL_SECONDS) -> int:
    """The handler deadline: ``timeout``, or 80 % of the stall threshold."""
    if timeout is not None:
        return duration_us(timeout, "timeout")
    return int(duration_us(stall_threshold, "stall_threshold") * DEADLINE_SHARE)


def past_deadline(
    calls: DataFrame,
    timeout: Duration | None = None,
    stall_threshold: Duration = STALL_SECONDS,
) -> DataFrame:
    """Calls cancelled at the deadline, as transient failures with a reason."""
    limit = deadline_us(timeout, stall_threshold)
    return (
        calls.filter(F.col("duration_us") > limit)
        .withColumn("category", F.lit("transient"))
        .withColumn("reason", F.lit("timeout"))
        .withColumn("duration_us", F.lit(limit).cast("long"))
    )


def stalled_partitions(
    calls: DataFrame, as_of: datetime, stall_threshold: Duration = STALL_SECONDS
) -> DataFrame:
    """Per partition: the last progress and whether it stalled at ``as_of``."""
    oldest = as_of - timedelta(microseconds=duration_us(stall_threshold, "stall_threshold"))
    return (
        calls.filter(F.col("timestamp") <= F.lit(as_of))
        .groupBy("topic", "partition")
        .agg(F.max("timestamp").alias("last_progress"))
        .withColumn("stalled", F.col("last_progress") < F.lit(oldest))
    )


def readiness(assignments: DataFrame) -> DataFrame:
    """Whether a group has at least one assigned partition; ``partition`` may be null."""
    return assignments.groupBy("group_id").agg(
        F.countDistinct("topic", "partition").alias("partitions"),
        (F.count("partition") > 0).alias("ready"),
    )
