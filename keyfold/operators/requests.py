"""Requests: one outcome per asked subsystem, from the log of responses."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyfold.functions.payload import is_json
from keyfold.functions.times import Duration, duration_us
from keyfold.plans.joins import broadcast_if_small

# The texts of response errors.
TIMEOUT_TEXT = "no response arrived before the deadline"
FORMAT_TEXT = "the responder answered in another format"
MALFORMED_TEXT = "the response did not decode"

JSON_FORMAT = "json"

# Our own name for the header that marks an event as a request and carries its id.
REQUEST_HEADER = "request-id"


def subsystem_names(names: Sequence[str]) -> list[str]:
    """Check and order the subsystems of a request; repeats count once."""
    if isinstance(names, str):
        raise TypeError("subsystems: expected a list of names")
    checked = []
    for name in names:
        if not isinstance(name, str):
            raise TypeError("subsystems: names must be text")
        if not name.strip():
            raise ValueError("subsystems: a name must not be empty")
        if name not in checked:
            checked.append(name)
    if not checked:
        raise ValueError("subsystems: at least one is required")
    return checked


def request_header(request_id: Column) -> Column:
    """Headers that make an outgoing event, or excise record, a request."""
    return F.create_map(F.lit(REQUEST_HEADER), request_id.cast("string"))


def requested(
    events: DataFrame, request_id: Column, subsystems: Sequence[str], timeout: Duration
) -> DataFrame:
    """Request rows, one per event and subsystem, with the deadline in microseconds.

    Works alike for messages and excise records.
    """
    names = subsystem_names(subsystems)
    return events.select(
        request_id.alias("request_id"), "topic", "key",
        F.unix_micros("timestamp").alias("sent_us"),
        (F.unix_micros("timestamp") + F.lit(duration_us(timeout, "timeout"))).alias("deadline_us"),
        F.explode(F.array(*[F.lit(name) for name in names])).alias("subsystem"),
    )


def handler_responses(calls: DataFrame, group_id: str) -> DataFrame:
    """Responses from handler calls: the return value, or the text of its failure.

    ``calls`` has request_id, timestamp, offset, ``returned`` (JSON text) and
    ``error`` (text, null on success).
    """
    return calls.filter("request_id IS NOT NULL").select(
        "request_id", F.lit(group_id).alias("group_id"), "timestamp", "offset",
        F.lit(JSON_FORMAT).alias("content_type"), F.col("returned").alias("body"), "error",
    )


def first_responses(
    responses: DataFrame, groups: DataFrame, requests: DataFrame | None = None
) -> DataFrame:
    """The first response per request and subsystem, by time and then offset.

    ``groups`` maps group_id to subsystem; any group of a subsystem may answer. With
    ``requests`` (the rows of ``requested``) only answers between sending and deadline
    count: that join has the aggregate's keys, so it adds no further shuffle, and
    adaptive execution splits a request with very many answers. Without it the map task
    keeps one response per request and subsystem.
    """
    order = F.struct("timestamp", "offset")
    answer = F.struct(F.unix_micros("timestamp").alias("answered_us"), "content_type", "body", "error")
    known = responses.join(broadcast_if_small(groups), "group_id")
    if requests is not None:
        spans = requests.select("request_id", "subsystem", "sent_us", "deadline_us")
        at = F.unix_micros("timestamp")
        known = known.join(spans, ["request_id", "subsystem"]).filter(
            at.between(F.col("sent_us"), F.col("deadline_us"))
        )
    return (
        known.groupBy("request_id", "subsystem")
        .agg(F.min_by(answer, order).alias("answer"))
    )


def request_outcomes(requests: DataFrame, first: DataFrame) -> DataFrame:
    """One outcome per requested subsystem; none is ever missing.

    ``first`` comes from ``first_responses`` with these requests. Both sides hold one row
    per (request, subsystem), so the join cannot fan out. A response before the request
    or after the deadline counts as none. Columns: request_id, subsystem, status, value,
    error_kind, error_message.
    """
    joined = requests.join(first, ["request_id", "subsystem"], "left")
    in_time = F.coalesce(
        F.col("answer.answered_us").between(F.col("sent_us"), F.col("deadline_us")), F.lit(False)
    )
    return joined.select(
        "request_id", "subsystem", F.when(in_time, F.col("answer")).alias("answer")
    ).transform(outcome_columns)


def outcome_columns(answers: DataFrame) -> DataFrame:
    """Type each ``answer`` struct (null: none arrived) as success or failure."""
    body, error = F.col("answer.body"), F.col("answer.error")
    kind = (
        F.when(F.col("answer").isNull(), "timeout")
        .when(F.col("answer.content_type") != JSON_FORMAT, "format_mismatch")
        .when(error.isNotNull(), "handler_error")
        .when(body.isNull() | ~is_json(body), "malformed_response")
    )
    message = (
        F.when(F.col("error_kind") == "timeout", TIMEOUT_TEXT)
        .when(F.col("error_kind") == "format_mismatch", FORMAT_TEXT)
        .when(F.col("error_kind") == "handler_error", error)
        .when(F.col("error_kind") == "malformed_response", MALFORMED_TEXT)
    )
    return (
        answers.withColumn("error_kind", kind)
        .withColumn("error_message", message)
        .withColumn("status", F.when(F.col("error_kind").isNull(), "success").otherwise("failure"))
        .withColumn("value", F.when(F.col("error_kind").isNull(), body))
        .drop("answer")
    )


def stream_outcomes(
    requests: DataFrame, responses: DataFrame, timeout: Duration, lateness: Duration = 0
) -> DataFrame:
    """Pair a request stream with a response stream, one or more rows per pair.

    ``requests`` has request_id, subsystem and timestamp, ``responses`` request_id,
    subsystem, timestamp and answer columns. A left outer interval join: watermarks on both
    sides let Spark drop a request's state once its deadline has passed, and emit it
    then without an answer. Several answers in time give several rows; reduce them
    with ``first_of_pairs`` after the sink.
    """
    delay = f"{duration_us(lateness, 'lateness') // 1000} milliseconds"
    limit = F.lit(timedelta(microseconds=duration_us(timeout, "timeout")))
    asked = requests.withWatermark("timestamp", delay).alias("q")
    answers = responses.withWatermark("timestamp", delay).alias("a")
    same = (F.col("q.request_id") == F.col("a.request_id")) & (
        F.col("q.subsystem") == F.col("a.subsystem")
    )
    in_time = (F.col("a.timestamp") >= F.col("q.timestamp")) & (
        F.col("a.timestamp") <= F.col("q.timestamp") + limit
    )
    return asked.join(answers, same & in_time, "leftOuter").select(
        F.col("q.request_id"), F.col("q.subsystem"),
        F.col("a.timestamp").alias("answered"), F.col("a.offset").alias("answer_offset"),
        F.col("a.content_type"), F.col("a.body"), F.col("a.error"),
    )


def first_of_pairs(pairs: DataFrame) -> DataFrame:
    """Outcomes from the rows of ``stream_outcomes``: the first answer of each pair wins."""
    answer = F.when(
        F.col("answered").isNotNull(),
        F.struct(F.unix_micros("answered").alias("answered_us"), "content_type", "body", "error"),
    )
    order = F.struct("answered", "answer_offset")
    return (
        pairs.groupBy("request_id", "subsystem")
        .agg(F.min_by(answer, F.when(F.col("answered").isNotNull(), order)).alias("answer"))
        .transform(outcome_columns)
    )
