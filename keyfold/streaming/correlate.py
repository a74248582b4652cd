"""One outcome per request on streams: requests and answers meet in state, per request.

Requests and answers are one stream, keyed by request_id. Each call from a worker to Spark's
state costs far more than the matching, so a request's pairs share one state value and one
timer: a micro-batch reads and writes them once. Of each pair it holds the request's span and
its best answer so far. The outcome leaves by the timer, once the watermark has passed the
answer's time, when no earlier one can come, or the deadline. So it is the first answer by
event time, however the rows were split into micro-batches.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from keyfold.functions.times import Duration, duration_us
from keyfold.operators.requests import outcome_columns
from keyfold.session import configure

PAIR = ["request_id", "subsystem"]
_FIELDS = ("offset", "content_type", "body", "error")
_ANSWER = "content_type string, body string, error string"
_OUTCOME = f"request_id string, subsystem string, answered_us long, {_ANSWER}"
_OutcomeRow = Row("request_id", "subsystem", "answered_us", "content_type", "body", "error")

# Answers without a request that a request's value holds; the others are cells of their own.
HELD_ANSWERS = 32

_encode = json.JSONEncoder(ensure_ascii=False).encode


def _place(answer: list) -> tuple:
    """By time and then offset, nulls first, as the table operators order answers."""
    return answer[0], answer[1] is not None, answer[1] or 0


class _Pairs:
    """The pairs of the request at hand.

    ``spans`` has [sent, deadline, first answer or None] by subsystem, ``waiting`` the answers
    of subsystems that were not asked yet. An answer is [us, offset, content_type, body, error].
    ``spilled`` is the earliest time of the answers in cells of their own, ``wake`` the timer
    in milliseconds.
    """

    def __init__(self, text: str | None) -> None:
        self.spans, self.waiting, self.spilled, self.wake = json.loads(text) if text else ({}, {}, None, None)

    def text(self) -> str:
        return _encode([self.spans, self.waiting, self.spilled, self.wake])

    def ask(self, subsystem: str, sent: int, timeout_us: int) -> None:
        """A request that is delivered again keeps its first sending."""
        span = self.spans.get(subsystem)
        if span is None or sent < span[0]:
            best = None if span is None else span[2]
            if best is not None and best[0] > sent + timeout_us:
                best = None
            self.spans[subsystem] = [sent, sent + timeout_us, best]

    def answer(self, subsystem: str, answer: list) -> None:
        """Of answers in time only the first is kept: none behind it wins by an earlier sending."""
        span = self.spans.get(subsystem)
        if span is None or answer[0] < span[0]:
            self.waiting.setdefault(subsystem, []).append(answer)
        elif answer[0] <= span[1] and (span[2] is None or _place(answer) < _place(span[2])):
            span[2] = answer

    def settle(self) -> None:
        """See which answers that waited are in time for the requests that came."""
        for subsystem in self.spans.keys() & self.waiting.keys():
            for answer in self.waiting.pop(subsystem):
                if answer[0] >= self.spans[subsystem][0]:
                    self.answer(subsystem, answer)

    def ended(self, now_us: int) -> Iterator[tuple[str, list | None]]:
        """Subsystems whose outcome is certain by now, with their answer."""
        for subsystem, (_, deadline, best) in list(self.spans.items()):
            if (deadline if best is None else best[0]) <= now_us:
                del self.spans[subsystem]
                yield subsystem, best

    def forget(self, now_us: int) -> None:
        """Drop answers whose request can no longer come."""
        left = {name: [a for a in answers if a[0] > now_us] for name, answers in self.waiting.items()}
        self.waiting = {name: answers for name, answers in left.items() if answers}

    def next_wake(self) -> int | None:
        """When the watermark makes an outcome certain, or an answer useless, next."""
        times = [deadline if best is None else best[0] for _, deadline, best in self.spans.values()]
        times += [answer[0] for answers in self.waiting.values() for answer in answers]
        if self.spilled is not None:
            times.append(self.spilled)
        return -(-min(times) // 1000) if times else None


class _Correlator(StatefulProcessor):
    """Holds a request's pairs until their outcomes are certain; then nothing of them is left."""

    def __init__(self, timeout_us: int) -> None:
        self._timeout_us = timeout_us

    def init(self, handle: Any) -> None:
        self._spark = handle
        self._span = handle.getValueState("span", "pairs string")
        self._answers = handle.getMapState("answers", "subsystem string, us long, offset long", _ANSWER)

    def close(self) -> None:
        pass

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        before = self._load()
        pairs = _Pairs(before)
        for *_, text in rows:
            row = json.loads(text)
            if row["asked"]:
                pairs.ask(row["subsystem"], row["us"], self._timeout_us)
            else:
                pairs.answer(row["subsystem"], [row["us"], *map(row.get, _FIELDS)])
        if pairs.spilled is not None:
            self._take_cells(pairs, lambda subsystem, us: subsystem in pairs.spans)
        pairs.settle()
        self._save(pairs, before)
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        before = self._load()
        pairs = _Pairs(before)
        # all that the watermark has passed, not only what this timer was set for
        now_us = timerValues.getCurrentWatermarkInMs() * 1000
        for subsystem, best in pairs.ended(now_us):
            answered, _, *content = best or [None] * 5
            yield _OutcomeRow(*key, subsystem, answered, *content)
        pairs.forget(now_us)
        if pairs.spilled is not None and pairs.spilled <= now_us:
            self._take_cells(pairs, lambda subsystem, us: us <= now_us)
        pairs.wake = None  # Spark deletes a timer that has fired
        self._save(pairs, before)

    def _load(self) -> str | None:
        found = self._span.get()
        return None if found is None else found[0]

    def _save(self, pairs: _Pairs, before: str | None) -> None:
        """Write what is left, and keep one timer for it."""
        self._spill(pairs)
        wake = pairs.next_wake()
        if wake != pairs.wake:
            if pairs.wake is not None:
                self._spark.deleteTimer(pairs.wake)
            if wake is not None:
                self._spark.registerTimer(wake)
            pairs.wake = wake
        if wake is None:
            if before is not None:
                self._span.clear()
            return
        text = pairs.text()
        if text != before:
            self._span.update((text,))

    # Answers without a request, beyond those that the value holds

    def _spill(self, pairs: _Pairs) -> None:
        room = HELD_ANSWERS
        for subsystem, answers in list(pairs.waiting.items()):
            for us, offset, *content in answers[room:]:
                self._answers.updateValue((subsystem, us, offset), tuple(content))
                pairs.spilled = us if pairs.spilled is None else min(us, pairs.spilled)
            pairs.waiting[subsystem] = answers[:room]
            room -= len(pairs.waiting[subsystem])
            if not pairs.waiting[subsystem]:
                del pairs.waiting[subsystem]

    def _take_cells(self, pairs: _Pairs, taken: Any) -> None:
        """Remove the cells that are taken; those of a subsystem that was asked are answers to it."""
        places, pairs.spilled = [], None
        for (subsystem, us, offset), content in self._answers.iterator():
            if not taken(subsystem, us):
                pairs.spilled = us if pairs.spilled is None else min(us, pairs.spilled)
                continue
            places.append((subsystem, us, offset))
            if subsystem in pairs.spans and us >= pairs.spans[subsystem][0]:
                pairs.answer(subsystem, [us, offset, *content])
        for place in places:
            self._answers.removeKey(place)


def correlate(
    requests: DataFrame, responses: DataFrame, *, timeout: Duration, lateness: Duration
) -> DataFrame:
    """One outcome per (request, subsystem) of two streams, or of two tables' streams.

    ``requests`` has request_id, subsystem and timestamp, ``responses`` these and offset,
    content_type, body and error. Columns of the result: request_id, subsystem, status,
    value, error_kind and error_message, as ``operators.requests.request_outcomes`` gives.

    The first answer between sending and deadline wins, by time and then offset. Answers
    that come before their request in the stream wait for it as long as it may still come;
    answers to nothing are dropped. A request delivered twice is one request. Rows with a
    null id or subsystem make no pair and are left out. Streams without rows give none.

    ``lateness`` is how far rows of either stream may lie behind its newest; the slower
    stream sets the pace. Rows later than that are dropped by Spark, so run the query
    with ``LateRowGuard``. A pair's state is a span and an answer, and goes with its outcome;
    a request's pairs are kept together, so it is to have no more subsystems than a row can hold.
    """
    if not (requests.isStreaming and responses.isStreaming):
        raise ValueError("correlate: for tables use operators.requests.request_outcomes")
    configure(requests.sparkSession)
    delay = f"{duration_us(lateness, 'lateness') // 1000} milliseconds"

    def rows(side: DataFrame, asked: bool) -> DataFrame:
        answer = [] if asked else [F.col("offset").cast("long"), *[F.col(c).cast("string") for c in _FIELDS[1:]]]
        subsystem = F.col("subsystem").cast("string")
        # one text, as a worker takes a row apart column by column
        content = F.struct(
            subsystem.alias("subsystem"), F.unix_micros("timestamp").alias("us"),
            F.lit(asked).alias("asked"), *[c.alias(n) for c, n in zip(answer, _FIELDS)],
        )
        known = "request_id is not null and subsystem is not null and timestamp is not null"
        return side.withWatermark("timestamp", delay).filter(known).select(
            F.col("request_id").cast("string").alias("request_id"), "timestamp",
            F.to_json(content).alias("content"),
        )

    pairs = rows(requests, True).unionByName(rows(responses, False)).groupBy("request_id")
    found = pairs.transformWithState(
        _Correlator(duration_us(timeout, "timeout")), _OUTCOME, "Append", "EventTime"
    )
    answer = F.when(
        F.col("answered_us").isNotNull(),
        F.struct("answered_us", "content_type", "body", "error"),
    )
    return found.select(*PAIR, answer.alias("answer")).transform(outcome_columns)
