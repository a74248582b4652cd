"""The stateful processor that runs a handler for one key at a time.

A key's clock is the latest timestamp it has seen. Timers due at or before the next
row's timestamp fire first, in time order, and win a tie. So a batch run and any
split into micro-batches give the same calls; a key that stays idle is woken by the
watermark.
"""

from __future__ import annotations

import asyncio
import heapq
import inspect
import json
import signal
import threading
import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor

from keyfold.definitions import Collection
from keyfold.errors import PermanentError, category
from keyfold.functions.times import HALF_SECOND_US, SECOND_US
from keyfold.operators.requests import REQUEST_HEADER
from keyfold.streaming.handles import (
    AsyncView, Attempt, Handle, KeyCells, SparkCells, bind, encode_json, final_state,
)
from keyfold.streaming.messages import Timer, deliver, from_us, nearest_second

OUTPUT_SCHEMA = (
    "kind string, topic string, key string, call string, partition int, offset long, "
    "time timestamp, attempt int, outcome string, category string, name string, cell string, "
    "size long, value string, error string, started timestamp, ended timestamp"
)
_OutputRow = Row(*[part.split()[0] for part in OUTPUT_SCHEMA.split(", ")])

# Spark timers have millisecond precision and handlers' timers whole seconds, so the
# last digits tell the timers of handlers, of retries and of expiry apart.
_RETRY_MS, _PURGE_MS, _RELEASE_MS = 1, 2, 3

# How often expired cells and ids are looked for, at most.
_PURGE_SECONDS = 3600

_KEY_SCHEMA = "clock long, parked_from long, parked_to long, failures int"


@contextmanager
def watchdog(seconds: float | None) -> Iterator[None]:
    """Interrupt what runs in the main thread with ``TimeoutError`` once the time is up.

    A worker runs handlers in its main thread. Elsewhere, and where a call does not let
    itself be interrupted, the call is found to have been too long once it returns.
    """
    if seconds is None:
        yield
        return

    def over(*_: Any) -> None:
        raise TimeoutError(f"timeout: the call took more than {seconds} s")

    interrupts = threading.current_thread() is threading.main_thread()
    began = time.monotonic()
    if interrupts:
        previous = signal.signal(signal.SIGALRM, over)
        signal.setitimer(signal.ITIMER_REAL, seconds)
    try:
        yield
    finally:
        if interrupts:
            signal.setitimer(signal.ITIMER_REAL, 0)
            signal.signal(signal.SIGALRM, previous)
    if time.monotonic() - began > seconds:
        over()


class Context:
    """What a handler may do for the current key during one call."""

    def __init__(self, run: KeyRun, attempt: Attempt) -> None:
        self._run, self._attempt = run, attempt
        self._handles: dict[str, Handle] = {}
        self._emitted: list[str] = []

    @property
    def key(self) -> str:
        return self._run.key

    @property
    def now(self) -> datetime:
        """The key's clock: event time, the same on every replay."""
        return from_us(self._attempt.now_us)

    def state(self, definition: Collection) -> Handle:
        """The key's collection; the same handle for the whole call."""
        found = bind(self._run.cells, definition, self._attempt)
        return self._handles.setdefault(definition.name, found)

    def emit(self, item: Any) -> None:
        """An output row; it leaves only if the call succeeds."""
        self._attempt.check()
        self._emitted.append(encode_json(item, PermanentError))

    # Timers are not part of the state transaction: a failed call keeps them.

    def schedule(self, moment: datetime) -> None:
        self._attempt.check()
        self._run.add_timer(nearest_second(moment))

    def unschedule(self, moment: datetime) -> None:
        self._attempt.check()
        self._run.timers.discard(nearest_second(moment))

    def clear_scheduled(self) -> None:
        self._attempt.check()
        self._run.timers.clear()

    def clear_and_schedule(self, moment: datetime) -> None:
        self.clear_scheduled()
        self.schedule(moment)

    def scheduled(self) -> list[datetime]:
        self._attempt.check()
        return [from_us(second * SECOND_US) for second in sorted(self._run.timers)]

    def finish(self) -> list[str]:
        for handle in self._handles.values():
            handle.commit()
        return self._emitted


class KeyRun:
    """The key at hand: its cells, timers, clock and parked calls."""

    def __init__(self, topic: str, key: str, cells: dict[str, KeyCells]) -> None:
        self.topic, self.key, self.cells = topic, key, cells
        self.timers: set[int] = set()
        self.clock = 0
        self.parked_from = self.parked_to = self.failures = 0
        self.retry_second: int | None = None
        self.saved_timers: set[int] = set()
        self.ids_expire = 0
        self._queue: list[int] = []

    def add_timer(self, second: int) -> None:
        if second not in self.timers:
            self.timers.add(second)
            heapq.heappush(self._queue, second)

    def next_timer(self) -> int | None:
        """The earliest timer; seconds no longer in ``timers`` leave the queue here."""
        while self._queue and self._queue[0] not in self.timers:
            heapq.heappop(self._queue)
        return self._queue[0] if self._queue else None

    @property
    def has_parked(self) -> bool:
        return self.parked_from < self.parked_to


class KeyedProcessor(StatefulProcessor):
    """Runs the handler on the rows and timers of each key."""

    def __init__(
        self,
        handler: Any,
        collections: Sequence[Collection],
        *,
        mode: str,
        max_retries: int,
        backoff_seconds: tuple[int, int],
        max_attempts: int | None,
        end_attempts: int,
        ids: tuple[int, str] | None,
        timeout_seconds: float | None,
        streaming: bool,
        order: str,
        with_state: bool,
        telemetry: bool,
    ) -> None:
        self._handler, self._collections = handler, list(collections)
        self._mode, self._max_retries = mode, max_retries
        self._backoff, self._max_attempts = backoff_seconds, max_attempts
        self._end_attempts, self._ids = end_attempts, ids
        self._timeout, self._streaming = timeout_seconds, streaming
        self._reorder, self._check_order = order == "wait", order in ("fail", "wait")
        self._with_state, self._telemetry = with_state, telemetry

    # Spark's entry points

    def init(self, handle: Any) -> None:
        self._spark = handle
        self._stores = {c.name: SparkCells(handle, c) for c in self._collections}
        self._key_state = handle.getValueState("engine-key", _KEY_SCHEMA)
        self._parked = handle.getMapState("engine-parked", "n long", "call string")
        if self._ids is not None:
            self._seen = handle.getMapState(
                "engine-ids", "id string", "version string, expires long"
            )
        if self._check_order:
            self._places = handle.getMapState("engine-places", "partition int", "offset long")
        if self._reorder:
            self._waiting = handle.getMapState("engine-waiting", "partition int, offset long", "row string")
        self._loop: asyncio.AbstractEventLoop | None = None
        methods = {n: getattr(self._handler, n) for n in ("on_message", "on_excise", "on_timer")}
        self._methods = {n: (m, inspect.iscoroutinefunction(m)) for n, m in methods.items()}

    def close(self) -> None:
        if self._loop is not None:
            self._loop.close()

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        run = self._load(key)
        if self._reorder:
            self._hold(rows)
            self._save(run)
            return
        if self._streaming:
            # Spark hands a micro-batch's rows of a key in no order. Their number is
            # bounded by the trigger's limit on files or offsets.
            rows = iter(sorted(rows, key=lambda r: (r.partition, r.offset)))
        yield from self._handle(run, rows)
        if not self._streaming:
            yield from self._drain(run)
            yield from self._state_rows(run)
        self._save(run)

    def handleExpiredTimer(
        self, key: Any, timerValues: Any, expiredTimerInfo: Any
    ) -> Iterator[Row]:
        run = self._load(key)
        expired_ms = expiredTimerInfo.getExpiryTimeInMs()
        if self._reorder:
            yield from self._handle(run, self._released(expired_ms * 1000))
        yield from self._advance(run, expired_ms * 1000)
        if expired_ms % 1000 == _PURGE_MS and self._purge(run, expired_ms * 1000):
            # Nothing is left, and the watermark is past the clock: forget the key.
            self._key_state.clear()
        else:
            self._save(run)

    def _handle(self, run: KeyRun, rows: Iterator[Row]) -> Iterator[Row]:
        """Deliver rows that are in order, and see to it that they are.

        The last offset handled per partition is kept with the key: a row that comes after a
        later one was handled fails the query, unless order is not asked for.
        """
        last, partition = None, None
        for row in rows:
            place = (row.partition, row.offset)
            if last is not None and place < last:
                raise RuntimeError(f"rows of key {run.key!r} are out of order: {last}, {place}")
            if self._check_order and row.partition != partition:
                if partition is not None:
                    self._places.updateValue((partition,), (last[1],))
                partition = row.partition
                handled = self._places.getValue((partition,))
                if handled is not None and row.offset <= handled[0]:
                    raise RuntimeError(
                        f"rows of key {run.key!r} are out of order: offset {row.offset} of partition "
                        f"{partition} comes after {handled[0]} was handled"
                    )
            last = place
            if self._is_duplicate(run, row):
                continue
            yield from self._advance(run, row.us)
            run.clock = max(run.clock, row.us)
            yield from self._deliver(run, _record_call(row))
        if partition is not None:
            self._places.updateValue((partition,), (last[1],))

    # Order over micro-batches

    def _hold(self, rows: Iterator[Row]) -> None:
        """Keep rows until the watermark has passed them, when none can come before them."""
        for row in rows:
            content = json.dumps(row.asDict(), default=str)
            self._waiting.updateValue((row.partition, row.offset), (content,))
            self._spark.registerTimer(-(-row.us // SECOND_US) * 1000 + _RELEASE_MS)

    def _released(self, now_us: int) -> list[Row]:
        """Rows the watermark has passed, in order; one that it has not holds back those
        behind it in its partition."""
        held: set[int] = set()
        found = []
        for place in sorted(tuple(place) for place in self._waiting.keys()):
            if place[0] in held:
                continue
            row = json.loads(self._waiting.getValue(place)[0])
            if row["us"] > now_us:
                held.add(place[0])
                continue
            self._waiting.removeKey(place)
            found.append(Row(**row))
        return found

    # Duplicates

    def _is_duplicate(self, run: KeyRun, row: Row) -> bool:
        """True if the event's id is remembered; otherwise it is from now on."""
        if self._ids is None or row.event_id is None:
            return False
        ttl_us, version = self._ids
        found = self._seen.getValue((row.event_id,))
        if found is not None and found[0] == version and row.us // SECOND_US < found[1]:
            return True
        expires = (row.us + ttl_us + HALF_SECOND_US) // SECOND_US
        self._seen.updateValue((row.event_id,), (version, expires))
        run.ids_expire = max(run.ids_expire, expires)
        return False

    def _forget_ids(self, now_us: int) -> bool:
        """Drop ids that have expired; true if any is left."""
        if self._ids is None:
            return False
        held = list(self._seen.iterator())
        gone = [name for name, content in held if content[1] * SECOND_US <= now_us]
        for name in gone:
            self._seen.removeKey(tuple(name))
        return len(gone) < len(held)

    # Loading and saving a key

    def _load(self, key: Any) -> KeyRun:
        topic, name = key
        cells = {c.name: KeyCells(c, self._stores[c.name]) for c in self._collections}
        run = KeyRun(topic, name, cells)
        saved = self._key_state.get()
        if saved is not None:
            run.clock, run.parked_from, run.parked_to, run.failures = saved
            for timer in self._spark.listTimers():
                if timer % 1000 == 0:
                    run.add_timer(timer // 1000)
                elif timer % 1000 == _RETRY_MS:
                    run.retry_second = timer // 1000
        run.saved_timers = self._timer_ms(run)
        return run

    def _save(self, run: KeyRun) -> None:
        for cells in run.cells.values():
            cells.flush()
        if run.parked_from == run.parked_to:
            run.parked_from = run.parked_to = 0
        self._key_state.update((run.clock, run.parked_from, run.parked_to, run.failures))
        wanted = self._timer_ms(run)
        for timer in run.saved_timers - wanted:
            self._spark.deleteTimer(timer)
        for timer in wanted - run.saved_timers:
            self._spark.registerTimer(timer)
        expiry = max((cells.last_expiry for cells in run.cells.values()), default=0)
        if self._streaming:
            # Rounded up, so that a busy key has few of these at a time.
            self._purge_at(-(-expiry // SECOND_US), _PURGE_SECONDS)
            if self._ids is not None:
                # Each look reads all ids of the key: an id is read eight times or so.
                self._purge_at(run.ids_expire, max(_PURGE_SECONDS, self._ids[0] // SECOND_US // 8))

    def _purge_at(self, second: int, step: int) -> None:
        if second:
            self._spark.registerTimer(-(-second // step) * step * 1000 + _PURGE_MS)

    def _timer_ms(self, run: KeyRun) -> set[int]:
        timers = {second * 1000 for second in run.timers}
        if run.retry_second is not None:
            timers.add(run.retry_second * 1000 + _RETRY_MS)
        return timers

    def _purge(self, run: KeyRun, now_us: int) -> bool:
        """Drop cells that have expired, which reads hide until then; true if none is left."""
        left = self._forget_ids(now_us) or bool(run.timers) or run.has_parked
        left = left or self._reorder and next(iter(self._waiting.keys()), None) is not None
        for cells in run.cells.values():
            held = list(cells.scan())
            gone = [c for c, content in held if content[1] and content[1] <= now_us]
            cells.apply(dict.fromkeys(gone), clear=False)
            cells.flush()
            left = left or len(gone) < len(held)
        return not left

    # Time

    def _advance(self, run: KeyRun, until_us: int) -> Iterator[Row]:
        """Fire, in time order, what is due at or before ``until_us``."""
        while True:
            due = [s for s in (run.next_timer(), run.retry_second) if s is not None]
            if not due or min(due) * SECOND_US > until_us:
                return
            second = min(due)
            run.clock = max(run.clock, second * SECOND_US)
            if second == run.retry_second:
                yield from self._retry_parked(run)
            else:
                run.timers.discard(second)
                yield from self._deliver(run, {"call": "on_timer", "us": second * SECOND_US})

    def _drain(self, run: KeyRun) -> Iterator[Row]:
        """At the end of batch input everything that still waits comes due.

        A call that goes on failing leaves as a ``parked`` row, and so does all that
        waits behind it, in order: nothing is given up and nothing overtakes it.
        """
        tries = 0
        while run.timers or run.retry_second is not None:
            last = max(s for s in (*run.timers, run.retry_second) if s is not None)
            head = run.parked_from if run.has_parked else None
            yield from self._advance(run, last * SECOND_US)
            stuck = run.has_parked and run.parked_from == head
            tries = tries + 1 if stuck else 0
            if stuck and not run.timers and tries >= self._end_attempts:
                yield from self._hand_back(run)

    def _hand_back(self, run: KeyRun) -> Iterator[Row]:
        attempt, run.failures, run.retry_second = run.failures, 0, None
        while run.has_parked:
            call = json.loads(self._parked.getValue((run.parked_from,))[0])
            self._parked.removeKey((run.parked_from,))
            run.parked_from += 1
            yield self._row("parked", run, call, attempt, "parked", value=call.get("payload"))
            attempt = 0

    # Calls

    def _deliver(self, run: KeyRun, call: dict) -> Iterator[Row]:
        if run.has_parked:
            # A failed call of this key waits for its retry; order is kept behind it.
            self._park(run, call)
            return
        yield from self._call(run, call)

    def _call(self, run: KeyRun, call: dict, earlier_failures: int = 0) -> Iterator[Row]:
        attempt = earlier_failures
        while True:
            attempt += 1
            started = datetime.now(timezone.utc)
            error, returned, emitted = self._attempt(run, call)
            kind = None if error is None else category(error)
            outcome = self._outcome(kind, attempt)
            if self._telemetry or error is not None:
                times = (started, datetime.now(timezone.utc))
                yield self._row("call", run, call, attempt, outcome, kind, error=error, times=times)
            if outcome != "retry":
                break
        if outcome == "ok":
            for text in emitted:
                yield self._row("output", run, call, attempt, outcome, value=text)
        elif outcome == "deferred":
            self._defer(run, call, attempt)
            return
        elif outcome == "dead_letter":
            yield self._row(
                "dead_letter", run, call, attempt, outcome, kind,
                value=call.get("payload"), error=error,
            )
        request = (call.get("headers") or {}).get(REQUEST_HEADER)
        if request is not None:
            yield self._row(
                "response", run, call, attempt, outcome, kind,
                name=request, value=returned, error=error,
            )

    def _outcome(self, kind: str | None, attempt: int) -> str:
        if kind is None:
            return "ok"
        if kind == "permanent":
            return "permanent"
        if self._mode == "best-effort":
            return "skipped"
        if self._mode == "low-latency":
            return "retry" if attempt <= self._max_retries else "dead_letter"
        exhausted = self._max_attempts is not None and attempt >= self._max_attempts
        return "dead_letter" if exhausted else "deferred"

    def _attempt(self, run: KeyRun, call: dict) -> tuple[Exception | None, str | None, list[str]]:
        attempt = Attempt(run.clock)
        context = Context(run, attempt)
        try:
            result = self._invoke(context, run, call)
            returned = encode_json(result, PermanentError)
            return None, returned, context.finish()
        except Exception as error:  # a handler may raise anything; the mode decides
            return error, None, []
        finally:
            attempt.alive = False

    def _invoke(self, context: Context, run: KeyRun, call: dict) -> Any:
        method, is_async = self._methods[call["call"]]
        if call["call"] == "on_timer":
            argument: Any = Timer(run.key, from_us(call["us"]))
        else:
            argument = deliver(
                run.topic, call["partition"], call["offset"], call["us"], run.key,
                call["headers"], call["payload"],
            )
        if not is_async:
            with watchdog(self._timeout):
                return method(context, argument)
        if self._loop is None:
            self._loop = asyncio.new_event_loop()
        running = method(AsyncView(context), argument)
        if self._timeout is not None:
            running = asyncio.wait_for(running, self._timeout)
        return self._loop.run_until_complete(running)

    # Deferral

    def _park(self, run: KeyRun, call: dict) -> None:
        self._parked.updateValue((run.parked_to,), (json.dumps(call),))
        run.parked_to += 1

    def _defer(self, run: KeyRun, call: dict, attempt: int) -> None:
        """Park the call at the head and set its retry timer; backoff doubles."""
        run.parked_from -= 1
        self._parked.updateValue((run.parked_from,), (json.dumps(call),))
        run.failures = attempt
        base, cap = self._backoff
        delay = min(base << min(attempt - 1, 32), cap)
        run.retry_second = (run.clock + delay * SECOND_US + SECOND_US // 2) // SECOND_US

    def _retry_parked(self, run: KeyRun) -> Iterator[Row]:
        """Run parked calls in order until one fails again."""
        run.retry_second = None
        failures, run.failures = run.failures, 0
        while run.has_parked and run.retry_second is None:
            head = run.parked_from
            call = json.loads(self._parked.getValue((head,))[0])
            self._parked.removeKey((head,))
            run.parked_from += 1
            yield from self._call(run, call, failures)
            failures = 0

    # Rows

    def _row(self, kind, run, call, attempt, outcome, category_=None, *, name=None,
             cell=None, size=None, value=None, error=None, times=(None, None)) -> Row:
        return _OutputRow(
            kind, run.topic, run.key, call["call"], call.get("partition"), call.get("offset"),
            from_us(call["us"]), attempt, outcome, category_, name, cell, size, value,
            None if error is None else str(error), *times,
        )

    def _state_rows(self, run: KeyRun) -> Iterator[Row]:
        """The key's committed state at the end of a batch run."""
        if not self._with_state:
            return
        for cells in run.cells.values():
            end = {"call": None, "us": run.clock}
            for cell, size, text in final_state(cells, run.clock):
                yield self._row(
                    "state", run, end, 0, None, name=cells.definition.name,
                    cell=cell, size=size, value=text,
                )


def _record_call(row: Row) -> dict:
    return {
        "call": "on_excise" if row.payload is None else "on_message",
        "partition": row.partition, "offset": row.offset, "us": row.us,
        # Spark hands a map over as a list of pairs.
        "payload": row.payload, "headers": dict(row.headers or ()),
    }
