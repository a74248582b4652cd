"""Batch runs that keep no state: keys whose calls wait do not hold up the others.

A call may wait up to its deadline, on a service or in vain, and a task that waits with it
leaves its core idle. So a task hands its keys to processes of its own, its lanes. While the
lanes use little of a core, another one gets the next keys. A handler that computes therefore
runs in one lane at a time, as it would in the task, and its calls do not take longer. A key's
rows all go to one lane, in order, and a lane's calls run in its main thread, where the
deadline interrupts them.
"""

from __future__ import annotations

import os
import signal
import time
import traceback
from collections import namedtuple
from collections.abc import Iterator
from itertools import groupby
from multiprocessing.connection import Connection, Pipe, wait
from typing import Any

from keyfold.streaming.processor import OUTPUT_SCHEMA, KeyedProcessor

# Lanes of a task, at most.
LANES = 16

# Rows after which the next key goes to another lane, and rows of one key sent at a time.
_ROWS, _PIECE = 128, 2048

# Below this share of a core the lanes are taken to wait. Looked at every so many seconds.
_QUIET, _LOOK_SECONDS = 0.5, 0.004

EVENT = ["topic", "key", "partition", "offset", "payload", "headers", "us", "event_id"]
_Event = namedtuple("_Event", EVENT)


class _Nothing:
    """A state handle for a processor that keeps nothing; each variable is empty."""

    def getValueState(self, *_: Any) -> _Nothing:
        return self

    getMapState = getValueState

    def get(self) -> None:
        return None

    def update(self, content: tuple) -> None:
        pass

    def listTimers(self) -> Iterator[int]:
        return iter(())

    def registerTimer(self, timer: int) -> None:
        raise RuntimeError("a batch run ends with all its timers fired")

    deleteTimer = registerTimer


def _serve(processor: KeyedProcessor, link: Connection) -> None:
    """Handle rows as they come; the outputs of a piece leave before the next one is awaited."""
    outputs: list[tuple] = []

    def rows() -> Iterator[_Event]:
        while (piece := link.recv()) is not None:
            yield from map(_Event._make, piece)
            link.send(outputs)
            outputs.clear()

    processor.init(_Nothing())
    for key, events in groupby(rows(), key=lambda e: (e.topic, e.key)):
        for row in processor.handleInputRows(key, events, None):
            outputs.append(tuple(row))
    processor.close()
    link.send(outputs)


class _Lane:
    """A process of the task's that handles what it is sent, and answers each piece once."""

    def __init__(self, processor: KeyedProcessor, others: list[_Lane]) -> None:
        self.link, far = Pipe()
        self.busy, self.open = False, True
        self.pid = os.fork()
        if self.pid:
            far.close()
            self.mark = self.cpu()
            return
        try:
            # else a lane would not see the end of the task while another one lives
            for link in (self.link, *[other.link for other in others]):
                link.close()
            try:
                _serve(processor, far)
            except EOFError:
                pass
            except BaseException:
                far.send(traceback.format_exc())
        finally:
            os._exit(0)

    def cpu(self) -> float:
        """CPU seconds so far, by the clock of the process; where it has none, it seems to work."""
        try:
            return time.clock_gettime((~self.pid << 3) | 2)
        except OSError:
            return time.monotonic()

    def send(self, piece: list[tuple] | None) -> None:
        self.link.send(piece)
        self.busy, self.open = True, piece is not None

    def receive(self) -> list[tuple]:
        try:
            outputs = self.link.recv()
        except EOFError:
            raise RuntimeError("a process that handles events has died") from None
        if isinstance(outputs, str):
            raise RuntimeError(f"handling events failed:\n{outputs}")
        self.busy = False
        return outputs

    def end(self) -> None:
        self.link.close()
        os.kill(self.pid, signal.SIGKILL)
        os.waitpid(self.pid, 0)


class _Lanes:
    """Deals pieces to lanes, and gathers their outputs."""

    def __init__(self, processor: KeyedProcessor) -> None:
        self._processor = processor
        self._lanes: list[_Lane] = []
        self._looked = time.monotonic()

    def run(self, pieces: Iterator[tuple[list[tuple], bool]]) -> Iterator[list[tuple]]:
        """``pieces``: rows, and whether the last one's key goes on in the next piece."""
        held: _Lane | None = None
        for piece, goes_on in pieces:
            while held.busy if held is not None else not self._may_deal():
                yield from self._outputs()
            lane = held or next((lane for lane in self._lanes if not lane.busy), None)
            if lane is None:
                lane = _Lane(self._processor, self._lanes)
                self._lanes.append(lane)
            lane.send(piece)
            self._used()
            held = lane if goes_on else None
        while self._busy() or any(lane.open for lane in self._lanes):
            for lane in self._lanes:
                if lane.open and not lane.busy:
                    lane.send(None)
            yield from self._outputs()

    def end(self) -> None:
        for lane in self._lanes:
            lane.end()

    def _busy(self) -> list[_Lane]:
        return [lane for lane in self._lanes if lane.busy]

    def _outputs(self) -> Iterator[list[tuple]]:
        busy = {lane.link: lane for lane in self._busy()}
        for link in wait(list(busy), _LOOK_SECONDS):
            if outputs := busy[link].receive():
                yield outputs

    def _may_deal(self) -> bool:
        """True if no lane is at work; those that wait do not count."""
        busy = len(self._busy())
        if not busy:
            return True
        passed = time.monotonic() - self._looked
        if busy == LANES or passed < _LOOK_SECONDS / 4:
            return False
        return self._used() < _QUIET * passed

    def _used(self) -> float:
        """CPU seconds of the busy lanes since the last look."""
        self._looked, used = time.monotonic(), 0.0
        for lane in self._busy():
            cpu = lane.cpu()
            used, lane.mark = used + cpu - lane.mark, cpu
        return used


def _pieces(batches: Iterator[Any]) -> Iterator[tuple[list[tuple], bool]]:
    """Rows of whole keys, or parts of a key with very many."""
    rows: list[tuple] = []
    for batch in batches:
        for row in zip(*[column.to_pylist() for column in batch.columns]):
            if rows and row[:2] != rows[-1][:2]:
                if len(rows) >= _ROWS:
                    yield rows, False
                    rows = []
            elif len(rows) >= _PIECE:
                yield rows, True
                rows = []
            rows.append(row)
    if rows:
        yield rows, False


def _arrow_schema() -> Any:
    import pyarrow as pa

    types = {
        "string": pa.string(), "int": pa.int32(), "long": pa.int64(),
        "timestamp": pa.timestamp("us", "UTC"),
    }
    return pa.schema([(n, types[t]) for n, t in (part.split() for part in OUTPUT_SCHEMA.split(", "))])


def run_in_lanes(processor: KeyedProcessor) -> Any:
    """A function for ``mapInArrow`` over rows of the columns ``EVENT``, sorted by key."""

    def run(batches: Iterator[Any]) -> Iterator[Any]:
        import pyarrow as pa

        schema, lanes = _arrow_schema(), _Lanes(processor)
        try:
            for outputs in lanes.run(_pieces(batches)):
                columns = zip(*outputs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, field.type) for column, field in zip(columns, schema)], schema=schema
                )
        finally:
            lanes.end()

    return run
