"""State handles: typed collections of one key inside one handler attempt.

A handle reads through three layers: the attempt's pending writes, the key's writes
that are committed but not yet sent to Spark, and Spark's state store. Committed
writes go to the store when the key's rows are done, so a key touched a thousand
times in a micro-batch costs one write per cell. Spark makes the micro-batch atomic.
"""

from __future__ import annotations

import asyncio
import json
from collections.abc import Iterator
from typing import Any

from keyfold.definitions import U32_MAX, Collection, Direction
from keyfold.errors import NullValueError, PermanentStateError, TransientStateError
from keyfold.streaming.messages import Message

MAX_CACHED_CELLS = 10_000

CELL_SCHEMA = "v string, expires long"
KEY_SCHEMAS = {"map": "k string", "deque": "slot long"}

# Deque ends live beside its slots, in cells no slot number reaches.
ENDS_CELL = -(2**62)


class SparkCells:
    """One collection's cells in Spark's state store, for the key being processed."""

    def __init__(self, handle: Any, definition: Collection) -> None:
        self.keyed = definition.kind != "value"
        if self.keyed:
            schema = KEY_SCHEMAS[definition.kind]
            self._state = handle.getMapState(definition.name, schema, CELL_SCHEMA)
        else:
            self._state = handle.getValueState(definition.name, CELL_SCHEMA)

    def get(self, cell: Any) -> tuple | None:
        found = self._state.getValue((cell,)) if self.keyed else self._state.get()
        return None if found is None else tuple(found)

    def put(self, cell: Any, content: tuple) -> None:
        if self.keyed:
            self._state.updateValue((cell,), content)
        else:
            self._state.update(content)

    def remove(self, cell: Any) -> None:
        if self.keyed:
            self._state.removeKey((cell,))
        else:
            self._state.clear()

    def clear(self) -> None:
        self._state.clear()

    def scan(self) -> Iterator[tuple[Any, tuple]]:
        if self.keyed:
            for cell, content in self._state.iterator():
                yield cell[0], tuple(content)
        else:
            found = self._state.get()
            if found is not None:
                yield None, tuple(found)


class KeyCells:
    """One collection of the current key: committed writes over the state store."""

    def __init__(self, definition: Collection, store: Any) -> None:
        self.definition, self._store = definition, store
        self._cells: dict[Any, tuple | None] = {}
        self._dirty: set[Any] = set()
        self._emptied = False
        self.last_expiry = 0

    def get(self, cell: Any) -> tuple | None:
        if cell not in self._cells:
            if len(self._cells) >= MAX_CACHED_CELLS:
                self.flush()
            self._cells[cell] = None if self._emptied else self._store.get(cell)
        return self._cells[cell]

    def apply(self, writes: dict[Any, tuple | None], clear: bool) -> None:
        if clear:
            self._cells.clear()
            self._dirty.clear()
            self._emptied = True
        self._cells.update(writes)
        self._dirty.update(writes)
        if self.definition.ttl_seconds:
            ends = (content[1] for content in writes.values() if content and content[1])
            self.last_expiry = max(ends, default=self.last_expiry)

    def scan(self) -> Iterator[tuple[Any, tuple]]:
        """Cells in no set order, with committed writes laid over the store."""
        # The store is read to its end first, so that a reader may stop at any item.
        stored = {} if self._emptied else dict(self._store.scan())
        stored.update(self._cells)
        return ((cell, content) for cell, content in stored.items() if content is not None)

    def flush(self) -> None:
        """Send committed writes to the store and forget the cached cells."""
        if self._emptied:
            self._store.clear()
        for cell in self._dirty:
            content = self._cells[cell]
            if content is not None:
                self._store.put(cell, content)
            elif not self._emptied:
                self._store.remove(cell)
        self._cells.clear()
        self._dirty.clear()
        self._emptied = False


class Attempt:
    """The life of one handler call; handles and scans die with it."""

    def __init__(self, now_us: int) -> None:
        self.now_us, self.alive = now_us, True

    def check(self) -> None:
        if not self.alive:
            raise TransientStateError("the handler call this handle belongs to has ended")


class Handle:
    """What the three kinds of handle share: pending writes, guards and transactions."""

    def __init__(self, cells: KeyCells, attempt: Attempt) -> None:
        self._base, self._attempt = cells, attempt
        self._definition = cells.definition
        self._pending: dict[Any, tuple | None] = {}
        self._clears = False

    def commit(self) -> None:
        """Make the writes so far last, whatever becomes of the call."""
        self._attempt.check()
        self._apply()

    def rollback(self) -> None:
        """Forget the writes since the last commit."""
        self._attempt.check()
        self._pending, self._clears = {}, False

    def _apply(self) -> None:
        if self._pending or self._clears:
            self._base.apply(self._pending, self._clears)
            self._pending, self._clears = {}, False

    def _write(self, cell: Any, content: tuple | None) -> None:
        self._attempt.check()
        self._pending[cell] = content
        if self._definition.read_uncommitted:
            self._apply()

    def _read(self, cell: Any) -> str | None:
        self._attempt.check()
        if cell in self._pending:
            content = self._pending[cell]
        else:
            content = None if self._clears else self._base.get(cell)
        return content[0] if self._is_live(content) else None

    def _is_live(self, content: tuple | None) -> bool:
        if content is None:
            return False
        return content[1] is None or content[1] > self._attempt.now_us

    def _all(self) -> dict[Any, str]:
        self._attempt.check()
        merged = {} if self._clears else dict(self._base.scan())
        merged.update(self._pending)
        return {cell: content[0] for cell, content in merged.items() if self._is_live(content)}

    def clear(self) -> None:
        """Remove everything."""
        self._attempt.check()
        self._pending, self._clears = {}, True
        if self._definition.read_uncommitted:
            self._apply()

    def _content(self, item: Any) -> tuple:
        ttl = self._definition.ttl_seconds
        expires = self._attempt.now_us + int(ttl * 1_000_000) if ttl else None
        return (self._encode(item), expires)

    def _encode(self, item: Any) -> str:
        if self._definition.payload == "message":
            if not isinstance(item, Message) or not item.delivered:
                raise TransientStateError("only a message that was delivered can be stored")
            return item.to_text()
        if isinstance(item, Message):
            raise TransientStateError("a message cannot be stored in a JSON collection")
        if item is None:
            raise NullValueError("null is not a storable value; clear or remove it instead")
        return encode_json(item, TransientStateError)

    def _decode(self, text: str | None) -> Any:
        if text is None:
            return None
        return Message.from_text(text) if self._definition.payload == "message" else json.loads(text)

    def _scanned(self, items: Iterator[Any]) -> Iterator[Any]:
        for item in items:
            self._attempt.check()
            yield item
        self._attempt.check()


_encode = json.JSONEncoder(ensure_ascii=False, allow_nan=False).encode


def encode_json(item: Any, error: type[Exception]) -> str:
    """JSON text of a value built from plain lists, text-keyed dicts and scalars."""
    try:
        if isinstance(item, (dict, list, tuple)):
            _check_keys(item)
        return _encode(item)
    except (TypeError, ValueError) as cause:
        raise error(f"value is not representable as JSON: {cause}") from cause


def _check_keys(item: Any) -> None:
    # The encoder would turn number keys into text without complaint.
    if isinstance(item, dict):
        for name in item:
            if not isinstance(name, str):
                raise TypeError(f"keys must be text, got {name!r}")
        item = item.values()
    for inner in item:
        if isinstance(inner, (dict, list, tuple)):
            _check_keys(inner)


def _is_backward(direction: Any) -> bool:
    token = direction.value if isinstance(direction, Direction) else direction
    if token not in ("forward", "backward"):
        raise TransientStateError(f"direction: expected forward or backward, got {token!r}")
    return token == "backward"


class ValueState(Handle):
    """A single value."""

    def get(self) -> Any:
        return self._decode(self._read(None))

    def set(self, item: Any) -> None:
        self._write(None, self._content(item))


class MapState(Handle):
    """An ordered map with text keys."""

    @staticmethod
    def _name(key: Any) -> str:
        if not isinstance(key, str):
            raise TransientStateError("map keys must be text")
        return key

    def get(self, key: str, default: Any = None) -> Any:
        found = self._decode(self._read(self._name(key)))
        return default if found is None else found

    def get_many(self, keys: list[str]) -> list[Any]:
        return [self.get(key) for key in keys]

    def contains(self, key: str) -> bool:
        return self._read(self._name(key)) is not None

    def set(self, key: str, item: Any) -> None:
        self._write(self._name(key), self._content(item))

    def remove(self, key: str) -> None:
        self._write(self._name(key), None)

    def items(self, direction: Direction = Direction.FORWARD) -> Iterator[tuple[str, Any]]:
        ordered = sorted(self._all().items(), reverse=_is_backward(direction))
        return self._scanned((key, self._decode(text)) for key, text in ordered)

    def keys(self, direction: Direction = Direction.FORWARD) -> Iterator[str]:
        return self._scanned(iter(sorted(self._all(), reverse=_is_backward(direction))))

    def values(self) -> Iterator[Any]:
        return (item for _, item in self.items())

    def __iter__(self) -> Iterator[str]:
        return self.keys()


class DequeState(Handle):
    """A double-ended queue on numbered slots; ends are kept as [front, back)."""

    def _ends(self) -> tuple[int, int]:
        # Ends never expire: an expired slot is a hole that still has its place.
        content = self._pending.get(ENDS_CELL)
        if content is None and not self._clears:
            content = self._base.get(ENDS_CELL)
        self._attempt.check()
        return tuple(json.loads(content[0])) if content else (0, 0)

    def _move(self, front: int, back: int) -> None:
        self._pending[ENDS_CELL] = (json.dumps([front, back]), None)

    def append(self, item: Any) -> None:
        self._push(item, right=True)

    def appendleft(self, item: Any) -> None:
        self._push(item, right=False)

    def _push(self, item: Any, right: bool) -> None:
        content = self._content(item)
        front, back = self._ends()
        limit = int(self._definition.capacity or U32_MAX)
        if self._definition.capacity is None and back - front >= limit:
            raise TransientStateError("deque is full")
        while back - front >= limit:
            # Over capacity the far end gives way, also after the bound was lowered.
            if right:
                self._pending[front] = None
                front += 1
            else:
                back -= 1
                self._pending[back] = None
        if right:
            slot, back = back, back + 1
        else:
            front -= 1
            slot = front
        self._move(front, back)
        self._write(slot, content)

    def pop(self) -> Any:
        return self._take(right=True)

    def popleft(self) -> Any:
        return self._take(right=False)

    def _take(self, right: bool) -> Any:
        front, back = self._ends()
        if front == back:
            return None
        slot = back - 1 if right else front
        item = self._decode(self._read(slot))
        self._move(*((front, back - 1) if right else (front + 1, back)))
        self._write(slot, None)
        return item

    def get(self, index: int) -> Any:
        if isinstance(index, bool) or not isinstance(index, int):
            raise TypeError(f"deque index must be an int, got {index!r}")
        front, back = self._ends()
        slot = front + index if index >= 0 else back + index
        return self._decode(self._read(slot)) if front <= slot < back else None

    def peek(self) -> Any:
        return self.get(-1)

    def peekleft(self) -> Any:
        return self.get(0)

    def size(self) -> int:
        front, back = self._ends()
        return back - front

    def is_empty(self) -> bool:
        return self.size() == 0

    def values(self, direction: Direction = Direction.FORWARD) -> Iterator[Any]:
        front, back = self._ends()
        slots = range(back - 1, front - 1, -1) if _is_backward(direction) else range(front, back)
        texts = (self._read(slot) for slot in slots)
        return self._scanned(self._decode(text) for text in texts if text is not None)

    def __iter__(self) -> Iterator[Any]:
        return self.values()


HANDLES = {"value": ValueState, "map": MapState, "deque": DequeState}


class AsyncView:
    """The same context or handle for ``async`` handlers: calls are awaited."""

    def __init__(self, target: Any) -> None:
        self._target = target

    def __getattr__(self, name: str) -> Any:
        found = getattr(self._target, name)
        if not callable(found):
            return found
        if name in ("items", "keys", "values"):
            return lambda *args, **kwargs: AsyncScan(found(*args, **kwargs))
        if name == "state":
            return lambda definition: AsyncView(found(definition))

        async def call(*args: Any, **kwargs: Any) -> Any:
            return found(*args, **kwargs)

        return call

    def __aiter__(self) -> AsyncScan:
        return AsyncScan(iter(self._target))


class AsyncScan:
    """A scan for ``async for``; ``aclose`` ends it early."""

    def __init__(self, items: Iterator[Any]) -> None:
        self._items: Iterator[Any] | None = items

    def __aiter__(self) -> AsyncScan:
        return self

    async def __anext__(self) -> Any:
        await asyncio.sleep(0)
        for item in self._items or ():
            return item
        raise StopAsyncIteration

    async def aclose(self) -> None:
        self._items = None


def bind(
    registered: dict[str, KeyCells], definition: Collection, attempt: Attempt
) -> Handle:
    """A handle on a declared collection."""
    attempt.check()
    if not isinstance(definition, Collection):
        raise TransientStateError("state() takes a collection definition")
    cells = registered.get(definition.name)
    if cells is None:
        raise PermanentStateError(f"collection {definition.name!r} is not declared")
    declared = cells.definition
    if (declared.kind, declared.payload) != (definition.kind, definition.payload):
        raise PermanentStateError(
            f"collection {definition.name!r} is declared as {declared.payload} {declared.kind}"
        )
    return HANDLES[declared.kind](cells, attempt)


def final_state(cells: KeyCells, now_us: int) -> Iterator[tuple[str | None, int | None, str]]:
    """The key's live cells as (cell, size, text); a deque's cells are its positions."""
    handle = HANDLES[cells.definition.kind](cells, Attempt(now_us))
    live = handle._all()
    if not isinstance(handle, DequeState):
        yield from ((cell, None, text) for cell, text in live.items())
        return
    front, back = handle._ends()
    live.pop(ENDS_CELL, None)
    yield from ((str(slot - front), back - front, text) for slot, text in live.items())
