"""State handles over a plain dictionary in place of Spark's store."""

import collections
import copy
from datetime import datetime, timezone
from random import Random as random_of

import pytest

from keyfold import definitions as d
from keyfold.definitions import Direction
from keyfold.errors import NullValueError, PermanentStateError, TransientStateError
from keyfold.streaming import handles
from keyfold.streaming.handles import Attempt, KeyCells, bind
from keyfold.streaming.messages import Message, deliver


class DictStore:
    def __init__(self):
        self.cells = {}

    def get(self, cell):
        return self.cells.get(cell)

    def put(self, cell, content):
        self.cells[cell] = content

    def remove(self, cell):
        self.cells.pop(cell, None)

    def clear(self):
        self.cells.clear()

    def scan(self):
        return iter(dict(self.cells).items())


class Key:
    """One key's collections; ``call`` starts a handler attempt."""

    def __init__(self, *definitions):
        self.stores = {x.name: DictStore() for x in definitions}
        self.cells = {x.name: KeyCells(x, self.stores[x.name]) for x in definitions}

    def call(self, definition, now_us=0):
        self.attempt = Attempt(now_us)
        return bind(self.cells, definition, self.attempt)

    def flush(self):
        for cells in self.cells.values():
            cells.flush()


VALUE, MAP, DEQUE = d.value("one"), d.map("many"), d.deque("row")
LOG = d.message_deque("messages")


@pytest.fixture(params=[False, True], ids=["cached", "stored"])
def between(request):
    """Run each case with and without a trip through the store between calls."""
    return (lambda key: key.flush()) if request.param else (lambda key: None)


def message(offset=1):
    return deliver("t", 0, offset, 0, "k", {}, '{"n": %d}' % offset)


def some_json(random, depth=0):
    """A random JSON value other than null."""
    kind = random.randrange(4 if depth > 2 else 6)
    if kind == 0:
        return random.randrange(-(2**40), 2**40)
    if kind == 1:
        return random.random() * 1e6
    if kind == 2:
        return "".join(chr(random.choice([33, 99, 228, 1078, 8364, 128640])) for _ in range(random.randrange(6)))
    if kind == 3:
        return random.random() < 0.5
    parts = [random.choice([None, some_json(random, depth + 1)]) for _ in range(random.randrange(4))]
    return parts if kind == 4 else {f"f{n}": part for n, part in enumerate(parts)}


def walk(definition, model, steps, act, between, seed):
    """Random acts on a handle and on a plain object, with commits, rollbacks and reloads."""
    random, key = random_of(seed), Key(definition)
    handle, kept = key.call(definition), copy.deepcopy(model)
    for _ in range(steps):
        act(random, handle, model)
        chance = random.random()
        if chance < 0.15:
            handle.commit()
            kept = copy.deepcopy(model)
            between(key)
            handle = key.call(definition)
        elif chance < 0.25:
            handle.rollback()
            model = copy.deepcopy(kept)


@pytest.mark.parametrize("seed", range(6))
def test_value_follows_a_plain_variable(between, seed):
    def act(random, handle, model):
        if random.random() < 0.2:
            handle.clear()
            model["now"] = None
        else:
            model["now"] = random.choice([0, False, "", [], {}, some_json(random)])
            handle.set(model["now"])
        found = handle.get()
        assert found == model["now"] and type(found) is type(model["now"])

    walk(d.value("one"), {"now": None}, 60, act, between, seed)


@pytest.mark.parametrize("seed", range(6))
def test_map_follows_a_dictionary(between, seed):
    names = [f"n{k}" for k in range(9)] + ["\u00e4", "\u0436\u0436", "\u20ac", "\U0001f680", "", "N1"]

    def act(random, handle, model):
        name, chance = random.choice(names), random.random()
        if chance < 0.6:
            model[name] = random.choice([0, False, some_json(random)])
            handle.set(name, model[name])
        elif chance < 0.9:
            model.pop(name, None)
            handle.remove(name)
        else:
            model.clear()
            handle.clear()
        asked = [random.choice(names) for _ in range(random.randrange(5))] * 2
        assert handle.get_many(asked) == [model.get(n) for n in asked]
        assert handle.contains(name) == (name in model)
        assert handle.get(name, "none") == model.get(name, "none")
        entries = sorted(model.items(), key=lambda entry: entry[0].encode())
        assert list(handle.items()) == entries
        assert list(handle.items(Direction.BACKWARD)) == entries[::-1]
        assert list(handle) == list(handle.keys()) == [n for n, _ in entries]
        assert list(handle.values()) == [v for _, v in entries]

    walk(d.map("many"), {}, 60, act, between, seed)


def test_map_names_are_text():
    with pytest.raises(TransientStateError):
        Key(MAP).call(MAP).get(5)


def test_map_scan_may_stop_early(between):
    key = Key(MAP)
    entries = key.call(MAP)
    names = sorted({f"{n * 7919 % 1000:x}" for n in range(500)}, key=str.encode)
    for n in reversed(names):
        entries.set(n, len(n))
    entries.commit()
    between(key)
    scan = key.call(MAP).keys(Direction.BACKWARD)
    assert [next(scan), next(scan)] == names[:-3:-1]
    scan.close()
    assert list(key.call(MAP).keys()) == names


@pytest.mark.parametrize("capacity", [None, 1, 4])
@pytest.mark.parametrize("seed", range(4))
def test_deque_follows_a_plain_one(between, seed, capacity):
    def act(random, handle, model):
        chance, item = random.random(), some_json(random)
        if chance < 0.35:
            handle.append(item)
            model.append(item)
        elif chance < 0.6:
            handle.appendleft(item)
            model.appendleft(item)
        elif chance < 0.75:
            assert handle.pop() == (model.pop() if model else None)
        elif chance < 0.95:
            assert handle.popleft() == (model.popleft() if model else None)
        else:
            handle.clear()
            model.clear()
        items = list(model)
        assert list(handle) == list(handle.values()) == items
        assert list(handle.values(Direction.BACKWARD)) == items[::-1]
        assert handle.size() == len(items) and handle.is_empty() == (not items)
        assert (handle.peekleft(), handle.peek()) == ((items[0], items[-1]) if items else (None, None))
        place = random.randrange(-len(items) - 2, len(items) + 2)
        inside = -len(items) <= place < len(items)
        assert handle.get(place) == (items[place] if inside else None)

    walk(d.deque("row", capacity=capacity), collections.deque(maxlen=capacity), 70, act, between, seed)


def test_deque_places_are_whole_numbers():
    with pytest.raises(TypeError):
        Key(DEQUE).call(DEQUE).get(1.5)


def test_lowered_capacity_takes_effect_on_push():
    key = Key(DEQUE)
    backlog = key.call(DEQUE)
    for n in range(6):
        backlog.append(n)
    backlog.commit()
    narrow = KeyCells(d.deque("row", capacity=2), key.stores["row"])
    key.flush()
    handle = handles.DequeState(narrow, Attempt(0))
    assert handle.size() == 6
    handle.append(6)
    assert list(handle) == [5, 6]


def test_commit_survives_failure_and_rollback_stops_at_it():
    key = Key(VALUE)
    cart = key.call(VALUE)
    cart.set("floor")
    cart.commit()
    cart.set("later")
    cart.rollback()
    assert cart.get() == "floor"
    cart.set("lost")
    key.attempt.alive = False  # the call fails: nothing is committed
    assert key.call(VALUE).get() == "floor"


def test_read_uncommitted_writes_through():
    loose = d.value("loose", read_uncommitted=True)
    key = Key(loose)
    key.call(loose).set("kept")
    assert key.call(loose).get() == "kept"


def test_ttl_runs_on_the_event_clock():
    short = d.map("short", ttl=10)
    key = Key(short)
    handle = key.call(short, now_us=0)
    handle.set("a", 1)
    handle.commit()
    assert key.call(short, 9_999_999).contains("a")
    assert not key.call(short, 10_000_000).contains("a")
    assert list(key.call(short, 10_000_000).items()) == []


def test_expired_deque_slots_are_holes_with_a_place():
    short = d.deque("short", ttl=10)
    key = Key(short)
    handle = key.call(short, 0)
    handle.append("old")
    handle.commit()
    handle = key.call(short, 5_000_000)
    handle.append("new")
    handle.commit()
    handle = key.call(short, 12_000_000)
    assert handle.size() == 2 and handle.peekleft() is None and handle.peek() == "new"
    assert list(handle) == ["new"]
    assert handle.popleft() is None and handle.size() == 1


def test_handles_and_scans_die_with_their_call():
    key = Key(VALUE, MAP)
    cart, totals = key.call(VALUE), key.call(MAP)
    totals.set("a", 1)
    totals.set("b", 2)
    scan = totals.items()
    next(scan)
    key.attempt.alive = False
    for act in (lambda: totals.get("a"), lambda: totals.set("c", 1), totals.commit, lambda: next(scan)):
        with pytest.raises(TransientStateError):
            act()
    assert cart.get() is None  # of another call, still alive


@pytest.mark.parametrize("item", [object(), lambda: 1, {1: "a"}, float("nan"), {"a": {2}}, b"x"])
def test_unrepresentable_writes_are_refused(item):
    key = Key(VALUE, MAP, DEQUE)
    for write in (
        key.call(VALUE).set, lambda x: key.call(MAP).set("k", x), key.call(DEQUE).append,
    ):
        with pytest.raises(TransientStateError, match="JSON"):
            write(item)


def test_null_is_absence():
    key = Key(VALUE, DEQUE)
    with pytest.raises(NullValueError):
        key.call(VALUE).set(None)
    with pytest.raises(ValueError):
        key.call(DEQUE).append(None)


def test_messages_only_as_delivered():
    key = Key(VALUE, LOG)
    log = key.call(LOG)
    log.append(message(7))
    log.commit()
    key.flush()
    back = key.call(LOG).peek()
    assert back == message(7) and back.payload == {"n": 7}
    key.call(LOG).append(back)  # one read back from state counts as delivered
    forged = Message("t", 0, 1, datetime(2024, 1, 1, tzinfo=timezone.utc), "k", {}, {"n": 1})
    for item in (forged, {"n": 1}, None):
        with pytest.raises(TransientStateError):
            key.call(LOG).append(item)
    with pytest.raises(TransientStateError):
        key.call(VALUE).set(message())


def test_binding():
    key = Key(VALUE)
    with pytest.raises(PermanentStateError):
        key.call(d.value("unknown"))
    with pytest.raises(PermanentStateError):
        key.call(d.map("cart"))
    with pytest.raises(TransientStateError):
        key.call("cart")
    with pytest.raises(TransientStateError):
        key.call(VALUE).get()
        handles._is_backward("sideways")


def test_cache_gives_way_to_the_store(monkeypatch):
    monkeypatch.setattr(handles, "MAX_CACHED_CELLS", 4)
    key = Key(MAP)
    for n in range(50):
        totals = key.call(MAP)
        totals.set(f"k{n % 20:02d}", totals.get(f"k{n % 20:02d}", 0) + 1)
        totals.commit()
    key.flush()
    assert list(key.call(MAP).items()) == [(f"k{n:02d}", 3 if n < 10 else 2) for n in range(20)]
