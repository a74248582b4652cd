"""Collection definitions, errors, durations and other plain checks."""

import asyncio
import dataclasses
from datetime import timedelta

import pytest

from keyfold import definitions as d
from keyfold.errors import (
    NullValueError, PermanentError, PermanentStateError, StateError, TransientError,
    TransientStateError, category, permanent, transient,
)
from keyfold.functions.times import duration_seconds, duration_us
from keyfold.operators.requests import subsystem_names


def test_constructors_give_kind_and_payload():
    made = {
        f(f.__name__).kind + "/" + f(f.__name__).payload
        for f in (d.value, d.map, d.deque, d.message_value, d.message_map, d.message_deque)
    }
    assert made == {"value/json", "map/json", "deque/json", "value/message", "map/message", "deque/message"}


def test_config_has_nine_fields():
    config = d.map("m", ttl=timedelta(minutes=1), keyset_limit=5, published=True).to_config()
    assert config == {
        "name": "m", "kind": "map", "payload": "json", "ttl_seconds": 60.0,
        "read_uncommitted": None, "published": True, "read_cache": None, "keyset_limit": 5,
        "capacity": None,
    }


def test_definitions_are_frozen():
    with pytest.raises(dataclasses.FrozenInstanceError):
        d.value("a").name = "b"


@pytest.mark.parametrize(
    "bad,field",
    [
        (d.value("v", ttl=-1), "ttl_seconds: must be a whole number"),
        (d.value("v", ttl=2.5), "ttl_seconds: must be a whole number"),
        (d.value("v", ttl=float("nan")), "ttl_seconds: must be a whole number"),
        (d.value("v", ttl=float("inf")), "ttl_seconds: must be a whole number"),
        (d.map("m", keyset_limit=-1), "keyset_limit: must be a whole number"),
        (d.map("m", keyset_limit=2.5), "keyset_limit: must be a whole number"),
        (d.Collection("v", "value", keyset_limit=5), "keyset_limit: only valid for map"),
        (d.deque("q", capacity=0), "capacity: must be a whole number in 1..=4294967295"),
        (d.deque("q", capacity=2.5), "capacity: must be a whole number"),
        (d.Collection("v", "value", capacity=5), "capacity: only valid for deque"),
        (d.Collection("v", "bogus"), "kind: expected"),
        (d.Collection("v", "value", "bogus"), "payload: expected"),
        (d.value(""), "name: missing"),
        (d.value("v", published=True), "published: needs a subsystem"),
        (d.value("v", read_cache=True), "read_cache: True is ambiguous"),
        (d.value("v", read_cache=-1), "read_cache: must not be negative"),
    ],
)
def test_bad_definitions_name_the_field(bad, field):
    with pytest.raises(ValueError, match=r"state_collections\[0\]\." + field.split(":")[0]) as error:
        d.check_collections([bad])
    assert field in str(error.value)


def test_names_are_unique_and_messages_stay_private():
    with pytest.raises(ValueError, match="declared twice"):
        d.check_collections([d.value("a"), d.map("a")])
    private = dataclasses.replace(d.message_value("m"), published=True)
    with pytest.raises(ValueError, match="cannot be published"):
        d.check_collections([private], "shop")


def test_good_definitions_pass():
    d.check_collections(
        [d.value("a", ttl=30, published=True, read_cache=False), d.map("b", keyset_limit=0),
         d.deque("c", capacity=100), d.message_deque("e", capacity=1, ttl=timedelta(days=1))],
        "shop",
    )


def test_error_family():
    assert PermanentStateError("x").is_permanent is True
    assert TransientStateError("x").is_permanent is False
    assert issubclass(NullValueError, (ValueError,)) and issubclass(NullValueError, TransientStateError)
    for error in (PermanentStateError, TransientStateError, NullValueError):
        with pytest.raises(StateError):
            raise error("x")
    assert category(PermanentError("x")) == "permanent"
    assert category(KeyError("x")) == "transient"


def test_decorators_keep_text_and_cause():
    @permanent(KeyError, ValueError)
    def plain():
        raise ValueError("bad input")

    @transient(OSError)
    async def awaited():
        raise OSError("gone")

    with pytest.raises(PermanentError, match="bad input") as error:
        plain()
    assert isinstance(error.value.__cause__, ValueError)
    with pytest.raises(TransientError, match="gone"):
        asyncio.run(awaited())
    with pytest.raises(ZeroDivisionError):
        transient(OSError)(lambda: 1 / 0)()


def test_durations():
    assert duration_us(timedelta(milliseconds=1)) == 1000 and duration_us(0.02) == 20_000
    assert duration_seconds(timedelta(minutes=5)) == 300
    for bad in (-1, float("inf"), timedelta(seconds=-1)):
        with pytest.raises(ValueError):
            duration_us(bad)
    with pytest.raises(TypeError):
        duration_us("5")


def test_subsystem_names():
    assert subsystem_names(["a", "b", "a"]) == ["a", "b"]
    for bad in ([], [""], ["  "]):
        with pytest.raises(ValueError):
            subsystem_names(bad)
    for bad in ("a", [1]):
        with pytest.raises(TypeError):
            subsystem_names(bad)
