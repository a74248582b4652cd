"""Declaring the collections a handler or a reader uses."""

from __future__ import annotations

import enum
import math
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta

from keyfold.functions.times import duration_us

U32_MAX = 2**32 - 1
KINDS = ("value", "map", "deque")
PAYLOADS = ("json", "message")

# Texts that callers match on.
WHOLE_NUMBER = "must be a whole number in {low}..={high}"
ONLY_FOR = "only valid for {kind} collections"
AMBIGUOUS_CACHE = "True is ambiguous; use a duration or False"
EXPECTED = "expected {choices}, got {found!r}"


class Direction(enum.Enum):
    """Scan order of maps and deques."""

    FORWARD = "forward"
    BACKWARD = "backward"


@dataclass(frozen=True)
class Collection:
    """One durable collection: its name, kind, payload and options."""

    name: str
    kind: str
    payload: str = "json"
    ttl: timedelta | float | None = None
    read_uncommitted: bool | None = None
    published: bool | None = None
    read_cache: timedelta | float | bool | None = None
    keyset_limit: float | None = None
    capacity: float | None = None

    @property
    def ttl_seconds(self) -> float | None:
        return self.ttl.total_seconds() if isinstance(self.ttl, timedelta) else self.ttl

    def to_config(self) -> dict[str, object]:
        """The definition as plain values."""
        return {
            "name": self.name,
            "kind": self.kind,
            "payload": self.payload,
            "ttl_seconds": self.ttl_seconds,
            "read_uncommitted": self.read_uncommitted,
            "published": self.published,
            "read_cache": self.read_cache,
            "keyset_limit": self.keyset_limit,
            "capacity": self.capacity,
        }


def value(name, *, ttl=None, read_uncommitted=None, published=None, read_cache=None):
    """A single JSON value per key."""
    return Collection(name, "value", "json", ttl, read_uncommitted, published, read_cache)


def map(name, *, ttl=None, read_uncommitted=None, published=None, read_cache=None,
        keyset_limit=None):
    """An ordered map of JSON values with text keys."""
    return Collection(
        name, "map", "json", ttl, read_uncommitted, published, read_cache, keyset_limit
    )


def deque(name, *, ttl=None, read_uncommitted=None, published=None, read_cache=None,
          capacity=None):
    """A double-ended queue of JSON values; a push over ``capacity`` evicts the far end."""
    return Collection(
        name, "deque", "json", ttl, read_uncommitted, published, read_cache, capacity=capacity
    )


def message_value(name, *, ttl=None, read_uncommitted=None):
    """A single delivered message per key."""
    return Collection(name, "value", "message", ttl, read_uncommitted)


def message_map(name, *, ttl=None, read_uncommitted=None, keyset_limit=None):
    """An ordered map of delivered messages with text keys."""
    return Collection(
        name, "map", "message", ttl, read_uncommitted, keyset_limit=keyset_limit
    )


def message_deque(name, *, ttl=None, read_uncommitted=None, capacity=None):
    """A double-ended queue of delivered messages."""
    return Collection(name, "deque", "message", ttl, read_uncommitted, capacity=capacity)


def _whole(number: float | None, field: str, low: int, high: int = U32_MAX) -> None:
    if number is None:
        return
    wrong_type = isinstance(number, bool) or not isinstance(number, (int, float))
    if wrong_type or not math.isfinite(number) or number != int(number) or not low <= number <= high:
        raise ValueError(f"{field}: " + WHOLE_NUMBER.format(low=low, high=high))


def check_read_cache(cache: timedelta | float | bool | None, field: str = "read_cache") -> None:
    """A reuse window for published reads: a duration, False for none, None to inherit."""
    if cache is True:
        raise ValueError(f"{field}: {AMBIGUOUS_CACHE}")
    if cache is not None and cache is not False:
        duration_us(cache, field)


def check_collections(collections: Sequence[Collection], subsystem: str | None = None) -> None:
    """Reject definitions that cannot be registered, naming the field at fault."""
    seen: set[str] = set()
    for index, definition in enumerate(collections):
        at = f"state_collections[{index}]"
        if not isinstance(definition.name, str) or not definition.name:
            raise ValueError(f"{at}.name: missing")
        if definition.name in seen:
            raise ValueError(f"{at}.name: {definition.name!r} is declared twice")
        seen.add(definition.name)
        for option, choices in (("kind", KINDS), ("payload", PAYLOADS)):
            found = getattr(definition, option)
            if found not in choices:
                problem = EXPECTED.format(choices=" or ".join(choices), found=found)
                raise ValueError(f"{at}.{option}: {problem}")
        _whole(definition.ttl_seconds, f"{at}.ttl_seconds", 0)
        for option, kind, low in (("keyset_limit", "map", 0), ("capacity", "deque", 1)):
            number = getattr(definition, option)
            if number is not None and definition.kind != kind:
                raise ValueError(f"{at}.{option}: " + ONLY_FOR.format(kind=kind))
            _whole(number, f"{at}.{option}", low)
        for option in ("read_uncommitted", "published"):
            flag = getattr(definition, option)
            if flag is not None and not isinstance(flag, bool):
                raise ValueError(f"{at}.{option}: must be true or false")
        check_read_cache(definition.read_cache, f"{at}.read_cache")
        if definition.published:
            if definition.payload != "json":
                raise ValueError(f"{at}.published: message collections cannot be published")
            if not subsystem:
                raise ValueError(f"{at}.published: needs a subsystem name")
