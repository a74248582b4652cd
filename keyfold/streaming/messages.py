"""What a handler receives."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from typing import Any

from keyfold.errors import PermanentError
from keyfold.functions.times import HALF_SECOND_US, SECOND_US

_EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)
_DELIVERED = object()
_encode = json.JSONEncoder(ensure_ascii=False).encode


def to_us(moment: datetime) -> int:
    """Epoch microseconds; a time without a zone is UTC."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return (moment - _EPOCH) // timedelta(microseconds=1)


def from_us(micros: int) -> datetime:
    return _EPOCH + timedelta(microseconds=micros)


def nearest_second(moment: datetime) -> int:
    """Timers have whole-second precision: nearest second, half rounds up."""
    return (to_us(moment) + HALF_SECOND_US) // SECOND_US


@dataclass(frozen=True)
class ExciseMessage:
    """The command to delete everything held for a key; it has no payload."""

    topic: str
    partition: int
    offset: int
    timestamp: datetime
    key: str
    headers: dict[str, str] = field(default_factory=dict, compare=False)


@dataclass(frozen=True)
class Message(ExciseMessage):
    """One delivered event. One built by hand cannot be stored in a collection."""

    payload: Any = None
    _origin: object = field(default=None, repr=False, compare=False)

    @property
    def delivered(self) -> bool:
        return self._origin is _DELIVERED

    def to_text(self) -> str:
        """The message as stored in a collection."""
        return _encode(
            [self.topic, self.partition, self.offset, to_us(self.timestamp), self.key,
             self.headers, self.payload]
        )

    @classmethod
    def from_text(cls, text: str) -> Message:
        topic, partition, offset, micros, key, headers, payload = json.loads(text)
        return cls(topic, partition, offset, from_us(micros), key, headers, payload, _DELIVERED)


def deliver(topic, partition, offset, micros, key, headers, payload) -> ExciseMessage:
    """The record as the handler sees it; null payload text is an excise record."""
    place = (topic, partition, offset, from_us(micros), key, headers or {})
    if payload is None:
        return ExciseMessage(*place)
    try:
        body = json.loads(payload)
    except ValueError as cause:
        # No retry can mend the text.
        raise PermanentError(f"payload is not JSON: {cause}") from cause
    return Message(*place, body, _DELIVERED)


@dataclass(frozen=True)
class Timer:
    """A timer that fires for a key."""

    key: str
    time: datetime


class EventHandler:
    """Base for handlers; methods may be plain or ``async``.

    ``on_message`` and ``on_excise`` return a JSON value, which answers the event if
    it is a request. ``on_timer`` returns nothing.
    """

    def on_message(self, context, message):
        raise NotImplementedError

    def on_excise(self, context, message):
        raise NotImplementedError

    def on_timer(self, context, timer):
        raise NotImplementedError


def check_handler(handler: Any) -> None:
    """A handler needs all three methods before anything is consumed."""
    for name in ("on_message", "on_excise", "on_timer"):
        method = getattr(handler, name, None)
        inherited = getattr(type(handler), name, None) is getattr(EventHandler, name)
        if not callable(method) or inherited:
            raise TypeError(f"handler must implement {name}")
