"""A user's handler per key, on Spark's ``transformWithState``."""

from keyfold.streaming.correlate import correlate
from keyfold.streaming.lateness import LateRowGuard
from keyfold.streaming.messages import EventHandler, ExciseMessage, Message, Timer
from keyfold.streaming.process import (
    call_rows,
    check_no_late_rows,
    collection_rows,
    committed_state,
    dead_letter_rows,
    output_rows,
    parked_rows,
    process_keyed,
    publish_state,
    response_rows,
    telemetry_rows,
)

__all__ = [
    "EventHandler", "ExciseMessage", "LateRowGuard", "Message", "Timer", "call_rows",
    "check_no_late_rows", "collection_rows", "committed_state", "correlate",
    "dead_letter_rows", "output_rows",
    "parked_rows", "process_keyed", "publish_state",
    "response_rows", "telemetry_rows",
]
