"""Handler and state errors, and how a failure is classified."""

from __future__ import annotations

import functools
import inspect
from collections.abc import Callable


class HandlerFailure(Exception):
    """A failure that states whether retrying can help."""

    is_permanent: bool = False


class TransientError(HandlerFailure):
    """Retrying may help."""


class PermanentError(HandlerFailure):
    """Retrying cannot help; the event is never tried again."""

    is_permanent = True


class StateError(Exception):
    """Any keyed-state failure, of either category."""


class PermanentStateError(StateError, PermanentError):
    """A deployment mistake, such as an undeclared collection."""


class TransientStateError(StateError, TransientError):
    """A caller's mistake at the state boundary; kept visible by retrying."""


class NullValueError(TransientStateError, ValueError):
    """Null is absence and cannot be stored."""


def category(error: BaseException) -> str:
    """``permanent`` if the error says so, otherwise ``transient``."""
    return "permanent" if getattr(error, "is_permanent", False) is True else "transient"


def _marking(target: type[HandlerFailure], kinds: tuple[type[BaseException], ...]) -> Callable:
    def decorate(function: Callable) -> Callable:
        if inspect.iscoroutinefunction(function):

            @functools.wraps(function)
            async def marked(*args, **kwargs):
                try:
                    return await function(*args, **kwargs)
                except kinds as error:
                    raise target(str(error)) from error
        else:

            @functools.wraps(function)
            def marked(*args, **kwargs):
                try:
                    return function(*args, **kwargs)
                except kinds as error:
                    raise target(str(error)) from error

        return marked

    return decorate


def transient(*kinds: type[BaseException]) -> Callable:
    """Decorator: raise the named exceptions as transient, keeping text and cause."""
    return _marking(TransientError, kinds)


def permanent(*kinds: type[BaseException]) -> Callable:
    """Decorator: raise the named exceptions as permanent, keeping text and cause."""
    return _marking(PermanentError, kinds)
