"""Retrying a source: which failures pass, and how long to wait."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator
from typing import TypeVar

from ..options import CaptureOptions

R = TypeVar("R")


class SourceBusy(Exception):
    """The source's connection pool has no room."""


class NoHost(Exception):
    """No host could serve; carries what each host answered."""

    def __init__(self, errors: list[BaseException]):
        super().__init__(f"{len(errors)} hosts failed")
        self.errors = errors


TRANSIENT = (SourceBusy, TimeoutError, ConnectionError)


def is_transient(error: BaseException | None) -> bool:
    """Whether anything in the chain of causes is a failure that may pass; what was merely being handled is no cause."""
    seen: set[int] = set()
    while error is not None and id(error) not in seen:
        seen.add(id(error))
        if isinstance(error, TRANSIENT) or (isinstance(error, NoHost) and any(isinstance(x, TRANSIENT) for x in error.errors)):
            return True
        error = error.__cause__
    return False


def delays(o: CaptureOptions, rng: Callable[[], float] = random.random) -> Iterator[float]:
    """Milliseconds before each further attempt: doubled up to a cap, less a random part."""
    step = o.retry_base
    while True:
        wait = min(step, o.retry_cap)
        yield wait - wait * o.retry_jitter / 100 * rng()
        step = min(step * 2, o.retry_cap)


def call(f: Callable[[], R], o: CaptureOptions, sleep: Callable[[float], None] = time.sleep) -> R:
    for attempt, wait in enumerate(delays(o), 1):
        try:
            return f()
        except Exception as e:
            if not is_transient(e) or (o.retry_attempts != -1 and attempt >= o.retry_attempts):
                raise
        sleep(wait / 1000)
    raise AssertionError("unreachable")
