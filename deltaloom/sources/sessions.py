"""Connections that equal settings share: counted references, one per process (and so per executor)."""

from __future__ import annotations

import threading
from collections.abc import Callable, Mapping
from typing import Any

#: Settings whose comma lists mean the same in any order; all others count as written (a cipher list is a preference).
UNORDERED = frozenset({"hosts"})


def settings_key(settings: Mapping[str, Any]) -> tuple:
    def plain(name: str, value: Any) -> Any:
        return tuple(sorted(x.strip() for x in str(value).split(","))) if name in UNORDERED and value is not None else value

    return tuple(sorted((k, plain(k, v)) for k, v in settings.items()))


class SharedSessions:
    def __init__(self, connect: Callable[[Mapping[str, Any]], Any], close: Callable[[Any], None]):
        self._connect, self._close, self._lock = connect, close, threading.Lock()
        self._held: dict[tuple, list] = {}

    def acquire(self, settings: Mapping[str, Any]) -> Any:
        """The session of these settings; a failed connect leaves nothing behind."""
        key = settings_key(settings)
        with self._lock:
            if key not in self._held:
                self._held[key] = [self._connect(settings), 0]
            self._held[key][1] += 1
            return self._held[key][0]

    def release(self, settings: Mapping[str, Any]) -> None:
        """Give one reference back; the last one closes. Releasing what isn't held does nothing."""
        key = settings_key(settings)
        with self._lock:
            if key not in self._held:
                return
            self._held[key][1] -= 1
            if self._held[key][1] > 0:
                return
            session = self._held.pop(key)[0]
        self._close(session)

    def count(self, settings: Mapping[str, Any]) -> int:
        return self._held.get(settings_key(settings), [None, 0])[1]
