"""Options of a capture: parsed from text, checked as a whole, fixed at plan time.

Everything here runs once on the driver. What the options switch off (an image, a key, a placement) is not in the
plan at all.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field, fields, replace
from enum import Enum


class Image(str, Enum):
    """How much of a row's image an event shows."""

    NONE = "none"
    FULL = "full"
    ONLY_UPDATED = "only-updated"

    @classmethod
    def parse(cls, text: str | None) -> Image:
        return _parse(cls, text, cls.NONE)


class Format(str, Enum):
    LEGACY = "legacy"
    ADVANCED = "advanced"

    @classmethod
    def parse(cls, text: str | None) -> Format:
        return _parse(cls, text, cls.LEGACY)


class Place(str, Enum):
    """Where the primary key goes."""

    KAFKA_KEY = "kafka-key"
    PAYLOAD_AFTER = "payload-after"
    PAYLOAD_BEFORE = "payload-before"
    PAYLOAD_DIFF = "payload-diff"  # accepted, reserved, without effect
    PAYLOAD_KEY = "payload-key"
    KAFKA_HEADERS = "kafka-headers"


def _parse(kind, text: str | None, default):
    try:
        return kind((text or "").strip().lower())
    except ValueError:
        return default


DEFAULT_PLACES = frozenset({Place.KAFKA_KEY, Place.PAYLOAD_AFTER, Place.PAYLOAD_BEFORE})
NAME = re.compile(r"[a-zA-Z_0-9]{1,48}\Z")
HOST = re.compile(r"[^:\s]+:\d{1,5}\Z")


def parse_places(text: str | None) -> frozenset[Place]:
    """Known places of a comma list; unknown ones are dropped. Null gives the default."""
    if text is None:
        return DEFAULT_PLACES
    found = (_parse(Place, x, None) for x in text.split(","))
    return frozenset(x for x in found if x)


def parse_tables(text: str) -> frozenset[tuple[str, str]]:
    """`ks.table, ks.table` as a set; white space is free. Raises ValueError for a malformed name."""
    out = set()
    for item in (x.strip() for x in text.split(",")):
        ks, dot, name = item.partition(".")
        if not dot or not NAME.match(ks.strip()) or not NAME.match(name.strip()):
            raise ValueError(f"not a table name: {item!r}")
        out.add((ks.strip(), name.strip()))
    return frozenset(out)


#: Settings by their names in a configuration (fixed values).
NAMES = {
    "topic.prefix": "logical_name", "cluster.ip.addresses": "hosts", "table.names": "tables", "user": "user", "password": "password",
    "query.time.window.size": "query_window", "confidence.window.size": "confidence_window", "minimal.wait.for.window.time": "minimal_wait",
    "initial.lookback.ms": "lookback", "cdc.incomplete.task.timeout.ms": "incomplete_timeout", "heartbeat.interval.ms": "heartbeat",
    "worker.retry.backoff.base": "retry_base", "worker.maximum.backoff": "retry_cap", "worker.jitter.percentage": "retry_jitter",
    "worker.max.retries": "retry_attempts", "cdc.include.primary-key.payload-key-name": "payload_key_name", "experimental.preimages.enabled": "preimages",
}
IMAGE_NAMES = {"cdc.output.format", "cdc.include.before", "cdc.include.after", "cdc.include.primary-key.placement"}
#: Worker settings of the connection, passed through (fixed values).
WORKER_NAMES = {
    "worker.config", "worker.shared.session.enabled", "worker.pooling.core.pool.local", "worker.pooling.max.pool.local", "worker.pooling.max.queue.size",
    "worker.pooling.max.requests.per.connection", "worker.pooling.pool.timeout.ms",
}


@dataclass(frozen=True)
class CaptureOptions:
    """All settings of a capture; durations are in milliseconds."""

    logical_name: str = ""
    hosts: str = ""
    tables: str = ""
    user: str | None = None
    password: str | None = None
    format: Format = Format.ADVANCED
    before: Image = Image.NONE
    after: Image = Image.NONE
    places: frozenset[Place] = DEFAULT_PLACES
    places_text: str | None = None
    payload_key_name: str = "key"
    preimages: bool = False
    wait_preimage_for_partition_delete: bool = False
    query_window: int = 30_000
    confidence_window: int = 30_000
    minimal_wait: int = 0
    lookback: int = 0
    incomplete_timeout: int = 15_000
    heartbeat: int = 30_000
    retry_base: int = 50
    retry_cap: int = 30_000
    retry_jitter: int = 20
    retry_attempts: int = 20
    source_options: Mapping[str, str] = field(default_factory=dict)  # connection settings, passed through
    unknown: tuple[str, ...] = ()  # settings that would have no effect

    @classmethod
    def from_config(cls, config: Mapping[str, str], prefix: str = "") -> CaptureOptions:
        """From text settings by their dotted names, a vendor's `prefix` in front or not.

        Connection settings are source options; a `worker.` name that nobody knows is an error, as it would change nothing.
        """
        config = {k.removeprefix(prefix): v for k, v in config.items()}
        kinds = {f.name: f.type for f in fields(cls)}
        made: dict = {"format": Format.parse(config.get("cdc.output.format")), "before": Image.parse(config.get("cdc.include.before")),
                      "after": Image.parse(config.get("cdc.include.after")), "places": parse_places(config.get("cdc.include.primary-key.placement")),
                      "places_text": config.get("cdc.include.primary-key.placement")}
        rest, unknown = {}, []
        for key, text in config.items():
            if key in NAMES:
                kind = kinds[NAMES[key]]
                made[NAMES[key]] = int(text) if kind == "int" else str(text).strip().lower() == "true" if kind == "bool" else text
            elif key.startswith("worker.") and key not in WORKER_NAMES:
                unknown.append(key)
            elif key not in IMAGE_NAMES:
                rest[key] = text
        return cls(**made, source_options=rest, unknown=tuple(unknown))

    def with_(self, **changes) -> CaptureOptions:
        return replace(self, **changes)

    @property
    def needs_pre(self) -> bool:
        return self.before is not Image.NONE

    @property
    def needs_post(self) -> bool:
        return self.after is not Image.NONE

    def errors(self) -> list[str]:
        """Every reason why these options can't run; empty if there is none."""
        out = []
        if self.hosts and not all(HOST.match(x.strip()) for x in self.hosts.split(",")):
            out.append("hosts: each must be ip:port with a numeric port of at most 5 digits")
        if self.tables:
            try:
                parse_tables(self.tables)
            except ValueError as e:
                out.append(f"tables: {e}")
        if self.format is Format.ADVANCED and self.preimages:
            out.append("preimages: only the legacy format has this option")
        if self.format is Format.LEGACY:
            for name in ("before", "after"):
                if getattr(self, name) is not Image.NONE:
                    out.append(f"{name}: must be none in the legacy format")
            if self.places != DEFAULT_PLACES:
                out.append("places: must be the default in the legacy format")
        elif self.places_text is not None:
            unknown = [x.strip() for x in self.places_text.split(",") if x.strip() and _parse(Place, x, None) is None]
            if unknown:
                out.append(f"places: unknown {', '.join(unknown)}")
            if not self.places and not unknown:
                out.append("places: at least one is needed")
        if not (self.retry_attempts == -1 or self.retry_attempts >= 1):
            out.append("retry_attempts: -1 or at least 1")
        out += [f"{name}: no such setting" for name in self.unknown]
        if self.heartbeat <= 0:
            out.append("heartbeat: must be positive")
        if (self.user is None) != (self.password is None):
            out.append("user and password: both or neither")
        return out

    def checked(self) -> CaptureOptions:
        if found := self.errors():
            raise ValueError("; ".join(found))
        return self
