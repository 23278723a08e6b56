"""Settings of a run: connection, replication defaults, limits and batch files."""

from __future__ import annotations

import os
import tempfile
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from .functions.names import SLOT_PREFIX


class ConfigError(ValueError):
    """A setting is missing or can't be used."""


METHODS = ("FULL_TABLE", "INCREMENTAL", "LOG_BASED")
REQUIRED = ("host", "port", "user", "password", "dbname")
#: Defaults (fixed values).
FETCH_ROWS = 20_000
MAX_RUN_SECONDS = 43_200
IDLE_SECONDS = 10_800
BATCH_ROWS = 500_000


def flag(value: Any, default: bool = False) -> bool:
    """A boolean, or the text "true" in any case; no value means the default."""
    if value is None:
        return default
    if isinstance(value, str):
        return value.lower() == "true"
    return bool(value)


@dataclass(frozen=True)
class BatchSettings:
    """Arrow files in place of records: rows of a file, and the folder that executors share."""

    rows: int = BATCH_ROWS
    root: str = field(default_factory=tempfile.gettempdir)
    format: str = "arrow"

    def __post_init__(self) -> None:
        if self.rows <= 0:
            raise ConfigError(f"a batch needs at least one row, not {self.rows}")
        if self.format != "arrow":
            raise ConfigError(f"batch files have format arrow, not {self.format!r}")
        if not os.path.isdir(self.root):
            raise ConfigError(f"the folder of batch files doesn't exist: {self.root!r}")

    @classmethod
    def of(cls, raw: Mapping[str, Any] | None) -> BatchSettings | None:
        """From a ``batch_config`` mapping; None (records) where there is none."""
        if raw is None:
            return None
        chosen: dict[str, Any] = {}
        if raw.get("batch_size") is not None:
            chosen["rows"] = int(raw["batch_size"])
        if (raw.get("storage") or {}).get("root"):
            chosen["root"] = raw["storage"]["root"]
        if (raw.get("encoding") or {}).get("format"):
            chosen["format"] = raw["encoding"]["format"]
        return cls(**chosen)


@dataclass(frozen=True)
class Settings:
    """A validated configuration."""

    host: str
    port: int
    user: str
    password: str
    dbname: str
    secondary_host: str | None = None
    secondary_port: int | None = None
    use_secondary: bool = False
    ssl: bool = False
    default_method: str | None = None
    schemas: tuple[str, ...] | None = None
    pipeline_id: str | None = None
    slot_prefixes: tuple[str, ...] = (SLOT_PREFIX,)
    fetch_rows: int = FETCH_ROWS
    limit: int | None = None
    max_run_seconds: int = MAX_RUN_SECONDS
    idle_seconds: float = IDLE_SECONDS
    break_at_end: bool = True
    debug_lsn: bool = False
    batch: BatchSettings | None = None

    @classmethod
    def of(cls, raw: Mapping[str, Any]) -> Settings:
        missing = [k for k in REQUIRED if raw.get(k) is None]
        if missing:
            raise ConfigError(f"missing settings: {', '.join(missing)}")
        method = raw.get("default_replication_method")
        if method is not None and method not in METHODS:
            raise ConfigError(f"default_replication_method is one of {', '.join(METHODS)}, not {method!r}")
        secondary = flag(raw.get("use_secondary"))
        absent = [k for k in ("secondary_host", "secondary_port") if secondary and not raw.get(k)]
        if absent:
            raise ConfigError(f"use_secondary needs {' and '.join(absent)}")
        return cls(
            host=str(raw["host"]), port=int(raw["port"]), user=str(raw["user"]), password=str(raw["password"]), dbname=str(raw["dbname"]),
            secondary_host=raw.get("secondary_host"), secondary_port=int(raw["secondary_port"]) if raw.get("secondary_port") else None, use_secondary=secondary,
            ssl=flag(raw.get("ssl")), default_method=method, schemas=schema_list(raw.get("filter_schemas")), pipeline_id=raw.get("tap_id"),
            slot_prefixes=(SLOT_PREFIX, *raw.get("slot_prefixes", ())),
            fetch_rows=int(raw.get("itersize") or FETCH_ROWS), limit=int(raw["limit"]) if raw.get("limit") else None,
            max_run_seconds=int(raw.get("max_run_seconds") or MAX_RUN_SECONDS), idle_seconds=float(raw.get("logical_poll_total_seconds") or IDLE_SECONDS),
            break_at_end=flag(raw.get("break_at_end_lsn"), True), debug_lsn=flag(raw.get("debug_lsn")), batch=BatchSettings.of(raw.get("batch_config")),
        )


def schema_list(text: str | None) -> tuple[str, ...] | None:
    """A comma-separated list of schema names; None if it names none."""
    names = tuple(s.strip() for s in (text or "").split(",") if s.strip())
    return names or None
