"""Settings from the environment, a TOML file and defaults, in this order."""

from __future__ import annotations

import os
import tomllib
from dataclasses import dataclass, fields
from pathlib import Path

SOURCES = ("live", "db")


def choose_source(asked: str | None, warehouse: str | None) -> str:
    """``live`` or ``db`` in any case; without a choice db where there is a warehouse."""
    if asked is None:
        return "db" if warehouse else "live"
    if asked.lower() not in SOURCES:
        raise ValueError(f"source must be one of {', '.join(SOURCES)}, not {asked!r}")
    return asked.lower()


@dataclass
class Settings:
    warehouse: str | None = None
    vendor_folder: str | None = None
    vendor_transport: str | None = None
    rate_per_minute: int = 280
    overlap_days: int = 5
    outlier_threshold: float = 0.5
    source: str | None = None

    @classmethod
    def load(cls, path: str | None = None, env: dict[str, str] | None = None) -> Settings:
        env = dict(os.environ) if env is None else env
        stored = tomllib.loads(Path(path).read_text()) if path and Path(path).exists() else {}
        out = cls()
        for f in fields(cls):
            value = env.get(f"TICKERFORGE_{f.name.upper()}", stored.get(f.name))
            if value is not None:
                kind = {"rate_per_minute": int, "overlap_days": int, "outlier_threshold": float}.get(f.name, str)
                setattr(out, f.name, kind(value))
        out.source = choose_source(out.source, out.warehouse)
        return out
