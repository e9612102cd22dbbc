"""Configuration from JSON or YAML, merged over defaults section by section."""

from __future__ import annotations

import json
from dataclasses import dataclass, field, fields, replace
from pathlib import Path


@dataclass(frozen=True)
class Ingest:
    max_workers: int = 4
    timeout_s: float = 30.0
    attempts: int = 3
    wait_multiplier: float = 2.0
    lookback_days: int = 14
    drop_corrections: bool = False


@dataclass(frozen=True)
class Dedupe:
    title_threshold: float = 0.85
    date_window_days: int = 7

    def __post_init__(self):
        if not 0 <= self.title_threshold <= 1:
            raise ValueError("title_threshold must lie between 0 and 1")


@dataclass(frozen=True)
class History:
    allow_after_days: int = 90
    suppress_emitted: bool = True


@dataclass(frozen=True)
class Config:
    feeds: tuple[dict, ...] = ()
    ingest: Ingest = field(default_factory=Ingest)
    dedupe: Dedupe = field(default_factory=Dedupe)
    history: History = field(default_factory=History)


def load(path: str | None) -> Config:
    """Defaults without a path; an error for a missing file or another suffix."""
    if path is None:
        return Config()
    p = Path(path)
    if p.suffix == ".json":
        raw = json.loads(p.read_text())
    elif p.suffix in (".yaml", ".yml"):
        import yaml

        raw = yaml.safe_load(p.read_text()) or {}
    else:
        raise ValueError(f"configuration must be JSON or YAML: {path}")
    return from_dict(raw)


def from_dict(raw: dict) -> Config:
    """A nested value replaces the default as a whole; unknown keys are ignored."""
    kinds = {"ingest": Ingest, "dedupe": Dedupe, "history": History}
    made = {k: t(**{f.name: raw[k][f.name] for f in fields(t) if f.name in raw[k]}) for k, t in kinds.items() if raw.get(k)}
    return Config(feeds=tuple(raw.get("feeds", ())), **made)


def override(config: Config, section: str, **values) -> Config:
    """Only values that are not None replace those of the configuration."""
    given = {k: v for k, v in values.items() if v is not None}
    return replace(config, **{section: replace(getattr(config, section), **given)}) if given else config


def effective_days(since: int | None, lookback: int) -> int:
    """0 and None both mean the default."""
    return since or lookback
