"""Checked settings of a run."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


def bounded_int(name: str, value: str | int, low: int, high: int) -> int:
    """An integer within bounds; anything else is an error that names the setting."""
    try:
        number = int(str(value).strip())
    except ValueError:
        raise ValueError(f"{name} must be an integer") from None
    if not low <= number <= high:
        raise ValueError(f"{name} must be from {low} to {high}")
    return number


def flag(name: str, value: str | bool) -> bool:
    """A switch: 0 or 1."""
    if str(value) not in ("0", "1", "False", "True"):
        raise ValueError(f"{name} must be 0 or 1")
    return str(value) in ("1", "True")


@dataclass(frozen=True)
class RunConfig:
    """Where a run reads and writes. reset replaces an existing table; bulk_* send documents to an index over HTTP."""

    persons: str
    organizations: str
    out: str
    reset: bool = False
    bulk_url: str = ""
    bulk_index: str = "persons"
    bulk_bytes: int = 8 * 1024 * 1024
    bulk_docs: int = 2000
    index_shards: int = 4

    def __post_init__(self):
        for f in ("persons", "organizations", "out"):
            if not getattr(self, f):
                raise ValueError(f"{f} is required")
        object.__setattr__(self, "reset", flag("reset", self.reset))
        object.__setattr__(self, "bulk_bytes", bounded_int("bulk_bytes", self.bulk_bytes, 1024, 64 * 1024 * 1024))
        object.__setattr__(self, "index_shards", bounded_int("index_shards", self.index_shards, 1, 8))
        object.__setattr__(self, "bulk_docs", bounded_int("bulk_docs", self.bulk_docs, 1, 100_000))

    @classmethod
    def from_env(cls, prefix: str = "WEFTLINE_", **given) -> RunConfig:
        """Settings from the environment (WEFTLINE_PERSONS and so on), overridden by what is given."""
        held = {f.name: os.environ[prefix + f.name.upper()] for f in fields(cls) if prefix + f.name.upper() in os.environ}
        return cls(**{"persons": "", "organizations": "", "out": "", **held, **{k: v for k, v in given.items() if v is not None}})
