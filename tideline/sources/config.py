"""Configuration: sources, mappings, filters (SC13, FL1-FL3 and their builders)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from tideline.functions.types import Override

OPS = ("insert", "update", "delete")


def _names(value: Any) -> tuple[str, ...]:
    return tuple(value or ()) if not isinstance(value, str) else (value,)


@dataclass(frozen=True)
class Source:
    """A named origin and what is replicated of it."""

    name: str
    type: str = "mysql"
    schema_mappings: Mapping[str, str] = field(default_factory=dict)
    limit_tables: tuple[str, ...] = ()
    skip_tables: tuple[str, ...] = ()
    skip_events: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    grant_select_to: tuple[str, ...] = ()
    replica_batch_size: int = 10_000
    replay_max_rows: int = 10_000
    batch_retention: str = "1 day"
    copy_max_memory: str = "300M"
    on_error_replay: str = "continue"
    auto_maintenance: str = "disabled"
    gtid_enable: bool = False
    keep_existing_schema: bool = False
    sleep_loop: float = 1

    def __post_init__(self) -> None:
        if self.type not in ("mysql", "pgsql"):
            raise ValueError(f"source {self.name}: type is mysql or pgsql")
        if self.on_error_replay not in ("continue", "exit"):
            raise ValueError(f"source {self.name}: on_error_replay is continue or exit")
        unknown = set(self.skip_events) - set(OPS)
        if unknown:
            raise ValueError(f"source {self.name}: skip_events has {sorted(unknown)}")


@dataclass(frozen=True)
class Config:
    sources: Mapping[str, Source]
    type_override: Mapping[str, Override] = field(default_factory=dict)
    fillfactor: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    @classmethod
    def of(cls, raw: Mapping[str, Any]) -> "Config":
        """From the nested mapping of a YAML file. Keys of a source that concern connections are left out."""
        sources = {}
        for name, given in (raw.get("sources") or {}).items():
            given = dict(given or {})
            # Some files nest a source's settings below its connection.
            given = {k: v for k, v in (given.get("db_conn") or {}).items() if k not in given} | given
            known = {k: v for k, v in given.items() if k in Source.__dataclass_fields__ and k != "name" and v is not None}
            for key in ("limit_tables", "skip_tables", "grant_select_to"):
                known[key] = _names(known.get(key))
            known["skip_events"] = {op: _names(v) for op, v in (known.get("skip_events") or {}).items() if v}
            sources[name] = Source(name=name, **known)
        overrides = {k.lower(): Override(v["override_to"], _names(v.get("override_tables") or "*")) for k, v in (raw.get("type_override") or {}).items()}
        fill = {str(k): _names((v or {}).get("tables")) for k, v in (raw.get("fillfactor") or {}).items()}
        return cls(sources, overrides, fill)

    @classmethod
    def load(cls, path: str | Path) -> "Config":
        import yaml

        return cls.of(yaml.safe_load(Path(path).read_text()) or {})

    def fill_factor(self, table: str) -> int:
        """SK13: the last level that names the table or ``*``, else 100. Kept as metadata."""
        levels = [int(level) for level, tables in self.fillfactor.items() if table in tables or "*" in tables]
        return levels[-1] if levels else 100


@dataclass(frozen=True)
class TableRules:
    """FL1, FL3: which tables of a schema count. A limit entry that names only a schema means all its tables."""

    limit: Mapping[str, frozenset[str] | None]
    skip: Mapping[str, frozenset[str]]

    @classmethod
    def of(cls, source: Source, tables: str | None = None) -> "TableRules":
        """``tables`` is a comma list as a command line gives it: met with the limits, free in schemas without one."""
        limit: dict[str, set[str] | None] = {}
        for entry in source.limit_tables:
            schema, _, table = entry.partition(".")
            if not table:
                limit[schema] = None
            elif limit.get(schema, set()) is not None:
                limit.setdefault(schema, set()).add(table)
        if tables and tables != "*":
            asked: dict[str, set[str]] = {}
            for entry in tables.split(","):
                schema, _, table = entry.strip().partition(".")
                asked.setdefault(schema, set()).add(table)
            limit = {s: (t if limit.get(s) is None else t & limit[s]) for s, t in asked.items()}
        skip: dict[str, set[str]] = {}
        for entry in source.skip_tables:
            schema, _, table = entry.partition(".")
            skip.setdefault(schema, set()).add(table)
        return cls({s: None if t is None else frozenset(t) for s, t in limit.items()}, {s: frozenset(t) for s, t in skip.items()})

    def keeps(self, schema: str, table: str) -> bool:
        if table in self.skip.get(schema, ()):
            return False
        limits = self.limit.get(schema)
        return limits is None or table in limits


def duplicate_destinations(mappings: Mapping[str, Mapping[str, str]]) -> list[str]:
    """A2: destinations that more than one origin schema maps to, over all sources."""
    seen: dict[str, int] = {}
    for own in mappings.values():
        for destination in own.values():
            seen[destination] = seen.get(destination, 0) + 1
    return sorted(d for d, n in seen.items() if n > 1)
