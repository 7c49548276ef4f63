"""Declarative dataset specifications.

A dataset is described by data, not code: a contract (ordered ``FieldMap``s),
an ordered rule list, merge keys and sequence, and hash / drift settings. All
pipeline functions read these frozen dataclasses; nothing reads module globals.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

TEXT_TRANSFORMS = ("upper", "lower", "initcap", "trim")
CONTRACT_TYPES = ("string", "int", "bigint", "long", "double", "date",
                  "timestamp", "timestamp_ntz", "boolean")
HASH_KINDS = ("text", "key", "number", "date")


@dataclass(frozen=True)
class FieldMap:
    """One contract field: where it comes from and what it becomes.

    ``src`` defaults to the field name. ``transforms`` run after the cast
    (text fields only).
    """

    name: str
    dtype: str
    src: str | None = None
    transforms: tuple[str, ...] = ()
    nullable: bool = True

    def __post_init__(self):
        if self.dtype not in CONTRACT_TYPES:
            raise ValueError(f"field {self.name}: unknown type {self.dtype!r}")
        for t in self.transforms:
            if t not in TEXT_TRANSFORMS:
                raise ValueError(f"field {self.name}: unknown transform {t!r}")
        if self.transforms and self.dtype != "string":
            raise ValueError(f"field {self.name}: transforms need a string field")

    @property
    def source(self) -> str:
        return self.src or self.name


@dataclass(frozen=True)
class Rule:
    """A row rule. ``predicate`` is a Spark SQL boolean expression that must hold.

    ``fields`` are the contract fields the predicate reads: a NULL in any of
    them is reported as ``null_<field>`` (and a NaN / infinity in a double as
    ``not_finite_<field>``) before the rule itself, so no row is left out of
    both the valid and the quarantined side. ``not_null`` rules report
    ``missing_<field>``.
    """

    name: str
    predicate: str
    reason: str
    fields: tuple[str, ...] = ()
    not_null: bool = False

    @staticmethod
    def required(field_name: str) -> "Rule":
        return Rule(f"{field_name}_nn", f"{field_name} IS NOT NULL",
                    f"missing_{field_name}", (field_name,), not_null=True)


@dataclass(frozen=True)
class HashPart:
    """A raw (bronze) column that takes part in the record hash."""

    column: str
    kind: str = "text"

    def __post_init__(self):
        if self.kind not in HASH_KINDS:
            raise ValueError(f"hash part {self.column}: unknown kind {self.kind!r}")


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    fields: tuple[FieldMap, ...]
    rules: tuple[Rule, ...] = ()
    keys: tuple[str, ...] = ()
    sequence: tuple[str, ...] = ("_ingest_ts",)
    hash_parts: tuple[HashPart, ...] = ()
    required_columns: tuple[str, ...] = ()
    known_columns: tuple[str, ...] = ()
    drift_fields: tuple[tuple[str, str], ...] = ()
    promote: tuple[tuple[str, str], ...] = ()
    business_date: str | None = None
    track: tuple[str, ...] | None = None

    def __post_init__(self):
        names = [f.name for f in self.fields]
        if len(set(names)) != len(names):
            raise ValueError(f"dataset {self.name}: duplicate contract field")
        for r in self.rules:
            for f in r.fields:
                if f not in names:
                    raise ValueError(f"rule {r.name}: unknown field {f}")
        for k in self.keys:
            if k not in names:
                raise ValueError(f"dataset {self.name}: unknown key {k}")

    @property
    def field_names(self) -> list[str]:
        return [f.name for f in self.fields]

    def field(self, name: str) -> FieldMap:
        for f in self.fields:
            if f.name == name:
                return f
        raise KeyError(name)

    @property
    def tracked(self) -> list[str]:
        """Columns whose change opens a new type-2 version."""
        if self.track is not None:
            return list(self.track)
        return [f.name for f in self.fields
                if not f.name.startswith("_") and f.name not in self.keys]


@dataclass(frozen=True)
class Settings:
    """Run-level policy. Defaults are the fixed values of the original pipeline."""

    # Late-arrival window 7 days, de-duplication watermark 3 days,
    # freshness limit 24 hours, maximum quarantine rate 0.05, maximum join drop
    # 0.02 (current) and 0.02 (as-of), maximum type-drift rate 0.001, maximum
    # corrupt rate 0.001, maximum rescued rate 0.02, quarantine retention 30 days,
    # 1000 files per micro-batch, backfill window 1900-01-01 .. 2999-12-31,
    # calendar 2020-01-01 .. 2030-12-31, run id "manual_run".
    late_window_days: int = 7
    watermark_days: int = 3
    freshness_sla_hours: int = 24
    guardrails_enforced: bool = True
    max_quarantine_rate: float = 0.05
    max_join_drop_rate_current: float = 0.02
    max_join_drop_rate_asof: float = 0.02
    max_type_drift_rate: float = 0.001
    max_corrupt_rate: float = 0.001
    max_rescued_rate: float = 0.02
    quarantine_retention_days: int = 30
    max_files_per_trigger: int = 1000
    replay_enabled: bool = False
    replay_id: str | None = None
    backfill_enabled: bool = False
    backfill_start: str = "1900-01-01"
    backfill_end: str = "2999-12-31"
    backfill_id: str | None = None
    backfill_reason: str | None = None
    run_id: str = "manual_run"
    calendar_start: str = "2020-01-01"
    calendar_end: str = "2030-12-31"
    now: str | None = None
    extra: dict = field(default_factory=dict, compare=False, hash=False)

    def __post_init__(self):
        if self.replay_enabled and self.replay_id is None:
            raise ValueError("replay_enabled requires replay_id")
        if self.backfill_enabled and (self.backfill_id is None or self.backfill_reason is None):
            raise ValueError("backfill_enabled requires backfill_id and backfill_reason")
        lo = _dt.date.fromisoformat(self.backfill_start)
        hi = _dt.date.fromisoformat(self.backfill_end)
        if lo > hi:
            raise ValueError("backfill_start is after backfill_end")
        if _dt.date.fromisoformat(self.calendar_start) > _dt.date.fromisoformat(self.calendar_end):
            raise ValueError("calendar_start is after calendar_end")
