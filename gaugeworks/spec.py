"""Declarative descriptions of tables.

A spec says what a table looks like and which rules it has to meet; the
operators turn it into DataFrame transformations. Everything here is plain,
immutable data, so a spec can be shared by the batch and the streaming path.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class WideTarget:
    """One target column per year, resolved to the target of the row's own year."""

    output: str
    year_column: str
    columns: tuple[tuple[int, str], ...]


@dataclass(frozen=True)
class RangeRule:
    """Values outside [low, high] violate ``rule``; null does not."""

    rule: str
    column: str
    low: float
    high: float


@dataclass(frozen=True)
class DomainRule:
    """Values outside ``allowed`` violate ``rule``; null does as well."""

    rule: str
    column: str
    allowed: tuple[str, ...]


@dataclass(frozen=True)
class ForeignKey:
    """``column`` must exist as ``ref_column`` in the table named ``entity``."""

    column: str
    entity: str
    ref_column: str | None = None

    @property
    def target_column(self) -> str:
        return self.ref_column or self.column


@dataclass(frozen=True)
class EntitySpec:
    """How one table is cleaned, checked and stored.

    Columns named here but missing from a source are skipped, so one spec
    serves narrow and wide sources; columns not named pass through untouched.
    """

    name: str
    renames: tuple[tuple[str, str], ...] = ()
    mandatory: tuple[str, ...] = ()
    text_columns: tuple[str, ...] = ()
    code_columns: tuple[str, ...] = ()
    padded_keys: tuple[tuple[str, int], ...] = ()
    numeric_columns: tuple[str, ...] = ()
    dedup_keys: tuple[str, ...] = ()
    latest_by: str = "_ingested_at"
    wide_target: WideTarget | None = None
    ranges: tuple[RangeRule, ...] = ()
    domains: tuple[DomainRule, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    partition_by: tuple[str, ...] = ()
    missing_suffix: str = "_ausente"
    audit_column: str = "_silver_processed_at"


@dataclass(frozen=True)
class IndicatorLayout:
    """Column names used by the integration and the marts."""

    year: str
    network: str
    city: str
    city_name: str
    state: str
    state_name: str
    result: str
    target: str
    participation: str
    level: str
    reached: str
    state_suffix: str
    nation_suffix: str
    audit_column: str = "_silver_processed_at"

    @property
    def state_result(self) -> str:
        return self.result + self.state_suffix

    @property
    def state_target(self) -> str:
        return self.target + self.state_suffix

    @property
    def nation_result(self) -> str:
        return self.result + self.nation_suffix

    @property
    def nation_target(self) -> str:
        return self.target + self.nation_suffix
