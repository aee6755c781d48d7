"""The whole flow: clean tables, quality reports, integration and marts.

Every table is written once and read back. Later steps use the stored table, so
no lineage is computed twice, a lost executor costs one table at most, and the
planner knows the true size of every join side.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Collection, Mapping
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import DataFrame

from gaugeworks.operators.integrate import (
    city_dimension,
    integrate,
    integration_report,
    state_dimension,
)
from gaugeworks.operators.quality import (
    QualityAlert,
    domain_offenders,
    quality_gate,
    quality_suite,
)
from gaugeworks.operators.standardise import rejected_rows, standardise_entity
from gaugeworks.plans.concurrent import concurrently
from gaugeworks.plans.marts import MARTS, ROWWISE, trend_from_tables
from gaugeworks.sources.reports import save_report, utc_now
from gaugeworks.sources.shared import materialise, remove_folder, replace_folder
from gaugeworks.sources.tables import publish_table, read_table, write_table
from gaugeworks.spec import EntitySpec, IndicatorLayout

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Lakehouse:
    """Where tables and reports are stored, and which jobs alerts stop.

    ``fail_on_alert`` holds for all entities, or for those it names. Reports lie under
    ``reports_root`` if that is given.
    """

    root: str
    fail_on_alert: bool | Collection[str] = False
    reports_root: str | None = None

    def stops(self, entity: str) -> bool:
        if isinstance(self.fail_on_alert, bool):
            return self.fail_on_alert
        return entity in self.fail_on_alert

    def table_path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/silver/{name}"

    def rejects_path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/silver_rejects/{name}"

    def mart_path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/gold/{name}"

    @property
    def reports_dir(self) -> str:
        return f"{(self.reports_root or self.root).rstrip('/')}/quality_reports"

    @property
    def offenders_dir(self) -> str:
        return f"{(self.reports_root or self.root).rstrip('/')}/quality_offenders"


@dataclass(frozen=True)
class Domain:
    """Specs of one subject area and the role each entity plays."""

    specs: Mapping[str, EntitySpec]
    layout: IndicatorLayout
    states: str
    cities: str
    national_targets: str
    state_targets: str
    city_targets: str
    students: str
    integrated: str


def run_entity(
    raw: DataFrame,
    spec: EntitySpec,
    lake: Lakehouse,
    references: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Clean, check and store one entity; returns the stored table.

    Rows that cleaning drops for a mandatory column are stored beside it. Rules are
    measured on stored columns. If alerts must keep the table from being published, it
    is written to a folder beside its place and takes that place once it has passed.
    """
    clean = standardise_entity(raw, spec, rebalance=True)
    path = lake.table_path(spec.name)
    if spec.mandatory:
        write_table(rejected_rows(raw, spec), lake.rejects_path(spec.name))
    if lake.stops(spec.name):
        beside = f"{path}.staged-{uuid.uuid4().hex}"
        staged = publish_table(clean, beside, spec.partition_by, rebalance=False)
        try:
            _check(raw, staged, spec, lake, references)
        except QualityAlert:
            remove_folder(raw.sparkSession, beside)
            raise
        replace_folder(raw.sparkSession, beside, path)
        return read_table(raw.sparkSession, path, schema=clean.schema).select(*clean.columns)
    stored = publish_table(clean, path, spec.partition_by, rebalance=False)
    _check(raw, stored, spec, lake, references)
    return stored


def _check(
    raw: DataFrame,
    df: DataFrame,
    spec: EntitySpec,
    lake: Lakehouse,
    references: Mapping[str, DataFrame] | None,
) -> None:
    """Store the report; after an alert also every value outside its domain."""
    run_id = f"{spec.name}-{uuid.uuid4().hex}"
    report = materialise(quality_suite(df, spec, references, raw), f"report-{spec.name}")
    save_report(report, lake.reports_dir, run_id, utc_now())
    if not quality_gate(report, fail_on_alert=False):
        return
    log.warning("quality alerts in %s", spec.name)
    offenders = [
        domain_offenders(df, spec.name, rule) for rule in spec.domains if rule.column in df.columns
    ]
    if offenders:
        every = reduce(DataFrame.unionByName, offenders)
        write_table(every, f"{lake.offenders_dir}/run_id={run_id}")
    if lake.stops(spec.name):
        quality_gate(report, fail_on_alert=True)


def run_integration(
    tables: Mapping[str, DataFrame], domain: Domain, lake: Lakehouse, by_network: bool = False
) -> DataFrame:
    """Integrate the stored tables and store the result by year.

    The check of the result is reported, it never stops the job.
    """
    layout = domain.layout
    cities, states = tables["cities"], tables["states"]
    state_targets = tables[domain.state_targets]
    national_targets = tables[domain.national_targets]
    integrated = integrate(
        tables[domain.city_targets],
        cities,
        states,
        state_targets,
        national_targets,
        layout,
        by_network,
        rebalance=True,
    )
    path = lake.table_path(domain.integrated)
    stored = publish_table(integrated, path, [layout.year], rebalance=False)
    report = integration_report(
        stored, cities, state_targets, national_targets, layout, domain.integrated
    )
    save_report(report, lake.reports_dir, f"{domain.integrated}-{uuid.uuid4().hex}", utc_now())
    return stored


def run_marts(
    integrated: DataFrame,
    layout: IndicatorLayout,
    lake: Lakehouse,
    built: Mapping[str, DataFrame] | None = None,
) -> dict:
    """Build and store all marts, partitioned by year.

    ``built`` holds marts that are made of other tables than the integrated one, which is
    stored by year. A mart with a row for each of its rows is thus written as its files come.
    """
    built = built or {}

    def mart(name: str) -> DataFrame:
        df = built[name] if name in built else MARTS[name](integrated, layout)
        rowwise = name in ROWWISE and name not in built
        return publish_table(df, lake.mart_path(name), [layout.year], rebalance=not rowwise)

    return concurrently(integrated.sparkSession, {name: partial(mart, name) for name in MARTS})


def run_lakehouse(
    raw: Mapping[str, DataFrame], domain: Domain, lake: Lakehouse, by_network: bool = False
) -> dict[str, DataFrame]:
    """Dimensions, then targets and students, then integration, then marts.

    ``raw`` maps entity names to source tables. Returns every stored table.
    """
    layout = domain.layout

    def entity(name: str, references: Mapping[str, DataFrame] | None = None) -> DataFrame:
        return run_entity(raw[name], domain.specs[name], lake, references)

    tables: dict[str, DataFrame] = {}
    tables[domain.states] = entity(domain.states)
    tables["states"] = materialise(state_dimension(tables[domain.states], layout), "states")
    refs = {domain.states: tables["states"]}
    tables[domain.cities] = entity(domain.cities, refs)
    tables["cities"] = materialise(city_dimension(tables[domain.cities], layout), "cities")
    refs[domain.cities] = tables["cities"]

    facts = (
        domain.national_targets,
        domain.state_targets,
        domain.city_targets,
        domain.students,
    )
    jobs = {name: partial(entity, name, refs) for name in facts}
    tables.update(concurrently(tables[domain.states].sparkSession, jobs))

    tables[domain.integrated] = run_integration(tables, domain, lake, by_network)
    targets = (tables[domain.city_targets], tables["cities"], tables[domain.state_targets], tables[domain.national_targets])
    trend = trend_from_tables(*targets, layout, by_network)
    tables.update(run_marts(tables[domain.integrated], layout, lake, {"gold_evolucao_temporal": trend}))
    return tables
