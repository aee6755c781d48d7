"""Publishing all tables of a run of the flow at once."""

from __future__ import annotations

import uuid
from collections.abc import Collection, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from gaugeworks.plans.lakehouse import Domain, Lakehouse, run_lakehouse
from gaugeworks.plans.marts import MARTS
from gaugeworks.sources.shared import remove_folder
from gaugeworks.sources.snapshots import TableSet


@dataclass(frozen=True)
class PublishedLake:
    """Runs write into folders of their own; one version names the tables of the run in force.

    A run that fails, or that a gate stops, publishes nothing, so readers always have all
    tables of one and the same run. Its reports are kept, as they tell why.
    """

    root: str
    fail_on_alert: bool | Collection[str] = False

    @property
    def published(self) -> TableSet:
        return TableSet(f"{self.root.rstrip('/')}/published")

    @property
    def reports_dir(self) -> str:
        return Lakehouse(self.root).reports_dir

    def run(
        self, raw: Mapping[str, DataFrame], domain: Domain, by_network: bool = False
    ) -> int:
        """The whole flow, then one step that publishes it; returns the version."""
        spark = next(iter(raw.values())).sparkSession
        folder = f"{self.root.rstrip('/')}/runs/{uuid.uuid4().hex}"
        lake = Lakehouse(folder, self.fail_on_alert, self.root)
        try:
            tables = run_lakehouse(raw, domain, lake, by_network)
            paths = {name: lake.table_path(name) for name in [*domain.specs, domain.integrated]}
            paths |= {name: lake.mart_path(name) for name in MARTS}
            entries = {
                name: {"path": path, "schema": tables[name].schema.json()}
                for name, path in paths.items()
                if name in tables
            }
            return self.published.publish_stored(spark, entries)
        except BaseException:
            remove_folder(spark, folder)
            raise

    def tables(self, spark: SparkSession, version: int | None = None) -> dict[str, DataFrame]:
        return self.published.tables(spark, version)
