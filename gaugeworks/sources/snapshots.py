"""Versions of stored tables: what a reader sees changes in one step or not at all.

Data folders are written once and never changed. A version is a small numbered JSON
document that names the folders in force, and comes into being by a rename that
fails if the number is taken. So readers see a whole version, writers that meet try
again on top of the other's, and a failure anywhere leaves the last version as it was.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gaugeworks.sources.shared import hadoop_path, remove_folder
from gaugeworks.sources.tables import write_table

_NAME = re.compile(r"(\d{12})\.json$")


@dataclass(frozen=True)
class SnapshotLog:
    """Numbered versions in ``root/_versions``; ``root/_data`` holds the folders they name."""

    root: str

    def _path(self, version: int) -> str:
        return f"{self.root.rstrip('/')}/_versions/{version:012d}.json"

    def folder(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/_data/{name}"

    def versions(self, spark: SparkSession) -> list[int]:
        place, files = hadoop_path(spark, f"{self.root.rstrip('/')}/_versions")
        if not files.exists(place):
            return []
        found = [_NAME.search(status.getPath().getName()) for status in files.listStatus(place)]
        return sorted(int(m.group(1)) for m in found if m)

    def read(self, spark: SparkSession, version: int) -> dict:
        place, files = hadoop_path(spark, self._path(version))
        stream = files.open(place)
        try:
            return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self, spark: SparkSession) -> tuple[int, dict]:
        """Number and content of the last version; -1 and nothing before the first."""
        found = self.versions(spark)
        return (found[-1], self.read(spark, found[-1])) if found else (-1, {})

    def commit(self, spark: SparkSession, version: int, content: Mapping) -> bool:
        """Make a version; false if there is one of this number already."""
        target, files = hadoop_path(spark, self._path(version))
        files.mkdirs(target.getParent())
        beside, _ = hadoop_path(spark, f"{self.root.rstrip('/')}/_versions/.{uuid.uuid4().hex}")
        stream = files.create(beside, False)
        try:
            stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        finally:
            stream.close()
        try:
            return _rename_to_new(spark, beside, target)
        finally:
            files.delete(beside, False)

    def update(self, spark: SparkSession, change: Callable[[dict], Mapping | None]) -> int:
        """Make the next version from the last one, again if another writer was first.

        ``change`` takes the content and returns the new one, or None to leave it.
        """
        while True:
            version, content = self.latest(spark)
            new = change(json.loads(json.dumps(content)))
            if new is None:
                return version
            if self.commit(spark, version + 1, new):
                return version + 1

    def expire(self, spark: SparkSession, keep: int, folders: Callable[[dict], Iterable[str]]) -> None:
        """Remove all but the last ``keep`` versions, and folders that only removed ones name.

        A reader of an older version then fails instead of seeing part of it.
        """
        found = self.versions(spark)
        old, kept = found[:-keep], found[-keep:]
        if not old:
            return
        needed = {f for version in kept for f in folders(self.read(spark, version))}
        for version in old:
            for folder in set(folders(self.read(spark, version))) - needed:
                remove_folder(spark, folder)
        for version in old:
            place, files = hadoop_path(spark, self._path(version))
            files.delete(place, False)


def _rename_to_new(spark: SparkSession, source, target) -> bool:
    """Rename unless the target exists, in one step."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    options = gateway.new_array(kind, 1)
    options[0] = kind.NONE
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
    try:
        context.rename(source, target, options)
    except Exception as error:  # noqa: BLE001
        if "FileAlreadyExistsException" in str(error):
            return False
        raise
    return True


@dataclass(frozen=True)
class TableSet:
    """Several tables that are published together and read at one version."""

    root: str

    @property
    def log(self) -> SnapshotLog:
        return SnapshotLog(self.root)

    def publish(self, spark: SparkSession, tables: Mapping[str, DataFrame], partition_by: Mapping[str, Iterable[str]] | None = None) -> int:
        """Write the tables, then make the version that has all of them; others stay as they are.

        Readers of any earlier version are not disturbed, and a failure publishes nothing.
        """
        entries, written = {}, []
        try:
            for name, df in tables.items():
                path = self.log.folder(f"{name}-{uuid.uuid4().hex}")
                written.append(path)
                write_table(df, path, (partition_by or {}).get(name, ()))
                entries[name] = {"path": path, "schema": df.schema.json()}
            return self.publish_stored(spark, entries)
        except BaseException:
            for path in written:
                remove_folder(spark, path)
            raise

    def publish_stored(self, spark: SparkSession, entries: Mapping[str, Mapping[str, str]]) -> int:
        """A version with tables that are stored already: name to ``path`` and ``schema`` (JSON)."""

        def change(content: dict) -> dict:
            return {"tables": {**content.get("tables", {}), **entries}}

        return self.log.update(spark, change)

    def tables(self, spark: SparkSession, version: int | None = None) -> dict[str, DataFrame]:
        """All tables of one version, the last by default."""
        content = self.log.latest(spark)[1] if version is None else self.log.read(spark, version)
        found = {}
        for name, entry in content.get("tables", {}).items():
            schema = T.StructType.fromJson(json.loads(entry["schema"]))
            found[name] = spark.read.schema(schema).parquet(entry["path"]).select(*schema.names)
        return found

    def expire(self, spark: SparkSession, keep: int) -> None:
        self.log.expire(spark, keep, lambda content: [t["path"] for t in content.get("tables", {}).values()])

    def register(self, spark: SparkSession, database: str, version: int | None = None) -> None:
        """Views in the session's catalog, one per table, on the folders of one version.

        They belong to the catalog, not to a session: any other session that shares it
        can query them. Publishing again and registering again points them to the new folders.
        """
        content = self.log.latest(spark)[1] if version is None else self.log.read(spark, version)
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
        for name, entry in content.get("tables", {}).items():
            schema = T.StructType.fromJson(json.loads(entry["schema"]))
            if spark.read.schema(schema).parquet(entry["path"]).isEmpty():
                # a partitioned table without rows has no file that tells its columns
                column, source = "CAST(NULL AS {1}) AS `{0}`", "WHERE false"
            else:
                column, source = "CAST(`{0}` AS {1}) AS `{0}`", f"FROM parquet.`{entry['path']}`"
            columns = ", ".join(column.format(f.name, f.dataType.simpleString()) for f in schema.fields)
            spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{name}` AS SELECT {columns} {source}")
