"""Tables that streams append to, compacted and merged while they grow."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.operators.dedup import keep_one
from gaugeworks.operators.quality_state import BUCKET, has_keys, key_bucket, merged_report
from gaugeworks.plans.concurrent import concurrently
from gaugeworks.sources.snapshots import SnapshotLog
from gaugeworks.sources.tables import write_table
from gaugeworks.spec import EntitySpec

ORIGIN = ("_stream", "_batch_id", "_order")
_ORIGIN_TYPES = (T.StringType(), T.LongType(), T.LongType())
# A stream may have so many batches before its order runs into the next stream's.
_BATCHES = 1 << 40
_COUNTS = "entidade string, regra string, coluna string, total_registros bigint, violacoes bigint"


def newest_rows(rows: DataFrame, keys: Iterable[str], never_null: Iterable[str] = ()) -> DataFrame:
    """One row per key, that of the greatest ``_newest``, then the smallest one.

    Of rows without a whole key only exact copies go. The result of some rows and that
    of others can be put together by the same function.
    """
    keys = list(keys)
    if not keys or any(k not in rows.columns for k in keys):
        columns = [c for c in rows.columns if c != "_newest"]
        return rows.groupBy(*columns).agg(F.max("_newest").alias("_newest"))
    return keep_one(rows, keys, "_newest", never_null, aside=["_newest"])


@dataclass(frozen=True)
class StreamSink:
    """Storage of streams: rows, quality rows, rejected payloads and rejected rows.

    A batch is named by the persistent id of its query and its number, so a query that
    starts over with a new checkpoint never replaces batches of the old one. Each kind is a
    list of part folders. As soon as ``fanout`` parts of one level are there, they are rewritten
    as one part of the next level, so parts stay few and a row is rewritten a few times only.

    With ``buckets`` there is also a merged table with one row per key, kept by hash of the key,
    and a report on all rows. The rows of a batch wait, as they are stored, until ``fanout`` batches
    do; these are merged at once, into the buckets of their keys only. A reader merges what waits.
    ``keep`` versions stay readable; folders that only older ones name are removed.
    """

    root: str
    fanout: int = 8
    buckets: int = 0
    keep: int = 4

    @property
    def log(self) -> SnapshotLog:
        return SnapshotLog(self.root)

    def kind_path(self, kind: str) -> str:
        return f"{self.root.rstrip('/')}/{kind}"

    def part_path(self, kind: str, name: str) -> str:
        return f"{self.kind_path(kind)}/_part={name}"

    def batch(self, spark: SparkSession, stream: str, batch_id: int) -> Batch | None:
        """A batch to be stored; None if it is stored already.

        The first batch of a stream gives the stream its place in the order of streams.
        """

        def place(content: dict) -> dict | None:
            streams = content.setdefault("streams", {})
            if stream in streams:
                return None
            streams[stream] = {"place": len(streams), "last": -1}
            return content

        self.log.update(spark, place)
        entry = self.log.latest(spark)[1]["streams"][stream]
        if batch_id <= entry["last"]:
            return None
        return Batch(self, spark, stream, batch_id, entry["place"] * _BATCHES + batch_id)

    # -- reading -----------------------------------------------------------------

    def _parts(self, spark: SparkSession, kind: str, paths: list[str], schema: T.StructType) -> DataFrame:
        if not paths:
            return spark.createDataFrame([], schema)
        reader = spark.read.schema(schema).option("basePath", self.kind_path(kind))
        return reader.parquet(*paths).select(*schema.names)

    def read(self, spark: SparkSession, kind: str, schema: T.StructType) -> DataFrame:
        """All rows of a kind at the last version, with their origin."""
        content = self.log.latest(spark)[1]
        origin = [T.StructField(n, t) for n, t in zip(ORIGIN, _ORIGIN_TYPES, strict=True)]
        full = T.StructType([*[f for f in schema.fields if f.name not in ORIGIN], *origin])
        return self._parts(spark, kind, [p["path"] for p in content.get("parts", {}).get(kind, [])], full)

    def read_merged(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """The merged table at the last version: one row per key over all batches."""
        content = self.log.latest(spark)[1]
        merged = [f"{path}/{BUCKET}={b}" for b, path in content.get("merged", {}).items()]
        if not content.get("waiting"):
            return self._parts(spark, "merged", merged, schema)
        table = content["table"]
        rows = newest_rows(self._unmerged(spark, content, merged), table["keys"], table["mandatory"])
        return rows.select(*schema.names)

    def _unmerged(self, spark: SparkSession, content: dict, merged: list[str]) -> DataFrame:
        """Rows of merged buckets and of the batches that wait, with their ``_newest``."""
        schema = T.StructType.fromJson(json.loads(content["table"]["schema"]))
        new = T.StructType([*schema.fields, T.StructField("_order", T.LongType())])
        old = T.StructType([*schema.fields, T.StructField("_newest", T.LongType())])
        rows = self._parts(spark, "rows", content["waiting"], new).withColumnRenamed("_order", "_newest")
        return rows.unionByName(self._parts(spark, "merged", merged, old)) if merged else rows

    def read_report(self, spark: SparkSession) -> DataFrame:
        """The quality report on all stored rows together, merged from the batches' reports.

        Counts add up. Different keys do not, so they are counted over the merged table and
        the batches that wait, of which no other column is read.
        """
        content = self.log.latest(spark)[1]
        counts = self.read(spark, "quality", spark.createDataFrame([], _COUNTS).schema).drop(*ORIGIN)
        if "table" not in content:
            return merged_report(counts.limit(0))
        merged = [f"{path}/{BUCKET}={b}" for b, path in content.get("merged", {}).items()]
        keys = content["table"]["keys"]
        if not keys:
            return merged_report(counts)
        return merged_report(counts, self._unmerged(spark, content, merged).select(*keys))

    # -- keeping it small ----------------------------------------------------------

    def compact(self, spark: SparkSession, partition_by: Mapping[str, Iterable[str]] | None = None) -> None:
        """Rewrite every level that has ``fanout`` parts as one part of the next level, all kinds at the same time."""
        by = partition_by or {}
        while True:
            content = self.log.latest(spark)[1]
            full = self._full_levels(content)
            if not full:
                break
            concurrently(
                spark,
                {
                    kind: partial(self._rewrite, spark, kind, level, paths, by.get(kind, ()))
                    for kind, level, paths in full
                },
            )
        self._merge_waiting(spark)
        self.log.expire(spark, self.keep, _folders)

    def _rewrite(self, spark: SparkSession, kind: str, level: int, paths: list[str], by: Iterable[str]) -> None:
        rows = spark.read.option("basePath", self.kind_path(kind)).parquet(*paths).drop("_part")
        target = self.part_path(kind, f"c-{uuid.uuid4().hex}")
        write_table(rows, target, by)
        new = {"path": target, "level": level}
        self.log.update(spark, lambda content: _replaced(content, kind, paths, new))

    def _merge_waiting(self, spark: SparkSession) -> None:
        """Once ``fanout`` batches wait, rewrite the buckets that they have keys of."""
        while True:
            content = self.log.latest(spark)[1]
            waiting, merged = content.get("waiting", []), content.get("merged", {})
            if len(waiting) < self.fanout:
                return
            table = content["table"]

            def placed(rows: DataFrame, table: dict = table) -> DataFrame:
                plain = rows.drop("_newest")
                return rows.withColumn(BUCKET, key_bucket(plain, table["keys"], self.buckets))

            new = placed(self._unmerged(spark, content, []))
            touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())  # at most buckets
            old = [f"{merged[str(b)]}/{BUCKET}={b}" for b in touched if str(b) in merged]
            kept = newest_rows(self._unmerged(spark, content, old), table["keys"], table["mandatory"])
            path = self.part_path("merged", f"m-{uuid.uuid4().hex}")
            write_table(placed(kept), path, [BUCKET])

            def merge(content: dict, waiting=waiting, merged=merged, new=dict.fromkeys(map(str, touched), path)) -> dict | None:
                if content.get("merged", {}) != merged or content.get("waiting", [])[: len(waiting)] != waiting:
                    return None  # another writer has merged them
                content["waiting"] = content["waiting"][len(waiting) :]
                content["merged"] = {**merged, **new}
                return content

            self.log.update(spark, merge)

    def _full_levels(self, content: dict) -> list[tuple[str, int, list[str]]]:
        """Per kind with a full level: kind, level of the new part, and the parts to rewrite.

        If the new part fills its level too, that one's parts are taken along, so no row is
        rewritten twice at once.
        """
        full = []
        for kind, parts in content.get("parts", {}).items():
            levels: dict[int, list[str]] = {}
            for part in parts:
                levels.setdefault(part["level"], []).append(part["path"])
            level = min((n for n, paths in levels.items() if len(paths) >= self.fanout), default=None)
            if level is None:
                continue
            paths = levels[level]
            while len(above := levels.get(level + 1, [])) + 1 >= self.fanout:
                paths, level = above + paths, level + 1
            full.append((kind, level + 1, paths))
        return full


def _replaced(content: dict, kind: str, paths: list[str], new: dict) -> dict | None:
    """Parts of a kind replaced by one; None if another writer has replaced some of them."""
    parts = content["parts"][kind]
    if not set(paths) <= {p["path"] for p in parts}:
        return None
    content["parts"][kind] = [p for p in parts if p["path"] not in paths] + [new]
    return content


def _folders(content: dict) -> list[str]:
    parts = [p["path"] for kind in content.get("parts", {}).values() for p in kind]
    return parts + list(content.get("merged", {}).values()) + content.get("waiting", [])


@dataclass
class Batch:
    """A micro-batch on its way into a sink: folders first, then one version that names them."""

    sink: StreamSink
    spark: SparkSession
    stream: str
    batch_id: int
    order: int
    kinds: list[str] = field(default_factory=list)

    def folder(self, kind: str) -> str:
        return self.sink.part_path(kind, f"b-{self.stream}-{self.batch_id}")

    def _origin(self, df: DataFrame) -> DataFrame:
        values = (self.stream, self.batch_id, self.order)
        return df.withColumns({n: F.lit(v).cast(t) for n, v, t in zip(ORIGIN, values, _ORIGIN_TYPES, strict=True)})

    def write(self, kind: str, df: DataFrame, partition_by: Iterable[str] = (), rebalance: bool = True) -> None:
        """A replay replaces what an earlier try has left behind without a version."""
        write_table(self._origin(df), self.folder(kind), partition_by, rebalance=rebalance)
        self.kinds.append(kind)

    def commit_parts(self) -> None:
        """Make the version that has the batch, for kinds that are only appended to."""

        def add(content: dict) -> dict | None:
            if self.batch_id <= content["streams"][self.stream]["last"]:
                return None
            return self._with_parts(content, self.kinds)

        self.sink.log.update(self.spark, add)

    def _with_parts(self, content: dict, kinds: Iterable[str]) -> dict:
        for kind in dict.fromkeys(kinds):
            content.setdefault("parts", {}).setdefault(kind, []).append({"path": self.folder(kind), "level": 0})
        content["streams"][self.stream]["last"] = self.batch_id
        return content

    def commit(self, spec: EntitySpec, rows: DataFrame) -> None:
        """Make the version that has the batch; with ``buckets`` its rows wait to be merged."""

        def add(content: dict) -> dict | None:
            if self.batch_id <= content["streams"][self.stream]["last"]:
                return None
            if self.sink.buckets:
                keys = list(spec.dedup_keys) if has_keys(rows, spec.dedup_keys) else []
                content["table"] = {"keys": keys, "mandatory": list(spec.mandatory), "schema": rows.schema.json()}
                content.setdefault("waiting", []).append(self.folder("rows"))
            return self._with_parts(content, self.kinds)

        self.sink.log.update(self.spark, add)
