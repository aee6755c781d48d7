"""Hard negatives of anchor vectors, from candidate blocks along a Hilbert curve.

Candidates are sorted by label and by their place on a Hilbert curve through all dimensions,
and cut into blocks of ``BLOCK`` rows, stored as Parquet. Every block has a zone map: the
least and the greatest value per dimension. Interval arithmetic on it bounds the inner
products of an anchor with all rows of a block from both sides, and so tells which
blocks may hold a row for one of the anchor's windows: its best rows of the same label,
or the rows of other labels whose scores lie between two shares of a positive's. Only those blocks are read.

A search keeps the best rows of every window. A block whose upper bound is under the
last of them, or whose bounds miss the window, cannot matter. To have good rows early,
blocks are searched in rounds: a hash puts every sixteenth block into level 1, every
sixteenth of those into level 2 and so on, and the highest level comes first. Levels change the
order only; a block of any level that may hold a better row is read.

Anchors are taken in batches of at most ``ANCHORS`` numbers, so what is sent to tasks is
bounded, whatever the table's size. A task holds at most ``HELD`` rows of results and
returns the best of each window; equal vectors are rows like others.

Rows without label or vector, with components that are null or not finite, or whose
scaled squares sum up to 2^53 or more (scores would not be exact) take no part. A vector
meets those of its own length only. A null id is never an anchor and comes last among ties.
Rows with equal ids are vectors of their own; no anchors, or no table rows, give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeworks.llm.common import arrow_schema
from gaugeworks.llm.running import running_totals
from gaugeworks.sources.shared import materialise, shared_folder

BLOCK = 256
#: Numbers in the vectors of a batch of anchors: 8 MB as 64-bit floats.
ANCHORS = 1 << 20
HELD = 200_000
KEY_BYTES = 16
_LAST_ID = np.iinfo(np.int64).max


def hilbert_keys(vectors: np.ndarray, size: int = KEY_BYTES) -> np.ndarray:
    """First ``size`` bytes of the place on a Hilbert curve through all dimensions.

    Coordinates are 6 bits of a signed logarithm, a scale that fits any data. The
    transformation is the one by Gray codes: bits are exchanged or inverted from the
    highest level down, then the coordinates' bits are read level by level.
    """
    bits, (n, dims) = 6, vectors.shape
    if not dims:
        return np.zeros((n, size), np.uint8)
    scale = np.minimum(np.floor(1.2 * np.log2(np.abs(vectors.astype(np.float64)) + 1)), 31)
    x = np.where(vectors < 0, 31 - scale, 32 + scale).astype(np.uint8).T.copy()
    level = 1 << (bits - 1)
    while level > 1:
        low = np.uint8(level - 1)
        for i in range(dims):
            inverted = (x[i] & np.uint8(level)) != 0
            swapped = np.where(inverted, 0, (x[0] ^ x[i]) & low).astype(np.uint8)
            x[0] ^= np.where(inverted, low, swapped).astype(np.uint8)
            x[i] ^= swapped
        level >>= 1
    x = np.bitwise_xor.accumulate(x, axis=0)
    flip, level = np.zeros(n, np.uint8), 1 << (bits - 1)
    while level > 1:
        flip ^= np.where(x[-1] & np.uint8(level), level - 1, 0).astype(np.uint8)
        level >>= 1
    x ^= flip
    planes = [(x >> np.uint8(bit)) & np.uint8(1) for bit in range(bits - 1, -1, -1)]
    packed = np.packbits(np.concatenate(planes).T, axis=1)[:, :size]
    return np.pad(packed, ((0, 0), (0, size - packed.shape[1])))


def _matrix(vectors: pa.Array, dims: int) -> np.ndarray:
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), dims)


def _with_keys(rows: DataFrame) -> DataFrame:
    schema = arrow_schema(rows.withColumn("key", F.lit(b"")).schema)
    at = {c: i for i, c in enumerate(rows.columns)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column(at["dims"]).to_numpy()
            keys = np.zeros((batch.num_rows, KEY_BYTES), np.uint8)
            for d in np.unique(dims):
                chosen = np.flatnonzero(dims == d)
                keys[chosen] = hilbert_keys(_matrix(batch.column(at["vector"]).take(pa.array(chosen)), d))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([k.tobytes() for k in keys], pa.binary())], schema=schema)

    return rows.mapInArrow(run, rows.withColumn("key", F.lit(b"")).schema)


_BLOCK_SCHEMA = (
    "level int, share int, block long, dims int, label long, low array<int>, high array<int>, ids array<long>, rows array<long>, "
    "vectors binary"
)


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Candidate blocks along the curve, one row each; a block has one label and one length of vectors."""
    arrow = arrow_schema(rows.sparkSession.createDataFrame([], _BLOCK_SCHEMA).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share, number = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []  # of one label, less than a block

        def block(rows: pa.Table) -> pa.RecordBatch:
            nonlocal number
            dims, label = rows.column("dims")[0].as_py(), rows.column("label")[0].as_py()
            vectors = _matrix(rows.column("vector").combine_chunks(), dims)
            name = (share << 33) + number
            number += 1
            # a hash of the block's name, uniform in 64 bits
            spread = (name + 1) * 0x9E3779B97F4A7C15 % (1 << 64)
            spread = (spread ^ (spread >> 29)) * 0xBF58476D1CE4E5B9 % (1 << 64)
            level = 0
            while level < 15 and (spread >> (60 - 4 * level)) & 15 == 0:
                level += 1
            values = [
                level, share, name, dims, label, vectors.min(axis=0).tolist(), vectors.max(axis=0).tolist(),
                rows.column("vec_id").to_pylist(), rows.column("row").to_pylist(), vectors.astype("<i4").tobytes(),
            ]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, arrow.types, strict=True)], schema=arrow)

        for batch in batches:
            dims, label = batch.column("dims").to_numpy(), batch.column("label").to_numpy()
            new = np.flatnonzero((np.diff(dims) != 0) | (np.diff(label) != 0)) + 1
            for start, end in zip([0, *new], [*new, batch.num_rows], strict=True):
                part = pa.Table.from_batches([batch.slice(start, end - start)])
                if held and (held[0]["dims"][0] != part["dims"][0] or held[0]["label"][0] != part["label"][0]):
                    yield block(pa.concat_tables(held))
                    held = []
                held = [pa.concat_tables([*held, part])]
                while held[0].num_rows >= size:
                    yield block(held[0].slice(0, size))
                    held = [held[0].slice(size)]
                if not held[0].num_rows:
                    held = []
        if held:
            yield block(held[0])

    order = ["dims", "label", "key", "row"]
    ordered = rows.select(*order, "vec_id", "vector").repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.mapInArrow(run, _BLOCK_SCHEMA)


@dataclass
class Batch:
    """Anchors of one length with ``width`` windows each: scores from ``least`` to ``most``."""

    vectors: np.ndarray  # anchors x dims, 64-bit floats that hold whole numbers
    labels: np.ndarray
    rows: np.ndarray  # the anchors' own rows, which are no partners of theirs
    least: np.ndarray  # anchors x width
    most: np.ndarray
    same_label: bool
    keep: int

    def wanted(self, label: int, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """Anchors that may have a row for one of their windows in a block, by its zone map."""
        of_label = np.flatnonzero((self.labels == label) == self.same_label)
        vectors = self.vectors[of_label]
        positive, negative = np.maximum(vectors, 0), np.minimum(vectors, 0)
        above = (positive @ high + negative @ low)[:, None]
        below = (positive @ low + negative @ high)[:, None]
        return of_label[((above >= least[of_label]) & (below <= self.most[of_label])).any(axis=1)]


class Best:
    """The best rows of every window that a task has met: greatest score, then smallest id, null last."""

    def __init__(self, keep: int, least: np.ndarray):
        self.keep, self.least = keep, least.copy()
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, window: np.ndarray, score: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        self.parts.append((window, score, ids, known))
        self.size += len(window)
        if self.size > 2 * HELD:
            self.settle()

    def settle(self) -> tuple[np.ndarray, ...]:
        """Keep the best; the last of a full window is the least score that still matters."""
        if not self.parts:
            return (np.zeros(0, np.int64),) * 4
        window, score, ids, known = (np.concatenate(c) for c in zip(*self.parts, strict=True))
        order = np.lexsort((ids, ~known, -score, window))
        window, score, ids, known = (c[order] for c in (window, score, ids, known))
        starts = np.flatnonzero(np.diff(window, prepend=-1))
        rank = np.arange(len(window)) - np.repeat(starts, np.diff(np.append(starts, len(window))))
        full = rank == self.keep - 1
        width = self.least.shape[1]
        at = window[full] // width, window[full] % width
        self.least[at] = np.maximum(self.least[at], score[full])
        kept = rank < self.keep
        self.parts = [(window[kept], score[kept], ids[kept], known[kept])]
        self.size = int(kept.sum())
        return self.parts[0]


def _chosen(zones: DataFrame, batch, least) -> DataFrame:
    """(share, block) of the blocks that the windows of a batch have to read."""
    schema = "share int, block long"
    arrow = arrow_schema(zones.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, scores = Batch(*batch.value), least.value
        for rows in batches:
            wanted = [
                len(anchors.wanted(label, np.array(low, float), np.array(high, float), scores)) > 0
                for label, low, high in zip(*[rows.column(i).to_pylist() for i in (2, 3, 4)], strict=True)
            ]
            kept = rows.filter(pa.array(wanted, pa.bool_()))
            yield pa.RecordBatch.from_arrays(kept.columns[:2], schema=arrow)

    return zones.select("share", "block", "label", "low", "high").mapInArrow(run, schema)


_FOUND = "window long, score long, vec_id long"


def _found(blocks: DataFrame, batch, least) -> DataFrame:
    """The best rows that a task has for every window."""
    arrow = arrow_schema(blocks.sparkSession.createDataFrame([], _FOUND).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Batch(*batch.value)
        best = Best(anchors.keep, least.value)
        width = anchors.least.shape[1]
        for rows in batches:
            lists = [rows.column(i) for i in range(6)]
            for label, low, high, ids, own, vectors in zip(*lists, strict=True):
                bounds = [np.array(v.as_py(), float) for v in (low, high)]
                # scores found since the block was chosen may rule it out
                of_block = anchors.wanted(label.as_py(), *bounds, best.least)
                if not len(of_block):
                    continue
                known = ids.values.is_valid().to_numpy(zero_copy_only=False)
                ids = ids.values.fill_null(_LAST_ID).to_numpy()
                matrix = np.frombuffer(vectors.as_py() or bytes(4), "<i4")[: len(ids) * len(low)]
                matrix = matrix.reshape(len(ids), len(low)).astype(np.float64)
                scores = (anchors.vectors[of_block] @ matrix.T).astype(np.int64)
                for w in range(width):
                    fits = (scores >= best.least[of_block, w, None]) & (scores <= anchors.most[of_block, w, None])
                    if anchors.same_label:
                        fits &= own.values.to_numpy()[None, :] != anchors.rows[of_block, None]
                    at, row = np.nonzero(fits)
                    best.add(of_block[at] * width + w, scores[at, row], ids[row], known[row])
        window, score, ids, known = best.settle()
        for k in range(0, len(window), HELD):
            part = slice(k, k + HELD)
            arrays = [pa.array(window[part]), pa.array(score[part]), pa.array(ids[part], mask=~known[part])]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return blocks.select("label", "low", "high", "ids", "rows", "vectors").mapInArrow(run, _FOUND)


class Candidates:
    """Blocks and zone maps of all vectors, and the search for the windows of a batch of anchors."""

    def __init__(self, rows: DataFrame, block: int = BLOCK):
        self.spark = rows.sparkSession
        self.blocks = materialise(_blocks(rows, block), "blocks", ("level", "share"))
        self.zones = materialise(self.blocks.select("level", "share", "block", "dims", "label", "low", "high"), "zones")
        found = self.zones.groupBy("level").agg(F.count(F.lit(1))).collect()  # at most 16 levels
        self.levels = sorted((r.level for r in found), reverse=True)

    def best(self, batch: Batch) -> DataFrame:
        """(window, score, vec_id, rank) of the best rows of every window; windows count row by row."""
        send = self.spark.sparkContext.broadcast
        whole, least, best = send(tuple(vars(batch).values())), batch.least, None
        empty = self.spark.createDataFrame([], f"{_FOUND}, rank int")
        for level in self.levels:
            scores = send(least)
            of_level = (F.col("level") == level) & (F.col("dims") == batch.vectors.shape[1])
            chosen = materialise(_chosen(self.zones.where(of_level), whole, scores), "chosen")
            # a share is one task's blocks, so there are no more than partitions
            shares = [r.share for r in chosen.select("share").distinct().collect()]
            if not shares:
                continue
            read = self.blocks.where(of_level & F.col("share").isin(shares)).join(chosen, ["share", "block"], "left_semi")
            found = _found(read, whole, scores)
            found = found.unionByName(best.select(*found.columns)) if best else found
            order = Window.partitionBy("window").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
            ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= batch.keep)
            best = materialise(ranked, "best")
            last = best.where(F.col("rank") == batch.keep).toArrow()  # at most one row per window of the batch
            window, least = last["window"].to_numpy(), least.copy()
            at = window // least.shape[1], window % least.shape[1]
            least[at] = np.maximum(least[at], last["score"].to_numpy())
        return best or empty


def whole_vectors(embeddings: DataFrame, scale: int = 256, relabel: Column | None = None, anchor: Column | None = None) -> DataFrame:
    """(row, vec_id, label, vector, dims, anchor) of the rows that take part; components become whole numbers."""
    fit = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < 2.0**31))
    rows = embeddings.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & fit).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        (F.col("label") if relabel is None else relabel).cast("long").alias("label"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("vector"),
        F.coalesce(F.lit(False) if anchor is None else anchor, F.lit(False)).alias("anchor"),
    )
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    return rows.where(square < 2.0**53).select(
        F.monotonically_increasing_id().alias("row"),
        "vec_id", "label", F.col("vector").cast("array<int>").alias("vector"), F.size("vector").alias("dims"), "anchor",
    )


_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    vectors: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, block: int = BLOCK
) -> DataFrame:
    """Per anchor and positive, the best rows of other labels with low to high percent of the positive's score.

    ``vectors`` is what ``whole_vectors`` returns. A positive with a negative score has no negatives.
    """
    spark = vectors.sparkSession
    rows = materialise(_with_keys(vectors), "vectors")
    candidates = Candidates(rows, block)
    anchors = rows.where("anchor").withColumns({"dims": F.col("dims").cast("long"), "one": F.lit(1).cast("long")})
    size = F.greatest(F.lit(1), F.least(F.lit(16_384), F.floor(F.lit(ANCHORS) / F.greatest("dims", F.lit(1)))))
    numbered = running_totals(anchors, "dims", ["label", "key", "row"], {"number": "one"}, name="anchors")
    numbered = materialise(numbered.withColumn("batch", F.floor((F.col("number") - 1) / size)), "anchors")
    path = shared_folder(spark, "hard-negatives")
    spark.createDataFrame([], _RESULT).write.parquet(path)
    for dims, number in numbered.select("dims", "batch").distinct().sort("dims", "batch").collect():
        part = numbered.where((F.col("dims") == dims) & (F.col("batch") == number)).sort("number").toArrow()
        n = part.num_rows
        matrix = _matrix(part["vector"].combine_chunks(), dims).astype(np.float64)
        head = matrix, part["label"].to_numpy(), part["row"].to_numpy()
        limit = np.full((n, 1), 1 << 62)
        found = candidates.best(Batch(*head, -limit, limit, True, positives)).toArrow()  # a few rows per anchor
        least, most = np.full((n, positives), 1 << 62), np.full((n, positives), -(1 << 62))
        anchor, place, score = (found[c].to_numpy() for c in ("window", "rank", "score"))
        usable = score >= 0
        at = anchor[usable], place[usable] - 1
        least[at], most[at] = -(-low * score[usable] // 100), high * score[usable] // 100
        windows = pa.table({
            "window": anchor * positives + place - 1, "anchor_id": part["vec_id"].combine_chunks().take(pa.array(anchor)),
            "positive_id": found["vec_id"], "positive_score": found["score"],
        })
        best = candidates.best(Batch(*head, least, most, False, negatives))
        named = best.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
        result = named.join(spark.createDataFrame(windows), "window")
        result.select(*[c.split()[0] for c in _RESULT.split(", ")]).write.mode("append").parquet(path)
    return spark.read.schema(_RESULT).parquet(path)
