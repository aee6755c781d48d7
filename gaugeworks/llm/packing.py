"""Packing documents into sequences of limited length by best-two-fit.

Documents become pieces of at most ``capacity`` ids. How many pieces there are of
each length decides the packing, and that histogram has at most ``capacity``
entries whatever the corpus, so the bins are planned on it: a plan lists bin
patterns and how many bins follow each. Pieces then find their bins in parallel by
their rank among the pieces of the same length.

A bin is filled greedily with the longest piece that still fits. Then its smallest
piece is taken out again if two unpacked pieces fit the gap that this leaves more
tightly. As many bins as the remaining pieces allow follow the same pattern.

Ranks come from counts per (length, slice) plus a row number within a slice, and
slices are small parts of the rows, so a length that a third of all pieces share is
spread over many tasks.

Null and empty texts are a document with the end id alone. Repeated rows are packed
as often as they occur; pieces of equal rows are interchangeable.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gaugeworks.llm.common import map_batches
from gaugeworks.llm.encoding import MAX_WORDS, WordTable, text_slices, vocabulary_path
from gaugeworks.sources.shared import materialise

CAPACITY = 4096
END_ID = 1
ROWS_PER_SLICE = 100_000
MIN_SLICES = 256


@dataclass(frozen=True)
class Slot:
    """Pieces ``first .. first + bins * each - 1`` of one length, ``each`` per bin."""

    length: int
    first: int
    bins: int
    each: int
    sequence: int
    offset: int


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[Slot]:
    """Bins for ``histogram`` (length -> number of pieces), lengths from 1 to ``capacity``."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in histogram.items():
        left[length] = count
    used = np.zeros(capacity + 1, np.int64)
    slots: list[Slot] = []
    sequence = 0
    lengths = np.arange(capacity + 1)
    while True:
        fits = np.maximum.accumulate(np.where(left > 0, lengths, 0))  # longest at most
        if not fits[capacity]:
            return slots
        pattern = _fill(left, fits, capacity)
        bins = min(int(left[n]) // k for n, k in pattern.items())
        offset = 0
        for n, k in sorted(pattern.items(), reverse=True):
            slots.append(Slot(n, int(used[n]), bins, k, sequence, offset))
            used[n] += bins * k
            left[n] -= bins * k
            offset += n * k
        sequence += bins


def _fill(left: np.ndarray, fits: np.ndarray, capacity: int) -> dict[int, int]:
    """One bin: length -> number of pieces, at most ``left`` of each."""
    pattern: dict[int, int] = {}
    gap, limit = capacity, capacity
    while gap and (n := int(fits[min(gap, limit)])):
        k = min(gap // n, int(left[n]))
        pattern[n] = k
        gap -= n * k
        limit = n - 1
    if gap:
        smallest = min(pattern)
        room = gap + smallest
        free = left.copy()
        for n, k in pattern.items():
            free[n] -= k
        pair = _best_two(free, room)
        if pair and sum(pair) > smallest:
            pattern[smallest] -= 1
            for n in pair:
                pattern[n] = pattern.get(n, 0) + 1
    return {n: k for n, k in pattern.items() if k}


def _best_two(free: np.ndarray, room: int) -> tuple[int, int] | None:
    """Two free pieces with the largest sum of at most ``room``."""
    have = np.flatnonzero(free[: room + 1] > 0)
    have = have[have > 0]
    if not len(have):
        return None
    lengths = np.arange(room + 1)
    below = np.maximum.accumulate(np.where(free[: room + 1] > 0, lengths, 0))
    second = below[room - have]
    lone = (second == have) & (free[have] < 2)  # one piece cannot be taken twice
    second = np.where(lone, below[np.maximum(have - 1, 0)], second)
    sums = np.where(second > 0, have + second, 0)
    best = int(sums.argmax())
    return (int(have[best]), int(second[best])) if sums[best] else None


def pieces(
    documents: DataFrame,
    path: str | None = None,
    capacity: int = CAPACITY,
    max_words: int = MAX_WORDS,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document cut to ``capacity``."""
    path = path or vocabulary_path()
    end = END_ID.to_bytes(4, "little")

    def function():
        table = WordTable(path, max_words)

        def convert(batch: pa.RecordBatch) -> dict:
            rows, piece, start, length, crc = [], [], [], [], []
            row = 0
            for run in text_slices(batch.column(1)):
                for found in table.whole_ids(run):
                    ids = found + end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        rows.append(row)
                        piece.append(k)
                        start.append(at // 4)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                    row += 1
            return {
                "doc_id": batch.column(0).take(pa.array(rows, "int64")),
                "piece": piece,
                "start": start,
                "length": length,
                "ids_crc32": crc,
            }

        return convert

    kind = documents.schema["doc_id"].dataType.simpleString()
    return map_batches(
        documents.select("doc_id", "text"),
        function,
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long",
    )


def ranked(parts: DataFrame, counts: DataFrame, slices: int) -> DataFrame:
    """Add ``rank``, from 0 without gaps among the pieces of a length."""
    before = W.partitionBy("length").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    first = counts.select(
        "length", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    within = W.partitionBy("length", "slice").orderBy("doc_id", "piece")
    return (
        parts.withColumn("rank", F.row_number().over(within) - 1)
        .join(first, ["length", "slice"])
        .withColumn("rank", F.col("rank") + F.col("first"))
        .drop("first", "slice")
    )


def pack(documents: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``."""
    stored = materialise(pieces(documents, path, capacity), "pieces")
    slices = max(MIN_SLICES, stored.count() // ROWS_PER_SLICE)
    parts = stored.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(slices)))
    counts = materialise(
        parts.groupBy("length", "slice").agg(F.count(F.lit(1)).alias("n")), "piece-counts"
    )
    # at most `capacity` rows
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    slots = sorted(plan(histogram, capacity), key=lambda s: (s.length, s.first))
    fields = ("length", "first", "bins", "each", "sequence", "offset")
    shared = documents.sparkSession.sparkContext.broadcast(
        {f: np.array([getattr(s, f) for s in slots], np.int64) for f in fields}
    )
    longest = max([1, *histogram.values()])

    def function():
        slot = shared.value
        # lengths and ranks as one ascending key; ranks of a length are below `longest`
        keys = slot["length"] * longest + slot["first"]

        def convert(batch: pa.RecordBatch) -> dict:
            columns = {n: batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")}
            length, rank = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("length", "rank"))
            at = np.searchsorted(keys, length * longest + rank, side="right") - 1
            place = rank - slot["first"][at]
            each = slot["each"][at]
            return columns | {
                "sequence_id": pa.array(slot["sequence"][at] + place // each),
                "offset": pa.array(slot["offset"][at] + place % each * length),
            }

        return convert

    kind = documents.schema["doc_id"].dataType.simpleString()
    return map_batches(
        ranked(parts, counts, slices),
        function,
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    )
