"""Removal of passages that other texts already have, by content-defined chunks.

A gear hash rolls over the bytes of a text: every byte shifts the hash left by one bit
and adds a fixed random number of its own. A chunk ends where the hash is small, which
depends on the last ``WINDOW + APART`` bytes only, so an insertion moves no cut that lies
further on and equal passages are cut alike wherever they stand. Chunks are compared
by a 64-bit digest. The first place of a chunk, by document and position, owns it.

A single short chunk may recur by chance. Adjacent recurring chunks form a run, and
only runs of at least ``min_bytes`` count as repeated passages; of a passage of 50
words, that is well under what its first and last partial chunk leave. Within a run,
chunks with an earlier owner are removed.

Only digests and places travel. First a partial aggregation finds the digests that
occur twice; then a join brings them back to their places, which a document collects,
so a chunk that a third of all documents share is a hot join key (adaptive execution
splits it) and never a group.

Null and empty texts have no chunks. Texts shorter than ``min_bytes`` are left alone;
exact copies of longer ones are runs like any other, so a repeated document keeps its
text at its first place only. ``remove_repeats`` numbers the rows, so null and repeated
ids do not matter there; ``repeats`` goes by ``doc_id``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import map_batches
from gaugeworks.llm.encoding import chunks as text_runs
from gaugeworks.sources.shared import materialise

WINDOW = 16
MEAN_BYTES = 24
APART = 8
MIN_BYTES = 120


class Chunker:
    """Cuts and digests of many texts at once, in numpy."""

    def __init__(self):
        draw = np.random.Generator(np.random.PCG64(20240229))
        self.gear = draw.integers(0, 1 << 16, 256, np.uint16)
        self.values = draw.integers(0, 1 << 64, 256, np.uint64)
        self.factor = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2 ** 64
        self.inverse = pow(self.factor, -1, 1 << 64)
        self.powers = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _powers(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.powers[0]) < size:
            self.powers = tuple(
                np.concatenate(([np.uint64(1)], np.full(size - 1, base, np.uint64))).cumprod(dtype=np.uint64)
                for base in (self.factor, self.inverse)
            )
        return self.powers

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(number of chunks per text, start in its text, length, digest)."""
        ends = np.cumsum([len(t) for t in texts])
        data = np.frombuffer(b"".join(texts), np.uint8)
        begins = np.concatenate(([0], ends[:-1]))
        h = self.gear[data]
        span = 1
        while span < WINDOW:  # sums over 1, 2, 4 ... bytes
            shifted = h.copy()
            shifted[span:] += h[:-span] << np.uint16(span)
            h, span = shifted, 2 * span
        raw = np.flatnonzero(h < (1 << 16) // MEAN_BYTES) + 1
        # a place that knows fewer bytes of its own text than the window is no cut
        raw = raw[raw - begins[np.searchsorted(ends, raw, side="left")] >= WINDOW]
        # of cuts close together the first stays: a rule that also looks at near bytes only
        raw = raw[np.diff(raw, prepend=-APART) >= APART]
        stops = np.union1d(raw, ends)
        starts = np.concatenate(([0], stops[:-1]))
        up, down = self._powers(len(data) + 1)
        sums = np.concatenate(([np.uint64(0)], (self.values[data] * up[: len(data)]).cumsum(dtype=np.uint64)))
        digest = (sums[stops] - sums[starts]) * down[starts]
        digest ^= digest >> np.uint64(32)
        digest *= np.uint64(0xD6E8FEB86659FD93)
        digest ^= digest >> np.uint64(32)
        text = np.searchsorted(ends, stops, side="left")
        return np.bincount(text, minlength=len(texts)), starts - begins[text], stops - starts, digest


def chunk_table(documents: DataFrame, row: str, text: str) -> DataFrame:
    """(row, chunks): start, length and digest of the chunks of every non-empty text."""

    def function():
        chunker = Chunker()

        def convert(batch: pa.RecordBatch) -> dict:
            found = [
                chunker([t.encode() for t in run]) for run in text_runs(batch.column(1).to_pylist())
            ]
            counts, starts, lengths, digests = map(np.concatenate, zip(*found, strict=True))
            offsets = np.concatenate(([0], counts.cumsum())).astype(np.int32)
            fields = {
                "start": starts.astype(np.int32),
                "length": lengths.astype(np.int32),
                "digest": digests.view(np.int64),
            }
            chunks = pa.StructArray.from_arrays([pa.array(v) for v in fields.values()], list(fields))
            return {"row": batch.column(0), "chunks": pa.ListArray.from_arrays(offsets, chunks)}

        return convert

    source = documents.select(F.col(row).cast("long").alias("row"), text)
    return map_batches(
        source.where((F.length(text) > 0) & F.col("row").isNotNull()),
        function,
        "row long, chunks array<struct<start:int,length:int,digest:long>>",
    )


def repeated_spans(
    documents: DataFrame, row: str = "doc_id", text: str = "text", min_bytes: int = MIN_BYTES
) -> DataFrame:
    """(row, start, length, first_row, own) of every repeated passage.

    Start and length are bytes of the UTF-8 text; ``first_row`` is the row where most of
    the passage stands first, and ``own`` tells whether this is that place. ``row`` is an
    integer column; rows that share a number count as one, rows without one are left out.
    """
    chunks = materialise(chunk_table(documents, row, text), "chunks")
    chunks = chunks.select("row", F.inline("chunks"))
    # stored, as a join side from an aggregation keeps adaptive execution from splitting hot chunks
    owners = materialise(
        chunks.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "start")).alias("first"))
        .where("n > 1")
        .select("digest", F.col("first.row").alias("first_row"), F.col("first.start").alias("first_start")),
        "chunk-owners",
    )
    found = (
        chunks.join(owners, "digest")
        .groupBy("row")
        .agg(F.sort_array(F.collect_set(F.struct("start", "length", "first_row", "first_start"))).alias("found"))
    )

    def function():
        def convert(batch: pa.RecordBatch) -> dict:
            lists = batch.column(1)
            flat = lists.flatten()
            row = np.repeat(batch.column(0).to_numpy(), np.diff(lists.offsets.to_numpy()))
            start, length, first_row, first_start = (f.to_numpy() for f in flat.flatten())
            return spans(row, start, length, first_row, first_start, min_bytes)

        return convert

    return map_batches(
        found, function, "row long, start int, length int, first_row long, own boolean"
    )


def spans(row, start, length, first_row, first_start, min_bytes: int) -> dict[str, np.ndarray]:
    """Spans of the recurring chunks of some documents, in order of row and start.

    In a run of adjacent chunks, a few that happen to stand earlier elsewhere don't make
    a passage: they count as own unless neighbours of their kind reach ``min_bytes``.
    """
    new_run = np.ones(len(row), bool)
    new_run[1:] = (row[1:] != row[:-1]) | (start[1:] != start[:-1] + length[:-1])
    own = (first_row == row) & (first_start == start)

    def segments(flag):
        begin = new_run.copy()
        begin[1:] |= flag[1:] != flag[:-1]
        at = np.flatnonzero(begin)
        return at, np.cumsum(begin) - 1, np.add.reduceat(length, at) if len(at) else length

    _, segment, total = segments(own)
    own = own | (total[segment] < min_bytes)
    at, segment, total = segments(own)
    longest = np.lexsort((-length, segment))[at] if len(at) else at
    keep = total >= min_bytes
    return {
        "row": row[at][keep],
        "start": start[at][keep],
        "length": total[keep].astype(np.int32),
        "first_row": np.where(own[at], row[at], first_row[longest])[keep],
        "own": own[at][keep],
    }


def numbered(documents: DataFrame, name: str) -> DataFrame:
    """``documents``, stored, with a row number that does not change when it is read again."""
    return materialise(documents.withColumn(name, F.monotonically_increasing_id()), "numbered")


def free_name(documents: DataFrame, name: str) -> str:
    while any(c.lower().startswith(name) for c in documents.columns):
        name = f"_{name}"
    return name


def remove_repeats(
    documents: DataFrame, text: str = "text", min_bytes: int = MIN_BYTES
) -> DataFrame:
    """``documents`` with every repeated passage left at its first place only."""
    own = free_name(documents, "chunk_dedup")
    row, cuts = f"{own}_row", f"{own}_spans"
    stored = numbered(documents, row)
    spans = (
        repeated_spans(stored, row, text, min_bytes)
        .where("not own")
        .groupBy(F.col("row").alias(row))
        .agg(F.sort_array(F.collect_list(F.struct("start", "length"))).alias(cuts))
    )
    # one join brings the spans to the rows, so texts are shuffled once; a text without any stays as it is
    joined = stored.join(spans, row, "left").select(*documents.columns, cuts)
    at = documents.columns.index(text)

    def function():
        def convert(batch: pa.RecordBatch) -> dict:
            *columns, found = batch.columns
            changed = found.is_valid()
            pairs = zip(columns[at].filter(changed).to_pylist(), found.filter(changed).to_pylist(), strict=True)
            texts = pa.array([cleaned(t, s) for t, s in pairs], columns[at].type)
            columns[at] = pc.replace_with_mask(columns[at], changed, texts)
            return dict(enumerate(columns))

        return convert

    return map_batches(joined, function, documents.schema)


def cleaned(text: str, spans: list[dict]) -> str:
    """Text without the spans; a character cut by the edge of a span goes with it."""
    data, parts, at = text.encode(), [], 0
    for span in spans:
        parts.append(data[at : span["start"]])
        at = span["start"] + span["length"]
    parts.append(data[at:])
    return b"".join(p.decode("utf-8", "ignore").encode() for p in parts).decode()


def repeats(documents: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """One row per repeated passage and place: (doc_id, start, length, first_doc_id, removed).

    ``start`` and ``length`` count bytes; ``removed`` is false at the first place.
    """
    return repeated_spans(documents, "doc_id", "text", min_bytes).select(
        F.col("row").alias("doc_id"),
        "start",
        "length",
        F.col("first_row").alias("first_doc_id"),
        (~F.col("own")).alias("removed"),
    )
