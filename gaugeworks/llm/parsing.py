"""Removal of bytes that stand earlier in the corpus, by prefix-free parsing.

A byte goes if a string of ``size`` bytes over it also starts earlier: in a document with a
smaller id, or in the same one further left. Strings never cross documents.

Parsing. A rolling hash over ``TRIGGER`` bytes marks triggers: every start of a string has
as trigger the first place of the smallest hash within its first ``REACH`` bytes. That
depends on the string's own bytes alone, so equal strings have the same trigger. The
starts that share a trigger make a phrase: its bytes reach from the first start to the
end of the last one's string, so phrases overlap, and the parse covers every string.

Dictionary. Equal phrases are one entry, owned by the earliest place; all strings of a
later copy stand earlier, so it is marked whole without looking inside. A phrase none
of whose strings can occur elsewhere is dropped: all of them hold the bytes around the
trigger (``probe``), which then occur once. A batch of a task sends an entry once, however often
it meets it, so a passage that a third of all documents share never fills a task.

Suffixes. What is left are entries that share the bytes around their trigger with
another one, as at the edges of repeated passages. Their suffixes, that is the strings
by start, are put in the order of the corpus: by their first bytes, then by digests
(96 bits) of all their bytes, as only equality counts beyond, then by place. In this
suffix array of the dictionary equal strings are neighbours and the first of them
stands earliest. Equal strings meet in one task, of every batch only the first.

A dictionary or suffix array of the whole corpus in one process, as in the sequential
method, is never built: every task sorts its share. Digests and places travel, and the
texts once, compressed, for both the suffixes and the final cut.

Null and empty texts have no bytes. Rows without an id come before all others; rows with
the same id are documents of their own, in the order of the table. ``documents`` must be
read from files, so that its rows keep their order when they are read again.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import arrow_schema
from gaugeworks.sources.shared import materialise

SIZE = 100
TRIGGER = 8
REACH = 68
#: Bytes that are parsed at once; phrases and suffixes among which a task looks for copies of its own.
PIECE = 1 << 20
ENTRIES = 1_000_000
SUFFIXES = 500_000

_MULTIPLIERS = np.random.Generator(np.random.PCG64(77)).integers(0, 1 << 64, (2, 64), np.uint64) | np.uint64(1)
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _SECOND
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def _words(data: bytes) -> np.ndarray:
    """The eight bytes from every place on, as one number; zeros follow the end."""
    padded = np.frombuffer(data + bytes(8), np.uint8)
    return np.ndarray(len(data), np.uint64, padded, strides=(1,))


def _digest(words: np.ndarray, at: np.ndarray, size: int, lane: int) -> np.ndarray:
    """64-bit digest of ``size`` bytes from every place of ``at`` on."""
    h = np.full(len(at), np.uint64(size + lane))
    steps = [*range(0, size - 7, 8)]
    if size % 8:
        steps.append(size - 8)
    for k, step in enumerate(steps):
        h = (h ^ words[at + step]) * _MULTIPLIERS[lane, k % 64]
        h ^= h >> np.uint64(31)
    return _mix(h)


class Parser:
    """Phrases of a piece of text."""

    def __init__(self, size: int, trigger: int = TRIGGER, reach: int = REACH):
        self.size, self.trigger = size, trigger
        self.span = reach - trigger + 1  # places among which a start has its trigger
        self.probe = size - reach  # bytes after a trigger that all strings of its phrase hold

    def __call__(self, words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(first start, number of starts, place of the trigger) of all phrases, in order.

        ``ends`` are the ends of texts of at least ``size`` bytes behind each other.
        """
        n = len(words) - self.size + 1
        hashed = words[: n + self.span - 1] * np.uint64(0x9E3779B97F4A7C15)
        hashed = (hashed ^ (hashed >> np.uint64(29))) * _SECOND
        value = (hashed & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashed), dtype=np.uint64)
        span = 1
        while 2 * span <= self.span:
            value = np.minimum(value[:-span], value[span:])
            span *= 2
        if rest := self.span - span:
            value = np.minimum(value[:-rest], value[rest:])
        place = (value & np.uint64(0xFFFFFFFF)).astype(np.int64)
        # starts whose strings would cross the end of a text belong to no phrase
        crossing = (ends[:-1, None] - np.arange(1, self.size)).ravel()
        place[crossing] = -1
        first = np.flatnonzero(np.diff(place, prepend=-2))
        count = np.diff(np.append(first, n))
        kept = place[first] >= 0
        return first[kept], count[kept], place[first[kept]]

    def entries(self, words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
        """(probe digest, digest, first start, number of starts) of all phrases."""
        first, count, place = self(words, ends)
        probe = _digest(words, place, self.trigger + self.probe, 0)
        # a phrase is shorter than two strings, so its first and last one hold all of it
        whole = _digest(words, first, self.size, 0) + _MULTIPLIERS[0, 0] * _digest(words, first + count - 1, self.size, 1)
        whole = _mix(whole ^ ((count.astype(np.uint64) << np.uint64(8)) + (place - first).astype(np.uint64)))
        return probe, whole, first, count


def _buffers(ids: list, rows: list, texts: list[bytes], size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Texts behind each other, a few at a time, longer ones in pieces: (bytes, and per part: id, row, place, end).

    Every string of ``size`` bytes lies in exactly one part.
    """
    parts, held = [], 0
    for i, text in enumerate(texts):
        for at in range(0, len(text) - size + 1, PIECE):
            piece = text[at : at + PIECE + size - 1]
            parts.append((piece, ids[i], rows[i], at))
            held += len(piece)
            if held > PIECE:
                yield _joined(parts)
                parts, held = [], 0
    if parts:
        yield _joined(parts)


def _joined(parts: list[tuple]) -> tuple:
    pieces, *place = zip(*parts, strict=True)
    return b"".join(pieces), *[np.array(c) for c in place], np.cumsum([len(p) for p in pieces])


def _table(schema: pa.Schema, columns: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types, strict=True)], schema=schema)


def _runs(flag: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of runs of flagged neighbours that touch or overlap in one row."""
    chosen = np.flatnonzero(flag)
    if not len(chosen):
        return chosen, chosen
    new = np.ones(len(chosen), bool)
    before, after = chosen[:-1], chosen[1:]
    new[1:] = (after != before + 1) | (row[after] != row[before]) | (start[after] > end[before])
    return chosen[new], chosen[np.append(np.flatnonzero(new)[1:] - 1, len(chosen) - 1)]


# Kinds of rows: bytes to remove, an entry of the dictionary, an entry whose probe is known to be shared.
SPAN, ENTRY, SHARED = 0, 1, 2
# A code is a kind and a length: bytes of a span, or the number of starts of an entry.
_PLACE = "id long, row long, start long"
_SENT = f"deal long, entry long, {_PLACE}, code long"
_FOUND = f"{_PLACE}, code long"


def _schema(rows: DataFrame, schema: str) -> pa.Schema:
    return arrow_schema(rows.sparkSession.createDataFrame([], schema).schema)


def _sent(documents: DataFrame, size: int) -> DataFrame:
    """What the parse sends: every entry of a batch once, and spans that stand earlier in the same batch."""
    arrow = _schema(documents, _SENT)

    def settled(probe, entry, ids, row, start, count) -> pa.RecordBatch:
        _, first, inverse = np.unique(entry, return_index=True, return_inverse=True)
        copy = first[inverse] != np.arange(len(entry))  # places ascend
        end = start + count - 1 + size
        head, tail = _runs(copy, row, start, end)
        own = np.flatnonzero(~copy)
        # two entries show that a probe is shared; further ones may go anywhere
        order = own[np.argsort(probe[own], kind="stable")]
        of_probe = np.flatnonzero(np.diff(probe[order].view(np.int64), prepend=~probe[order[0]].view(np.int64)))
        rank = np.arange(len(order)) - np.repeat(of_probe, np.diff(np.append(of_probe, len(order))))
        shared = rank >= 2
        deal = np.where(shared, probe[order] ^ entry[order], probe[order])
        spread = (row[head].astype(np.uint64) << np.uint64(20)) + start[head].astype(np.uint64)
        columns = [
            np.append(deal, _mix(spread)).view(np.int64), np.append(entry[order], np.zeros(len(head), np.uint64)).view(np.int64),
            *[np.append(c[order], c[head]) for c in (ids, row, start)],
            np.append(count[order] * 4 + np.where(shared, SHARED, ENTRY), (end[tail] - start[head]) * 4 + SPAN),
        ]
        return _table(arrow, columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = Parser(size)
        for batch in batches:
            ids, rows, texts = (batch.column(i).to_pylist() for i in range(3))
            # earlier documents first, so that what is met again stands later
            order = sorted(range(len(ids)), key=lambda i: (ids[i], rows[i]))  # noqa: B023
            ids, rows = [ids[i] for i in order], [rows[i] for i in order]
            found, held = [], 0
            for data, of_id, of_row, at, ends in _buffers(ids, rows, [texts[i].encode() for i in order], size):
                probe, entry, first, count = parser.entries(_words(data), ends)
                part = np.searchsorted(ends, first, side="right")
                begins = np.append(0, ends[:-1])[part]
                found.append((probe, entry, of_id[part], of_row[part], first - begins + at[part], count))
                held += len(first)
                if held > ENTRIES:
                    yield settled(*map(np.concatenate, zip(*found, strict=True)))
                    found, held = [], 0
            if held:
                yield settled(*map(np.concatenate, zip(*found, strict=True)))

    return documents.mapInArrow(run, _SENT)


def _dictionary(sent: DataFrame, size: int) -> DataFrame:
    """Spans, and the entries that share their probe with another one, each at its earliest place."""
    arrow = _schema(sent, _FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deal = entry = None  # of the row before
        pending: list[np.ndarray] | None = None  # an entry whose probe has no second entry yet
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            is_span = columns[5] % 4 == SPAN
            out = [[c[is_span] for c in columns[2:]]]
            d, e, *rest = (c[~is_span] for c in columns)
            if len(d):
                new_deal, new = np.ones(len(d), bool), np.ones(len(d), bool)
                new_deal[1:] = d[1:] != d[:-1]
                new_deal[0] = deal is None or d[0] != deal
                new[1:] = new_deal[1:] | (e[1:] != e[:-1])
                new[0] = new_deal[0] or e[0] != entry
                copies = [c[~new] for c in rest]
                copies[3] = (copies[3] // 4 - 1 + size) * 4 + SPAN
                run_of = np.cumsum(new_deal)
                owners = np.flatnonzero(new)
                many = np.bincount(run_of[owners], minlength=run_of[-1] + 1)
                goes_on = run_of[owners] == 0
                certain = goes_on | (many[run_of[owners]] > 1) | (rest[3][owners] % 4 == SHARED)
                if pending is not None and many[0]:
                    out.append(pending)
                if many[0] or run_of[-1] > 0:
                    pending = None
                last = owners[-1] if len(owners) and run_of[owners[-1]] == run_of[-1] else None
                if last is not None and not certain[-1]:
                    pending = [c[last : last + 1] for c in rest]
                    pending[3] = pending[3] // 4 * 4 + ENTRY
                own = [c[owners[certain]] for c in rest]
                own[3] = own[3] // 4 * 4 + ENTRY
                out += [copies, own]
                deal, entry = d[-1], e[-1]
            yield _table(arrow, [np.concatenate(c) for c in zip(*out, strict=True)])

    order = ["deal", "entry", "id", "row", "start"]
    return sent.repartition("deal").sortWithinPartitions(*order).mapInArrow(run, _FOUND)


_SUFFIX = f"head long, a long, b int, {_PLACE}, length int"


def _suffixes(entries: DataFrame, size: int) -> DataFrame:
    """The suffixes of the dictionary: a string (first bytes and digests) and its place, once per batch, and spans.

    ``entries`` holds doc_id, id, row, packed text and a list of (start, number of starts). A
    span has length and a random key, a suffix length 0; ``head`` orders like the first eight bytes.
    """
    arrow = _schema(entries, _SUFFIX)

    def settled(found: list[tuple]) -> pa.RecordBatch:
        words, a, b, ids, row, start = map(np.concatenate, zip(*found, strict=True))
        # places ascend, so of equal strings np.unique names the earliest
        _, first, inverse = np.unique(a, return_index=True, return_inverse=True)
        owner = first[inverse]
        again = (owner != np.arange(len(a))) & (b == b[owner]) & (words == words[owner])
        head, tail = _runs(again, row, start, start + size)
        own = np.flatnonzero(~again)
        order = words[own].byteswap() ^ np.uint64(1 << 63)
        columns = [
            np.append(order, _mix(a[head] ^ start[head].astype(np.uint64))).view(np.int64),
            np.append(a[own], a[head]).view(np.int64),
            np.append(b[own], b[head]).view(np.int32),
            *[np.append(c[own], c[head]) for c in (ids, row, start)],
            np.append(np.zeros(len(own), np.int32), start[tail] + size - start[head]),
        ]
        return _table(arrow, columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            _, ids, rows, texts, lists = (batch.column(i).to_pylist() for i in range(5))
            found: list[tuple[np.ndarray, ...]] = []
            held = 0
            for i in sorted(range(len(ids)), key=lambda i: (ids[i], rows[i])):  # noqa: B023
                words = _words(unpack(texts[i]))
                chosen = np.array([(e["start"], e["code"] // 4) for e in lists[i]])
                chosen = chosen[np.argsort(chosen[:, 0])]
                for k in range(0, len(chosen), 10_000):
                    first, count = chosen[k : k + 10_000].T
                    at = np.repeat(first - np.cumsum(count) + count, count) + np.arange(count.sum())
                    lanes = [_digest(words, at, size, lane) for lane in (0, 1)]
                    place = [np.full(len(at), ids[i]), np.full(len(at), rows[i]), at]
                    found.append((words[at], lanes[0], (lanes[1] >> np.uint64(32)).astype(np.uint32), *place))
                    held += len(at)
                    if held > SUFFIXES:
                        yield settled(found)
                        found, held = [], 0
            if found:
                yield settled(found)

    return entries.mapInArrow(run, _SUFFIX)


def _neighbours(suffixes: DataFrame, size: int) -> DataFrame:
    """(row, start, length) of suffixes that equal the one before them in the suffix array, and of all spans."""
    schema = "row long, start long, length int"
    arrow = _schema(suffixes, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            head, a, b, _, row, start, length = (c.to_numpy() for c in batch.columns)
            suffix = np.flatnonzero(length == 0)
            keys = [c[suffix] for c in (head, a, b)]
            equal = np.zeros(len(suffix), bool)
            if len(suffix):
                equal[1:] = np.logical_and.reduce([c[1:] == c[:-1] for c in keys])
                equal[0] = last is not None and all(c[0] == x for c, x in zip(keys, last, strict=True))
                last = [c[-1] for c in keys]
            chosen = np.append(np.flatnonzero(length > 0), suffix[equal])
            spans = np.where(length[chosen] > 0, length[chosen], size)
            yield _table(arrow, [row[chosen], start[chosen], spans])

    order = ["head", "a", "b", "id", "row", "start"]
    return suffixes.repartition("head", "a", "b").sortWithinPartitions(*order).mapInArrow(run, schema)


def _packed(documents: DataFrame) -> DataFrame:
    """Texts compressed, as they are shuffled."""
    kinds = documents.select("row", "doc_id", "id", F.lit(b"").alias("packed")).schema
    arrow = arrow_schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(1).compress
        for batch in batches:
            packed = [compress(t.encode()) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(packed, pa.binary())], schema=arrow)

    return documents.select("row", "doc_id", "id", "text").mapInArrow(run, kinds)


def _with_spans(documents: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """(row, doc_id, id, packed, spans) of every document; spans may overlap and cover all bytes to remove."""
    numbered = documents.select(
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("id"),
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    long_enough = numbered.select("id", "row", "text").where(F.octet_length("text") >= size)
    found = materialise(_dictionary(_sent(long_enough, size), size), "parse-dictionary")
    kind, length = F.col("code") % 4, F.floor(F.col("code") / 4).cast("int")
    wanted = found.where(kind == ENTRY).groupBy("row").agg(F.collect_list(F.struct("start", "code")).alias("entries"))
    # one shuffle of the texts serves both joins, so both take the same columns
    packed = _packed(numbered)
    suffixes = _suffixes(packed.join(wanted, "row").select("doc_id", "id", "row", "packed", "entries"), size)
    spans = (
        _neighbours(suffixes, size)
        .unionByName(found.where(kind == SPAN).select("row", "start", length.alias("length")))
        .groupBy("row")
        .agg(F.collect_list(F.struct("start", "length")).alias("spans"))
    )
    return packed.join(spans, "row", "left").select("doc_id", "id", "packed", "spans")


def merged(spans: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs (start, end) of spans that overlap or touch."""
    out: list[tuple[int, int]] = []
    for start, end in sorted((s["start"], s["start"] + s["length"]) for s in spans or ()):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def kept(data: bytes, runs: list[tuple[int, int]]) -> bytes:
    parts, at = [], 0
    for start, end in runs:
        parts.append(data[at:start])
        at = end
    return b"".join([*parts, data[at:]])


def remove_repeated_bytes(
    documents: DataFrame, size: int = SIZE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document: (doc_id, n_bytes, n_removed, n_spans, kept); ``kept`` is what is left, as bytes."""

    kind = documents.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept binary"
    arrow = _schema(documents, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out, held = [], 0
            for doc, _, packed, spans in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                data, runs = unpack(packed), merged(spans)
                rest = kept(data, runs)
                out.append((doc, len(data), len(data) - len(rest), len(runs), rest))
                held += len(rest)
                if held > 1 << 25:
                    yield _table(arrow, list(zip(*out, strict=True)))
                    out, held = [], 0
            if out:
                yield _table(arrow, list(zip(*out, strict=True)))

    return _with_spans(documents, doc_id, text, size).mapInArrow(run, schema)


def removal_report(documents: DataFrame, size: int = SIZE) -> DataFrame:
    """``remove_repeated_bytes`` with the SHA-256 of what is left instead of the bytes."""
    return remove_repeated_bytes(documents, size).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )
