"""Jaccard self-join of documents on word shingles, by a grouped prefix join.

Two sets with a Jaccard similarity of at least ``t`` share one of their first
``n - ceil(t * n) + 1`` shingles in any order that all sets agree on. Here, shingles
that many documents share come last, the rest in the order of their 64-bit hash, so a
passage of a third of all documents hardly ever gets into a prefix. That order is the
only use of the frequencies: they are counted over all documents, but of the frequent
shingles only the ``MAX_FREQUENT`` most frequent are put last, which bounds what is
sent to the tasks and changes no result.

Equal sets are one class. Classes with the same prefix and size are one group, and
only groups are joined on prefix shingles. Candidates whose prefixes share too little
are left out, the others are expanded to classes and verified on whole sets.

Component ids need no list of all links. First every group of a shingle is compared
with the one that shares most, and components are formed; then again with another one,
chosen at random; at last all remaining candidates from different components are
verified. A cluster of many near copies so costs a few comparisons per member, and a
pair is left out only if its documents are connected already.

A text without words has an empty set and links with nothing. Null texts count as
empty. Repeated rows and null ids are allowed; a null id is never a component id
unless the whole component has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import components, map_batches, small_batches, words
from gaugeworks.sources.shared import materialise

SHINGLE = 5
PERCENT = 75
MAX_FREQUENT = 1 << 18
#: A shingle is reported by a task when it is in so many of the task's documents.
SEEN_OFTEN = 2
FREQUENT = 8
TOKENS_AT_ONCE = 1_500_000
#: Rows of two numbers and a 16-byte key, so at most some 10 MB.
MAX_BROADCAST = 150_000
MAX_WORDS = 150_000


class Shingler:
    """Sorted distinct 64-bit hashes of the shingles of a text."""

    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.hashes: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        split = words(text)
        if not split:
            return np.zeros(0, np.uint64)
        known = self.hashes
        if len(known) > MAX_WORDS:
            known.clear()
        for word in set(split).difference(known):
            known[word] = xxhash.xxh3_64_intdigest(word)
        of_words = np.fromiter(map(known.__getitem__, split), np.uint64, len(split))
        span = min(self.size, len(split))
        h = np.full(len(split) - span + 1, np.uint64(span))
        for k in range(span):
            h = (h ^ (h >> np.uint64(29))) * self.FACTOR + of_words[k : len(split) - span + 1 + k]
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return np.unique(h ^ (h >> np.uint64(32)))


def frequent_shingles(documents: DataFrame, text: str, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, and in how many documents each was seen.

    A task reports a shingle that occurs in ``SEEN_OFTEN`` of the documents it holds at a
    time; counts are added up by Spark. At most ``MAX_FREQUENT`` rows are collected.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        held: list[np.ndarray] = []
        total = 0

        def often() -> pa.RecordBatch:
            tokens = np.concatenate(held)
            held.clear()
            tokens.sort()
            start = np.flatnonzero(np.append(True, tokens[1:] != tokens[:-1]))
            n = np.diff(start, append=len(tokens))
            keep = n >= SEEN_OFTEN
            return pa.RecordBatch.from_arrays(
                [pa.array(tokens[start[keep]].view(np.int64)), pa.array(n[keep])], ["shingle", "n"]
            )

        for batch in batches:
            for content in batch.column(0).to_pylist():
                held.append(shingler(content))
                total += len(held[-1])
                if total >= TOKENS_AT_ONCE:
                    yield often()
                    total = 0
        if total:
            yield often()

    counted = materialise(
        documents.select(text)
        .mapInArrow(run, "shingle long, n long")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") >= FREQUENT),
        "shingle-counts",
    )
    level = F.floor(F.log2("n"))
    sizes = counted.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("rows")).collect()
    total, lowest = 0, 64
    for row in sorted(sizes, key=lambda r: -r.level):
        if total + row.rows > MAX_FREQUENT:
            break
        total, lowest = total + row.rows, row.level
    rows = counted.where(level >= lowest).collect()
    shingles = np.array([r.shingle for r in rows], np.int64).view(np.uint64)
    order = np.argsort(shingles)
    return shingles[order], np.array([r.n for r in rows], np.int64)[order]


def prefix(tokens: np.ndarray, frequent: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles of a sorted set in the common order: frequent ones last."""
    length = len(tokens) - -(-percent * len(tokens) // 100) + 1
    if not len(frequent):
        return tokens[:length]
    at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
    often = frequent[at] == tokens
    rare = tokens[~often]
    if len(rare) >= length:
        return rare[:length]
    last = np.lexsort((tokens[often], counts[at[often]]))
    return np.concatenate([rare, tokens[often][last]])[:length]


def sets(documents: DataFrame, doc: str, text: str, percent: int, size: int) -> DataFrame:
    """(doc, n, key, group, prefix) of every row, stored, with a row number."""
    frequent, counts = frequent_shingles(documents, text, size)
    shared = documents.sparkSession.sparkContext.broadcast((frequent, counts))

    def function():
        shingler = Shingler(size)
        often, n_often = shared.value

        def convert(batch: pa.RecordBatch) -> dict:
            n, key, group, start = [], [], [], []
            for content in batch.column(1).to_pylist():
                tokens = shingler(content)
                first = prefix(tokens, often, n_often, percent) if len(tokens) else tokens
                n.append(len(tokens))
                key.append(xxhash.xxh3_128_digest(tokens.tobytes()))
                group.append(xxhash.xxh3_64_intdigest(first.tobytes(), len(tokens)) - (1 << 63))
                start.append(first.view(np.int64))
            offsets = np.cumsum([0, *map(len, start)]).astype(np.int32)
            flat = np.concatenate([*start, np.zeros(0, np.int64)])
            prefixes = pa.ListArray.from_arrays(offsets, flat)
            return {"doc": batch.column(0), "n": n, "key": key, "group": group, "prefix": prefixes}

        return convert

    kind = documents.schema[doc].dataType.simpleString()
    found = map_batches(
        documents.select(doc, text),
        function,
        f"doc {kind}, n long, key binary, group long, prefix array<long>",
    )
    return materialise(found.withColumn("row", F.monotonically_increasing_id()), "sets")


def whole_sets(documents: DataFrame, doc: str, text: str, wanted: DataFrame, size: int) -> DataFrame:
    """(class, tokens) of the classes in ``wanted`` (class, doc, key), computed from their texts.

    ``doc`` is the id of a row with that set."""
    texts = documents.select(F.col(doc).alias("id"), F.col(text).alias("text"))
    if wanted.count() <= MAX_BROADCAST:  # else the texts are shuffled
        wanted = F.broadcast(wanted)
    joined = wanted.join(texts, F.col("doc").eqNullSafe(F.col("id"))).select("class", "key", "text")

    def function():
        shingler = Shingler(size)

        def convert(batch: pa.RecordBatch) -> dict:
            found = [shingler(t).tobytes() for t in batch.column(2).to_pylist()]
            # rows may share an id; the key tells which of them is meant
            same = [xxhash.xxh3_128_digest(f) == k for f, k in zip(found, batch.column(1).to_pylist(), strict=True)]
            keep = pa.array(np.flatnonzero(same))
            return {"class": batch.column(0).take(keep), "tokens": pa.array(found, "binary").take(keep)}

        return convert

    found = map_batches(joined, function, "class long, tokens binary")
    return materialise(found, "whole-sets").dropDuplicates(["class"])


def verify(pairs: DataFrame, tokens: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked) for every pair of classes."""
    left = tokens.select(F.col("class").alias("a"), F.col("tokens").alias("tokens_a"))
    right = tokens.select(F.col("class").alias("b"), F.col("tokens").alias("tokens_b"))

    def function():
        def convert(batch: pa.RecordBatch) -> dict:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):  # without copies
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            return {"a": batch.column(0), "b": batch.column(1), "linked": linked}

        return convert

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "tokens_a", "tokens_b")
    return materialise(map_batches(joined, function, "a long, b long, linked boolean"), "verified")


def _overlap(n: str, m: str, percent: int) -> Column:
    """The smallest overlap of two similar sets of these sizes."""
    return F.expr(f"({percent} * ({n} + {m}) + {100 + percent - 1}) div {100 + percent}")


def _may_meet(n: str, place: str, percent: int) -> Column:
    """Whether sets of sizes ``n`` can be similar if the shingle at these places of their
    prefixes is the first one they share; for one shingle of every similar pair it is."""
    most = 1 + F.least(F.col("n") - F.col("place") - 1, F.col(n) - F.col(place) - 1)
    return most >= _overlap("n", n, percent)


def _proposals(lists: DataFrame, step: int, percent: int) -> DataFrame:
    """Pairs (a, b) of every member of a list with one member; ``lists`` is (list, class, n,
    place, component).

    First that is the member with the largest part of its shingles in lists: of many
    edited copies, the text they come from, which is near to all of them. Then it is a
    member chosen at random for each list.
    """
    if step == 0:
        shared = lists.groupBy("class").agg(F.count(F.lit(1)).alias("shared"))
        lists = lists.join(shared, "class")
        rank = F.struct(-F.col("shared") / F.col("n"), F.xxhash64("class"))
    else:
        rank = F.xxhash64(F.concat_ws("-", "class", "list", F.lit(step)))
    order = F.struct(
        rank.alias("h"),
        F.col("class").alias("centre"),
        F.col("n").alias("centre_n"),
        F.col("place").alias("centre_place"),
        F.col("component").alias("centre_component"),
    )
    centres = lists.groupBy("list").agg(F.min(order).alias("m")).select("list", "m.*")
    return (
        lists.join(centres, "list")
        .where(
            (F.col("component") != F.col("centre_component"))
            & _may_meet("centre_n", "centre_place", percent)
        )
        .select(F.least("class", "centre").alias("a"), F.greatest("class", "centre").alias("b"))
        .distinct()
    )


def _needed(n: str, m: str, percent: int) -> Column:
    """How many shingles the prefixes of two sets must share.

    Up to the end of the prefix that ends first, common shingles are in both prefixes.
    Beyond it that set has one shingle less than ``percent`` of its size, so they add at
    most that many to the overlap.
    """
    beyond = F.expr(f"({percent} * greatest({n}, {m}) + 99) div 100 - 1")
    return _overlap(n, m, percent) - beyond


def _screened(pairs: DataFrame, rows: DataFrame, percent: int) -> DataFrame:
    """Pairs whose prefixes share enough."""
    left = rows.select(F.col("row").alias("a"), F.col("n").alias("n_a"), F.col("prefix").alias("prefix_a"))
    right = rows.select(F.col("row").alias("b"), F.col("n").alias("n_b"), F.col("prefix").alias("prefix_b"))
    both = F.size(F.array_intersect("prefix_a", "prefix_b"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .where(both >= _needed("n_a", "n_b", percent))
        .select("a", "b")
    )


def _rest(lists: DataFrame, percent: int) -> DataFrame:
    """All pairs of one list from different components that may be similar enough."""
    other = lists.select(
        "list",
        F.col("class").alias("class_b"),
        F.col("n").alias("n_b"),
        F.col("place").alias("place_b"),
        F.col("component").alias("component_b"),
    )
    return (
        lists.join(other, "list")
        .where((F.col("component") < F.col("component_b")) & _may_meet("n_b", "place_b", percent))
        .select(F.least("class", "class_b").alias("a"), F.greatest("class", "class_b").alias("b"))
        .distinct()
    )


def join(
    documents: DataFrame,
    doc: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    size: int = SHINGLE,
) -> DataFrame:
    """(row, doc, n, component) of every row: set size and smallest id reachable by links.

    ``row`` numbers the rows of the result.
    """
    with small_batches(documents.sparkSession):
        return _join(documents, doc, text, percent, size)


def _join(documents: DataFrame, doc: str, text: str, percent: int, size: int) -> DataFrame:
    rows = sets(documents, doc, text, percent, size)
    classes = materialise(
        rows.where("n > 0").groupBy("key", "n").agg(
            F.min("row").alias("class"), F.min("doc").alias("doc"), F.min("group").alias("group")
        ),
        "classes",
    )
    lists = materialise(_shared_lists(rows, classes), "candidates")
    links = checked = None
    current = lists.withColumn("component", F.col("class"))
    for step in range(3):
        pairs = _proposals(current, step, percent) if step < 2 else _rest(current, percent)
        pairs = _screened(materialise(pairs, "proposals"), rows, percent)
        if checked is not None:
            pairs = pairs.join(checked, ["a", "b"], "left_anti")
        pairs = materialise(pairs, "pairs")
        if checked is not None and pairs.isEmpty():
            continue
        ends = pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()
        wanted = materialise(classes.join(ends, "class").select("class", "doc", "key"), "wanted")
        found = verify(pairs, whole_sets(documents, doc, text, wanted, size), percent)
        checked = found.select("a", "b") if checked is None else checked.union(found.select("a", "b"))
        linked = found.where("linked").select("a", "b")
        links = linked if links is None else links.union(linked)
        groups = components(links, "documents")
        if step < 2:
            current = materialise(_open_lists(lists, groups), "open")
            if current.isEmpty():
                break
    least = materialise(
        classes.join(groups.withColumnRenamed("id", "class"), "class", "left").select(
            "key", "doc", F.coalesce("component", "class").alias("component")
        ),
        "class-components",
    )
    smallest = least.groupBy("component").agg(F.min("doc").alias("component_doc"))
    named = least.join(smallest, "component").select("key", "component_doc")
    return rows.join(named, "key", "left").select(
        "row", "doc", "n", F.coalesce("component_doc", "doc").alias("component")
    )


def _shared_lists(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(list, class, n, place): classes whose groups share a prefix shingle, and those of one group."""
    postings = rows.select(F.posexplode("prefix").alias("place", "list"), "row")
    # stored, as a join side from an aggregation keeps adaptive execution from splitting hot lists
    often = materialise(
        postings.groupBy("list").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("list"),
        "frequent-lists",
    )
    of_row = rows.select("row", "group")
    places = materialise(
        postings.join(often, "list").join(of_row, "row").select("list", "group", "place").distinct(),
        "places",
    )
    # rows of one group, as copies are, have met here too
    several = materialise(
        places.groupBy("list").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("list"),
        "shared-lists",
    )
    members = classes.select("group", "class", "n")
    large = members.groupBy("group").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("group")
    return (
        places.join(several, "list")
        .join(members, "group")
        .select("list", "class", "n", "place")
        .union(
            members.join(large, "group").select(
                F.xxhash64("group").alias("list"), "class", "n", F.lit(0).alias("place")
            )
        )
    )


def _open_lists(lists: DataFrame, groups: DataFrame) -> DataFrame:
    """Lists that still have members from different components."""
    placed = lists.join(groups.withColumnRenamed("id", "class"), "class", "left").withColumn(
        "component", F.coalesce("component", "class")
    )
    split = (
        placed.groupBy("list")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low < high")
        .select("list")
    )
    return placed.join(split, "list").select("list", "class", "n", "place", "component")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    return join(documents).select(
        F.col("doc").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id")
    )


def keep_one(documents: DataFrame, text: str = "text") -> DataFrame:
    """One row of each component, the first by row number; rows without words all stay."""
    name = "jaccard_row"
    while name in {c.lower() for c in documents.columns}:
        name = f"_{name}"
    stored = materialise(documents.withColumn(name, F.monotonically_increasing_id()), "numbered")
    found = join(stored, doc=name, text=text)
    kept = found.where((F.col("n") == 0) | (F.col("doc") == F.col("component"))).select(F.col("doc").alias(name))
    return stored.join(kept, name).select(*documents.columns)
