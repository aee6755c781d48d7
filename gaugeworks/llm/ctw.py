"""Language-model scores by context-tree weighting over bytes.

A text is its words in lower case, apart by spaces, and one end. Every byte is coded as
eight binary decisions. For a decision, a context is the bits of the byte so far and
the ``0 .. DEPTH`` bytes before it. Each context has a Krichevsky-Trofimov estimate
from its counts, and the tree weights, for every context, its own estimate against
what the longer contexts make of the same data, by how well either would have coded
the training texts. The probability of a decision is the weighted mixture along its
path. Contexts without training data have no say.

Counts of all (context, byte) pairs of the corpus come from one pass and a Spark
aggregation, and all of them are in the model, so it grows with the corpus. The tree is
worked out in parts: a part is everything below a context of ``TOP + 1`` bytes, at most
2^24 pairs, and its task needs nothing else. A first pass over the parts adds up how well
they code, for each context of ``TOP`` bytes; these contexts, at most 2^16 whatever the
corpus, are weighed on the driver; a second pass gives every pair its probability. Pairs
that only texts not learnt from have are among them with count 0: they get a probability,
but change none.

The ``MAX_PAIRS_SENT`` most frequent pairs and ``MAX_WORDS_SENT`` most frequent words,
which are most positions, are looked up in a bounded table; the positions of all others
are joined to the full tables. So the bounds move work, not results. The unigram base
compares words by 64-bit hashes.

Null and empty texts are one end. Repeated rows count as often as they occur. With
nothing to learn from, every byte has probability 1/256.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import arrow_rows, id_remainder, map_batches, words
from gaugeworks.llm.encoding import chunks
from gaugeworks.sources.shared import materialise

DEPTH = 5
TOP = 2
MAX_PAIRS_SENT = 1 << 21
MAX_WORDS_SENT = 1 << 18
WORDS_IN_TASK = 250_000
PAIRS_IN_TASK = 1_000_000
CHARACTERS_AT_ONCE = 1_000_000
PART_ROWS = 300_000
END = b"\n"
PAIR, WORD = 0, 1


def stream_keys(streams: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(key, text) of every byte: the byte and, above it, the ``DEPTH`` bytes before it.

    The nearest byte is the lowest, so a mask shortens a context. Before a text stand
    ends."""
    pad = END * DEPTH
    lengths = np.array([len(s) for s in streams])
    data = np.frombuffer(b"".join([pad + s for s in streams]), np.uint8)
    text = np.repeat(np.arange(len(streams)), lengths)
    at = np.arange(len(text)) + DEPTH * (text + 1)
    whole = data.astype(np.int64)
    keys = whole.copy()
    for j in range(1, DEPTH + 1):
        keys[j:] |= whole[:-j] << (8 * j)
    return keys[at], text


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function for x > 0: eight steps up, then Stirling's series."""
    product = np.ones_like(x)
    for k in range(8):
        product *= x + k
    y = x + 8
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log probability that the estimator gives to any order of these decisions."""
    half = 2 * log_gamma(np.array([0.5]))[0]
    return log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - half


@dataclass
class Level:
    """Decisions in all contexts of one depth, sorted by number.

    ``number`` holds the context above the first bits of the byte, which a one marks;
    ``of_pair`` says where the decision of each pair is.
    """

    number: np.ndarray
    zeros: np.ndarray
    ones: np.ndarray
    of_pair: np.ndarray


def decisions(keys: np.ndarray, counts: np.ndarray, bits: int) -> Level:
    """The decisions after ``bits`` bits on the way to the bytes of sorted pairs."""
    byte = keys & 255
    number = (keys & ~255) | (1 << bits) | (byte >> (8 - bits))
    begin = np.diff(number, prepend=-1) != 0
    first = np.flatnonzero(begin)
    one = counts * ((byte >> (7 - bits)) & 1)
    ones = np.add.reduceat(one, first).astype(float)
    zeros = np.add.reduceat(counts - one, first).astype(float)
    return Level(number[first], zeros, ones, np.cumsum(begin) - 1)


def shorter(number: np.ndarray, depth: int) -> np.ndarray:
    """The same decisions in contexts of ``depth`` bytes, their farthest byte left out."""
    return ((number >> 8) & ((1 << 8 * (depth - 1)) - 1)) << 8 | (number & 255)


def by_depth(keys: np.ndarray, counts: np.ndarray, depths: range) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sorted keys and counts of the pairs in their contexts of each depth.

    ``keys`` are sorted and have contexts of the last depth."""
    out = [(keys, counts)]
    for depth in reversed(depths[:-1]):
        keys, where = np.unique(keys & ((1 << 8 * (depth + 1)) - 1), return_inverse=True)
        counts = np.bincount(where, counts, len(keys)).astype(np.int64)
        out.append((keys, counts))
    return out[::-1]


def weigh(
    levels: list[Level], depths: range, split: np.ndarray | None = None
) -> tuple[list[np.ndarray], np.ndarray, list[np.ndarray]]:
    """Weights of the own estimates, totals of the first depth, and parents; by depth.

    ``split`` is what longer contexts make of the data of the last depth, if there are any."""
    weights: list[np.ndarray] = [np.empty(0)] * len(levels)
    parents: list[np.ndarray] = [np.empty(0, np.int64)] * len(levels)
    for k in reversed(range(len(levels))):
        total = own = log_estimate(levels[k].zeros, levels[k].ones)
        weights[k] = np.ones(len(own))
        if split is not None:
            total = np.logaddexp(own, split) - np.log(2)
            weights[k] = np.exp(np.minimum(0.0, own - np.log(2) - total))
        if k:
            above = levels[k - 1].number
            parents[k] = np.searchsorted(above, shorter(levels[k].number, depths[k]))
            split = np.bincount(parents[k], total, len(above))
    return weights, total, parents


@dataclass
class Mixed:
    """Of decisions: the mixture so far, the weight that is left, and the probability of a
    one where the context is the longest."""

    sum: np.ndarray
    left: np.ndarray
    one: np.ndarray

    def take(self, at: np.ndarray) -> Mixed:
        return Mixed(self.sum[at], self.left[at], self.one[at])

    def below(self, level: Level, weight: np.ndarray) -> Mixed:
        """One byte further; ``self`` is aligned with ``level``."""
        seen = level.zeros + level.ones
        estimate = (level.ones + 0.5) / (seen + 1)
        share = np.where(seen > 0, weight, 0.0)
        one = np.where(seen > 0, self.sum + self.left * estimate, self.one)
        return Mixed(self.sum + self.left * share * estimate, self.left * (1 - share), one)


def start(size: int) -> Mixed:
    return Mixed(np.zeros(size), np.ones(size), np.full(size, 0.5))


PART_DEPTHS = range(TOP + 1, DEPTH + 1)
TOP_DEPTHS = range(TOP + 1)


def code_lengths(keys: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """Of whole parts, for each decision in a context of ``TOP`` bytes: its counts, and
    how well the longer contexts code its data."""
    pairs = by_depth(keys, counts, PART_DEPTHS)
    found = []
    for bits in range(8):
        levels = [decisions(k, n, bits) for k, n in pairs]
        _, total, _ = weigh(levels, PART_DEPTHS)
        number, at = np.unique(shorter(levels[0].number, TOP + 1), return_inverse=True)
        sums = [np.bincount(at, x, len(number)) for x in (levels[0].zeros, levels[0].ones, total)]
        found.append((number, sums[0].astype(np.int64), sums[1].astype(np.int64), sums[2]))
    columns = [np.concatenate(c) for c in zip(*found, strict=True)]
    return dict(zip(("number", "zeros", "ones", "split"), columns, strict=True))


def mix_top(number: np.ndarray, zeros: np.ndarray, ones: np.ndarray, split: np.ndarray) -> Mixed:
    """The mixtures of all decisions in contexts of ``TOP`` bytes, which are sorted."""
    levels = [Level(number, zeros.astype(float), ones.astype(float), np.empty(0))]
    for depth in reversed(TOP_DEPTHS[1:]):
        above, at = np.unique(shorter(levels[0].number, depth), return_inverse=True)
        sums = [np.bincount(at, x, len(above)) for x in (levels[0].zeros, levels[0].ones)]
        levels.insert(0, Level(above, *sums, np.empty(0)))
    weights, _, parents = weigh(levels, TOP_DEPTHS, split)
    mixed = start(len(levels[0].number)).below(levels[0], weights[0])
    for level, weight, parent in list(zip(levels, weights, parents, strict=True))[1:]:
        mixed = mixed.take(parent).below(level, weight)
    return mixed


def probabilities(keys: np.ndarray, counts: np.ndarray, number: np.ndarray, top: Mixed) -> np.ndarray:
    """log10 probability of every pair of whole parts; ``top`` has the decisions ``number``."""
    pairs = by_depth(keys, counts, PART_DEPTHS)
    score = np.zeros(len(keys))
    for bits in range(8):
        levels = [decisions(k, n, bits) for k, n in pairs]
        weights, _, parents = weigh(levels, PART_DEPTHS)
        parents[0] = np.searchsorted(number, shorter(levels[0].number, TOP + 1))
        mixed = top
        for level, weight, parent in zip(levels, weights, parents, strict=True):
            mixed = mixed.take(parent).below(level, weight)
        one = mixed.one[levels[-1].of_pair]
        score += np.log10(np.where((keys >> (7 - bits)) & 1, one, 1 - one))
    return score


class Table:
    """Values by whole numbers, in open addressing, looked up by the million.

    Tasks are sent ``arrays()`` and make a table ``of_arrays``."""

    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    @classmethod
    def of_arrays(cls, keys: np.ndarray, values: np.ndarray) -> Table:
        table = cls.__new__(cls)
        table.bits, table.keys, table.values = len(keys).bit_length() - 1, keys, values
        return table

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        return self.keys, self.values

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, (3 * len(keys) // 2).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.zeros(1 << self.bits, np.float32)
        slot = self.slot(keys)
        rest = np.arange(len(keys))
        while len(rest):
            free = rest[self.keys[slot[rest]] == -1]
            self.keys[slot[free]] = keys[free]  # of several, the last gets the slot
            rest = rest[self.keys[slot[rest]] != keys[rest]]
            slot[rest] = (slot[rest] + 1) & ((1 << self.bits) - 1)
        self.values[slot] = values

    def slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * self.FACTOR
        return ((mixed ^ (mixed >> np.uint64(29))) * self.FACTOR >> np.uint64(64 - self.bits)).astype(np.int64)

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(values, found)."""
        slot = self.slot(keys)
        there = self.keys[slot]
        values = self.values[slot].astype(np.float64)
        found = there == keys
        rest = np.flatnonzero(~found & (there != -1))
        while len(rest):
            slot[rest] = (slot[rest] + 1) & ((1 << self.bits) - 1)
            there = self.keys[slot[rest]]
            hit = there == keys[rest]
            found[rest[hit]] = True
            values[rest[hit]] = self.values[slot[rest[hit]]]
            rest = rest[~hit & (there != -1)]
        return values, found


def gather(documents: DataFrame, text: str, learn: str) -> DataFrame:
    """(kind, key, n): training counts of all pairs and words of the corpus, stored.

    Pairs of texts that are not learnt from are there too, with count 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def rows(kind: int, keys: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
            kinds = np.full(len(keys), kind, np.int8)
            yield from arrow_rows({"kind": kinds, "key": keys, "n": n.astype(np.int64)})

        def word_rows() -> Iterator[pa.RecordBatch]:
            keys = np.array([xxhash.xxh3_64_intdigest(w) for w in found], np.uint64).view(np.int64)
            yield from rows(WORD, keys, np.fromiter(found.values(), np.int64, len(found)))
            found.clear()

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, where = np.unique(np.concatenate([k for k, _ in held]), return_inverse=True)
            return keys, np.bincount(where, np.concatenate([n for _, n in held]), len(keys))

        for batch in batches:
            learnt = batch.column(1).to_pylist()
            at = 0
            for texts in chunks(batch.column(0).to_pylist(), CHARACTERS_AT_ONCE):
                split = [words(t) for t in texts]
                use = np.array(learnt[at : at + len(texts)], bool)
                at += len(texts)
                for ws, u in zip(split, use, strict=True):
                    if u:
                        found.update(ws)
                found[END] += int(use.sum())
                keys, text_of = stream_keys([b" ".join(ws) + END for ws in split])
                kept = use[text_of]
                held.append(np.unique(keys[kept], return_counts=True))
                other = np.unique(keys[~kept])
                held.append((other, np.zeros(len(other), np.int64)))
                del keys, text_of, kept, split
                if len(found) > WORDS_IN_TASK:
                    yield from word_rows()
                if sum(len(k) for k, _ in held[1:]) > PAIRS_IN_TASK:
                    held[:] = [merged()]
                    if len(held[0][0]) > PAIRS_IN_TASK:
                        yield from rows(PAIR, *held.pop())
        yield from word_rows()
        if held:
            yield from rows(PAIR, *merged())

    counted = (
        documents.select(text, learn)
        .mapInArrow(run, "kind tinyint, key long, n long")
        .groupBy("kind", "key")
        .agg(F.sum("n").alias("n"))
    )
    return materialise(counted.where((F.col("kind") == PAIR) | (F.col("n") > 0)), "gathered")


def map_parts(pairs: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``function(keys, counts)``, whose result is columns, of one or more whole parts at a time."""
    part = F.shiftright("key", 8).bitwiseAND((1 << 8 * (TOP + 1)) - 1)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        held, limit = [], PART_ROWS
        for batch in batches:
            held.append(np.stack([batch.column(i).to_numpy() for i in range(2)]))
            if sum(h.shape[1] for h in held) >= limit:
                rows = np.concatenate(held, 1)
                of = (rows[0] >> 8) & ((1 << 8 * (TOP + 1)) - 1)
                cut = int(np.searchsorted(of, of[-1]))  # the last part may go on
                if cut:
                    yield rows[0, :cut], rows[1, :cut]
                held = [rows[:, cut:].copy()]
                limit = max(PART_ROWS, 2 * held[0].shape[1])
        if held:
            rows = np.concatenate(held, 1)
            yield rows[0], rows[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, counts in parts(batches):
            order = np.argsort(keys)
            yield from arrow_rows(function(keys[order], counts[order]))

    dealt = pairs.select("key", "n", part.alias("part")).repartition("part").sortWithinPartitions("part")
    return dealt.select("key", "n").mapInArrow(run, schema)


def train(counted: DataFrame) -> DataFrame:
    """(key, n, value): the model, which is the log10 probability of every pair; stored."""
    pairs = counted.where(F.col("kind") == PAIR)
    sums = (
        map_parts(pairs, code_lengths, "number long, zeros long, ones long, split double")
        .groupBy("number")
        .agg(*[F.sum(c).alias(c) for c in ("zeros", "ones", "split")])
        .toArrow()  # at most 2^16 contexts with 255 decisions each
    )
    number, *rest = (sums[c].to_numpy() for c in ("number", "zeros", "ones", "split"))
    order = np.argsort(number)
    top = mix_top(number[order], *[c[order] for c in rest])
    shared = counted.sparkSession.sparkContext.broadcast((number[order], top.sum, top.left, top.one))

    def function(keys: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
        number, *mixed = shared.value
        return {"key": keys, "n": counts, "value": probabilities(keys, counts, number, Mixed(*mixed))}

    return materialise(map_parts(pairs, function, "key long, n long, value double"), "model")


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The rows with the largest ``n``, at most ``most``."""
    level = F.floor(F.log2("n"))
    sizes = counts.where("n > 0").groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("rows")).collect()
    total, lowest = 0, 64
    for row in sorted(sizes, key=lambda r: -r.level):
        if total + row.rows > most:
            break
        total, lowest = total + row.rows, row.level
    return counts.where((F.col("n") > 0) & (level >= lowest))


def score(documents: DataFrame, learn: str, text: str = "text", max_pairs_sent: int = MAX_PAIRS_SENT) -> DataFrame:
    """``documents`` without ``text`` and ``learn``, with the scores of every row.

    ``learn`` is a boolean column: whether the row is learnt from.
    """
    counted = gather(documents, text, learn)
    spark = documents.sparkSession
    counts = counted.where(F.col("kind") == WORD)
    totals = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    space = totals.n + 0.1 * (totals.v + 1)
    model = train(counted)
    sent = most_frequent(model, max_pairs_sent).select("key", "value").toArrow()
    often = most_frequent(counts, MAX_WORDS_SENT).select("key", "n").toArrow().sort_by("key")
    shared = spark.sparkContext.broadcast(
        (
            *Table(sent["key"].to_numpy(), sent["value"].to_numpy()).arrays(),
            often["key"].to_numpy(),
            np.log10((often["n"].to_numpy() + 0.1) / space),
        )
    )
    rest = [c for c in documents.columns if c not in (text, learn)]

    def function():
        *arrays, frequent, logs = shared.value
        pairs = Table.of_arrays(*arrays)
        hashes: dict[bytes, int] = {}

        def convert(batch: pa.RecordBatch) -> dict:
            n_tokens, known, base, rare, rare_pairs, scores = [], [], [], [], [], []
            for texts in chunks(batch.column(batch.num_columns - 1).to_pylist(), CHARACTERS_AT_ONCE):
                split = [words(t) for t in texts]
                keys, text_of = stream_keys([b" ".join(ws) + END for ws in split])
                values, hit = pairs.look_up(keys)
                scores.append(np.bincount(text_of[hit], values[hit], len(split)))
                missed = np.cumsum(np.bincount(text_of[~hit], minlength=len(split)))
                rare_pairs += np.split(keys[~hit], missed[:-1])
                del keys, text_of, values, hit
                if len(hashes) > WORDS_IN_TASK:
                    hashes.clear()
                for word in set().union(*split, [END]).difference(hashes):
                    hashes[word] = xxhash.xxh3_64_intdigest(word)
                for ws in split:
                    ws.append(END)
                    tokens = np.fromiter(map(hashes.__getitem__, ws), np.uint64, len(ws)).view(np.int64)
                    n_tokens.append(len(ws))
                    if len(frequent):
                        at = np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)
                        hit = frequent[at] == tokens
                        known.append(int(hit.sum()))
                        base.append(float(logs[at[hit]].sum()))
                        tokens = tokens[~hit]
                    else:
                        known.append(0)
                        base.append(0.0)
                    rare.append(tokens)
            kept = {c: batch.column(i) for i, c in enumerate(rest)}
            return kept | {
                "_n": n_tokens, "_known": known, "_base": base, "_rare": rare, "_pairs": rare_pairs,
                "_score": np.concatenate(scores),
            }

        return convert

    source = documents.select(*rest, text)
    kinds = "".join(f"`{c}` {source.schema[c].dataType.simpleString()}, " for c in rest)
    found = map_batches(
        source,
        function,
        f"{kinds}_n long, _known long, _base double, _rare array<long>, _pairs array<long>, _score double",
    )
    found = materialise(found.withColumn("_row", F.monotonically_increasing_id()), "scored")
    rare = found.select("_row", F.lit(WORD).alias("kind"), F.explode("_rare").alias("key")).union(
        found.select("_row", F.lit(PAIR).alias("kind"), F.explode("_pairs").alias("key"))
    )
    values = counts.select(
        "kind", "key", F.lit(1).alias("known"), F.log10((F.col("n") + 0.1) / F.lit(space)).alias("value")
    ).union(model.select(F.lit(PAIR).alias("kind"), "key", F.lit(0).alias("known"), "value"))
    unknown = F.log10(F.lit(0.1) / F.lit(space))  # of a word; the model has all pairs
    of_rare = (
        rare.join(values, ["kind", "key"], "left")
        .groupBy("_row")
        .agg(
            F.sum(F.when(F.col("kind") == WORD, F.coalesce("value", unknown))).alias("more"),
            F.sum(F.when(F.col("kind") == PAIR, F.col("value"))).alias("deeper"),
            F.sum("known").alias("also"),
        )
    )
    return found.join(of_rare, "_row", "left").select(
        *rest,
        F.col("_n").alias("n_tokens"),
        (F.col("_known") + F.coalesce("also", F.lit(0))).alias("n_known"),
        F.lit(totals.n).cast("long").alias("train_tokens"),
        (F.col("_base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("_score") + F.coalesce("deeper", F.lit(0.0))).alias("score"),
    )


def score_documents(documents: DataFrame) -> DataFrame:
    """Scores of all documents, learnt from those whose id hash modulo 10 is not 0."""
    held_out = id_remainder(F.col("doc_id"), 10) == 0
    source = documents.select(
        "doc_id", held_out.alias("held_out"), (~held_out).alias("learn"), "text"
    )
    return score(source, "learn")
