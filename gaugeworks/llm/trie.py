"""The prefix trie of conversations: which turns many of them start with.

A node of depth d is a distinct sequence of first d turns. It is named by a 128-bit
key: the exclusive or of the digests of its turns, each mixed with its place. Keys of
prefixes are thus running totals, made without a task per conversation.

Turns are taken in blocks of ``BLOCK``. First conversations are grouped block by block:
those with the same key at the end of a block share all of its turns, so one
aggregation of one row per conversation and block counts them. Then turn boundaries
are refined: a block that has no sibling (another block after the same prefix) is a
plain chain, whose nodes all have the members of the block. Only blocks with siblings
are taken apart into turns, which are grouped by their keys.

Sums over subtrees need no walk. A node belongs to its smallest member, and what a
conversation owns is a tail of its own path. So the sum over a subtree is what its
members own, less what the smallest of them owns above the node: one more aggregation
of the same blocks and one running total.

Only numbers travel, never texts. A first turn that a third of all conversations share
is folded by partial aggregation, and a conversation with a third of all turns is
dealt out by range. The digest of the ids that end in one node is made from strings of
up to ``IDS`` ids, joined in many tasks; one task then streams these strings.

Turns without a conversation id are left out. Null roles and texts are empty, null turn
numbers come first, and turns with equal numbers follow in the order of their digests;
repeated rows are turns like others. A table without conversations has no nodes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import WHITE
from gaugeworks.llm.running import running_totals
from gaugeworks.sources.shared import materialise

BLOCK = 4
IDS = 256


def numbered_turns(
    conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, place, a, b, words): turns by place from 1, two digests of role and text, words of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    bare = F.regexp_replace(F.regexp_replace(text, f"^{WHITE}", ""), f"{WHITE}$", "")
    turns = conversations.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).alias("turn"),
        F.xxhash64(F.lit(1), role, text).alias("a"),
        F.xxhash64(F.lit(2), role, text).alias("b"),
        F.when(bare == "", 0).otherwise(F.size(F.split(bare, WHITE))).cast("long").alias("words"),
        F.lit(1).cast("long").alias("one"),
    )
    placed = running_totals(turns, "conv_id", ["turn", "a", "b"], {"place": "one"}, name="places")
    return placed.select("conv_id", "place", "a", "b", "words")


def rebuilt(turns: DataFrame, family: int = 20, most: int = 4) -> DataFrame:
    """Numbered turns whose first h, the id's crc32 modulo ``most``, come from the family's first conversation.

    That is the one whose id is the id less its remainder by ``family``; it gives all turns
    it has, if fewer, and none if it is absent.
    """
    base = F.col("conv_id") - F.col("conv_id") % family
    lent = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    heads = materialise(
        turns.where((F.col("conv_id") == base) & (F.col("place") < most)).withColumnRenamed("conv_id", "base"),
        "trie-heads",
    )
    sizes = materialise(heads.groupBy("base").agg(F.count(F.lit(1)).alias("size")), "trie-sizes")
    # ids that borrow nothing need no join
    borrowers = turns.select("conv_id").distinct().select("conv_id", base.alias("base"), lent.alias("lent")).where("lent > 0")
    borrowed = borrowers.join(heads, "base").where("place <= lent").select(*turns.columns)
    own = turns.select("*", base.alias("base"), lent.alias("lent")).where("place > lent").join(sizes, "base", "left")
    moved = F.col("place") - F.col("lent") + F.least("lent", F.coalesce("size", F.lit(0)))
    return borrowed.unionByName(own.withColumn("place", moved).select(*turns.columns))


def _mixed(lane: int, turn: Column) -> Column:
    """One half of a turn's digest, mixed with its place."""
    digest = turn.getField("ab"[lane])
    return F.xxhash64(F.lit(3 + lane), digest, turn.getField("place"))


def _blocks(turns: DataFrame, size: int) -> DataFrame:
    """One row per conversation and block: key before it, keys after each of its turns, their words."""
    block = ((F.col("place") - 1) / size).cast("long")
    grouped = (
        turns.withColumn("block", block)
        .groupBy("conv_id", "block")
        .agg(F.sort_array(F.collect_list(F.struct("place", "a", "b", "words"))).alias("turns"))
    )
    lanes = [F.transform("turns", partial(_mixed, i)) for i in (0, 1)]
    grouped = grouped.select("conv_id", "block", "turns.words", lanes[0].alias("la"), lanes[1].alias("lb"))
    xor = lambda x, y: x.bitwiseXOR(y)
    zero = F.lit(0).cast("long")
    own = grouped.withColumns({"xa": F.aggregate("la", zero, xor), "xb": F.aggregate("lb", zero, xor)})
    path = running_totals(own, "conv_id", ["block"], {"ea": "xa", "eb": "xb"}, "xor", "trie-paths")

    def keys(lane: str, start: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(1), F.size(lane)), lambda r: F.aggregate(F.slice(lane, F.lit(1), r), start, xor)
        )

    start = {c: xor(F.col(f"e{c}"), F.col(f"x{c}")) for c in "ab"}
    return path.select(
        "conv_id", "block", "words", "ea", "eb",
        start["a"].alias("sa"), start["b"].alias("sb"),
        keys("la", start["a"]).alias("ka"), keys("lb", start["b"]).alias("kb"),
    )


def _refined(groups: DataFrame, size: int) -> DataFrame:
    """Nodes of all blocks: (a, b, pa, pb, depth, words, conv_id, n_convs, saved, leaves)."""
    turn = F.arrays_zip("ka", "kb", "words")
    measures = ["conv_id", "n_convs", "saved", "leaves"]
    nodes = groups.select("*", F.posexplode(turn).alias("at", "turn")).select(
        F.col("turn.ka").alias("a"),
        F.col("turn.kb").alias("b"),
        *[
            F.when(F.col("at") == 0, F.col(f"s{c}")).otherwise(F.get(f"k{c}", F.col("at") - 1)).alias(f"p{c}")
            for c in "ab"
        ],
        (F.col("block") * size + F.col("at") + 1).alias("depth"),
        F.col("turn.words").alias("words"),
        "only",
        *measures,
    )
    same = ["a", "b", "pa", "pb", "depth", "words"]
    split = (
        nodes.where("not only")
        .groupBy(*same)
        .agg(F.min("conv_id").alias("conv_id"), *[F.sum(m).alias(m) for m in measures[1:]])
    )
    return nodes.where("only").select(*same, *measures).unionByName(split)


def _digests_of_ends(ends: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) from one (a, b, conv_id) per conversation."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts = [], []
            for a, b, c in zip(*[batch.column(i).to_pylist() for i in range(3)], strict=True):
                if rows and rows[-1][:2] == (a, b) and len(texts[-1]) < IDS:
                    texts[-1].append(str(c))
                else:
                    rows.append((a, b, c))
                    texts.append([str(c)])
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(v, pa.int64()) for v in zip(*rows, strict=True)], pa.array([",".join(t) for t in texts])],
                    names=["a", "b", "first", "ids"],
                )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None

        def finished(keys: list, states: list) -> pa.RecordBatch:
            a, b = zip(*keys, strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array([s.hexdigest() for s in states])],
                names=["a", "b", "ends_sha256"],
            )

        for batch in batches:
            keys, states = [], []
            for a, b, ids in zip(*[batch.column(i).to_pylist() for i in (0, 1, 3)], strict=True):
                if (a, b) == key:
                    state.update(b"," + ids.encode())
                    continue
                if key is not None:
                    keys.append(key)
                    states.append(state)
                key, state = (a, b), hashlib.sha256(ids.encode())
            if keys:
                yield finished(keys, states)
        if key is not None:
            yield finished([key], [state])

    order = ["a", "b", "conv_id"]
    ordered = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    joined = ordered.mapInArrow(chunks, "a long, b long, first long, ids string")
    by_node = joined.repartition("a", "b").sortWithinPartitions("a", "b", "first")
    return by_node.mapInArrow(digests, "a long, b long, ends_sha256 string")


def prefix_trie(turns: DataFrame, conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """All nodes of the trie, the root (depth 0) included.

    ``turns`` is what ``numbered_turns`` returns, ``conversations`` holds every ``conv_id``,
    those without turns too. Per node: ``conv_id`` of the smallest member, ``depth``,
    ``parent_conv_id``, ``n_convs`` (members), ``n_children``, ``n_leaves`` (childless nodes of
    its subtree), ``saved_tokens`` (words that its subtree repeats), ``ends_sha256`` (ids that end here).
    """
    rows = materialise(_blocks(turns, block), "trie-blocks")
    last = rows.groupBy("conv_id").agg(F.max_by(F.struct("ea", "eb"), "block").alias("end"))
    root = F.lit(0).cast("long")
    ends = materialise(
        conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
        .join(last, "conv_id", "left")
        .select("conv_id", F.coalesce("end.ea", root).alias("a"), F.coalesce("end.eb", root).alias("b")),
        "trie-ends",
    )
    key, same = ["ea", "eb"], ["block", "words", "sa", "sb", "ka", "kb"]
    groups = rows.groupBy(*key).agg(
        *[F.first(c).alias(c) for c in same], F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")
    )
    groups = materialise(groups, "trie-groups")
    alone = (
        groups.groupBy("sa", "sb")
        .agg(F.count(F.lit(1)).alias("siblings"), F.min("ea").alias("ea"), F.min("eb").alias("eb"))
        .where("siblings = 1")
        .select(*key, F.lit(True).alias("alone"))
    )
    groups = materialise(
        groups.join(alone, key, "left").withColumn("only", F.coalesce("alone", F.lit(False))).drop("alone"), "trie-siblings"
    )
    unknown = F.lit(0).cast("long")
    counted = _refined(groups.withColumns({"saved": unknown, "leaves": unknown}), block)
    children = counted.groupBy(F.col("pa").alias("a"), F.col("pb").alias("b")).agg(F.count(F.lit(1)).alias("n_children"))
    owned = (
        counted.join(materialise(children, "trie-children"), ["a", "b"], "left")
        .withColumns({
            "n_children": F.coalesce("n_children", F.lit(0)),
            "repeated": (F.col("n_convs") - 1) * F.col("words"),
        })
        .drop("saved", "leaves")
    )
    nodes = materialise(
        running_totals(owned, "conv_id", ["depth"], {"so_far": "repeated"}, name="trie-owned"), "trie-nodes"
    )
    of_owner = nodes.groupBy("conv_id").agg(
        F.sum("repeated").alias("saved"), F.count_if(F.col("n_children") == 0).alias("leaves")
    )
    below = (
        rows.select("conv_id", *key).join(materialise(of_owner, "trie-owners"), "conv_id")
        .groupBy(*key).agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    )
    subtrees = _refined(groups.join(below, key, "left").fillna(0, ["saved", "leaves"]), block)
    subtrees = materialise(subtrees.select("a", "b", "saved", "leaves"), "trie-subtrees")
    parents = nodes.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("conv_id").alias("parent_conv_id"))
    digests = materialise(_digests_of_ends(ends), "trie-digests")
    empty = F.lit(hashlib.sha256().hexdigest())
    size = ends.agg(F.min("conv_id").alias("smallest"), F.count(F.lit(1)).alias("n")).first()
    deep = (
        nodes.join(subtrees, ["a", "b"])
        .join(digests, ["a", "b"], "left")
        .join(parents, ["pa", "pb"], "left")
        .select(
            "conv_id", "depth", F.coalesce("parent_conv_id", F.lit(size.smallest).cast("long")).alias("parent_conv_id"),
            "n_convs", "n_children", F.col("leaves").alias("n_leaves"),
            (F.col("saved") - F.col("so_far") + F.col("repeated")).alias("saved_tokens"),
            F.coalesce("ends_sha256", empty).alias("ends_sha256"),
        )
    )
    if not size.n:
        return deep
    without_turns = digests.where("a = 0 and b = 0").first()
    top = nodes.agg(
        F.lit(size.smallest).cast("long").alias("conv_id"),
        root.alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(size.n).cast("long").alias("n_convs"),
        F.count_if((F.col("pa") == 0) & (F.col("pb") == 0)).alias("n_children"),
        F.greatest(F.count_if(F.col("n_children") == 0), F.lit(1)).alias("n_leaves"),
        F.coalesce(F.sum("repeated"), F.lit(0)).alias("saved_tokens"),
        F.lit(without_turns.ends_sha256 if without_turns else hashlib.sha256().hexdigest()).alias("ends_sha256"),
    )
    return deep.unionByName(top)
