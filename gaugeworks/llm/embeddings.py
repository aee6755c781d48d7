"""Near-duplicate embeddings by a forest of random-projection trees.

Equal vectors of a label are one class, with a count. Every class goes down ``TREES``
trees. A node with more than ``LEAF`` classes is split by random directions at
thresholds near the median; classes close to a threshold go to both sides, by as much
as two linked vectors usually differ along a direction. Where that is too much of a node
(``SPILL``), as in a cluster in which all vectors link, another place of the threshold is
tried; a node that no direction of a round can split stays whole. Classes that share a
leaf are compared by cosine in double precision, and links are joined to components.
Leaves of more than ``leaf`` classes are compared in blocks of some ``BLOCK`` classes,
every pair of blocks for itself, so no task holds or compares a whole cluster.

Nodes are split in rounds. A round fits up to ``LEVELS`` levels below every large node
on a bounded sample of the node's own rows (``SAMPLE``, spread by hash), in one task
per node, and then sends every row of the node down. So no model and no group grows
with the data; the number of rounds grows with its logarithm, as a split leaves at most
``PAIRS_LEFT`` of a node's pairs.

Classes can meet in several leaves. A pair is counted in the leaf with the smallest
number that both are in, so link counts need no list of all pairs; for components a
leaf yields one edge per class at most.

Vectors that are null, zero, of another length than the rest of their leaf, or hold
null or non-finite components link with nothing, and neither do rows without a label
or id. Repeated rows are other vectors to each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import components, map_batches
from gaugeworks.sources.shared import materialise

COSINE = 0.98
TREES = 6
LEAF = 512
LEVELS = 4
SAMPLE = 2048
ROUNDS = 30
#: Largest share of a node's sample that may go to both sides of a split.
SPILL = 0.4
#: Largest share of a node's pairs that may be left to compare after a split off the middle.
PAIRS_LEFT = 0.9
#: Mean number of classes of a block, where a leaf is compared in blocks.
BLOCK = 512


def usable(vector: Column) -> Column:
    """Whether a vector can link: finite components, not all zero."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Unit vectors, in double precision, of a column of lists of one length."""
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = values.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = flat.reshape(len(values), -1)
    out = out / np.abs(out).max(axis=1, keepdims=True)  # squares of extreme values stay finite
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def directions(node: int, size: int) -> np.ndarray:
    draw = np.random.Generator(np.random.PCG64(node & (1 << 64) - 1))
    found = draw.standard_normal((2**LEVELS - 1, size))
    return found / np.linalg.norm(found, axis=1, keepdims=True)


def fit(node: int, vectors: np.ndarray, cosine: float) -> np.ndarray:
    """Low and high bound of every inner node, in heap order; rows between them go both ways."""
    draw = np.random.Generator(np.random.PCG64([node & (1 << 64) - 1, 1]))
    along = vectors @ directions(node, vectors.shape[1]).T
    margin = np.sqrt(max(0.0, 2 - 2 * cosine) / vectors.shape[1])
    bounds = np.zeros((2**LEVELS - 1, 2))
    inside = {0: np.arange(len(vectors))}
    for k in range(2**LEVELS - 1):
        rows = inside[k]
        values = np.sort(along[rows, k])
        bounds[k] = threshold(values, draw.uniform(0.4, 0.6), margin)
        inside[2 * k + 1] = rows[along[rows, k] <= bounds[k, 1]]
        inside[2 * k + 2] = rows[along[rows, k] > bounds[k, 0]]
    return bounds


def threshold(values: np.ndarray, share: float, margin: float) -> tuple[float, float]:
    """Low and high bound of a split of sorted values; infinite where all have to stay together.

    The bounds are always a whole margin off the threshold.
    """
    n = len(values)
    if not n:
        return np.inf, np.inf
    low, middle, high = np.quantile(values, [max(0.0, share - SPILL / 2), share, share + SPILL / 2])
    if low <= middle - margin and middle + margin <= high:
        return middle - margin, middle + margin
    places = np.quantile(values, np.linspace(0.02, 0.98, 49))
    left = np.searchsorted(values, places + margin, side="right") / n
    right = 1 - np.searchsorted(values, places - margin, side="right") / n
    pairs = np.where(left + right - 1 <= SPILL, left**2 + right**2, np.inf)
    best = int(np.argmin(pairs))
    if pairs[best] > PAIRS_LEFT:
        return np.inf, np.inf
    return places[best] - margin, places[best] + margin


def whole(bounds: np.ndarray) -> bool:
    """Whether the first node of these bounds stays together on all levels."""
    return bool(np.isinf(bounds[[2**k - 1 for k in range(LEVELS)]]).all())


def descend(node: int, vectors: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf number) of every leaf that a row gets to."""
    along = vectors @ directions(node, vectors.shape[1]).T
    rows, at = np.arange(len(vectors)), np.zeros(len(vectors), np.int64)
    for _ in range(LEVELS):
        value = along[rows, at]
        left, right = value <= bounds[at, 1], value > bounds[at, 0]
        rows, at = (
            np.concatenate([rows[left], rows[right]]),
            np.concatenate([2 * at[left] + 1, 2 * at[right] + 2]),
        )
    return rows, at - (2**LEVELS - 1)


def _fit(inside: DataFrame, cosine: float) -> DataFrame:
    """(label, node, bounds, whole) of the nodes of ``inside``, which has their size ``n``."""
    kind = inside.schema["label"].dataType.simpleString()

    def fitted(sample: pa.Table) -> pa.Table:
        node = sample["node"][0].as_py()
        bounds = fit(node, matrix(sample["vector"]), cosine)
        return pa.table(
            {
                "label": sample["label"].slice(0, 1),
                "node": [node],
                "bounds": pa.array([bounds.ravel().tolist()], pa.list_(pa.float64())),
                "whole": [whole(bounds)],
            }
        )

    drawn = F.pmod(F.xxhash64("class", "node"), F.col("n")) < SAMPLE
    return (
        inside.where(drawn)
        .select("label", "node", "vector")
        .groupBy("label", "node")
        .applyInArrow(fitted, f"label {kind}, node long, bounds array<double>, whole boolean")
    )


def _split(inside: DataFrame, models: DataFrame) -> DataFrame:
    """Send the rows of ``inside`` down by up to ``LEVELS`` levels; nodes without a model are left out."""
    kind = inside.schema["label"].dataType.simpleString()
    vector = inside.schema["vector"].dataType.simpleString()

    def function():
        def convert(batch: pa.RecordBatch) -> dict:
            node = batch.column(1).to_numpy()
            vectors = matrix(batch.column(3))
            bounds = batch.column(4)
            taken, leaf = [], []
            for n in np.unique(node):
                of = np.flatnonzero(node == n)
                limits = np.array(bounds[int(of[0])].as_py()).reshape(-1, 2)
                row, number = descend(int(n), vectors[of], limits)
                taken.append(of[row])
                leaf.append(child(np.int64(n), number))
            take = pa.array(np.concatenate(taken))
            return {
                "label": batch.column(0).take(take),
                "node": np.concatenate(leaf),
                "class": batch.column(2).take(take),
                "vector": batch.column(3).take(take),
            }

        return convert

    return map_batches(
        inside.join(models, ["label", "node"]).select("label", "node", "class", "vector", "bounds"),
        function,
        f"label {kind}, node long, class long, vector {vector}",
    )


def child(node: np.int64, number: np.ndarray) -> np.ndarray:
    """Number of a leaf below ``node``: a mix of both, the same in every task."""
    with np.errstate(over="ignore"):
        h = np.uint64(np.int64(node)) ^ (number.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        return (h ^ (h >> np.uint64(31))).view(np.int64)


def forest(classes: DataFrame, cosine: float, trees: int, leaf: int) -> DataFrame:
    """(label, node, class, vector) of every leaf that a class is in."""
    rows = classes.select(
        "label",
        F.explode(F.array(*[F.lit(t) for t in range(trees)])).alias("tree"),
        "class",
        "vector",
    ).select(
        "label", F.xxhash64("label", "tree", F.size("vector")).alias("node"), "class", "vector"
    )
    rows = materialise(rows, "forest")
    done: list[DataFrame] = []
    for _ in range(ROUNDS):
        sizes = materialise(rows.groupBy("label", "node").agg(F.count(F.lit(1)).alias("n")), "nodes")
        large = sizes.where(F.col("n") > leaf)
        if large.isEmpty():
            break
        inside = rows.join(large, ["label", "node"])
        models = materialise(_fit(inside, cosine), "models")
        done.append(rows.join(models.where("not whole"), ["label", "node"], "left_anti"))
        rows = materialise(_split(inside, models.where("not whole")), "forest")
    for part in done:
        rows = rows.unionByName(part)
    return rows


def _links(leaves: DataFrame, cosine: float) -> DataFrame:
    """(class, links, root): per leaf and class, links counted here and the smallest class reached."""

    def compared(rows: pa.Table) -> pa.Table:
        ids = rows["class"].to_numpy()
        copies = rows["n"].to_numpy()
        node = rows["node"][0].as_py()
        vectors = matrix(rows["vector"])
        before = smaller_leaves(rows["leaves"].combine_chunks(), node)
        links = np.zeros(len(ids), np.int64)
        ends: list[np.ndarray] = []
        for a in range(0, len(ids), 1024):
            for b in range(a, len(ids), 1024):
                p, q = slice(a, a + 1024), slice(b, b + 1024)
                linked = vectors[p] @ vectors[q].T >= cosine
                if a == b:
                    np.fill_diagonal(linked, False)
                i, j = np.nonzero(linked)
                ends.append(np.stack([i + a, j + b]))
                first = linked & ~(before[p] @ before[q].T > 0)
                links[p] += first @ copies[q]
                if a != b:
                    links[q] += first.T @ copies[p]
        root = smallest_reached(ids, *np.concatenate(ends, axis=1))
        return pa.table({"class": ids, "links": links, "root": root})

    return leaves.groupBy("label", "node").applyInArrow(
        compared, "class long, links long, root long"
    )


def _block_links(leaves: DataFrame, cosine: float) -> DataFrame:
    """As ``_links``, for large leaves; ``blocks`` is the number of blocks of a row's leaf.

    A block travels as one row. Block i meets the blocks i, i + 1 ... halfway round the
    ring of all blocks, so every two blocks meet once and every block equally often.
    """
    kind = leaves.schema["label"].dataType.simpleString()
    long_list, double_list = pa.list_(pa.int64()), pa.list_(pa.float64())

    def packed(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("class")
        return pa.table(
            {
                "label": rows["label"].slice(0, 1),
                "node": rows["node"].slice(0, 1),
                "blocks": rows["blocks"].slice(0, 1),
                "block": rows["block"].slice(0, 1),
                "ids": pa.array([rows["class"].to_numpy()], long_list),
                "copies": pa.array([rows["n"].to_numpy()], long_list),
                "vectors": pa.array([matrix(rows["vector"]).ravel()], double_list),
                "leaves": pa.array([rows["leaves"].to_pylist()], pa.list_(long_list)),
            }
        )

    numbered = leaves.withColumn("block", F.pmod(F.xxhash64("class", F.lit("block")), "blocks"))
    blocks = materialise(
        numbered.groupBy("label", "node", "block").applyInArrow(
            packed,
            f"label {kind}, node long, blocks long, block long, ids array<long>, copies array<long>, "
            "vectors array<double>, leaves array<array<long>>",
        ),
        "blocks",
    )
    half = F.floor(F.col("blocks") / 2)
    twice = (F.col("blocks") % 2 == 0) & (F.col("step") == half) & (F.col("step") > 0) & (F.col("block") >= half)
    meeting = (
        blocks.select("label", "node", "blocks", "block", F.explode(F.sequence(F.lit(0).cast("long"), half)).alias("step"))
        .where(~twice)
        .select("label", "node", "block", ((F.col("block") + F.col("step")) % F.col("blocks")).alias("other"))
    )
    parts = ("ids", "copies", "vectors", "leaves")
    one = blocks.select("label", "node", "block", *[F.col(c).alias(f"{c}_p") for c in parts])
    two = blocks.select("label", "node", F.col("block").alias("other"), *[F.col(c).alias(f"{c}_q") for c in parts])
    pairs = (
        meeting.join(one, ["label", "node", "block"])
        .join(two, ["label", "node", "other"])
        .select("label", "node", "block", "other", *[f"{c}_{x}" for x in "pq" for c in parts])
    )

    def function():
        def convert(batch: pa.RecordBatch) -> dict:
            out: list[list] = [[], [], [], [], [], []]
            for k in range(batch.num_rows):
                label, node, block, other = (batch.column(i)[k].as_py() for i in range(4))
                p, copies_p, x, leaves_p = (batch.column(i)[k].values for i in range(4, 8))
                q, copies_q, y, leaves_q = (batch.column(i)[k].values for i in range(8, 12))
                p, q = p.to_numpy(), q.to_numpy()
                both = pa.concat_arrays([leaves_p, leaves_q])
                before = smaller_leaves(both, node)
                first = ~(before[: len(p)] @ before[len(p) :].T > 0)
                if first.any():
                    x, y = (v.to_numpy().reshape(len(i), -1) for v, i in ((x, p), (y, q)))
                    first &= x @ y.T >= cosine
                if block == other:
                    np.fill_diagonal(first, False)
                # pairs met in an earlier leaf have their links and edges there
                ids = np.concatenate([p, q])
                i, j = np.nonzero(first)
                if block == other:
                    root = smallest_reached(p, i, j)
                    ends = [(block, p, first @ copies_q.to_numpy(), root)]
                else:
                    root = smallest_reached(ids, i, j + len(p))
                    ends = [
                        (block, p, first @ copies_q.to_numpy(), root[: len(p)]),
                        (other, q, first.T @ copies_p.to_numpy(), root[len(p) :]),
                    ]
                for at, own, links, reached in ends:
                    for column, value in zip(out, (label, node, at, own, links, reached), strict=True):
                        column.append(value)
            return dict(enumerate(out))

        return convert

    met = map_batches(
        pairs, function, f"label {kind}, node long, block long, ids array<long>, links array<long>, roots array<long>"
    )

    def summed(rows: pa.Table) -> pa.Table:
        ids = rows["ids"].chunk(0)[0].values.to_numpy()
        links = sum(part.values.to_numpy() for part in rows["links"])
        roots = np.concatenate([part.values.to_numpy() for part in rows["roots"]])
        # the classes of the block and what they reach anywhere, as one graph
        nodes, ends = np.unique(np.concatenate([ids, roots]), return_inverse=True)
        own = np.tile(ends[: len(ids)], len(roots) // len(ids))
        reached = smallest_reached(nodes, own, ends[len(ids) :])
        counted = np.zeros(len(nodes), np.int64)
        counted[ends[: len(ids)]] = links
        return pa.table({"class": nodes, "links": counted, "root": reached})

    return met.groupBy("label", "node", "block").applyInArrow(summed, "class long, links long, root long")


def smaller_leaves(leaves: pa.ListArray, node: int) -> np.ndarray:
    """Which classes (rows) are in which leaves (columns) with a smaller number than ``node``."""
    row = np.repeat(np.arange(len(leaves)), leaves.value_lengths().to_numpy())
    number = leaves.flatten().to_numpy()
    row, number = row[number < node], number[number < node]
    kinds, column = np.unique(number, return_inverse=True)
    out = np.zeros((len(leaves), len(kinds)), np.float32)
    out[row, column] = 1
    return out[:, out.sum(0) > 1]


def smallest_reached(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    root = ids.copy()
    while len(i):
        before = root.copy()
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        if np.array_equal(root, before):
            break
    return root


def near_duplicates(
    embeddings: DataFrame,
    cosine: float = COSINE,
    trees: int = TREES,
    leaf: int = LEAF,
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = embeddings.select(
        "vec_id", "label", F.col("embedding").alias("vector"), usable(F.col("embedding")).alias("good")
    )
    able = F.col("good") & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    key = F.xxhash64("vector")
    classes = materialise(
        rows.where(able)
        .groupBy("label", key.alias("key"), "vector")
        .agg(F.min(F.col("vec_id").cast("long")).alias("first"), F.count(F.lit(1)).alias("n"))
        # a number of its own, as ids may be repeated
        .withColumn("class", F.monotonically_increasing_id()),
        "classes",
    )
    leaves = materialise(forest(classes, cosine, trees, leaf), "leaves")
    of_class = leaves.groupBy("class").agg(
        F.sort_array(F.collect_set("node")).alias("leaves")
    )
    blocks = F.ceil(F.count(F.lit(1)) / BLOCK)
    large = materialise(
        leaves.groupBy("label", "node").agg(F.count(F.lit(1)).alias("size"), blocks.alias("blocks")).where(F.col("size") > leaf).drop("size"),
        "large-leaves",
    )
    placed = leaves.join(of_class.join(classes.select("class", "n"), "class"), "class").select(
        "label", "node", "class", "vector", "n", "leaves"
    )
    found = materialise(
        _links(placed.join(large, ["label", "node"], "left_anti"), cosine).unionByName(
            _block_links(placed.join(large, ["label", "node"]), cosine)
        ),
        "links",
    )
    links = found.groupBy("class").agg(F.sum("links").alias("links"))
    edges = found.where("class <> root").select(F.col("class").alias("a"), F.col("root").alias("b"))
    groups = materialise(components(edges, "vectors").withColumnRenamed("id", "class"), "groups")
    smallest = (
        groups.join(classes.select("class", "first"), "class")
        .groupBy("component")
        .agg(F.min("first").alias("smallest"))
    )
    # stored on both sides, so that the join can split a component with a large share of the classes
    named = groups.join(materialise(smallest, "smallest"), "component").select("class", "smallest")
    linked = materialise(
        classes.join(links, "class", "left").join(named, "class", "left").select(
            "label",
            "key",
            "vector",
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("smallest", "first").alias("component"),
        ),
        "linked",
    )
    good = rows.where(able).withColumn("key", key).join(linked, ["label", "key", "vector"])
    rest = rows.where(~able).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component")
    )
    return (
        good.select("vec_id", "n_links", "component")
        .unionByName(rest)
        .select(
            "vec_id",
            "n_links",
            F.col("component").alias("component_id"),
            F.coalesce(F.col("vec_id") == F.col("component"), F.lit(True)).alias("kept"),
        )
    )
