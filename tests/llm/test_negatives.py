"""Hard negatives from zone-mapped blocks against scores of all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from gaugeworks.llm import negatives
from oracle_check import connect, differences

SCHEMA = "vec_id long, embedding array<float>, label int, Row string, block long"


def brute_force(rows):
    taking = []
    for i, (vec_id, vector, label, *_) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in vector]
        if sum(x * x for x in whole) < 2**53:
            taking.append((i, vec_id, (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label, whole))
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for i, vec_id, label, whole in taking:
        if vec_id is None or vec_id % 100:
            continue
        scored = [(sum(a * b for a, b in zip(whole, w, strict=True)), v, lab) for j, v, lab, w in taking if j != i and len(w) == len(whole)]
        for p, pid, _ in sorted((s for s in scored if s[2] == label), key=order)[:5]:
            fitting = [s for s in scored if s[2] != label and 30 * p <= 100 * s[0] <= 90 * p]
            out += [(vec_id, pid, k + 1, s[1], p, s[0]) for k, s in enumerate(sorted(fitting, key=order)[:10])]
    return sorted(out, key=str)


def found(spark, rows, block=negatives.BLOCK):
    df = spark.createDataFrame(rows, SCHEMA)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = negatives.whole_vectors(df, 256, moved, F.col("vec_id") % 100 == 0)
    return sorted(map(tuple, negatives.hard_negatives(vectors, block=block).collect()), key=str)


def table(n, dims=6, seed=0, spread=0.3):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(9, dims))
    chosen = draw.integers(0, 9, n)
    vectors = (centres[chosen] + spread * draw.normal(size=(n, dims))).astype(np.float32)
    labels = (chosen + draw.integers(0, 2, n)) % 10
    return [(i * 5, v.tolist(), int(lab), None, 1) for i, (v, lab) in enumerate(zip(vectors, labels, strict=True))]


def test_equals_all_pairs(spark):
    rows = table(400)
    assert found(spark, rows, block=8) == brute_force(rows)


def test_nulls_ties_and_repeats(spark):
    rows = table(120, 3, 1)
    same = [1.0, 0.5, 0.25]
    rows += [(100, same, 3, None, 1)] * 3 + [(None, same, 3, None, 1), (None, same, 4, None, 1)]
    rows += [(900 + i, [0.5, 0.25, 0.125], 5, None, 1) for i in range(30)] + [(907, [0.5, 0.25, 0.125], 5, None, 1)] * 2
    rows += [(200, None, 1, None, 1), (300, [1.0, None, 0.0], 1, None, 1), (400, [1.0, math.nan, 0.0], 1, None, 1)]
    rows += [(500, [math.inf, 0.0, 0.0], 1, None, 1), (600, same, None, None, 1), (700, [1e30, 0.0, 0.0], 3, None, 1)]
    rows += [(800, [], 1, None, 1), (801, [], 1, None, 1), (803, [], 2, None, 1), (1100, [1.0, 2.0], 2, None, 1), (1101, [1.0, 2.0], 2, None, 1)]
    assert found(spark, rows, block=16) == brute_force(rows)


def test_batches_and_full_tasks(spark, monkeypatch):
    rows = table(600, 4, 2)
    monkeypatch.setattr(negatives, "ANCHORS", 4 * 7)
    monkeypatch.setattr(negatives, "HELD", 50)
    assert found(spark, rows, block=4) == brute_force(rows)


def test_empty_and_no_anchor(spark):
    assert found(spark, []) == []
    assert found(spark, [(1, [1.0], 2, None, 1)]) == []


@pytest.mark.parametrize("dims", [1, 2, 5])
def test_the_curve_moves_one_step_at_a_time(dims):
    """Cells of a grid, in the order of their keys, are neighbours."""
    scale = lambda x: math.floor(1.2 * math.log2(abs(x) + 1))
    steps = [x for x in range(0, 12) if x == 0 or scale(x) != scale(x - 1)][:4]
    grid = np.stack(np.meshgrid(*[steps] * dims, indexing="ij"), -1).reshape(-1, dims)
    keys = negatives.hilbert_keys(grid)
    cells = grid[np.lexsort(keys.T[::-1])]
    level = np.vectorize(scale)(cells)
    assert (np.abs(np.diff(level, axis=0)).sum(axis=1) == 1).all()


def test_only_chosen_blocks_are_read(spark):
    """Vectors of clusters far apart: bounds rule out most of the blocks."""
    rows = table(2000, 4, 3, spread=0.02)
    df = spark.createDataFrame(rows, SCHEMA)
    stored = negatives.materialise(negatives._with_keys(negatives.whole_vectors(df)), "vectors")
    candidates = negatives.Candidates(stored, 16)
    first = stored.orderBy("vec_id").limit(1).toArrow()
    vector, label, row = np.array(first["vector"].to_pylist(), float), first["label"].to_numpy(), first["row"].to_numpy()
    scored = stored.where(F.col("label") == int(label[0])).toArrow()
    fifth = np.sort(np.array(scored["vector"].to_pylist()) @ vector[0])[-6]
    batch = negatives.Batch(vector, label, row, np.array([[int(fifth)]]), np.array([[1 << 62]]), True, 5)
    sent = spark.sparkContext.broadcast(tuple(vars(batch).values()))
    chosen = negatives._chosen(candidates.zones, sent, spark.sparkContext.broadcast(batch.least)).count()
    assert 0 < chosen < candidates.zones.count() / 4


def test_query(spark, small):
    name = "op11_hilbert_zone_maps"
    assert differences(spark, connect(small), registry.queries()[name], registry.oracle_sql()[name], small) == []
