import numpy as np

from gaugeworks.llm import embeddings
from gaugeworks.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, label int, node string"


def brute_force(rows, cosine=embeddings.COSINE):
    """id -> (links, component), comparing all pairs."""
    good = []
    for vec_id, vector, label in rows:
        ok = vector is not None and label is not None and None not in vector
        if ok:
            v = np.array(vector, np.float64)
            if np.isfinite(v).all() and v.any():
                v = v / np.abs(v).max()
                good.append((vec_id, v / np.linalg.norm(v), label))
    out = {vec_id: [0, vec_id] for vec_id, _, _ in rows}
    for label in {g[2] for g in good}:
        ids = np.array([g[0] for g in good if g[2] == label])
        x = np.stack([g[1] for g in good if g[2] == label])
        linked = x @ x.T >= cosine
        np.fill_diagonal(linked, False)
        root = ids.copy()
        while True:
            low = np.minimum(root, np.where(linked, root, ids.max()).min(1))
            if (low == root).all():
                break
            root = low
        for k, vec_id in enumerate(ids.tolist()):
            out[vec_id] = [int(linked[k].sum()), int(root[k])]
    return out


def results(frame):
    return {r.vec_id: [r.n_links, r.component_id] for r in frame.collect()}


def test_table_against_brute_force(spark, small):
    source = table(spark, small.replace("0.001", "0.01"), "embeddings")
    rows = [(r.vec_id, r.embedding, r.label) for r in source.collect()]
    draw = np.random.default_rng(1)
    for vec_id, vector, label in rows[::2]:  # near copies at all distances around the threshold
        v = np.array(vector)
        noise = draw.standard_normal(len(v)) * np.linalg.norm(v) / len(v) ** 0.5
        near = (v + noise * draw.uniform(0.02, 0.25)).astype(np.float32).tolist()
        rows.append((vec_id + 1_000_000, near, label))
    source = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    want = brute_force(rows)
    got = results(embeddings.near_duplicates(source, leaf=128, trees=4))
    assert got.keys() == want.keys()
    assert sum(a == b for a, b in ((got[k], want[k]) for k in want)) >= 0.99 * len(want)
    links = sum(v[0] for v in want.values())
    assert links and sum(v[0] for v in got.values()) >= 0.99 * links
    assert all(got[k][0] <= want[k][0] for k in want)


def test_dense_groups_are_split_and_counted_once(spark):
    draw = np.random.default_rng(3)
    centre = draw.standard_normal(16)
    near = centre + 0.02 * draw.standard_normal((300, 16))
    far = draw.standard_normal((300, 16))
    copies = np.repeat(far[:1], 200, axis=0)
    rows = [(i, v.astype(np.float32).tolist(), 1) for i, v in enumerate(np.concatenate([near, far, copies]))]
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    want = brute_force(rows)
    got = results(embeddings.near_duplicates(frame, leaf=128, trees=6))
    assert sum(v[0] for v in got.values()) >= 0.97 * sum(v[0] for v in want.values())
    assert all(got[k][0] <= want[k][0] for k in want)
    assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in want.items()}
    assert got[700] == [200, 300]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0], 1), (2, [2.0, 4.0], 1), (3, [1.0, 2.0], 2), (4, [1.0, 2.0], None), (5, None, 1),
        (6, [0.0, 0.0], 1), (7, [1.0, None], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [], 1),
        (11, [1.0, 2.0, 0.0], 1), (12, [1e-38, 2e-38], 1), (13, [3e38, 3e38], 1), (14, [-1.0, -2.0], 1),
    ]
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = results(embeddings.near_duplicates(frame))
    assert got == {r[0]: [0, r[0]] for r in rows} | {1: [2, 1], 2: [2, 1], 12: [2, 1]}
    again = embeddings.near_duplicates(spark.createDataFrame([(None, [1.0], 1, "")] * 2, SCHEMA)).collect()
    assert [(r.vec_id, r.n_links, r.component_id) for r in again] == [(None, 0, None)] * 2
    assert embeddings.near_duplicates(frame.limit(0)).collect() == []


def test_components_of_a_long_path(spark):
    from gaugeworks.llm.common import components

    edges = [(i, i + 1) for i in range(10, 400)] + [(1000, i) for i in range(1001, 1200)] + [(5, 5)]
    found = components(spark.createDataFrame(edges, "a long, b long"), "t").collect()
    want = {i: 10 for i in range(10, 401)} | {i: 1000 for i in range(1000, 1200)}
    assert {r.id: r.component for r in found} == want


def test_large_groups_of_near_copies_lose_no_link(spark):
    draw = np.random.default_rng(5)
    near = draw.standard_normal(16) + 0.06 * draw.standard_normal((4000, 16))
    far = draw.standard_normal((1500, 16))
    rows = [(i, v.astype(np.float32).tolist(), 1) for i, v in enumerate(np.concatenate([near, far]))]
    want = brute_force(rows)
    got = results(embeddings.near_duplicates(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)))
    assert sum(v[0] for v in want.values()) > 4_000_000
    assert all(got[k][0] <= want[k][0] for k in want)
    assert sum(v[0] for v in got.values()) >= 0.999 * sum(v[0] for v in want.values())
    assert {k: v[1] for k, v in got.items()} == {k: v[1] for k, v in want.items()}


def test_leaves_compared_in_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "ROUNDS", 0)  # no splits: one large leaf in every tree
    draw = np.random.default_rng(6)
    for size in (40, 90, 200):
        monkeypatch.setattr(embeddings, "BLOCK", 32)
        near = draw.standard_normal(8) + 0.1 * draw.standard_normal((size, 8))
        near = np.concatenate([near, near[:10]])  # classes with several vectors
        rows = [(i, v.astype(np.float32).tolist(), 1) for i, v in enumerate(near)]
        frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
        assert results(embeddings.near_duplicates(frame, leaf=32, trees=2)) == brute_force(rows)


def test_repeated_ids_are_vectors_of_their_own(spark):
    x, y = [1.0, 0.1, 0.0], [0.0, 0.1, 1.0]
    rows = [(1, x, 1), (1, y, 1), (2, x, 1), (3, [0.0, 0.11, 1.0], 1), (1, x, 2), (5, [0.0, 1.0, 0.0], 1)]
    found = embeddings.near_duplicates(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).collect()
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in found)
    assert got == [(1, 0, 1, True), (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False), (5, 0, 5, True)]
