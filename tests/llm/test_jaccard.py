import random
import re

import numpy as np

from gaugeworks.llm import jaccard
from gaugeworks.llm.common import BATCH_BYTES, table


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute_force(rows):
    """id -> (size, component), from an index of all shingles."""
    sets = {k: shingle_set(t) for k, t in rows}
    parent = {k: k for k in sets}

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    places = {}
    for k, s in sets.items():
        common = {}
        for x in s:
            for other in places.setdefault(x, []):
                common[other] = common.get(other, 0) + 1
            places[x].append(k)
        for other, both in common.items():
            if 100 * both >= 75 * (len(s) + len(sets[other]) - both):
                a, b = sorted((root(k), root(other)))
                parent[b] = a
    return {k: (len(s), root(k)) for k, s in sets.items()}


def results(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


def test_table_equals_brute_force(spark, small):
    docs = table(spark, small, "documents")
    want = brute_force([(r.doc_id, r.text) for r in docs.collect()])
    assert any(c != k for k, (_, c) in want.items())
    assert results(jaccard.near_duplicates(docs)) == want


def variants(seed=5):
    """Chains and clusters around the threshold, with a passage that all share."""
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(4))
    passage = [word() for _ in range(40)]
    rows = []
    for _ in range(6):
        words = [word() for _ in range(draw.choice((8, 60, 120)))]
        for _ in range(25):
            words = list(words)
            for _ in range(draw.randint(0, 2)):
                words[draw.randrange(len(words))] = word()
            rows.append(" ".join(words + passage * draw.randint(0, 1)))
    rows += [" ".join([word() for _ in range(60)] + passage) for _ in range(100)]
    rows += [rows[0].upper(), "\t".join(rows[1].split()), "Two words", "two words", "two  WORDS x", None, "", " \n", "a b c d", "a b c d e"]
    return list(enumerate(rows))


def test_variants_equal_brute_force(spark, monkeypatch):
    rows = variants()
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, row string, n int").repartition(3)
    want = brute_force(rows)
    assert results(jaccard.near_duplicates(docs)) == want
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    empty = {k for k, (n, _) in want.items() if not n}
    assert len(ids) == len(set(ids)) and empty <= set(ids)
    assert sorted(want[k][1] for k in ids) == sorted({c for _, c in want.values()})


def test_order_of_shingles_changes_no_result(spark, monkeypatch):
    rows = variants(9)
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(jaccard, "frequent_shingles", lambda d, t, s: (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    assert results(jaccard.near_duplicates(docs)) == brute_force(rows)


def test_odd_rows(spark):
    same = "one two three four five six"
    docs = spark.createDataFrame([(None, same), (3, same), (3, same), (2, None), (2, "other words"), (None, "lone")], "doc_id int, text string")
    found = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs).collect()), key=str)
    assert found == sorted([(None, 2, 3), (3, 2, 3), (3, 2, 3), (2, 0, 2), (2, 1, 2), (None, 1, None)], key=str)
    assert jaccard.near_duplicates(docs.limit(0)).collect() == []
    assert jaccard.keep_one(docs.limit(0)).collect() == []
    long = spark.createDataFrame([(1, "word " * 100_000), (2, "word " * 99_000)], "doc_id int, text string")
    assert results(jaccard.near_duplicates(long)) == {1: (1, 1), 2: (1, 1)}


def test_python_workers_get_small_batches(spark, monkeypatch):
    text = "concat_ws(' ', transform(sequence(1, 6000), x -> x + 10000 * (id div 2)), id)"
    docs = spark.range(0, 300, 1, 1).selectExpr("id AS doc_id", f"{text} AS text")
    kind = type(docs)
    plain, most = kind.mapInArrow, 2 * BATCH_BYTES

    def watched(frame, function, schema):
        def checked(batches):
            for batch in batches:
                assert batch.nbytes <= most
                yield batch

        return plain(frame, lambda batches: function(checked(batches)), schema)

    monkeypatch.setattr(kind, "mapInArrow", watched)
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    assert results(jaccard.near_duplicates(docs)) == {k: (5997, k - k % 2) for k in range(300)}
    assert spark.conf.get(setting, None) is None
    spark.conf.set(setting, "32m")
    try:
        assert jaccard.keep_one(docs).count() == 150
        assert spark.conf.get(setting) == "32m"
    finally:
        spark.conf.unset(setting)


def test_frequent_shingles_come_last():
    tokens = np.arange(0, 80, 2, dtype=np.uint64)
    frequent, counts = np.array([0, 2, 4, 5], np.uint64), np.array([9, 7, 8, 1])
    assert jaccard.prefix(tokens, frequent, counts, 75).tolist() == list(range(6, 28, 2))
    assert jaccard.prefix(tokens[:4], frequent, counts, 75).tolist() == [6, 2]
