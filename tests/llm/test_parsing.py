"""Prefix-free parsing against a plain search for earlier strings."""

import hashlib
import random

import numpy as np
import pytest

import __spark_entry__ as registry
from gaugeworks.llm import parsing

SCHEMA = "doc_id long, text string, Row string, kind string"


def brute_force(rows, size=parsing.SIZE):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, i))
    seen, out = set(), {}
    for i in order:
        data = (rows[i][1] or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for s in range(len(data) - size + 1):
            string = data[s : s + size]
            if string in seen:
                gone[s : s + size] = True
            seen.add(string)
        rest = bytes(b for b, g in zip(data, gone, strict=False) if not g)
        runs = int(np.count_nonzero(np.diff(gone.astype(int), prepend=0) == 1))
        out[i] = (rows[i][0], len(data), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest())
    return sorted(out.values(), key=str)


def found(spark, rows, tmp_path, size=parsing.SIZE, files=3):
    path = str(tmp_path / f"docs-{random.random()}")
    spark.createDataFrame(rows, SCHEMA).coalesce(files if files == 1 else 1).write.parquet(path)
    return sorted(map(tuple, parsing.removal_report(spark.read.parquet(path), size).collect()), key=str)


def corpus(seed, n=60):
    draw = random.Random(seed)
    words = ["".join(draw.choices("abcdefghé \n", k=draw.randint(1, 9))) for _ in range(400)]
    passages = [" ".join(draw.choices(words, k=draw.randint(8, 60))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [" ".join(draw.choices(words, k=draw.randint(0, 40))) for _ in range(3)]
        for at in range(draw.randint(0, 3)):
            parts.insert(at, draw.choice(passages))
        rows.append((draw.randint(0, 3 * n), "".join(parts), None, "x"))
    rows += [(1000 + i, rows[i][1], None, None) for i in range(5)]  # exact copies
    rows += [(2000 + i, rows[i][1].replace("a", "b", 1), None, None) for i in range(10)]
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_equals_a_plain_search(spark, tmp_path, seed):
    rows = corpus(seed)
    ids = {}
    rows = [(ids.setdefault(r[0], r[0]) if r[0] not in ids else 5000 + i, *r[1:]) for i, r in enumerate(rows)]
    draw = random.Random(seed)
    draw.shuffle(rows)
    assert found(spark, rows, tmp_path) == brute_force(rows)


def test_runs_of_one_byte_nulls_and_repeated_ids(spark, tmp_path):
    rows = [
        (1, "a" * 500, None, None), (2, "a" * 99, None, None), (3, "b" * 100, None, None), (4, "b" * 101, None, None),
        (5, None, None, None), (6, "", None, None), (7, "ab" * 300 + "x" + "ab" * 80, None, None),
        (None, "q" * 30 + "".join(map(str, range(80))), None, None), (None, "".join(map(str, range(80))), None, None),
        (7, "".join(map(str, range(90))), None, None), (7, "".join(map(str, range(90))), None, None),
    ]
    assert found(spark, rows, tmp_path, files=1) == brute_force(rows)


def test_a_hot_passage_with_other_neighbours(spark, tmp_path, monkeypatch):
    draw = random.Random(5)
    passage = "".join(draw.choices("abcdefgh ", k=230))
    rows = [(i, f"{draw.random()}" * 3 + passage + f"{draw.random()}" * 4, None, None) for i in range(300)]
    monkeypatch.setattr(parsing, "ENTRIES", 100)
    monkeypatch.setattr(parsing, "PIECE", 128)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(spark, rows, tmp_path) == brute_force(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_short_strings_and_empty_table(spark, tmp_path):
    rows = corpus(9, 30)
    rows = [(i, *r[1:]) for i, r in enumerate(rows)]
    assert found(spark, rows, tmp_path, size=80) == brute_force(rows, 80)
    assert found(spark, [], tmp_path) == []


def test_a_text_beyond_one_piece(spark, tmp_path):
    draw = random.Random(3)
    block = "".join(draw.choices("abcdefgh", k=700_000))
    rows = [(1, block, None, None), (0, block[200_000:] + "tail" + block[:900], None, None)]
    got = found(spark, rows, tmp_path)
    assert [r[:4] for r in got] == [(0, 500_904, 0, 0), (1, 700_000, 900 + 500_000, 2)]


def test_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = registry.queries()["op12_prefix_free_parsing"](spark, small)
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(rows)
