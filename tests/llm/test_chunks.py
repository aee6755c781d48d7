import random
import re

import numpy as np

from gaugeworks.llm import chunks
from gaugeworks.llm.common import table
from plan_text import executed_plan


def text(seed, words=120):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(draw.randint(2, 9))) for _ in range(words))


def slow_cuts(data, chunker):
    """The rolling hash byte by byte."""
    raw, h = [], 0
    for i, byte in enumerate(data):
        h = ((h << 1) + int(chunker.gear[byte])) & 0xFFFF
        if i + 1 >= chunks.WINDOW and h < (1 << 16) // chunks.MEAN_BYTES:
            raw.append(i + 1)
    near = [c for k, c in enumerate(raw) if not k or c - raw[k - 1] >= chunks.APART]
    return near if near and near[-1] == len(data) else [*near, len(data)]


def test_chunks_equal_the_rolling_hash():
    chunker = chunks.Chunker()
    data = [text(i, n).encode() for i, n in enumerate((1, 3, 200, 40, 2000))] + [b"x", "é".encode()]
    counts, starts, lengths, digests = chunker(data)
    at = 0
    seen = {}
    for d, n in zip(data, counts, strict=True):
        ends = slow_cuts(d, chunker)
        assert (starts[at : at + n] + lengths[at : at + n]).tolist() == ends
        for s, ln, g in zip(starts[at : at + n], lengths[at : at + n], digests[at : at + n], strict=True):
            assert seen.setdefault(int(g), d[s : s + ln]) == d[s : s + ln]
        at += n
    assert at == len(starts)
    alone = chunker([data[3]])
    assert np.array_equal(alone[3], digests[counts[:3].sum() : counts[:4].sum()])


def passages(spark):
    shared = text(1000, 60)
    rows = [(i, text(i)) for i in range(40)]
    for i in range(0, 40, 4):  # in some, at different places
        words = rows[i][1].split()
        rows[i] = (i, " ".join(words[:i] + [shared] + words[i:]))
    rows += [(100, text(1)), (101, text(2) + " tail"), (102, None), (103, ""), (104, "short"), (105, "short")]
    return rows, shared, spark.createDataFrame([(a, b, "s", 1) for a, b in rows], "doc_id long, text string, chunk_dedup string, row int")


def test_repeated_passages_are_found_and_clean_texts_left_alone(spark):
    rows, shared, docs = passages(spark)
    found = chunks.repeats(docs).collect()
    assert {r.doc_id for r in found} == {*range(0, 40, 4), 1, 100, 2, 101}
    whole = dict(rows)
    for r in found:
        assert r.removed == (r.doc_id != r.first_doc_id)
        part = whole[r.doc_id].encode()[r.start : r.start + r.length]
        assert part in whole[r.first_doc_id].encode()
        if r.doc_id % 4 == 0 and r.doc_id < 40:
            assert len(part) > 0.6 * len(shared.encode()) and r.first_doc_id == 0


def test_removal_keeps_first_places(spark):
    rows, shared, docs = passages(spark)
    cleaned = chunks.remove_repeats(docs)
    assert cleaned.columns == docs.columns
    after = {r.doc_id: r.text for r in cleaned.collect()}
    before = dict(rows)
    assert after.keys() == before.keys()
    touched = {*range(4, 40, 4), 100, 101}
    for k in before.keys() - touched - {0, 1, 2}:
        assert after[k] == before[k]
    for k in touched:
        assert len(after[k]) < len(before[k])
        assert shared not in after[k]
    assert sum(shared in (t or "") for t in after.values()) == 1


def test_texts_are_shuffled_once(spark):
    docs = passages(spark)[2]
    cleaned = chunks.remove_repeats(docs)
    assert cleaned.schema == docs.schema
    scans = re.findall(r"FileScan parquet \[([^\]]*)", executed_plan(cleaned).split("== Initial Plan")[0])
    assert sum("text#" in columns for columns in scans) == 1


def test_odd_rows(spark):
    same = text(7)
    docs = spark.createDataFrame([(1, same), (1, same), (None, same), (2, text(8) * 300)], "doc_id int, text string")
    assert [r.doc_id for r in chunks.repeats(docs.where("doc_id = 1")).collect()] == [1]
    after = [r.text for r in chunks.remove_repeats(docs).where("doc_id is null or doc_id = 1").collect()]
    assert sum(t == same for t in after) == 1
    assert chunks.repeats(docs.limit(0)).collect() == []
    assert chunks.remove_repeats(docs.limit(0)).collect() == []


def test_spans_against_a_plain_count_on_a_table(spark, small):
    docs = table(spark, small, "documents")
    texts = {r.doc_id: r.text.encode() for r in docs.collect()}
    found = chunks.repeats(docs).collect()
    assert found
    for r in found:
        part = texts[r.doc_id][r.start : r.start + r.length]
        assert len(part) == r.length >= chunks.MIN_BYTES
    # every passage of 400 bytes that two documents share is found
    grams, caught = {}, {(r.doc_id) for r in found}
    for k, t in texts.items():
        for i in range(0, len(t) - 400, 400):
            grams[t[i : i + 400]] = k
    for k, t in texts.items():
        for i in range(len(t) - 400):
            other = grams.get(t[i : i + 400], k)
            assert other == k or (k in caught and other in caught)


def test_a_cut_character_goes_with_its_span():
    data = "aé b"
    assert chunks.cleaned(data, [{"start": 2, "length": 1}]) == "a b"
