import zlib

import numpy as np
import pytest

from gaugeworks.llm import language
from gaugeworks.llm.common import table


def plain_bundle(text, dimensions=64):
    """Trigram by trigram."""
    bundler = language.Bundler(dimensions)
    total = np.zeros(dimensions)
    word = ""
    for c in (text or "").lower() + " ":
        if c.isalpha():
            word += c
            continue
        codes = [0, *[ord(x) + 1 for x in word], 0]
        for a, b, d in zip(codes, codes[1:], codes[2:]):
            total += np.roll(bundler.letter(a), 2) * np.roll(bundler.letter(b), 1) * bundler.letter(d)
        word = ""
    return total / max(np.linalg.norm(total), 1e-30)


def test_vectors_equal_a_plain_bundle():
    texts = ["Hello, wörld 12 a b--cd", None, "", "123 ..", "中文 ñandú İx", "a", "end", "ab " * 900]
    found = language.Bundler(64)(texts)
    for vector, text in zip(found, texts, strict=True):
        assert vector == pytest.approx(plain_bundle(text), abs=1e-5)


def test_held_out_accuracy(spark, small):
    docs = table(spark, small, "documents")
    rows = {r.doc_id: r for r in docs.collect()}
    found = language.identify(docs).collect()
    assert {r.doc_id for r in found} == rows.keys()
    right = total = 0
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1
        if r.held_out and rows[r.doc_id].lang:
            total += 1
            right += r.lang_pred == rows[r.doc_id].lang
    assert right >= 0.97 * total


def test_labels_of_held_out_rows_are_never_read(spark, small):
    docs = table(spark, small, "documents")
    hidden = docs.withColumn("lang", language.F.when(language.id_remainder(docs.doc_id, 4) != 2, docs.lang))
    key = lambda r: r.doc_id
    assert sorted(language.identify(hidden).collect(), key=key) == sorted(language.identify(docs).collect(), key=key)


def test_odd_rows(spark):
    rows = [(1, None, "en"), (2, "", "en"), (3, "12 ?!", None), (4, "the cat and the dog", "en"), (5, "der hund und die katze", "de")]
    rows += [(None, "the dog", None)] * 2 + [(6, "die katze " * 20_000, None)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, lang string").withColumn("score", language.F.lit("q"))
    learnt = language.learn(docs)
    found = language.predict(docs, learnt, {"doc_id": docs.doc_id}).collect()
    got = [(r.doc_id, r.lang_pred) for r in found]
    assert sorted(got, key=str) == sorted([(1, "und"), (2, "und"), (3, "und"), (4, "en"), (5, "de"), (None, "en"), (None, "en"), (6, "de")], key=str)
    nothing = language.predict(docs, {}, {"doc_id": docs.doc_id}).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}
    assert language.identify(docs.limit(0)).collect() == []
