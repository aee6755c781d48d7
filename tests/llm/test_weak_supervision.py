import re
from collections import Counter

import pytest

from gaugeworks.llm import quality
from gaugeworks.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text),
        dup,
        len(covered),
        len(words) < 10 or 100 * len(covered) > 20 * len(words),
    )


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_measures_of_a_table(spark, small):
    docs = table(spark, small, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = quality.verdicts(docs).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[n] for n in NAMES) == brute_force(texts[r.doc_id])
        assert not (r.kept and r.base_failed)
    labels = {r.doc_id: r.quality for r in table(spark, small, "labels").collect()}
    by_label = {label: [r.kept for r in rows if labels.get(r.doc_id) == label and not r.base_failed] for label in (0, 1)}
    assert sum(by_label[1]) >= 0.99 * len(by_label[1])


ODD = [
    None, "", " \n\t ", "one", "a b c d e a b c d e", "x y \u0085 z\x0bw\x1cq",
    "line\nline\n\n \nline \nline", "# * $ % & | < >", "aa " * 50_000, "a b c d e f " * 3 + "\x00 z",
    "Ünï cödé 中文 \U0001f600 " * 5,
]


def test_odd_texts(spark):
    docs = spark.createDataFrame(
        [(i, t) for i, t in enumerate(ODD)] + [(None, "one two")] * 2, "doc_id int, text string"
    )
    rows = quality.verdicts(docs).collect()
    assert len(rows) == len(ODD) + 2
    for r in rows:
        text = "one two" if r.doc_id is None else ODD[r.doc_id]
        assert tuple(r[n] for n in NAMES) == brute_force(text), text[:30]
    assert quality.verdicts(docs.limit(0)).collect() == []


def test_filter_keeps_columns_even_with_clashing_names(spark):
    good = "Plain words make a calm sentence that nobody would throw away. " * 1
    rows = [(1, good * 1 + " ".join(f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(80)), "q", 3), (2, "###", "q", 4)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, Quality string, n_words int")
    found = quality.good_documents(docs)
    assert found.columns == docs.columns
    assert [r.doc_id for r in found.collect()] == [1]
    with pytest.raises(ValueError, match="in the way"):
        quality.judge(docs)


def test_estimate_finds_good_and_poor_rules():
    # rules 0-2 agree, rule 3 is noise: every combination of its votes is as frequent
    patterns = {(1, 1, 1, 1): 400, (1, 1, 1, -1): 400, (-1, -1, -1, 1): 100, (-1, -1, -1, -1): 100}
    model = quality.estimate(patterns, 4)
    assert model.prior == pytest.approx(0.8, abs=0.02)
    assert min(model.on_good[:3]) > 0.99 and min(model.on_bad[:3]) == 0.95
    assert model.on_good[3] == 0.55 and model.on_bad[3] < 0.55
    assert model.log_odds((1, 1, 1, -1)) > 0 > model.log_odds((-1, -1, -1, 1))
    assert quality.estimate({}, 2) == quality.Model(0.8, (0.9, 0.9), (0.5, 0.5))


def test_labelled_documents_are_told_apart(spark, small):
    folder = small.replace("0.001", "0.01")
    rows = quality.verdicts(table(spark, folder, "documents")).collect()
    labels = {r.doc_id: r.quality for r in table(spark, folder, "labels").collect()}
    for label, least, most in ((1, 0.99, 1.0), (0, 0.0, 0.2)):
        kept = [r.kept for r in rows if labels.get(r.doc_id) == label and not r.base_failed]
        assert least <= sum(kept) / len(kept) <= most


def test_posterior_column_equals_the_model(spark):
    model = quality.Model(0.7, (0.9, 0.6), (0.5, 0.45))
    votes = spark.createDataFrame([(1, -1), (0, 0), (-1, 1)], "a int, b int")
    import math

    for r in votes.select("a", "b", model.posterior([votes.a, votes.b]).alias("p")).collect():
        assert r.p == pytest.approx(1 / (1 + math.exp(-model.log_odds((r.a, r.b)))))


def test_plan_is_native(spark, small):
    from plan_text import executed_plan

    plan = executed_plan(quality.verdicts(table(spark, small, "documents")))
    assert "Python" not in plan and "Arrow" not in plan
