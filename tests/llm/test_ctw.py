import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from gaugeworks.llm import ctw
from gaugeworks.llm.common import table


def tokens_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), "\n"]


def stream(text):
    ws = tokens_of(text)
    return (" ".join(ws[:-1]) + "\n").encode()


class PlainTree:
    """Context-tree weighting from the definition, with dictionaries and recursion."""

    def __init__(self, streams, depth):
        self.depth = depth
        self.counts = defaultdict(lambda: [0, 0])
        self.longer = defaultdict(set)
        for s in streams:
            for ctx, prefix, bit in self.steps(s):
                for d in range(depth + 1):
                    self.counts[ctx[:d], prefix][bit] += 1
                    if d < depth:
                        self.longer[ctx[:d], prefix].add(ctx[: d + 1])
        self.done = {}

    def steps(self, s):
        padded = b"\n" * self.depth + s
        for i in range(self.depth, len(padded)):
            ctx = tuple(padded[i - 1 :: -1][: self.depth])
            prefix = ""
            for k in range(7, -1, -1):
                bit = padded[i] >> k & 1
                yield ctx, prefix, bit
                prefix += str(bit)

    @staticmethod
    def kt(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(self, ctx, prefix):
        key = ctx, prefix
        if key not in self.done:
            own = self.kt(*self.counts[key])
            if len(ctx) < self.depth:
                split = sum(self.weighted(c, prefix)[1] for c in self.longer[key])
                total = np.logaddexp(own, split) - math.log(2)
                self.done[key] = math.exp(own - math.log(2) - total), total
            else:
                self.done[key] = 1.0, own
        return self.done[key]

    def probability(self, ctx, prefix, d=0):
        a, b = self.counts[ctx[:d], prefix] if (ctx[:d], prefix) in self.counts else (0, 0)
        if not a + b:
            return 0.5
        estimate = (b + 0.5) / (a + b + 1)
        if d == self.depth or (ctx[: d + 1], prefix) not in self.counts:
            return estimate
        share = self.weighted(ctx[:d], prefix)[0]
        return share * estimate + (1 - share) * self.probability(ctx, prefix, d + 1)

    def score(self, s):
        out = 0.0
        for ctx, prefix, bit in self.steps(s):
            p = self.probability(ctx, prefix)
            out += math.log10(p if bit else 1 - p)
        return out


TEXTS = [
    "the cat and the dog and the cat", "The dog\tand a bird", None, "", "ñandú über the 中文 cat", "zebra quilt",
    "cat " * 50, "a b c d e f g", "the the the", "dog and dog and bird",
]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id int, text string, learn boolean, kind string, n_tokens int")


def test_scores_equal_a_plain_tree(spark):
    rows = [(i, t, i % 3 != 0, "x", 7) for i, t in enumerate(TEXTS)] + [(None, "the cat", True, "x", 7)] * 2
    tree = PlainTree([stream(r[1]) for r in rows if r[2]], ctw.DEPTH)
    docs = frame(spark, rows).drop("kind", "n_tokens").repartition(2)
    found = ctw.score(docs, "learn").collect()
    want = Counter((r[0], round(tree.score(stream(r[1])), 3)) for r in rows)
    assert Counter((r.doc_id, round(r.score, 3)) for r in found) == want


def test_pairs_that_are_only_joined_give_the_same_scores(spark):
    rows = [(i, t, i % 3 != 0, "x", 7) for i, t in enumerate(TEXTS)]
    tree = PlainTree([stream(r[1]) for r in rows if r[2]], ctw.DEPTH)
    docs = frame(spark, rows).drop("kind", "n_tokens")
    for sent in (0, 40):
        found = {r.doc_id: r.score for r in ctw.score(docs, "learn", max_pairs_sent=sent).collect()}
        assert found == pytest.approx({r[0]: tree.score(stream(r[1])) for r in rows}, rel=1e-6)


def test_parts_in_small_pieces_give_the_same_model(spark, small, monkeypatch):
    docs = table(spark, small, "documents").select("text", ctw.F.lit(True).alias("learn"))
    counted = ctw.gather(docs, "text", "learn")
    whole = {r.key: r.value for r in ctw.train(counted).collect()}
    monkeypatch.setattr(ctw, "PART_ROWS", 50)
    assert {r.key: r.value for r in ctw.train(counted).collect()} == pytest.approx(whole)
    assert len(whole) == counted.where(f"kind = {ctw.PAIR}").count() > 10_000


def test_texts_that_are_not_learnt_from_change_no_score(spark):
    rows = [(i, t, i % 3 != 0, "x", 7) for i, t in enumerate(TEXTS)]
    more = [(100 + i, f"quite other words {i} xyz{i * 977}" * 20, False, "x", 7) for i in range(20)]
    few = {r.doc_id: r.score for r in ctw.score(frame(spark, rows).drop("kind", "n_tokens"), "learn").collect()}
    many = {r.doc_id: r.score for r in ctw.score(frame(spark, rows + more).drop("kind", "n_tokens"), "learn").collect()}
    assert {k: many[k] for k in few} == pytest.approx(few, rel=1e-9) and len(many) == len(few) + 20


def test_probabilities_of_all_bytes_add_up_to_one(spark):
    learnt = ["abab abba", "ab ba xyz"]
    held = [(i + 10, "abab" + chr(i), False, "", 0) for i in range(33, 127)]
    rows = [(i, t, True, "", 0) for i, t in enumerate(learnt)] + held
    model = {r.key: r.value for r in ctw.train(ctw.gather(frame(spark, rows), "text", "learn")).collect()}
    tree = PlainTree([stream(t) for t in learnt], ctw.DEPTH)
    ctx = tuple(b"baba\n")
    above = sum(b << 8 * (k + 1) for k, b in enumerate(ctx))
    total = 0
    for byte in range(256):
        p, prefix = 1.0, ""
        for k in range(7, -1, -1):
            q = tree.probability(ctx, prefix)
            bit = byte >> k & 1
            p *= q if bit else 1 - q
            prefix += str(bit)
        if above | byte in model:
            assert model[above | byte] == pytest.approx(math.log10(p), rel=1e-6)
        total += p
    assert total == pytest.approx(1) and sum(above | b in model for b in range(256)) > 60


def test_base_counts_on_a_table(spark, small, monkeypatch):
    docs = table(spark, small, "documents")
    rows = {r.doc_id: r.text for r in docs.collect()}
    held = {k: zlib.crc32(str(k).encode()) % 10 == 0 for k in rows}
    counts = Counter(t for k, x in rows.items() if not held[k] for t in tokens_of(x))
    total = sum(counts.values())
    space = total + 0.1 * (len(counts) + 1)
    monkeypatch.setattr(ctw, "MAX_WORDS_SENT", 500)  # most words take the join
    found = ctw.score_documents(docs).collect()
    assert {r.doc_id for r in found} == rows.keys() and len(found) == len(rows)
    for r in found:
        tokens = tokens_of(rows[r.doc_id])
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[r.doc_id], len(tokens), total)
        assert r.n_known == sum(counts[t] > 0 for t in tokens)
        assert r.base_score == pytest.approx(sum(math.log10((counts[t] + 0.1) / space) for t in tokens))


def test_held_out_texts_are_coded_better_than_by_the_base(spark, small):
    found = ctw.score_documents(table(spark, small.replace("0.001", "0.01"), "documents"))
    out = [(r.score, r.base_score) for r in found.where("held_out").collect()]
    assert len(out) > 50 and sum(s for s, _ in out) > sum(b for _, b in out)


def test_nothing_to_learn_from(spark):
    docs = frame(spark, [(1, "ab", False, "", 0), (2, None, False, "", 0)]).drop("n_tokens")
    found = {r.doc_id: r for r in ctw.score(docs, "learn").collect()}
    assert found[1].score == pytest.approx(-3 * 8 * math.log10(2))
    assert (found[2].n_tokens, found[2].n_known, found[2].train_tokens, found[2].base_score) == (1, 0, 0, 0.0)
    assert found[1].kind == ""
    assert ctw.score(docs.limit(0), "learn").collect() == []


def test_table_of_numbers():
    draw = np.random.default_rng(0)
    keys = np.unique(draw.integers(0, 1 << 50, 5000))
    found = ctw.Table(keys, np.arange(len(keys)))
    values, there = found.look_up(np.concatenate([keys, keys + 1]))
    assert there[: len(keys)].all() and values[: len(keys)].tolist() == list(range(len(keys)))
    assert not there[len(keys) :][~np.isin(keys + 1, keys)].any()
    assert not ctw.Table(keys[:0], keys[:0]).look_up(keys)[1].any()


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 10, 1e3, 1e9])
    assert ctw.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-9, abs=1e-9)
