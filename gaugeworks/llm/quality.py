"""Quality by weak supervision.

Every rule looks at one property of a text and votes good (1), bad (-1) or abstains
(0). Expectation-maximisation estimates from the votes of all documents how often
each rule is right on good and on bad documents, and which share is good; a document is
kept when its posterior probability of being good reaches one half. A text that fails
the base checks is never kept, and does not count in the estimates.

Documents with the same votes have the same posterior, so EM runs over vote patterns
and their counts. There are at most 3 ** len(RULES) patterns, however many documents;
only they reach the driver. The posterior of a document is then a sum of one learned
weight per rule, a plain column expression. Everything else is built-in functions.

Null and empty texts have no words and fail the base checks. Repeated rows count as
often as they occur. Windows of words are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import WHITE
from gaugeworks.sources.shared import materialise

WINDOW = 5
PLAIN_WORD = r"^[('\"]?[\p{L}\p{N}'-]+[.,;:!?)'\"]*$"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20


@dataclass(frozen=True)
class Rule:
    """Good from or up to one bound of a measure, bad beyond the other."""

    name: str
    measure: str
    good: str
    bad: str

    def vote(self, struct: str) -> Column:
        """The rule's vote on the measures in ``struct``; a null measure abstains."""
        measure = f"({re.sub(r'[a-z]+_[a-z_]+', lambda m: f'{struct}.{m[0]}', self.measure)})"
        return (
            F.when(F.expr(f"{measure} {self.bad}"), -1)
            .when(F.expr(f"{measure} {self.good}"), 1)
            .otherwise(0)
            .cast("tinyint")
        )


RULES = (
    Rule("length", "n_words", ">= 50", "< 20"),
    Rule("word_length", "word_chars / nullif(n_words, 0)", "between 3 and 9", "> 14"),
    Rule("symbols", "n_symbols / nullif(n_words, 0)", "< 0.02", "> 0.2"),
    Rule("line_copies", "n_dup_lines / nullif(n_lines, 0)", "< 0.05", "> 0.3"),
    Rule("repetition", "100 * n_repeat_words / nullif(n_words, 0)", "< 5", "> 20"),
    Rule("letters", "n_letters / nullif(word_chars, 0)", "> 0.85", "< 0.7"),
    Rule("plain_words", "n_plain_words / nullif(n_words, 0)", ">= 0.9", "< 0.75"),
    Rule("capitals", "n_capitals / nullif(n_letters, 0)", "< 0.2", "> 0.4"),
)


def measured(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add struct ``out`` with the measures of ``text``; intermediate columns are dropped again."""
    tmp = lambda name: f"{out}_{name}"
    c = lambda name: F.col(tmp(name))
    whole = F.coalesce(F.col(text), F.lit(""))
    windows = F.transform(
        F.slice(c("hashes"), 1, F.greatest(F.size(c("hashes")) - (WINDOW - 1), F.lit(0))),
        lambda h, i: F.xxhash64(h, *[F.get(c("hashes"), i + k) for k in range(1, WINDOW)]),
    )
    step = (
        df.withColumn(tmp("words"), F.array_remove(F.split(whole, WHITE), ""))
        .withColumn(
            tmp("lines"), F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        )
        .withColumn(tmp("joined"), F.array_join(c("words"), ""))
        .withColumn(tmp("hashes"), F.transform(c("words"), lambda w: F.xxhash64(w)))
        .withColumn(tmp("windows"), windows)
        .withColumn(
            tmp("sorted"),
            F.when(
                F.size(F.array_distinct(c("windows"))) < F.size(c("windows")),
                F.sort_array(
                    F.transform(c("windows"), lambda h, i: F.struct(h.alias("h"), i.alias("i")))
                ),
            ),
        )
    )
    found = F.filter(
        c("sorted"),
        lambda x, k: (x["h"] == F.get(c("sorted"), k + 1)["h"])
        | ((k > 0) & (x["h"] == F.get(c("sorted"), k - 1)["h"])),
    )
    starts = F.sort_array(F.transform(found, lambda x: x["i"]))
    covered = F.aggregate(
        starts,
        F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")),
        lambda a, i: F.struct(
            (a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last")
        ),
        lambda a: a["n"],
    )
    length = lambda column: F.length(column).cast("long")
    without = lambda column, pattern: F.length(F.regexp_replace(column, pattern, ""))
    joined = c("joined")
    step = step.withColumn(
        out,
        F.struct(
            F.size(c("words")).cast("long").alias("n_words"),
            length(joined).alias("word_chars"),
            (length(joined) - without(joined, r"[#*$%&|<>]+")).cast("long").alias("n_symbols"),
            (F.size(c("lines")) - F.size(F.array_distinct(c("lines")))).cast("long").alias("n_dup_lines"),
            F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
            F.size(c("lines")).cast("long").alias("n_lines"),
            (length(joined) - without(joined, r"\p{L}+")).cast("long").alias("n_letters"),
            F.size(F.filter(c("words"), lambda w: w.rlike(PLAIN_WORD))).cast("long").alias("n_plain_words"),
            (length(joined) - without(joined, r"\p{Lu}+")).cast("long").alias("n_capitals"),
        ),
    )
    names = ("words", "lines", "joined", "hashes", "windows", "sorted")
    return step.drop(*[tmp(n) for n in names])


@dataclass(frozen=True)
class Model:
    """Share of good documents, and how often each rule's vote is right on good and on bad ones."""

    prior: float
    on_good: tuple[float, ...]
    on_bad: tuple[float, ...]

    def weights(self) -> list[tuple[float, float]]:
        """What a good and a bad vote of each rule add to the log odds."""
        return [
            (math.log(a / (1 - b)), math.log((1 - a) / b))
            for a, b in zip(self.on_good, self.on_bad, strict=True)
        ]

    def start(self) -> float:
        return math.log(self.prior / (1 - self.prior))

    def log_odds(self, votes: Iterable[int]) -> float:
        return self.start() + sum(
            up if v > 0 else down if v < 0 else 0.0
            for v, (up, down) in zip(votes, self.weights(), strict=True)
        )

    def posterior(self, votes: Iterable[Column]) -> Column:
        odds = F.lit(self.start())
        for vote, (up, down) in zip(votes, self.weights(), strict=True):
            odds = odds + F.when(vote > 0, up).when(vote < 0, down).otherwise(0.0)
        return 1 / (1 + F.exp(-odds))


def estimate(patterns: dict[tuple[int, ...], int], rules: int, rounds: int = 200) -> Model:
    """EM over vote patterns, from rules that are right on most good and half the bad documents.

    No rule is ever sure, nor worse than chance, so a good vote never counts against a
    document. One document's worth of the start values is added per rule; with no
    documents they remain.
    """
    model = Model(0.8, (0.9,) * rules, (0.5,) * rules)
    for _ in range(rounds):
        good = {v: 1 / (1 + math.exp(-model.log_odds(v))) for v in patterns}
        total = sum(patterns.values())
        prior = (sum(n * good[v] for v, n in patterns.items()) + 0.8) / (total + 1)
        on_good, on_bad = [], []
        for r in range(rules):
            cast = [(v[r], n * good[v], n * (1 - good[v])) for v, n in patterns.items() if v[r]]
            a = (sum(g for v, g, _ in cast if v > 0) + 0.9) / (sum(g for _, g, _ in cast) + 1)
            b = (sum(w for v, _, w in cast if v < 0) + 0.5) / (sum(w for _, _, w in cast) + 1)
            on_good.append(min(0.995, max(0.55, a)))
            on_bad.append(min(0.95, max(1.02 - on_good[-1], b)))
        after = Model(min(0.99, max(0.5, prior)), tuple(on_good), tuple(on_bad))
        old = (model.prior, *model.on_good, *model.on_bad)
        new = (after.prior, *after.on_good, *after.on_bad)
        model = after
        if max(abs(x - y) for x, y in zip(old, new, strict=True)) < 1e-9:
            break
    return model


def vote_patterns(df: DataFrame, votes: str) -> dict[tuple[int, ...], int]:
    """Counts per pattern: at most 3 ** len(RULES) rows."""
    rows = df.groupBy(votes).agg(F.count(F.lit(1)).alias("n")).collect()
    return {tuple(r[0]): r.n for r in rows}


def judge(
    documents: DataFrame, text: str = "text", out: str = "quality", drop_text: bool = False
) -> DataFrame:
    """``documents``, stored, with struct ``out``: measures, votes, base_failed, p_good, kept.

    ``out`` and names that begin with it must not be columns of ``documents``.
    """
    taken = [c for c in documents.columns if c.lower().startswith(out.lower())]
    if taken:
        raise ValueError(f"columns {taken} are in the way of {out!r}")
    inner = measured(documents, text, out)
    if drop_text:
        inner = inner.drop(text)
    field = lambda s: f"{out}.{s}"
    votes = F.array(*[rule.vote(out) for rule in RULES])
    stored = materialise(inner.withColumn(f"{out}_votes", votes), "judged")
    failed = (F.col(field("n_words")) < MIN_WORDS) | (
        100 * F.col(field("n_repeat_words")) > MAX_REPEAT_PERCENT * F.col(field("n_words"))
    )
    model = estimate(vote_patterns(stored.where(~failed), f"{out}_votes"), len(RULES))
    p_good = model.posterior([F.get(f"{out}_votes", F.lit(i)) for i in range(len(RULES))])
    return (
        stored.withColumn(
            out,
            F.struct(
                f"{out}.*",
                F.col(f"{out}_votes").alias("votes"),
                failed.alias("base_failed"),
                p_good.alias("p_good"),
                (~failed & (p_good >= 0.5)).alias("kept"),
            ),
        )
        .drop(f"{out}_votes")
    )


def good_documents(documents: DataFrame, text: str = "text") -> DataFrame:
    """Rows whose text is kept, with the columns of ``documents``."""
    out = "quality"
    while any(c.lower().startswith(out) for c in documents.columns):
        out = f"_{out}"
    return judge(documents, text, out).where(F.col(f"{out}.kept")).select(*documents.columns)


def verdicts(documents: DataFrame) -> DataFrame:
    """One row per document with its measures, votes and verdict."""
    return judge(documents.select("doc_id", "text"), drop_text=True).select(
        "doc_id",
        *[
            f"quality.{n}"
            for n in (
                "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                "base_failed", "kept", "p_good", "votes",
            )
        ],
    )
