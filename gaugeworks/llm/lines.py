"""Removal of lines that are spread over many sites.

A line counts once per document. Lines in enough documents, from more than one site,
get a HyperLogLog sketch of their sites; sketches merge in the aggregation, so a line
of every document costs a task no more than any other. An estimate clearly off the
threshold decides; lines near it get an exact distinct count. Lines are compared by a
64-bit hash of their text without white space at the ends.

A text loses its spread lines wherever it has a line of its own. A text all of whose
lines are spread is a copy of other texts and stays whole for the near-duplicate stage.
So no text loses all its lines.

Null texts stay null, empty texts empty; lines without a word are never removed. A
null site counts as no site. Repeated rows are kept and treated alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.llm.common import WHITE_CHARACTERS
from gaugeworks.sources.shared import materialise

MIN_SITES = 12
LOG_SKETCH = 12
#: Four standard errors of a sketch with 2 ** LOG_SKETCH registers.
MARGIN = 4 * 1.04 / 2 ** (LOG_SKETCH / 2)


def _key(line: Column) -> Column:
    """Hash of a line, null without a word."""
    bare = F.trim(line, F.lit(WHITE_CHARACTERS))
    return F.when(bare != "", F.xxhash64(bare))


def _keys(text: Column) -> Column:
    return F.transform(F.split(text, "\n"), _key)


def spread_lines(lines: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """(line) of all lines on at least ``min_sites`` sites; ``lines`` is (line, site)."""
    # stored, as a join side from an aggregation keeps adaptive execution from splitting hot lines
    often = materialise(
        lines.groupBy("line")
        .agg(F.count("site").alias("n"), F.min("site").alias("low"), F.max("site").alias("high"))
        .where((F.col("n") >= min_sites) & ((F.col("low") < F.col("high")) | F.lit(min_sites <= 1)))
        .select("line"),
        "frequent-lines",
    )
    sketched = materialise(
        lines.join(often, "line")
        .where("site is not null")
        .groupBy("line")
        .agg(F.hll_sketch_agg("site", F.lit(LOG_SKETCH)).alias("sketch"))
        .select("line", F.hll_sketch_estimate("sketch").alias("sites")),
        "line-sketches",
    )
    off = max(1.0, MARGIN * min_sites)
    clear = sketched.where(F.col("sites") > min_sites + off).select("line")
    near = sketched.where(F.abs(F.col("sites") - min_sites) <= off).select("line")
    exact = (
        lines.join(near, "line")
        .groupBy("line")
        .agg(F.count_distinct("site").alias("sites"))
        .where(F.col("sites") >= min_sites)
        .select("line")
    )
    return clear.union(exact)


def remove_spread_lines(
    documents: DataFrame,
    text: str = "text",
    site: str = "source",
    min_sites: int = MIN_SITES,
    counts: bool = False,
) -> DataFrame:
    """``documents`` without the spread lines of their texts.

    With ``counts`` the columns ``n_lines`` and ``n_removed`` are added.
    """
    names = {c.lower() for c in documents.columns}
    own = "line_dedup"
    while any(n.startswith(own) for n in names):
        own = f"_{own}"
    content, found, drop = f"{own}_content", f"{own}_found", f"{own}_drop"
    lines = materialise(
        documents.select(
            F.xxhash64(text).alias("content"),
            F.col(site).cast("string").alias("site"),
            F.explode(F.array_distinct(F.array_compact(_keys(F.col(text))))).alias("line"),
        ),
        "lines",
    )
    spread = materialise(spread_lines(lines, min_sites), "spread-lines")
    per_text = (
        lines.select("content", "line")
        .join(spread, "line")
        .groupBy(F.col("content").alias(content))
        .agg(F.collect_set("line").alias(found))
    )
    split = F.split(F.col(text), "\n")
    marked = F.transform(split, lambda x: F.coalesce(F.array_contains(F.col(found), _key(x)), F.lit(False)))
    joined = (
        documents.withColumn(content, F.xxhash64(text))
        .join(per_text, content, "left")
        .withColumn(drop, F.when(F.col(found).isNotNull(), marked))
    )
    n_lines = F.size(F.array_compact(_keys(F.col(text))))
    n_found = F.coalesce(F.size(F.filter(F.col(drop), lambda x: x)), F.lit(0))
    copy = n_found >= n_lines
    kept = F.array_join(F.filter(split, lambda x, i: ~F.get(F.col(drop), i)), "\n")
    removed = F.col(found).isNotNull() & ~copy
    out = {text: F.when(removed, kept).otherwise(F.col(text))}
    if counts:
        out["n_lines"] = F.greatest(n_lines, F.lit(0)).cast("long")
        out["n_removed"] = F.when(removed, n_found).otherwise(0).cast("long")
    return joined.withColumns(out).select(*documents.columns, *[c for c in out if c != text])
