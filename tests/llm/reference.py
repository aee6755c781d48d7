"""Brute-force versions of the pipeline's stages, on dictionaries from id to row."""

import numpy as np

from gaugeworks.llm import chunks, lines
from test_jaccard import brute_force as components
from test_lines import brute_force as without_spread_lines
from test_weak_supervision import brute_force as measures


def quality_rules(before, after):
    """What EM decides is tested on its own; base failures must go and plain texts stay."""
    failed = {k for k, r in before.items() if measures(r.text)[-1]}
    assert not failed & after.keys()
    return {k: before[k].text for k in after}


def line_dedup(before, after):
    return dict(zip(before, without_spread_lines([(r.source, r.text) for r in before.values()], lines.MIN_SITES), strict=True))


def ngram_jaccard_join(before, after):
    found = components([(k, r.text) for k, r in before.items()])
    kept = [found[k][1] for k in after]
    assert sorted(kept) == sorted({c for _, c in found.values()})
    return {k: before[k].text for k in after}


def substring_dedup(before, after):
    """Chunk by chunk: texts lose what stands earlier, in runs that are long enough."""
    chunker = chunks.Chunker()
    rows = {}
    for k, r in before.items():
        data = (r.text or "").encode()
        if data:
            _, start, length, _ = chunker([data])
            rows[k] = (data, start, length)
    times = {}
    for data, start, length in rows.values():
        for s, n in zip(start, length, strict=True):
            times[data[s : s + n]] = times.get(data[s : s + n], 0) + 1
    out = {}
    for k, r in before.items():
        out[k] = after[k].text
        if k not in rows:
            assert after[k].text == r.text
            continue
        data, start, length = rows[k]
        again = np.array([times[data[s : s + n]] > 1 for s, n in zip(start, length, strict=True)])
        run = longest = 0
        for flag, n in zip(again, length, strict=True):
            run = run + int(n) if flag else 0
            longest = max(longest, run)
        if longest < chunks.MIN_BYTES:
            assert after[k].text == r.text
    # every chunk that is left twice is in no long run of what was removed elsewhere
    left = {}
    for k, r in after.items():
        data = (r.text or "").encode()
        for i in range(0, len(data) - 400, 50):
            left.setdefault(data[i : i + 400], set()).add(k)
    for k, r in after.items():
        data = (r.text or "").encode()
        for i in range(len(data) - 400):
            assert left.get(data[i : i + 400], {k}) == {k}
    return out


STAGES = {f.__name__: f for f in (quality_rules, line_dedup, ngram_jaccard_join, substring_dedup)}
