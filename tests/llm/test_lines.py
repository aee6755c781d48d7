from collections import defaultdict

from gaugeworks.llm import lines
from gaugeworks.llm.common import table


def brute_force(rows, min_sites):
    """Texts after removal, straight from the definition."""
    white = " \t\n\x0b\x0c\r"
    sites = defaultdict(set)
    for site, text in rows:
        for line in (text or "").split("\n"):
            if line.strip(white) and site is not None:
                sites[line.strip(white)].add(site)
    out = []
    for _, text in rows:
        if text is None:
            out.append(None)
            continue
        marked = [(x, len(sites[x.strip(white)]) >= min_sites) for x in text.split("\n")]
        spread = sum(m for _, m in marked)
        if spread >= sum(bool(x.strip(white)) for x, _ in marked):
            out.append(text)
        else:
            out.append("\n".join(x for x, m in marked if not m))
    return out


def test_table_equals_brute_force(spark, small):
    docs = table(spark, small, "documents")
    rows = {r.doc_id: (r.source, r.text) for r in docs.collect()}
    for sites in (3, 12):
        want = dict(zip(rows, brute_force(list(rows.values()), sites), strict=True))
        found = lines.remove_spread_lines(docs, min_sites=sites, counts=True)
        assert found.columns == [*docs.columns, "n_lines", "n_removed"]
        got = {r.doc_id: r for r in found.collect()}
        assert {k: r.text for k, r in got.items()} == want
        assert any(r.n_removed for r in got.values())


def test_odd_rows(spark):
    foot = "  Read our terms.\t"
    rows = [(f"s{i}", f"own line {i}\n{foot}\n\nmore {i}") for i in range(20)]
    rows += [(None, "own\nRead our terms.\nmore"), ("s1", None), ("s1", ""), ("s2", " \n\t"), ("s3", "Read our terms.")]
    rows += [(f"s{i % 15}", "copy one\ncopy two\ncopy three") for i in range(40)]
    rows += [(f"s{i}", f"one head\nown line {i}\none foot") for i in range(20)]
    rows += [("s1", "local\nlocal\nlocal two") for _ in range(40)]  # many documents, one site
    docs = spark.createDataFrame([(i, t, s, 1) for i, (s, t) in enumerate(rows)], "doc_id int, text string, source string, line_dedup int")
    found = {r.doc_id: r.text for r in lines.remove_spread_lines(docs).collect()}
    assert [found[i] for i in range(len(rows))] == brute_force(rows, 12)
    assert found[0] == "own line 0\n\nmore 0" and found[24] == "Read our terms."
    assert found[65] == "own line 0" and found[25] == rows[25][1]
    assert lines.remove_spread_lines(docs.limit(0)).collect() == []


def test_estimates_near_the_threshold_are_counted_exactly(spark):
    pairs = [(k, f"site {i}") for k, n in ((1, 999), (2, 1000), (3, 1001), (4, 3000)) for i in range(n)]
    frame = spark.createDataFrame(pairs + pairs[:500], "line long, site string")
    assert sorted(r.line for r in lines.spread_lines(frame, 1000).collect()) == [2, 3, 4]


def test_plan_is_native(spark, small):
    from plan_text import executed_plan

    plan = executed_plan(lines.remove_spread_lines(table(spark, small, "documents")))
    assert "Python" not in plan and "Arrow" not in plan
