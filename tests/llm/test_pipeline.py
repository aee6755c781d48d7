import __spark_entry__ as registry
import corpus_pipeline
import reference
from gaugeworks.llm.common import table
from gaugeworks.sources.shared import materialise


def test_registry_has_all_operators_and_the_pipeline():
    names = registry.queries()
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert names["pipeline"] is corpus_pipeline.run


def test_every_stage_against_its_brute_force_version(spark, small):
    docs = table(spark, small, "documents")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialise(stage(spark, docs, small), name)
        assert docs.columns == columns
        rows = docs.collect()
        after = {r.doc_id: r for r in rows}
        assert len(after) == len(rows) and after.keys() <= before.keys()
        assert {k: r.text for k, r in after.items()} == reference.STAGES[name](before, after)
        before = after
    name, stage = corpus_pipeline.STAGES[-1]
    pieces = stage(spark, docs, small).collect()
    assert {r.doc_id for r in pieces} == before.keys()
    assert sorted((r.doc_id, r.piece, r.length) for r in pieces) == sorted(
        (r.doc_id, r.piece, r.length) for r in corpus_pipeline.run(spark, small).collect()
    )


def test_stages_survive_odd_rows(spark, small):
    rows = [(1, None, None, None, None), (1, "", "en", "s", 0), (None, "few words", "en", None, 9), (2, "x" * 30_000, "en", "s", 1)]
    rows += [(3, "the same text again and again but not here", "en", "s", 3)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = materialise(stage(spark, frame, small), name)
            assert name == "best_fit_packing" or out.columns == docs.columns
            out.collect()
            frame = out if frame.limit(1).count() and name != "quality_rules" else frame
