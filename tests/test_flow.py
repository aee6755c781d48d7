"""What the whole flow reads its sources from."""

from gaugeworks.domains import star_queries
from gaugeworks.domains.education import STUDENT_EVENT
from gaugeworks.plans.extract import extract_students
from plan_text import optimised_plan


def test_sources_of_the_flow_are_extracted_once(spark, small, monkeypatch):
    monkeypatch.setattr(star_queries, "run_lakehouse", lambda raw, domain, lake: raw)
    sources = star_queries._flow(spark, small)
    assert set(sources) == set(star_queries.STAR_SCORES.specs)
    for name, df in sources.items():
        plan = optimised_plan(df)
        assert "Join" not in plan and "Aggregate" not in plan, name
    assert sources["dados_alunos"].count() == star_queries.Star(spark, small).extracted_students().count()


def test_names_are_attached_to_orders_before_students(spark, small):
    star = star_queries.Star(spark, small)
    raw = star.raw
    plain = extract_students(raw.raw_students(), raw.city_directory(), raw.dictionary())
    found = star.extracted_students()
    assert found.schema == plain.schema
    assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = optimised_plan(found)
        by_city = [line for line in plan.split("\n") if "Join LeftOuter, (id_municipio" in line]
        by_order = [line for line in plan.split("\n") if "Join Inner, (l_orderkey" in line]
        assert len(by_city) == len(by_order) == 1
        assert by_city[0].index("Join") > by_order[0].index("Join")  # deeper in the tree
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_part_arrives_by_a_rename_and_payloads_are_written_once(spark, small, monkeypatch):
    written, moved = [], []
    real = star_queries.replace_folder
    monkeypatch.setattr(star_queries, "replace_folder", lambda s, a, b: (moved.append((a, b)), real(s, a, b)))
    monkeypatch.setattr(star_queries, "write_table", lambda *a, **k: written.append(a))
    sink, payloads = star_queries._run_stream(spark, small)
    assert len(moved) == 4 and not written
    star = star_queries.Star(spark, small)
    expected = star.raw.student_payloads(star.extracted_students(), STUDENT_EVENT).select("data")
    assert payloads.exceptAll(expected).isEmpty() and expected.exceptAll(payloads).isEmpty()
    shared = str(star_queries.shared_folder(spark, "parts"))
    star_queries._arrive(spark, f"{shared}/waiting", f"{shared}/source", 2)  # a part without rows
    assert spark.read.schema("data binary, parte int").parquet(f"{shared}/source").count() == 0
