"""Rules, reports, the gate and the report table."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gaugeworks.domains.education import EDUCATION, STATE_CODES
from gaugeworks.operators.quality import (
    QualityAlert,
    domain_check,
    domain_offenders,
    duplicate_check,
    foreign_key_check,
    gate_decisions,
    incomplete_check,
    measure,
    missing_checks,
    orphan_keys,
    quality_gate,
    quality_suite,
    range_check,
    report_documents,
    source_report,
    spec_checks,
)
from gaugeworks.sources.reports import read_reports, save_report
from gaugeworks.spec import DomainRule, EntitySpec, ForeignKey, RangeRule

STATE = DomainRule("uf_valida", "sigla_uf", STATE_CODES)


def one(df, check):
    return measure(df, "t", [check]).first()


def test_duplicates(spark):
    data = [("a", 7)] * 4 + [("a", 8), ("b", 7), ("b", 7), ("c", 7)]
    df = spark.createDataFrame(data, ["id", "ano"])
    row = one(df, duplicate_check(df, ["id", "ano"]))
    assert (row.total_registros, row.violacoes, row.status) == (8, 4, "ALERTA")
    assert one(df, duplicate_check(df, ["id"])).violacoes == 5
    assert one(df, duplicate_check(df, [])).violacoes == 0
    assert one(df, duplicate_check(df, ["absent"])).status == "N/A"


def test_incomplete_keys_are_no_duplicates_but_counted(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2), (1, 2), (None, None)], "a int, b int")
    row = one(df, duplicate_check(df, ["a", "b"]))
    assert row.violacoes == 1
    row = one(df, incomplete_check(df, ["a", "b"]))
    assert (row.regra, row.violacoes, row.percentual) == ("chave_incompleta", 3, 60.0)


def test_a_clean_table_with_some_null_ids_passes(spark):
    spec = EntitySpec(name="t", dedup_keys=("id",))
    ids = [(str(i),) for i in range(98)] + [(None,)] * 2
    report = quality_suite(spark.createDataFrame(ids, "id string"), spec)
    assert quality_gate(report, fail_on_alert=True) == []


def test_keys_of_the_source_are_reported(spark):
    spec = EntitySpec(name="t", mandatory=("k", "y"), padded_keys=(("k", 5),))
    data = [("123456", 1), ("12a", 1), ("-3", 1), ("", 1), (None, None), ("12345", 1)]
    source = spark.createDataFrame(data, "K string, y int")
    report = {(r.regra, r.coluna): r for r in source_report(source, spec).collect()}
    assert report["chave_invalida", "k"].violacoes == 3
    assert report["chave_ausente", "k"].violacoes == 2
    assert report["chave_ausente", "y"].violacoes == 1
    assert report["chave_invalida", "k"].status == "ALERTA" and len(report) == 3


def test_the_gate_counts_checks_like_the_report(spark):
    df, spec = students(spark), EDUCATION.specs["dados_alunos"]
    report = quality_suite(df, spec)
    document = report_documents(report).first()
    alerts = sum(c.status == "ALERTA" for c in document.checks)
    assert gate_decisions(report, True).first().alertas == alerts


def test_missing_values(spark):
    df = spark.createDataFrame([(0.5, "a"), (None, None), (None, "b"), (2.5, "")] * 2 + [(9.0, "c")], "m double, s string")
    checks = missing_checks(df, ["m", "absent", "s"])
    assert [c.label for c in checks] == ["m", "s"]
    assert [(r.violacoes, r.percentual) for r in (one(df, c) for c in checks)] == [(4, 44.44), (2, 22.22)]


@pytest.mark.parametrize("nulls, status", [(4, "OK"), (5, "ALERTA")])
def test_five_percent_missing_is_an_alert(spark, nulls, status):
    df = spark.range(100).select(F.when(F.col("id") >= nulls, 1).alias("x"))
    assert one(df, missing_checks(df, ["x"])[0]).status == status


def test_empty_table_is_fine(spark):
    df = spark.createDataFrame([], "id int, x double, sigla_uf string")
    checks = [duplicate_check(df, ["id"]), *missing_checks(df, ["x"]), domain_check(df, STATE)]
    report = measure(df, "t", checks).collect()
    assert [(r.violacoes, r.status) for r in report] == [(0, "OK")] * 3
    assert report[1].percentual == 0.0


def test_ranges(spark):
    df = spark.createDataFrame([("2018",), ("2019",), ("2035",), (None,), ("x",)], ["ano"])
    row = one(df, range_check(df, RangeRule("consistencia_ano", "ano", 2019, 2035)))
    assert (row.violacoes, row.status) == (1, "ALERTA")
    absent = range_check(df, RangeRule("consistencia_percentual", "meta", 0, 100))
    assert one(df, absent).status == "N/A"


def test_domain_counts_null_and_lists_every_offender(spark):
    data = [("SP",), ("XX",), ("XX",), (None,)]
    df = spark.createDataFrame(data, ["sigla_uf"])
    row = one(df, domain_check(df, STATE))
    assert (row.violacoes, row.status) == (3, "ALERTA")
    offenders = domain_offenders(df, "t", STATE).collect()
    assert {(r.valor, r.registros) for r in offenders} == {("XX", 2), (None, 1)}


def test_foreign_key(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,), ("c",)], ["k"])
    reference = spark.createDataFrame([("a",), ("a",), (None,)], ["key"])
    key = ForeignKey("k", "other", "key")
    assert {r.k for r in orphan_keys(df, reference, key).collect()} == {"b", "c", None}
    row = foreign_key_check(df, "t", reference, key).first()
    assert (row.regra, row.violacoes, row.status) == ("chave_relacionamento", 3, "ALERTA")


def students(spark):
    return spark.createDataFrame(
        [("1", 2024, "0000001", "SP", 1.0), ("1", 2024, "0000002", "XX", None)],
        "id_aluno string, ano int, id_municipio string, sigla_uf string, proficiencia_saeb double",
    )


def test_fused_suite_equals_single_rules(spark):
    df, spec = students(spark), EDUCATION.specs["dados_alunos"]
    fused = measure(df, spec.name, spec_checks(df, spec)).collect()
    single = [one(df, check) for check in spec_checks(df, spec)]
    assert [r[1:] for r in fused] == [r[1:] for r in single]


def test_suite_checks_keys_only_with_a_reference(spark):
    df, spec = students(spark), EDUCATION.specs["dados_alunos"]
    cities = spark.createDataFrame([("0000001",)], ["id_municipio"])
    rules = [r.regra for r in quality_suite(df, spec).collect()]
    assert "chave_relacionamento" not in rules
    report = quality_suite(df, spec, {"municipio": cities}).collect()
    assert [(r.violacoes) for r in report if r.regra == "chave_relacionamento"] == [1]


def test_counting_rules_scan_the_table_once(spark, tmp_path):
    path = str(tmp_path / "t")
    students(spark).write.parquet(path)
    df, spec = spark.read.parquet(path), EDUCATION.specs["dados_alunos"]
    report = measure(df, spec.name, spec_checks(df, spec))
    assert report._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_gate(spark):
    spec = EntitySpec(name="t", dedup_keys=("id",))
    good = quality_suite(spark.createDataFrame([(1,), (2,)], ["id"]), spec)
    bad = quality_suite(spark.createDataFrame([(1,), (1,)], ["id"]), spec)
    assert quality_gate(good, fail_on_alert=True) == []
    assert quality_gate(bad, fail_on_alert=False) == ["t"]
    with pytest.raises(QualityAlert):
        quality_gate(bad, fail_on_alert=True)
    assert issubclass(QualityAlert, ValueError)
    assert gate_decisions(bad, True).first().publica is False


def test_documents_group_missing_columns(spark):
    df, spec = students(spark), EDUCATION.specs["dados_alunos"]
    document = report_documents(quality_suite(df, spec)).first()
    checks = {c.regra: c for c in document.checks}
    assert len(checks) == len(document.checks) == 5
    missing = checks["valores_ausentes"]
    assert missing.status == "ALERTA" and missing.coluna is None
    assert {(d.coluna, d.nulos) for d in missing.detalhe_por_coluna} == {
        ("ano", 0), ("id_municipio", 0), ("proficiencia_saeb", 1),
    }
    assert document.status_geral == "ALERTA"


def test_reports_of_several_runs_add_up_and_a_rerun_replaces(spark, tmp_path):
    path = str(tmp_path / "reports")
    spec = EntitySpec(name="t", dedup_keys=("id",))
    report = quality_suite(spark.createDataFrame([(1,), (1,)], ["id"]), spec)
    at = datetime(2024, 5, 6, 7, 8, 9, 123456)
    for run in ("one", "two", "two"):
        save_report(report, path, run, at)
    stored = read_reports(spark, path).collect()
    assert len(stored) == 2
    assert {r.reported_at for r in stored} == {at}
    assert [r.status_geral for r in stored] == ["ALERTA", "ALERTA"]
