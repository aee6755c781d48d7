"""The whole flow on the shipped domain, and what a gate does to it."""

import os

import pytest

from gaugeworks.domains.education import EDUCATION
from gaugeworks.operators.quality import QualityAlert
from gaugeworks.plans.concurrent import concurrently
from gaugeworks.plans.lakehouse import Lakehouse, run_entity, run_lakehouse, run_marts
from gaugeworks.plans.marts import MARTS
from gaugeworks.sources.reports import read_reports
from gaugeworks.sources.tables import read_table


@pytest.fixture()
def raw(spark):
    wide = ", ".join(f"meta_alfabetizacao_{y} double" for y in range(2024, 2031))
    metas = tuple(float(y - 1950) for y in range(2024, 2031))
    figures = f"ano int, rede string, taxa_alfabetizacao string, {wide}, percentual_participacao double"
    return {
        "uf": spark.createDataFrame(
            [("sp", " São  Paulo", 2024, "2", "M"), ("rj ", "Rio", 2024, "2", "M")],
            "sigla_uf string, sigla_uf_nome string, ano int, serie string, rede string",
        ),
        "municipio": spark.createDataFrame(
            [(355030, "One", "sp", 2024, "2", "M"), (355030, "One", "sp", 2025, "2", "M")],
            "id_municipio int, id_municipio_nome string, sigla_uf string, ano int, "
            "serie string, rede string",
        ),
        "meta_alfabetizacao_brasil": spark.createDataFrame(
            [(2024, "M", "60,5", *metas, 90.0)], figures
        ),
        "meta_alfabetizacao_uf": spark.createDataFrame(
            [("SP", 2024, "M", "70", *metas, 90.0)], f"sigla_uf string, {figures}"
        ),
        "meta_alfabetizacao_municipio": spark.createDataFrame(
            [(355030, 2024, "M", "80,25", *metas, 90.0, 4), (99, 2025, "M", "n/d", *metas, 90.0, 1)],
            f"id_municipio int, {figures}, nivel_alfabetizacao int",
        ),
        "dados_alunos": spark.createDataFrame(
            [("a", 355030, "sp", 2024, 700.0, 1.0), ("a", 355030, "sp", 2024, 700.0, 1.0)],
            "id_aluno string, id_municipio int, sigla_uf string, ano int, proficiencia double, "
            "peso_aluno double",
        ),
    }


def test_flow_from_sources_to_marts(spark, raw, tmp_path):
    lake = Lakehouse(str(tmp_path))
    tables = run_lakehouse(raw, EDUCATION, lake)
    assert tables["municipio"].count() == 2 and tables["cities"].count() == 1
    assert tables["dados_alunos"].count() == 1
    mart = {r.id_municipio: r for r in tables["gold_indicador_municipio"].collect()}
    one = mart["0355030"]
    assert (one.nome_municipio, one.nome_uf) == ("One", "São Paulo")
    assert (one.indicador_alfabetizacao_pct, one.meta_alfabetizacao) == (80.25, 74.0)
    assert one.atingiu_meta_municipio is True
    assert mart["0000099"].nome_uf is None
    trend = {r.ano: r for r in tables["gold_evolucao_temporal"].collect()}
    assert trend[2024].resultado_brasil == 60.5
    # Stored tables can be read again, and the marts built from the stored table alone.
    integrated = read_table(spark, lake.table_path(EDUCATION.integrated))
    again = run_marts(integrated, EDUCATION.layout, Lakehouse(str(tmp_path / "again")))
    assert set(again) == set(MARTS)
    reports = {r.entidade: r.status_geral for r in read_reports(spark, lake.reports_dir).collect()}
    assert reports["uf"] == "OK"
    assert reports["meta_alfabetizacao_municipio"] == "ALERTA"
    assert reports[EDUCATION.integrated] == "ALERTA"


def test_running_twice_gives_the_same_tables(raw, tmp_path):
    lake = Lakehouse(str(tmp_path))
    counts = []
    for _ in range(2):
        tables = run_lakehouse(raw, EDUCATION, lake, by_network=True)
        counts.append({name: df.count() for name, df in tables.items()})
    assert counts[0] == counts[1]


def test_a_gate_keeps_a_bad_table_out_but_reports_it(spark, raw, tmp_path):
    lake = Lakehouse(str(tmp_path), fail_on_alert=True)
    spec = EDUCATION.specs["meta_alfabetizacao_municipio"]
    with pytest.raises(QualityAlert):
        run_entity(raw[spec.name], spec, lake)
    assert not os.path.exists(lake.table_path(spec.name))
    assert read_reports(spark, lake.reports_dir).first().status_geral == "ALERTA"
    coded = raw["municipio"].selectExpr("id_municipio", "'zz' AS sigla_uf")
    with pytest.raises(QualityAlert):
        run_entity(coded, EDUCATION.specs["municipio"], lake)
    found = spark.read.parquet(lake.offenders_dir).filter("run_id LIKE 'municipio-%'")
    assert [(r.coluna, r.valor, r.registros) for r in found.collect()] == [("sigla_uf", "ZZ", 1)]
    good = EDUCATION.specs["uf"]
    assert run_entity(raw["uf"], good, lake).count() == 2


def test_rejected_rows_are_stored_and_a_gate_can_hold_for_one_entity(spark, raw, tmp_path):
    lake = Lakehouse(str(tmp_path), fail_on_alert={"municipio"})
    spec = EDUCATION.specs["meta_alfabetizacao_municipio"]
    source = raw[spec.name].unionByName(raw[spec.name].selectExpr("* EXCEPT (id_municipio)", "123456789 AS id_municipio"))
    kept = run_entity(source, spec, lake)
    lost = spark.read.parquet(lake.rejects_path(spec.name)).collect()
    assert kept.count() + len(lost) == source.count()
    assert {(r.coluna, r.motivo, r.valor) for r in lost} == {("id_municipio", "chave_invalida", "123456789")}
    checks = {c.regra: c.status for r in read_reports(spark, lake.reports_dir).collect() for c in r.checks}
    assert checks["chave_invalida"] == "ALERTA"
    coded = raw["municipio"].selectExpr("id_municipio", "'zz' AS sigla_uf")
    with pytest.raises(QualityAlert):
        run_entity(coded, EDUCATION.specs["municipio"], lake)
    assert os.listdir(os.path.dirname(lake.table_path("x"))) == [spec.name]


def test_a_gated_table_replaces_the_old_one(spark, raw, tmp_path):
    lake = Lakehouse(str(tmp_path), fail_on_alert=True)
    spec = EDUCATION.specs["uf"]
    assert run_entity(raw["uf"], spec, lake).count() == 2
    assert run_entity(raw["uf"].limit(1), spec, lake).count() == 1
    assert os.listdir(os.path.dirname(lake.table_path("x"))) == ["uf"]


def test_jobs_run_together_and_a_failure_is_raised(spark):
    def fail():
        raise QualityAlert("stop")

    jobs = {n: (lambda n=n: spark.range(n).count()) for n in (3, 5)}
    assert concurrently(spark, jobs) == {3: 3, 5: 5}
    with pytest.raises(QualityAlert):
        concurrently(spark, {"good": lambda: spark.range(1).count(), "bad": fail})
