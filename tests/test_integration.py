"""Integration of city, state and national figures, and the marts on it."""

import pytest
from pyspark.sql import functions as F

from gaugeworks.domains.education import LAYOUT
from gaugeworks.operators.integrate import (
    city_dimension,
    integrate,
    integration_report,
    state_dimension,
)
from gaugeworks.plans.marts import (
    MARTS,
    city_mart,
    comparison_mart,
    dashboard_mart,
    state_mart,
    trend_mart,
)

TARGETS = (
    "id_municipio string, ano int, rede string, resultado_alfabetizacao double, "
    "meta_alfabetizacao double, percentual_participacao double, nivel_alfabetizacao int, "
    "nome_municipio string, sigla_uf string"
)


@pytest.fixture()
def inputs(spark):
    city_targets = spark.createDataFrame(
        [
            ("0000001", 2024, "M", 80.0, 70.0, 90.0, 3, "ignored", "ZZ"),
            ("0000001", 2024, "E", 60.0, 70.0, 90.0, 3, "ignored", "ZZ"),
            ("0000002", 2024, "M", None, 70.0, 90.0, 3, None, None),
            ("0000009", 2025, "M", 50.0, None, 90.0, 3, None, None),
        ],
        TARGETS,
    )
    cities = spark.createDataFrame(
        [("0000001", "One", "SP"), ("0000002", "Two", "RJ")],
        "id_municipio string, nome_municipio string, sigla_uf string",
    )
    states = spark.createDataFrame(
        [("SP", "São Paulo"), ("RJ", "Rio")], "sigla_uf string, nome_uf string"
    )
    state_targets = spark.createDataFrame(
        [("SP", 2024, "M", 65.0, 60.0), ("SP", 2024, "E", 55.0, 60.0), ("RJ", 2024, "M", 40.0, None)],
        "sigla_uf string, ano int, rede string, resultado_alfabetizacao double, "
        "meta_alfabetizacao double",
    )
    national = spark.createDataFrame(
        [(2024, "M", 60.0, 61.0), (2024, "E", 62.0, 61.0), (2024, "P", 64.0, 61.0)],
        "ano int, rede string, resultado_alfabetizacao double, meta_alfabetizacao double",
    )
    return city_targets, cities, states, state_targets, national


def test_rows_multiply_by_the_networks_on_the_other_side(inputs):
    integrated = integrate(*inputs, LAYOUT)
    counts = {(r.id_municipio, r.rede): r["count"] for r in integrated.groupBy("id_municipio", "rede").count().collect()}
    assert counts == {
        ("0000001", "M"): 6, ("0000001", "E"): 6, ("0000002", "M"): 3, ("0000009", "M"): 1,
    }
    assert integrated.columns[:4] == ["ano", "sigla_uf", "id_municipio", "rede"]
    assert integrated.columns[-1] == "_silver_processed_at"


def test_by_network_keeps_every_city_row_once(inputs):
    rows = integrate(*inputs, LAYOUT, by_network=True, audit=False).collect()
    got = {(r.id_municipio, r.rede): r for r in rows}
    assert len(rows) == len(got) == 4
    one = got["0000001", "E"]
    assert (one.nome_municipio, one.sigla_uf, one.nome_uf) == ("One", "SP", "São Paulo")
    assert (one.resultado_alfabetizacao_uf, one.resultado_alfabetizacao_brasil) == (55.0, 62.0)
    assert one.atingiu_meta_municipio is False
    assert got["0000001", "M"].atingiu_meta_municipio is True
    assert got["0000002", "M"].atingiu_meta_municipio is None
    unknown = got["0000009", "M"]
    assert (unknown.sigla_uf, unknown.nome_uf, unknown.meta_alfabetizacao_brasil) == (None,) * 3


def test_report_names_orphans_and_multiplying_keys(inputs):
    _, cities, _, state_targets, national = inputs
    integrated = integrate(*inputs, LAYOUT)
    report = integration_report(integrated, cities, state_targets, national, LAYOUT, "t")
    got = {(r.entidade, r.regra): r.violacoes for r in report.collect()}
    assert got == {
        ("t", "chave_relacionamento"): 1,
        ("t_uf", "duplicidade"): 1,
        ("t_brasil", "duplicidade"): 2,
    }


def test_dimensions_have_one_row_per_code(spark):
    states = spark.createDataFrame(
        [("SP", "São Paulo", 2023), ("SP", "Sao Paulo", 2024), ("RJ", "Rio", 2023)],
        ["sigla_uf", "nome_uf", "ano"],
    )
    got = sorted(tuple(r) for r in state_dimension(states, LAYOUT).collect())
    assert got == [("RJ", "Rio"), ("SP", "Sao Paulo")]
    with pytest.raises(ValueError, match="sigla_uf"):
        city_dimension(spark.createDataFrame([("1", "a")], ["id_municipio", "nome_municipio"]), LAYOUT)


def test_state_mart(inputs):
    mart = {(r.ano, r.sigla_uf): r for r in state_mart(integrate(*inputs, LAYOUT), LAYOUT).collect()}
    assert set(mart) == {(2024, "SP"), (2024, "RJ"), (2025, None)}
    sp = mart[2024, "SP"]
    # Two networks compete; the smaller figure is kept, always.
    assert (sp.indicador_alfabetizacao_pct, sp.gap_meta_pct, sp.atingiu_meta_uf) == (55.0, -5.0, False)
    assert (mart[2024, "RJ"].gap_meta_pct, mart[2024, "RJ"].atingiu_meta_uf) == (None, None)


def test_trend_counts_rows_and_cities(inputs):
    rows = trend_mart(integrate(*inputs, LAYOUT), LAYOUT).collect()
    assert [r.ano for r in rows] == [2024, 2025]
    first, second = rows
    assert first.media_indicador_municipios == 70.0
    assert (first.qtd_municipios_avaliados, first.qtd_municipios_distintos) == (15, 2)
    assert (first.resultado_brasil, first.meta_brasil) == (60.0, 61.0)
    assert (second.media_indicador_municipios, second.resultado_brasil) == (50.0, None)


def test_projection_marts(inputs):
    integrated = integrate(*inputs, LAYOUT, by_network=True)
    assert len(city_mart(integrated, LAYOUT).columns) == 9
    assert len(dashboard_mart(integrated, LAYOUT).columns) == 15
    comparison = comparison_mart(integrated, LAYOUT)
    assert len(comparison.columns) == 12
    row = comparison.filter((F.col("id_municipio") == "0000001") & (F.col("meta_uf") == 60.0))
    assert {r.gap_municipio_vs_brasil for r in row.collect()} == {20.0, -2.0}
    assert set(MARTS) == {
        "gold_indicador_municipio", "gold_indicador_uf", "gold_comparacao_metas",
        "gold_evolucao_temporal", "gold_dashboard",
    }
