"""Analytic marts on the integrated table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.columns import gap, reached
from gaugeworks.operators.dedup import keep_one
from gaugeworks.operators.means import grouped_mean
from gaugeworks.sources.shared import materialise
from gaugeworks.spec import IndicatorLayout


def city_mart(df: DataFrame, layout: IndicatorLayout) -> DataFrame:
    """Result and own target per city, year and network."""
    return df.select(
        layout.year,
        layout.city,
        layout.city_name,
        layout.state,
        layout.state_name,
        layout.network,
        F.col(layout.result).alias("indicador_alfabetizacao_pct"),
        layout.target,
        layout.reached,
    )


def state_mart(df: DataFrame, layout: IndicatorLayout) -> DataFrame:
    """State figures against the state target, one row per year and state.

    The figures are those published for the state, not an average of its cities.
    ``distinct`` folds the city rows in a hash aggregate first, so ranking only
    sees the few different figures of a state and year.
    """
    figures = df.select(
        layout.year,
        layout.state,
        layout.state_name,
        F.col(layout.state_result).alias("indicador_alfabetizacao_pct"),
        F.col(layout.state_target).alias(layout.target),
    ).distinct()
    result, target = F.col("indicador_alfabetizacao_pct"), F.col(layout.target)
    return keep_one(figures, [layout.year, layout.state], null_keys="collapse").withColumns(
        {
            "gap_meta_pct": gap(result, target),
            "atingiu_meta_uf": reached(result, target),
        }
    )


def comparison_mart(df: DataFrame, layout: IndicatorLayout) -> DataFrame:
    """City, state and nation side by side."""
    return df.select(
        layout.year,
        layout.city,
        layout.city_name,
        layout.state,
        F.col(layout.result).alias("resultado_municipio"),
        F.col(layout.target).alias("meta_municipio"),
        layout.reached,
        F.col(layout.state_result).alias("resultado_uf"),
        F.col(layout.state_target).alias("meta_uf"),
        F.col(layout.nation_result).alias("resultado_brasil"),
        F.col(layout.nation_target).alias("meta_brasil"),
        gap(F.col(layout.result), F.col(layout.nation_result)).alias("gap_municipio_vs_brasil"),
    )


def trend_mart(df: DataFrame, layout: IndicatorLayout) -> DataFrame:
    """Yearly mean of the city results next to the national figures.

    ``qtd_municipios_avaliados`` counts rows, as it always did; the number of
    different cities is ``qtd_municipios_distintos``.
    """
    nation = df.select(
        layout.year,
        F.col(layout.nation_result).alias("resultado_brasil"),
        F.col(layout.nation_target).alias("meta_brasil"),
    )
    return _trend(df.withColumn("_weight", F.lit(1)), nation, layout)


def trend_from_tables(
    city_targets: DataFrame,
    cities: DataFrame,
    state_targets: DataFrame,
    national_targets: DataFrame,
    layout: IndicatorLayout,
    by_network: bool = False,
) -> DataFrame:
    """The same mart as ``trend_mart`` of the integrated table, without integrating.

    Integration repeats a city row for every state row and every national row of its
    keys. Here the keys' numbers of rows are counted first, and a city row weighs their
    product. So no repeated row is made, and what is joined has one row per key.
    """
    network = [layout.network] if by_network else []
    state_keys, nation_keys = [layout.state, layout.year, *network], [layout.year, *network]
    once = lambda c: F.greatest(F.coalesce(c, F.lit(1)), F.lit(1))
    rows = (
        city_targets.select(layout.city, layout.year, *network, layout.result)
        .join(cities.select(layout.city, layout.state), layout.city, "left")
        .join(state_targets.groupBy(*state_keys).agg(F.count(F.lit(1)).alias("_states")), state_keys, "left")
        .join(national_targets.groupBy(*nation_keys).agg(F.count(F.lit(1)).alias("_nations")), nation_keys, "left")
        .withColumn("_weight", once(F.col("_states")) * once(F.col("_nations")))
    )
    nation = (
        city_targets.select(*nation_keys)
        .distinct()
        .join(national_targets.select(*nation_keys, layout.result, layout.target), nation_keys, "left")
        .select(
            layout.year,
            F.col(layout.result).alias("resultado_brasil"),
            F.col(layout.target).alias("meta_brasil"),
        )
    )
    return _trend(rows, nation, layout)


def _trend(rows: DataFrame, nation: DataFrame, layout: IndicatorLayout) -> DataFrame:
    """City rows are folded by year, city and result first, which both results start from."""
    folded = rows.groupBy(layout.year, layout.city, layout.result).agg(F.sum("_weight").alias("_weight"))
    folded = materialise(folded, "trend")
    mean = grouped_mean(folded, [layout.year], layout.result, "_mean", "_values", "_weight")
    counts = folded.groupBy(layout.year).agg(
        F.coalesce(F.sum(F.when(F.col(layout.city).isNotNull(), F.col("_weight"))), F.lit(0)).alias("qtd_municipios_avaliados"),
        F.count_distinct(layout.city).alias("qtd_municipios_distintos"),
    )
    year = F.col("_year").eqNullSafe(F.col(layout.year))
    cities = counts.join(mean.withColumnRenamed(layout.year, "_year"), year).select(
        layout.year,
        F.round("_mean", 2).alias("media_indicador_municipios"),
        "qtd_municipios_avaliados",
        "qtd_municipios_distintos",
    )
    one_per_year = keep_one(nation.distinct(), [layout.year], null_keys="collapse")
    return cities.join(one_per_year, layout.year, "left").orderBy(layout.year)


def dashboard_mart(df: DataFrame, layout: IndicatorLayout) -> DataFrame:
    """Wide table for reporting tools."""
    return df.select(
        layout.year,
        layout.city,
        layout.city_name,
        layout.state,
        layout.state_name,
        layout.network,
        F.col(layout.result).alias("indicador_municipio_pct"),
        layout.target,
        layout.reached,
        F.col(layout.state_result).alias("indicador_uf_pct"),
        F.col(layout.state_target).alias("meta_uf"),
        F.col(layout.nation_result).alias("indicador_brasil_pct"),
        F.col(layout.nation_target).alias("meta_brasil"),
        layout.participation,
        layout.level,
    )


# The published names of the marts.
MARTS: dict[str, Callable[[DataFrame, IndicatorLayout], DataFrame]] = {
    "gold_indicador_municipio": city_mart,
    "gold_indicador_uf": state_mart,
    "gold_comparacao_metas": comparison_mart,
    "gold_evolucao_temporal": trend_mart,
    "gold_dashboard": dashboard_mart,
}
# Marts with one row per integrated row.
ROWWISE = frozenset({"gold_indicador_municipio", "gold_comparacao_metas", "gold_dashboard"})
