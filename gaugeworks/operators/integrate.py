"""Joining city results with their state and national figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions.columns import reached
from gaugeworks.operators.dedup import keep_one
from gaugeworks.operators.quality import (
    duplicate_check,
    foreign_key_check,
    measure,
)
from gaugeworks.spec import ForeignKey, IndicatorLayout


def state_dimension(states: DataFrame, layout: IndicatorLayout) -> DataFrame:
    """One (code, name) row per state."""
    names = states.select(layout.state, layout.state_name).distinct()
    return keep_one(names, [layout.state], null_keys="collapse")


def city_dimension(cities: DataFrame, layout: IndicatorLayout) -> DataFrame:
    """One (id, name, state) row per city; the state column is required."""
    columns = [layout.city, layout.city_name, layout.state]
    lacking = [c for c in columns if c not in cities.columns]
    if lacking:
        raise ValueError(f"city table lacks {lacking}")
    return keep_one(cities.select(*columns).distinct(), [layout.city], null_keys="collapse")


def _figures(
    targets: DataFrame, keys: list[str], layout: IndicatorLayout, suffix: str
) -> DataFrame:
    measures: list[Column] = [
        F.col(c).alias(c + suffix) for c in (layout.target, layout.result)
    ]
    return targets.select(*keys, *measures)


def integrate(
    city_targets: DataFrame,
    cities: DataFrame,
    states: DataFrame,
    state_targets: DataFrame,
    national_targets: DataFrame,
    layout: IndicatorLayout,
    by_network: bool = False,
    audit: bool = True,
    rebalance: bool = False,
) -> DataFrame:
    """City results with names, state figures and national figures.

    State and national figures exist per school network. By default they are
    joined on place and year alone, so a city row repeats for every network on
    the other side; ``by_network`` joins on the network too and keeps one row per
    city row, provided all three levels use the same network codes.

    City names and states come from the dimension, not from the target table.

    All tables but the first should be stored ones. Then their size is known, so
    the small ones are broadcast, and a join that does shuffle does so right below
    the join, where adaptive execution can split a hot city or state. With ``rebalance`` the
    rows are dealt by year for a write before state and national figures repeat them.
    """
    network = [layout.network] if by_network else []
    state_keys = [layout.state, layout.year, *network]
    nation_keys = [layout.year, *network]
    located = city_targets.drop(layout.city_name, layout.state, layout.audit_column).join(
        cities.select(layout.city, layout.city_name, layout.state), layout.city, "left"
    )
    result = (
        (located.hint("rebalance", layout.year) if rebalance else located)
        .join(states.select(layout.state, layout.state_name), layout.state, "left")
        .join(
            _figures(state_targets, state_keys, layout, layout.state_suffix), state_keys, "left"
        )
        .join(
            _figures(national_targets, nation_keys, layout, layout.nation_suffix),
            nation_keys,
            "left",
        )
        .withColumn(layout.reached, reached(F.col(layout.result), F.col(layout.target)))
    )
    # Same column order for both variants: keys first, as a USING join gives them.
    head = [layout.year, layout.state, layout.city, layout.network]
    result = result.select(*head, *[c for c in result.columns if c not in head])
    return result.withColumn(layout.audit_column, F.current_timestamp()) if audit else result


def integration_report(
    integrated: DataFrame,
    cities: DataFrame,
    state_targets: DataFrame,
    national_targets: DataFrame,
    layout: IndicatorLayout,
    entity: str,
) -> DataFrame:
    """Cities unknown to the dimension, and join keys that multiply rows."""
    orphans = foreign_key_check(integrated, entity, cities, ForeignKey(layout.city, "cities"))
    state_keys = duplicate_check(state_targets, [layout.state, layout.year])
    nation_keys = duplicate_check(national_targets, [layout.year])
    return orphans.unionByName(
        measure(state_targets, f"{entity}{layout.state_suffix}", [state_keys])
    ).unionByName(measure(national_targets, f"{entity}{layout.nation_suffix}", [nation_keys]))
