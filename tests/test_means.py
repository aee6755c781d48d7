"""The mean for every double, against exact sums."""

import math
import struct

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gaugeworks.domains.education import EDUCATION
from gaugeworks.operators.integrate import integrate
from gaugeworks.operators.means import grouped_mean
from gaugeworks.plans.marts import trend_from_tables, trend_mart
from plan_text import executed_plan

LAYOUT = EDUCATION.layout


def means(spark, groups, parts=3, weight=None):
    rows = [(k, v, n) for k, vs in groups.items() for v, n in vs]
    df = spark.createDataFrame(rows, "k int, v double, n long").repartition(parts)
    found = grouped_mean(df, ["k"], "v", weight=weight)
    return {r.k: (r["mean"], r["count"]) for r in found.collect()}


def expected(values):
    values = [v for v in values if v is not None]
    if not values:
        return None, 0
    if not all(map(math.isfinite, values)):
        return sum(values), len(values)
    try:
        return math.fsum(values) / len(values), len(values)
    except OverflowError:
        return math.fsum(v / len(values) for v in values), len(values)


def same(a, b):
    return (a == b or (a != a and b != b)) if a is not None and b is not None else a is b


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.floats(allow_subnormal=False) | st.none(), min_size=1, max_size=12), min_size=8, max_size=20))
def test_equals_the_exact_sum(spark, groups):
    keyed = dict(enumerate(groups))
    found = means(spark, {k: [(v, 1) for v in vs] for k, vs in keyed.items()})
    for k, vs in keyed.items():
        mean, count = expected(vs)
        assert found[k][1] == count
        if mean is not None and math.isfinite(mean) and mean != 0 and abs(math.log2(abs(mean))) > 1000:
            assert found[k][0] == pytest.approx(mean, rel=1e-15)
        else:
            assert same(found[k][0], mean), (vs, found[k][0], mean)


def test_values_that_other_sums_lose(spark):
    groups = {
        0: [1e30, 2.0], 1: [math.inf, 2.0], 2: [3e28, 1.0, 1.0], 3: [1e308, 1e308, -1e308, 1.0], 4: [1.7e308, 1.7e308],
        5: [math.inf, -math.inf], 6: [math.nan, 1.0], 7: [1e-300, 3e-300], 8: [-0.5, 0.5, 1e-17], 9: [None, None],
        10: [5e-324, 5e-324], 11: [1e16, 1.0, -1e16], 12: [0.0, -0.0], 13: [-math.inf, 4.0], 14: [-7.25],
    }
    found = means(spark, {k: [(v, 1) for v in vs] for k, vs in groups.items()})
    for k, vs in groups.items():
        mean, count = expected(vs)
        if k == 4:
            mean = 1.7e308
        assert found[k][1] == count and same(found[k][0], mean), (vs, found[k])


def test_neighbours_of_powers_of_two(spark):
    values = []
    for power in range(-1070, 1024, 32):
        for step in (-1, 0, 1):
            bits = struct.unpack("<q", struct.pack("<d", 2.0**power))[0] + step
            values.append(struct.unpack("<d", struct.pack("<q", bits))[0])
    found = means(spark, {i: [(v, 1)] for i, v in enumerate(values)})
    assert [found[i][0] for i in range(len(values))] == values


def test_weights_and_no_keys(spark):
    found = means(spark, {1: [(0.1, 3), (None, 5), (7.0, 2)], 2: [(1.0, 10**12)]}, weight="n")
    assert found == {1: (math.fsum([0.1] * 3 + [7.0] * 2) / 5, 5), 2: (1.0, 10**12)}
    empty = spark.createDataFrame([], "v double")
    assert [tuple(r) for r in grouped_mean(empty, [], "v").collect()] == [(None, 0)]


def inputs(spark):
    figures = [
        ("1", 2024, "M", 10.0, 1.0), ("1", 2024, "E", 1e30, 1.0), ("2", 2024, "M", None, 1.0), ("3", 2025, "M", -4.0, 1.0),
        (None, 2024, "M", 5.0, 1.0), ("9", None, "M", 2.0, 1.0), ("2", 2026, None, 3.0, 1.0),
    ]
    result, target = LAYOUT.result, LAYOUT.target
    city = spark.createDataFrame(figures, f"{LAYOUT.city} string, {LAYOUT.year} int, {LAYOUT.network} string, {result} double, {target} double")
    cities = spark.createDataFrame([("1", "a", "SP"), ("2", "b", "RJ"), ("3", "c", None)], f"{LAYOUT.city} string, {LAYOUT.city_name} string, {LAYOUT.state} string")
    states = spark.createDataFrame([("SP", "x")], f"{LAYOUT.state} string, {LAYOUT.state_name} string")
    state = spark.createDataFrame(
        [("SP", 2024, "M", 1.0, 2.0), ("SP", 2024, "E", 1.5, 2.0), ("SP", 2024, "E", 1.5, 2.5), ("RJ", 2025, "M", 1.0, 2.0)],
        f"{LAYOUT.state} string, {LAYOUT.year} int, {LAYOUT.network} string, {result} double, {target} double",
    )
    nation = spark.createDataFrame(
        [(2024, "M", 3.0, 4.0), (2024, "E", 2.0, 9.0), (2025, "E", 1.0, 1.0), (2026, "M", 7.0, 7.0)],
        f"{LAYOUT.year} int, {LAYOUT.network} string, {result} double, {target} double",
    )
    return city, cities, states, state, nation


@pytest.mark.parametrize("by_network", [False, True])
def test_trend_without_the_fan_out(spark, by_network):
    city, cities, states, state, nation = inputs(spark)
    integrated = integrate(city, cities, states, state, nation, LAYOUT, by_network)
    plain = sorted((tuple(r) for r in trend_mart(integrated, LAYOUT).collect()), key=str)
    factorised = trend_from_tables(city, cities, state, nation, LAYOUT, by_network)
    assert sorted((tuple(r) for r in factorised.collect()), key=str) == plain
    assert "Generate" not in executed_plan(factorised).split("trend")[0]
