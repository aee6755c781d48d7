"""Every registered query against its SQL, and properties of all plans."""

import re
from pathlib import Path

import pytest

import __spark_entry__ as registry
from oracle_check import connect, differences
from plan_text import executed_plan

ROOT = Path(__file__).resolve().parents[1]
QUERIES = {k: v for k, v in registry.queries().items() if k not in registry.LLM_QUERIES}
SQL = {k: v for k, v in registry.oracle_sql().items() if k not in registry.LLM_SQL}


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_sql(spark, duck, small, key):
    assert differences(spark, duck, QUERIES[key], SQL[key], small) == []


@pytest.mark.parametrize(
    "key",
    [
        "student_fact",
        "code_decode",
        "extract_state",
        "extract_city",
        "extract_students",
        "targets_city",
        "integrate_fanout",
        "integrate_by_network",
        "quality_fk",
        "mart_city",
        "mart_state",
        "mart_comparison",
        "mart_dashboard",
    ],
)
def test_plans_have_no_python_and_no_cross_join(spark, small, key):
    plan = executed_plan(QUERIES[key](spark, small))
    for word in ("Python", "Arrow", "CartesianProduct", "NestedLoop"):
        assert word not in plan


def test_scans_read_only_what_is_needed(spark, small):
    plan = executed_plan(QUERIES["number_parse"](spark, small))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert "o_totalprice" not in schema and "o_orderpriority" not in schema


def test_null_keys_are_dropped_in_the_scan(spark, small):
    plan = executed_plan(QUERIES["targets_national"](spark, small))
    assert "IsNotNull(o_orderdate)" in plan


def test_library_stays_inside_spark():
    for path in (ROOT / "gaugeworks").rglob("*.py"):
        if "llm" in path.parts:
            continue
        text = path.read_text()
        for word in ("localCheckpoint", "toPandas", "pandas_udf", ".rdd", "crossJoin"):
            assert word not in text, f"{word} in {path}"


def test_entry(spark):
    assert registry.entry(spark).limit(1).count() == 1
