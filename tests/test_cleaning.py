"""Names, text, keys, numbers, missing values and own-year targets."""

import random
import re

import json
from fractions import Fraction

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.domains.education import EDUCATION
from gaugeworks.functions.columns import (
    clean_text,
    exact_mean,
    gap,
    lenient_double,
    padded_key,
    reached,
)
from gaugeworks.operators.cleaning import (
    flag_missing,
    pad_key_columns,
    require_keys,
    resolve_wide_target,
    upper_code_columns,
)
from gaugeworks.operators.naming import normalise_names, plain_name, rename_columns
from gaugeworks.operators.standardise import (
    rejected_rows,
    standardise_entity,
    standardise_values,
)
from gaugeworks.spec import EntitySpec, WideTarget


def values(df, column):
    return [row[column] for row in df.collect()]


def apply(spark, data, dtype, build):
    schema = T.StructType([T.StructField("x", dtype)])
    df = spark.createDataFrame([(v,) for v in data], schema)
    return values(df.select(build(F.col("x")).alias("y")), "y")


@pytest.mark.parametrize(
    "name, plain",
    [
        (" Código Município ", "codigo_municipio"),
        ("Nome-Cidade", "nome_cidade"),
        ("camelCase", "camelcase"),
        ("already_plain", "already_plain"),
    ],
)
def test_plain_name(name, plain):
    assert plain_name(name) == plain


def test_names_that_collide_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], ["Ano", "ano "])
    with pytest.raises(ValueError, match="collide"):
        normalise_names(df)
    with pytest.raises(ValueError, match="collide"):
        rename_columns(spark.createDataFrame([(1, 2)], ["a", "b"]), (("a", "b"),))


def test_rename_skips_absent_and_identical(spark):
    df = spark.createDataFrame([(1, 2)], ["a", "b"])
    renamed = rename_columns(df, (("a", "x"), ("none", "y"), ("b", "b")))
    assert renamed.columns == ["x", "b"]


def test_text_is_collapsed_before_it_is_trimmed(spark):
    got = apply(spark, ["\t São   Paulo \n", None], T.StringType(), clean_text)
    assert got == ["São Paulo", None]


def test_code_is_upper_case(spark):
    df = spark.createDataFrame([("  ba",), ("Mg ",), ("   ",), ("",), (None,)], ["c"])
    assert values(upper_code_columns(df, ["c", "absent"]), "c") == ["BA", "MG", None, None, None]


def test_key_is_padded(spark):
    df = spark.createDataFrame([(41, 5), (98765, 0), (None, 12)], "a int, b int")
    padded = pad_key_columns(df, (("a", 5), ("b", 3), ("absent", 2)))
    assert values(padded, "a") == ["00041", "98765", None]
    assert values(padded, "b") == ["005", "000", "012"]


def test_key_that_does_not_fit_is_null(spark):
    def key(dtype):
        return lambda c: padded_key(c, dtype, 7)

    text = apply(spark, ["12345678", "", " 42 ", None], T.StringType(), key(T.StringType()))
    assert text == [None, None, "0000042", None]
    real = apply(
        spark, [355030.0, 1.5, float("nan"), float("inf")], T.DoubleType(), key(T.DoubleType())
    )
    assert real == ["0355030", None, None, None]


def test_numbers_are_parsed_leniently(spark):
    data = ["12,5", "12.5", " 7 ", "1.234,5", "n/d", "", "NaN", None]
    got = apply(spark, data, T.StringType(), lambda c: lenient_double(c, T.StringType()))
    assert got == [12.5, 12.5, 7.0, None, None, None, None, None]
    real = apply(
        spark,
        [1.5, float("nan"), None],
        T.DoubleType(),
        lambda c: lenient_double(c, T.DoubleType()),
    )
    assert real == [1.5, None, None]
    assert apply(spark, [3], T.IntegerType(), lambda c: lenient_double(c, T.IntegerType())) == [3.0]


def test_mandatory_keys_and_missing_flags(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", None), (None, 2.0)], "k string, v double")
    got = flag_missing(require_keys(df, ["k", "absent"]), ["v", "absent"], "_ausente")
    assert sorted(tuple(r) for r in got.collect()) == [("a", 1.0, False), ("b", None, True)]


def test_own_year_target(spark):
    wide = WideTarget("meta", "ano", ((2024, "m24"), (2025, "m25"), (2026, "m26")))
    df = spark.createDataFrame(
        [("2024", 1.0, 2.0), ("2025", 1.0, 2.0), ("2023", 1.0, 2.0), ("x", 1.0, 2.0)],
        "ano string, m24 double, m25 double",
    )
    resolved = resolve_wide_target(df, wide)
    assert values(resolved, "meta") == [1.0, 2.0, None, None]
    assert resolved.columns == ["ano", "m24", "m25", "meta"]
    no_targets = df.select("ano")
    assert resolve_wide_target(no_targets, wide).columns == ["ano"]


def test_comparison_is_three_valued(spark):
    df = spark.createDataFrame([(2.0, 1.0), (1.0, 2.0), (None, 1.0), (1.0, None)], "a double, b double")
    got = df.select(reached(F.col("a"), F.col("b")).alias("r"), gap(F.col("a"), F.col("b")).alias("g"))
    assert [tuple(r) for r in got.collect()] == [
        (True, 1.0), (False, -1.0), (None, None), (None, None),
    ]


def test_mean_does_not_depend_on_order_and_survives_huge_values(spark):
    data = [0.1, 0.2, 0.3, 1e9, -1e9] * 50
    for parts in (1, 7):
        df = spark.createDataFrame([(v,) for v in data], "x double").repartition(parts)
        assert df.agg(exact_mean(F.col("x"))).first()[0] == pytest.approx(0.12, abs=0)
    empty = spark.createDataFrame([], "x double")
    assert empty.agg(exact_mean(F.col("x"))).first()[0] is None


@pytest.mark.parametrize(
    "data",
    [[4e-7, 4e-7], [1e16, 0.25, -1e16, 4e-7], [-0.1, 0.2, -0.3, 1e9 + 0.1], [2.0**53 + 2, 1.5], [7.25]],
)
def test_mean_keeps_all_digits_in_any_partitioning(spark, data):
    exact = float(sum(map(Fraction, data)) / len(data))
    for parts in (1, 3):
        df = spark.createDataFrame([(v,) for v in data] + [(None,)], "x double").repartition(parts)
        assert df.agg(exact_mean(F.col("x"))).first()[0] == pytest.approx(exact, rel=1e-12)
    forward = spark.createDataFrame([(v,) for v in data * 50], "x double")
    backward = spark.createDataFrame([(v,) for v in data[::-1] * 50], "x double").repartition(4)
    means = {df.agg(exact_mean(F.col("x"))).first()[0] for df in (forward, backward)}
    assert len(means) == 1


def test_rejected_and_kept_rows_make_up_the_source(spark):
    spec = EntitySpec(
        name="t", mandatory=("k", "c"), padded_keys=(("k", 4),), code_columns=("c",), text_columns=("c",)
    )
    data = [("12", "a", 1), ("12345", "a", 2), (None, "b", 3), ("", "b", 4), ("7", "  ", 5), ("8", None, 6), ("9", "x", 7)]
    source = spark.createDataFrame(data, "K string, C string, v int")
    kept = standardise_values(source, spec).collect()
    lost = rejected_rows(source, spec).collect()
    assert sorted(r.v for r in kept) == [1, 7]
    got = sorted((json.loads(r.linha)["v"], r.coluna, r.motivo, r.valor) for r in lost if r.valor)
    assert got == [(2, "k", "chave_invalida", "12345"), (5, "c", "chave_ausente", "  ")]
    assert len(kept) + len(lost) == len(data)
    assert {r.motivo for r in lost if not (r.valor or "").strip()} == {"chave_ausente"}


def test_entity_drops_null_keys_and_copies(spark):
    df = spark.createDataFrame(
        [("ba ", 1), (" BA", 1), ("mg", 2), ("mg", 2), ("mg", 3), (None, 4), ("  ", 4)],
        "sigla_uf string, n int",
    )
    clean = standardise_entity(df, EDUCATION.specs["uf"])
    assert sorted((r.sigla_uf, r.n) for r in clean.collect()) == [("BA", 1), ("MG", 2), ("MG", 3)]
    assert clean.columns[-1] == "_silver_processed_at"


def city_targets(spark):
    rows = [
        (3550308, "2024", "1", "80,5", 70.0, None, 90.0),
        (3550308, "2024", "1", "80,5", 70.0, None, 90.0),
        (355030, "2025", None, "n/d", 70.0, 75.0, 91.0),
        (355030, "2025", None, "n/d", 70.0, 75.0, 91.0),
        (355030, "2025", None, "60", 70.0, 75.0, 91.0),
        (123456789, "2025", "1", "60", 70.0, 75.0, 91.0),
        (None, "2025", "1", "60", 70.0, 75.0, 91.0),
    ]
    names = (
        "`id-municipio` bigint, Ano string, rede string, taxa_alfabetizacao string, "
        "meta_alfabetizacao_2024 double, meta_alfabetizacao_2025 double, "
        "percentual_participacao double"
    )
    return spark.createDataFrame(rows, names)


def test_standardise_in_full(spark):
    clean = standardise_entity(
        city_targets(spark), EDUCATION.specs["meta_alfabetizacao_municipio"], audit=False
    )
    got = {
        (r.id_municipio, r.ano, r.rede, r.resultado_alfabetizacao, r.meta_alfabetizacao)
        for r in clean.collect()
    }
    # The over-long and the missing key are gone, a null network keeps both its rows.
    assert got == {
        ("3550308", "2024", "1", 80.5, 70.0),
        ("0355030", "2025", None, None, 75.0),
        ("0355030", "2025", None, 60.0, 75.0),
    }
    assert clean.count() == 3
    flags = [c for c in clean.columns if c.endswith("_ausente")]
    assert len(flags) == 4 and clean.columns[-4:] == flags


def test_standardise_twice_changes_nothing(spark):
    spec = EDUCATION.specs["meta_alfabetizacao_municipio"]
    once = standardise_entity(city_targets(spark), spec, audit=False)
    twice = standardise_entity(once, spec, audit=False)
    assert twice.columns == once.columns
    assert sorted(map(str, twice.collect())) == sorted(map(str, once.collect()))


def test_columns_outside_the_spec_pass_through(spark):
    df = spark.createDataFrame([(1, " x ")], ["other", "More Text"])
    clean = standardise_entity(df, EntitySpec(name="any"), audit=False)
    assert clean.columns == ["other", "more_text"]
    assert clean.collect()[0].more_text == " x "


def test_random_text_against_plain_python(spark):
    rng = random.Random(11)
    texts = [
        "".join(rng.choice(" \t\n0123456789,.-xé") for _ in range(rng.randrange(10)))
        for _ in range(2000)
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(5)
    got = df.select(
        "t",
        clean_text(F.col("t")).alias("clean"),
        padded_key(F.col("t"), T.StringType(), 7).alias("key"),
        lenient_double(F.col("t"), T.StringType()).alias("number"),
    ).collect()
    assert len(got) == 2000

    def number(text):
        try:
            return float(text.replace(",", ".").strip())
        except ValueError:
            return None

    for row in got:
        assert row.clean == re.sub(r"\s+", " ", row.t).strip(" ")
        inner = row.t.strip(" ")
        assert row.key == (inner.rjust(7, "0") if 1 <= len(inner) <= 7 else None)
        assert row.number == number(row.t)
