"""Literacy indicators: states, cities, targets and assessed students."""

from __future__ import annotations

from pyspark.sql import types as T

from gaugeworks.plans.lakehouse import Domain
from gaugeworks.spec import (
    DomainRule,
    EntitySpec,
    ForeignKey,
    IndicatorLayout,
    RangeRule,
    WideTarget,
)

# ---------------------------------------------------------------------------
# Codes, ranges, years and published column names.
# ---------------------------------------------------------------------------
STATE_CODES = (
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA",
    "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
)
PERCENT_RANGE = (0.0, 100.0)
YEAR_RANGE = (2019, 2035)
TARGET_YEARS = tuple(range(2024, 2031))
CITY_KEY_WIDTH = 7

STATE_NAME = ("sigla_uf_nome", "nome_uf")
CITY_NAME = ("id_municipio_nome", "nome_municipio")
RESULT = ("taxa_alfabetizacao", "resultado_alfabetizacao")
SCORE = ("proficiencia", "proficiencia_saeb")

RULE_STATE_CODE = "uf_valida"
RULE_YEAR = "consistencia_ano"
RULE_PERCENT = "consistencia_percentual"

LAYOUT = IndicatorLayout(
    year="ano",
    network="rede",
    city="id_municipio",
    city_name="nome_municipio",
    state="sigla_uf",
    state_name="nome_uf",
    result="resultado_alfabetizacao",
    target="meta_alfabetizacao",
    participation="percentual_participacao",
    level="nivel_alfabetizacao",
    reached="atingiu_meta_municipio",
    state_suffix="_uf",
    nation_suffix="_brasil",
)

_TEXT, _WHOLE, _REAL = T.StringType(), T.IntegerType(), T.DoubleType()
STUDENT_EVENT = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in (
            ("ano", _WHOLE),
            ("id_municipio", _TEXT),
            ("id_municipio_nome", _TEXT),
            ("sigla_uf", _TEXT),
            ("id_escola", _TEXT),
            ("id_aluno", _TEXT),
            ("caderno", _WHOLE),
            ("serie", _TEXT),
            ("rede", _TEXT),
            ("presenca", _TEXT),
            ("preenchimento_caderno", _TEXT),
            ("alfabetizado", _TEXT),
            ("proficiencia", _REAL),
            ("peso_aluno", _REAL),
        )
    ]
)


def build_domain(
    target_years: tuple[int, ...] = TARGET_YEARS, year_range: tuple[int, int] = YEAR_RANGE
) -> Domain:
    """The six entities for the given target years and valid years.

    State and city scores keep their full grain (year, grade, network); the
    dimensions are derived from them, so no score is lost.
    """
    wide = WideTarget("meta_alfabetizacao", "ano", tuple((y, wide_name(y)) for y in target_years))
    numbers = (
        "resultado_alfabetizacao",
        "percentual_participacao",
        *[name for _, name in wide.columns],
    )
    state_code = DomainRule(RULE_STATE_CODE, "sigla_uf", STATE_CODES)
    year = RangeRule(RULE_YEAR, "ano", *year_range)
    percents = tuple(
        RangeRule(RULE_PERCENT, c, *PERCENT_RANGE)
        for c in ("meta_alfabetizacao", "resultado_alfabetizacao")
    )
    city_key = (("id_municipio", CITY_KEY_WIDTH),)
    to_state = ForeignKey("sigla_uf", "uf")
    to_city = ForeignKey("id_municipio", "municipio")

    specs = (
        EntitySpec(
            name="uf",
            renames=(STATE_NAME,),
            mandatory=("sigla_uf",),
            text_columns=("sigla_uf", "nome_uf"),
            code_columns=("sigla_uf",),
            dedup_keys=("sigla_uf", "ano", "serie", "rede"),
            domains=(state_code,),
            ranges=(year,),
        ),
        EntitySpec(
            name="municipio",
            renames=(CITY_NAME,),
            mandatory=("id_municipio",),
            text_columns=("nome_municipio", "sigla_uf"),
            code_columns=("sigla_uf",),
            padded_keys=city_key,
            dedup_keys=("id_municipio", "ano", "serie", "rede"),
            domains=(state_code,),
            ranges=(year,),
            foreign_keys=(to_state,),
        ),
        EntitySpec(
            name="meta_alfabetizacao_brasil",
            renames=(RESULT,),
            mandatory=("ano",),
            numeric_columns=numbers,
            dedup_keys=("ano", "rede"),
            wide_target=wide,
            ranges=(year, *percents),
            partition_by=("ano",),
        ),
        EntitySpec(
            name="meta_alfabetizacao_uf",
            renames=(STATE_NAME, RESULT),
            mandatory=("sigla_uf", "ano"),
            text_columns=("sigla_uf",),
            code_columns=("sigla_uf",),
            numeric_columns=numbers,
            dedup_keys=("sigla_uf", "ano", "rede"),
            wide_target=wide,
            domains=(state_code,),
            ranges=(year, *percents),
            foreign_keys=(to_state,),
            partition_by=("ano",),
        ),
        EntitySpec(
            name="meta_alfabetizacao_municipio",
            renames=(CITY_NAME, RESULT),
            mandatory=("id_municipio", "ano"),
            code_columns=("sigla_uf",),
            padded_keys=city_key,
            numeric_columns=numbers,
            dedup_keys=("id_municipio", "ano", "rede"),
            wide_target=wide,
            domains=(state_code,),
            ranges=(year, *percents),
            foreign_keys=(to_city,),
            partition_by=("ano",),
        ),
        EntitySpec(
            name="dados_alunos",
            renames=(CITY_NAME, SCORE),
            mandatory=("id_municipio", "ano"),
            code_columns=("sigla_uf",),
            padded_keys=city_key,
            numeric_columns=("proficiencia_saeb", "peso_aluno"),
            dedup_keys=("id_aluno", "ano"),
            domains=(state_code,),
            ranges=(year,),
            foreign_keys=(to_city,),
            partition_by=("ano", "sigla_uf"),
        ),
    )
    return Domain(
        specs={spec.name: spec for spec in specs},
        layout=LAYOUT,
        states="uf",
        cities="municipio",
        national_targets="meta_alfabetizacao_brasil",
        state_targets="meta_alfabetizacao_uf",
        city_targets="meta_alfabetizacao_municipio",
        students="dados_alunos",
        integrated="indicador_alfabetizacao_integrado",
    )


def wide_name(year: int) -> str:
    return f"meta_alfabetizacao_{year}"


EDUCATION = build_domain()
