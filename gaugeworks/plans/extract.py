"""Source tables with their codes decoded and their names attached."""

from __future__ import annotations

from pyspark.sql import DataFrame

from gaugeworks.operators.lookup import attach_directory, decode_codes

# Output columns, in the published order.
_LEVELS = [f"proporcao_aluno_nivel_{i}" for i in range(9)]
_SCORES = ["serie", "rede", "taxa_alfabetizacao", "media_portugues", *_LEVELS]
STATE_COLUMNS = ["ano", "sigla_uf", "sigla_uf_nome", *_SCORES]
CITY_COLUMNS = ["ano", "id_municipio", "id_municipio_nome", "sigla_uf", *_SCORES]
STUDENT_COLUMNS = [
    "ano",
    "id_municipio",
    "id_municipio_nome",
    "sigla_uf",
    "id_escola",
    "id_aluno",
    "caderno",
    "serie",
    "rede",
    "presenca",
    "preenchimento_caderno",
    "alfabetizado",
    "proficiencia",
    "peso_aluno",
]
STUDENT_CODES = ["serie", "rede", "presenca", "preenchimento_caderno", "alfabetizado"]
INGESTION_TIME = "_ingested_at"


def attach_state(df: DataFrame, state_directory: DataFrame) -> DataFrame:
    """Add the state name (directory: sigla, nome)."""
    return attach_directory(df, state_directory, "sigla_uf", "sigla", {"nome": "sigla_uf_nome"})


def attach_city(df: DataFrame, city_directory: DataFrame) -> DataFrame:
    """Add city name and state code (directory: id_municipio, nome, sigla_uf)."""
    columns = {"nome": "id_municipio_nome", "sigla_uf": "sigla_uf"}
    return attach_directory(df, city_directory, "id_municipio", "id_municipio", columns)


def extract_state(
    scores: DataFrame, state_directory: DataFrame, dictionary: DataFrame
) -> DataFrame:
    named = attach_state(scores, state_directory)
    return decode_codes(named, dictionary, "uf", ["serie", "rede"]).select(*STATE_COLUMNS)


def extract_city(scores: DataFrame, city_directory: DataFrame, dictionary: DataFrame) -> DataFrame:
    return decode_city(attach_city(scores, city_directory), dictionary)


def decode_city(named: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The same for scores that have the name and the state of their city."""
    return decode_codes(named, dictionary, "municipio", ["serie", "rede"]).select(*CITY_COLUMNS)


def extract_students(
    students: DataFrame, city_directory: DataFrame, dictionary: DataFrame
) -> DataFrame:
    """Students with decoded answers; an ingestion time is kept if there is one."""
    return decode_students(attach_city(students, city_directory), dictionary)


def decode_students(named: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The same for students that have the name and the state of their city."""
    extra = [INGESTION_TIME] if INGESTION_TIME in named.columns else []
    return decode_codes(named, dictionary, "alunos", STUDENT_CODES).select(
        *STUDENT_COLUMNS, *extra
    )
