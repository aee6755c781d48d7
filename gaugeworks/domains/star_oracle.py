"""The registered queries as SQL for DuckDB, to compare results with.

Each query is a final SELECT over named sub-queries. ``_PARTS`` holds those
sub-queries in order; a query gets the ones it needs, directly or not.
"""

from __future__ import annotations

import re

from gaugeworks.domains.education import STATE_CODES
from gaugeworks.domains.star_schema import (
    DICTIONARY,
    FLOW_MEASURES,
    KEY_WIDTH,
    LITERATE_SCORE,
    PARTS,
    TARGET_YEARS,
    UNFIT_EVERY,
    UNFIT_KEYS,
    YEARS,
)

_CODES = ", ".join(f"'{code}'" for code in STATE_CODES)
_VALID_YEAR = f"{YEARS[0]} AND {YEARS[1]}"
_WIDE = [f"meta_alfabetizacao_{year}" for year in TARGET_YEARS]
_LEVELS = [f"proporcao_aluno_nivel_{i}" for i in range(9)]
_NUMBERS = ["resultado_alfabetizacao", "percentual_participacao", *_WIDE]
_CITY, _STATE, _NATION = (
    "meta_alfabetizacao_municipio",
    "meta_alfabetizacao_uf",
    "meta_alfabetizacao_brasil",
)


def _uf(number: str) -> str:
    return f"[{_CODES}][CAST({number} AS INTEGER) + 1]"


def _join(parts: list[str]) -> str:
    return ",\n       ".join(parts)


def _padded(column: str, text: str | None = None, width: int = KEY_WIDTH) -> str:
    text = text or f"CAST({column} AS VARCHAR)"
    fits = f"length({text}) BETWEEN 1 AND {width}"
    return f"CASE WHEN {fits} THEN lpad({text}, {width}, '0') END"


def _number(column: str) -> str:
    return f"TRY_CAST(replace({column}, ',', '.') AS DOUBLE)"


def _own_target() -> str:
    cases = " ".join(f"WHEN {y} THEN meta_alfabetizacao_{y}" for y in TARGET_YEARS)
    return f"CASE ano {cases} END AS meta_alfabetizacao"


def _flags(columns: list[str]) -> str:
    return _join([f"{c} IS NULL AS {c}_ausente" for c in columns])


def _first_of(
    table: str, columns: list[str], keys: list[str], latest: str | None, bypass: list[str]
) -> str:
    """Rows ranked first in their key; rows with a null in ``bypass`` only lose copies."""
    order = [f"{latest} DESC NULLS LAST"] if latest else []
    order += [f"{c} ASC NULLS FIRST" for c in columns if c not in keys and c != latest]
    over = f"PARTITION BY {', '.join(keys)} ORDER BY {', '.join(order)}"
    ranked = f"SELECT {', '.join(columns)} FROM {table}"
    if not bypass:
        return f"{ranked} QUALIFY row_number() OVER ({over}) = 1"
    known = " AND ".join(f"{c} IS NOT NULL" for c in bypass)
    unknown = " OR ".join(f"{c} IS NULL" for c in bypass)
    return (
        f"({ranked} WHERE {known} QUALIFY row_number() OVER ({over}) = 1)"
        f" UNION ALL (SELECT DISTINCT {', '.join(columns)} FROM {table} WHERE {unknown})"
    )


def _targets(lead: str, rate: str, source: str, level: str = "") -> str:
    wide = [
        f"(3000 + (k * 13 + {y} * 7) % 6000) / 1e2 AS meta_alfabetizacao_{y}" for y in TARGET_YEARS
    ]
    return (
        f"SELECT {lead} ano, rede, {rate} AS taxa_alfabetizacao, {_join(wide)},"
        f" ((n * 7) % 10001) / 1e2 AS percentual_participacao{level} FROM {source}"
    )


def _scores(lead: str, source: str) -> str:
    levels = [f"((n * {i + 1}) % 10001) / 1e2 AS {c}" for i, c in enumerate(_LEVELS)]
    return (
        f"SELECT ano, {lead}, '2' AS serie, rede, n / 1e2 AS taxa_alfabetizacao,"
        f" CAST(600 + n % 301 AS DOUBLE) AS media_portugues, {_join(levels)} FROM {source}"
    )


def _groups(key: str, source: str) -> str:
    return (
        f"SELECT {key} AS k, CAST(year(o_orderdate) AS INTEGER) AS ano, o_orderstatus AS rede,"
        f" CAST(sum(o_orderkey) % 10001 AS BIGINT) AS n FROM {source} GROUP BY ALL"
    )


def _clean_targets(source: str, lead: str, rate: str, tail: str = "") -> str:
    """``source`` may end in a condition."""
    return (
        f"SELECT {lead} ano, rede, {rate} AS resultado_alfabetizacao, {_join(_WIDE)},"
        f" percentual_participacao{tail} FROM {source}"
    )


def _finished(source: str) -> str:
    return f"SELECT *, {_own_target()}, {_flags(_NUMBERS)} FROM {source}"


def _label(table: str, column: str) -> str:
    return (
        f"(SELECT min(valor) FROM dictionary x WHERE x.id_tabela = '{table}'"
        f" AND x.nome_coluna = '{column}' AND x.chave = s.{column}) AS {column}"
    )


_TARGET_COLUMNS = ["ano", "rede", "resultado_alfabetizacao", *_WIDE, "percentual_participacao"]
_STUDENT_RAW = [
    "id_aluno", "id_municipio", "ano", "id_escola", "caderno", "serie", "rede", "presenca",
    "preenchimento_caderno", "alfabetizado", "proficiencia", "peso_aluno",
]
_STUDENT_CODES = ["serie", "rede", "presenca", "preenchimento_caderno", "alfabetizado"]
_STUDENT_CLEAN = [
    "ano", "id_municipio", "nome_municipio", "sigla_uf", "id_escola", "id_aluno", "caderno",
    "serie", "rede", "presenca", "preenchimento_caderno", "alfabetizado", "proficiencia_saeb",
    "peso_aluno",
]


def _students_clean(texts: bool, ingested: bool) -> str:
    """Values of extracted students after cleaning, ids as text for events."""
    ids = {"id_escola": "id_escola", "id_aluno": "id_aluno"}
    if texts:
        ids = {c: f"CAST({c} AS VARCHAR)" for c in ids}
    columns = {
        "ano": "ano",
        "id_municipio": _padded("id_municipio"),
        "nome_municipio": "id_municipio_nome",
        "sigla_uf": "upper(trim(sigla_uf))",
        **ids,
        **{c: c for c in ["caderno", *_STUDENT_CODES]},
        "proficiencia_saeb": "proficiencia",
        "peso_aluno": "peso_aluno",
    }
    if ingested:
        columns["_ingested_at"] = "_ingested_at"
    return (
        f"SELECT {_join([f'{expr} AS {name}' for name, expr in columns.items()])}"
        f" FROM extracted_students WHERE ano IS NOT NULL AND {columns['id_municipio']} IS NOT NULL"
    )


def _integrated(network: bool) -> str:
    on_state = " AND su.rede = c.rede" if network else ""
    on_nation = " AND nb.rede = c.rede" if network else ""
    own = [
        *_TARGET_COLUMNS[2:],
        "nivel_alfabetizacao",
        "meta_alfabetizacao",
        *[f"{c}_ausente" for c in _NUMBERS],
    ]
    return (
        f"SELECT c.ano, m.sigla_uf, c.id_municipio, c.rede, {_join([f'c.{x}' for x in own])},"
        " m.nome_municipio, u.nome_uf,"
        " su.meta_alfabetizacao AS meta_alfabetizacao_uf,"
        " su.resultado_alfabetizacao AS resultado_alfabetizacao_uf,"
        " nb.meta_alfabetizacao AS meta_alfabetizacao_brasil,"
        " nb.resultado_alfabetizacao AS resultado_alfabetizacao_brasil,"
        " c.resultado_alfabetizacao >= c.meta_alfabetizacao AS atingiu_meta_municipio"
        " FROM city_targets c"
        " LEFT JOIN cities m ON m.id_municipio = c.id_municipio"
        " LEFT JOIN states u ON u.sigla_uf = m.sigla_uf"
        f" LEFT JOIN state_targets su ON su.sigla_uf = m.sigla_uf AND su.ano = c.ano{on_state}"
        f" LEFT JOIN national_targets nb ON nb.ano = c.ano{on_nation}"
    )


# -- report rows ---------------------------------------------------------------


def _row(
    entity: str,
    rule: str,
    label: str,
    violations: str,
    source: str,
    percent: bool = False,
    total: str = "count(*)",
) -> str:
    share = "CASE WHEN t > 0 THEN round(v / t * 100, 2) ELSE 0.0 END"
    pct = f"CAST({share} AS DOUBLE)" if percent else "CAST(NULL AS DOUBLE)"
    alert = f"{share} >= 5" if percent else "v > 0"
    return (
        f"SELECT '{entity}' AS entidade, '{rule}' AS regra, '{label}' AS coluna,"
        f" CAST(t AS BIGINT) AS total_registros, CAST(v AS BIGINT) AS violacoes,"
        f" {pct} AS percentual,"
        f" CASE WHEN v IS NULL THEN 'N/A' WHEN {alert} THEN 'ALERTA' ELSE 'OK' END AS status"
        f" FROM (SELECT {total} AS t, {violations} AS v FROM {source})"
    )


def _duplicates(entity: str, source: str, keys: str) -> str:
    label = keys.replace(" ", "")
    known = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    complete = f"(SELECT {keys} FROM {source} WHERE {known})"
    beyond = f"(SELECT count(*) FROM {complete}) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {complete}))"
    return _row(entity, "duplicidade", label, f"any_value({beyond})", source)


def _unique(entity: str, source: str, keys: str) -> list[str]:
    known = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    missing = f"count(*) FILTER (WHERE NOT ({known}))"
    label = keys.replace(" ", "")
    return [
        _duplicates(entity, source, keys),
        _row(entity, "chave_incompleta", label, missing, source, True),
    ]


def _source_rules(entity: str, source: str, columns: list[str]) -> list[str]:
    """Missing values of mandatory columns, and unfit city keys."""
    rules = []
    for c in columns:
        absent = f"count(*) FILTER (WHERE {c} IS NULL OR trim(CAST({c} AS VARCHAR)) = '')"
        rules.append(_row(entity, "chave_ausente", c, absent, source, True))
        if c == "id_municipio":
            unfit = f"count(*) FILTER (WHERE {c} NOT BETWEEN 0 AND {UNFIT_KEYS - 1})"
            rules.append(_row(entity, "chave_invalida", c, unfit, source))
    return rules


def _missing(entity: str, source: str, columns: list[str]) -> list[str]:
    return [
        _row(entity, "valores_ausentes", c, f"count(*) FILTER (WHERE {c} IS NULL)", source, True)
        for c in columns
    ]


def _year_rule(entity: str, source: str) -> str:
    bad = f"count(*) FILTER (WHERE ano NOT BETWEEN {_VALID_YEAR})"
    return _row(entity, "consistencia_ano", "ano", bad, source)


def _percent_rule(entity: str, source: str, column: str) -> str:
    bad = f"count(*) FILTER (WHERE {column} NOT BETWEEN 0 AND 100)"
    return _row(entity, "consistencia_percentual", column, bad, source)


def _state_rule(entity: str, source: str) -> str:
    bad = f"count(*) FILTER (WHERE sigla_uf IS NULL OR sigla_uf NOT IN ({_CODES}))"
    return _row(entity, "uf_valida", "sigla_uf", bad, source)


def _not_applicable(entity: str, rule: str, column: str, source: str) -> str:
    return _row(entity, rule, column, "NULL", source)


def _fk(entity: str, source: str, column: str, reference: str) -> str:
    orphans = (
        f"(SELECT DISTINCT {column} FROM {source}) k WHERE NOT EXISTS"
        f" (SELECT 1 FROM {reference} r WHERE r.{column} = k.{column})"
    )
    return _row(entity, "chave_relacionamento", column, "count(*)", orphans, total="NULL")


def _target_rules(entity: str, source: str, mandatory: list[str], state: bool) -> list[str]:
    return [
        *_missing(entity, source, [*mandatory, *_NUMBERS]),
        *([_state_rule(entity, source)] if state else []),
        _year_rule(entity, source),
        _percent_rule(entity, source, "meta_alfabetizacao"),
        _percent_rule(entity, source, "resultado_alfabetizacao"),
    ]


def _union(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


def _suite_sql() -> str:
    return _union(
        [
            *_unique("uf", "states", "sigla_uf"),
            *_source_rules("uf", "raw_state", ["sigla_uf"]),
            *_missing("uf", "states", ["sigla_uf"]),
            _state_rule("uf", "states"),
            _not_applicable("uf", "consistencia_ano", "ano", "states"),
            *_unique("municipio", "cities", "id_municipio"),
            *_source_rules("municipio", "raw_city", ["id_municipio"]),
            *_missing("municipio", "cities", ["id_municipio"]),
            _state_rule("municipio", "cities"),
            _not_applicable("municipio", "consistencia_ano", "ano", "cities"),
            _fk("municipio", "cities", "sigla_uf", "states"),
            *_unique(_NATION, "national_targets", "ano, rede"),
            *_source_rules(_NATION, "raw_national_targets", ["ano"]),
            *_target_rules(_NATION, "national_targets", ["ano"], False),
            *_unique(_STATE, "state_targets", "sigla_uf, ano, rede"),
            *_source_rules(_STATE, "raw_state_targets", ["sigla_uf", "ano"]),
            *_target_rules(_STATE, "state_targets", ["sigla_uf", "ano"], True),
            _fk(_STATE, "state_targets", "sigla_uf", "states"),
            *_unique(_CITY, "located_clean", "id_municipio, ano, rede"),
            *_source_rules(_CITY, "raw_city_targets", ["id_municipio", "ano"]),
            *_target_rules(_CITY, "located_clean", ["id_municipio", "ano"], True),
            _fk(_CITY, "located_clean", "id_municipio", "cities"),
            *_unique("dados_alunos", "students", "id_aluno, ano"),
            *_source_rules("dados_alunos", "raw_students", ["id_municipio", "ano"]),
            *_missing(
                "dados_alunos",
                "students",
                ["id_municipio", "ano", "proficiencia_saeb", "peso_aluno"],
            ),
            _state_rule("dados_alunos", "students"),
            _year_rule("dados_alunos", "students"),
            _fk("dados_alunos", "students", "id_municipio", "cities"),
        ]
    )


_FIT_TARGETS = "{0} WHERE id_municipio < " + str(UNFIT_KEYS)

_PARTS: dict[str, str] = {
    "dictionary": "SELECT * FROM (VALUES "
    + ", ".join("(" + ", ".join(f"'{v}'" for v in row) + ")" for row in DICTIONARY)
    + ") AS d(id_tabela, nome_coluna, chave, valor)",
    "raw_state": f"SELECT ' ' || lower({_uf('n_nationkey')}) || ' ' AS sigla_uf,"
    " ' ' || replace(n_name, '_', '  ') AS sigla_uf_nome FROM nation",
    "raw_city_once": "SELECT CAST(c_custkey AS INTEGER) AS id_municipio,"
    " '  ' || replace(c_name, '#', '   ') || ' ' AS id_municipio_nome,"
    " CASE WHEN c_custkey % 97 = 0 THEN 'xx' WHEN c_custkey % 89 = 0 THEN NULL"
    f" ELSE ' ' || lower({_uf('c_nationkey')}) || ' ' END AS sigla_uf FROM customer",
    "raw_city": "SELECT * FROM raw_city_once UNION ALL"
    " SELECT * FROM raw_city_once WHERE id_municipio % 10 = 0",
    "city_directory": "SELECT DISTINCT c_custkey AS id_municipio, c_name AS nome,"
    f" {_uf('c_nationkey')} AS sigla_uf FROM customer",
    "state_directory": f"SELECT DISTINCT {_uf('n_nationkey')} AS sigla, n_name AS nome FROM nation",
    "city_groups": _groups("o_custkey", "orders"),
    "state_groups": _groups("c_nationkey", "orders JOIN customer ON c_custkey = o_custkey"),
    "nation_groups": _groups("CAST(0 AS BIGINT)", "orders"),
    "raw_city_targets": _targets(
        f"CASE WHEN k % {UNFIT_EVERY} = 0 THEN k + {UNFIT_KEYS} WHEN k % 101 = 0 THEN k + 9000000 ELSE k END AS id_municipio,",
        "CASE WHEN k % 53 = 0 THEN 'n/d' WHEN k % 59 = 0 THEN NULL WHEN k % 211 = 0 THEN '105,50'"
        " ELSE CAST(n // 100 AS VARCHAR) || ',' || lpad(CAST(n % 100 AS VARCHAR), 2, '0') END",
        "city_groups",
        ", n % 9 AS nivel_alfabetizacao",
    ),
    "raw_state_targets": _targets(f"{_uf('k')} AS sigla_uf,", "n / 1e2", "state_groups"),
    "raw_national_targets": _targets("", "n / 1e2", "nation_groups"),
    "raw_city_scores": _scores("k AS id_municipio", "city_groups"),
    "raw_state_scores": _scores(f"{_uf('k')} AS sigla_uf", "state_groups"),
    "raw_students_once": "SELECT l_orderkey AS o, CASE WHEN l_orderkey % 503 <> 0 THEN l_orderkey"
    " END AS id_aluno, o_custkey AS id_municipio, CAST(year(l_shipdate) AS INTEGER) AS ano,"
    " l_suppkey AS id_escola, l_linenumber AS caderno, '2' AS serie, o_orderstatus AS rede,"
    " l_returnflag AS presenca, l_linestatus AS preenchimento_caderno,"
    f" CASE WHEN p >= {LITERATE_SCORE} THEN '1' ELSE '0' END AS alfabetizado, p AS proficiencia,"
    " 0.8::DOUBLE + l_tax AS peso_aluno, l_shipdate AS _ingested_at FROM (SELECT *,"
    " 600.0::DOUBLE + (CAST(round(l_extendedprice * 100) AS BIGINT) % 30001) / 1e2 AS p"
    " FROM lineitem JOIN orders ON o_orderkey = l_orderkey)",
    "raw_students": "SELECT * EXCLUDE (o) FROM raw_students_once UNION ALL"
    " SELECT * EXCLUDE (o) FROM raw_students_once WHERE o % 20 = 0",
    # Clean dimensions and targets.
    "clean_state": "SELECT upper(trim(regexp_replace(sigla_uf, '\\s+', ' ', 'g'))) AS sigla_uf,"
    " trim(regexp_replace(sigla_uf_nome, '\\s+', ' ', 'g')) AS nome_uf FROM raw_state",
    "states": _first_of("clean_state", ["sigla_uf", "nome_uf"], ["sigla_uf"], None, []),
    "clean_city": f"SELECT {_padded('id_municipio')} AS id_municipio,"
    " trim(regexp_replace(id_municipio_nome, '\\s+', ' ', 'g')) AS nome_municipio,"
    " upper(trim(regexp_replace(sigla_uf, '\\s+', ' ', 'g'))) AS sigla_uf FROM raw_city",
    "cities": _first_of(
        "clean_city", ["id_municipio", "nome_municipio", "sigla_uf"], ["id_municipio"], None, []
    ),
    "clean_city_targets": _clean_targets(
        _FIT_TARGETS.format("raw_city_targets"),
        f"{_padded('id_municipio')} AS id_municipio,",
        _number("taxa_alfabetizacao"),
        ", nivel_alfabetizacao",
    ),
    "city_targets": _finished("clean_city_targets"),
    "located_city_targets": "SELECT t.*, d.nome AS id_municipio_nome, d.sigla_uf"
    " FROM raw_city_targets t LEFT JOIN city_directory d ON d.id_municipio = t.id_municipio",
    "located_values": _clean_targets(
        _FIT_TARGETS.format("located_city_targets"),
        f"{_padded('id_municipio')} AS id_municipio,",
        _number("taxa_alfabetizacao"),
        ", nivel_alfabetizacao, id_municipio_nome AS nome_municipio,"
        " upper(trim(sigla_uf)) AS sigla_uf",
    ),
    "located_clean": _finished("located_values"),
    "clean_state_targets": _clean_targets(
        "raw_state_targets", "upper(trim(sigla_uf)) AS sigla_uf,", "taxa_alfabetizacao"
    ),
    "state_targets": _finished("clean_state_targets"),
    "named_state_targets": _clean_targets(
        "raw_state_targets LEFT JOIN state_directory ON sigla = sigla_uf",
        "upper(trim(sigla_uf)) AS sigla_uf,",
        "taxa_alfabetizacao",
        ", nome AS nome_uf",
    ),
    "clean_national_targets": _clean_targets("raw_national_targets", "", "taxa_alfabetizacao"),
    "national_targets": _finished("clean_national_targets"),
    # Students.
    "extracted_students": "SELECT s.ano, s.id_municipio, d.nome AS id_municipio_nome, d.sigla_uf,"
    " s.id_escola, s.id_aluno, s.caderno, "
    + ", ".join(_label("alunos", c) for c in _STUDENT_CODES)
    + ", s.proficiencia, s.peso_aluno, s._ingested_at FROM raw_students s"
    " LEFT JOIN city_directory d ON d.id_municipio = s.id_municipio",
    "clean_students": _students_clean(texts=False, ingested=True),
    "deduped_students": _first_of(
        "clean_students",
        [*_STUDENT_CLEAN, "_ingested_at"],
        ["id_aluno", "ano"],
        "_ingested_at",
        ["id_aluno"],
    ),
    "students": f"SELECT *, {_flags(['proficiencia_saeb', 'peso_aluno'])} FROM deduped_students",
    "clean_events": _students_clean(texts=True, ingested=False),
    "deduped_events": _first_of(
        "clean_events", _STUDENT_CLEAN, ["id_aluno", "ano"], None, ["id_aluno"]
    ),
    "part_events": f"SELECT *, CAST(caderno % {PARTS} AS BIGINT) AS _batch_id FROM clean_events",
    "deduped_parts": _first_of(
        "part_events",
        [*_STUDENT_CLEAN, "_batch_id"],
        ["id_aluno", "ano", "_batch_id"],
        None,
        ["id_aluno"],
    ),
    "stored_parts": f"SELECT *, {_flags(['proficiencia_saeb', 'peso_aluno'])} FROM deduped_parts",
    "distinct_parts": "SELECT * EXCLUDE (_batch_id), max(_batch_id) AS _newest FROM stored_parts"
    " GROUP BY ALL",
    "newest_parts": _first_of(
        "distinct_parts",
        [*_STUDENT_CLEAN, "proficiencia_saeb_ausente", "peso_aluno_ausente", "_newest"],
        ["id_aluno", "ano"],
        "_newest",
        ["id_aluno"],
    ),
    "smallest_parts": _first_of(
        "distinct_parts",
        [*_STUDENT_CLEAN, "proficiencia_saeb_ausente", "peso_aluno_ausente"],
        ["id_aluno", "ano"],
        None,
        ["id_aluno"],
    ),
    "streamed": f"SELECT *, {_flags(['proficiencia_saeb', 'peso_aluno'])} FROM deduped_events",
    # Dimensions of the whole flow, from the scores.
    "flow_cities": f"SELECT DISTINCT {_padded('k')} AS id_municipio, d.nome AS nome_municipio,"
    " d.sigla_uf FROM city_groups LEFT JOIN city_directory d ON d.id_municipio = k",
    "flow_states": "SELECT DISTINCT sigla_uf, nome AS nome_uf FROM raw_state_scores"
    " LEFT JOIN state_directory ON sigla = sigla_uf",
    # Integration, marts, reports.
    "fanout": _integrated(network=False),
    "by_network": _integrated(network=True),
    "state_figures": "SELECT DISTINCT ano, sigla_uf, nome_uf,"
    " resultado_alfabetizacao_uf AS indicador_alfabetizacao_pct,"
    " meta_alfabetizacao_uf AS meta_alfabetizacao FROM fanout",
    "state_mart": "SELECT *, round(indicador_alfabetizacao_pct - meta_alfabetizacao, 2)"
    " AS gap_meta_pct, indicador_alfabetizacao_pct >= meta_alfabetizacao AS atingiu_meta_uf"
    " FROM ("
    + _first_of(
        "state_figures",
        ["ano", "sigla_uf", "nome_uf", "indicador_alfabetizacao_pct", "meta_alfabetizacao"],
        ["ano", "sigla_uf"],
        None,
        [],
    )
    + ")",
    "nation_figures": "SELECT DISTINCT ano, resultado_alfabetizacao_brasil AS resultado_brasil,"
    " meta_alfabetizacao_brasil AS meta_brasil FROM fanout",
    "nation_by_year": _first_of(
        "nation_figures", ["ano", "resultado_brasil", "meta_brasil"], ["ano"], None, []
    ),
    "trend": "SELECT ano,"
    " round(avg(resultado_alfabetizacao), 2) AS media_indicador_municipios,"
    " count(id_municipio) AS qtd_municipios_avaliados,"
    " count(DISTINCT id_municipio) AS qtd_municipios_distintos FROM fanout GROUP BY ano",
    "suite": _suite_sql(),
    "metrics": "SELECT event_type AS entidade, ts AS reported_at,"
    " unnest(['QualityCheckAlerts', 'PipelineRunStatus']) AS metrica,"
    " unnest([CAST(event_id % 4 AS INTEGER), CASE WHEN event_id % 4 = 0 THEN 0 ELSE 1 END])"
    " AS valor FROM events",
    "alarms": "SELECT entidade, date_trunc('hour', reported_at) AS inicio, metrica,"
    " CAST(max(valor) AS DOUBLE) AS highest, CAST(sum(valor) AS DOUBLE) AS summed"
    " FROM metrics GROUP BY ALL",
    "flow_integrated": "SELECT c.ano, m.sigla_uf FROM city_targets c"
    " LEFT JOIN flow_cities m ON m.id_municipio = c.id_municipio"
    " LEFT JOIN state_targets su ON su.sigla_uf = m.sigla_uf AND su.ano = c.ano"
    " LEFT JOIN national_targets nb ON nb.ano = c.ano",
}


def _count(name: str, source: str) -> str:
    return f"SELECT '{name}' AS tabela, count(*) AS registros FROM {source}"


_OFFENDERS = (
    "SELECT '{0}' AS entidade, 'uf_valida' AS regra, 'sigla_uf' AS coluna, sigla_uf AS valor,"
    " count(*) AS registros FROM {1} WHERE sigla_uf IS NULL OR sigla_uf NOT IN ("
    + _CODES
    + ") GROUP BY sigla_uf"
)

def _part_quality(part: int) -> str:
    """Quality rows of one micro-batch and its rejected payloads."""
    rows = f"(SELECT * FROM stored_parts WHERE _batch_id = {part})"
    events = f"(SELECT * FROM extracted_students WHERE caderno % {PARTS} = {part})"
    numbers = ["id_municipio", "ano", "proficiencia_saeb", "peso_aluno"]
    rules = [
        *_unique("dados_alunos", rows, "id_aluno, ano"),
        *_source_rules("dados_alunos", events, ["id_municipio", "ano"]),
        *_missing("dados_alunos", rows, numbers),
        _state_rule("dados_alunos", rows),
        _year_rule("dados_alunos", rows),
        "SELECT 'dados_alunos', 'evento_rejeitado', 'data', NULL, count(*), NULL, 'ALERTA' FROM"
        f" orders WHERE o_orderkey % 1000 = 0 AND (o_orderkey // 1000) % {PARTS} = {part}"
        " HAVING count(*) > 0",
    ]
    return f"SELECT *, CAST({part} AS BIGINT) AS _batch_id FROM ({_union(rules)})"


def _stream_quality_whole() -> str:
    """Rules on all stored rows of the stream together."""
    numbers = ["id_municipio", "ano", "proficiencia_saeb", "peso_aluno"]
    return _union(
        [
            *_unique("dados_alunos", "stored_parts", "id_aluno, ano"),
            *_source_rules("dados_alunos", "extracted_students", ["id_municipio", "ano"]),
            *_missing("dados_alunos", "stored_parts", numbers),
            _state_rule("dados_alunos", "stored_parts"),
            _year_rule("dados_alunos", "stored_parts"),
        ]
    )


_QUERIES: dict[str, str] = {
    "scan_roundtrip": "SELECT *, CAST(year(o_orderdate) AS INTEGER) AS ano FROM orders",
    "scan_csv": "SELECT * FROM customer",
    "rename_normalise": "SELECT c_custkey AS codigo_cliente, c_name AS nome, c_nationkey AS nacao"
    " FROM customer",
    "text_clean": "SELECT id_municipio, trim(regexp_replace(id_municipio_nome, '\\s+', ' ', 'g'))"
    " AS id_municipio_nome FROM raw_city",
    "code_upper": "SELECT id_municipio, upper(trim(sigla_uf)) AS sigla_uf FROM raw_city",
    "key_zero_pad": "SELECT o_orderkey,"
    f" {_padded('', 'CAST(o_orderkey * 997 AS VARCHAR)', 7)} AS inteiro,"
    f" {_padded('', 'CAST(o_orderkey * 997 AS VARCHAR)', 7)} AS real,"
    " CASE WHEN o_orderkey % 10 <> 0 THEN "
    f"{_padded('', 'CAST(o_orderkey * 997 AS VARCHAR)', 7)} END AS texto FROM orders",
    "number_parse": f"SELECT id_municipio, ano, rede, {_number('taxa_alfabetizacao')}"
    " AS taxa_alfabetizacao FROM raw_city_targets",
    "missing_values": "SELECT id_municipio, ano, rede, sigla_uf, v AS taxa_alfabetizacao,"
    " v IS NULL AS taxa_alfabetizacao_ausente FROM (SELECT *,"
    f" {_number('taxa_alfabetizacao')} AS v FROM located_city_targets WHERE sigla_uf IS NOT NULL)",
    "dedup_exact": "SELECT DISTINCT * FROM raw_students",
    "dedup_key": _first_of(
        "raw_students", _STUDENT_RAW, ["id_aluno", "ano"], None, ["id_aluno", "ano"]
    ),
    "dedup_latest": _first_of(
        "raw_students",
        [*_STUDENT_RAW, "_ingested_at"],
        ["id_aluno", "ano"],
        "_ingested_at",
        ["id_aluno", "ano"],
    ),
    "wide_target_resolve": f"SELECT id_municipio, ano, rede, {_own_target()} FROM raw_city_targets",
    "standardise_entity": "SELECT * FROM city_targets",
    "audit_time": "SELECT count(*) AS registros, 0::BIGINT AS fora_do_intervalo FROM city_targets",
    "dim_state": "SELECT * FROM states",
    "dim_city": "SELECT * FROM cities",
    "targets_national": "SELECT * FROM national_targets",
    "targets_state": _finished("named_state_targets"),
    "targets_city": "SELECT * FROM located_clean",
    "student_fact": "SELECT * FROM students",
    "rejected_rows": "SELECT 'id_municipio' AS coluna, 'chave_invalida' AS motivo,"
    " CAST(id_municipio AS VARCHAR) AS valor, count(*) AS registros FROM raw_city_targets"
    f" WHERE id_municipio >= {UNFIT_KEYS} GROUP BY id_municipio UNION ALL"
    " SELECT NULL, 'mantida', NULL, count(*) FROM city_targets",
    "code_decode": "SELECT id_aluno, id_municipio, ano, "
    + ", ".join(_label("alunos", c) for c in _STUDENT_CODES)
    + " FROM raw_students s",
    "directory_lookup": "SELECT * FROM located_city_targets",
    "extract_state": "SELECT ano, sigla_uf, nome AS sigla_uf_nome, "
    + f"{_label('uf', 'serie')}, {_label('uf', 'rede')}, taxa_alfabetizacao, media_portugues,"
    f" {_join(_LEVELS)} FROM raw_state_scores s LEFT JOIN state_directory ON sigla = sigla_uf",
    "extract_city": "SELECT ano, s.id_municipio, d.nome AS id_municipio_nome, d.sigla_uf, "
    + f"{_label('municipio', 'serie')},"
    f" {_label('municipio', 'rede')},"
    f" taxa_alfabetizacao, media_portugues, {_join(_LEVELS)} FROM raw_city_scores s"
    " LEFT JOIN city_directory d ON d.id_municipio = s.id_municipio",
    "extract_students": "SELECT * FROM extracted_students",
    "quality_duplicates": _union(
        [
            *_unique("municipio", "raw_city", "id_municipio"),
            *_unique("dados_alunos", "raw_students", "id_aluno, ano"),
            *_unique(_CITY, "raw_city_targets", "id_municipio, ano, rede"),
        ]
    ),
    "quality_missing": _union(
        [
            *_missing("municipio", "raw_city", ["id_municipio", "id_municipio_nome", "sigla_uf"]),
            *_missing(_CITY, "city_targets", _NUMBERS),
            *_missing("dados_alunos", "raw_students", ["id_aluno"]),
        ]
    ),
    "quality_range": _union(
        [
            _year_rule(_CITY, "city_targets"),
            _percent_rule(_CITY, "city_targets", "meta_alfabetizacao"),
            _percent_rule(_CITY, "city_targets", "resultado_alfabetizacao"),
            _year_rule("dados_alunos", "raw_students"),
            *[
                _not_applicable("dados_alunos", "consistencia_percentual", c, "raw_students")
                for c in ("meta_alfabetizacao", "resultado_alfabetizacao")
            ],
        ]
    ),
    "quality_domain": _union(
        [
            _OFFENDERS.format(
                "municipio", "(SELECT upper(trim(sigla_uf)) AS sigla_uf FROM raw_city)"
            ),
            _OFFENDERS.format(_CITY, "located_city_targets"),
        ]
    ),
    "quality_fk": _union(
        [
            _fk(_CITY, "city_targets", "id_municipio", "cities"),
            _fk("municipio", "cities", "sigla_uf", "states"),
        ]
    ),
    "quality_suite": "SELECT * FROM suite",
    "quality_report": "SELECT entidade,"
    " CASE WHEN bool_and(status IN ('OK', 'N/A')) THEN 'OK' ELSE 'ALERTA' END AS status_geral,"
    " CAST(count(*) AS INTEGER) AS regras,"
    " CAST(count(*) FILTER (WHERE status = 'ALERTA') AS INTEGER) AS alertas"
    " FROM (SELECT entidade, regra, CASE WHEN regra <> 'valores_ausentes' THEN coluna END AS c,"
    " CASE WHEN bool_or(status = 'ALERTA') THEN 'ALERTA' ELSE 'OK' END AS status"
    " FROM suite GROUP BY ALL) GROUP BY entidade",
    "quality_gate": "SELECT entidade,"
    " CASE WHEN bool_and(status IN ('OK', 'N/A')) THEN 'OK' ELSE 'ALERTA' END AS status_geral,"
    " count(DISTINCT regra || '/' || CASE WHEN regra <> 'valores_ausentes' THEN coluna ELSE '' END)"
    " FILTER (WHERE status = 'ALERTA') AS alertas,"
    " bool_and(status IN ('OK', 'N/A')) AS publica FROM suite GROUP BY entidade",
    "integrate_fanout": "SELECT * FROM fanout",
    "integrate_by_network": "SELECT * FROM by_network",
    "integrate_fk_check": _union(
        [
            _fk("indicador_alfabetizacao_integrado", "fanout", "id_municipio", "cities"),
            _duplicates("indicador_alfabetizacao_integrado_uf", "state_targets", "sigla_uf, ano"),
            _duplicates("indicador_alfabetizacao_integrado_brasil", "national_targets", "ano"),
        ]
    ),
    "mart_city": "SELECT ano, id_municipio, nome_municipio, sigla_uf, nome_uf, rede,"
    " resultado_alfabetizacao AS indicador_alfabetizacao_pct, meta_alfabetizacao,"
    " atingiu_meta_municipio FROM fanout",
    "mart_state": "SELECT * FROM state_mart",
    "mart_comparison": "SELECT ano, id_municipio, nome_municipio, sigla_uf,"
    " resultado_alfabetizacao AS resultado_municipio, meta_alfabetizacao AS meta_municipio,"
    " atingiu_meta_municipio, resultado_alfabetizacao_uf AS resultado_uf,"
    " meta_alfabetizacao_uf AS meta_uf, resultado_alfabetizacao_brasil AS resultado_brasil,"
    " meta_alfabetizacao_brasil AS meta_brasil,"
    " round(resultado_alfabetizacao - resultado_alfabetizacao_brasil, 2)"
    " AS gap_municipio_vs_brasil FROM fanout",
    "mart_trend_integrated": "SELECT * FROM trend LEFT JOIN nation_by_year USING (ano) ORDER BY ano",
    "mart_trend": "SELECT * FROM trend LEFT JOIN nation_by_year USING (ano) ORDER BY ano",
    "mart_dashboard": "SELECT ano, id_municipio, nome_municipio, sigla_uf, nome_uf, rede,"
    " resultado_alfabetizacao AS indicador_municipio_pct, meta_alfabetizacao,"
    " atingiu_meta_municipio, resultado_alfabetizacao_uf AS indicador_uf_pct,"
    " meta_alfabetizacao_uf AS meta_uf, resultado_alfabetizacao_brasil AS indicador_brasil_pct,"
    " meta_alfabetizacao_brasil AS meta_brasil, percentual_participacao, nivel_alfabetizacao"
    " FROM fanout",
    "mart_sql_view": "SELECT ano, count(*) AS estados,"
    " count(*) FILTER (WHERE atingiu_meta_uf) AS atingiram, max(gap_meta_pct) AS maior_gap"
    " FROM state_mart WHERE sigla_uf IS NOT NULL GROUP BY ano",
    "mart_sql_catalog": "SELECT ano, count(*) AS estados,"
    " count(*) FILTER (WHERE atingiu_meta_uf) AS atingiram, max(gap_meta_pct) AS maior_gap"
    " FROM state_mart WHERE sigla_uf IS NOT NULL GROUP BY ano",
    "json_decode": "SELECT CASE WHEN event_id % 100 > 1"
    " THEN TRY_CAST(regexp_extract(props, '^\\{\"k\": (-?[0-9]+)\\}$', 1) AS INTEGER) END AS k,"
    " count(*) AS eventos FROM events GROUP BY 1",
    "stream_ingest": "SELECT * FROM stored_parts",
    "stream_batch_parity": "SELECT (SELECT count(*) FROM smallest_parts) AS linhas_stream,"
    " (SELECT count(*) FROM streamed) AS linhas_batch, count(*) AS diferencas FROM ("
    "(SELECT * FROM smallest_parts EXCEPT SELECT * FROM streamed) UNION ALL"
    " (SELECT * FROM streamed EXCEPT SELECT * FROM smallest_parts))",
    "stream_merged": "SELECT * EXCLUDE (_newest) FROM newest_parts",
    "stream_quality": _union([_part_quality(part) for part in range(PARTS)]),
    "stream_restarted": "SELECT * FROM smallest_parts",
    "stream_compacted": "SELECT * FROM stored_parts",
    "stream_upserted": "SELECT * EXCLUDE (_newest) FROM newest_parts",
    "quality_incremental": _stream_quality_whole(),
    "quality_metrics": "SELECT * FROM metrics",
    "metrics_cursor": "SELECT e.event_type AS entidade, e.ts AS reported_at,"
    " unnest(['QualityCheckAlerts', 'PipelineRunStatus']) AS metrica,"
    " unnest([CAST(event_id % 4 AS INTEGER), CASE WHEN event_id % 4 = 0 THEN 0 ELSE 1 END])"
    " AS valor, CASE WHEN event_id % 4 = 0 THEN 0 ELSE 1 END AS rodada FROM events e",
    "quality_alarms": "SELECT entidade, inicio, 'Qualidade-Com-Alerta' AS alarme,"
    " highest AS estatistica, 0.0::DOUBLE AS limite, highest > 0 AS em_alarme FROM alarms"
    " WHERE metrica = 'PipelineRunStatus' UNION ALL"
    " SELECT entidade, inicio, 'Muitos-Alertas-Qualidade', summed, 3.0::DOUBLE, summed > 3"
    " FROM alarms WHERE metrica = 'QualityCheckAlerts'",
    "alarms_stream": "SELECT entidade, inicio, 'Qualidade-Com-Alerta' AS alarme,"
    " highest AS estatistica, 0.0::DOUBLE AS limite, highest > 0 AS em_alarme FROM alarms"
    " WHERE metrica = 'PipelineRunStatus' UNION ALL"
    " SELECT entidade, inicio, 'Muitos-Alertas-Qualidade', summed, 3.0::DOUBLE, summed > 3"
    " FROM alarms WHERE metrica = 'QualityCheckAlerts'",
    "end_to_end": _union(
        [
            _count("uf", "raw_state_scores"),
            _count("states", "(SELECT DISTINCT sigla_uf FROM raw_state_scores)"),
            _count("municipio", "raw_city_scores"),
            _count("cities", "flow_cities"),
            _count(_NATION, "national_targets"),
            _count(_STATE, "state_targets"),
            _count(_CITY, "city_targets"),
            _count("dados_alunos", "students"),
            _count("indicador_alfabetizacao_integrado", "flow_integrated"),
            _count("gold_indicador_municipio", "flow_integrated"),
            _count("gold_indicador_uf", "(SELECT DISTINCT ano, sigla_uf FROM flow_integrated)"),
            _count("gold_comparacao_metas", "flow_integrated"),
            _count("gold_evolucao_temporal", "(SELECT DISTINCT ano FROM flow_integrated)"),
            _count("gold_dashboard", "flow_integrated"),
        ]
    ),
}


def _needed(sql: str, parts: dict[str, str]) -> set[str]:
    """Names of the sub-queries used by ``sql``, directly or through others."""
    found: set[str] = set()
    waiting = [sql]
    while waiting:
        words = set(re.findall(r"\w+", waiting.pop()))
        for name in (words & parts.keys()) - found:
            found.add(name)
            waiting.append(parts[name])
    return found


# Where the tables of the whole flow come from.
_FLOW_SOURCES = {
    "uf": "raw_state_scores",
    "municipio": "raw_city_scores",
    _NATION: "national_targets",
    _STATE: "state_targets",
    _CITY: "city_targets",
    "dados_alunos": "students",
    "indicador_alfabetizacao_integrado": "fanout",
    "gold_indicador_municipio": f"({_QUERIES['mart_city']})",
    "gold_indicador_uf": f"({_QUERIES['mart_state']})",
    "gold_comparacao_metas": f"({_QUERIES['mart_comparison']})",
    "gold_evolucao_temporal": f"({_QUERIES['mart_trend']})",
    "gold_dashboard": f"({_QUERIES['mart_dashboard']})",
}


def _flow_values() -> str:
    """Rows, values and sums of the measures; the flow takes its dimensions from the scores."""
    rows = [
        f"SELECT '{name}' AS tabela, count(*) AS registros, '{c}' AS coluna, count({c}) AS valores,"
        f" CAST(sum(CAST({c} AS DECIMAL(18, 4))) AS DOUBLE) AS soma FROM {_FLOW_SOURCES[name]}"
        for name, columns in FLOW_MEASURES.items()
        for c in columns
    ]
    integrated = _integrated(network=False)
    for table in ("cities m", "states u"):
        integrated = integrated.replace(f"JOIN {table}", f"JOIN flow_{table}")
    return _with_parts(_union(rows), {**_PARTS, "fanout": integrated})


_MARTS = ("mart_city", "mart_state", "mart_comparison", "mart_trend", "mart_dashboard")


def _with_parts(sql: str, parts: dict[str, str]) -> str:
    needed = _needed(sql, parts)
    used = [f"{name} AS ({body})" for name, body in parts.items() if name in needed]
    return f"WITH {', '.join(used)}\n{sql}" if used else sql


def oracle_queries() -> dict[str, str]:
    by_network = {**_PARTS, "fanout": _PARTS["by_network"]}
    result = {key: _with_parts(sql, _PARTS) for key, sql in _QUERIES.items()}
    result["pipeline_end_to_end"] = _flow_values()
    result |= {f"{key}_by_network": _with_parts(_QUERIES[key], by_network) for key in _MARTS}
    return result
