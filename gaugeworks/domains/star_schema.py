"""The literacy domain played on star-schema tables.

Orders, customers and line items stand in for targets, cities and students. The
raw tables are derived from them with injected dirt: untrimmed text, unknown and
missing codes, decimal commas, unparseable numbers, orphans and duplicates.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.domains.education import STATE_CODES, build_domain, wide_name
from gaugeworks.plans.lakehouse import Domain

# Fixed values of the fixtures.
YEARS = (1996, 2001)
TARGET_YEARS = tuple(range(1996, 2002))
LITERATE_SCORE = 743
KEY_WIDTH = 12  # customer keys have fewer digits at any scale
UNFIT_EVERY, UNFIT_KEYS = 37, 10**KEY_WIDTH
PARTS = 4  # micro-batches of a stream
MALFORMED_EVENT = '{"ano": 19'
FLOW_MEASURES = {
    "uf": ("taxa_alfabetizacao", "media_portugues"),
    "municipio": ("taxa_alfabetizacao", "proporcao_aluno_nivel_8"),
    "meta_alfabetizacao_brasil": ("resultado_alfabetizacao", "meta_alfabetizacao"),
    "meta_alfabetizacao_uf": ("resultado_alfabetizacao", "meta_alfabetizacao"),
    "meta_alfabetizacao_municipio": ("resultado_alfabetizacao", "meta_alfabetizacao"),
    "dados_alunos": ("proficiencia_saeb", "peso_aluno"),
    "indicador_alfabetizacao_integrado": (
        "resultado_alfabetizacao",
        "meta_alfabetizacao_uf",
        "resultado_alfabetizacao_brasil",
    ),
    "gold_indicador_municipio": ("indicador_alfabetizacao_pct", "meta_alfabetizacao"),
    "gold_indicador_uf": ("indicador_alfabetizacao_pct", "gap_meta_pct"),
    "gold_comparacao_metas": ("resultado_uf", "gap_municipio_vs_brasil"),
    "gold_evolucao_temporal": ("media_indicador_municipios", "resultado_brasil"),
    "gold_dashboard": ("percentual_participacao", "indicador_brasil_pct"),
}
DICTIONARY = (
    ("uf", "serie", "2", "2° ano do Ensino Fundamental"),
    ("uf", "rede", "F", "Federal"),
    ("uf", "rede", "O", "Municipal"),
    ("uf", "rede", "P", "Estadual"),
    ("municipio", "serie", "2", "2° ano do Ensino Fundamental"),
    ("municipio", "rede", "F", "Federal"),
    ("municipio", "rede", "O", "Municipal"),
    ("municipio", "rede", "P", "Estadual"),
    ("municipio", "rede", "P", "Estadual"),
    ("alunos", "serie", "2", "2° ano do Ensino Fundamental"),
    ("alunos", "rede", "F", "Federal"),
    ("alunos", "rede", "O", "Municipal"),
    ("alunos", "rede", "P", "Estadual"),
    ("alunos", "presenca", "A", "Presente"),
    ("alunos", "presenca", "R", "Ausente"),
    ("alunos", "preenchimento_caderno", "F", "Prova preenchida"),
    ("alunos", "preenchimento_caderno", "O", "Prova não preenchida"),
    ("alunos", "alfabetizado", "1", "Sim"),
    ("alunos", "alfabetizado", "0", "Não"),
    ("alunos", "alfabetizado", "0", "Não"),
)


def _wide_keys(domain: Domain) -> Domain:
    specs = {
        name: replace(spec, padded_keys=tuple((c, KEY_WIDTH) for c, _ in spec.padded_keys))
        for name, spec in domain.specs.items()
    }
    return replace(domain, specs=specs)


def _domain() -> Domain:
    """Directory-like state and city tables have one row per code here."""
    base = _wide_keys(build_domain(TARGET_YEARS, YEARS))
    specs = dict(base.specs)
    specs["uf"] = replace(specs["uf"], dedup_keys=("sigla_uf",))
    specs["municipio"] = replace(specs["municipio"], dedup_keys=("id_municipio",))
    return replace(base, specs=specs)


STAR = _domain()
STAR_SCORES = _wide_keys(build_domain(TARGET_YEARS, YEARS))


def state_code(number: Column) -> Column:
    codes = F.array(*[F.lit(code) for code in STATE_CODES])
    return F.get(codes, number.cast("int"))


def _percent(number: Column) -> Column:
    return number / F.lit(100.0)


def _repeat_rows(df: DataFrame, condition: Column) -> DataFrame:
    """Rows that meet the condition twice, all others once."""
    copies = F.when(condition, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return df.withColumn("_copy", F.explode(copies)).drop("_copy")


@dataclass
class StarTables:
    """Raw tables of the domain, all lazily derived from the Parquet files."""

    spark: SparkSession
    folder: str
    _opened: dict[str, DataFrame] = field(default_factory=dict)

    def table(self, name: str) -> DataFrame:
        """A source table; its footer is read once."""
        if name not in self._opened:
            self._opened[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._opened[name]

    # -- dimensions and lookups ------------------------------------------------

    def raw_state(self) -> DataFrame:
        code = F.lower(state_code(F.col("n_nationkey")))
        name = F.replace("n_name", F.lit("_"), F.lit("  "))
        return self.table("nation").select(
            F.concat(F.lit(" "), code, F.lit(" ")).alias("sigla_uf"),
            F.concat(F.lit(" "), name).alias("sigla_uf_nome"),
        )

    def raw_city(self) -> DataFrame:
        key = F.col("c_custkey")
        clean = F.concat(F.lit(" "), F.lower(state_code(F.col("c_nationkey"))), F.lit(" "))
        code = F.when(key % 97 == 0, "xx").when(key % 89 != 0, clean)
        name = F.replace("c_name", F.lit("#"), F.lit("   "))
        cities = self.table("customer").select(
            key.cast("int").alias("id_municipio"),
            F.concat(F.lit("  "), name, F.lit(" ")).alias("id_municipio_nome"),
            code.alias("sigla_uf"),
        )
        return _repeat_rows(cities, F.col("id_municipio") % 10 == 0)

    def city_directory(self) -> DataFrame:
        cities = self.table("customer").select(
            F.col("c_custkey").alias("id_municipio"),
            F.col("c_name").alias("nome"),
            state_code(F.col("c_nationkey")).alias("sigla_uf"),
        )
        return _repeat_rows(cities, F.col("id_municipio") % 10 == 0)

    def state_directory(self) -> DataFrame:
        states = self.table("nation").select(
            "n_nationkey",
            state_code(F.col("n_nationkey")).alias("sigla"),
            F.col("n_name").alias("nome"),
        )
        return _repeat_rows(states, F.col("n_nationkey") % 10 == 0).drop("n_nationkey")

    def dictionary(self) -> DataFrame:
        rows = ", ".join(str(row) for row in DICTIONARY)
        return self.spark.sql(
            f"SELECT * FROM VALUES {rows} AS d(id_tabela, nome_coluna, chave, valor)"
        )

    # -- figures per city, state and nation -----------------------------------

    def city_groups(self) -> DataFrame:
        """Order keys summed per customer, year and status (k, ano, rede, s)."""
        return (
            self.table("orders")
            .groupBy(
                F.col("o_custkey").alias("k"),
                F.year("o_orderdate").alias("ano"),
                F.col("o_orderstatus").alias("rede"),
            )
            .agg(F.sum("o_orderkey").alias("s"))
        )

    def state_groups(self) -> DataFrame:
        """The same per nation; customers are folded before the join."""
        customers = self.table("customer").select(
            F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("nation")
        )
        return (
            self.city_groups()
            .join(customers, "k")
            .groupBy(F.col("nation").cast("bigint").alias("k"), "ano", "rede")
            .agg(F.sum("s").alias("s"))
        )

    def nation_groups(self) -> DataFrame:
        return (
            self.table("orders")
            .groupBy(F.year("o_orderdate").alias("ano"), F.col("o_orderstatus").alias("rede"))
            .agg(F.sum("o_orderkey").alias("s"))
            .withColumn("k", F.lit(0).cast("bigint"))
        )

    @staticmethod
    def _targets(groups: DataFrame, lead: Mapping[str, Column], rate: Column | None) -> DataFrame:
        k, n = F.col("k"), F.col("n")
        wide = [
            _percent(F.lit(3000) + (k * 13 + y * 7) % 6000).alias(wide_name(y))
            for y in TARGET_YEARS
        ]
        return groups.withColumn("n", F.col("s") % 10001).select(
            *[column.alias(name) for name, column in lead.items()],
            "ano",
            "rede",
            (_percent(n) if rate is None else rate).alias("taxa_alfabetizacao"),
            *wide,
            _percent(n * 7 % 10001).alias("percentual_participacao"),
            (n % 9).alias("_level"),
        )

    def raw_city_targets(self) -> DataFrame:
        k, n = F.col("k"), F.col("n")
        written = F.concat(
            F.floor(n / 100).cast("string"), F.lit(","), F.lpad((n % 100).cast("string"), 2, "0")
        )
        rate = (
            F.when(k % 53 == 0, "n/d")
            .when(k % 59 == 0, F.lit(None).cast("string"))
            .when(k % 211 == 0, "105,50")
            .otherwise(written)
        )
        key = (
            F.when(k % UNFIT_EVERY == 0, k + UNFIT_KEYS).when(k % 101 == 0, k + 9000000).otherwise(k)
        )
        targets = self._targets(self.city_groups(), {"id_municipio": key}, rate)
        return targets.withColumnRenamed("_level", "nivel_alfabetizacao")

    def raw_state_targets(self) -> DataFrame:
        lead = {"sigla_uf": state_code(F.col("k"))}
        return self._targets(self.state_groups(), lead, None).drop("_level")

    def raw_national_targets(self) -> DataFrame:
        return self._targets(self.nation_groups(), {}, None).drop("_level")

    @staticmethod
    def _scores(groups: DataFrame, lead: Mapping[str, Column]) -> DataFrame:
        """Scores of groups; further columns of these follow."""
        n = F.col("n")
        extra = [c for c in groups.columns if c not in ("k", "ano", "rede", "s")]
        levels = [
            _percent(n * (i + 1) % 10001).alias(f"proporcao_aluno_nivel_{i}") for i in range(9)
        ]
        return groups.withColumn("n", F.col("s") % 10001).select(
            "ano",
            *[column.alias(name) for name, column in lead.items()],
            F.lit("2").alias("serie"),
            "rede",
            _percent(n).alias("taxa_alfabetizacao"),
            (n % 301 + 600).cast("double").alias("media_portugues"),
            *levels,
            *extra,
        )

    def raw_city_scores(self, groups: DataFrame | None = None) -> DataFrame:
        groups = self.city_groups() if groups is None else groups
        return self._scores(groups, {"id_municipio": F.col("k")})

    def raw_state_scores(self) -> DataFrame:
        return self._scores(self.state_groups(), {"sigla_uf": state_code(F.col("k"))})

    # -- students ----------------------------------------------------------------

    def student_orders(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("l_orderkey"), "o_custkey", "o_orderstatus"
        )

    def raw_students(self, orders: DataFrame | None = None) -> DataFrame:
        """Students of all orders; further columns of ``orders`` follow."""
        orders = self.student_orders() if orders is None else orders
        extra = [c for c in orders.columns if c not in ("l_orderkey", "o_custkey", "o_orderstatus")]
        order = F.col("l_orderkey")
        cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
        score = F.lit(600.0) + _percent(cents % 30001)
        students = self.table("lineitem").join(orders, "l_orderkey")
        return _repeat_rows(students, order % 20 == 0).select(
            F.when(order % 503 != 0, order).alias("id_aluno"),
            F.col("o_custkey").alias("id_municipio"),
            F.year("l_shipdate").alias("ano"),
            F.col("l_suppkey").alias("id_escola"),
            F.col("l_linenumber").alias("caderno"),
            F.lit("2").alias("serie"),
            F.col("o_orderstatus").alias("rede"),
            F.col("l_returnflag").alias("presenca"),
            F.col("l_linestatus").alias("preenchimento_caderno"),
            F.when(score >= LITERATE_SCORE, "1").otherwise("0").alias("alfabetizado"),
            score.alias("proficiencia"),
            (F.lit(0.8) + F.col("l_tax")).alias("peso_aluno"),
            F.col("l_shipdate").alias("_ingested_at"),
            *extra,
        )

    def student_payloads(self, students: DataFrame, schema: T.StructType) -> DataFrame:
        """Extracted students as JSON events, a few that lack their end, and the part of the
        stream they arrive in."""
        fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
        events = students.select(
            F.to_json(F.struct(*fields)).cast("binary").alias("data"),
            (F.col("caderno") % PARTS).cast("int").alias("parte"),
        )
        broken = (
            self.table("orders")
            .filter(F.col("o_orderkey") % 1000 == 0)
            .select(
                F.lit(MALFORMED_EVENT).cast("binary").alias("data"),
                (F.floor(F.col("o_orderkey") / 1000) % PARTS).cast("int").alias("parte"),
            )
        )
        return events.unionByName(broken)

    # -- reports -----------------------------------------------------------------

    def reports(self) -> DataFrame:
        """Quality-report documents, one per event, with 0 to 3 alerting checks."""
        alerts = (F.col("event_id") % 4).cast("int")
        checks = F.transform(
            F.sequence(F.lit(0), F.lit(3)),
            lambda i: F.struct(
                F.concat(F.lit("regra_"), i.cast("string")).alias("regra"),
                F.lit(None).cast("string").alias("coluna"),
                F.when(i < alerts, "ALERTA").otherwise("OK").alias("status"),
            ),
        )
        return self.table("events").select(
            F.col("event_type").alias("entidade"),
            F.when(alerts == 0, "OK").otherwise("ALERTA").alias("status_geral"),
            F.col("ts").cast("timestamp_ntz").alias("reported_at"),
            checks.alias("checks"),
        )
