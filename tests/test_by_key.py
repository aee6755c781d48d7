"""Tables stored by key, and writes that do without a shuffle of whole rows."""

import pytest
from pyspark.sql import functions as F

from gaugeworks.domains import star_queries
from gaugeworks.domains.education import EDUCATION, LAYOUT, STUDENT_EVENT
from gaugeworks.operators.dedup import keep_one, raw_keys
from gaugeworks.operators.integrate import integrate
from gaugeworks.operators.standardise import standardise_entity
from gaugeworks.plans import lakehouse
from gaugeworks.plans.lakehouse import Lakehouse, run_marts
from gaugeworks.plans.marts import MARTS
from gaugeworks.sources import shared
from gaugeworks.sources.shared import materialise_by_key, staged
from gaugeworks.sources.tables import read_table, write_table
from gaugeworks.streaming.students import merge_batches
from plan_text import executed_plan, optimised_plan

SPEC = EDUCATION.specs["dados_alunos"]
ROWS = [("a", 1, 2.0), ("a", 1, 1.0), ("b", None, 3.0), ("b", None, 3.0), (None, None, None), ("c", 2, None)]
SCHEMA = "id string, ano int, v double"


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_rows_stored_by_key_lose_duplicates_without_a_shuffle(spark):
    rows = spark.createDataFrame(ROWS, SCHEMA)
    tables = spark.catalog.listTables()
    stored = materialise_by_key(rows, "rows", ["id", "ano"])
    assert stored.schema == rows.schema and same(stored, rows)
    kept = keep_one(stored, ["id", "ano"])
    assert "Exchange" not in executed_plan(kept)
    assert same(kept, keep_one(rows, ["id", "ano"]))
    assert spark.catalog.listTables() == tables


def test_empty_tables_and_absent_keys_are_stored_too(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert materialise_by_key(empty, "empty", ["id"]).collect() == []
    rows = spark.createDataFrame(ROWS, SCHEMA)
    assert same(materialise_by_key(rows, "rows", ["nothing"]), rows)
    with staged(rows, "rows", ["id"]) as stored:
        assert same(stored, rows)


def test_a_key_with_most_rows_is_folded_before_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(shared, "_FEW_ROWS", 10)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        hot = spark.range(2000).select(F.when(F.col("id") < 1500, 7).otherwise(F.col("id")).alias("k"), "id")
        kept = keep_one(materialise_by_key(hot, "hot", ["k"]), ["k"])
        even = keep_one(materialise_by_key(spark.range(2000).select("id"), "even", ["id"]), ["id"])
        assert "Exchange" in executed_plan(kept) and "Exchange" not in executed_plan(even)
        assert kept.count() == 501 and kept.filter("k = 7").first().id == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_keys_count_as_raw_only_if_cleaning_leaves_all_of_them(spark):
    assert raw_keys(STUDENT_EVENT.names, SPEC) == ["id_aluno", "ano"]
    assert raw_keys(["ano"], SPEC) == []
    assert raw_keys(["id_municipio", "ano", "rede"], EDUCATION.specs["meta_alfabetizacao_municipio"]) == []


@pytest.mark.parametrize("newest_first", [True, False])
def test_batches_are_merged_without_a_shuffle(spark, newest_first):
    rows = spark.createDataFrame(
        [("1", 2024, "9", 0), ("1", 2024, "5", 1), (None, 2024, "3", 0), (None, 2024, "3", 1)],
        "id_aluno string, ano int, serie string, _batch_id long",
    )
    merged = merge_batches(rows, SPEC, newest_first=newest_first, stored=True)
    assert "Exchange" not in executed_plan(merged)
    assert sorted((tuple(r) for r in merged.collect()), key=str) == [("1", 2024, "5"), (None, 2024, "3")]


def test_parity_compares_both_sides_where_they_are_stored(spark, small, monkeypatch):
    made = {}
    real = star_queries.materialise_by_key
    monkeypatch.setattr(
        star_queries, "materialise_by_key", lambda df, name, keys: made.setdefault(name, real(df, name, keys))
    )
    result = star_queries.stream_batch_parity(spark, small)
    assert set(made) == {"events-batch", "sides"}
    # one exchange brings the counts of the tasks together, none the rows
    assert executed_plan(result).count("Exchange SinglePartition") == executed_plan(result).count("Exchange ") == 1
    found = result.first()
    assert found.linhas_stream == found.linhas_batch > 0 and found.diferencas == 0


def test_a_restarted_stream_gets_payloads_that_are_written_once(spark, small, monkeypatch):
    moved, copied = [], []
    real = star_queries.replace_folder
    monkeypatch.setattr(star_queries, "replace_folder", lambda s, a, b: (moved.append(b), real(s, a, b)))
    for name in ("write_table", "materialise"):
        monkeypatch.setattr(star_queries, name, lambda *a, **k: copied.append(a))
    rows = star_queries.stream_restarted(spark, small)
    assert [path[-1] for path in moved] == ["0", "2", "1", "3"] and not copied
    assert rows.count() == star_queries.Star(spark, small).students().count()


def test_names_are_attached_to_groups_before_scores(spark, small):
    star = star_queries.Star(spark, small)
    raw = star.raw
    plain = star_queries.extract_city(raw.raw_city_scores(), raw.city_directory(), raw.dictionary())
    found = star.extracted_city_scores()
    assert found.columns == plain.columns and same(found, plain)


def test_columns_that_follow_from_others_do_not_travel(spark):
    events = spark.createDataFrame([(2024, "355030", "1", 1.0)], "ano int, id_municipio string, id_aluno string, proficiencia_saeb double")
    plan = optimised_plan(standardise_entity(events, SPEC, rebalance=True))
    above, below = plan.split("RebalancePartitions")
    for name in ("proficiencia_saeb_ausente", "_silver_processed_at"):
        assert name in above and name not in below


def figures(spark):
    cities = spark.createDataFrame([(str(i), f"n{i}", "SP" if i % 2 else "RJ") for i in range(6)], "id_municipio string, nome_municipio string, sigla_uf string")
    states = spark.createDataFrame([("SP", "s"), ("RJ", "r")], "sigla_uf string, nome_uf string")
    targets = spark.range(24).select(
        (F.col("id") % 2 + 2023).cast("int").alias("ano"),
        (F.col("id") % 7).cast("string").alias("id_municipio"),
        F.col("id").cast("string").alias("rede"),
        F.lit(50.0).alias("meta_alfabetizacao"),
        F.col("id").cast("double").alias("resultado_alfabetizacao"),
        F.lit(1.0).alias("percentual_participacao"),
        F.lit("1").alias("nivel_alfabetizacao"),
    )
    level = targets.select("ano", "rede", "meta_alfabetizacao", "resultado_alfabetizacao")
    return [targets, cities, states, level.withColumn("sigla_uf", F.lit("SP")), level]


def test_rows_are_rebalanced_before_figures_repeat_them(spark):
    inputs = figures(spark)
    plain = integrate(*inputs, LAYOUT, audit=False)
    dealt = integrate(*inputs, LAYOUT, audit=False, rebalance=True)
    assert dealt.columns == plain.columns and same(dealt, plain)
    lines = optimised_plan(dealt).split("\n")
    depth = next(line.index("Rebalance") for line in lines if "RebalancePartitions" in line)
    above = [line for line in lines if "Join LeftOuter" in line and line.index("Join") < depth]
    assert len(above) == 3 and "RebalancePartitions" not in optimised_plan(plain)


def test_marts_of_integrated_rows_are_written_as_their_files_come(spark, tmp_path, monkeypatch):
    integrated = integrate(*figures(spark), LAYOUT, audit=False)
    write_table(integrated, str(tmp_path / "i"), [LAYOUT.year])
    stored = read_table(spark, str(tmp_path / "i"), schema=integrated.schema).select(*integrated.columns)
    written = {}
    real = lakehouse.publish_table

    def publish(df, path, by, rebalance=True):
        written[path.rsplit("/", 1)[1]] = rebalance
        return real(df, path, by, rebalance=rebalance)

    monkeypatch.setattr(lakehouse, "publish_table", publish)
    lake = Lakehouse(str(tmp_path / "lake"))
    marts = run_marts(stored, LAYOUT, lake)
    assert {n for n, rebalance in written.items() if not rebalance} == {
        "gold_indicador_municipio", "gold_comparacao_metas", "gold_dashboard"
    }
    for name in ("gold_indicador_municipio", "gold_comparacao_metas", "gold_dashboard"):
        assert same(marts[name], MARTS[name](stored, LAYOUT)), name
        files = list((tmp_path / "lake" / "gold" / name).rglob("*.parquet"))
        assert len(files) <= len(list((tmp_path / "i").rglob("*.parquet"))), name
