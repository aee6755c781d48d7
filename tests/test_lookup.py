"""Decoding and directories."""

from pyspark.sql import functions as F

from gaugeworks.operators.lookup import attach_directory, decode_codes
from plan_text import executed_plan


def dictionary(spark):
    return spark.createDataFrame(
        [
            ("alunos", "rede", "1", "Federal"),
            ("alunos", "rede", "1", "Federal"),
            ("alunos", "rede", "2", "Zulu"),
            ("alunos", "rede", "2", "Alfa"),
            ("uf", "rede", "3", "Outra"),
            ("alunos", "serie", "2", "2° ano"),
        ],
        ["id_tabela", "nome_coluna", "chave", "valor"],
    )


def facts(spark):
    return spark.createDataFrame(
        [(10, 1, "2"), (11, 2, "x"), (12, 3, None), (13, None, "2")], "id int, rede int, serie string"
    )


def expected():
    return [(10, "Federal", "2° ano"), (11, "Alfa", None), (12, None, None), (13, None, "2° ano")]


def test_codes_become_labels_without_multiplying_rows(spark):
    df = decode_codes(facts(spark), dictionary(spark), "alunos", ["rede", "serie"])
    assert df.columns == ["id", "rede", "serie"]
    assert executed_plan(df).count("BroadcastHashJoin") == 2
    assert sorted((tuple(r) for r in df.collect()), key=str) == expected()


def test_labels_too_large_to_broadcast_are_joined(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = decode_codes(facts(spark), dictionary(spark), "alunos", ["rede", "serie"])
        assert sorted((tuple(r) for r in df.collect()), key=str) == expected()
        plan = executed_plan(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_a_constant_code_is_joined_by_key_and_labels_come_ready(spark):
    df = facts(spark).withColumn("serie", F.lit("2")).withColumn("rede", F.lit(1))
    decoded = decode_codes(df, dictionary(spark), "alunos", ["rede", "serie"])
    plan = executed_plan(decoded)
    assert "NestedLoop" not in plan and "Aggregate" not in plan
    assert {(r.rede, r.serie) for r in decoded.collect()} == {("Federal", "2° ano")}


def test_directory_rows_are_distinct(spark):
    directory = spark.createDataFrame(
        [(1, "One", "SP"), (1, "One", "SP"), (2, "Two", "RJ")], ["code", "nome", "uf"]
    )
    df = spark.createDataFrame([(1, "a"), (3, "b"), (None, "c")], "city int, v string")
    got = attach_directory(df, directory, "city", "code", {"nome": "city_name", "uf": "state"})
    assert got.columns == ["city", "v", "city_name", "state"]
    assert {tuple(r) for r in got.collect()} == {
        (1, "a", "One", "SP"), (3, "b", None, None), (None, "c", None, None),
    }
