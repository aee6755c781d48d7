"""The stream: decoding, replay, several batches, parity and rejects."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeworks.domains.education import EDUCATION, STUDENT_EVENT
from gaugeworks.operators.quality import quality_suite
from gaugeworks.operators.standardise import standardise_entity
from gaugeworks.streaming.students import (
    CORRUPT,
    StreamSink,
    decode_events,
    merge_batches,
    query_id,
    read_events,
    read_stream_table,
    start_stream,
    store_micro_batch,
)
from plan_text import executed_plan

SPEC = EDUCATION.specs["dados_alunos"]


def event(student, year=2024, city="355030", **fields):
    return json.dumps({"ano": year, "id_municipio": city, "sigla_uf": "sp", "id_aluno": student, **fields})


def payloads(spark, texts):
    rows = [(bytearray(t.encode()),) if t is not None else (None,) for t in texts]
    return spark.createDataFrame(rows, "data binary")


def clean(spark, texts):
    events = decode_events(payloads(spark, texts), STUDENT_EVENT)
    return standardise_entity(events, SPEC)


def stored_rows(spark, sink):
    schema = clean(spark, []).schema
    return read_stream_table(spark, sink, "rows", schema)


def plain(df):
    names = [c for c in df.columns if not c.startswith("_")]
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


def test_malformed_payloads_and_fields_are_null(spark):
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("s", T.StringType())])
    texts = ['{"k": 1, "s": "a"}', '{"k": "x", "s": "b"}', '{"k": 1', None, '{"other": 5}']
    decoded = decode_events(payloads(spark, texts), schema, corrupt=CORRUPT)
    got = [(r.k, r.s, r[CORRUPT]) for r in decoded.collect()]
    assert got == [
        (1, "a", None),
        (None, "b", texts[1]),
        (None, None, texts[2]),
        (None, None, None),
        (None, None, None),
    ]


def test_filters_do_not_parse_the_text_again(spark):
    plan = executed_plan(clean(spark, [event("1")]))
    assert plan.count("from_json") == 1


def test_replaying_a_batch_changes_nothing(spark, tmp_path):
    sink = StreamSink(str(tmp_path))
    texts = [event("1"), event("1"), event("2", proficiencia=700.5), '{"ano": 1', event("3", city="35503080")]
    for _ in range(2):
        store_micro_batch(payloads(spark, texts), 0, sink, "s", SPEC, STUDENT_EVENT)
    assert stored_rows(spark, sink).count() == 2
    rejected = read_stream_table(
        spark, sink, "rejected", T.StructType([T.StructField("payload", T.StringType())])
    )
    assert [r.payload for r in rejected.collect()] == ['{"ano": 1']
    lost = spark.read.parquet(sink.kind_path("rejected_rows")).collect()
    assert [(r.coluna, r.motivo, r.valor) for r in lost] == [("id_municipio", "chave_invalida", "35503080")]
    assert json.loads(lost[0].linha)["id_aluno"] == "3"


def test_batches_are_kept_apart_and_streams_too(spark, tmp_path):
    for stream, batch, student in (("a", 0, "1"), ("a", 1, "1"), ("b", 0, "2")):
        sink = StreamSink(str(tmp_path))
        store_micro_batch(payloads(spark, [event(student)]), batch, sink, stream, SPEC, STUDENT_EVENT)
    rows = stored_rows(spark, sink)
    got = sorted((r._stream, r._batch_id, r.id_aluno) for r in rows.collect())
    assert got == [("a", 0, "1"), ("a", 1, "1"), ("b", 0, "2")]
    report_schema = quality_suite(clean(spark, []), SPEC).schema
    report = read_stream_table(spark, sink, "quality", report_schema)
    assert report.select("_stream", "_batch_id").distinct().count() == 3
    assert report.filter("regra = 'duplicidade'").agg(F.sum("violacoes")).first()[0] == 0


def test_an_empty_batch_is_stored(spark, tmp_path):
    sink = StreamSink(str(tmp_path))
    store_micro_batch(payloads(spark, ["{", None]), 0, sink, "s", SPEC, STUDENT_EVENT)
    assert stored_rows(spark, sink).count() == 0


@pytest.mark.parametrize("files_per_batch", [1, 100])
def test_merged_batches_equal_the_batch_path(spark, tmp_path, files_per_batch):
    texts = [event(str(i % 7), 2024 + i % 2, str(i % 3), serie=str(i % 5)) for i in range(60)]
    texts += [event(None, serie="9")] * 3  # copies without an id, in several batches
    source = str(tmp_path / "source")
    for part in range(4):  # students are in all parts
        payloads(spark, texts[part::4]).coalesce(1).write.mode("append").parquet(source)
    events = read_events(
        spark,
        "parquet",
        {"pathGlobFilter": "*.parquet", "maxFilesPerTrigger": str(files_per_batch)},
        "data binary",
        source,
    )
    sink = StreamSink(str(tmp_path / "sink"))
    checkpoint = str(tmp_path / "checkpoint")
    for _ in range(2):  # The second run finds nothing new.
        query = start_stream(events, sink, SPEC, STUDENT_EVENT, checkpoint, available_now=True)
        query.awaitTermination()
    streamed = stored_rows(spark, sink)
    assert {r._stream for r in streamed.collect()} == {query_id(spark, checkpoint)}
    batches = streamed.select("_batch_id").distinct().count()
    assert batches == (4 if files_per_batch == 1 else 1)
    assert plain(merge_batches(streamed, SPEC, newest_first=False)) == plain(clean(spark, texts))


def test_a_new_checkpoint_keeps_the_batches_of_the_old_one(spark, tmp_path):
    source = str(tmp_path / "source")
    payloads(spark, [event("1")]).write.parquet(source)
    events = read_events(spark, "parquet", {"pathGlobFilter": "*.parquet"}, "data binary", source)
    sink = StreamSink(str(tmp_path / "sink"))
    for checkpoint in ("one", "two"):
        start_stream(
            events, sink, SPEC, STUDENT_EVENT, str(tmp_path / checkpoint), available_now=True
        ).awaitTermination()
    assert stored_rows(spark, sink).select("_stream").distinct().count() == 2


def test_the_newest_batch_wins_and_the_batch_table_comes_first(spark, tmp_path):
    sink = StreamSink(str(tmp_path))
    for batch, grade in enumerate(("1", "9", "5")):
        texts = [event("2", serie=grade), event(None, serie="x")]
        store_micro_batch(payloads(spark, texts), batch, sink, "s", SPEC, STUDENT_EVENT)
    table = clean(spark, [event("2", serie="0"), event("1", serie="0")])
    both = merge_batches(stored_rows(spark, sink), SPEC, table)
    got = sorted(((r.id_aluno, r.serie) for r in both.collect()), key=str)
    assert got == [("1", "0"), ("2", "5"), (None, "x")]
