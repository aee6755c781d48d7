"""Versions: conflicts, failures at any step, growing streams, merged tables and reports."""

import json

import pytest
from pyspark.sql import functions as F

from gaugeworks.domains.education import EDUCATION, STUDENT_EVENT
from gaugeworks.operators.quality import quality_suite
from gaugeworks.plans import lakehouse, publication
from gaugeworks.plans.monitor import evaluate_alarms, report_metrics
from gaugeworks.plans.publication import PublishedLake
from gaugeworks.sources import snapshots
from gaugeworks.sources.reports import read_reports, write_documents
from gaugeworks.sources.snapshots import SnapshotLog, TableSet
from gaugeworks.sources.tables import write_table
from gaugeworks.streaming import reports as report_streams
from gaugeworks.streaming import tables
from gaugeworks.streaming.students import merge_batches, read_stream_table, store_micro_batch
from gaugeworks.streaming.tables import StreamSink
from plan_text import executed_plan
from test_lakehouse import raw  # noqa: F401
from test_stream import SPEC, clean, event, payloads, plain


def test_a_version_is_made_once(spark, tmp_path):
    log = SnapshotLog(str(tmp_path))
    assert log.latest(spark) == (-1, {})
    assert log.commit(spark, 0, {"a": 1}) and not log.commit(spark, 0, {"a": 2})
    assert log.latest(spark) == (0, {"a": 1})
    calls = []

    def change(content):
        calls.append(content)
        if len(calls) == 1:  # another writer is first
            log.commit(spark, 1, {"a": 5})
        return {"a": content["a"] + 1}

    assert log.update(spark, change) == 2 and log.latest(spark) == (2, {"a": 6})
    assert log.update(spark, lambda c: None) == 2
    log.expire(spark, 1, lambda c: [])
    assert log.versions(spark) == [2]
    assert [p.name for p in (tmp_path / "_versions").iterdir() if p.suffix == ".json"] == ["000000000002.json"]


def test_tables_change_together_whatever_fails(spark, tmp_path, monkeypatch):
    tables = TableSet(str(tmp_path))
    frames = lambda n: {k: spark.range(n).withColumn("k", F.lit(k)) for k in ("a", "b", "c")}
    first = tables.publish(spark, frames(2), {"a": ["k"]})
    write, commit = snapshots.write_table, SnapshotLog.commit
    for step in range(4):
        done = []

        def fail(*args, done=done, step=step):
            done.append(1)
            if step == 3 or len(done) > step:
                raise OSError("stop")
            return write(*args)

        monkeypatch.setattr(snapshots, "write_table", fail if step < 3 else write)
        monkeypatch.setattr(SnapshotLog, "commit", commit if step < 3 else fail)
        with pytest.raises(OSError):
            tables.publish(spark, frames(5))
        monkeypatch.undo()
        assert {n: d.count() for n, d in tables.tables(spark).items()} == dict.fromkeys("abc", 2)
        assert len(list((tmp_path / "_data").iterdir())) == 3
    held = tables.tables(spark)
    tables.publish(spark, {"a": spark.range(7)})
    assert {n: d.count() for n, d in tables.tables(spark).items()} == {"a": 7, "b": 2, "c": 2}
    assert held["a"].count() == 2 and tables.tables(spark, first)["a"].count() == 2
    tables.expire(spark, 1)
    assert len(list((tmp_path / "_data").iterdir())) == 3


def test_another_session_queries_the_published_version(spark, tmp_path):
    tables = TableSet(str(tmp_path))
    frame = spark.sql("SELECT id, CAST(id % 3 AS STRING) AS code FROM range(6)")
    tables.publish(spark, {"mart": frame}, {"mart": ["code"]})
    tables.register(spark, "published_marts")
    other = spark.newSession()
    query = "SELECT code, count(*) AS n FROM published_marts.mart GROUP BY code"
    assert {tuple(r) for r in other.sql(query).collect()} == {("0", 2), ("1", 2), ("2", 2)}
    tables.publish(spark, {"mart": frame.where("id > 2")}, {"mart": ["code"]})
    tables.register(spark, "published_marts")
    assert {tuple(r) for r in other.sql(query).collect()} == {("0", 1), ("1", 1), ("2", 1)}
    spark.sql("DROP DATABASE published_marts CASCADE")


def test_a_run_is_published_whole_or_not_at_all(spark, raw, tmp_path, monkeypatch):  # noqa: F811
    lake = PublishedLake(str(tmp_path))
    version = lake.run(raw, EDUCATION)
    before = {n: d.count() for n, d in lake.tables(spark).items()}
    assert before["gold_evolucao_temporal"] == 2 and before["uf"] == 2
    with pytest.raises(lakehouse.QualityAlert):
        PublishedLake(str(tmp_path), fail_on_alert=True).run(raw, EDUCATION)

    def stop(*args, **kwargs):
        raise OSError("stop")

    monkeypatch.setattr(lakehouse, "run_marts", stop)
    with pytest.raises(OSError):
        lake.run(raw, EDUCATION)
    monkeypatch.setattr(publication.TableSet, "publish_stored", stop)
    monkeypatch.setattr(publication, "run_lakehouse", lambda raw, *a: {"uf": raw["uf"]})
    with pytest.raises(OSError):
        lake.run(raw, EDUCATION)
    monkeypatch.undo()
    assert lake.published.log.latest(spark)[0] == version
    assert {n: d.count() for n, d in lake.tables(spark).items()} == before
    assert len(list((tmp_path / "runs").iterdir())) == 1
    assert read_reports(spark, lake.reports_dir).where("status_geral = 'ALERTA'").count() > 1


def _texts(batch):
    texts = [event(str((batch * 3 + i) % 11), 2024 + i % 2, str(i % 4), serie=f"{batch}-{i}") for i in range(8)]
    return [*texts, event(None, serie="9"), event(str(batch), serie="x"), event(str(batch), city=None)]


def test_parts_stay_few_and_replays_change_nothing(spark, tmp_path):
    sink = StreamSink(str(tmp_path), fanout=3, keep=2)
    schema = clean(spark, []).schema
    for batch in range(20):
        part = sink.batch(spark, "s", batch)
        part.write("rows", clean(spark, [event(str(batch))]), SPEC.partition_by)
        part.commit_parts()
        sink.compact(spark, {"rows": SPEC.partition_by})
        parts = sink.log.latest(spark)[1]["parts"]["rows"]
        assert len(parts) <= 2 * 3
    rows = read_stream_table(spark, sink, "rows", schema)
    found = sorted((r._batch_id, r.id_aluno) for r in rows.collect())
    assert found == [(b, str(b)) for b in range(20)]
    version = sink.log.latest(spark)[0]
    assert all(sink.batch(spark, "s", b) is None for b in range(20))
    assert sink.log.latest(spark)[0] == version
    folders = [p for p in (tmp_path / "rows").iterdir() if p.is_dir()]
    assert len(folders) <= 10  # two versions' parts
    assert sink._full_levels(sink.log.latest(spark)[1]) == []


def test_merged_table_and_report_grow_with_the_batches(spark, tmp_path):
    sink = StreamSink(str(tmp_path), fanout=2, buckets=3)
    events = []
    for stream, batch in (("old", 0), ("old", 7), ("old", 900), ("new", 0), ("old", 901), ("new", 1)):
        texts = _texts(batch % 13)
        events += texts
        for _ in range(2):  # each is replayed
            store_micro_batch(payloads(spark, texts), batch, sink, stream, SPEC, STUDENT_EVENT)
        rows = read_stream_table(spark, sink, "rows", clean(spark, []).schema)
        whole = merge_batches(rows, SPEC)
        merged = sink.read_merged(spark, whole.schema)
        assert plain(merged) == plain(whole)
    # the new stream comes after the old one, whatever the numbers of their batches
    assert {r.serie for r in whole.where("id_aluno = '0' AND ano = 2024").collect()} == {
        r.serie for r in rows.where("id_aluno = '0' AND ano = 2024 AND _stream = 'new'").orderBy(F.col("_order").desc(), "serie").limit(1).collect()
    }
    source = report_events(spark, events)
    stored = rows.drop("_stream", "_batch_id", "_order")
    expected = quality_suite(stored, SPEC, source=source)
    assert plain(sink.read_report(spark)) == plain(expected)


def report_events(spark, texts):
    from gaugeworks.streaming.students import decode_events

    return decode_events(payloads(spark, texts), STUDENT_EVENT)


def test_a_version_of_another_stream_makes_a_batch_merge_again(spark, tmp_path, monkeypatch):
    sink = StreamSink(str(tmp_path), buckets=2)
    commit, raced = SnapshotLog.commit, []

    def race(self, session, version, content):
        if content["streams"].get("a", {}).get("last") == 0 and not raced:
            raced.append(1)
            store_micro_batch(payloads(spark, [event("1", serie="b")]), 0, sink, "b", SPEC, STUDENT_EVENT)
        return commit(self, session, version, content)

    monkeypatch.setattr(SnapshotLog, "commit", race)
    store_micro_batch(payloads(spark, [event("1", serie="a"), event("2", serie="a")]), 0, sink, "a", SPEC, STUDENT_EVENT)
    rows = read_stream_table(spark, sink, "rows", clean(spark, []).schema)
    whole = merge_batches(rows, SPEC)
    assert plain(sink.read_merged(spark, whole.schema)) == plain(whole) and whole.count() == 2
    report = {r.regra: r.violacoes for r in sink.read_report(spark).where("regra = 'duplicidade'").collect()}
    assert report == {"duplicidade": 1}


def test_batches_wait_and_are_merged_together(spark, tmp_path):
    sink = StreamSink(str(tmp_path), fanout=3, buckets=2)
    buckets = []
    for batch in range(7):
        texts = [event(str(i), serie=str(batch)) for i in range(batch, batch + 5)]
        store_micro_batch(payloads(spark, [*texts, event(None)]), batch, sink, "s", SPEC, STUDENT_EVENT)
        content = sink.log.latest(spark)[1]
        buckets.append(sorted(content.get("merged", {}).values()))
        assert len(content["waiting"]) == (batch + 1) % 3
        rows = read_stream_table(spark, sink, "rows", clean(spark, []).schema)
        whole = merge_batches(rows, SPEC)
        assert plain(sink.read_merged(spark, whole.schema)) == plain(whole)
        repeated = sink.read_report(spark).where("regra = 'duplicidade'").first().violacoes
        assert repeated == 5 * (batch + 1) - (batch + 5)
    # a batch rewrites nothing by itself: buckets change with every third one
    assert buckets[0] == buckets[1] == [] and buckets[2] == buckets[4] and buckets[5] == buckets[6] != buckets[4]
    assert set(content["parts"]) == {"rows", "rejected", "rejected_rows", "quality"}
    merged = executed_plan(merge_batches(rows, SPEC))
    assert merged.count("Exchange hashpartitioning") == 1


REPORT = (
    "entidade string, status_geral string, reported_at timestamp_ntz,"
    " checks array<struct<regra: string, coluna: string, status: string>>"
)


def documents(spark, rows):
    texts = [
        (json.dumps({"entidade": e, "status_geral": s, "reported_at": t, "checks": [{"regra": "r", "status": c} for c in cs]}),)
        for e, s, t, cs in rows
    ]
    return spark.createDataFrame(texts, "value string").select(F.from_json("value", REPORT).alias("d")).select("d.*")


RUNS = [
    [("a", "ALERTA", "2024-05-01T10:05:00", ["ALERTA"] * 2), ("b", "OK", "2024-05-01T11:00:00", ["OK"])],
    [("a", "ALERTA", "2024-05-01T10:55:00", ["ALERTA"] * 2), ("a", "OK", "2024-05-01T09:00:00", ["OK"])],
    [("b", "ALERTA", "2024-04-30T23:59:59", ["ALERTA", "OK"]), ("b", "OK", "2024-05-01T11:30:00", [])],
]


def test_each_report_is_published_once(spark, tmp_path):
    folder, sink, checkpoint = str(tmp_path / "reports"), StreamSink(str(tmp_path / "metrics"), fanout=2), str(tmp_path / "cursor")
    assert report_streams.publish_new_reports(spark, folder, sink, checkpoint).count() == 0
    for i, run in enumerate(RUNS):
        write_documents(documents(spark, run), f"{folder}/run_id={i}")
        new = report_streams.publish_new_reports(spark, folder, sink, checkpoint)
        assert new.count() == 2 * len(run)
        assert report_streams.publish_new_reports(spark, folder, sink, checkpoint).count() == 0
    every = report_streams.read_metrics(spark, sink).drop("_stream", "_batch_id", "_order")
    assert plain(every) == plain(report_metrics(read_reports(spark, folder)))


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0), (1, 2, 0)])
def test_alarms_of_a_stream_equal_the_batch_in_any_order(spark, tmp_path, order):
    folder, sink, checkpoint = str(tmp_path / "reports"), StreamSink(str(tmp_path / "alarms"), fanout=2), str(tmp_path / "cursor")
    for i in order:
        write_documents(documents(spark, RUNS[i]), f"{folder}/run_id={i}")
        alarms = report_streams.run_alarm_stream(spark, folder, sink, checkpoint, "30 days")
        assert plain(alarms) == plain(evaluate_alarms(report_metrics(read_reports(spark, folder))))
    assert {(r.entidade, r.alarme) for r in alarms.where("em_alarme").collect()} >= {("a", "Muitos-Alertas-Qualidade")}


def test_levels_that_become_full_together_are_rewritten_once(spark, tmp_path, monkeypatch):
    sink, rewritten = StreamSink(str(tmp_path), fanout=2), []
    monkeypatch.setattr(tables, "write_table", lambda df, *a: (rewritten.append(df.count()), write_table(df, *a)))
    for batch in range(4):
        part = sink.batch(spark, "s", batch)
        write_table(part._origin(clean(spark, [event(str(batch))])), part.folder("rows"), SPEC.partition_by)
        part.kinds.append("rows")
        part.commit_parts()
        sink.compact(spark, {"rows": SPEC.partition_by})
    assert rewritten == [2, 4]  # and not 2, 2, 4
    parts = sink.log.latest(spark)[1]["parts"]["rows"]
    assert [p["level"] for p in parts] == [2]
    rows = read_stream_table(spark, sink, "rows", clean(spark, []).schema).collect()
    assert sorted((r._batch_id, r.id_aluno) for r in rows) == [(b, str(b)) for b in range(4)]
