"""Reports as files, metrics and alarms."""

import json
import os
from datetime import datetime, timezone

from gaugeworks.plans.monitor import AlarmRule, evaluate_alarms, report_metrics
from gaugeworks.sources.reports import read_reports


def write(folder, name, document):
    (folder / name).write_text(json.dumps(document, indent=2, ensure_ascii=False))


def test_pretty_printed_reports_with_missing_fields(spark, tmp_path):
    checks = [{"regra": "a", "status": "OK"}, {"regra": "b", "status": "ALERTA"}]
    write(
        tmp_path,
        "uf_20240102T030405.json",
        {"entidade": "uf", "status_geral": "ALERTA", "checks": checks},
    )
    write(tmp_path, "odd.json", {"other": 1})
    reports = {r.entidade: r for r in read_reports(spark, str(tmp_path), True).collect()}
    assert reports["uf"].reported_at == datetime(2024, 1, 2, 3, 4, 5)
    odd = reports["odd.json"]
    assert (odd.status_geral, odd.checks) == ("DESCONHECIDO", [])
    written = datetime.fromtimestamp((tmp_path / "odd.json").stat().st_mtime, timezone.utc)
    assert abs((odd.reported_at - written.replace(tzinfo=None)).total_seconds()) < 2
    metrics = report_metrics(read_reports(spark, str(tmp_path), True))
    got = {(r.entidade, r.metrica): r.valor for r in metrics.collect()}
    assert got == {
        ("uf", "QualityCheckAlerts"): 1,
        ("uf", "PipelineRunStatus"): 1,
        ("odd.json", "QualityCheckAlerts"): 0,
        ("odd.json", "PipelineRunStatus"): 1,
    }


def test_an_undated_report_raises_its_alarm(spark, tmp_path):
    write(tmp_path, "uf.json", {"entidade": "uf", "status_geral": "ALERTA", "checks": []})
    at = datetime(2024, 5, 6, 7, 30, tzinfo=timezone.utc).timestamp()
    os.utime(tmp_path / "uf.json", (at, at))
    alarms = evaluate_alarms(report_metrics(read_reports(spark, str(tmp_path), True))).collect()
    raised = [(r.entidade, r.inicio) for r in alarms if r.em_alarme]
    assert raised == [("uf", datetime(2024, 5, 6, 7, 0))]


def metrics(spark):
    rows = [
        ("uf", datetime(2024, 1, 1, 0, 10), "QualityCheckAlerts", 2),
        ("uf", datetime(2024, 1, 1, 0, 50), "QualityCheckAlerts", 2),
        ("uf", datetime(2024, 1, 1, 1, 0), "QualityCheckAlerts", 3),
        ("uf", datetime(2024, 1, 1, 0, 10), "PipelineRunStatus", 0),
        ("uf", datetime(2024, 1, 1, 0, 50), "PipelineRunStatus", 1),
        ("uf", datetime(2024, 1, 1, 1, 0), "PipelineRunStatus", 0),
    ]
    return spark.createDataFrame(
        rows, "entidade string, reported_at timestamp_ntz, metrica string, valor int"
    )


def test_hourly_alarms(spark):
    got = {
        (r.alarme, r.inicio.hour): (r.estatistica, r.em_alarme)
        for r in evaluate_alarms(metrics(spark)).collect()
    }
    assert got == {
        ("Qualidade-Com-Alerta", 0): (1.0, True),
        ("Qualidade-Com-Alerta", 1): (0.0, False),
        ("Muitos-Alertas-Qualidade", 0): (4.0, True),
        ("Muitos-Alertas-Qualidade", 1): (3.0, False),
    }


def test_rules_with_their_own_period(spark):
    rule = AlarmRule("daily", "QualityCheckAlerts", "sum", 6, "1 day")
    row = evaluate_alarms(metrics(spark), (rule,)).collect()
    assert [(r.alarme, r.estatistica, r.em_alarme) for r in row] == [("daily", 7.0, True)]
