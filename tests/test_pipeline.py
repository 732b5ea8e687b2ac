"""Whole runs, their metrics and settings."""

import json

import pytest
from pyspark.sql import functions as F

from tests.test_feeds import envelope, write
from weftline.plans.config import RunConfig, bounded_int, flag
from weftline.plans.pipeline import audit_report, ingest, last_stage, report, task_usage
from weftline.sinks.documents import SinkError
from weftline.sources.feeds import FeedError


def folders(tmp_path, persons, orgs):
    for name, files in (("person", persons), ("organization", orgs)):
        (tmp_path / name).mkdir()
        for i, lines in enumerate(files):
            write(tmp_path / name / f"part-{i}.json.gz", *lines)
    return RunConfig(str(tmp_path / "person"), str(tmp_path / "organization"), str(tmp_path / "out"))


def metrics(tmp_path):
    return json.loads((tmp_path / "out/metrics.json").read_text())


def test_a_run(spark, tmp_path):
    persons = [[envelope(i, roles=[{"organization_id": 8}, {"organization_id": 999}, {}]) for i in range(k, k + 20)] for k in (0, 100)]
    config = folders(tmp_path, persons, [[envelope(8, name="h")], [envelope(3, name="c")]])
    done = ingest(spark, config)
    assert (done["persons"], done["roles"], done["resolved_org_refs"], done["unresolved_org_refs"], done["organizations"], done["indexed"]) == (40, 120, 40, 40, 2, 40)
    assert metrics(tmp_path)["status"] == "completed" and "persons_per_second" in report(str(tmp_path / "out/metrics.json"))
    doc = json.loads(spark.read.parquet(str(tmp_path / "out/documents")).where("id = 105").head().doc)
    assert doc["organizations"] == [{"forager_id": 8, "name": "h"}] and doc["unresolved_organization_ids"] == [999]
    with pytest.raises(Exception):
        ingest(spark, config)
    assert ingest(spark, RunConfig(config.persons, config.organizations, config.out, reset=True))["persons"] == 40


@pytest.mark.parametrize(
    "persons,orgs,error,message",
    [
        ([[envelope(1), "{secret"]], [[envelope(8)]], FeedError, "part-0.json.gz:2: malformed JSON record"),
        ([[envelope(1)]], [[envelope(8)], [envelope(8)]], FeedError, "duplicate organization id 8"),
        ([[envelope(1, roles=[{"organization_id": "8"}])]], [[envelope(8)]], FeedError, "part-0.json.gz:1: a role's organization_id"),
        ([[envelope(1, m="first")], [envelope(1, m="second")]], [[envelope(8)]], SinkError, "count mismatch: sink=1, acknowledged=2"),
    ],
)
def test_failed_runs(spark, tmp_path, persons, orgs, error, message):
    with pytest.raises(error, match=message):
        ingest(spark, folders(tmp_path, persons, orgs))
    held = metrics(tmp_path)
    assert held["status"] == "failed" and held["persons_per_second"] == 0 and "secret" not in json.dumps(held)
    with pytest.raises(ValueError):
        report(str(tmp_path / "out/metrics.json"))


def test_settings(monkeypatch, tmp_path, spark):
    assert bounded_int("x", " 5 ", 1, 9) == 5 and flag("x", "1") and not flag("x", False)
    for bad in ("", "x", "0", "10", "5.0"):
        with pytest.raises(ValueError, match="^x must be"):
            bounded_int("x", bad, 1, 9)
    with pytest.raises(ValueError):
        flag("x", "yes")
    with pytest.raises(ValueError):
        RunConfig("", "o", "out")
    monkeypatch.setenv("WEFTLINE_PERSONS", "p")
    monkeypatch.setenv("WEFTLINE_BULK_DOCS", "7")
    c = RunConfig.from_env(organizations="o", out="x", persons=None)
    assert (c.persons, c.bulk_docs, c.reset) == ("p", 7, False)
    audit_report({"a": spark.range(2)}, str(tmp_path / "a.json"))
    assert json.loads((tmp_path / "a.json").read_text()) == {"a": [{"id": 0}, {"id": 1}]}


def test_usage_counts_only_later_stages(spark):
    spark.range(1000, numPartitions=2).selectExpr("sum(id)").collect()
    at = last_stage(spark)
    assert set(task_usage(spark, at).values()) == {0}
    spark.range(1000, numPartitions=2).groupBy((F.col("id") % 7).alias("k")).count().collect()
    used = task_usage(spark, at)
    assert used["task_seconds"] > 0 and used["shuffle_bytes"] > 0 and last_stage(spark) > at


def test_event_log(spark, tmp_path, capsys):
    config = folders(tmp_path, [[envelope(i) for i in range(3)]], [[envelope(8, name="h")]])
    done = ingest(spark, config)
    events = [json.loads(line) for line in capsys.readouterr().err.splitlines() if line.startswith('{"event"')]
    assert [e["event"] for e in events] == ["organization_stage_started", "organization_stage_complete", "person_stage_started", "persons_enriched", "documents_written", "pipeline_complete"]
    assert events[1]["organizations"] == 1 and events[4]["indexed"] == 3 and events[-1] == {"event": "pipeline_complete"} | done
    with pytest.raises(Exception):
        ingest(spark, config)  # the documents are there already
    assert json.loads(capsys.readouterr().err.splitlines()[-1])["event"] == "pipeline_failed"
