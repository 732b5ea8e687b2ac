"""A full run: both feeds are validated, persons are enriched and written, counts are reconciled, metrics kept."""

from __future__ import annotations

import json
import math
import os
import sys
import time
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.enrich import enrich_parts, totals
from weftline.plans.config import RunConfig
from weftline.plans.runtime import settle
from weftline.sinks.documents import MAX_DOC_BYTES, SinkError, write_metrics, write_table
from weftline.sinks.index import SearchIndex, index_body, send_documents
from weftline.sources.feeds import FeedError, demand_unique, demand_valid, envelopes, feed_files, feed_lines


def log(event: str, **values) -> None:
    """A line of the run's event log, as JSON on standard error."""
    print(json.dumps({"event": event, **values}, default=str), file=sys.stderr, flush=True)


def load_feed(spark: SparkSession, path: str, kind: str, *, parts: bool = False) -> DataFrame:
    """A feed's validated envelopes (file, line, bytes, id, body; see envelopes for parts), settled, so that no file is read and parsed twice."""
    return demand_valid(settle(envelopes(feed_lines(spark, feed_files(spark, path)), kind, parts=parts)))


def known_stages(spark: SparkSession) -> list:
    """The stages that the session still knows: the last ones, spark.ui.retainedStages of them (1,000 unless set)."""
    sc = spark.sparkContext
    known = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return [known.apply(i) for i in range(known.size())]


def last_stage(spark: SparkSession) -> int:
    return max((x.stageId() for x in known_stages(spark)), default=-1)


def task_usage(spark: SparkSession, after: int = -1) -> dict[str, float]:
    """What the tasks of stages after this one have used, over all executors: seconds, and bytes read and shuffled."""
    stages = [x for x in known_stages(spark) if x.stageId() > after]
    return {
        "task_seconds": sum(x.executorRunTime() for x in stages) / 1000,
        "cpu_seconds": sum(x.executorCpuTime() for x in stages) / 1e9,
        "gc_seconds": sum(x.jvmGcTime() for x in stages) / 1000,
        "input_bytes": sum(x.inputBytes() for x in stages),
        "shuffle_bytes": sum(x.shuffleWriteBytes() for x in stages),
    }


def ingest(spark: SparkSession, config: RunConfig) -> dict:
    """Runs an ingest and returns its metrics, which are also kept in out/metrics.json, running, failed or completed.

    With bulk_url the documents also go into a search index, which must not exist unless reset, is created with its mapping
    first, and at the end must count what was acknowledged. Everything is validated before any document is written. The first bad line, a repeated organization, a document over 32
    MiB or a count that doesn't match ends the run; messages name files, lines and ids, never content.
    """
    metrics: dict = {"status": "running", "started": datetime.now(UTC).isoformat()}
    began = time.monotonic()
    local = "://" not in config.out  # a run on remote storage keeps its metrics only in what it returns
    if local:
        os.makedirs(config.out, exist_ok=True)

    def keep() -> None:
        if local:
            write_metrics(f"{config.out}/metrics.json", metrics)

    keep()
    before = last_stage(spark)
    index = SearchIndex(config.bulk_url, config.bulk_index)
    try:
        if config.bulk_url:
            index.create(index_body(shards=config.index_shards), reset=config.reset)
        log("organization_stage_started")
        orgs = demand_unique(load_feed(spark, config.organizations, "organization"), "organization")
        size = orgs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("b"), F.coalesce(F.max("bytes"), F.lit(0)).alias("m")).head()
        metrics |= {"organizations": size.n, "organization_raw_bytes": size.b, "organization_max_raw_bytes": size.m, "stage_seconds": time.monotonic() - began}
        keep()
        log("organization_stage_complete", **{k: v for k, v in metrics.items() if k.startswith(("organization", "stage"))})
        at = time.monotonic()
        log("person_stage_started")
        persons = load_feed(spark, config.persons, "person", parts=True)
        docs = settle(enrich_parts(persons, orgs))
        long = docs.where(F.octet_length("doc") + 96 > MAX_DOC_BYTES).select("id").head()
        if long:
            raise SinkError(f"document {long.id} is too long")
        metrics |= totals(docs).head().asDict()
        log("persons_enriched", persons=metrics["persons"], seconds=time.monotonic() - at)
        out = docs.select("id", "doc")
        metrics |= write_table(out, f"{config.out}/documents", reset=config.reset)
        log("documents_written", indexed=metrics["indexed"], seconds=time.monotonic() - at)
        if config.bulk_url:
            figures = send_documents(out, config.bulk_url, config.bulk_index, most_bytes=config.bulk_bytes, most_docs=config.bulk_docs)
            metrics |= {f"bulk_{k}": v for k, v in figures.items()}
            metrics["index_count"] = index.finish(figures["indexed"])
            log("bulk_sent", index=config.bulk_index, seconds=time.monotonic() - at, **figures)
        metrics |= {"person_seconds": time.monotonic() - at, "status": "completed"}
    except Exception as e:
        metrics |= {"status": "failed", "error": str(e) if isinstance(e, (FeedError, SinkError)) else type(e).__name__}
        raise
    finally:
        wall = time.monotonic() - began
        metrics["wall_seconds"] = wall
        metrics |= task_usage(spark, before)
        metrics["persons_per_second"] = metrics.get("persons", 0) / wall if metrics["status"] == "completed" and wall > 0 else 0.0
        keep()
        log("pipeline_complete" if metrics["status"] == "completed" else "pipeline_failed", **metrics)
    return metrics


#: Figures of a completed run, and those that only some runs have.
REPORTED = ("persons", "organizations", "roles", "resolved_org_refs", "unresolved_org_refs", "persons_with_unresolved_orgs", "unresolved_percent", "stage_seconds", "person_seconds", "wall_seconds", "persons_per_second")
ALSO = ("task_seconds", "cpu_seconds", "gc_seconds", "input_bytes", "shuffle_bytes", "bulk_indexed", "bulk_retried", "bulk_requests", "bulk_sent_bytes", "index_count")


def report(path: str) -> str:
    """A run's figures as text; metrics that are missing, not finite or of a run that didn't complete are refused."""
    with open(path) as f:
        metrics = json.load(f)
    if metrics.get("status") != "completed":
        raise ValueError(f"the run is {metrics.get('status', 'unknown')}")
    shown = {name: metrics.get(name) for name in REPORTED} | {name: metrics[name] for name in ALSO if name in metrics}
    wrong = [name for name, x in shown.items() if type(x) not in (int, float) or not 0 <= x < math.inf]
    if wrong:
        raise ValueError(f"{wrong[0]} is missing or no number")
    return "\n".join(f"{name:30} {x:,}" if type(x) is int else f"{name:30} {x:,.3f}" for name, x in shown.items())


MOST_AUDIT_ROWS = 100_000


def audit_report(tables: dict[str, DataFrame], path: str) -> None:
    """Writes audit tables to one JSON file by name; one of more than MOST_AUDIT_ROWS rows is refused."""
    held = {name: t.limit(MOST_AUDIT_ROWS + 1).collect() for name, t in tables.items()}
    long = [name for name, rows in held.items() if len(rows) > MOST_AUDIT_ROWS]
    if long:
        raise ValueError(f"{long[0]} has more than {MOST_AUDIT_ROWS} rows; write it as a table")
    write_metrics(path, {name: [r.asDict(recursive=True) for r in rows] for name, rows in held.items()})
