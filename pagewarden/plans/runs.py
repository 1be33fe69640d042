"""Crawl runs: what a run's history says by role, the run before it, its record's close, and reports that are read again."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.urls import prepared
from . import report
from .relational import latest, untrusted_hosts

_COUNTERS = ("claimed", "lease_expired")


def by_role(history: DataFrame, urls: DataFrame, run_id: str | None = None) -> DataFrame:
    """A run's history (or all of it) with each URL's host and whether it is an index page."""
    rows = history if run_id is None else history.where(F.col("run_id") == run_id)
    of = urls.select(F.col("id").alias("url_id"), F.col("host_key").alias("host"), (F.col("role") == "index").alias("index"), F.col("status").alias("url_status"))
    return rows.drop("host").join(of, "url_id")


def role_stats(rows: DataFrame) -> DataFrame:
    """One row for each role and host with the counts of a report, in one aggregation."""
    r = F.col("outcome") == "response"
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return rows.groupBy("index", "host").agg(
        F.count("*").alias("fetched"), n(r).alias("responses"), n(r & (F.col("http_status") == 200)).alias("ok"),
        n(r & (F.col("http_status") == 304)).alias("not_modified"), n(F.col("observation") == "not_found").alias("not_found"),
    )


def failed_final(rows: DataFrame) -> DataFrame:
    """How many URLs a run touched that have failed for good."""
    return rows.where("url_status = 'failed_final'").agg(F.count_distinct("url_id").alias("failed_final"))


def previous_runs(runs: DataFrame, history: DataFrame) -> DataFrame:
    """(id, previous): for each run the last one that began before it, was finished and fetched something; null without one.

    Runs are few (one a week); the window is over their distinct starts, so it is one small task by intent. Runs that began
    at the same moment are not before one another."""
    fetched = history.select(F.col("run_id").alias("id")).distinct().withColumn("_any", F.lit(True))
    rows = runs.join(fetched, "id", "left")
    counts = F.when(F.col("finished_at").isNotNull() & F.col("_any"), F.struct("started_at", "id"))
    moments = rows.groupBy("started_at").agg(F.max(counts).alias("best"))
    earlier = moments.select("started_at", F.max("best").over(W.orderBy("started_at").rowsBetween(W.unboundedPreceding, -1)).alias("p"))
    return rows.select("id", "started_at").join(earlier, "started_at").select("id", F.col("p.id").alias("previous"))


def latest_run(runs: DataFrame) -> DataFrame:
    return runs.orderBy(F.desc("started_at"), F.desc("id")).limit(1)


def latest_declarations(history: DataFrame, urls: DataFrame) -> DataFrame:
    """(host, page, declared): each URL's last declared canonical URL, unreadable ones left out."""
    last = latest(history.where("declared_canonical_url IS NOT NULL").select("url_id", "fetched_at", "declared_canonical_url"), "url_id", "fetched_at", "declared_canonical_url")
    pages = urls.select(F.col("id").alias("url_id"), F.col("host_key").alias("host"), F.col("normalized_url").alias("page"))
    rows = last.join(pages, "url_id").withColumn("p", prepared("declared_canonical_url"))
    return rows.where("p.normalized IS NOT NULL AND p.rejection IS NULL").select("host", "page", F.col("p.normalized").alias("declared"))


def distrusted(history: DataFrame, urls: DataFrame) -> DataFrame:
    """Hosts whose declarations in the history are not believed, with the reason."""
    return untrusted_hosts(latest_declarations(history, urls))


# ---- the record of a run ---------------------------------------------------------------------------------------------


def collect(history: DataFrame, urls: DataFrame, run_id: str, now: Column, counters: dict | None = None) -> dict:
    """A run's stats as plain data: by host for pages and index pages, and totals. A host's row is the unit of its size."""
    rows = by_role(history, urls, run_id).cache()
    try:
        hosts: dict[str, dict] = {"hosts": {}, "index_hosts": {}}
        for r in role_stats(rows).collect():
            hosts["index_hosts" if r["index"] else "hosts"][r["host"]] = {k: r[k] for k in ("fetched", "responses", "ok", "not_modified", "not_found")}
        spread, queue = report.percentiles(rows).first(), report.queue_state(urls, now).first()
        return hosts | {
            "response_ms_p50": spread.p50, "response_ms_p95": spread.p95, "failed_final": failed_final(rows).first()[0],
            "queue_due": queue.depth, "queue_oldest_wait_secs": queue.oldest_wait_s,
        } | {k: (counters or {}).get(k) for k in _COUNTERS}
    finally:
        rows.unpersist()


def stats_of(text: str) -> dict:
    """Saved stats, with what an older run did not save at its default."""
    return {"hosts": {}, "index_hosts": {}, "response_ms_p50": None, "response_ms_p95": None, "failed_final": 0, "queue_due": 0, "queue_oldest_wait_secs": None, "claimed": None, "lease_expired": None} | json.loads(text)


def alerts_for(runs: DataFrame, history: DataFrame, urls: DataFrame, run_id: str, claimed: int = 0, lease_expired: int = 0) -> DataFrame:
    """A run's alerts against the run before it, counted anew from the history so that both follow the same rules."""
    before = previous_runs(runs, history).where(F.col("id") == run_id).first()
    stats = lambda r: report.host_stats(by_role(history, urls, r).where("NOT index"))
    previous = stats(before.previous) if before and before.previous else None
    pages = urls.where("role <> 'index'").select(F.col("id").alias("url_id"), F.col("host_key").alias("host"))
    changes = report.content_changes(history.drop("host").join(pages, "url_id"), F.lit(run_id))
    return report.alerts(stats(run_id), previous, changes, claimed, lease_expired)


def closed(runs: DataFrame, run_id: str, stats: dict, alerts: list[dict], now: Column) -> DataFrame:
    """The runs with one of them finished: its end, stats and alerts in one change."""
    this = F.col("id") == run_id
    values = {"finished_at": now, "stats": F.lit(json.dumps(stats)), "alerts": F.lit(json.dumps(alerts))}
    return runs.select(*[F.when(this, values[c]).otherwise(F.col(c)).cast(runs.schema[c].dataType).alias(c) if c in values else F.col(c) for c in runs.columns])


def load(runs: DataFrame, history: DataFrame, urls: DataFrame, now: Column, run_id: str | None = None) -> dict:
    """A run's report: what was saved, otherwise counted anew (without counters); the last run's without an id."""
    found = (latest_run(runs) if run_id is None else runs.where(F.col("id") == run_id)).first()
    if found is None:
        raise LookupError("no such run")
    stats = stats_of(found.stats) if found.stats else collect(history, urls, found.id, now)
    alerts = json.loads(found.alerts) if found.alerts else [r.asDict() for r in alerts_for(runs, history, urls, found.id).collect()]
    took = int((found.finished_at - found.started_at).total_seconds()) if found.finished_at else None
    return {"id": found.id, "kind": found.kind, "started_at": str(found.started_at), "duration_secs": took, "config": json.loads(found.config) if found.config else None, "stats": stats, "alerts": alerts}


def markdown(loaded: dict) -> str:
    """A loaded report as Markdown: the run, its totals, pages and index pages by host, alerts."""
    s = loaded["stats"]
    shown = lambda x: "—" if x is None else str(x)
    lines = [f"# Run report: {loaded['kind']}", "", f"Run {loaded['id']}, started {loaded['started_at']}, took {shown(loaded['duration_secs'])} s.", ""]
    lines += ["| | |", "|-|-|"] + [f"| {k} | {shown(s[k])} |" for k in ("response_ms_p50", "response_ms_p95", "failed_final", "queue_due", "queue_oldest_wait_secs", *_COUNTERS)]
    for title, key in (("Pages", "hosts"), ("Index pages", "index_hosts")):
        rows = sorted(s[key].items())
        total = {k: sum(v[k] for _, v in rows) for k in ("fetched", "responses", "ok", "not_modified", "not_found")}
        lines += ["", f"## {title}", "", "| host | fetched | responses | read | not modified | not found |", "|-|-|-|-|-|-|"]
        lines += [f"| {h} | {v['fetched']} | {v['responses']} | {v['ok']} | {report.percent(v['not_modified'] / (v['ok'] + v['not_modified']) if v['ok'] + v['not_modified'] else None)} | {v['not_found']} |" for h, v in [*rows, ("all", total)]]
    lines += ["", "## Alerts", ""]
    lines += [f"- {a['kind']}" + (f" at {a['host']}" if a.get("host") else "") + (f": {a['count']}" if a.get("count") is not None else "") + (f" ({report.percent(a['rate'])})" if a.get("rate") is not None else "") for a in loaded["alerts"]] or ["None."]
    return "\n".join(lines) + "\n"
