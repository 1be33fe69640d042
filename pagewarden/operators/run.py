"""A crawl run: waves of claims, fetches and records until nothing is due, and the run's own record.

A wave claims at most one URL for each host, fetches them all, and records what came of it table by table. Fetches are
written before they are recorded, and every table is a snapshot, so a run that stops can be told from what is there: claims
end with their lease, and a fetch that is recorded again is refused by its token or by its row in the history.
"""

from __future__ import annotations

import json
import os
import socket
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import decisions, html, http
from ..functions import vocab as V
from ..functions.urls import prepared
from ..plans import relational, runs
from . import crawl
from .store import Store

#: Claimed URLs (url_id, url, host_key, etag, last_modified) to rows of schema.FETCHES.
Fetch = Callable[[DataFrame], DataFrame]
_HEADERS = ("etag", "last_modified")


def worker_id() -> str:
    return f"{os.environ.get('HOSTNAME') or socket.gethostname()}-{os.getpid()}"


@dataclass(frozen=True)
class Config:
    kind: str = "full"
    worker: str = field(default_factory=worker_id)
    wave: int = 16
    waves: int = 10_000
    lease_s: int = 600
    ahead_s: int = 0

    def snapshot(self) -> dict:
        return asdict(self)


def read(fetched: DataFrame) -> DataFrame:
    """Fetches with what was read: body_kind, raw_hash, decoded text's charset (d) and, of whole pages only, extraction (e)."""
    kind = http.read_kind(F.col("status"), F.col("content_type"), F.octet_length("body"), F.col("body"))
    rows = fetched.withColumn("body_kind", F.when(F.col("outcome") == "response", F.coalesce(kind, F.lit("not_read"))).otherwise("not_read"))
    rows = rows.withColumn("raw_hash", F.when(F.col("body_kind").isin("html", "pdf", "other"), http.raw_hash(F.col("body"))))
    page = F.col("body_kind") == "html"
    rows = rows.withColumn("last_url", F.try_element_at(F.col("hops"), F.lit(-1))["url"]).withColumn("d", html.decoded(F.col("content_type"), F.when(page, F.col("body"))))
    return rows.drop("body").withColumn("e", html.extracted(F.when(page, F.col("d.text")), F.col("last_url")))


def judged(rows: DataFrame, distrusted: DataFrame) -> DataFrame:
    """Reads with their verdict (v), canonical decision (c, where the status links) and fingerprints."""
    prints = html.fingerprints(F.col("e"))
    bad = distrusted.select(F.col("host").alias("host_key"), F.lit(True).alias("_bad"))
    rows = rows.join(bad, "host_key", "left").withColumn("p", prepared("e.canonical"))
    rows = rows.withColumn("v", decisions.verdict(F.col("outcome"), F.col("status"), F.col("hops"), F.col("e.title"), prints["title_hash"], F.col("error.location")))
    decided = decisions.canonical(F.col("hops"), F.col("e.canonical"), F.col("p"), F.col("_bad").isNull())
    links = (F.col("outcome") == "response") & (decisions.status_action(F.col("status")) == "link")
    rows = rows.withColumn("c", F.when(links, decided)).drop("_bad", "p")
    whole = F.col("e.body_text").isNotNull()
    return rows.select("*", *[F.when(whole, x).alias(n) for n, x in prints.items()], F.col("e.robots").alias("robots_meta"))


def history_rows(rows: DataFrame, run_id: str, now: Column) -> DataFrame:
    said = http.describe(F.col("outcome"), F.col("error"))
    last = F.try_element_at(F.col("hops"), F.lit(-1))["status"]
    took = F.aggregate("hops", F.lit(0).cast("long"), lambda n, h: n + F.coalesce(h["elapsed_ms"], F.lit(0)))
    return rows.select(
        F.lit(run_id).alias("run_id"), "url_id", now.alias("fetched_at"), (F.col("retry_count") + 1).alias("attempt"), F.coalesce("status", last).alias("http_status"), took.alias("response_time_ms"),
        F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes"), said["outcome"].alias("outcome"), F.col("v.error_type").alias("error_type"), said["detail"].alias("error_detail"), *_HEADERS, "raw_hash", "body_hash", "extractor_version",
        F.col("e.canonical").alias("declared_canonical_url"), "content_type", F.col("d.charset").alias("charset"), F.col("d.charset_source").alias("charset_source"), F.col("d.charset_replaced").alias("charset_replaced"), F.col("v.observation").alias("observation"),
    )


def claimed(store: Store, config: Config, now: Column) -> DataFrame | None:
    """Claims a wave: its URLs with token, current resource and validators; None if nothing is due."""
    urls = store.read("urls")
    due = relational.claim_candidates(urls.withColumnRenamed("id", "url_id"), now, decisions.checked_ahead(config.ahead_s))
    picked = [r.url_id for r in relational.pick(due, now, now, config.wave).select("url_id").collect()]  # at most a wave
    if not picked:
        return None
    ids = store.spark.createDataFrame([(i,) for i in picked], "id string")
    store.write("urls", crawl.claim(urls, ids, config.worker, config.lease_s, now))
    mine = store.read("urls").join(ids, "id", "left_semi").select(F.col("id").alias("url_id"), F.col("normalized_url").alias("url"), "host_key", "role", "claim_token", "retry_count")
    current = relational.latest(store.read("url_resources"), "url_id", "observed_at", "resource_id").select("url_id", F.col("resource_id").alias("from_id"))
    mine = mine.join(current, "url_id", "left")
    ask = crawl.validators(mine.withColumnRenamed("from_id", "resource_id"), store.read("fetch_history"), store.read("resources"), now)
    return mine.join(ask.select("url_id", *_HEADERS), "url_id", "left")


def record(store: Store, run_id: str, claims: DataFrame, fetched: DataFrame, now: Column) -> dict[str, int]:
    """Records a wave: history, host moves, resources round by round, versions, links, and the end of the claims."""
    mine = claims.select("url_id", "host_key", "role", "claim_token", "retry_count", "from_id")
    done = mine.select(F.lit(run_id).alias("run_id"), "url_id", "claim_token", (F.col("retry_count") > 0).alias("retry"))
    outcomes = crawl.record_outcomes(store.read("urls"), store.read("fetch_history"), done).select("url_id", F.col("outcome").alias("_outcome"))
    history, urls = store.read("fetch_history"), store.read("urls")
    rows = read(fetched.withColumn("bytes", F.octet_length("body"))).join(mine, "url_id").join(outcomes, "url_id")
    rows = judged(rows.where("_outcome = 'saved'"), runs.distrusted(history, urls)).cache()
    counts = {r["_outcome"]: r["count"] for r in outcomes.groupBy("_outcome").count().collect()}

    store.write("fetch_history", crawl.append_history(history, history_rows(rows, run_id, now)))
    seen = rows.where("v.host_move IS NOT NULL").select("v.host_move.*", F.col("url").alias("sample_url"))
    store.write("host_moves", crawl.add_host_moves(store.read("host_moves"), seen, now))

    before = store.read("resources")
    kept = before.select(F.col("id").alias("from_id"), F.col("canonical_url").alias("_c"), F.col("final_url").alias("_f"), F.col("declared_canonical_url").alias("_d"), F.col("canonical_source").alias("_s"), F.col("body_hash").alias("_body"), F.col("raw_hash").alias("_raw"), F.col("links_hash").alias("_links"), F.col("extractor_version").alias("_version"))
    rows = rows.join(kept, "from_id", "left").cache()
    same = (F.col("status") == 304) & F.col("from_id").isNotNull()
    about = rows.where(F.col("c").isNotNull() | same).select(
        "url_id", "from_id", F.coalesce("c.canonical_url", "_c").alias("canonical_url"), F.coalesce("c.source", "_s").alias("source"), F.coalesce("c.final_url", "_f").alias("final_url"),
        F.coalesce("c.relation", F.lit("direct")).alias("relation"), F.coalesce("c.declared_canonical_url", "_d").alias("declared"), F.col("v.observation").alias("observation"),
    )
    numbered = crawl.rounds(about).cache()
    linked = None
    for k in sorted(r["round"] for r in numbered.select("round").distinct().collect()):
        res, links, r = crawl.apply_resolution(store.read("resources"), store.read("url_resources"), numbered.where(F.col("round") == k).drop("round"), now)
        found = r.where("resource_id IS NOT NULL").select("url_id", "resource_id").cache()
        columns = ["raw_hash", "page_hash", "title_hash", "body_hash", "links_hash", "page_updated_on", "extractor_version", "extractor_rule", "robots_meta"]
        facts = found.join(rows.select("url_id", F.col("v.observation").alias("observation"), *_HEADERS, *columns), "url_id").where("observation IS NOT NULL")
        store.write("resources", crawl.observe(res, facts, now))
        store.write("url_resources", links)
        linked = found if linked is None else linked.unionByName(found)

    about_page = rows if linked is None else rows.join(linked, "url_id", "left")
    about_page = about_page.withColumn("resource_id", F.lit(None).cast("string")) if linked is None else about_page
    whole = about_page.where("resource_id IS NOT NULL AND body_hash IS NOT NULL AND v.observation = 'alive'")
    store.write("content_versions", crawl.add_versions(store.read("content_versions"), whole.select("resource_id", "body_hash", now.alias("created_at"), F.col("e.title").alias("title"), "page_updated_on", "extractor_version")))
    anchors = whole.select("url_id", F.explode("e.anchors").alias("a")).withColumn("p", prepared("a.url"))
    anchors = anchors.groupBy("url_id").agg(F.collect_list(F.struct("a.url", "a.text", "p.dedup_key", "p.host_key")).alias("anchors"))
    pages = whole.join(anchors, "url_id").select("resource_id", "host_key", (F.col("role") == "index").alias("index"), (~F.col("links_hash").eqNullSafe(F.col("_links"))).alias("links_changed"), "anchors")
    store.write("page_links", crawl.replace_links(store.read("page_links"), pages.dropDuplicates(["resource_id"])))

    after = store.read("resources").select(F.col("id").alias("resource_id"), "state", F.col("raw_hash").alias("_raw_now"), F.col("body_hash").alias("_body_now"))
    ended = about_page.join(after, "resource_id", "left")
    pdf = crawl.is_pdf(F.col("outcome"), F.col("body_kind"), F.col("_raw_now"), F.col("_body_now"))
    kind = decisions.visit_kind(F.col("v.job"), F.col("state"), pdf, F.col("role") == "index")
    new = F.coalesce("body_hash", "raw_hash")
    change = F.when(same, "unchanged").otherwise(decisions.change(F.coalesce("_body", "_raw"), F.col("_version"), new, F.col("extractor_version")))
    ended = ended.select("url_id", "claim_token", F.col("v.job").alias("job"), F.col("v.error_type").alias("error_type"), kind.alias("kind"), change.alias("change"), "outcome", "error")
    finished = crawl.complete(store.read("urls"), ended, now)
    hosts = ended.where("outcome = 'robots_unavailable'").select(F.col("error.host_key").alias("host_key")).distinct()
    store.write("urls", crawl.postpone(finished, hosts, V.SKIPPED_HOST_DAYS * V.DAY, now))
    rows.unpersist()
    return counts


def run(store: Store, fetch: Fetch, config: Config, now: Callable[[], Column] = F.current_timestamp) -> tuple[str, dict]:
    """One recorded run: its row, waves until nothing is due, its stats and alerts. If it fails, its row stays without an end.

    The summary counts waves, claims and what recording them meant."""
    run_id, spark = str(uuid.uuid4()), store.spark
    own = spark.createDataFrame([(run_id, config.kind, json.dumps(config.snapshot()))], "id string, kind string, config string").withColumn("started_at", now())
    store.write("crawl_runs", store.read("crawl_runs").unionByName(own, allowMissingColumns=True))
    summary = {"waves": 0, "claimed": 0, "saved": 0, "already_recorded": 0, "stale_claim": 0}
    while summary["waves"] < config.waves:
        claims = claimed(store, config, now())
        if claims is None:
            break
        folder = f"{store.folder}/fetched/{run_id}-{summary['waves']:05d}"
        fetch(claims).write.parquet(folder)
        fetched = spark.read.parquet(folder)
        for k, n in record(store, run_id, claims, fetched, now()).items():
            summary[k] += n
            summary["claimed"] += n
        summary["waves"] += 1
    history, urls = store.read("fetch_history"), store.read("urls")
    stats = runs.collect(history, urls, run_id, now(), {"claimed": summary["claimed"], "lease_expired": summary["stale_claim"]})
    alerts = [r.asDict() for r in runs.alerts_for(store.read("crawl_runs"), history, urls, run_id, summary["claimed"], summary["stale_claim"]).collect()]
    store.write("crawl_runs", runs.closed(store.read("crawl_runs"), run_id, stats, alerts, now()))
    return run_id, summary
