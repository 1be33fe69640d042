"""Run reports: counts by host, totals, ratios, alerts, Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import vocab as V


def status_counts(history: DataFrame) -> DataFrame:
    return history.where("outcome = 'response'").groupBy("host", "http_status").agg(F.count("*").alias("n"))


def stopped_counts(history: DataFrame) -> DataFrame:
    """By host, fetches that ended without a response, network errors by their kind."""
    why = F.when(F.col("outcome") == "network", F.concat(F.lit("network:"), F.split_part("error_detail", F.lit(":"), F.lit(1)))).otherwise(F.col("outcome"))
    return history.where("outcome <> 'response'").groupBy("host", why.alias("reason")).agg(F.count("*").alias("n"))


def observation_counts(history: DataFrame) -> DataFrame:
    return history.where("observation IS NOT NULL").groupBy("host", "observation").agg(F.count("*").alias("n"))


def byte_totals(history: DataFrame) -> DataFrame:
    return history.groupBy("host").agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.count_if(F.coalesce("charset_replaced", F.lit(False))).alias("replaced"))


def content_changes(history: DataFrame, run: Column | None = None) -> DataFrame:
    """By run and host: pages with an earlier hash (compared), and those whose hash is another one now (changed)."""
    value = F.coalesce("body_hash", "raw_hash")
    before = F.last(value, ignorenulls=True).over(W.partitionBy("url_id").orderBy("fetched_at").rowsBetween(W.unboundedPreceding, -1))
    rows = history.withColumn("_hash", value).withColumn("_before", before).where("observation = 'alive' AND (http_status = 304 OR _hash IS NOT NULL)")
    rows = rows if run is None else rows.where(F.col("run_id") == run)
    return rows.groupBy("run_id", "host").agg(F.count("_before").alias("compared"), F.count_if(F.col("_before").isNotNull() & (F.col("http_status") == 200) & (F.col("_before") != F.col("_hash"))).alias("changed"))


def percentiles(history: DataFrame) -> DataFrame:
    disc = lambda p: F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY response_time_ms)")
    return history.where("outcome = 'response'").agg(disc(0.5).alias("p50"), disc(0.95).alias("p95"))


def queue_state(urls: DataFrame, now: Column) -> DataFrame:
    due = urls.where((~F.col("status").isin("processing", "retired")) & (F.col("next_crawl_at") <= now))
    return due.agg(F.count("*").alias("depth"), F.round((F.unix_micros(now) - F.unix_micros(F.min("next_crawl_at"))) / 1e6).cast("long").alias("oldest_wait_s"))


def host_stats(history: DataFrame) -> DataFrame:
    """One row per host with the counts that ratios and alerts need, in one aggregation of the history."""
    r = F.col("outcome") == "response"
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return history.groupBy("host").agg(
        F.count("*").alias("fetched"), n(r).alias("responses"), n(r & (F.col("http_status") == 200)).alias("ok"), n(r & (F.col("http_status") == 304)).alias("not_modified"),
        n(r & ((F.col("http_status") == 429) | F.col("http_status").between(500, 599))).alias("throttled"), n(F.col("outcome") == "robots_unavailable").alias("robots_unavailable"), n(F.col("outcome").isin("robots_unavailable", "network")).alias("unreachable"),
        n(F.col("observation").isin("not_found", "soft_404_title", "soft_404_known_title", "top_redirect", "gone")).alias("missing"),
    )


def ratio(a: str, b: str) -> Column:
    return F.try_divide(F.col(a), F.col(b))


def ratios(stats: DataFrame) -> DataFrame:
    """Share of not-modified among read pages and share of failing responses; null without a denominator."""
    return stats.select("host", "fetched", "responses", "ok", F.try_divide(F.col("not_modified"), F.col("ok") + F.col("not_modified")).alias("not_modified_ratio"), ratio("throttled", "responses").alias("throttled_rate"))


ALERT = ["kind", "host", "count", "rate"]


def alerts(stats: DataFrame, previous: DataFrame | None, changes: DataFrame | None = None, claimed: int = 0, lease_expired: int = 0, least_responses: int = 0) -> DataFrame:
    """Rows (kind, host, count, rate), host-wise ones by host. Each kind is a filter over the same small stats."""
    null = lambda t: F.lit(None).cast(t)
    prev = previous.select("host", (F.col("missing") / F.col("fetched")).alias("before")) if previous is not None else None
    now = stats.withColumn("rate", ratio("missing", "fetched"))
    now = now.join(prev, "host", "left") if prev is not None else now.withColumn("before", null("double"))
    surge = (F.col("missing") >= V.SURGE_COUNT) & (F.col("rate") >= V.SURGE_RATE) & (F.col("before").isNull() | (F.col("rate") > V.SURGE_TIMES * F.col("before")))
    out = now.where(surge).select(F.lit("surge").alias("kind"), "host", F.col("missing").alias("count"), "rate")
    total = stats.agg(F.coalesce(F.sum("fetched"), F.lit(0)).alias("fetched"), F.coalesce(F.sum("responses"), F.lit(0)).alias("responses"), F.coalesce(F.sum("unreachable"), F.lit(0)).alias("unreachable"))
    one = lambda kind, cond, count, rate: total.where(cond).select(F.lit(kind).alias("kind"), null("string").alias("host"), count.alias("count"), rate.alias("rate"))
    out = out.unionByName(one("all_failed", (F.col("fetched") >= 1) & (F.col("responses") == 0) & (F.col("unreachable") == F.col("fetched")), F.col("fetched"), null("double")))
    if least_responses > 0:
        out = out.unionByName(one("too_few_responses", F.col("responses") < least_responses, F.col("responses"), null("double")))
    if changes is not None:
        c = changes.agg(F.sum("compared").alias("compared"), F.sum("changed").alias("changed"))
        out = out.unionByName(c.where((F.col("compared") >= V.CHANGE_COMPARED) & (F.col("changed") / F.col("compared") > V.CHANGE_RATE)).select(F.lit("content_change_rate_high").alias("kind"), null("string").alias("host"), F.col("changed").alias("count"), (F.col("changed") / F.col("compared")).alias("rate")))
    if lease_expired >= V.LEASE_COUNT and claimed and lease_expired / claimed >= V.LEASE_RATE:
        out = out.unionByName(one("lease_expired_often", F.lit(True), F.lit(lease_expired).cast("long"), F.lit(lease_expired / claimed)))
    return out.unionByName(stats.where("robots_unavailable > 0").select(F.lit("host_skipped").alias("kind"), "host", F.col("robots_unavailable").alias("count"), null("double").alias("rate")))


def percent(x: float | None) -> str:
    return "—" if x is None else f"{100 * x:.1f}%"


def markdown(kind: str, started: str, stats: list, found: list) -> str:
    """A run's report; stats and found are the few rows of a finished report."""
    lines = [f"# Run report: {kind}", "", f"Started {started}.", "", "| host | fetched | responses | not modified | throttled |", "|-|-|-|-|-|"]
    lines += [f"| {r['host']} | {r['fetched']} | {r['responses']} | {percent(r['not_modified_ratio'])} | {percent(r['throttled_rate'])} |" for r in sorted(stats, key=lambda r: r["host"])]
    lines += ["", "## Alerts", ""] + ([f"- {a['kind']}" + (f" at {a['host']}" if a["host"] else "") + f": {a['count']}" + (f" ({percent(a['rate'])})" if a["rate"] is not None else "") for a in found] or ["None."])
    return "\n".join(lines) + "\n"
