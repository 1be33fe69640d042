"""HTTP: policies by status, media types and body kinds, Retry-After, pacing, network errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab as V


def robots_policy(status: Column) -> Column:
    return F.when(status.between(200, 299), "parse").when(status.between(300, 499), "allow_all").otherwise("skip")


def redirect_kind(status: Column) -> Column:
    return F.when(status.isin(301, 308), "permanent").when(status.isin(302, 303, 307), "temporary")


def media_type(content_type: Column) -> Column:
    return F.nullif(F.lower(F.trim(F.substring_index(content_type, ";", 1))), F.lit(""))


def settled_by_header(content_type: Column) -> Column:
    """Whether the header alone says that a body is neither a page nor a PDF."""
    kind = media_type(content_type)
    return kind.isNotNull() & ~kind.isin("application/octet-stream", "text/html", "application/xhtml+xml", "application/pdf")


def body_kind(content_type: Column, body: Column) -> Column:
    """html, pdf or other. A PDF's first bytes win over the header; a doubtful body is a page if its first sign is '<'."""
    head = F.hex(F.substring(body, 1, 512))
    sniffed = head.rlike("^(?:EFBBBF)?(?:09|0A|0C|0D|20)*3C")
    return (
        F.when(head.startswith("255044462D"), "pdf")
        .when(settled_by_header(content_type), "other")
        .when(media_type(content_type).isin("text/html", "application/xhtml+xml") | sniffed, "html")
        .otherwise("other")
    )


def read_kind(status: Column, content_type: Column, length: Column, body: Column) -> Column:
    """What becomes of a page's body: only 2xx are read, nothing that the header rules out or that is over the limit."""
    kind = body_kind(content_type, body)
    return F.when(~status.between(200, 299), "not_read").when(settled_by_header(content_type), "other").when((length > V.PAGE_LIMIT) | (F.octet_length(body) > V.PAGE_LIMIT), "too_large").otherwise(kind)


def raw_hash(body: Column) -> Column:
    return F.sha2(body, 256)


def retry_after(value: Column, now: Column) -> Column:
    """Seconds of a Retry-After header: a number, or a date (past ones count as 0); null if it is neither."""
    text = F.trim(value)
    date = F.try_to_timestamp(F.regexp_extract(text, r"^[A-Za-z]{3}, (.*) GMT$", 1), F.lit("dd MMM yyyy HH:mm:ss"))
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint")).when(date.isNotNull(), F.greatest(F.lit(0), F.unix_timestamp(date) - F.unix_timestamp(now)))


def pace(responses: Column, least: float = V.PACE_LEAST_S, crawl_delay: Column | None = None) -> Column:
    """Folds a host's responses, structs (status, retry_after), in order: struct(slowdowns, wait seconds)."""
    base = F.lit(least) if crawl_delay is None else F.greatest(F.lit(least), F.coalesce(crawl_delay, F.lit(least)))
    gap = lambda n: F.least(base * F.pow(F.lit(2.0), n), F.greatest(F.lit(V.PACE_MOST_S), base))

    def step(state, r):
        slow = (r["status"] == 429) | r["status"].between(500, 599)
        n = F.when(slow, F.when(gap(state["slowdowns"]) < V.PACE_MOST_S, state["slowdowns"] + 1).otherwise(state["slowdowns"])).otherwise(F.greatest(F.lit(0), state["slowdowns"] - 1))
        told = F.when(r["status"].isin(429, 503), F.least(r["retry_after"].cast("double"), F.lit(float(V.RETRY_AFTER_MOST_S))))
        return F.struct(n.cast("int").alias("slowdowns"), F.greatest(gap(n), told).alias("wait"))

    return F.aggregate(responses, F.struct(F.lit(0).alias("slowdowns"), base.alias("wait")), step)


def network_kind(error: Column) -> Column:
    """timeout, dns, connect or other, from an error's text."""
    low = F.lower(error)
    return F.when(low.rlike("timed? ?out|timeout"), "timeout").when(low.rlike("dns|name or service|getaddrinfo|resolve"), "dns").when(low.rlike("connect|refused|reset|unreachable"), "connect").otherwise("other")


def describe(outcome: Column, error: Column) -> Column:
    """struct(outcome, detail) as the history keeps it: the redirect anomalies are one outcome."""
    anomaly = outcome.isin("missing_location", "too_many_redirects", "redirect_loop")
    detail = F.when(anomaly, outcome).when(outcome == "network", F.concat(error["kind"], F.lit(": "), F.coalesce(error["detail"], F.lit("")))).when(outcome == "robots_unavailable", error["host_key"]).when(outcome == "out_of_scope", error["location"])
    return F.struct(F.when(anomaly, "redirect_anomaly").otherwise(outcome).alias("outcome"), detail.alias("detail"))
