"""Fetches from recorded exchanges: the crawl's source where there is no network.

Each URL is followed through recorded responses by the rules of a live fetch: scope, robots, redirects (five at most), loops.
URLs of a host stay in one task, in order, so a live source could pace them there.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from .. import schema
from ..functions import vocab as V
from ..functions.urls import join_url, prepare

#: (status, headers by lower-case name, body) of a URL, or an error's kind.
Exchange = Callable[[str], tuple[int, dict[str, str], bytes] | str]
_REDIRECTS = (301, 302, 303, 307, 308)


def follow(url: str, allowed: set[str], exchange: Exchange, robots: Callable[..., str] = lambda host, url: "allow") -> dict:
    """One fetch. robots: allow, deny or unavailable for a host and one of its URLs."""
    hops, seen, blank = [], set(), {"status": None, "etag": None, "last_modified": None, "content_type": None, "x_robots_tag": None, "body": None, "error": None}

    def end(outcome: str, **more) -> dict:
        return blank | {"hops": hops, "outcome": outcome} | more

    error = lambda **e: {"host_key": None, "location": None, "kind": None, "detail": None} | e
    while True:
        ready = prepare(url)
        if not ready or ready["rejection"] or ready["host_key"] not in allowed:
            return end("out_of_scope", error=error(location=url))
        if (said := robots(ready["host_key"], ready["normalized"])) != "allow":
            return end("robots_denied" if said == "deny" else "robots_unavailable", error=error(host_key=ready["host_key"]))
        at = ready["normalized"]
        if at in seen:
            return end("redirect_loop")
        seen.add(at)
        got = exchange(at)
        if isinstance(got, str):
            return end("network", error=error(kind=got))
        status, headers, body = got
        hops.append({"url": at, "status": status, "elapsed_ms": 0})
        if status not in _REDIRECTS:
            read = body if 200 <= status < 300 and len(body) <= V.PAGE_LIMIT else None
            return end("response", status=status, etag=headers.get("etag"), last_modified=headers.get("last-modified"), content_type=headers.get("content-type"), x_robots_tag=headers.get("x-robots-tag"), body=read)
        if "location" not in headers:
            return end("missing_location")
        if len(hops) > V.MAX_REDIRECTS:
            return end("too_many_redirects")
        url = join_url(at, headers["location"]) or headers["location"]


def conditional(exchange: Exchange, etag: str | None, last_modified: str | None) -> Exchange:
    """The same exchanges for a request with validators: a page that still has one of them is not modified."""

    def ask(url: str):
        got = exchange(url)
        if isinstance(got, str) or got[0] != 200:
            return got
        same = etag and got[1].get("etag") == etag or not etag and last_modified and got[1].get("last-modified") == last_modified
        return (304, got[1], b"") if same else got

    return ask


def fetches(claims: DataFrame, allowed: set[str], exchange: Exchange, robots: Callable[..., str] = lambda host, url: "allow") -> DataFrame:
    """claims: (url_id, url, host_key, and etag and last_modified to ask with, if they have these); a row of schema.FETCHES
    for each."""
    extra = [c for c in ("etag", "last_modified") if c in claims.columns]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            asked = [tuple(r.get(c) if isinstance(r.get(c), str) else None for c in ("etag", "last_modified")) for r in f.to_dict("records")]
            rows = [{"url_id": i, "url": u} | follow(u, allowed, conditional(exchange, *v), robots) for i, u, v in zip(f["url_id"], f["url"], asked)]
            yield pd.DataFrame(rows, columns=schema.FETCHES.names)

    return claims.repartition("host_key").select("url_id", "url", *extra).mapInPandas(run, schema.FETCHES)
