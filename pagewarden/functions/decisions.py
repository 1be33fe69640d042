"""Rules of the crawl as column expressions: canonical URL, liveness, state, change and schedule."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab as V
from .http import redirect_kind
from .urls import host_key, hostname, is_top_page


def status_action(status: Column) -> Column:
    return F.when(status.between(200, 299) | status.isin(404, 410), "link").when(status == 304, "keep_previous").otherwise("skip")


def permanent_target(hops: Column) -> Column:
    """URL at the end of the leading run of permanent redirects; null if there is none. hops: array of (url, status)."""

    def step(s, i):
        goes = s["on"] & (redirect_kind(F.get(hops, i)["status"]) == "permanent")
        goes = F.coalesce(goes, F.lit(False))
        return F.struct(goes.alias("on"), F.when(goes, F.get(hops, i + 1)["url"]).otherwise(s["url"]).alias("url"))

    steps = F.when(F.size(hops) > 1, F.sequence(F.lit(0), F.size(hops) - 2)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, F.struct(F.lit(True).alias("on"), F.lit(None).cast("string").alias("url")), step)["url"]


def canonical(hops: Column, declared_raw: Column, declared: Column, trusted: Column) -> Column:
    """struct(canonical_url, source, relation, final_url, declared_canonical_url, ignored_redirect, ignored_declared).

    declared: the prepared struct of declared_raw. Null without hops."""
    start, last = F.get(hops, F.lit(0))["url"], F.try_element_at(hops, F.lit(-1))["url"]
    target = permanent_target(hops)
    to_top = F.coalesce(is_top_page(target) & ~is_top_page(start), F.lit(False))
    candidate = F.when(~to_top, target)
    url = declared["normalized"]
    ignored = (
        F.when(declared_raw.isNull(), None)
        .when(url.isNull(), F.concat(F.lit("unreadable:"), declared["rejection"]))
        .when((last != start) & ~F.coalesce(candidate == last, F.lit(False)), "redirected_away")
        .when(~F.coalesce(host_key(last) == declared["host_key"], F.lit(False)), "other_host")
        .when(~trusted, "host_untrusted")
        .when(is_top_page(url) & ~is_top_page(last), "points_to_top_page")
        .when(candidate.isNotNull() & (candidate != url), "conflicts_with_redirect")
    )
    adopted = F.when(declared_raw.isNotNull() & ignored.isNull() & candidate.isNull(), url)
    chosen = F.coalesce(candidate, adopted, start)
    source = F.when(candidate.isNotNull(), "redirect").when(adopted.isNotNull(), "declared").otherwise("normalized")
    relation = F.when(chosen == start, "direct").when(candidate.isNotNull(), "redirect").otherwise("declared")
    out = F.struct(chosen.alias("canonical_url"), source.alias("source"), relation.alias("relation"), last.alias("final_url"), F.coalesce(url, declared_raw).alias("declared_canonical_url"), F.when(to_top, "to_top_page").alias("ignored_redirect"), ignored.alias("ignored_declared"))
    return F.when(F.size(hops) > 0, out)


def says_not_found(title: Column) -> Column:
    low = F.lower(title)
    hit = F.lit(False)
    for phrase in V.NOT_FOUND_TITLES:
        hit = hit | F.contains(low, F.lit(phrase))
    return F.coalesce(hit, F.lit(False))


def host_moved(last_url: Column, last_status: Column, location: Column) -> Column:
    """struct(from_host_key, to_host_key) if a permanent redirect changes nothing but the host; both URLs normalised."""
    rest = lambda u: F.regexp_replace(u, r"^https?://[^/?#]+", "")
    a, b = host_key(last_url), host_key(location)
    return F.when((redirect_kind(last_status) == "permanent") & (hostname(a) != hostname(b)) & (rest(last_url) == rest(location)), F.struct(a.alias("from_host_key"), b.alias("to_host_key")))


def verdict(outcome: Column, status: Column, hops: Column, title: Column, title_hash: Column, location: Column, known_titles: Column | None = None) -> Column:
    """struct(job, error_type, observation, host_move) of a fetch."""
    last, first = F.try_element_at(hops, F.lit(-1)), F.get(hops, F.lit(0))
    response = outcome == "response"
    to_top = (F.size(hops) > 1) & is_top_page(last["url"]) & ~is_top_page(first["url"])
    known = F.coalesce(F.array_contains(known_titles, title_hash), F.lit(False)) if known_titles is not None else F.lit(False)
    ok = response & status.between(200, 299)
    observation = (
        F.when(ok & to_top, "top_redirect").when(ok & says_not_found(title), "soft_404_title").when(ok & known, "soft_404_known_title").when(ok | (response & (status == 304)), "alive")
        .when(response & (status == 404), "not_found").when(response & (status == 410), "gone")
    )
    move = F.when(outcome == "out_of_scope", host_moved(last["url"], last["status"], location))
    error = (
        F.when(observation.isNotNull(), None).when(response & status.isin(401, 403), "forbidden").when(response & (status == 429), "rate_limited").when(response & status.between(500, 599), "server_error").when(response, "unexpected_status")
        .when(outcome == "out_of_scope", F.when(move.isNotNull(), "host_moved").otherwise("out_of_scope")).when(outcome.isin("robots_denied", "robots_unavailable", "network"), outcome).otherwise("redirect")
    )
    job = F.when(observation.isNotNull(), "succeeded").when(error.isin("forbidden", "robots_denied", "host_moved", "out_of_scope"), "blocked").otherwise("retry")
    return F.struct(job.alias("job"), error.alias("error_type"), observation.alias("observation"), move.alias("host_move"))


def next_state(state: Column, misses: Column, observation: Column) -> Column:
    """struct(state, misses) of a resource after an observation; a moved one is frozen."""
    missing = observation.isin("not_found", "soft_404_title", "soft_404_known_title", "top_redirect")
    after = (
        F.when(state == "moved", state).when(observation == "alive", "active").when(observation == "gone", "deleted")
        .when(missing & ((state == "deleted") | (misses + 1 >= V.NOT_FOUND_LIMIT)), "deleted").when(missing, "deletion_candidate").otherwise(state)
    )
    count = F.when(state == "moved", misses).when(observation == "alive", 0).when(missing | (observation == "gone"), misses + 1).otherwise(misses)
    return F.struct(after.alias("state"), count.cast("int").alias("misses"))


def fold_states(observations: Column, state: str = "active") -> Column:
    """State after observations in order."""
    return F.aggregate(observations, F.struct(F.lit(state).alias("state"), F.lit(0).alias("misses")), lambda s, o: next_state(s["state"], s["misses"], o))


def change(old_hash: Column, old_version: Column, new_hash: Column, new_version: Column) -> Column:
    """changed, unchanged or unknown; other extractor versions cannot be compared."""
    known = old_hash.isNotNull() & old_version.eqNullSafe(new_version)
    return F.when(~known, "unknown").when(old_hash == new_hash, "unchanged").otherwise("changed")


def visit_kind(job: Column, state: Column, pdf: Column, index: Column) -> Column:
    return F.when(job == "blocked", "blocked").when(state == "deletion_candidate", "deletion_candidate").when(index & (state == "deleted"), "gone_index").when(pdf, "pdf").otherwise("page")


def _bound(kind: Column, i: int) -> Column:
    out = F.lit(V.BOUNDS["page"][i] * V.DAY)
    for name, b in V.BOUNDS.items():
        out = F.when(kind == name, b[i] * V.DAY).otherwise(out)
    return out.cast("double")


def adapt(kind: Column, changed: Column, interval: Column) -> Column:
    """The next interval in seconds: the last one within the kind's bounds, halved by a change, stretched by half without."""
    first, low, high = (_bound(kind, i) for i in range(3))
    clamp = lambda x: F.least(F.greatest(x, low), high)
    base = clamp(interval.cast("double"))
    moved = F.when(kind == "blocked", base * 1.5).when(kind.isin("deletion_candidate", "gone_index"), base).when(changed == "changed", base / 2).when(changed == "unchanged", base * 1.5).otherwise(base)
    return F.when(interval.isNull(), first).otherwise(clamp(moved))


def backoff(failures: Column) -> Column:
    return F.least(F.lit(float(V.BACKOFF_FIRST_S)) * F.pow(F.lit(2.0), F.least(F.greatest(failures - 1, F.lit(0)), F.lit(30))), F.lit(float(V.BACKOFF_MOST_S)))


def jitter_ms(url_id: Column) -> Column:
    """A UUID's 128-bit number modulo the jitter's span, worked out in groups of eight hexadecimal digits."""
    digits = F.regexp_replace(url_id, "-", "")
    mod, out = V.JITTER_MS + 1, F.lit(0).cast("long")
    for k in range(4):
        out = (out * (1 << 32) + F.conv(F.substring(digits, 8 * k + 1, 8), 16, 10).cast("long")) % mod
    return out


def schedule(job: Column, kind: Column, changed: Column, retries: Column, interval: Column, url_id: Column) -> Column:
    """struct(status, retry_count, after seconds, interval seconds) of a completed job."""
    new, failures = adapt(kind, changed, interval), retries + 1
    final = failures > V.MAX_RETRIES
    status = F.when(job != "retry", job).when(final, "failed_final").otherwise("retry_wait")
    after = F.when(job != "retry", new).when(final, float(V.FAILED_FINAL_DAYS * V.DAY)).otherwise(backoff(failures) + jitter_ms(url_id) / 1000)
    count = F.when(job == "succeeded", 0).when(job == "blocked", retries).otherwise(failures)
    return F.struct(status.alias("status"), count.cast("int").alias("retry_count"), after.alias("after"), F.when(job != "retry", new).otherwise(interval.cast("double")).alias("interval"))


def shortest_interval_s() -> int:
    """The least time until a URL is due again, over all kinds of visits."""
    return V.DAY * min(V.FAILED_FINAL_DAYS, *(least for _, least, _ in V.BOUNDS.values()))


def longest_retry_wait_s() -> float:
    return V.BACKOFF_MOST_S + V.JITTER_MS / 1000


def checked_ahead(ahead_s: int) -> int:
    """A look-ahead that cannot make a run fetch a URL twice; a longer one is an error."""
    if ahead_s >= shortest_interval_s():
        raise ValueError(f"looking {ahead_s} s ahead would reach a URL's next visit ({shortest_interval_s()} s)")
    return ahead_s
