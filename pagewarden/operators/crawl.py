"""The queue and the record of a wave of fetches, as transformations of tables.

A wave holds one fetch for each URL. Rows that touch the same resource are worked off in rounds, in the order of their URL's
id, so that each sees what the one before it did; within a round everything is set-based. ``now`` is always an argument.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import decisions
from ..functions import vocab as V
from .store import insert_ignore, upsert, uuid_of

# ---- queue -----------------------------------------------------------------------------------------------------------


def claim(urls: DataFrame, picked: DataFrame, worker: str, lease_s: int, now: Column) -> DataFrame:
    """The URL table with the picked ids claimed: token raised, leased. Ids that are no longer claimable stay."""
    free = ~((F.col("status") == "processing") & (F.col("lease_until") > now)) & (F.col("status") != "retired")
    rows = urls.join(picked.select("id").distinct().withColumn("_p", F.lit(True)), "id", "left")
    take = F.coalesce(F.col("_p"), F.lit(False)) & free
    until = now + F.make_dt_interval(secs=F.lit(lease_s))
    return _with(rows, urls, take, {"status": F.lit("processing"), "worker_id": F.lit(worker), "lease_until": until, "claim_token": F.col("claim_token") + 1})


def _with(rows: DataFrame, like: DataFrame, cond: Column, values: dict[str, Column]) -> DataFrame:
    return rows.select(*[F.when(cond, values[c]).otherwise(F.col(c)).cast(like.schema[c].dataType).alias(c) if c in values else F.col(c) for c in like.columns])


def extend(urls: DataFrame, claims: DataFrame, lease_s: int, now: Column) -> DataFrame:
    """Longer leases for claims (id, token) that still hold."""
    rows = urls.join(claims.select("id", "token"), "id", "left")
    return _with(rows, urls, (F.col("status") == "processing") & (F.col("token") == F.col("claim_token")), {"lease_until": now + F.make_dt_interval(secs=F.lit(lease_s))})


def postpone(urls: DataFrame, hosts: DataFrame, after_s: int, now: Column) -> DataFrame:
    """URLs of skipped hosts wait, never less than before; those at work stay."""
    rows = urls.join(hosts.select("host_key", F.lit(True).alias("_h")).distinct(), "host_key", "left")
    until = now + F.make_dt_interval(secs=F.lit(after_s))
    return _with(rows, urls, F.col("_h").isNotNull() & (F.col("status") != "processing") & (F.col("next_crawl_at") < until), {"next_crawl_at": until})


def complete(urls: DataFrame, done: DataFrame, now: Column) -> DataFrame:
    """Jobs end: done has (url_id, claim_token, job, error_type, kind, change). A token that is not the URL's is stale."""
    d = done.select(F.col("url_id").alias("id"), F.col("claim_token").alias("_token"), "job", "error_type", "kind", "change")
    rows = urls.join(d, "id", "left").withColumn("_s", decisions.schedule(F.col("job"), F.col("kind"), F.col("change"), F.col("retry_count"), F.col("recrawl_interval_secs"), F.col("id")))
    return _with(rows, urls, F.col("_token") == F.col("claim_token"), {
        "status": F.col("_s.status"), "retry_count": F.col("_s.retry_count"), "next_crawl_at": now + F.make_dt_interval(secs=F.col("_s.after").cast("decimal(18,6)")), "recrawl_interval_secs": F.col("_s.interval"),
        "last_crawled_at": now, "attempt_count": F.col("attempt_count") + 1, "worker_id": F.lit(None), "lease_until": F.lit(None), "last_error_type": F.col("error_type"),
    })


# ---- history, moves, contents ----------------------------------------------------------------------------------------


def append_history(history: DataFrame, rows: DataFrame) -> DataFrame:
    """One row for each run and URL: the last attempt's."""
    both = history.unionByName(rows.select(history.columns))
    last = F.row_number().over(W.partitionBy("run_id", "url_id").orderBy(F.desc_nulls_last("attempt"), F.desc("fetched_at")))
    return both.withColumn("_n", last).where("_n = 1").drop("_n")


def record_outcomes(urls: DataFrame, history: DataFrame, done: DataFrame) -> DataFrame:
    """What recording each finished attempt (run_id, url_id, claim_token, retry) means: stale_claim where the token is not
    the URL's any more, already_recorded where the run has a row of the URL and this is no retry, otherwise saved."""
    holds = urls.select(F.col("id").alias("url_id"), F.col("claim_token").alias("_token"))
    there = history.select("run_id", "url_id", F.lit(True).alias("_there")).distinct()
    rows = done.join(holds, "url_id", "left").join(there, ["run_id", "url_id"], "left")
    stale = ~F.coalesce(F.col("_token") == F.col("claim_token"), F.lit(False))
    outcome = F.when(stale, "stale_claim").when(F.col("_there") & ~F.coalesce("retry", F.lit(False)), "already_recorded").otherwise("saved")
    return rows.withColumn("outcome", outcome).drop("_token", "_there")


def is_pdf(outcome: Column, body_kind: Column, raw_hash: Column, body_hash: Column) -> Column:
    """Whether a fetch is of a PDF: by its body, or where none was read by how its resource is kept (a whole but no text hash)."""
    kept = raw_hash.isNotNull() & body_hash.isNull()
    by_body = F.when(body_kind == "pdf", True).when(body_kind == "html", False).otherwise(kept)
    return F.coalesce((outcome == "response") & by_body, F.lit(False))


def validators(urls: DataFrame, history: DataFrame, resources: DataFrame, now: Column, every_days: int = V.FULL_FETCH_DAYS) -> DataFrame:
    """For URLs (url_id, resource_id): etag and last_modified to ask with; none where the body was not read in full lately."""
    whole = history.where("raw_hash IS NOT NULL").groupBy("url_id").agg(F.max("fetched_at").alias("_read"))
    kept = resources.select(F.col("id").alias("resource_id"), "etag", "last_modified")
    recent = F.coalesce(F.col("_read") > now - F.make_dt_interval(days=F.lit(every_days)), F.lit(False))
    rows = urls.select("url_id", "resource_id").join(whole, "url_id", "left").join(kept, "resource_id", "left")
    return rows.select("url_id", "resource_id", recent.alias("recent"), *[F.when(recent, F.col(c)).alias(c) for c in ("etag", "last_modified")])


def add_host_moves(moves: DataFrame, seen: DataFrame, now: Column) -> DataFrame:
    """Proposed moves (from_host_key, to_host_key, sample_url); a known one keeps its status and first time."""
    fresh = seen.groupBy("from_host_key", "to_host_key").agg(F.min("sample_url").alias("sample_url")).select("from_host_key", "to_host_key", F.lit("proposed").alias("status"), "sample_url", now.alias("first_seen_at"), now.alias("last_seen_at"))
    return upsert(moves, fresh, ["from_host_key", "to_host_key"], ["sample_url", "last_seen_at"])


def approve(moves: DataFrame, from_host: str, to_host: str) -> DataFrame:
    """An observed move is approved; one that nobody saw is an error."""
    this = (F.col("from_host_key") == from_host) & (F.col("to_host_key") == to_host)
    if moves.where(this).isEmpty():
        raise ValueError(f"no move from {from_host} to {to_host} was observed")
    return _with(moves, moves, this, {"status": F.lit("approved")})


def add_versions(versions: DataFrame, rows: DataFrame) -> DataFrame:
    return insert_ignore(versions, rows, ["resource_id", "body_hash"])


def replace_links(links: DataFrame, pages: DataFrame) -> DataFrame:
    """pages: (resource_id, host_key, index, links_changed, anchors: array of (url, text, dedup_key, host_key)), extracted
    ones only. Links of the page's own host are kept for index pages and pages that have some, when they changed or none is
    there."""
    have = links.groupBy("resource_id").agg(F.count("*").alias("existing"))
    p = pages.join(have, "resource_id", "left").withColumn("existing", F.coalesce("existing", F.lit(0)))
    go = p.where((F.col("index") | (F.col("existing") > 0)) & (F.col("links_changed") | (F.col("existing") == 0)))
    fresh = go.select("resource_id", F.col("host_key").alias("_own"), F.explode("anchors").alias("a")).where(F.col("a.host_key") == F.col("_own")).select("resource_id", "a.url", "a.dedup_key", "a.host_key", "a.text").dropDuplicates(["resource_id", "url", "text"])
    return links.join(go.select("resource_id"), "resource_id", "left_anti").select(links.columns).unionByName(fresh.select(links.columns))


# ---- resources -------------------------------------------------------------------------------------------------------


def resolution(rows: DataFrame, resources: DataFrame) -> DataFrame:
    """rows: (url_id, from_id, canonical_url, source, final_url, relation, declared, observation). Adds target_id and what a
    changed canonical URL means: new, same, relinked, renamed, absorbed or refused."""
    frm = resources.select(F.col("id").alias("from_id"), F.col("state").alias("_fs"), F.col("canonical_url").alias("_fc"))
    to = resources.select(F.col("canonical_url"), F.col("id").alias("target_id"), F.col("state").alias("_ts"), F.col("moved_to_resource_id").alias("_tm"))
    r = rows.join(frm, "from_id", "left").join(to, "canonical_url", "left")
    action = (
        F.when(F.col("from_id").isNull(), "new").when(F.col("_fc") == F.col("canonical_url"), "same").when((F.col("_fs") == "moved") | ~F.coalesce(F.col("observation") == "alive", F.lit(False)), "relinked")
        .when(F.col("target_id").isNull(), "renamed").when((F.col("_ts") == "moved") | F.coalesce(F.col("_tm") == F.col("from_id"), F.lit(False)), "refused").otherwise("absorbed")
    )
    return r.withColumn("action", action).drop("_fs", "_fc", "_ts", "_tm")


def rounds(rows: DataFrame) -> DataFrame:
    """Numbers rows so that no two of a round share the resource they come from or the canonical URL they go to, and a row
    comes after every earlier one (by url_id) that it shares one with.

    Round by round: the rows that are first on both sides. As many rounds as the longest run of rows that wait for each
    other; a wave has one fetch for each host, so these are few."""
    first = lambda *key: F.row_number().over(W.partitionBy(*key).orderBy("url_id")) == 1
    left, out, k = rows.withColumn("_from", F.coalesce("from_id", "url_id")), None, 0
    while True:
        k += 1
        left = left.withColumn("_go", first("_from")).withColumn("_go", F.col("_go") & first("canonical_url")).persist()
        now = left.where("_go").drop("_go", "_from").withColumn("round", F.lit(k))
        out = now if out is None else out.unionByName(now)
        left = left.where("NOT _go").drop("_go")
        if left.isEmpty():
            return out


def stronger_source() -> Column:
    """For upsert(): of the old and the new canonical_source the stronger one."""
    strength = lambda c: F.array_position(F.array(*map(F.lit, V.SOURCES)), c)
    old, new = F.col("old.canonical_source"), F.col("new.canonical_source")
    return F.when(strength(new) > strength(old), new).otherwise(old)


def apply_resolution(resources: DataFrame, url_resources: DataFrame, rows: DataFrame, now: Column) -> tuple[DataFrame, DataFrame, DataFrame]:
    """One round: (resources, url_resources, rows with the resource_id that each observation is about; null if refused)."""
    r = resolution(rows, resources)
    made = F.when(F.col("action") == "renamed", F.col("from_id")).when(F.col("action") != "refused", F.coalesce("target_id", uuid_of("canonical_url")))
    r = r.withColumn("resource_id", made).cache()
    rename = r.where("action = 'renamed'").select(F.col("from_id").alias("id"), F.col("canonical_url").alias("_c"))
    res = resources.join(rename, "id", "left").withColumn("canonical_url", F.coalesce("_c", "canonical_url")).drop("_c")
    gone = r.where("action = 'absorbed'").select(F.col("from_id").alias("id"), F.col("target_id").alias("_to"))
    res = res.join(gone, "id", "left")
    res = _with(res, resources, F.col("_to").isNotNull(), {"state": F.lit("moved"), "moved_to_resource_id": F.col("_to")})
    kept = r.where("resource_id IS NOT NULL").groupBy("resource_id").agg(F.min_by(F.struct("canonical_url", "final_url", "declared", "source"), "url_id").alias("x"))
    fresh = kept.select(F.col("resource_id").alias("id"), "x.canonical_url", "x.final_url", F.col("x.declared").alias("declared_canonical_url"), F.col("x.source").alias("canonical_source"), F.lit("active").alias("state"), F.lit(0).alias("consecutive_not_found"), F.lit(0).alias("change_count"))
    res = upsert(res, fresh, ["id"], ["final_url", "declared_canonical_url", "canonical_source"], {"canonical_source": stronger_source()})
    linked = r.where("resource_id IS NOT NULL").select("url_id", "resource_id", "relation", now.alias("observed_at"))
    return res, upsert(url_resources, linked, ["url_id", "resource_id"], ["relation", "observed_at"]), r


def observe(resources: DataFrame, seen: DataFrame, now: Column) -> DataFrame:
    """seen: (resource_id, observation, extracted and header columns). State and misses move; content is written only for a
    living page whose body was read in full, otherwise only the time of the visit."""
    columns = ["etag", "last_modified", "raw_hash", "page_hash", "title_hash", "body_hash", "links_hash", "page_updated_on", "extractor_version", "extractor_rule", "robots_meta"]
    s = seen.select(F.col("resource_id").alias("id"), "observation", *[F.col(c).alias(f"_n_{c}") for c in columns])
    rows = resources.join(s, "id", "left").withColumn("_s", decisions.next_state(F.col("state"), F.col("consecutive_not_found"), F.col("observation")))
    live = F.col("observation").isNotNull() & (F.col("state") != "moved")
    full = live & (F.col("observation") == "alive") & F.col("_n_raw_hash").isNotNull()
    moved = decisions.change(F.coalesce("body_hash", "raw_hash"), F.col("extractor_version"), F.coalesce("_n_body_hash", "_n_raw_hash"), F.col("_n_extractor_version")) == "changed"
    rows = rows.withColumn("_full", F.coalesce(full, F.lit(False))).withColumn("_changed", F.coalesce(full & moved, F.lit(False)))
    values = {c: F.when(F.col("_full"), F.col(f"_n_{c}")).otherwise(F.col(c)) for c in columns}
    values |= {"state": F.col("_s.state"), "consecutive_not_found": F.col("_s.misses"), "last_crawled_at": now, "last_changed_at": F.when(F.col("_changed"), now).otherwise(F.col("last_changed_at")), "change_count": F.col("change_count") + F.col("_changed").cast("int")}
    return _with(rows, resources, F.coalesce(live, F.lit(False)), values)
