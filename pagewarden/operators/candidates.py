"""Candidates for dead programs: related URLs of the registry row, index pages to crawl, and moved pages by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import urls
from ..functions import vocab as V
from ..functions.names import features, normalize_name, similar
from ..plans.relational import coverage, latest, park, ranked
from .registry_import import url_rows


def source_values(registry: Column) -> Column:
    """Texts of a registry row that may hold URLs, in order: the rest of a joined main URL, related links, the description."""
    v = F.parse_json(registry)
    get = lambda path, t: F.try_variant_get(v, path, t)
    tail = F.filter(urls.split_joined(F.coalesce(get("$.localGovernmentLink.uri", "string"), F.lit(""))), lambda _, i: i > 0)
    related = F.transform(F.coalesce(F.try_variant_get(v, "$.relatedLink", "array<variant>"), F.array().cast("array<variant>")), lambda x: F.try_variant_get(x, "$.uri", "string"))
    return F.array_compact(F.concat(tail, related, F.array(get("$.description", "string"))))


def related(programs: DataFrame, allowed: DataFrame) -> DataFrame:
    """For rows (program_id, registry, main_key, main_host): each URL found, with its reason to be dropped or its rank.

    Unreadable ones are told first, repeats of a key are passed over, and at most MAX_RELATED are ranked."""
    found = programs.select("program_id", "main_key", "main_host", F.posexplode(F.flatten(F.transform(source_values(F.col("registry")), urls.extract_urls))).alias("pos", "raw"))
    found = found.withColumn("p", urls.prepared("raw")).join(allowed.select(F.col("host_key").alias("_h"), F.lit(True).alias("_ok")), F.col("p.host_key") == F.col("_h"), "left")
    again = F.row_number().over(W.partitionBy("program_id", "p.dedup_key").orderBy("pos"))
    found = found.withColumn("_n", F.when(F.col("p.rejection").isNull(), again)).where("_n IS NULL OR _n = 1")
    n = F.col("p.normalized")
    reason = (
        F.when(F.col("p.rejection").isNotNull(), "unreadable").when(urls.hostname(F.col("p.host_key")) != urls.hostname(F.col("main_host")), "other_host").when(F.col("_ok").isNull(), "not_allowed")
        .when(F.col("p.dedup_key") == F.col("main_key"), "same_as_main").when(~urls.html_like(n), "not_html").when(urls.is_form(n), "form")
    )
    found = found.withColumn("reason", reason)
    place = F.when(F.col("reason").isNull(), F.count_if(F.col("reason").isNull()).over(W.partitionBy("program_id").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)))
    found = found.withColumn("rank", place.cast("int"))
    return found.select("program_id", "pos", "raw", "p", F.when(F.col("rank") > V.MAX_RELATED, "over_limit").otherwise(F.col("reason")).alias("reason"), F.when(F.col("rank") <= V.MAX_RELATED, F.col("rank")).alias("rank"))


def rebuilt_related(links: DataFrame, dead: DataFrame, candidates: DataFrame) -> DataFrame:
    """Related links from the registry are rebuilt for dead programs only; found ones and clashing keys stay."""
    kept = links.join(dead.select("program_id", F.lit(True).alias("_dead")).distinct(), "program_id", "left").where("NOT (coalesce(_dead, false) AND role = 'related' AND source = 'registry')").drop("_dead")
    fresh = candidates.select("program_id", "url_id", F.lit("related").alias("role"), "rank", F.lit("registry").alias("source")).dropDuplicates(["program_id", "url_id"])
    return kept.unionByName(fresh.join(kept.select("program_id", "url_id"), ["program_id", "url_id"], "left_anti"))


def index_starts(mains: DataFrame) -> DataFrame:
    """Directories above main URLs (normalized_url), prepared, the first for each key."""
    dirs = mains.select(urls.parent_dir(F.col("normalized_url")).alias("dir")).where("dir IS NOT NULL").distinct()
    return dirs.select(F.col("dir").alias("idx"), urls.prepared("dir").alias("p"))


def registered_starts(table: DataFrame, starts: DataFrame, links: DataFrame, now: Column) -> DataFrame:
    """The URL table with new starts added, index rows that are none parked, and parked ones that are again restored."""
    keys = starts.where("p.rejection IS NULL").select(F.col("p.dedup_key").alias("dedup_key")).distinct()
    parked = park(table.withColumn("url_id", F.col("id")), keys, links).select("id", F.lit(True).alias("_park"))
    back = keys.select("dedup_key", F.lit(True).alias("_start"))
    rows = table.join(parked, "id", "left").join(back, "dedup_key", "left")
    restore = (F.col("role") == "index") & (F.col("status") == "retired") & F.col("_start").isNotNull()
    rows = rows.withColumn("next_crawl_at", F.when(restore, now).otherwise(F.col("next_crawl_at"))).withColumn("status", F.when(F.col("_park"), "retired").when(restore, "queued").otherwise(F.col("status"))).select(table.columns)
    fresh = url_rows(starts, "index", V.PRIORITY_INDEX, now).join(table.select("dedup_key"), "dedup_key", "left_anti")
    return rows.unionByName(fresh, allowMissingColumns=True)


def scored(targets: DataFrame, links: DataFrame) -> DataFrame:
    """Pairs (program_id, dedup_key, url, text, score) of a target's names and the texts of its host's pages that are alike.

    Bigrams are made once for each name and text; a pair costs one set intersection, and none where lengths rule it out."""
    names = F.explode(F.array_distinct(F.array_compact(F.array("canonical_name", "short_name"))))
    named = targets.select("program_id", "host_key", names.alias("name")).withColumn("nm", normalize_name(F.col("name"))).where("nm <> ''")
    named = named.select("program_id", "host_key", features(F.col("nm")).alias("a"))
    pages = links.where(urls.page_like(F.col("url"))).withColumn("txt", normalize_name(F.col("text")))
    pages = pages.select("host_key", "url", "dedup_key", "text", features(F.col("txt")).alias("b"))
    pairs = named.join(pages, "host_key").withColumn("score", similar(F.col("a"), F.col("b"), V.MIN_SCORE))
    return pairs.where(F.col("score") >= V.MIN_SCORE).drop("a", "b")


def suggestions(targets: DataFrame, links: DataFrame, excluded: DataFrame) -> DataFrame:
    """For dead programs (program_id, canonical_name, short_name, host_key) and links (host_key, url, dedup_key, text): the
    best MAX_CANDIDATES pages of the host by name, each with its score, rank, and how many more there are.

    excluded: (program_id, dedup_key) that are the program's own or already judged."""
    pairs = scored(targets, links).join(excluded, ["program_id", "dedup_key"], "left_anti")
    best = pairs.groupBy("program_id", "dedup_key").agg(F.min_by(F.struct("url", "text", "score"), F.struct(-F.col("score"), "url")).alias("b"))
    best = best.select("program_id", "dedup_key", "b.*").withColumn("more", F.greatest(F.lit(0), F.count("*").over(W.partitionBy("program_id")) - V.MAX_CANDIDATES))
    return ranked(best, "program_id", [F.desc("score"), F.asc("url")], V.MAX_CANDIDATES)


def host_links(page_links: DataFrame, index_urls: DataFrame, url_resources: DataFrame) -> DataFrame:
    """Links of pages that are the current resource of an index URL in use."""
    now = latest(url_resources, "url_id", "observed_at", "resource_id").select("url_id", "resource_id")
    seen = index_urls.where("role = 'index' AND status <> 'retired'").select(F.col("id").alias("url_id")).join(now, "url_id").select("resource_id").distinct()
    return page_links.join(seen, "resource_id", "left_semi")


def unusable_hosts(index_urls: DataFrame, url_resources: DataFrame, resources: DataFrame) -> DataFrame:
    """Hosts whose fetched index pages are many and none of them live."""
    now = latest(url_resources, "url_id", "observed_at", "resource_id").select("url_id", "resource_id")
    starts = index_urls.where("role = 'index' AND status <> 'retired' AND last_crawled_at IS NOT NULL").select(F.col("id").alias("url_id"), F.col("host_key").alias("host"))
    states = starts.join(now, "url_id", "left").join(resources.select(F.col("id").alias("resource_id"), "state"), "resource_id", "left")
    return coverage(states).where("unusable")
