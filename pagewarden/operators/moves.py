"""Where dead programs' pages may have moved, and related links of dead programs: the whole reports from the store's tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab as V
from ..plans.relational import allow_list, dead_programs, latest
from . import candidates
from .registry_import import url_rows
from .store import Store, insert_ignore


def targets(programs: DataFrame, links: DataFrame, urls: DataFrame, url_resources: DataFrame, resources: DataFrame) -> DataFrame:
    """Programs whose main URL's current resource is dead, with that URL, by area, name and id (in the order of bytes)."""
    current = latest(url_resources, "url_id", "observed_at", "resource_id")
    dead = dead_programs(programs.withColumnRenamed("id", "program_id"), links, current, resources.withColumnRenamed("id", "resource_id").select("resource_id", "state"))
    main = urls.select(F.col("id").alias("url_id"), "raw_url", "normalized_url", "dedup_key", "host_key")
    return dead.join(main, "url_id").orderBy("area_code", "canonical_name", "program_id")


def own_keys(found: DataFrame, links: DataFrame, urls: DataFrame) -> DataFrame:
    """(program_id, dedup_key): all URLs that the targets have already."""
    keys = urls.select(F.col("id").alias("url_id"), "dedup_key")
    mine = links.select("program_id", "url_id").join(found.select("program_id").distinct(), "program_id", "left_semi")
    return mine.join(keys, "url_id").select("program_id", "dedup_key").distinct()


def live_links(page_links: DataFrame, urls: DataFrame, url_resources: DataFrame, resources: DataFrame) -> DataFrame:
    """Links of living pages that are the current resource of an index URL in use."""
    alive = resources.where("state = 'active'").select(F.col("id").alias("resource_id"))
    return candidates.host_links(page_links, urls, url_resources).join(alive, "resource_id", "left_semi")


def skipped(found: DataFrame, links: DataFrame, judged: DataFrame) -> DataFrame:
    """How many pages would be candidates if nobody had judged them."""
    would = candidates.scored(found, links).select("program_id", "dedup_key").distinct()
    return would.join(judged, ["program_id", "dedup_key"], "left_semi").agg(F.count("*").alias("skipped_judged"))


def suggest(store: Store, judged: DataFrame) -> dict:
    """The report: number of targets, suggestions (one for each program with candidates), judged ones left out, hosts of no
    use. judged: (program_id, dedup_key). What reaches the driver is the report: at most three candidates a dead program."""
    programs, links, urls = store.read("programs"), store.read("program_urls"), store.read("urls")
    now, resources = store.read("url_resources"), store.read("resources")
    found = targets(programs, links, urls, now, resources).cache()
    pages = live_links(store.read("page_links"), urls, now, resources)
    excluded = own_keys(found, links, urls).unionByName(judged.select("program_id", "dedup_key")).distinct()
    best = candidates.suggestions(found, pages, excluded)
    made = best.groupBy("program_id").agg(F.max("more").alias("more"), F.sort_array(F.collect_list(F.struct("rank", "url", "text", "score"))).alias("candidates"))
    shown = ["program_id", "area_code", "canonical_name", "short_name", F.col("normalized_url").alias("dead_url")]
    rows = found.select(*shown).join(made, "program_id").orderBy("area_code", "canonical_name", "program_id")
    out = {"targets": found.count(), "suggestions": [r.asDict(recursive=True) for r in rows.collect()], "skipped_judged": skipped(found, pages, judged).first()[0]}
    out["unusable_hosts"] = [r.asDict() for r in candidates.unusable_hosts(urls, now, resources).orderBy("host").collect()]
    found.unpersist()
    return out


def candidate_file(report: dict, generated_at: str) -> str:
    """The suggestions as a JSON file for reviewers."""
    return json.dumps({"generated_at": generated_at, "suggestions": report["suggestions"]}, ensure_ascii=False, indent=2) + "\n"


def markdown(report: dict) -> str:
    lines = ["# Moved pages", "", f"{report['targets']} dead programs, {len(report['suggestions'])} with candidates, {report['skipped_judged']} candidates judged already.", ""]
    for s in report["suggestions"]:
        lines.append(f"- {s['canonical_name']} ({s['area_code']}), {s['dead_url']}" + (f", {s['more']} more" if s["more"] else ""))
        lines += [f"  - {c['score']:.2f} {c['url']} {c['text']}" for c in s["candidates"]]
    lines += ["", "## Hosts without a living index page", ""] + ([f"- {h['host']}: {h['starts']} starts" for h in report["unusable_hosts"]] or ["None."])
    return "\n".join(lines) + "\n"


# ---- related links ---------------------------------------------------------------------------------------------------


def drop_reasons(related: DataFrame) -> DataFrame:
    """How many URLs were dropped for each reason."""
    return related.where("reason IS NOT NULL").groupBy("reason").agg(F.count("*").alias("n"))


def with_candidates(related: DataFrame) -> DataFrame:
    """How many programs have a candidate."""
    return related.where("rank IS NOT NULL").agg(F.count_distinct("program_id").alias("programs"))


def link_related(store: Store, now: Column, dry_run: bool = False) -> dict:
    """Rebuilds related links of dead programs from their registry rows: counts of what was found, dropped and added."""
    links, urls = store.read("program_urls"), store.read("urls")
    dead = targets(store.read("programs"), links, urls, store.read("url_resources"), store.read("resources"))
    dead = dead.select("program_id", "registry", F.col("dedup_key").alias("main_key"), F.col("host_key").alias("main_host"))
    found = candidates.related(dead, allow_list(urls.where("role <> 'index'"), store.read("host_moves"))).cache()
    chosen = found.where("rank IS NOT NULL")
    fresh = url_rows(chosen.withColumn("idx", F.struct("program_id", "pos")), "related", V.PRIORITY_RELATED, now)
    wider = insert_ignore(urls, fresh, ["dedup_key"])
    keys = wider.select(F.col("id").alias("url_id"), "dedup_key")
    pairs = chosen.select("program_id", "rank", F.col("p.dedup_key").alias("dedup_key")).join(keys, "dedup_key").select("program_id", "url_id", "rank")
    counts = {
        "dead_programs": dead.count(), "programs_with_related": with_candidates(found).first()[0], "links": chosen.count(),
        "new_urls": fresh.join(urls.select("dedup_key"), "dedup_key", "left_anti").count(), "dropped": {r.reason: r.n for r in drop_reasons(found).collect()},
    }
    if not dry_run:
        after = candidates.rebuilt_related(links, dead.select("program_id"), pairs)
        store.write("urls", wider)
        store.write("program_urls", after)
    found.unpersist()
    return counts
