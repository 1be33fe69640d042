"""Reviewed decisions: candidates are registered, then linked by a ladder of conditions.

A file reviews a program once, so the reviews of a file do not touch each other's main links; the ladder is one CASE over a
joined row, and its outcome one merge. Computing it without writing is the dry run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab as V
from ..plans.relational import latest
from .registry_import import url_rows


def registered(urls: DataFrame, checked: DataFrame, now: Column) -> DataFrame:
    """The URL table with the reviews' candidates: hits as seeds, index pages as starts."""
    rows = checked.where("verdict IN ('hit', 'index')").withColumn("idx", F.col("pos")).withColumn("p", F.col("u"))
    hits, index = url_rows(rows.where("verdict = 'hit'"), "seed", V.PRIORITY_MAIN, now), url_rows(rows.where("verdict = 'index'"), "index", V.PRIORITY_RELATED, now)
    for new in (hits, index):
        urls = urls.unionByName(new.join(urls.select("dedup_key"), "dedup_key", "left_anti"), allowMissingColumns=True)
    return urls


def ladder(checked: DataFrame, links: DataFrame, urls: DataFrame, url_resources: DataFrame, resources: DataFrame, host_moves: DataFrame) -> DataFrame:
    """checked reviews with ``outcome``: none, already, apply, or the reason of a refusal, and what the merge needs."""
    now = latest(url_resources, "url_id", "observed_at", "resource_id").select("url_id", "resource_id")
    state = resources.select(F.col("id").alias("resource_id"), "state")
    seen = urls.select(F.col("id").alias("url_id"), "dedup_key", "status").join(now, "url_id", "left").join(state, "resource_id", "left")
    main = links.where("role = 'main'").select("program_id", F.col("url_id").alias("main_id"), F.col("source").alias("main_source"))
    old = seen.select(F.col("url_id").alias("main_id"), F.col("dedup_key").alias("main_key"), F.col("resource_id").alias("main_resource"), F.col("state").alias("main_state"))
    new = seen.select(F.col("url_id").alias("cand_id"), F.col("dedup_key").alias("cand_key"), F.col("resource_id").alias("cand_resource"), F.col("state").alias("cand_state"), F.col("status").alias("cand_status"))
    has = links.select("program_id", F.col("url_id").alias("cand_id"), F.lit(True).alias("linked")).distinct()
    ranks = links.groupBy("program_id").agg((F.coalesce(F.max(F.when(F.col("role") == "related", F.col("rank"))), F.lit(0)) + 1).alias("next_rank"))
    moves = host_moves.where("status = 'approved'").select(F.col("from_host_key").alias("_f"), F.col("to_host_key").alias("_t"), F.lit(True).alias("approved"))
    r = checked.join(main, "program_id", "left").join(old, "main_id", "left").join(new, F.col("u.dedup_key") == F.col("cand_key"), "left").join(has, ["program_id", "cand_id"], "left").join(ranks, "program_id", "left")
    r = r.join(moves, (F.col("dead.host_key") == F.col("_f")) & (F.col("u.host_key") == F.col("_t")), "left")
    hit, move, yes = F.col("verdict") == "hit", F.col("host_move"), lambda c: F.coalesce(c, F.lit(False))
    replaced = hit & yes(F.col("main_id") == F.col("cand_id")) & yes(F.col("main_source") == "discovered")
    dead = yes(F.col("main_state").isin(*V.DEAD))
    outcome = (
        F.when(F.col("verdict") == "none", "none").when(F.col("main_id").isNull(), "main_changed").when(move & F.col("approved").isNull(), "host_move_not_approved").when(replaced, "already")
        .when(~yes(F.col("main_key") == F.col("dead.dedup_key")), "main_changed").when(~move & F.col("main_resource").isNull(), "main_not_dead").when(F.col("cand_resource").isNull(), "no_resource")
        .when(hit & F.col("main_resource").isNotNull() & (F.col("main_resource") == F.col("cand_resource")), "same_resource").when(hit & (F.col("cand_state") == "moved"), "target_moved").when(F.col("cand_state") != "active", "not_active")
        .when((F.col("verdict") == "index") & F.col("linked").isNotNull(), "already").when(F.col("main_resource").isNotNull() & ~dead, "main_not_dead").otherwise("apply")
    )
    return r.withColumn("outcome", outcome)


def apply(links: DataFrame, decided: DataFrame) -> DataFrame:
    """Links after the reviews: a hit becomes the main link (a related row of it goes), an index page a related one."""
    go = decided.where("outcome = 'apply'")
    hit = go.where("verdict = 'hit'").select("program_id", F.col("cand_id").alias("url_id"))
    kept = links.join(hit.select("program_id", F.lit("main").alias("role")), ["program_id", "role"], "left_anti").join(hit, ["program_id", "url_id"], "left_anti")
    mains = hit.select("program_id", "url_id", F.lit("main").alias("role"), F.lit(1).alias("rank"), F.lit("discovered").alias("source"))
    index = go.where("verdict = 'index'").select("program_id", F.col("cand_id").alias("url_id"), F.lit("related").alias("role"), F.col("next_rank").cast("int").alias("rank"), F.lit("discovered").alias("source"))
    return kept.select(links.columns).unionByName(mains).unionByName(index)


def promoted(urls: DataFrame, decided: DataFrame, links: DataFrame, now: Column) -> DataFrame:
    """Candidates that were taken are seeds (retired ones queued); old mains of host moves that nothing uses are retired."""
    used = decided.where("outcome IN ('apply', 'already')")
    up = used.select(F.col("cand_id").alias("id"), F.lit(True).alias("_up")).distinct()
    old = used.where("host_move").select(F.col("main_id").alias("id")).join(links.select(F.col("url_id").alias("id")), "id", "left_anti").select("id", F.lit(True).alias("_out")).distinct()
    rows = urls.join(up, "id", "left").join(old, "id", "left")
    back = F.col("_up").isNotNull() & (F.col("status") == "retired")
    return rows.select(*[
        F.when(F.col("_up").isNotNull() & (F.col("role") == "index"), "seed").otherwise(F.col(c)).alias(c) if c == "role"
        else F.when(back, "queued").when(F.col("_out").isNotNull(), "retired").otherwise(F.col(c)).alias(c) if c == "status"
        else F.when(back, now).otherwise(F.col(c)).alias(c) if c == "next_crawl_at" else F.col(c) for c in urls.columns
    ])
