"""Facts of programs for readers: current URL, state, moved target and related links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import codes
from ..functions import vocab as V
from ..plans.relational import chain_ends, latest


def facts(programs: DataFrame, links: DataFrame, urls: DataFrame, url_resources: DataFrame, resources: DataFrame) -> DataFrame:
    """One row per program: url (at the end of a moved chain), state, checked_at, changed_at (of the first resource),
    auto_update, moved_to, and related links of dead programs by rank."""
    now = latest(url_resources, "url_id", "observed_at", "resource_id").select("url_id", "resource_id")
    ends = chain_ends(resources.select("id", "moved_to_resource_id"), "id", "moved_to_resource_id").select("id", "end")
    r = resources.select("id", "canonical_url", "state", F.col("last_crawled_at").alias("checked_at"), F.col("last_changed_at").alias("changed_at")).join(ends, "id")
    r = r.join(resources.select(F.col("id").alias("end"), F.col("canonical_url").alias("end_url")), "end", "left")
    own = links.join(urls.select(F.col("id").alias("url_id"), "raw_url", "status"), "url_id").join(now, "url_id", "left").join(r.withColumnRenamed("id", "resource_id"), "resource_id", "left")
    main = own.where("role = 'main'").select("program_id", F.col("resource_id").alias("main_resource"), "status", "state", "checked_at", "changed_at", "end_url")
    others = own.where("role = 'related'").join(main.select("program_id", "main_resource", F.col("state").alias("main_state")), "program_id").where(F.col("main_state").isin(*V.DEAD) & ~F.coalesce(F.col("resource_id") == F.col("main_resource"), F.lit(False)))
    rel = others.groupBy("program_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", F.coalesce("end_url", "raw_url").alias("url"), "state"))), lambda x: F.struct(x["url"].alias("url"), x["state"].alias("state"))).alias("related"))
    out = programs.join(main, F.col("id") == main["program_id"], "left").drop("program_id").join(rel, F.col("id") == rel["program_id"], "left")
    none = F.array().cast("array<struct<url:string,state:string>>")
    return out.select("id", F.coalesce("end_url", "source_url").alias("url"), "state", "checked_at", "changed_at", F.coalesce(F.col("status") != "blocked", F.lit(True)).alias("auto_update"), F.when(F.col("state") == "moved", F.col("end_url")).alias("moved_to"), F.coalesce("related", none).alias("related"))


def area_programs(programs: DataFrame, areas: DataFrame, code: str, age_months: int | None = None, category: str | None = None) -> DataFrame:
    """Programs of an area and the one above it, in the readers' order. A negative age is an error."""
    if age_months is not None and age_months < 0:
        raise ValueError("age_months must not be negative")
    here = areas.where(F.col("code") == code)
    codes_of = here.select("code").unionByName(here.where("parent_code IS NOT NULL").select(F.col("parent_code").alias("code")))
    out = programs.join(codes_of, F.col("area_code") == F.col("code"), "left_semi")
    if age_months is not None:
        out = out.where(codes.age_matches(age_months, F.col("age_min_months"), F.col("age_max_months")))
    if category is not None:
        out = out.where(F.array_contains("category_codes", category))
    return out.drop("registry").orderBy(F.desc("area_code"), F.substring("um", 3, 20).cast("int").asc(), F.asc("psid"))
