"""Registry import: areas and programs are upserted, URLs come in once, main links are rebuilt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab as V
from ..functions.urls import prepared, split_joined
from ..sources.registry import areas, parse
from .store import Store, insert_ignore, upsert, uuid_of


def main_urls(programs: DataFrame) -> DataFrame:
    """(psid, idx, p): the first URL of each program, prepared; p.rejection says why one is not used."""
    return programs.select("psid", "idx", prepared(split_joined(F.col("source_url"))[0]).alias("p"))


def url_rows(p: DataFrame, role: str, priority: int, now: Column, first: str = "idx") -> DataFrame:
    """New queue rows of prepared URLs, one for each key, the first one seen; crawl state at its defaults."""
    rows = p.where("p.rejection IS NULL AND p.normalized IS NOT NULL").groupBy(F.col("p.dedup_key").alias("dedup_key")).agg(F.min_by("p", first).alias("p"))
    return rows.select(
        uuid_of("dedup_key").alias("id"), F.col("p.raw").alias("raw_url"), F.col("p.normalized").alias("normalized_url"), "dedup_key", F.col("p.host_key").alias("host_key"), F.lit(role).alias("role"), F.lit(0).alias("depth"), F.lit(priority).alias("priority"),
        F.lit("queued").alias("status"), now.alias("next_crawl_at"), F.lit(0).alias("attempt_count"), F.lit(0).alias("retry_count"), F.lit(0).cast("long").alias("claim_token"),
    )


def rebuilt_mains(links: DataFrame, mains: DataFrame) -> DataFrame:
    """Links after an import: registry mains are replaced, mains that a review found stay, and a related link to the new main
    goes. mains: (program_id, url_id)."""
    reviewed = links.where("role = 'main' AND source = 'discovered'").select("program_id")
    fresh = mains.join(reviewed, "program_id", "left_anti").select("program_id", "url_id", F.lit("main").alias("role"), F.lit(1).alias("rank"), F.lit("registry").alias("source"))
    kept = links.where("NOT (role = 'main' AND source = 'registry')").join(fresh.select("program_id", "url_id"), ["program_id", "url_id"], "left_anti")
    return kept.unionByName(fresh)


def import_registry(store: Store, rows: DataFrame, now: Column) -> dict[str, int]:
    """Imports registry rows; any row with an error stops it, rejected URLs do not. Counts of what is there afterwards."""
    programs = parse(rows).cache()
    bad = programs.where("error IS NOT NULL").orderBy("idx").select("idx", "error").first()
    if bad:
        raise ValueError(f"row {bad.idx}: {bad.error}")
    store.write("areas", upsert(store.read("areas"), areas(programs), ["code"], ["name", "parent_code"]))
    fresh = programs.drop("idx", "error", "area_name").withColumn("id", uuid_of("psid")).withColumn("imported_at", now)
    store.write("programs", upsert(store.read("programs"), fresh, ["psid"], [c for c in fresh.columns if c not in ("id", "psid")]))
    ready = main_urls(programs)
    store.write("urls", insert_ignore(store.read("urls"), url_rows(ready, "seed", V.PRIORITY_MAIN, now), ["dedup_key"]))
    ids = store.read("programs").select(F.col("id").alias("program_id"), "psid")
    keys = store.read("urls").select(F.col("id").alias("url_id"), "dedup_key")
    mains = ready.where("p.rejection IS NULL").select("psid", F.col("p.dedup_key").alias("dedup_key")).join(ids, "psid").join(keys, "dedup_key").select("program_id", "url_id")
    store.write("program_urls", rebuilt_mains(store.read("program_urls"), mains))
    return {t: store.read(t).count() for t in ("areas", "programs", "urls", "program_urls")}
