"""Relational building blocks: latest row per key, as-of values, exclusions, chains, allow-lists, coverage, merges of maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import vocab as V


def latest(df: DataFrame, key: str | list[str], *order: str) -> DataFrame:
    """The row of each key that is last by ``order``. max_by combines before the shuffle, so hot keys cost little."""
    keys = [key] if isinstance(key, str) else key
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def first_by(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The row of each key that comes first by ``order``."""
    rest = [c for c in df.columns if c != key]
    picked = df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(key, *[F.col(f"_row.{c}").alias(c) for c in rest])


def ranked(df: DataFrame, key: str | list[str], order: list[Column], most: int, name: str = "rank") -> DataFrame:
    """The first ``most`` rows of each key with their rank; the limit goes into the window (WindowGroupLimit)."""
    keys = [key] if isinstance(key, str) else key
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= most)


def previous_known(df: DataFrame, key: str, order: str, value: Column) -> Column:
    """As-of: the last value that is not null in an earlier row of the key."""
    return F.last(value, ignorenulls=True).over(W.partitionBy(key).orderBy(order).rowsBetween(W.unboundedPreceding, -1))


def allow_list(urls: DataFrame, moves: DataFrame | None = None) -> DataFrame:
    """Hosts that may be fetched: those of the URLs and the targets of approved moves."""
    hosts = urls.select("host_key").where("host_key IS NOT NULL")
    if moves is not None:
        hosts = hosts.unionByName(moves.where("status = 'approved'").select(F.col("to_host_key").alias("host_key")))
    return hosts.distinct()


def in_scope(urls: DataFrame, hosts: DataFrame) -> DataFrame:
    return urls.join(hosts, "host_key", "left_semi")


def dead_programs(programs: DataFrame, links: DataFrame, current: DataFrame, resources: DataFrame) -> DataFrame:
    """Programs whose main URL's current resource is gone or about to be."""
    main = links.where("role = 'main'").select("program_id", "url_id")
    return programs.join(main, "program_id").join(current.select("url_id", "resource_id"), "url_id").join(resources.where(F.col("state").isin(*V.DEAD)), "resource_id")


def chain_ends(edges: DataFrame, node: str, target: str, hops: int = 10) -> DataFrame:
    """(node, end, hops): where following ``target`` leads, at most ``hops`` steps, null targets ending it. Unrolled joins,
    so a cycle ends with the bound; only rows whose chain goes on are joined again."""
    nxt = edges.where(F.col(target).isNotNull()).select(F.col(node).alias("_n"), F.col(target).alias("_t"))
    out = edges.select(F.col(node), F.col(node).alias("end"), F.lit(0).alias("hops"))
    for k in range(hops):
        on = F.when(F.col("hops") == k, F.col("end"))
        out = out.join(nxt, on == F.col("_n"), "left").select(node, F.coalesce("_t", "end").alias("end"), (F.col("hops") + F.col("_t").isNotNull().cast("int")).alias("hops"))
    return out


def coverage(starts: DataFrame) -> DataFrame:
    """Rows (host, state) of fetched index pages: starts, live pages, and whether the host is of no use."""
    out = starts.groupBy("host").agg(F.count("*").alias("starts"), F.count_if(F.coalesce(F.col("state") == "active", F.lit(False))).alias("live_pages"))
    return out.withColumn("unusable", (F.col("starts") >= V.UNUSABLE_STARTS) & (F.col("live_pages") == 0))


def add_maps(a: Column, b: Column) -> Column:
    """Sums of two count maps by key."""
    empty = F.create_map().cast("map<string,bigint>")
    return F.map_zip_with(F.coalesce(a, empty), F.coalesce(b, empty), lambda _, x, y: F.coalesce(x, F.lit(0)) + F.coalesce(y, F.lit(0)))


def untrusted_hosts(declarations: DataFrame) -> DataFrame:
    """Rows (host, page, declared), one for each page: hosts whose declarations are not believed, with the reason.

    chain: a declared page declares something else in turn. same_target: all other pages declare one target, three at least."""
    pointing = declarations.where("page <> declared")
    nxt = declarations.select("host", F.col("page").alias("declared"), F.col("declared").alias("next"))
    chained = pointing.join(nxt, ["host", "declared"]).where("next <> declared").groupBy("host").agg(F.lit(True).alias("chain"))
    target = pointing.groupBy("host").agg(F.min_by("declared", "page").alias("target"), F.count("*").alias("pages"))
    same = declarations.join(target, "host").where("page <> target").groupBy("host").agg(F.bool_and(F.col("declared") == F.col("target")).alias("same"), F.first("pages").alias("pages"))
    both = target.select("host").join(chained, "host", "left").join(same, "host", "left")
    reason = F.when(F.col("chain"), "chain").when(F.col("same") & (F.col("pages") >= V.SAME_TARGET_PAGES), "same_target")
    return both.select("host", reason.alias("reason")).where("reason IS NOT NULL")


def claim_candidates(urls: DataFrame, now: Column, ahead_s: int = 0, busy: DataFrame | None = None) -> DataFrame:
    """One URL for each host without a live lease: the due one of highest priority. busy: (url_id, resource_id) at work."""
    lease = (F.col("status") == "processing") & (F.col("lease_until") > now)
    held = urls.where(lease).select("host_key").distinct()
    due = (
        (F.col("status").isin("queued", "succeeded", "failed_final", "blocked") & (F.col("next_crawl_at") <= now + F.make_dt_interval(secs=F.lit(ahead_s))))
        | ((F.col("status") == "retry_wait") & (F.col("next_crawl_at") <= now))
        | ((F.col("status") == "processing") & (F.col("lease_until") <= now))
    )
    free = urls.where((F.col("status") != "retired") & due).join(held, "host_key", "left_anti")
    if busy is not None:
        taken = busy.select(F.col("url_id").alias("_taker"), "resource_id")
        free = free.join(taken, (free["resource_id"] == taken["resource_id"]) & (F.col("url_id") != F.col("_taker")), "left_anti")
    return ranked(free, "host_key", [F.desc("priority"), F.asc_nulls_last("next_crawl_at"), F.asc("url_id")], 1).drop("rank")


def pick(candidates: DataFrame, ready_at: Column, now: Column, limit: int) -> DataFrame:
    """The next URLs to fetch: hosts that are ready first, then priority, due time and id."""
    return candidates.orderBy(F.greatest(ready_at, now).asc(), F.desc("priority"), F.asc_nulls_last("next_crawl_at"), F.asc("url_id")).limit(limit)


def next_retry_in(urls: DataFrame, now: Column) -> DataFrame:
    """Seconds until the first waiting retry, 0 if it is due; null if none waits."""
    first = F.min(F.when(F.col("status") == "retry_wait", F.col("next_crawl_at")))
    return urls.agg(F.greatest(F.lit(0).cast("long"), F.round((F.unix_micros(first) - F.unix_micros(now)) / 1e6).cast("long")).alias("seconds"))


def park(urls: DataFrame, starts: DataFrame, links: DataFrame) -> DataFrame:
    """Index URLs that are no start any more and that no program uses."""
    return urls.where("role = 'index' AND status <> 'retired'").join(starts.select("dedup_key"), "dedup_key", "left_anti").join(links.select("url_id"), "url_id", "left_anti")
