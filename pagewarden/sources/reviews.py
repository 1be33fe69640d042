"""Review files: JSON files directly under a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions.urls import prepared


def read_reviews(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each review: file, pos, program_id, dead_url, verdict, url, host_move, rejected, in the files' order."""
    files = spark.read.schema(schema.REVIEWS).option("multiLine", True).option("pathGlobFilter", "*.json").json(folder).select(F.col("_metadata.file_name").alias("file"), F.posexplode("reviews").alias("pos", "r"))
    return files.select("file", "pos", "r.program_id", "r.dead_url", "r.verdict", "r.url", F.coalesce("r.host_move", F.lit(False)).alias("host_move"), F.coalesce("r.rejected", F.array().cast("array<string>")).alias("rejected")).orderBy("file", "pos")


def validated(reviews: DataFrame) -> DataFrame:
    """reviews with their prepared URLs (u, dead, rejected_keys) and all errors found."""
    r = reviews.withColumn("u", prepared("url")).withColumn("dead", prepared("dead_url"))
    each = r.select("file", "pos", F.explode_outer("rejected").alias("x")).withColumn("p", prepared("x")).groupBy("file", "pos").agg(F.collect_list(F.when(F.col("x").isNotNull(), F.struct("x", "p.dedup_key", "p.host_key", "p.rejection"))).alias("rj"))
    twice = r.groupBy("file", "program_id").agg((F.count("*") > 1).alias("twice"))
    r = r.join(each, ["file", "pos"]).join(twice, ["file", "program_id"])
    rest = lambda c: F.regexp_replace(c, r"^https?://[^/?#]+", "")
    same_host = F.col("u.host_key") == F.col("dead.host_key")
    found = [
        (F.col("twice"), "duplicate_program"), (F.col("host_move") & (F.col("verdict") != "hit"), "host_move_without_hit"), (F.col("verdict").isin("hit", "index") & F.col("url").isNull(), "no_url"), ((F.col("verdict") == "none") & F.col("url").isNotNull(), "url_with_none"),
        (F.col("u.rejection").isNotNull(), "unreadable_url"), (F.col("dead.rejection").isNotNull(), "unreadable_dead_url"), (F.exists("rj", lambda x: x["rejection"].isNotNull()), "unreadable_rejected"), (~F.col("host_move") & ~same_host, "other_host"), (F.col("host_move") & same_host, "same_host"),
        (F.col("host_move") & (rest(F.col("u.normalized")) != rest(F.col("dead.normalized"))), "other_path"), (F.exists("rj", lambda x: x["host_key"] != F.col("dead.host_key")), "rejected_on_other_host"),
    ]
    return r.withColumn("errors", F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for c, n in found])))


def judged(checked: DataFrame) -> DataFrame:
    """(program_id, dedup_key) that a review has decided: its URL and every rejected one."""
    return checked.select("program_id", F.explode(F.array_compact(F.concat(F.array("u.dedup_key"), F.transform("rj", lambda x: x["dedup_key"])))).alias("dedup_key")).distinct()
