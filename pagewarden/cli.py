"""Command line: python -m pagewarden.cli STORE COMMAND ..."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from . import api
from .operators import candidates, crawl, moves, registry_import, review_links
from .operators.store import Store
from .plans import runs
from .sources import registry, reviews


def main(args: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="pagewarden")
    p.add_argument("store")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("import-registry").add_argument("--source", required=True)
    sub.add_parser("register-index")
    move = sub.add_parser("approve-host-move")
    move.add_argument("--from", dest="old", required=True)
    move.add_argument("--to", dest="new", required=True)
    rev = sub.add_parser("apply-reviews")
    rev.add_argument("step", choices=["register", "link"])
    rev.add_argument("folder")
    rev.add_argument("--dry-run", action="store_true")
    related = sub.add_parser("link-related")
    related.add_argument("--dry-run", action="store_true")
    told = sub.add_parser("run-report")
    told.add_argument("--run")
    told.add_argument("--append", help="a file that the report is added to")
    moved = sub.add_parser("suggest-moves")
    moved.add_argument("--reviews", help="a folder of review files whose pages are left out")
    moved.add_argument("--out", help="the file of candidates")
    show = sub.add_parser("programs")
    show.add_argument("area")
    show.add_argument("--age-months")
    show.add_argument("--category")
    a = p.parse_args(args)
    spark = spark or SparkSession.builder.appName("pagewarden").getOrCreate()
    store, now = Store(spark, a.store), F.current_timestamp()
    if a.command == "import-registry":
        rows = registry.read_registry(spark, a.source)
        print(json.dumps(registry_import.import_registry(store, rows, now)))
        for r in registry.unknown_tags(registry.parse(rows)).collect():
            print(f"warning: row {r.idx}: unknown {r.kind} code {r.code}")
    elif a.command == "register-index":
        links = store.read("program_urls")
        mains = links.where("role = 'main'").join(store.read("urls").select(F.col("id").alias("url_id"), "normalized_url"), "url_id")
        if mains.isEmpty():
            print("error: no main URL")
            return 1
        store.write("urls", candidates.registered_starts(store.read("urls"), candidates.index_starts(mains), links, now))
    elif a.command == "approve-host-move":
        store.write("host_moves", crawl.approve(store.read("host_moves"), a.old, a.new))
    elif a.command == "apply-reviews":
        checked = reviews.validated(reviews.read_reviews(spark, a.folder)).cache()
        bad = checked.where("size(errors) > 0").select("file", "program_id", "errors").collect()
        for r in bad:
            print(f"error: {r.file}: {r.program_id}: {', '.join(r.errors)}")
        if bad:
            return 1
        if a.step == "register":
            urls = review_links.registered(store.read("urls"), checked, now)
            if not a.dry_run:
                store.write("urls", urls)
        else:
            links = store.read("program_urls")
            decided = review_links.ladder(checked, links, store.read("urls"), store.read("url_resources"), store.read("resources"), store.read("host_moves")).cache()
            counts = {r.outcome: r["count"] for r in decided.groupBy("outcome").count().collect()}
            print(json.dumps(counts))
            if not a.dry_run:
                after = review_links.apply(links, decided)
                store.write("urls", review_links.promoted(store.read("urls"), decided, after, now))
                store.write("program_urls", after)
            if set(counts) - {"none", "already", "apply"}:
                return 1
    elif a.command == "link-related":
        print(json.dumps(moves.link_related(store, now, a.dry_run)))
    elif a.command == "run-report":
        try:
            text = runs.markdown(runs.load(store.read("crawl_runs"), store.read("fetch_history"), store.read("urls"), now, a.run))
        except LookupError as e:
            print(f"error: {e}")
            return 1
        print(text)
        if a.append:
            with open(a.append, "a", encoding="utf-8") as out:
                out.write(text)
    elif a.command == "suggest-moves":
        none = spark.createDataFrame([], "program_id string, dedup_key string")
        judged = reviews.judged(reviews.validated(reviews.read_reviews(spark, a.reviews))) if a.reviews else none
        report = moves.suggest(store, judged)
        print(moves.markdown(report))
        if a.out:
            at = spark.range(1).select(now.cast("string")).first()[0]
            with open(a.out, "w", encoding="utf-8") as out:
                out.write(moves.candidate_file(report, at))
    else:
        try:
            print(json.dumps(api.area_programs(store, a.area, a.age_months, a.category), ensure_ascii=False))
        except (api.NotFound, api.BadRequest) as e:
            print(json.dumps(api.error(e)[1]))
            return 1
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
