import json

import pytest
from pyspark.sql import functions as F

from pagewarden import schema
from pagewarden.operators import candidates, crawl, facts, registry_import, review_links
from pagewarden.operators.store import Store, insert_ignore, upsert
from pagewarden.plans import relational, report
from pagewarden.sources import registry, reviews
from pagewarden.streaming.states import step

def now():
    return F.lit("2026-01-01 00:00:00").cast("timestamp")



def row(psid, area, uri, name="児童手当", related=None, description=None, **ages):
    bound = lambda k: {"targetAge": ages.get(k), "targetAgeOfMonths": None}
    return {
        "institutionName": {"canonicalName": name, "shortName": None}, "target": {k: bound(k) for k in ("lessThan", "lessThanOrEqualTo", "greaterThanOrEqualTo", "greaterThan")},
        "localGovernmentLink": {"uri": uri}, "area": {"areaCode": area}, "basicInformation": {"psid": psid}, "tag": {"categoryCode": ["3"], "targetCode": None, "contentsCode": ["077"]},
        "relatedLink": related, "description": description,
    }


REGISTRY = [
    row("p+131130+1+UM24", "131130;渋谷区", "https://a.jp/kosodate/teate.html", greaterThanOrEqualTo=0, lessThan=3),
    row("p+131130+1+UM3", "131130;渋谷区", "https://a.jp/kosodate/todoke.html,https://a.jp/x.html", "出生届", [{"uri": "https://b.jp/1"}, {"uri": "https://a.jp/f.pdf"}, None], "https://a.jp/y.html。"),
    row("p+130001+1+UM58", "130001; 東京都", "https://a.jp/kosodate/teate.html#x", "給付"),
]


def load(spark, tmp_path, rows):
    path = tmp_path / "r.json"
    path.write_text(json.dumps(rows, ensure_ascii=False) if not isinstance(rows, str) else rows)
    return registry.read_registry(spark, str(path))


def test_import_twice(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/db")
    rows = load(spark, tmp_path, REGISTRY)
    counts = registry_import.import_registry(store, rows, now())
    assert counts == {"areas": 2, "programs": 3, "urls": 2, "program_urls": 3}
    before = {t: sorted(map(str, store.read(t).collect())) for t in counts}
    assert registry_import.import_registry(store, rows, now()) == counts
    assert {t: sorted(map(str, store.read(t).collect())) for t in counts} == before
    got = {r.psid: r for r in store.read("programs").collect()}["p+131130+1+UM24"]
    assert (got.um, got.category_codes, got.content_codes, got.age_min_months, got.age_max_months) == ("UM24", ["003"], ["077"], 0, 36)
    listed = facts.area_programs(store.read("programs"), store.read("areas"), "131130", age_months=12).select("um").collect()
    assert [r.um for r in listed] == ["UM3", "UM24"] or {r.um for r in listed} >= {"UM3", "UM24"}
    with pytest.raises(ValueError):
        facts.area_programs(store.read("programs"), store.read("areas"), "131130", age_months=-1)


@pytest.mark.parametrize("text, error", [("{", "invalid_json"), ("{}", "not_an_array"), ([{"a": 1}], "bad_record"), ([row("x", "131130;a", "u")], "bad_psid"), ([row("x+UM1", "1;a", "u")], "bad_area")])
def test_registry_errors(spark, tmp_path, text, error):
    assert registry.parse(load(spark, tmp_path, text)).first().error.startswith(error)


def test_related(spark, tmp_path):
    p = registry.parse(load(spark, tmp_path, REGISTRY)).select(F.col("psid").alias("program_id"), "registry", F.lit("https://a.jp/kosodate/todoke.html").alias("main_key"), F.lit("https://a.jp").alias("main_host"))
    got = candidates.related(p, spark.createDataFrame([("https://a.jp",)], "host_key string")).where("program_id LIKE '%UM3'").orderBy("pos").collect()
    assert [(r.p.normalized, r.reason, r.rank) for r in got] == [("https://a.jp/x.html", None, 1), ("https://b.jp/1", "other_host", None), ("https://a.jp/f.pdf", "not_html", None), ("https://a.jp/y.html", None, 2)]


def test_suggestions(spark):
    t = spark.createDataFrame([("p", "児童手当について", None, "h")], "program_id string, canonical_name string, short_name string, host_key string")
    rows = [("h", f"https://a.jp/{i}", f"k{i}", text) for i, text in enumerate(["児童手当", "児童手当ページ", "ごみ", "児童手当に", "児童手当とは"])] + [("h", "https://a.jp/x.pdf", "x", "児童手当")]
    out = candidates.suggestions(t, spark.createDataFrame(rows, "host_key string, url string, dedup_key string, text string"), spark.createDataFrame([("p", "k3")], "program_id string, dedup_key string")).orderBy("rank").collect()
    assert [r.dedup_key for r in out][:1] == ["k0"] and all(r.score >= 0.6 for r in out) and "k3" not in {r.dedup_key for r in out} and "x" not in {r.dedup_key for r in out}


def test_merges(spark):
    t = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "k int, v string, w string")
    c = spark.createDataFrame([(2, "B", "Y"), (3, "C", "Z")], "k int, v string, w string")
    assert sorted(map(tuple, upsert(t, c, ["k"], ["v"]).collect())) == [(1, "a", "x"), (2, "B", "y"), (3, "C", "Z")]
    assert sorted(map(tuple, insert_ignore(t, c.unionByName(c), ["k"]).collect())) == [(1, "a", "x"), (2, "b", "y"), (3, "C", "Z")]


def test_chain_with_a_cycle(spark):
    e = spark.createDataFrame([(1, 2), (2, 3), (3, None), (4, 5), (5, 4)], "n int, t int")
    got = {r.n: (r.end, r.hops) for r in relational.chain_ends(e, "n", "t", 10).collect()}
    assert got[1] == (3, 2) and got[3] == (3, 0) and got[4][1] == 10


def urls_table(spark, rows):
    d = spark.createDataFrame(rows, "id string, host_key string, status string, priority int, claim_token long, retry_count int")
    d = d.withColumn("next_crawl_at", now()).withColumn("attempt_count", F.lit(0)).withColumn("role", F.lit("seed"))
    return d.select(*[F.col(f.name) if f.name in d.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.URLS])


def test_every_joined_url_is_a_source(spark):
    links = [f"https://a.jp/{k}" for k in range(1200)]
    row = spark.createDataFrame([(json.dumps({"localGovernmentLink": {"uri": ",".join(links)}}),), ("{}",)], "r string")
    assert sorted((r[0] for r in row.select(candidates.source_values(F.col("r"))).collect()), key=len) == [[], links[1:]]


def test_claim_takes_every_pick(spark):
    ids = spark.range(10_050).select(F.col("id").cast("string").alias("id"))
    u = ids.selectExpr("id", "'idle' AS status", "0L AS claim_token", "CAST(NULL AS timestamp) AS lease_until", "CAST(NULL AS string) AS worker_id")
    assert crawl.claim(u, ids, "w", 600, now()).where("status = 'processing' AND claim_token = 1").count() == 10_050


def test_claim_and_complete(spark):
    u = urls_table(spark, [("a", "h", "queued", 1, 0, 0), ("b", "h", "queued", 2, 0, 0), ("c", "g", "retired", 1, 0, 0)])
    keyed = u.withColumnRenamed("id", "url_id")
    assert [r.url_id for r in relational.claim_candidates(keyed, now()).collect()] == ["b"]
    u = crawl.claim(u, u.where("id = 'b'").select("id"), "w", 600, now())
    assert u.where("id = 'b'").first().claim_token == 1
    assert relational.claim_candidates(u.withColumnRenamed("id", "url_id"), now()).count() == 0  # the host is leased
    done = spark.createDataFrame([("b", 1, "succeeded", None, "page", "unknown"), ("a", 9, "succeeded", None, "page", "unknown")], "url_id string, claim_token long, job string, error_type string, kind string, change string")
    got = {r.id: r for r in crawl.complete(u, done, now()).collect()}
    assert (got["b"].status, got["b"].recrawl_interval_secs, got["b"].attempt_count, got["b"].lease_until) == ("succeeded", 7 * 86400, 1, None) and got["a"].status == "queued"
    assert crawl.postpone(u, spark.createDataFrame([("h",)], "host_key string"), 86400, now()).where("id = 'a'").first().next_crawl_at.day == 2


def test_resolution(spark):
    empty = lambda k: spark.createDataFrame([], schema.TABLES[k])
    obs = "url_id string, from_id string, canonical_url string, source string, final_url string, relation string, declared string, observation string"
    res, links, r = crawl.apply_resolution(empty("resources"), empty("url_resources"), spark.createDataFrame([("u", None, "https://a/1", "normalized", "https://a/1", "direct", None, "alive")], obs), now())
    a = res.first()
    assert a.state == "active" and links.count() == 1
    res2, _, r = crawl.apply_resolution(res, links, spark.createDataFrame([("u", a.id, "https://a/2", "redirect", "https://a/2", "redirect", None, "alive")], obs), now())
    assert r.first().action == "renamed" and [(x.id, x.canonical_url, x.canonical_source) for x in res2.collect()] == [(a.id, "https://a/2", "redirect")]
    both = res.unionByName(res.withColumn("id", F.lit("z")).withColumn("canonical_url", F.lit("https://a/3")))
    res3, _, r = crawl.apply_resolution(both, links, spark.createDataFrame([("u", a.id, "https://a/3", "redirect", "https://a/3", "redirect", None, "alive")], obs), now())
    moved = {x.id: x for x in res3.collect()}[a.id]
    assert (r.first().action, moved.state, moved.moved_to_resource_id) == ("absorbed", "moved", "z")


def test_observe_and_links(spark):
    res = spark.createDataFrame([("r", "https://a/1", "active", "h1", 4)], "id string, canonical_url string, state string, body_hash string, extractor_version int")
    res = res.withColumn("consecutive_not_found", F.lit(0)).withColumn("change_count", F.lit(0))
    res = res.select(*[F.col(f.name) if f.name in res.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.RESOURCES])
    cols = ["etag", "last_modified", "raw_hash", "page_hash", "title_hash", "body_hash", "links_hash", "page_updated_on", "extractor_version", "extractor_rule", "robots_meta"]
    base = spark.createDataFrame([("r", "alive")], "resource_id string, observation string")
    seen = base.select("*", *[F.lit({"raw_hash": "x", "body_hash": "h2", "extractor_version": 4}.get(c)).alias(c) for c in cols])
    got = crawl.observe(res, seen, now()).first()
    assert (got.body_hash, got.change_count, got.last_changed_at is not None) == ("h2", 1, True)
    got = crawl.observe(res, seen.withColumn("observation", F.lit("not_found")), now()).first()
    assert (got.body_hash, got.state, got.consecutive_not_found) == ("h1", "deletion_candidate", 1)
    links = spark.createDataFrame([], schema.PAGE_LINKS)
    pages = spark.sql("SELECT 'r' AS resource_id, 'h' AS host_key, true AS index, true AS links_changed, array(named_struct('url','u','text','t','dedup_key','k','host_key','h'), named_struct('url','v','text','t','dedup_key','k','host_key','g')) AS anchors")
    links = crawl.replace_links(links, pages)
    assert [r.url for r in links.collect()] == ["u"] and crawl.replace_links(links, pages.withColumn("links_changed", F.lit(False))).count() == 1


def test_reviews(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"reviewed_at": "x", "reviews": [
        {"program_id": "p1", "dead_url": "https://a.jp/old", "verdict": "hit", "url": "https://a.jp/new", "rejected": ["https://a.jp/no"]},
        {"program_id": "p2", "dead_url": "https://a.jp/old2", "verdict": "hit", "url": "https://b.jp/x"},
        {"program_id": "p3", "dead_url": "https://a.jp/old3", "verdict": "none", "url": None}]}))
    checked = reviews.validated(reviews.read_reviews(spark, str(tmp_path))).cache()
    assert {r.program_id: r.errors for r in checked.collect()} == {"p1": [], "p2": ["other_host"], "p3": []}
    assert {tuple(r) for r in reviews.judged(checked).collect()} == {("p1", "https://a.jp/new"), ("p1", "https://a.jp/no"), ("p2", "https://b.jp/x")}
    ok = checked.where("size(errors) = 0")
    u = spark.createDataFrame([("o", "https://a.jp/old", "succeeded"), ("n", "https://a.jp/new", "succeeded")], "id string, dedup_key string, status string")
    links = spark.createDataFrame([("p1", "o", "main", 1, "registry")], schema.PROGRAM_URLS)
    ur = spark.createDataFrame([("o", "ro"), ("n", "rn")], "url_id string, resource_id string").withColumn("observed_at", now())
    res = spark.createDataFrame([("ro", "deleted"), ("rn", "active")], "id string, state string")
    moves = spark.createDataFrame([], schema.HOST_MOVES)
    got = review_links.ladder(ok, links, u, ur, res, moves)
    assert {r.program_id: r.outcome for r in got.collect()} == {"p1": "apply", "p3": "none"}
    assert [tuple(r) for r in review_links.apply(links, got).collect()] == [("p1", "n", "main", 1, "discovered")]
    alive = review_links.ladder(ok, links, u, ur, res.withColumn("state", F.lit("active")), moves).where("program_id = 'p1'").first()
    assert alive.outcome == "main_not_dead"


def test_report_text():
    text = report.markdown("weekly", "2026-01-01", [{"host": "h", "fetched": 2, "responses": 2, "not_modified_ratio": 0.5, "throttled_rate": None}], [{"kind": "surge", "host": "h", "count": 5, "rate": 0.25}])
    assert "| h | 2 | 2 | 50.0% | — |" in text and "- surge at h: 5 (25.0%)" in text


def test_stream_step_is_the_rule(spark):
    from pagewarden.functions import decisions

    seen = ["alive", "not_found", "gone", "top_redirect"]
    cases = [(s, m, o) for s in ("active", "deletion_candidate", "deleted", "moved") for m in (0, 2) for o in seen]
    rows = spark.createDataFrame(cases, "s string, m int, o string").select("s", "m", "o", decisions.next_state(F.col("s"), F.col("m"), F.col("o")).alias("n")).collect()
    assert all((r.n.state, r.n.misses) == step(r.s, r.m, r.o) for r in rows)


def test_replayed_fetches(spark):
    from pagewarden.sources.replay import fetches, follow

    pages = {"https://a.jp/1": (301, {"location": "/2"}, b""), "https://a.jp/2": (200, {"content-type": "text/html"}, b"<p>x"), "https://a.jp/l": (302, {"location": "/l"}, b""), "https://a.jp/o": (301, {"location": "https://b.jp/"}, b""), "https://a.jp/m": (301, {}, b"")}
    ask = lambda u: pages.get(u, "timeout")
    got = {u: follow(f"https://a.jp/{u}", {"https://a.jp"}, ask)["outcome"] for u in "12lomx"}
    assert got == {"1": "response", "2": "response", "l": "redirect_loop", "o": "out_of_scope", "m": "missing_location", "x": "network"}
    claims = spark.createDataFrame([("u", "https://a.jp/1", "https://a.jp")], "url_id string, url string, host_key string")
    row = fetches(claims, {"https://a.jp"}, ask).first()
    assert [h.status for h in row.hops] == [301, 200] and bytes(row.body) == b"<p>x"


def test_answers(spark, tmp_path):
    from pagewarden import api

    store = Store(spark, f"file://{tmp_path}/db")
    registry_import.import_registry(store, load(spark, tmp_path, REGISTRY), now())
    body = api.area_programs(store, "131130", "12")
    assert [p["um"] for p in body["data"]] == ["UM3", "UM24", "UM58"] and body["data"][0]["auto_update"] is True
    assert api.program(store, body["data"][0]["id"])["data"]["url"].startswith("https://a.jp/")
    for call, status in ((lambda: api.area_programs(store, "000000"), 404), (lambda: api.area_programs(store, "131130", "-1"), 400), (lambda: api.program(store, "x"), 404)):
        try:
            call()
            raise AssertionError
        except (api.NotFound, api.BadRequest) as e:
            assert api.error(e)[0] == status


def test_command_line(spark, tmp_path, capsys):
    from pagewarden import cli

    (tmp_path / "r.json").write_text(json.dumps(REGISTRY, ensure_ascii=False))
    db = f"file://{tmp_path}/db"
    assert cli.main([db, "import-registry", "--source", str(tmp_path / "r.json")], spark) == 0
    assert cli.main([db, "register-index"], spark) == 0
    assert Store(spark, db).read("urls").where("role = 'index' AND priority = 90").select("normalized_url").first()[0] == "https://a.jp/kosodate/"
    assert cli.main([db, "programs", "131130"], spark) == 0 and cli.main([db, "programs", "9"], spark) == 1
    assert "児童手当" in capsys.readouterr().out
