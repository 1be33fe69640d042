import json

import pytest
from pyspark.sql import functions as F

from pagewarden import cli, schema
from pagewarden.functions import decisions, html
from pagewarden.operators import crawl, moves
from pagewarden.operators.store import Store
from pagewarden.plans import runs
from pagewarden.sources.replay import conditional, follow
from pagewarden.sources.robots import Robots, Rules


def rows(spark, table, *found):
    kind = schema.TABLES[table]
    return spark.createDataFrame([tuple(r.get(f.name) for f in kind) for r in found], kind)


def now():
    return F.lit("2026-01-08 00:00:00").cast("timestamp")


def at(day, hour=0):
    import datetime

    return datetime.datetime(2026, 1, day, hour)


def test_a_write_that_stops_leaves_the_old_table(spark, tmp_path, monkeypatch):
    store = Store(spark, f"file://{tmp_path}/db")
    one, two = (rows(spark, "areas", *[{"code": str(k)} for k in range(n)]) for n in (1, 2))
    store.write("areas", one)
    files = [p.name for p in (tmp_path / "db/areas").iterdir() if p.name.startswith("current-")]

    class Stops:
        def __getattr__(self, name):
            if name == "create":
                raise KeyboardInterrupt
            return getattr(fs, name)

    fs = store.fs
    monkeypatch.setattr(store, "fs", Stops())
    with pytest.raises(KeyboardInterrupt):
        store.write("areas", two)
    monkeypatch.undo()
    assert store.read("areas").count() == 1
    store.write("areas", two)
    assert store.read("areas").count() == 2 and len(files) == 1 and store.read("programs").isEmpty()


def test_rounds_share_nothing(spark):
    found = [(1, "G", "C1"), (2, "F", "C1"), (3, "F", "C2"), (4, None, "C3"), (5, "H", "C2"), (6, "K", "C9")]
    got = crawl.rounds(spark.createDataFrame([(str(u), f, c) for u, f, c in found], "url_id string, from_id string, canonical_url string")).collect()
    assert len(got) == len(found)
    number = {r.url_id: r.round for r in got}
    for a in got:
        for b in got:
            if a.url_id < b.url_id and (a.canonical_url == b.canonical_url or a.from_id and a.from_id == b.from_id):
                assert number[a.url_id] < number[b.url_id]
    assert number == {"1": 1, "2": 2, "3": 3, "4": 1, "5": 4, "6": 1}
    assert crawl.rounds(spark.createDataFrame([], "url_id string, from_id string, canonical_url string")).isEmpty()


def test_deeply_nested_pages():
    n = 20_000
    e = html.extract("<html><body>" + "<div>" * n + "<p>text <a href='/x.html'>x</a>" + "</div>" * n + "</body></html>", "https://a.jp/")
    assert e["body_text"] == "text x" and e["links"] == ["https://a.jp/x.html"]


ROBOTS = """User-agent: *
Disallow: /private
Allow: /private/open
Disallow: /*.php$
Crawl-delay: 5

User-agent: other
User-agent: Warden
Disallow: /no # not this
"""


def test_robots_rules():
    every, own = Rules(ROBOTS, "nobody"), Rules(ROBOTS, "warden")
    assert [every.allows(f"https://a.jp{p}") for p in ("", "/", "/private/x", "/private/open/x", "/a.php", "/a.php?x", "/no")] == [True, True, False, True, False, True, True]
    assert every.delay == 5.0 and own.delay is None and not own.allows("https://a.jp/no/1") and own.allows("https://a.jp/private")


def test_robots_are_asked_once_and_followed():
    asked = []

    def exchange(url):
        asked.append(url)
        if url == "https://a.jp/robots.txt":
            return 301, {"location": "https://b.jp/robots.txt"}, b""
        if url == "https://b.jp/robots.txt":
            return 200, {}, b"User-agent: *\nDisallow: /secret"
        return {"https://c.jp/robots.txt": (404, {}, b""), "https://d.jp/robots.txt": (503, {}, b""), "https://e.jp/robots.txt": "timeout"}.get(url, (200, {}, b"page"))

    allowed = {f"https://{h}.jp" for h in "abcde"}
    robots = Robots("warden", allowed, exchange)
    got = [follow(u, allowed, exchange, robots)["outcome"] for u in ("https://a.jp/x", "https://a.jp/secret/1", "https://c.jp/", "https://d.jp/", "https://e.jp/")]
    assert got == ["response", "robots_denied", "response", "robots_unavailable", "robots_unavailable"]
    assert asked.count("https://a.jp/robots.txt") == 1 and Robots("x", {"https://a.jp"}, exchange)("https://a.jp", "https://a.jp/secret") == "allow"


def test_conditional_requests():
    page = lambda url: (200, {"etag": '"1"', "last-modified": "Mon"}, b"x")
    status = lambda *v: conditional(page, *v)("https://a.jp/")[0]
    assert (status('"1"', None), status('"2"', "Mon"), status(None, "Mon"), status(None, None)) == (304, 200, 304, 200)


def test_look_ahead_stays_under_the_shortest_interval():
    assert decisions.shortest_interval_s() == 3 * 86_400 and decisions.longest_retry_wait_s() == 605
    assert decisions.checked_ahead(3600) == 3600
    with pytest.raises(ValueError):
        decisions.checked_ahead(3 * 86_400)


@pytest.fixture
def store(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/db")
    url = lambda i, path, role="seed", **more: {"id": i, "raw_url": f"https://a.jp{path}", "normalized_url": f"https://a.jp{path}", "dedup_key": f"a.jp{path}", "host_key": "https://a.jp", "role": role, "status": "queued"} | more
    registry = json.dumps({"localGovernmentLink": {"uri": "https://a.jp/dead.html"}, "relatedLink": [{"uri": "https://a.jp/other.html"}, {"uri": "https://b.jp/x.html"}, {"uri": "https://a.jp/f.pdf"}]})
    s.write("programs", rows(spark, "programs", {"id": "p1", "psid": "1", "area_code": "131130", "canonical_name": "児童手当の給付", "registry": registry}, {"id": "p2", "psid": "2", "area_code": "131130", "canonical_name": "出生届", "registry": "{}"}))
    s.write("urls", rows(spark, "urls", url("u1", "/dead.html"), url("u2", "/live.html"), url("i1", "/", "index", last_crawled_at=at(1))))
    s.write("program_urls", rows(spark, "program_urls", {"program_id": "p1", "url_id": "u1", "role": "main", "rank": 1, "source": "registry"}, {"program_id": "p2", "url_id": "u2", "role": "main", "rank": 1, "source": "registry"}))
    s.write("resources", rows(spark, "resources", {"id": "r1", "canonical_url": "https://a.jp/dead.html", "state": "deleted"}, {"id": "r2", "canonical_url": "https://a.jp/live.html", "state": "active"}, {"id": "r3", "canonical_url": "https://a.jp/", "state": "active"}))
    s.write("url_resources", rows(spark, "url_resources", *[{"url_id": u, "resource_id": r, "observed_at": at(1)} for u, r in (("u1", "r1"), ("u2", "r2"), ("i1", "r3"))]))
    link = lambda path, text: {"resource_id": "r3", "url": f"https://a.jp{path}", "dedup_key": f"a.jp{path}", "host_key": "https://a.jp", "text": text}
    s.write("page_links", rows(spark, "page_links", link("/new.html", "児童手当の給付について"), link("/old.html", "児童手当の給付"), link("/dead.html", "児童手当の給付"), link("/zoo.html", "動物園のご案内")))
    ran = lambda i, day, **more: {"id": i, "kind": "full", "started_at": at(day), "finished_at": at(day, 1)} | more
    s.write("crawl_runs", rows(spark, "crawl_runs", ran("a", 1), ran("b", 2), ran("c", 3, finished_at=None)))
    fetched = lambda r, u, status, **more: {"run_id": r, "url_id": u, "fetched_at": at(3), "outcome": "response", "http_status": status, "response_time_ms": 100, "bytes": 10, "observation": "alive" if status == 200 else "not_found"} | more
    s.write("fetch_history", rows(spark, "fetch_history", fetched("a", "u1", 200), fetched("c", "u1", 404), fetched("c", "u2", 200), fetched("c", "i1", 200)))
    return s


def test_suggested_moves(spark, store):
    judged = spark.createDataFrame([("p1", "a.jp/old.html")], "program_id string, dedup_key string")
    report = moves.suggest(store, judged)
    assert report["targets"] == 1 and report["skipped_judged"] == 1 and report["unusable_hosts"] == []
    (one,) = report["suggestions"]
    assert (one["program_id"], one["dead_url"], one["more"], [c["url"] for c in one["candidates"]]) == ("p1", "https://a.jp/dead.html", 0, ["https://a.jp/new.html"])
    assert json.loads(moves.candidate_file(report, "now"))["suggestions"][0]["canonical_name"] == "児童手当の給付" and "new.html" in moves.markdown(report)


def test_related_links_of_dead_programs(spark, store):
    dry = moves.link_related(store, now(), dry_run=True)
    assert dry == {"dead_programs": 1, "programs_with_related": 1, "links": 1, "new_urls": 1, "dropped": {"other_host": 1, "not_html": 1}}
    assert store.read("urls").count() == 3 and moves.link_related(store, now()) == dry
    assert moves.link_related(store, now()) == dry | {"new_urls": 0}
    added = store.read("program_urls").where("role = 'related'").collect()
    assert [(r.program_id, r.rank, r.source) for r in added] == [("p1", 1, "registry")] and store.read("urls").where("role = 'related'").count() == 1


def test_run_reports(spark, store):
    args = (store.read("crawl_runs"), store.read("fetch_history"), store.read("urls"))
    assert {r.id: r.previous for r in runs.previous_runs(*args[:2]).collect()} == {"a": None, "b": "a", "c": "a"}
    counted = runs.load(*args, now())
    assert counted["id"] == "c" and counted["stats"]["hosts"]["https://a.jp"] == {"fetched": 2, "responses": 2, "ok": 1, "not_modified": 0, "not_found": 1}
    assert counted["stats"]["index_hosts"]["https://a.jp"]["ok"] == 1 and counted["stats"]["claimed"] is None and counted["duration_secs"] is None
    stats = runs.collect(*args[1:], "c", now(), {"claimed": 3})
    store.write("crawl_runs", runs.closed(args[0], "c", stats, [{"kind": "surge", "host": "https://a.jp", "count": 1, "rate": 0.5}], now()))
    saved = runs.load(store.read("crawl_runs"), *args[1:], now(), "c")
    assert saved["stats"]["claimed"] == 3 and saved["alerts"][0]["kind"] == "surge" and saved["duration_secs"] == 5 * 86_400
    text = runs.markdown(saved)
    assert "| https://a.jp | 2 | 2 | 1 |" in text and "- surge at https://a.jp: 1 (50.0%)" in text
    assert runs.stats_of("{}")["failed_final"] == 0
    with pytest.raises(LookupError):
        runs.load(*args, now(), "nothing")


def test_commands(spark, store, tmp_path, capsys):
    out = tmp_path / "out"
    assert cli.main([store.folder, "run-report", "--append", str(out)], spark) == 0 and "Run report: full" in out.read_text()
    assert cli.main([store.folder, "run-report", "--run", "none"], spark) == 1
    assert cli.main([store.folder, "suggest-moves", "--out", str(out)], spark) == 0 and len(json.loads(out.read_text())["suggestions"]) == 1
    assert cli.main([store.folder, "link-related", "--dry-run"], spark) == 0 and '"links": 1' in capsys.readouterr().out


PAGES = {
    "https://e.jp/dead.html": (404, {"content-type": "text/html"}, b""),
    "https://a.jp/": (301, {"location": "/top/"}, b""),
    "https://a.jp/top/": (200, {"content-type": "text/html", "etag": '"1"'}, b"<html><head><title>Top</title></head><body><p>Hello <a href='/y.html'>Y</a></p></body></html>"),
    "https://b.jp/f.pdf": (200, {"content-type": "application/pdf"}, b"%PDF-1.4 x"),
}


def exchange(url):
    if url.endswith("/robots.txt"):
        return (503, {}, b"") if "c.jp" in url else (404, {}, b"")
    return PAGES.get(url, (500, {}, b""))


def test_a_recorded_run(spark, store):
    from pagewarden.operators.run import Config, claimed, run
    from pagewarden.sources.replay import fetches

    more = (("u3", "https://b.jp/f.pdf"), ("u4", "https://c.jp/x.html"), ("u5", "https://d.jp/error.html"), ("u6", "https://e.jp/dead.html"))
    extra = [{"id": i, "raw_url": u, "normalized_url": u, "dedup_key": u[8:], "host_key": u[: u.index("/", 8)], "role": "seed", "status": "queued"} for i, u in more]
    urls = store.read("urls").unionByName(rows(spark, "urls", *extra)).fillna({"claim_token": 0, "retry_count": 0, "attempt_count": 0, "priority": 1})
    urls = urls.withColumn("status", F.when(F.col("id").isin("u1", "u2"), "retired").otherwise(F.col("status")))
    store.write("urls", urls.withColumn("next_crawl_at", F.lit("2026-01-02 00:00:00").cast("timestamp")))
    allowed = {f"https://{h}.jp" for h in "abcde"}
    robots = Robots("warden", allowed, exchange)
    run_id, summary = run(store, lambda claims: fetches(claims, allowed, exchange, robots), Config(worker="w"), now)
    assert summary == {"waves": 1, "claimed": 5, "saved": 5, "already_recorded": 0, "stale_claim": 0}
    history = {r.url_id: r for r in store.read("fetch_history").where(F.col("run_id") == run_id).collect()}
    assert {i: (r.outcome, r.http_status, r.observation) for i, r in history.items()} == {
        "i1": ("response", 200, "alive"), "u3": ("response", 200, "alive"), "u4": ("robots_unavailable", None, None), "u5": ("response", 500, None), "u6": ("response", 404, "not_found"),
    }
    after = {r.id: r for r in store.read("urls").collect()}
    assert {i: after[i].status for i in history} == {"i1": "succeeded", "u3": "succeeded", "u4": "retry_wait", "u5": "retry_wait", "u6": "succeeded"}
    assert after["u3"].recrawl_interval_secs == 30 * 86_400 and after["i1"].recrawl_interval_secs == 7 * 86_400 and after["u5"].last_error_type == "server_error"
    resources = {r.canonical_url: r for r in store.read("resources").collect()}
    assert resources["https://e.jp/dead.html"].state == "deletion_candidate" and resources["https://a.jp/top/"].etag == '"1"' and resources["https://b.jp/f.pdf"].raw_hash
    assert resources["https://a.jp/top/"].id == "r3" and {r.url for r in store.read("page_links").collect()} == {"https://a.jp/y.html"}
    report = runs.load(store.read("crawl_runs"), store.read("fetch_history"), store.read("urls"), now(), run_id)
    assert report["config"]["worker"] == "w" and report["stats"]["claimed"] == 5 and report["stats"]["index_hosts"]["https://a.jp"]["fetched"] == 1
    assert {a["kind"] for a in report["alerts"]} == {"host_skipped"} and claimed(store, Config(worker="w"), now()) is None
