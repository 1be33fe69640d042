import pytest
from pyspark.sql import functions as F

from pagewarden.functions import codes, dates, decisions, html, http, names, urls


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


@pytest.mark.parametrize("raw, normalized, rejection", [
    ("https://Example.JP/a/../b?utm_source=x&b=2&a=1#f", "https://example.jp/b?a=1&b=2", None),
    (" http://example.jp ", "http://example.jp/", None),
    ("https://example.jp:443/%7eabc%2f", "https://example.jp/~abc%2F", None),
    ("https://example.jp:8443/", None, "port"),
    ("ftp://example.jp/", None, "scheme"),
    ("mailto:a@example.jp", None, "scheme"),
    ("no url", None, "unparsable"),
    ("https://例え.jp/子", "https://xn--r8jz45g.jp/%E5%AD%90", None),
    ("https://example.jp/?gclid=1", "https://example.jp/", None),
])
def test_prepare(raw, normalized, rejection):
    got = urls.prepare(raw)
    assert (got["normalized"], got["rejection"]) == (normalized, rejection)


def test_site_rule_changes_the_key_only():
    got = urls.prepare("https://www.city.koganei.lg.jp/smph/a.html")
    assert got["normalized"].endswith("/smph/a.html") and got["dedup_key"] == "https://www.city.koganei.lg.jp/a.html"


def test_url_expressions(spark):
    assert one(spark, urls.split_joined(F.lit("https://a/x,y,https://b/"))) == ["https://a/x,y", "https://b/"]
    assert one(spark, urls.extract_urls(F.lit("見て https://a.jp/x.html。または http://b.jp/;https://c.jp/."))) == ["https://a.jp/x.html", "http://b.jp/", "https://c.jp/"]
    for u, d in (("https://a.jp/x/y.html?q", "https://a.jp/x/"), ("https://a.jp/x/y/", "https://a.jp/x/"), ("https://a.jp/", "https://a.jp/")):
        assert one(spark, urls.parent_dir(F.lit(u))) == d
    for u, top in (("https://a.jp/", True), ("https://a.jp/index.html", True), ("https://a.jp/?q", False), ("https://a.jp/index.a/b", False)):
        assert one(spark, urls.is_top_page(F.lit(u))) is top
    assert one(spark, urls.page_like(F.lit("https://a.jp/x.PDF"))) is False and one(spark, urls.page_like(F.lit("https://a.jp/x"))) is True
    assert urls.join_url("https://a.jp/b/c.html", "../d?e") == "https://a.jp/d?e"


def test_codes_and_ages(spark):
    assert one(spark, codes.normalize_codes(F.array(F.lit("002，003"), F.lit("27 "), F.lit("86"), F.lit("002")))) == ["002", "003", "027", "086"]
    assert one(spark, codes.um_from_psid(F.lit("psid3.0+3000020131130+1+UM24"))) == "UM24"
    assert one(spark, codes.split_area(F.lit("131130; \t渋谷区"))).name == "渋谷区" and one(spark, codes.split_area(F.lit("13113;x"))) is None
    n = lambda v: F.lit(v).cast("int")
    assert one(spark, codes.age_max_months(n(None), n(2), n(None))) == 36 and one(spark, codes.age_max_months(n(None), n(2), n(3))) == 28 and one(spark, codes.age_max_months(n(0), n(None), n(None))) is None


def test_names(spark):
    norm = lambda a: one(spark, names.normalize_name(F.lit(a)))
    sim = lambda a, b: one(spark, names.similarity(F.lit(norm(a)), F.lit(norm(b))))
    assert sim("児童手当", "児童手当について") == 1.0 and sim("児童", "児童") == 0.0
    assert one(spark, names.normalize_name(F.lit("ＡＢ・ｃ（１）ー々"))) == "abc1ー々"
    assert sim("night care", "nacht care") == pytest.approx(2 * 4 / 16, abs=0.2)


def test_http(spark):
    kind = lambda t, b: one(spark, http.body_kind(F.lit(t), F.lit(b)))
    assert [kind("text/html", b"%PDF-1"), kind("image/png", b"<html"), kind(None, b"\xef\xbb\xbf \n<html"), kind("application/pdf", b"<p"), kind(None, b"x")] == ["pdf", "other", "html", "html", "other"]
    now = F.lit("2026-01-01 00:00:00").cast("timestamp")
    assert [one(spark, http.retry_after(F.lit(v), now)) for v in ("120", "Thu, 01 Jan 2026 00:01:00 GMT", "Wed, 31 Dec 2025 00:00:00 GMT", "x")] == [120, 60, 0, None]
    r = lambda s, a=None: F.struct(F.lit(s).alias("status"), F.lit(a).cast("int").alias("retry_after"))
    got = one(spark, http.pace(F.array(r(503), r(503), r(429, 50), r(200))))
    assert (got.slowdowns, got.wait) == (2, 8.0)


def test_dates(spark):
    assert str(one(spark, dates.updated_on(F.lit("公開日 令和5年1月2日\n最終更新日:\n令和6年2月30日 更新日 2024.3.1")))) == "2024-03-01"
    assert one(spark, dates.updated_on(F.lit("免許の更新 2024年1月1日から"))) is None


def test_pages():
    page = "<html><head><title> 児童　手当\n</title><link rel=canonical href='/c'></head><body><nav><a href='/n'>n</a></nav><div id=Content><p>子<b>育</b>て</p><script>x</script><a href='b?b=1&a=2'>次 へ</a><div class='localnavi'>z</div></div></body></html>"
    e = html.extract(page, "https://a.jp/x/")
    assert (e["title"], e["canonical"], e["rule"], e["body_text"]) == ("児童 手当", "https://a.jp/c", "content", "子育て\n次 へ")
    assert e["anchors"] == [{"url": "https://a.jp/x/b?a=2&b=1", "text": "次 へ"}] and "n" in e["page_text"] and "x" not in e["page_text"]
    got = html.decode("text/html", "<meta charset=Shift_JIS>".encode() + "子育て".encode("cp932"))
    assert got["text"].endswith("子育て") and (got["charset"], got["charset_source"], got["charset_replaced"]) == ("Shift_JIS", "meta", False)
    assert html.decode("text/html; charset=utf-8", b"\xff")["charset_replaced"] is True


def test_canonical(spark):
    hop = lambda u, s: F.struct(F.lit(u).alias("url"), F.lit(s).alias("status"))

    def decide(hops, declared=None, trusted=True):
        p = urls.prepare(declared) if declared else None
        s = F.struct(*[F.lit(p[k] if p else None).cast("string").alias(k) for k in ("normalized", "host_key", "rejection")])
        return one(spark, decisions.canonical(F.array(*[hop(*h) for h in hops]), F.lit(declared).cast("string"), s, F.lit(trusted)))

    a, b, c, top = "https://a.jp/a", "https://a.jp/b", "https://a.jp/c", "https://a.jp/"
    assert decide([(a, 200)]).relation == "direct"
    assert (decide([(a, 301), (b, 302), (c, 200)]).canonical_url, decide([(a, 301), (b, 302), (c, 200)]).final_url) == (b, c)
    assert decide([(a, 301), (top, 200)]).ignored_redirect == "to_top_page"
    assert decide([(a, 200)], b).source == "declared" and decide([(a, 200)], b, False).ignored_declared == "host_untrusted"
    assert decide([(a, 302), (b, 200)], b).ignored_declared == "redirected_away"
    assert decide([(a, 200)], "https://z.jp/").ignored_declared == "other_host" and decide([(a, 200)], top).ignored_declared == "points_to_top_page"
    assert decide([(a, 301), (b, 200)], c).ignored_declared == "conflicts_with_redirect"


@pytest.mark.parametrize("seen, state, misses", [(["not_found"] * 2, "deletion_candidate", 2), (["not_found"] * 3, "deleted", 3), (["gone"], "deleted", 1), (["gone", "alive"], "active", 0), (["gone", "not_found"], "deleted", 2), ([], "active", 0)])
def test_states(spark, seen, state, misses):
    got = one(spark, decisions.fold_states(F.array(*[F.lit(x) for x in seen]).cast("array<string>")))
    assert (got.state, got.misses) == (state, misses)


def test_schedule(spark):
    days = lambda kind, change, interval: one(spark, decisions.adapt(F.lit(kind), F.lit(change), F.lit(interval).cast("double"))) / 86400
    d = 86400.0
    assert [days("page", "unchanged", None), days("page", "unchanged", 7 * d), days("page", "unchanged", 10.5 * d), days("page", "changed", 7 * d), days("blocked", "unknown", 30 * d), days("gone_index", "changed", 1 * d)] == [7, 10.5, 14, 3.5, 30, 90]
    u = "00000000-0000-0000-0000-00000000138a"
    got = one(spark, decisions.schedule(F.lit("retry"), F.lit("page"), F.lit("unknown"), F.lit(1), F.lit(7 * d), F.lit(u)))
    assert (got.status, got.retry_count, got.after) == ("retry_wait", 2, 20 + (0x138A % 5001) / 1000)
    assert one(spark, decisions.schedule(F.lit("retry"), F.lit("page"), F.lit("unknown"), F.lit(2), F.lit(7 * d), F.lit(u))).status == "failed_final"
