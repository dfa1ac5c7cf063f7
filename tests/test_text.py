"""Cleaning, folding, URLs and rules on literal texts."""

import html
import unicodedata

import pytest
import random

from pyspark.sql import functions as F

from panelforge import catalog
from panelforge.functions import text as tx, times as tm, urls
from panelforge.operators import news as nw


def one(spark, value, fn):
    return spark.createDataFrame([(value,)], "v string").select(fn(F.col("v")).alias("r")).collect()[0]["r"]


def test_entities_match_the_standard_decoder(spark):
    texts = ["a &amp; b &lt;p&gt; &eacute;&agrave; &#233; &#x1EA1; &nope; 5 &euro;", "&amp;lt;", "no entity; here", "&", "&#0;x", "tail&copy;", "a;b &quot;q&quot;;"]
    rows = spark.createDataFrame([(t,) for t in texts], "v string").select("v", tx.decode_entities(F.col("v")).alias("r")).collect()
    for row in rows:
        if row["v"] != "&#0;x":
            assert row["r"] == html.unescape(row["v"])


def test_html_cleaning(spark):
    assert one(spark, "<p>Tai nạn &amp; ùn tắc</p>\n <b>A</b>", tx.clean_html) == "Tai nạn & ùn tắc A"
    assert one(spark, "&lt;script&gt;x&lt;/script&gt; y", tx.clean_html) == "x y"
    assert one(spark, "<script>var a;</script>b", tx.clean_summary) == "b"
    assert one(spark, "<p></p>", tx.clean_summary) is None
    assert one(spark, 'x <IMG class="c" src="http://i/a.png?x=1&amp;y=2">', tx.image_url) == "http://i/a.png?x=1&y=2"


def test_nfc_and_folding(spark):
    decomposed = unicodedata.normalize("NFD", "Hà Nội đường")
    assert one(spark, decomposed, tx.nfc) == "Hà Nội đường"
    assert one(spark, decomposed, tx.fold_accents) == "ha noi duong"
    assert one(spark, "Đống Đa", lambda c: tx.fold_accents(c, fold_d=False)) == "đong đa"


def test_nfc_runs_in_the_jvm_and_keeps_every_text(spark):
    values = [None, "", "abc", unicodedata.normalize("NFD", "Hà Nội đường"), "각 ﬁ Ω \u0344 \U0001d15e", "a\u0323\u0302\u0301 ậ\u0301"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").withColumn("n", tx.nfc(F.col("v")))
    assert "Python" not in df._jdf.queryExecution().executedPlan().toString()
    got = {r["i"]: r["n"] for r in df.collect()}
    assert got == {i: None if v is None else unicodedata.normalize("NFC", v) for i, v in enumerate(values)}


def test_title_tokens_drop_stopwords(spark):
    got = one(spark, "Tai nạn của xe tải trên đường A 5", lambda c: tx.title_tokens(c, catalog.TITLE_STOPWORDS))
    assert got == ["tai", "nan", "xe", "tai", "uong"]


def test_poly_hash_and_redaction(spark):
    total = 0
    for c in "đường-1":
        total = (total * 31 + ord(c)) % 1_000_003
    assert one(spark, "đường-1", tx.poly_hash) == total
    assert one(spark, "GET /x?key=secret&z=1", tx.redact_key) == "GET /x?key=<redacted>&z=1"


@pytest.mark.parametrize("raw,want", [
    ("HTTP://WWW.Site.vn//a//b/?utm_source=x&b=2&a=1&fbclid=9#top", "http://www.site.vn/a/b?a=1&b=2"),
    ("//site.vn/a", "https://site.vn/a"),
    ("https://site.vn/a?q=h%C3%A0+n%E1%BB%99i&z=", "https://site.vn/a?q=h%C3%A0+n%E1%BB%99i&z="),
    ("none", None),
])
def test_canonical_url(spark, raw, want):
    assert one(spark, raw, urls.canonical_url) == want


def test_resolve_links(spark):
    page = "https://site.vn/tin/giao-thong/a.htm"
    cases = {"/b.htm": "https://site.vn/b.htm", "c.htm": "https://site.vn/tin/giao-thong/c.htm", "//x.vn/d": "https://x.vn/d", "https://y.vn": "https://y.vn"}
    for href, want in cases.items():
        assert one(spark, href, lambda c: urls.resolve(F.lit(page), c)) == want


def test_times_in_urls(spark):
    text = lambda c: urls.path_time(c).cast("string")
    assert one(spark, "https://x.vn/tin-20260608155717402.htm", text) == "2026-06-08 15:57:17"
    assert one(spark, "https://x.vn/tin-192260608151155779.htm", text) == "2026-06-08 15:11:55"
    assert one(spark, "https://x.vn/tin-20261399.htm", text) is None
    page = lambda c: urls.page_name_time(c).cast("string")
    assert one(spark, "https://x.vn/tin-192260608151155779.htm", page) == "2026-06-08 15:11:55"


def test_dates_in_text(spark):
    day = lambda c: tm.text_date(c, F.lit(2026)).cast("string")
    assert one(spark, "sáng 5/3/2025 tại", day) == "2025-03-05 00:00:00"
    assert one(spark, "ngày 7-11 kẹt xe", day) == "2026-11-07 00:00:00"
    assert one(spark, "ngày 31-2", day) is None


LABELLED = {
    "accident": ["Tai nạn trên cao tốc", "Hai xe va chạm", "Xe tải lật xe", "Ô tô tông vào dải phân cách"],
    "flood": ["Đường ngập sâu sau mưa", "Phố bị ngập úng"],
    "road_work": ["Rào chắn phố A để thi công", "Cấm đường ban đêm", "Cải tạo đường B"],
    "event": ["Lễ hội hoa đăng", "Giải chạy marathon"],
    "weather": ["Bão số 3 đổ bộ", "Sương mù dày đặc"],
    "other": ["Giá vàng hôm nay"],
}


@pytest.mark.parametrize("label,text", [(k, t) for k, texts in LABELLED.items() for t in texts])
def test_event_types(spark, label, text):
    assert one(spark, text, nw.event_type) == label


@pytest.mark.parametrize("text,level", [
    ("hai người tử vong", 3), ("ùn tắc kéo dài 3 km", 2), ("lưu thông chậm", 1), ("bình thường", 0), ("tử vong, phân luồng", 3),
])
def test_keyword_severity(spark, text, level):
    assert one(spark, text, nw.keyword_severity) == level


def test_long_classifier_precedence(spark):
    pick = lambda t: tuple(one(spark, t, nw.category_and_subtype))
    assert pick("Đề xuất mở rộng đường vành đai") == ("infrastructure_planning", "đề xuất")
    assert pick("Dự kiến thi công cầu mới")[0] == "roadwork_active"
    assert pick("Đang thi công, tai nạn gần đó") == ("roadwork_active", "đang thi công")
    assert pick("Tai nạn liên hoàn") == ("accident", "tai nạn")
    assert pick("Giá vàng") == ("unrelated", "unrelated")


def test_places(spark):
    rows = spark.createDataFrame([(1, "Ùn tắc ở Cầu Giấy và Nguyễn Trãi", "Hà Nội"), (2, "Không có địa danh", None), (3, None, None), (4, "", "x")], "id int, t string, h string")
    found = {r["id"]: (r["places"], r["primary_place"]) for r in nw.located_places(rows, "id", "t", "h", nw.gazetteer_table(spark)).collect()}
    assert found == {1: (["Nguyễn Trãi, Hà Nội", "Cầu Giấy, Hà Nội"], "Nguyễn Trãi, Hà Nội"), 2: ([], ""), 3: ([], ""), 4: ([], "")}
    city = one(spark, "tai nan o sai gon", lambda c: nw.city_by_alias(c, F.lit(None).cast("string"), catalog.NEWS_CITY_ALIASES))
    assert tuple(city) == ("hcmc", "sài gòn")


def test_gazetteer_of_a_hundred_thousand_names(spark):
    """The answers of a plain search, from a table that is no literal of the plan."""
    rng = random.Random(3)
    syllables = ["ba", "cau", "duc", "giấy", "hàng", "khê", "lộ", "mai", "nam", "phú", "quốc", "sơn", "tân", "vinh", "xã", "y"]
    names = sorted({" ".join(rng.choices(syllables, k=rng.randint(2, 5))).title() + rng.choice(["", f" {rng.randint(1, 60)}"]) for _ in range(160_000)})
    names += ["Ô", "Mã", "Bắc", "bắc", "Đường Láng"]
    table = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "name string, rank int")
    texts = [" ".join(rng.choices(syllables, k=12)) + f" {rng.randint(1, 60)}" for _ in range(12)] + ["xBẮCx ô mã", "ĐƯỜNG LÁNG", "", None, "y " * 900 + "giấy hàng ba " + "mai vinh " * 60]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    out = nw.place_names(df, "id", "t", table)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Quốc" not in plan and len(names) > 100_000
    first = {}
    for n in names:
        first.setdefault(n.lower(), n)
    ordered = sorted(first.values(), key=len, reverse=True)
    for r in out.collect():
        low = (texts[r["id"]] or "").lower()
        assert r["places"] == [n for n in ordered if n.lower() in low]


def test_listing_links(spark):
    keep = lambda title, link: spark.createDataFrame([(title, link)], "t string, l string").select(nw.link_relevant(F.col("t"), F.col("l")).alias("k")).collect()[0]["k"]
    assert keep("Ùn tắc nghiêm trọng trên cao tốc", "https://x.vn/giao-thong/un-tac-123456.html")
    assert not keep("Giao thông", "https://x.vn/giao-thong/un-tac-123456.html")
    assert not keep("Ùn tắc nghiêm trọng", "https://x.vn/")
    assert not keep("Ùn tắc nghiêm trọng", "https://x.vn/giao-thong/muc-luc.html")


def test_gazetteer_filter_keeps_every_name(spark, monkeypatch):
    """Names over the borders of cuts and stretches; a filter of one flag lets every fragment through and finds the same."""
    rows = [(at, "x" * at + "Old Bridge" + "y" * 40) for at in [*range(20, 36), *range(500, 518)]] + [(-1, "Old Brid ge"), (-2, ""), (-3, "ab")]
    df = spark.createDataFrame(rows, "id long, t string")
    table = spark.createDataFrame([("Old Bridge", 0), ("ab", 1), ("Far", 2)], "name string, rank int")
    want = {at: ["Old Bridge"] if at >= 0 else ["ab"] if at == -3 else [] for at, _ in rows}
    for size in (nw.FILTER, 1):
        monkeypatch.setattr(nw, "FILTER", size)
        assert {r["id"]: r["places"] for r in nw.place_names(df, "id", "t", table).collect()} == want
    monkeypatch.undo()
    known = nw._fragment_filter(table, "name").collect()
    assert len(known) == 1 and len(known[0]["_known"]) == nw.FILTER and sum(known[0]["_known"]) <= 3
