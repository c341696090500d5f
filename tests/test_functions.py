"""Scalar expressions against Python's own behaviour and fixed values."""

import time
from urllib.parse import quote_plus

import pytest
from pyspark.sql import functions as F

from mediasignal.functions import dates, text, themes, urls
from mediasignal.functions.html import add_main_text
from mediasignal.operators.entities import money_amounts
from mediasignal.operators.membership import key_filter, may_hold


def column(spark, values, expr, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.y for r in rows.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


BLANKS = ["", " ", "a", "  a b ", "\ta ", " x　", "\x1ca\x1f", "\x85b\x0b", "a\n\nb", "​z"]


def test_strip_is_pythons(spark):
    assert column(spark, BLANKS, text.strip) == [b.strip() for b in BLANKS]


def test_word_count_is_pythons(spark):
    values = BLANKS + ["one two  three", "日本語 テキスト"]
    assert column(spark, values, text.word_count) == [len(v.split()) for v in values]
    assert column(spark, [None], text.word_count) == [0]


def test_blank(spark):
    values = BLANKS + [None]
    assert column(spark, values, text.is_blank) == [not (v or "").strip() for v in values]


def test_norm_label(spark):
    assert column(spark, [" Bullish\t", "BEARISH", None, ""], text.norm_label) == ["bullish", "bearish", "nan", ""]


def test_squeeze(spark):
    assert column(spark, ["  a \n  b  "], text.squeeze) == ["a b"]


@pytest.mark.parametrize("size", [1, 2, 7])
def test_small_chunks_rebuild_the_text(spark, size):
    value = "héllo wörld 日本 😀!"
    got = column(spark, [value], lambda c: text.chunks(c, size))[0]
    assert got == [value[i:i + size] for i in range(0, len(value), size)]


def test_chunk_counts(spark):
    values = ["x" * 4500, "x" * 4501, "", None]
    assert [len(c) for c in column(spark, values, lambda c: text.chunks(c, 4500))] == [1, 2, 0, 0]


def test_rejoin_puts_a_space_into_a_cut_word(spark):
    assert column(spark, ["abcdef"], lambda c: text.rejoin(text.chunks(c, 4))) == ["abcd ef"]


def test_cap_counts_characters(spark):
    assert column(spark, ["😀" * 5], lambda c: text.cap(c, 3)) == ["😀" * 3]


def test_first_truthy(spark):
    rows = spark.createDataFrame([("", None, "c"), ("a", "b", "c"), (None, "b", ""), ("", "", "")], "a string, b string, c string")
    assert [r.y for r in rows.select(text.first_truthy(F.col("a"), F.col("b"), F.col("c")).alias("y")).collect()] == [
        "c", "a", "b", ""]


def test_percent_of_nothing(spark):
    row = spark.range(1).select(text.percent(F.lit(0), F.lit(0)).alias("a"), text.percent(F.lit(1), F.lit(4)).alias("b")).first()
    assert (row.a, row.b) == (0.0, 25.0)


def test_domain(spark):
    values = ["http://User:pw@WWW.Ex.com:8080/a b|c", "no-scheme", "//Host/x", "https://a.b?q#f", "", None, "http:///x"]
    assert column(spark, values, urls.domain) == ["user:pw@www.ex.com:8080", "", "host", "a.b", "", "", ""]
    assert column(spark, ["https://www.a.b/www.", "https://wwwx.a"], lambda c: urls.domain(c, True)) == ["a.b", "wwwx.a"]


def test_quote_plus(spark):
    values = ['("Exchange Rate" OR "a~b*c") sourcecountry:UK', "é/ü?&=+%", "-_.~ *'"]
    assert column(spark, values, urls.quote_plus) == [quote_plus(v) for v in values]
    assert column(spark, values[:1], urls.quote_plus) == [
        "%28%22Exchange+Rate%22+OR+%22a~b%2Ac%22%29+sourcecountry%3AUK"]


def test_eligible(spark):
    values = ["http://a.b", "http://a.bc", "HTTP://a.bcd", "ftp://a.bcd", "http://a/VIDEO/1", "https://a.b/videos", "", None]
    assert column(spark, values, urls.eligible) == [True, True, False, False, False, False, False, False]


def test_lenient_dates(spark):
    values = ["2025-08-04T00:00:00.000Z", "2025-08-04", "garbage", "2025/08/04", "", None, "T10:00", "2025", "2025-13-01"]
    got = column(spark, values, lambda c: dates.parse_lenient(c).cast("string"))
    assert got == ["2025-08-04 00:00:00", "2025-08-04 00:00:00"] + [None] * 7


def test_dates_ignore_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        got = column(spark, ["2025-08-01T00:00:00.000Z"], lambda c: dates.month_iso(dates.parse_lenient(c)))
        assert got == ["2025-08-01T00:00:00.000Z"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_week(spark):
    def week(c):
        return F.concat_ws(" ", dates.week_start(c), dates.week_end(c))
    got = column(spark, ["2025-08-10", "2025-08-11"], lambda c: week(dates.run_date(c)))
    assert got == ["2025-08-04 2025-08-10", "2025-08-11 2025-08-17"]


def test_bad_run_date_raises(spark):
    with pytest.raises(Exception):
        column(spark, ["08/04/2025"], dates.run_date)


def test_themes(spark):
    values = ['["b","a","b",""]', '"x;y"', "7", '["T1",2,null,["n"]]', "null", "{}", "[]", None, '"[1]"', '""']
    got = column(spark, values, lambda c: themes.themes_text(F.parse_json(c)))
    assert got == ["a, b", "x;y", "", "T1", "", "", "", "", "[1]", ""]


@pytest.mark.parametrize("html,expected", [
    ("<article><p>One<br>two</p><p>th<b>r</b>ee</p></article>", "One two three"),
    ("<body><nav>menu</nav><p>text</p><footer>f</footer></body>", "text"),
    ("<main>in</main><p>out</p>", "in"),
    ("<body><ARTICLE class='a'>Big</ARTICLE> rest</body>", "Big"),
    ("plain words", "plain words"),
    ("<p>a<script>var t='</p>';</script>b<!-- <p>no</p> --></p>", "ab"),
    ("<style>p{}</style>", ""),
    ("", ""),
    (None, ""),
    ("<p>a &lt; b &amp;&amp; c &amp;lt; &quot;d&quot;&nbsp;</p>", 'a < b && c &lt; "d"'),
    ("<p>&#233;&#xE9;&#x1F600;&#0;&#55296;&#1114112;</p>", "éé😀���"),
    ("<p>1 < 2 and 3 > 2</p>", "1 < 2 and 3 > 2"),
    ("<article></article><p>outside</p>", "outside"),
])
def test_main_text(spark, html, expected):
    rows = spark.createDataFrame([(html,)], "html string")
    assert add_main_text(rows, "html", "t").first().t == expected


def test_money(spark):
    values = ["paid $5 million now", "€1,200.50.", "USD 3bn", "no money here", "AUSD 5", "$5, then £7k", None]
    assert column(spark, values, money_amounts) == [
        ["$5 million"], ["€1,200.50"], ["USD 3bn"], [], [], ["$5", "£7k"], []]


@pytest.mark.parametrize("n", [0, 1, 2, 3])
def test_has_words(spark, n):
    values = BLANKS + ["one two  three", " one two\n", None, "x" * 30_000]
    got = column(spark, values, lambda c: text.has_words(c, n))
    assert got == [len((v or "").split()) >= n for v in values]


LONG = "word " * 20
MENU = "<ul><li><a href='/a'>one</a></li><li><a href='/b'>two words</a></li></ul>"


@pytest.mark.parametrize("html,expected", [
    (f"<body><div>{MENU}</div><div><h2>Title</h2><p>{LONG}</p><p>short end of it all</p></div><div>{MENU}</div></body>",
     f"Title {LONG}short end of it all"),
    (f"<div>{MENU}</div><p>few words here</p>", "few words here"),  # nothing long: all but the links
    (f"<div>{MENU}</div>", "one two words"),  # nothing else
    (f"<p>{LONG}<a href='/x'>a link inside</a> goes on</p>", f"{LONG}a link inside goes on"),
    (f"<a href='/x'>{LONG}</a><p>{LONG}</p>", LONG.strip()),
    (f"<a name='x'><p>{LONG}</p>", LONG.strip()),
    (f"<article>one</article><p>{LONG}</p><article>two</article>", f"one {LONG}two"),
    (f"<article><p></p></article><main>x</main><p>{LONG}</p>", "x"),
    (f"<body><p>{LONG}</p><form>a<nav>b<form>c</form></nav>d</form><p>{LONG}</p></body>", f"{LONG}{LONG.strip()}"),
    (f"<body><p>{LONG}</p></nav><aside>{LONG}</body>", f"{LONG}{LONG.strip()}"),
])
def test_blocks(spark, html, expected):
    assert add_main_text(spark.createDataFrame([(html,)], "html string"), "html", "t").first().t == expected


def test_key_filter(spark):
    keys = spark.range(3000).selectExpr("concat('https://a.example/', id) as u").unionByName(spark.sql("select cast(null as string) as u"))
    rows = spark.range(40_000).selectExpr("concat('https://a.example/', id) as url", "id as block")
    kept = {r.block for r in may_hold(rows, "url", key_filter(keys, "u", 1), 1).collect()}
    assert set(range(3000)) <= kept and len(kept) < 3000 + 0.03 * 37_000
    full = may_hold(rows, "url", key_filter(rows, "url", 1), 1)  # far too many keys: none is lost
    assert full.columns == ["url", "block"] and full.count() == 40_000
    assert may_hold(rows, "url", key_filter(keys.limit(0), "u", 8), 8).count() == 0


def test_chunks_of_long_texts(spark):
    texts = ["", None, "a", "ab" * 4500, "é😀\n" * 5000, "\r\n\u2028" * 3001]
    got = column(spark, texts, lambda c: text.chunks(c, 4500))
    assert got == [[t[i:i + 4500] for i in range(0, len(t or ""), 4500)] if t else [] for t in texts]
    long = spark.range(1).select(F.expr("repeat('é😀x ', 4000000)").alias("t"))
    start = time.perf_counter()
    assert long.select(F.size(text.chunks(F.col("t"), 4500))).first()[0] == 3556
    assert time.perf_counter() - start < 20  # seeking each piece from the start takes minutes
