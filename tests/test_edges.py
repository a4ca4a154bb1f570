"""Edge rows that the tables don't hold."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pressloom.functions import lines, sqltext, text
from pressloom.functions.rules import SiteRule
from pressloom.operators import articles, feed, numbering, report
from pressloom.sources import files


def values(spark, column, *rows):
    return [r[0] for r in spark.createDataFrame([(x,) for x in rows], "v string").select(column(F.col("v"))).collect()]


def test_normal_form(spark):
    assert values(spark, text.norm_key, "ＮＦＫＣ　Ａ_b", "　", None, "中 文！", "Ünï-1") == ["nfkcab", "", "", "中文", "ünï1"]


def test_fences_and_broken_json(spark):
    got = values(spark, lambda v: F.to_json(F.struct(lines.tolerant_json(v).alias("x"))), '```json\n[1]\n```', 'so: {"a":1} ok', "[1, 2", "", None)
    assert got[:2] == ['{"x":[1]}', '{"x":{"a":1}}'] and got[2:] == ["{}", "{}", "{}"]


def test_title_is_no_body_line(spark):
    raw = '[{"text":"Ｔｉｔｌｅ","label":"body","confidence":1,"index":0},{"text":"A line of text","label":"body","confidence":0.9,"index":1},{"text":"low","label":"body","confidence":0.5,"index":2}]'
    df = spark.createDataFrame([(raw, "title"), (raw, None), (None, "t")], "raw string, title string")
    out = [r["body"] for r in lines.body_from_labels(df, "raw", "title", "body").collect()]
    assert out == ["A line of text", "Ｔｉｔｌｅ\n\nA line of text", ""]


def test_charsets(spark):
    page = "<meta charset='gbk'><p>中文</p>"
    rows = [(1, page.encode("gbk"), ""), (2, page.encode("gbk"), None), (3, "é".encode("latin-1"), "text/html; charset=ISO-8859-1"), (4, b"\xff", "charset=no-such"), (5, None, None)]
    out = {r["k"]: (r["charset"], r["html"]) for r in files.decode_pages(spark.createDataFrame(rows, "k int, raw binary, content_type string")).collect()}
    assert out[1] == out[2] == ("gbk", page)
    assert out[3] == ("iso-8859-1", "é") and out[4] == ("no-such", "�") and out[5][1] is None
    late = spark.createDataFrame([(b" " * 3000 + b"charset=gbk",)], "raw binary")
    name = late.select(files.page_charset("raw", F.lit("")), files.page_charset("raw", F.lit(""), scan_bytes=4000)).first()
    assert tuple(name) == ("utf-8", "gbk")


def test_guessed_charsets(spark):
    rows = [(1, "é".encode(), "text/html"), (2, "é".encode(), "image/svg"), (3, "é".encode("latin-1"), None), (4, b"\xef\xbb\xbf\xc3\xa9", "TEXT/plain"), (5, "é".encode("utf-16"), None), (6, b"", None), (7, None, "text/html")]
    df = spark.createDataFrame(rows, "k int, raw binary, content_type string")
    told = {r["k"]: (r["charset"], r["html"]) for r in files.decode_pages(df).collect()}
    assert told[1] == ("iso-8859-1", "Ã©") and told[2] == ("utf-8", "é") and told[3] == ("utf-8", "�") and told[7] == ("iso-8859-1", None)
    seen = {r["k"]: (r["charset"], r["html"]) for r in files.decode_pages(df, guess=files.bytes_guess("raw")).collect()}
    assert [seen[k] for k in (1, 2, 4, 5, 6)] == [("utf-8", "é"), ("utf-8", "é"), ("utf-8-sig", "é"), ("utf-16", "é"), ("utf-8", "")]
    assert seen[3] == ("utf-8", "�") and seen[7][1] is None


def test_whole_row_keys(spark):
    df = spark.createDataFrame([(1, None, "b", "a"), (2, "l", "b", "a"), (3, "", "b", "a")], "arrival int, PERMALINK string, zed string, alpha string")
    keys = [r[0] for r in df.select(feed.row_key(df, ignore=("arrival",))).collect()]
    assert keys == ['{"alpha":"a","zed":"b"}', "l", '{"PERMALINK":"","alpha":"a","zed":"b"}']


def test_dedup_is_idempotent(spark):
    df = spark.createDataFrame([(i, f"k{i % 7}") for i in range(50)], "arrival int, PERMALINK string")
    once = feed.dedup_feed(df, "arrival")
    assert sorted(r["arrival"] for r in once.collect()) == list(range(7))
    assert sorted(map(str, feed.dedup_feed(once, "arrival").collect())) == sorted(map(str, once.collect()))


@pytest.mark.parametrize(
    ("kind", "some"), [("int", [1, 2]), ("string", ["1", "x"]), ("double", [1.0, 2.5]), ("date", [dt.date(2024, 1, 1)]), ("boolean", [True]), ("decimal(9,2)", [1])]
)
def test_filters_take_any_type_and_length(spark, kind, some):
    rows = spark.createDataFrame([(v,) for v in some] + [(None,)], f"d {'int' if kind.startswith('decimal') else kind}").select(F.col("d").cast(kind).alias("d"))
    assert report.in_filter(rows, "d", some).count() == len(some)
    assert report.in_filter(rows, "d", rows.select("d")).count() == len(some)
    if kind == "int":
        assert report.in_filter(rows, "d", range(2, 12_000)).count() == 1


def test_numbers_leave_no_cached_table(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    out = {r["no"]: r["x"] for r in numbering.number_rows(df, "x").collect()}
    assert out == {i + 1: i for i in range(1000)}
    assert numbering.number_rows(df.limit(0), "x").count() == 0
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == 0


def test_instants_keep_zone_and_fraction():
    moment = dt.datetime(2024, 5, 1, 9, 0, 0, 250_000, tzinfo=dt.timezone(dt.timedelta(hours=9)))
    assert sqltext.literal(moment) == "TIMESTAMP '2024-05-01 00:00:00.250000+00:00'"


def test_interface_elements_are_no_paragraphs(spark):
    html = "<html><body><article><p class='Byline'>By somebody of the paper, today</p><p>The first real paragraph of the text.</p><div id='toolbar-1'>Print this page or send it on</div></article></body></html>"
    rules = [
        SiteRule("all", "a.com", "blocks", containers=("article",), tags=("p", "div"), min_chars=5),
        SiteRule("some", "b.com", "blocks", containers=("article",), tags=("p", "div"), min_chars=5, skip_like=("byline", "toolbar")),
    ]
    pages = spark.createDataFrame([("http://a.com/x", html), ("http://b.com/x", html)], "url string, html string")
    out = {r["rule"]: r["content"] for r in articles.extract_articles(pages, dt.datetime(2025, 1, 1), rules).collect()}
    assert out["some"] == "The first real paragraph of the text." and out["all"].count("\n") == 2
