"""Plans and results of jobs over many rows: translations, numbers, report pages, streams."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from pressloom.functions import lines
from pressloom.operators import lookups, numbering, report
from pressloom.plans import checks_report as cr
from pressloom.plans import checks_text as ct
from pressloom.session import shared_folder
from pressloom.streaming import forms


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def nodes(df, name):
    return sum(line.lstrip(" :+-").startswith(name) for line in plan(df).split("\n"))


# ---- labelled lines --------------------------------------------------------------------------


def test_lines_are_parsed_once(spark, data):
    out = entry.queries()["keep_body_lines"](spark, data)
    assert nodes(out, "ArrowEvalPython") == 1
    df = ct.labelled(spark, data).withColumn("lines", lines.parse_labels("raw"))
    once = plan(df).count("parse_json")
    assert plan(out).count("parse_json") <= once


# ---- translations ----------------------------------------------------------------------------


def test_translations_take_one_lookup_for_any_columns(spark):
    rows = [(1, "a", "b", None), (2, "b", "b", "a"), (3, None, " ", "c"), (None, "a", "x" * 50_000, "a"), (3, None, " ", "c")]
    df = spark.createDataFrame(rows, "_row int, one string, two string, _found string")
    words = spark.createDataFrame([("a", "A"), ("a", "AA"), ("b", "B"), ("x" * 50_000, "X"), ("c", None), (None, "N"), (" ", "blank")], "text string, translated string")
    out = lookups.attach_translations(df, words, {"one": "one_ja", "two": "two_ja", "_found": "three_ja"})
    got = sorted(((r["_row"] or 0, r["one_ja"], r["two_ja"], r["three_ja"]) for r in out.collect()))
    assert got == [(0, "A", "X", "A"), (1, "A", "B", ""), (2, "B", "B", "A"), (3, "", "", ""), (3, "", "", "")]
    single = lookups.attach_translations(df, words, {"one": "one_ja"})
    assert nodes(out, "Join") == nodes(single, "Join") == 2
    assert lookups.attach_translations(df.limit(0), words, {"one": "one_ja"}).count() == 0
    assert lookups.attach_translations(df, words.limit(0), {"one": "one_ja"}).select("one_ja").distinct().collect() == [("",)]


def test_variants_test_the_corpus_once(spark, data):
    pages = spark.read.parquet(f"{data}/pages.parquet")
    out = lookups.amp_variants(pages, pages.select("url", "html"))
    assert "RLIKE" not in plan(out) and nodes(out, "Join") == 1


# ---- numbers ---------------------------------------------------------------------------------


def test_numbering_moves_no_row_after_the_sort(spark, monkeypatch):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x"))
    out = numbering.number_rows(df, "x")
    assert nodes(out, "Join") == 0 and "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r["no"]: r["x"] for r in out.collect()} == {i + 1: i for i in range(5000)}
    monkeypatch.setattr(numbering, "MOST_OFFSETS", 1)
    assert {r["no"]: r["x"] for r in numbering.number_rows(df, "x").collect()} == {i + 1: i for i in range(5000)}


# ---- report pages ----------------------------------------------------------------------------


def plain(df):
    return [tuple(r) for r in df.collect()]


def test_pages_joined_are_the_whole_report(spark, data):
    pages = cr.query_pages(spark, data, pageSize=7)
    whole = report.report_query(
        cr.events(spark, data), cr.query_spec(), cr.dimensions(), cr.measures(), time_col="ts", stream_fields={"title": "props"}, first_by="event_id"
    )
    joined = [r[1:] for k in range(pages.count) for r in sorted(plain(pages.page(k)))]
    assert joined == plain(whole) and len(joined) == pages.n_rows > 20
    assert [pages.page(k).count() for k in (0, pages.count - 1, pages.count)] == [7, pages.n_rows - 7 * (pages.count - 1), 0]
    one = report.report_query(
        cr.events(spark, data), cr.query_spec(pageSize=7), cr.dimensions(), cr.measures(), time_col="ts", stream_fields={"title": "props"},
        first_by="event_id", page=2,
    )
    assert [r[1:] for r in sorted(plain(pages.page(2)))] == plain(one)
    page = pages.page(2)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in page and "Exchange" not in page and "PushedFilters: [IsNotNull(_row_no), GreaterThanOrEqual" in page


def test_a_report_starts_at_the_spec_s_page(spark, data):
    pages = cr.query_pages(spark, data, pageSize=10, page=1)
    assert pages.rest().count() == pages.n_rows - 10
    feed = report.report_feed(pages, key=F.col("PERMALINK_4"))
    firsts = {}
    for r in sorted(plain(pages.rest().select(report.ROW_NUMBER, "PERMALINK_4"))):
        firsts.setdefault(r[1], r[0])
    assert {r["PERMALINK_4"]: r["arrival"] for r in feed.collect()} == firsts
    none = report.report_pages(cr.events(spark, data).limit(0), cr.query_spec(), cr.dimensions(), cr.measures(), time_col="ts")
    assert none.count == 0 and none.page(0).count() == 0
    with pytest.raises(ValueError, match="pageSize"):
        cr.query_pages(spark, data, pageSize=0)


# ---- streams ---------------------------------------------------------------------------------

DAY = dt.timedelta(days=1)
START = dt.datetime(2024, 1, 1)


def firsts(rows, within):
    """The rows that a batch keeps: per key the first, then the next one later than ``within`` after it."""
    last, out = {}, []
    for at, key, no in sorted(rows):
        if key not in last or at > last[key] + within:
            last[key] = at
            out.append((at, key, no))
    return sorted(out)


def run(spark, files, lateness, within):
    path = shared_folder(spark, "arrivals")
    for batch in files:
        spark.createDataFrame(batch, "ts timestamp, key string, no int").coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema("ts timestamp, key string, no int").option("maxFilesPerTrigger", 1).parquet(path)
    out = forms.stream_dedup(stream, "key", "ts", lateness, within, "no")
    target = shared_folder(spark, "firsts")
    query = out.writeStream.format("parquet").option("checkpointLocation", shared_folder(spark, "state")).trigger(availableNow=True).start(target)
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    return sorted((r["ts"], r["key"], r["no"]) for r in spark.read.schema(out.schema).parquet(target).collect()), held


def test_stream_keeps_the_first_arrival_in_any_order(spark):
    rng = random.Random(4)
    rows = [(START + rng.random() * 20 * DAY, f"k{rng.randrange(12)}", i) for i in range(400)]
    rows += [(rows[0][0], rows[0][1], 1000), (START + 60 * DAY, "end", 1001)]
    want = [r for r in firsts(rows, 3 * DAY) if r[1] != "end"]
    assert len(want) < 120
    # rows come up to two days out of order, spread over six files
    arrived = sorted(rows, key=lambda r: r[0] + rng.random() * 2 * DAY)
    step = len(arrived) // 6 + 1
    files = [arrived[i : i + step] for i in range(0, len(arrived), step)]
    for order in range(2):
        for f in files:
            rng.shuffle(f)
        got, held = run(spark, files if order else [[r for f in files[::-1] for r in f]], 2 * DAY, 3 * DAY)
        assert got == want
        assert held[-1] == 1  # all that is left is the key that closes the others


def test_keys_of_a_stream_share_states(spark):
    keys = 3000
    rows = [(START + k * DAY / keys, None if k == 7 else k * 2**50 + 1, None if k % 5 == 0 else 2**60 + k) for k in range(keys)]
    rows += [(at + DAY, key, no) for at, key, no in rows] + [(START + 5 * DAY, rows[8][1], 1), (START + 60 * DAY, 1, 0)]
    path, target = shared_folder(spark, "arrivals"), shared_folder(spark, "firsts")
    schema = "ts timestamp, key long, no long"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    out = forms.stream_dedup(spark.readStream.schema(schema).parquet(path), "key", "ts", 2 * DAY, 3 * DAY, "no")
    query = out.writeStream.format("parquet").option("checkpointLocation", shared_folder(spark, "state")).trigger(availableNow=True).start(target)
    query.awaitTermination()
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert 1 <= max(held) <= forms.GROUPS and held[-1] == 1
    got = {(r["ts"], r["key"], r["no"]) for r in spark.read.schema(schema).parquet(target).collect()}
    # whole numbers stay exact next to nulls, and no key sees another one's rows
    assert got == {*rows[:keys], rows[-2]}
