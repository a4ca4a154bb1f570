"""Checks of the report query."""

from __future__ import annotations

from pyspark.sql import functions as F

from pressloom.functions.base import literal_table
from pressloom.functions.urls import url_host
from pressloom.operators import report
from pressloom.operators.numbering import number_rows
from pressloom.plans.registry import check
from pressloom.sources.tables import table

START_MS, END_MS = 1704412800000, 1706140799999  # 2024-01-05 to 2024-01-24, UTC
TOPICS = [3, 5, 8, 13, 21, 34, 55, 89, 144, 1, 2, 4, 6, 10, 16, 26, 42, 68, 110]
EXCLUDED = ["example.net", "spam-farm.example.org", "cheap-pills.example.com"]

RANGE_SQL = "ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts <= TIMESTAMP '2024-01-24 23:59:59.999'"
JST_SQL = "(ts + INTERVAL 9 HOUR)"
TOPIC_SQL = f"user_id IN ({', '.join(map(str, TOPICS))})"


def dimensions():
    return {
        "LISTENING_MEDIA_TYPE": "event_type",
        "TOPIC_IDS": "user_id",
        "SN_CREATED_TIME": "ts",
        "PERMALINK": F.col("user_id").cast("string"),
        "ES_MESSAGE_ID": "event_id",
        "MEDIA_SOURCE_NAME": "event_type",
    }


def measures():
    return {
        "REACH_COUNT": F.col("value").cast("decimal(18,2)"),
        "WEB_SHARES_OVERALL": F.get_json_object("props", "$.k").cast("long"),
    }


def spec(**changes):
    base = {
        "startTime": START_MS, "endTime": END_MS, "timeZone": "Asia/Tokyo", "page": 0, "pageSize": 20,
        "filters": [], "groupBys": [], "projections": [], "sorts": [],
    }
    return {**base, **changes}


GROUPS = [
    {"heading": "MEDIA_SOURCE_NAME_2", "dimensionName": "MEDIA_SOURCE_NAME", "groupType": "FIELD"},
    {"heading": "PERMALINK_4", "dimensionName": "PERMALINK", "groupType": "FIELD"},
]
DAILY = {"heading": "SN_CREATED_TIME_1", "dimensionName": "SN_CREATED_TIME", "groupType": "DATE_HISTOGRAM",
         "details": {"interval": "1d"}}
WEEKLY = {**DAILY, "details": {"interval": "1w"}}
SUMS = [
    {"heading": "REACH_0", "measurementName": "REACH_COUNT", "aggregateFunction": "SUM"},
    {"heading": "SHARES_1", "measurementName": "WEB_SHARES_OVERALL", "aggregateFunction": "SUM"},
]
SORTS = [{"heading": "WEB_SHARES_OVERALL__SUM__LISTENING", "order": "DESC"}]
SHARES_SQL = "CAST(sum(CAST(props->>'$.k' AS BIGINT)) AS BIGINT)"
REACH_SQL = "CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE)"


def events(spark, folder):
    return table(spark, folder, "events")


@check("report_time_range", f"SELECT event_id FROM events WHERE {RANGE_SQL}")
def report_time_range(spark, folder):
    return report.time_range(events(spark, folder), "ts", START_MS, END_MS).select("event_id")


@check("report_in_filter", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view')")
def report_in_filter(spark, folder):
    df = report.in_filter(events(spark, folder), "event_type", ["click", "view"])
    return report.in_filter(df, "user_id", []).select("event_id", "event_type")


@check("topic_filter", f"SELECT event_id, user_id FROM events WHERE {TOPIC_SQL}")
def topic_filter(spark, folder):
    return report.topic_filter(events(spark, folder), "user_id", TOPICS).select("event_id", "user_id")


@check("site_exclusion", """
WITH h AS (SELECT page_id, regexp_replace(regexp_extract(lower(url), '^[a-z]+://([^/?#]*)', 1), '^www[.]', '') AS host
           FROM pages)
SELECT page_id, host FROM h WHERE NOT (""" + " OR ".join(
    f"host = '{s}' OR host LIKE '%.{s}'" for s in EXCLUDED) + ")")
def site_exclusion(spark, folder):
    """Even pages by a list of sites, odd ones by a table of them."""
    pages = table(spark, folder, "pages").select("page_id", url_host("url").alias("host"))
    sites = literal_table(spark, [(s,) for s in EXCLUDED], "site string")
    even = report.exclude_sites(pages.filter(F.col("page_id") % 2 == 0), "host", EXCLUDED)
    return even.unionByName(report.exclude_sites(pages.filter(F.col("page_id") % 2 == 1), "host", sites))


@check("report_group_field", """
SELECT event_type AS "MEDIA_SOURCE_NAME_2", CAST(user_id AS VARCHAR) AS "PERMALINK_4", event_id AS "ES_MESSAGE_ID"
FROM events GROUP BY ALL""")
def report_group_field(spark, folder):
    groups = report.group_columns(spec(groupBys=GROUPS), dimensions(), add_message_id=True)
    return events(spark, folder).select(*groups).distinct()


@check("report_date_histogram", f"""
SELECT strftime(d, '%Y-%m-%d') AS bucket, step, n FROM (
  SELECT date_trunc('day', {JST_SQL}) AS d, '1d' AS step, count(*) AS n FROM events GROUP BY 1
  UNION ALL SELECT date_trunc('week', {JST_SQL}), '1w', count(*) FROM events GROUP BY 1) t""")
def report_date_histogram(spark, folder):
    df = events(spark, folder)
    parts = [
        df.groupBy(report.date_bucket("ts", "Asia/Tokyo", step).alias("d")).agg(F.count("*").alias("n"))
        .select(F.date_format("d", "yyyy-MM-dd").alias("bucket"), F.lit(step).alias("step"), "n")
        for step in ("1d", "1w")
    ]
    return parts[0].unionByName(parts[1])


@check("report_sum", """
SELECT l_returnflag, l_linestatus, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS quantity,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS price
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def report_sum(spark, folder):
    sums = report.sum_columns(
        {"projections": [{"heading": "quantity", "measurementName": "QUANTITY", "aggregateFunction": "SUM"},
                         {"heading": "price", "measurementName": "PRICE", "aggregateFunction": "SUM"}]},
        {"QUANTITY": F.col("l_quantity").cast("decimal(18,2)"), "PRICE": F.col("l_extendedprice").cast("decimal(18,2)")},
    )
    out = table(spark, folder, "lineitem").groupBy("l_returnflag", "l_linestatus").agg(*sums)
    return out.withColumns({c: F.col(c).cast("double") for c in ("quantity", "price")})


GROUPED_SQL = f"""
WITH g AS (SELECT event_type AS media, CAST(user_id AS VARCHAR) AS link, {REACH_SQL} AS reach, {SHARES_SQL} AS shares
           FROM events WHERE {RANGE_SQL} GROUP BY 1, 2)"""


def _grouped(spark, folder, page=None, **changes):
    s = spec(groupBys=GROUPS, projections=SUMS, sorts=SORTS, **changes)
    return s, report.report_query(events(spark, folder), s, dimensions(), measures(), time_col="ts", page=page)


def _named(df, *keep):
    return df.select(
        *keep,
        F.col("MEDIA_SOURCE_NAME_2").alias("media"), F.col("PERMALINK_4").alias("link"),
        F.col("REACH_0").cast("double").alias("reach"), F.col("SHARES_1").alias("shares"),
    )


@check("report_sort", GROUPED_SQL + """
SELECT *, row_number() OVER (ORDER BY shares DESC, media, link) AS place FROM g""")
def report_sort(spark, folder):
    s, out = _grouped(spark, folder)
    order = report.sort_columns(s, out.columns, ["MEDIA_SOURCE_NAME_2", "PERMALINK_4"])
    ranked = number_rows(out, *order, name="place")
    return _named(ranked, "place")


@check("report_page", GROUPED_SQL + "SELECT * FROM g ORDER BY shares DESC, media, link LIMIT 25 OFFSET 50")
def report_page(spark, folder):
    _, out = _grouped(spark, folder, page=2, pageSize=25)
    return _named(out)


@check("report_fields", f"""
SELECT event_type AS media, CAST(user_id AS VARCHAR) AS link, {SHARES_SQL} AS shares, arg_min(props, event_id) AS title,
       count(*) AS n FROM events WHERE {RANGE_SQL} GROUP BY 1, 2""")
def report_fields(spark, folder):
    s = spec(groupBys=GROUPS, projections=SUMS[1:] + [
        {"heading": "n", "measurementName": "ROWS", "aggregateFunction": "SUM"}])
    out = report.report_query(
        events(spark, folder), s, dimensions(), {**measures(), "ROWS": F.lit(1).cast("long")}, time_col="ts",
        stream_fields={"title": "props"}, first_by="event_id",
    )
    return out.select(F.col("MEDIA_SOURCE_NAME_2").alias("media"), F.col("PERMALINK_4").alias("link"),
                      F.col("SHARES_1").alias("shares"), "title", "n")


QUERY_SQL = f"""
q AS (SELECT strftime(date_trunc('week', {JST_SQL}), '%Y-%m-%d') AS week, event_type AS media, CAST(user_id AS VARCHAR) AS link,
       {REACH_SQL} AS reach, {SHARES_SQL} AS shares, arg_min(props, event_id) AS title
FROM events WHERE {RANGE_SQL} AND event_type IN ('click', 'view', 'purchase') AND {TOPIC_SQL} GROUP BY 1, 2, 3),
numbered AS (SELECT *, row_number() OVER (ORDER BY shares DESC, week, media, link) - 1 AS no FROM q)"""


def query_spec(**changes):
    return spec(
        filters=[
            {"dimensionName": "LISTENING_MEDIA_TYPE", "filterType": "IN", "values": ["click", "view", "purchase"]},
            {"dimensionName": "TOPIC_IDS", "filterType": "IN", "values": TOPICS},
            {"dimensionName": "QUERY", "filterType": "IN", "values": []},
        ],
        groupBys=[WEEKLY, *GROUPS], projections=SUMS, sorts=SORTS, **changes,
    )


def query_pages(spark, folder, **changes):
    return report.report_pages(
        events(spark, folder), query_spec(**changes), dimensions(), measures(), time_col="ts", stream_fields={"title": "props"},
        first_by="event_id",
    )


def _query_columns(df, *keep):
    return df.select(
        *keep, F.date_format("SN_CREATED_TIME_1", "yyyy-MM-dd").alias("week"), F.col("MEDIA_SOURCE_NAME_2").alias("media"),
        F.col("PERMALINK_4").alias("link"), F.col("REACH_0").cast("double").alias("reach"),
        F.col("SHARES_1").alias("shares"), "title",
    )


# all pages from the spec's page on, then the first row of each link
@check("report_query", f"""WITH {QUERY_SQL}
SELECT no AS arrival, week, media, link, reach, shares, title FROM numbered WHERE no >= 50
QUALIFY row_number() OVER (PARTITION BY link, media ORDER BY no) = 1""")
def report_query(spark, folder):
    pages = query_pages(spark, folder, page=2, pageSize=25)
    feed = report.report_feed(pages, key=F.concat_ws("|", "PERMALINK_4", "MEDIA_SOURCE_NAME_2"))
    return _query_columns(feed, "arrival")


@check("report_pages", f"""WITH {QUERY_SQL} SELECT no // 30 AS page, no, week, media, link, reach, shares, title FROM numbered""")
def report_pages(spark, folder):
    """The pages of a report, read one by one in numbered ranges and put together again."""
    pages = query_pages(spark, folder, pageSize=30)
    numbered = pages.rows.withColumn("page", F.floor(F.col(report.ROW_NUMBER) / pages.size).cast("long"))
    return _query_columns(numbered, "page", F.col(report.ROW_NUMBER).alias("no"))
