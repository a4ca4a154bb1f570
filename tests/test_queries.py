"""Registered queries against their SQL on the smallest tables, and the guard around the llm part."""

import math
import os
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as entry
from pressloom.plans import checks

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
CHECKED = [
    "scan_envelopes", "feed_pages", "scan_parts", "decode_pages", "flatten_feed", "row_key", "dedup_feed", "valid_urls", "report_in_filter",
    "topic_filter", "report_query", "chunk_ids", "number_rows", "shard_rows", "enrich_master", "recover_empty", "attach_translations",
    "registered_domain", "keep_body_lines", "norm_key", "page_title", "articles", "parse_dates", "news_sheet", "stream_parts", "site_title",
    "article_kinds", "prune_chrome", "pick_container", "largest_block", "report_pages", "amp_variant", "site_exclusion", "stream_histogram_days",
    "stream_dedup", "stream_histogram", "udf_result_shapes",
]


def plain(value):
    return "nan" if isinstance(value, float) and math.isnan(value) else f"{value:.9g}" if isinstance(value, float) else repr(value)


@pytest.fixture(scope="module")
def tables(data):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{data}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_its_sql(spark, data, tables, name):
    got = entry.queries()[name](spark, data)
    want = tables.sql(entry.oracle_sql()[name])
    names = sorted(want.columns)
    assert sorted(got.columns) == names
    expected = want.select(*[duckdb.ColumnExpression(n) for n in names]).fetchall()
    assert sorted(tuple(map(plain, r)) for r in got.select(*names).collect()) == sorted(tuple(map(plain, r)) for r in expected)


def test_the_histogram_counts_the_last_days_too(tables):
    assert tables.sql(f"SELECT sum(n) FROM ({entry.oracle_sql()['stream_histogram_days']})").fetchall() == tables.sql("SELECT count(*) FROM events").fetchall()


def test_entry_is_the_news_sheet(spark):
    assert entry.entry(spark).columns[0] == "no"


def test_the_extraction_plans_small(spark, data):
    """The plan that the sheet stages, with every expression of a page in it."""
    pages = checks.QUERIES["articles"](spark, data)
    assert 50_000 < len(pages._jdf.queryExecution().optimizedPlan().toString()) < 200_000


def test_every_survey_query_is_registered():
    assert len(checks.QUERIES) >= 119 and set(checks.SQL) <= set(checks.QUERIES)


def test_entry_works_without_the_llm_part(tmp_path):
    root = os.path.dirname(os.path.abspath(entry.__file__))
    (tmp_path / "pressloom").mkdir()
    os.symlink(f"{root}/__spark_entry__.py", tmp_path / "__spark_entry__.py")
    for part in os.listdir(f"{root}/pressloom"):
        if part != "llm" and not part.startswith("__pycache__"):
            os.symlink(f"{root}/pressloom/{part}", tmp_path / "pressloom" / part)
    code = "import runpy; m = runpy.run_path('__spark_entry__.py'); q = m['queries'](); print('pipeline' in q, 'news_sheet' in q)"
    # the file's own folder is what it imports from, so a copy stands in for the link
    (tmp_path / "__spark_entry__.py").unlink()
    with open(f"{root}/__spark_entry__.py") as source:
        (tmp_path / "__spark_entry__.py").write_text(source.read())
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.stdout.split() == ["False", "True"], out.stderr[-500:]
