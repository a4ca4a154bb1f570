"""Choice of the site rule of a page."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.functions.rules import RULE, SiteRule, rule_row


def rule_table(spark: SparkSession, rules: Iterable[SiteRule]) -> DataFrame:
    """One row per domain: its rules, best first.

    Best means higher priority, then longer path prefix, then earlier registration.
    """
    rules = list(rules)
    ranked = sorted(rules, key=lambda r: (r.priority, len(r.path_prefix or "")), reverse=True)
    by_domain: dict[str, list] = {}
    for r in ranked:
        by_domain.setdefault(r.domain, []).append(rule_row(r))
    return spark.createDataFrame(list(by_domain.items()), f"_domain string, _rules array<{RULE}>")


def pick_site_rule(pages: DataFrame, rules: Iterable[SiteRule] | DataFrame, domain: str = "domain", path: str = "path") -> DataFrame:
    """Add ``rule``, the best rule for the page's domain and path, or NULL.

    ``rules`` may be a table like :func:`rule_table`'s.  The rules of a domain arrive
    as one array, so the choice itself needs no shuffle.
    """
    here = F.col(path)
    best = F.get(F.filter(F.col("_rules"), lambda r: (
        F.coalesce(here.startswith(r.getField("path_prefix")), F.lit(True))
        & F.coalesce(F.regexp_like(here, r.getField("path_regex")), F.lit(True)))), F.lit(0))
    table = rules if isinstance(rules, DataFrame) else rule_table(pages.sparkSession, rules)
    return pages.join(table, F.col(domain) == F.col("_domain"), "left").withColumn("rule", best).drop("_domain", "_rules")
