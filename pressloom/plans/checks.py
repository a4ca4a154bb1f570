"""All checks; importing this module fills the registry."""

from pressloom.plans import checks_feed, checks_files, checks_pages, checks_report, checks_sheet, checks_streams, checks_text  # noqa: F401
from pressloom.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
