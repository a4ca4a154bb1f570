"""Helpers of the operators' jobs: written tables, free column names, joins with groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.session import staged

__all__ = ["free_name", "join_groups", "staged"]


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` has it (case is ignored)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def join_groups(rows: DataFrame, groups: DataFrame, keys: list[str], size: str, most: int = 1024) -> DataFrame:
    """``rows`` with the columns of their group in ``groups`` (null where it has none); a group of any size stays spread.

    ``size``: column with the group's rows.  Groups with more than one row in ``most`` of
    all can be no more than ``most``, so they are broadcast; rows of all others
    meet their group by a join.  Both tables are read twice: give written ones.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    is_hot = F.col(size) * most > total
    hot = F.broadcast(groups.filter(is_hot))
    in_hot = rows.join(hot, keys)
    others = rows.join(hot, keys, "left_anti").join(groups.filter(~is_hot), keys, "left")
    return in_hot.unionByName(others)
