"""Joining rows to one row per key when a few keys may hold a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: keys with more than one part in MOST of all rows are hot; there are fewer than MOST of them
MOST = 1000


def join_counted(rows: DataFrame, groups: DataFrame, key: str, count: str, how: str = "inner") -> DataFrame:
    """``rows`` joined to ``groups``, which has one row per key and the number of rows it stands for.

    Keys that hold more than 1/MOST of the counted rows are fewer than MOST, whatever the
    data, so their groups are broadcast and their rows stay where they are; the other rows
    are told by a list of those keys. All other keys are joined by a shuffle in which no key
    is large, and without hot keys that join is all. ``how`` is inner or left. Both inputs
    are read twice and should be written tables.
    """
    total = groups.agg(F.sum(count)).first()[0] or 0
    is_hot = F.col(count) * MOST > F.lit(total)
    keys = [r[0] for r in groups.where(is_hot).select(key).collect()]
    if not keys:
        return rows.join(groups, key, how)
    found = rows.join(F.broadcast(groups.where(is_hot)), key)
    is_rest = F.coalesce(~F.col(key).isin(keys), F.lit(True))
    return found.unionByName(rows.where(is_rest).join(groups.where(~is_hot), key, how))
