"""Join of rows to one row per group, safe for hot groups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_groups(
    rows: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "left", null_group: bool = False
) -> DataFrame:
    """Join ``rows`` to ``groups``, which has one row per key and was aggregated by those keys.

    AQE splits a hot key only if both inputs of the join are plain shuffles. A plain equality
    would reuse the shuffle of the aggregate, and the hot key would stay in one task. The
    null-safe comparison hashes differently, so both sides are shuffled for the join; ``groups``
    is small by then. NULL keys meet only with ``null_group``.
    """
    if not null_group:
        for k in keys:
            groups = groups.where(F.col(k).isNotNull())
    right = groups.withColumnsRenamed({k: f"_g_{k}" for k in keys})
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_g_{k}")) for k in keys])
    joined = rows.join(right, same, how)
    return joined.drop(*[f"_g_{k}" for k in keys])
