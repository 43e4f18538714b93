"""What is offered, what is loaded, what is missing, and loading it.

All of it is joins: a key list anti-joined with the loaded keys gives the
missing keys, and the source semi-joined with the missing keys gives the rows
to load.  The right side of each join is reduced to distinct keys first (a
partial aggregate), so a key repeated in a third of the rows is one row when
it reaches the join; AQE may then broadcast it, by its measured size, or split
skewed partitions of the left side.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F


def _keys(df: DataFrame, key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def missing_keys(source: DataFrame, target: DataFrame, key: str | Sequence[str] = "DATE_KEY",
                 keep: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``source`` (projected to ``keep``, default the key) whose key is
    not in ``target``.  An empty target leaves every source key missing; a
    NULL key never matches, so it is reported missing."""
    k = _keys(source, key)
    left = source.select(*(keep or k))
    right = target.select(*k).distinct()
    return left.join(right, k, "left_anti")


def with_target(source: DataFrame, target: DataFrame, key: str | Sequence[str],
                target_cols: Sequence[str]) -> DataFrame:
    """Left outer join USING the key: every source row, with the target's
    columns where the key is loaded and NULL where it is not.  A key loaded
    twice gives two rows, as any left join does."""
    k = _keys(source, key)
    return source.join(target.select(*k, *target_cols), k, "left")


def load_missing(source: DataFrame, missing: DataFrame,
                 key: str | Sequence[str] = "DATE_KEY") -> DataFrame:
    """The rows of ``source`` whose key is in ``missing`` (a semi-join)."""
    k = _keys(source, key)
    return source.join(missing.select(*k).distinct(), k, "left_semi")


def pending(*missing: DataFrame) -> DataFrame:
    """Union (by position, duplicates kept) of several missing-key lists."""
    return reduce(lambda a, b: a.union(b), missing)


def pending_count(*missing: DataFrame, alias: str = "PENDING") -> DataFrame:
    """One row: how many keys are still to load."""
    return pending(*missing).agg(F.count(F.lit(1)).alias(alias))


def has_pending(*missing: DataFrame) -> bool:
    """Driver-side check that stops at the first missing key."""
    return not pending(*missing).isEmpty()
