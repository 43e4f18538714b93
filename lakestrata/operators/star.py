"""Star schema: location key, location and calendar dimensions, fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from lakestrata.functions.calendar import calendar_attributes
from lakestrata.functions.keys import composite_key


def with_location_key(df: DataFrame, optional: Sequence[str] = ("STATE",),
                      required: Sequence[str] = ("COUNTRY",), sep: str = "",
                      name: str = "LOCATION_KEY") -> DataFrame:
    """``LOCATION_KEY = coalesce(STATE, '') || COUNTRY`` (see ``composite_key``)."""
    return df.withColumn(name, composite_key(optional, required, sep))


def first_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str],
                  cols: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order`` (ascending, NULLs first).

    Built as ``min_by`` in a grouped aggregate, not a window: each task keeps
    one candidate per key before the shuffle, so a key that holds a third of
    the rows still sends one row per task.  The ordering also covers the
    returned columns, so equal order values resolve to the same row every run.
    """
    keys = [key] if isinstance(key, str) else list(key)
    vals = [c for c in cols if c not in keys]
    ordering = F.struct(*[F.col(o) for o in order], *[F.col(c) for c in vals])
    picked = F.min_by(F.struct(*[F.col(c) for c in vals]), ordering).alias("__first")
    return df.groupBy(*keys).agg(picked).select(*keys, *[F.col(f"__first.{c}").alias(c)
                                                         for c in vals])


def location_dim(df: DataFrame, key: str = "LOCATION_KEY",
                 attrs: Sequence[str] = ("COUNTRY", "STATE", "LAT", "LONG"),
                 order: Sequence[str] = ("DATE_ID",)) -> DataFrame:
    """One row per location key with its attributes from its first row."""
    return first_per_key(df, key, order, attrs)


def location_state(df: DataFrame, key: str = "LOCATION_KEY", attrs: Sequence[str] = ("COUNTRY", "STATE", "LAT", "LONG"),
                   order: Sequence[str] = ("DATE_ID",)) -> DataFrame:
    """What ``location_dim`` keeps of its rows: the first of each key, with its place in the order.

    States merge: ``merged_location_state`` of two tables' states is the state of both tables together.
    """
    return first_per_key(df, key, order, [*order, *(a for a in attrs if a not in order)])


def merged_location_state(old: DataFrame, new: DataFrame, key: str = "LOCATION_KEY",
                          attrs: Sequence[str] = ("COUNTRY", "STATE", "LAT", "LONG"), order: Sequence[str] = ("DATE_ID",)) -> DataFrame:
    return location_state(old.unionByName(new), key, attrs, order)


def calendar_dim(df: DataFrame, date_col: str = "DATE_ID") -> DataFrame:
    """Distinct dates seen (gaps stay gaps; a NULL date gives a NULL row)."""
    return df.select(date_col).distinct().withColumns(calendar_attributes(date_col))


def fact(df: DataFrame, cols: Sequence[str], partition_copy: tuple[str, str] | None =
         ("DATE_KEY_PART", "DATE_ID")) -> DataFrame:
    """Project the fact columns; add a copy of the date to partition the files by."""
    out = df.select(*cols)
    if partition_copy:
        name, src = partition_copy
        out = out.withColumn(name, F.col(src))
    return out
