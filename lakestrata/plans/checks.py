"""Invariants of the published lake, as Spark queries returning violations.

Each check returns the offending rows (empty = holds).  All are joins or
partial aggregates, so they run on the cluster at table scale.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakestrata import schemas as S
from lakestrata.plans.refined import read_refined


def orphan_keys(fact: DataFrame, dim: DataFrame, key: str = "LOCATION_KEY") -> DataFrame:
    """Distinct fact keys with no row in the dimension (NULL matches NULL)."""
    f = fact.select(key).distinct()
    d = dim.select(F.col(key).alias("__dim_key")).distinct()
    return f.join(d, f[key].eqNullSafe(d["__dim_key"]), "left_anti")


def duplicate_keys(dim: DataFrame, key: str = "LOCATION_KEY") -> DataFrame:
    """Keys that occur more than once in a dimension, with their count."""
    return dim.groupBy(key).agg(F.count(F.lit(1)).alias("N")).filter(F.col("N") > 1)


def series_mismatch(trusted: DataFrame, keys: Sequence[str] = tuple(S.LOCATION), day: str = "DATE_ID",
                    counters: Sequence[str] = tuple(S.COUNTERS),
                    cumulative_suffix: str = "_AC") -> DataFrame:
    """Series without NULLs whose daily values do not add up to the last
    cumulative value (one row per key and counter).  Where the last day has
    several rows, the sum must lie within their values."""
    per_day, per_key = [], []
    for c in counters:
        ac = F.col(c + cumulative_suffix)
        per_day += [F.sum(c).alias(f"{c}__sum"), F.min(ac).alias(f"{c}__low"), F.max(ac).alias(f"{c}__high"),
                    F.count_if(ac.isNull()).alias(f"{c}__nulls")]
        last = F.struct(F.col(day).isNotNull(), day)
        per_key += [F.sum(f"{c}__sum").alias(f"{c}__sum"), F.max_by(f"{c}__low", last).alias(f"{c}__low"),
                    F.max_by(f"{c}__high", last).alias(f"{c}__high"), F.sum(f"{c}__nulls").alias(f"{c}__nulls")]
    sums = trusted.groupBy(*keys, day).agg(*per_day).groupBy(*keys).agg(*per_key)
    bad = [sums.filter((F.col(f"{c}__nulls") == 0)
                       & ~F.coalesce(F.col(f"{c}__sum").between(F.col(f"{c}__low"), F.col(f"{c}__high")), F.lit(False)))
           .select(*keys, F.lit(c).alias("COUNTER"), F.col(f"{c}__sum").alias("DAILY_SUM"),
                   F.col(f"{c}__high").cast("long").alias("LAST_CUMULATIVE"))
           for c in counters]
    out = bad[0]
    for b in bad[1:]:
        out = out.unionByName(b)
    return out


def verify_lake(spark: SparkSession, refined: str, fmt: str, trusted: DataFrame, quality: DataFrame,
                sources: Mapping[str, tuple[DataFrame, DataFrame]], kept: Mapping[str, Column]) -> dict[str, int]:
    """Violation counts of the published files (all zero when they hold).

    ``sources``: each source's offered rows and its raw zone; ``kept``: which of these rows the later zones have.
    Rows lost or doubled between two zones show as the difference of their numbers.
    """
    fact, location, calendar, base = (read_refined(spark, refined, n, fmt) for n in (
        "fato_covid", "dim_location", "dim_calendar", "base_trusted"))
    offered = sum(o.count() for o, _ in sources.values())
    raw = sum(r.count() for _, r in sources.values())
    wanted = sum(r.where(kept[src]).count() for src, (_, r) in sources.items())
    labelled, days, facts = quality.count(), trusted.count(), fact.count()
    return {
        "orphan_location_keys": orphan_keys(fact, location).count(),
        "duplicate_location_keys": duplicate_keys(location).count(),
        "duplicate_dates": duplicate_keys(calendar, "DATE_ID").count(),
        "series_mismatch": series_mismatch(trusted).count(),
        "rows_source_raw": abs(offered - raw),
        "rows_raw_quality": abs(wanted - labelled),
        "rows_quality_trusted": abs(labelled - days),
        "rows_trusted_fact": abs(days - facts),
        "rows_trusted_published": abs(days - base.count()),
    }
