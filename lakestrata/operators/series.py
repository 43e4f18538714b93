"""Ordered series per key: previous values, and cumulative -> daily counters.

``previous_values`` is ``lag`` over ``PARTITION BY keys ORDER BY order``,
built so that no key has to fit in one task:

1. Rows are counted per key, a partial aggregate; the keys with more than ``split_above`` rows
   are written as a small table and joined, never fetched.
2. The rows of all other keys go through one window per key.
3. The rows of the hot keys are range-partitioned by the whole order, whatever its types, so
   Spark's sampled bounds cut a key into parts of about equal size, and written with the number of their part.
   The last value of every (key, part) is found with ``max_by``, reduced inside each task;
   a window over those, a row a part, gives every part what it inherits; rows and heads are windowed
   together per (key, part), and the heads dropped.

Counting and writing run while the plan is built: over an input that is costly to compute
(a join, a CSV parse), write it first and pass the written table.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakestrata.session import scratch_path

_P = "__series_part"
_M = "__series_row"
PREV = "__prev_"

SPLIT_ABOVE = 2_000_000


def _prev_expr(c: str, w: Window, ignore_nulls: bool) -> Column:
    if ignore_nulls:
        return F.last(F.col(c), ignorenulls=True).over(
            w.rowsBetween(Window.unboundedPreceding, -1))
    return F.lag(F.col(c)).over(w)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hot_keys(df: DataFrame, keys: Sequence[str], split_above: int = SPLIT_ABOVE) -> DataFrame:
    """The keys with more than ``split_above`` rows, as a table."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > F.lit(split_above)).select(*keys))


def _joined(df: DataFrame, hot: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Semi- or anti-join in which NULL equals NULL."""
    other = hot.select(*[F.col(k).alias(f"__hot_{i}") for i, k in enumerate(keys)])
    return df.join(other, reduce(and_, [F.col(k).eqNullSafe(F.col(f"__hot_{i}")) for i, k in enumerate(keys)]), how)


def _split_previous(rows: DataFrame, keys: list[str], order: list[str], cols: list[str],
                    ignore_nulls: bool, prefix: str) -> DataFrame:
    """Steps 3: the previous values of keys of any size."""
    parts = _written(rows.repartitionByRange(*keys, *order).withColumn(_P, F.spark_partition_id()), "series-parts")
    at = F.struct(*[F.col(o) for o in order])
    tails = parts.groupBy(*keys, _P).agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), at) if ignore_nulls else at).alias(c) for c in cols])
    w_parts = Window.partitionBy(*keys).orderBy(_P)
    heads = tails.select(*keys, _P, *[_prev_expr(c, w_parts, ignore_nulls).alias(c) for c in cols], F.lit(0).alias(_M))
    both = parts.withColumn(_M, F.lit(1)).unionByName(heads, allowMissingColumns=True)
    w = Window.partitionBy(*keys, _P).orderBy(F.col(_M), *order)
    prev = {prefix + c: _prev_expr(c, w, ignore_nulls) for c in cols}
    return both.withColumns(prev).where(F.col(_M) == 1).select(*rows.columns, *prev)


def previous_values(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    cols: Sequence[str], *, ignore_nulls: bool = False,
                    prefix: str = PREV, split_above: int | None = SPLIT_ABOVE) -> DataFrame:
    """Add ``prefix + c`` = the value of ``c`` on the previous row of its key.

    ``order`` is ascending with NULLs first, of any orderable types; give it a tie-breaker so the
    order is total, else equal rows may come in any order (as with any
    window).  ``ignore_nulls`` takes the last non-NULL value before the row
    instead of the previous row's value.  Keys with more than ``split_above`` rows are
    split (0: every key; None: no key, one plain window).
    """
    keys, order, cols = list(keys), list(order), list(cols)
    if set(cols) & (set(keys) | set(order)):
        raise ValueError("value columns must not be key or order columns")
    w = Window.partitionBy(*keys).orderBy(*order)
    plain = lambda x: x.withColumns({prefix + c: _prev_expr(c, w, ignore_nulls) for c in cols})
    if split_above is None:
        return plain(df)
    hot = _written(hot_keys(df, keys, split_above), "hot-keys")
    if hot.isEmpty():
        return plain(df)
    split = _split_previous(_joined(df, hot, keys, "left_semi"), keys, order, cols, ignore_nulls, prefix)
    return plain(_joined(df, hot, keys, "left_anti")).unionByName(split)


def lag_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], col: str,
              alias: str, **kwargs) -> DataFrame:
    """Previous row's ``col`` per key as ``alias`` (NULL on the first row)."""
    out = previous_values(df, keys, order, [col], prefix="__lag_", **kwargs)
    return out.withColumnRenamed(f"__lag_{col}", alias)


def cumulative_to_daily(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                        counters: Sequence[str], *, tiebreak: Sequence[str] = (),
                        ignore_null_gaps: bool = False, cumulative_suffix: str = "_AC",
                        **kwargs) -> DataFrame:
    """Turn cumulative counters into per-step values.

    Each counter ``c`` is renamed ``c + cumulative_suffix`` in place and a new
    ``c`` = ``c - previous c`` is appended; on the first row of a key, and on
    the row after a NULL, it falls back to the cumulative value.  Drops stay
    negative.  ``ignore_null_gaps`` subtracts the last non-NULL value instead,
    so 10, 15, NULL, 20 gives 10, 5, NULL, 5 rather than 10, 5, NULL, 20.
    Other keyword arguments go to ``previous_values`` (split_above).
    """
    full_order = list(order) + [t for t in tiebreak if t not in order]
    x = previous_values(df, keys, full_order, counters, ignore_nulls=ignore_null_gaps, **kwargs)
    daily = [F.coalesce(F.try_subtract(F.col(c), F.col(PREV + c)), F.col(c)).alias(c)
             for c in counters]
    kept = [F.col(c).alias(c + cumulative_suffix) if c in counters else F.col(c)
            for c in df.columns]
    return x.select(*kept, *daily)
