"""Trusted -> refined: one fact, a location and a calendar dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata import schemas as S
from lakestrata.operators.star import (
    calendar_dim, fact, location_dim, location_state, merged_location_state, with_location_key,
)
from lakestrata.sources.commit import commit, finish, read_released, stage
from lakestrata.sources.csv import read_csv, read_partitioned_csv
from lakestrata.sources.sinks import write_table


#: Beside the star's four tables: what later publications merge their new locations with.
STATE = "location_state"


def read_trusted(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The trusted table with its declared types, whatever the format at rest."""
    if fmt == "csv":
        return read_partitioned_csv(spark, path, S.TRUSTED).select(*S.TRUSTED_COLUMNS)
    return spark.read.schema(S.TRUSTED).parquet(path).select(*S.TRUSTED_COLUMNS)


def refine(trusted: DataFrame, *, location_order: Sequence[str] = ("DATE_ID", "FONTE"),
           key_sep: str = "") -> dict[str, DataFrame]:
    """The four refined tables and the state of the locations, lazily; each reads only the columns it needs."""
    base = with_location_key(trusted, sep=key_sep)
    return {
        "fato_covid": fact(base, S.FACT_COLUMNS, (S.FACT_PARTITION, "DATE_ID")),
        "dim_location": location_dim(base, order=location_order),
        "dim_calendar": calendar_dim(base),
        "base_trusted": base,
        STATE: location_state(base, order=location_order),
    }


def refine_more(spark: SparkSession, trusted: DataFrame, new_rows: DataFrame, root: str, fmt: str = "parquet", *,
                location_order: Sequence[str] = ("DATE_ID", "FONTE"), key_sep: str = "") -> dict[str, DataFrame]:
    """As ``refine``, where the published star lacks only ``new_rows`` of the trusted table.

    Both dimensions are the published ones merged with those of the new rows; no other row is read for them.
    """
    tables = refine(trusted, location_order=location_order, key_sep=key_sep)
    new = with_location_key(new_rows.select(*{*S.LOCATION, *location_order, "DATE_ID", "LAT", "LONG"}), sep=key_sep)
    state = merged_location_state(read_refined(spark, root, STATE), location_state(new, order=location_order), order=location_order)
    dates = read_refined(spark, root, "dim_calendar", fmt).select(F.col("DATE_ID").cast("date").alias("DATE_ID"))
    return {**tables, STATE: state, "dim_location": state.select(*S.DIM_LOCATION_COLUMNS),
            "dim_calendar": calendar_dim(dates.unionByName(new.select("DATE_ID")))}


def null_date_rows(spark: SparkSession, trusted: DataFrame,
                   view: str = "base_trusted") -> DataFrame:
    """Rows whose date could not be read, through SQL on a view that Spark names and drops; a caller's view stays."""
    return spark.sql(f"SELECT * FROM {{{view}}} WHERE DATE_ID IS NULL", **{view: trusted})


def publish_refined(tables: dict[str, DataFrame], root: str, fmt: str = "parquet",
                    fact_rebalance: bool = False, from_day=None, days: DataFrame | None = None) -> None:
    """Publish the star, all four tables or none: the fact partitioned by its date copy, the rest whole.

    The tables are staged and then released together (``sources.commit``), so a run that stops anywhere leaves a whole star to
    ``read_refined``: the old one, or the new one.  With ``from_day`` only the fact's days from it on are written, with ``days``
    (a table of ``DATE_ID``) only these, each replacing its folder.

    The trusted input is columnar, so the four writes each scan their own
    columns instead of holding the whole table in memory between them.  It
    is also stored one folder per DATE_ID, so every scan task already holds
    few dates and the fact (partitioned by the same date) is written without
    a shuffle; pass ``fact_rebalance=True`` for an input not laid out by date.
    """
    rows, partial = tables["fato_covid"], from_day is not None or days is not None
    spark = rows.sparkSession
    finish(spark, root)
    if from_day is not None:
        rows = rows.where(F.col("DATE_ID") >= F.lit(from_day))
    if days is not None:
        changed = days.select(F.col("DATE_ID").alias("__day")).distinct()
        rows = rows.join(changed, F.col("DATE_ID").eqNullSafe(F.col("__day")), "left_semi")
    staged = stage(root)
    write_table(rows, f"{staged}/fato_covid", fmt=fmt, partition_by=[S.FACT_PARTITION], rebalance=fact_rebalance)
    whole = ["dim_location", "dim_calendar", "base_trusted"]
    for name in whole:
        write_table(tables[name], f"{staged}/{name}", fmt=fmt)
    if STATE in tables:
        write_table(tables[STATE], f"{staged}/{STATE}")
        whole.append(STATE)
    commit(spark, root, staged, whole if partial else ["fato_covid", *whole], ["fato_covid"] if partial else [])


def read_refined(spark: SparkSession, root: str, name: str, fmt: str = "parquet") -> DataFrame:
    """A table of the star that counts, also while a release is being moved into place."""
    csv = fmt == "csv" and name != STATE
    read = lambda path: read_csv(spark, path, sep="|") if csv else spark.read.parquet(path)
    return read_released(spark, root, name, read, S.FACT_PARTITION)
