"""Raw -> trusted: two report layouts into one typed, labelled, daily table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata import schemas as S
from lakestrata.operators.harmonise import SourceMap, harmonise
from lakestrata.operators.quality import (
    COVID_GATE, COVID_RULES, annotate, gate, ratio, ratio_check, report,
)
from lakestrata.operators.series import cumulative_to_daily
from lakestrata.session import scratch_path
from lakestrata.sources.csv import read_csv_strings
from lakestrata.sources.sinks import write_table

#: Carried beside the harmonised columns to order rows of one key and day: the update's time and the file's key.
CARRIED = {"LAST_UPDATE": "Last_Update", "FILE_KEY": "DATE_KEY"}


def harmonise_reports(general: DataFrame, us: DataFrame, date_formats: Iterable[str] = (),
                      date_column: str = "Last_Update", carry: bool = False) -> DataFrame:
    """Tag both sources, drop county rows of the general one, rename, union, cast.

    ``date_column``: the raw column that gives DATE_ID, the update's or (with a
    format such as ``MM-dd-yyyy``) the file's key.  With ``carry`` the ``CARRIED`` columns are added as text, NULL where
    a source has none.
    """
    formats = tuple(date_formats)

    def mapped(df: DataFrame, tag: str, rename: dict[str, str], keep=None) -> tuple[DataFrame, SourceMap]:
        names = {src: dst for src, dst in rename.items() if dst != "DATE_ID"} | {date_column: "DATE_ID"}
        if carry:
            present = {c.lower(): c for c in df.columns}
            df = df.withColumns({c: F.col(present[raw.lower()]).cast("string") if raw.lower() in present
                                 else F.lit(None).cast("string") for c, raw in CARRIED.items()})
        return df, SourceMap(tag, names, keep=keep)

    columns = S.HARMONISED_COLUMNS + (list(CARRIED) if carry else [])
    return harmonise(
        [mapped(general, S.TAG_GENERAL, S.GENERAL_RENAME, F.col(S.COUNTY_COLUMN).isNull()),
         mapped(us, S.TAG_US, S.US_RENAME)],
        columns, S.HARMONISED_CASTS, S.SOURCE_COLUMN, formats)


def quality_table(harmonised: DataFrame, ratio_tolerance: float = 0.0) -> DataFrame:
    """Harmonised rows with the ten labels, the ratio check and the recomputed ratio."""
    return annotate(harmonised, COVID_RULES).withColumns({
        "check_calc_case_fatality_ratio": ratio_check(
            "DEATHS", "CONFIRMED", "CASE_FATALITY_RATIO", tolerance=ratio_tolerance),
        "NEW_CASE_FATALITY_RATIO": ratio("DEATHS", "CONFIRMED"),
    })


def row_order(q: DataFrame):
    """What orders the rows of one location and day: the update's time, source, file, then all else.

    Two rows that tie in it are equal in every column, so any order of them gives the same table.
    """
    carried = [F.col("LAST_UPDATE").try_cast("timestamp")] if "LAST_UPDATE" in q.columns else []
    first = ["FONTE", *(c for c in CARRIED if c in q.columns)]
    rest = [c for c in S.HARMONISED_COLUMNS if c not in ("FONTE", "DATE_ID", *S.LOCATION)]
    # Each field under a name of its own: the counters are values of the series too.
    return F.struct(*[c.alias(f"o{i}") for i, c in enumerate([*carried, *map(F.col, first + rest)])])


def trusted_from_quality(q: DataFrame, *, ignore_null_gaps: bool = False, apply_gate: bool = False,
                         **series_kwargs) -> DataFrame:
    """The trusted table from the labelled one: cumulative counters as ``*_AC``,
    daily ones in their place, the recomputed ratio as CASE_FATALITY_RATIO.

    The series key is (STATE, COUNTRY) ordered by DATE_ID, then ``row_order``, so every run
    gives the same deltas.  The gate (all of the first eight labels pass) is
    off by default, as in the published pipeline.  ``series_kwargs`` go to
    ``previous_values``.
    """
    if apply_gate:
        q = gate(q, COVID_GATE)
    q = q.withColumn("ROW_ORDER", row_order(q)).select(
        *[c for c in S.HARMONISED_COLUMNS if c != "CASE_FATALITY_RATIO"],
        F.col("NEW_CASE_FATALITY_RATIO").alias("CASE_FATALITY_RATIO"), "ROW_ORDER")
    daily = cumulative_to_daily(q, S.LOCATION, ["DATE_ID"], S.COUNTERS, tiebreak=["ROW_ORDER"],
                                ignore_null_gaps=ignore_null_gaps, **series_kwargs)
    return daily.select(*S.TRUSTED_COLUMNS)


def raw_to_trusted(general: DataFrame, us: DataFrame, *, date_formats: Iterable[str] = (),
                   date_column: str = "Last_Update", **kwargs) -> DataFrame:
    """Raw frames -> trusted (see ``trusted_from_quality``)."""
    return trusted_from_quality(quality_table(harmonise_reports(general, us, date_formats, date_column, carry=True)),
                                **kwargs)


def run_trusted(spark: SparkSession, general_dir: str, us_dir: str, trusted_path: str, *,
                quality_path: str | None = None, raw_sep: str = "|", fmt: str = "parquet",
                date_formats: Iterable[str] = (), date_column: str = "Last_Update", **kwargs) -> dict[str, str]:
    """Raw folders -> labelled table -> trusted table, both written whole.

    The labelled, typed table is written first (Parquet, below the shared
    checkpoint folder unless a path is given): the raw text is parsed once,
    the labels stay available for ``report``, and the series step reads only the
    columns it needs from it.
    """
    general = read_csv_strings(spark, general_dir, sep=raw_sep)
    us = read_csv_strings(spark, us_dir, sep=raw_sep)
    quality_path = quality_path or scratch_path(spark, "quality")
    labelled = quality_table(harmonise_reports(general, us, date_formats, date_column, carry=True))
    write_table(labelled, quality_path, fmt="parquet")
    trusted = trusted_from_quality(spark.read.parquet(quality_path), **kwargs)
    write_table(trusted, trusted_path, fmt=fmt, partition_by=["DATE_ID"])
    return {"quality": quality_path, "trusted": trusted_path}


def last_rows(q: DataFrame, ignore_null_gaps: bool = False) -> DataFrame:
    """Per location, the last row: what later days are subtracted from.

    With ``ignore_null_gaps`` each counter is its last known value.  A partial aggregate: a task sends one row a location.
    """
    at = F.struct("DATE_ID", row_order(q).alias("o"))
    value = lambda c: F.when(F.col(c).isNotNull(), at) if ignore_null_gaps and c in S.COUNTERS else at
    rest = [c for c in q.columns if c not in S.LOCATION]
    return q.groupBy(*S.LOCATION).agg(*[F.max_by(c, value(c)).alias(c) for c in rest]).select(*q.columns)


def quality_summary(spark: SparkSession, quality_path: str) -> DataFrame:
    """(RULE, LABEL, N) over the labelled table ``run_trusted`` wrote."""
    labelled = spark.read.parquet(quality_path)
    return report(labelled, COVID_RULES)
