"""Bring sources of different layouts into one typed table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.functions.casts import typed


@dataclass(frozen=True)
class SourceMap:
    """How one source maps onto the shared layout.

    ``tag``     value of the source column on every row of this source.
    ``rename``  source column -> shared column.
    ``keep``    optional row predicate applied before renaming.
    """

    tag: str
    rename: Mapping[str, str] = field(default_factory=dict)
    keep: Column | None = None


def keep_null(df: DataFrame, column: str) -> DataFrame:
    """Keep rows whose ``column`` is NULL (pushed to the scan as IsNull)."""
    return df.filter(F.col(column).isNull())


def map_source(df: DataFrame, mapping: SourceMap, columns: Sequence[str], tag_col: str,
               casts: Mapping[str, str] | None = None,
               date_formats: Iterable[str] = ()) -> DataFrame:
    """Filter, then one projection: renamed, tagged and cast columns in order."""
    if mapping.keep is not None:
        df = df.filter(mapping.keep)
    present = {c.lower(): c for c in df.columns}
    source_of = {dst.lower(): src for src, dst in mapping.rename.items()
                 if src.lower() in present}
    fmts = tuple(date_formats)
    exprs, absent = [], []
    for c in columns:
        if c == tag_col:
            e = F.lit(mapping.tag)
            if casts and c in casts:
                e = typed(e, casts[c], fmts)
        else:
            src = source_of.get(c.lower(), c)
            if src.lower() not in present:
                absent.append(c)
                continue
            name = present[src.lower()]
            e = typed(name, casts[c], fmts) if casts and c in casts else F.col(name)
        exprs.append(e.alias(c))
    if absent:
        raise ValueError(f"source {mapping.tag!r} lacks columns {absent}")
    return df.select(*exprs)


def harmonise(sources: Iterable[tuple[DataFrame, SourceMap]], columns: Sequence[str],
              casts: Mapping[str, str] | None = None, tag_col: str = "FONTE",
              date_formats: Iterable[str] = ()) -> DataFrame:
    """Tag, filter, rename, project and cast each source, then union by name.

    The union is by name, so a source whose columns come in another order
    cannot shift values into the wrong column.  It is a narrow operator: no
    shuffle, each source keeps its partitions.
    """
    fmts = tuple(date_formats)
    frames = [map_source(df, m, columns, tag_col, casts, fmts) for df, m in sources]
    if not frames:
        raise ValueError("no sources")
    return reduce(lambda a, b: a.unionByName(b), frames)
