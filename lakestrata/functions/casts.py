"""Safe casts for raw text columns.

Raw snapshot files arrive as text.  The casts below give the same answers as
Spark's lenient (non-ANSI) casts the layered lake was written for, while
running under ANSI mode: a bad value becomes NULL instead of failing the job.

* int, long: the whole part, so ``"123.0"`` is 123 and ``"123.7"`` is 123;
  letters (``12d``, ``1e3``) and hex forms are NULL.
* decimal(p, s): HALF_UP rounding to the scale, NULL on overflow.
* date: ISO date with an optional time part; more patterns may be given.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DecimalType


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_string(c: str | Column) -> Column:
    return _c(c).cast("string")


def as_double(c: str | Column) -> Column:
    return _c(c).try_cast("double")


# A whole number with an optional fraction, which is cut off; blanks and control characters around it don't count.
# Text of any other form is NULL before a cast sees it (a failed text -> integer cast is slow: it fails by exception).
_BLANK = r"[\x00-\x20\x7F]*"
_WHOLE = rf"^{_BLANK}([+-]?\d+)(?:\.\d*)?{_BLANK}$"
_NO_WHOLE = rf"^{_BLANK}[+-]?\.\d*{_BLANK}$"  # nothing before the point: 0


def _integer(c: str | Column, kind: str) -> Column:
    x = _c(c).cast("string")
    whole = F.nullif(F.regexp_extract(x, _WHOLE, 1), F.lit("")).try_cast(kind)
    # The second pattern is tried only where the first gave nothing.
    return F.coalesce(whole, F.when(x.rlike(_NO_WHOLE), F.lit(0).cast(kind)))


def as_int(c: str | Column) -> Column:
    return _integer(c, "int")


def as_long(c: str | Column) -> Column:
    return _integer(c, "long")


def as_decimal(c: str | Column, precision: int = 10, scale: int = 0) -> Column:
    return _c(c).try_cast(DecimalType(precision, scale))


def as_date(c: str | Column, formats: Iterable[str] = ()) -> Column:
    base = _c(c).try_cast("date")
    alts = [F.to_date(F.try_to_timestamp(_c(c), F.lit(fmt))) for fmt in formats]
    return F.coalesce(base, *alts) if alts else base


_KINDS = {
    "string": as_string,
    "double": as_double,
    "int": as_int,
    "long": as_long,
    "date": as_date,
}


def quote_ident(name: str) -> str:
    """A column name as a SQL identifier."""
    return "`" + name.replace("`", "``") + "`"


def quote_str(value: str) -> str:
    """A Python string as a SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def typed_sql(name: str, kind: str, date_formats: Iterable[str] = ()) -> str:
    """The safe cast of a named column as SQL text (same results as ``typed``)."""
    x = quote_ident(name)
    kind = kind.replace(" ", "").lower()
    if kind.startswith("decimal"):
        spec = "(10,0)" if kind == "decimal" else kind[len("decimal"):]
        return f"TRY_CAST({x} AS DECIMAL{spec})"
    if kind == "string":
        return f"CAST({x} AS STRING)"
    if kind == "double":
        return f"TRY_CAST({x} AS DOUBLE)"
    if kind in ("int", "long"):
        t = f"CAST({x} AS STRING)"
        whole = f"TRY_CAST(NULLIF(regexp_extract({t}, {quote_str(_WHOLE)}, 1), '') AS {kind.upper()})"
        return f"COALESCE({whole}, CASE WHEN {t} RLIKE {quote_str(_NO_WHOLE)} THEN CAST(0 AS {kind.upper()}) END)"
    if kind == "date":
        alts = [f"to_date(try_to_timestamp({x}, {quote_str(f)}))" for f in date_formats]
        base = f"TRY_CAST({x} AS DATE)"
        return f"COALESCE({base}, {', '.join(alts)})" if alts else base
    raise ValueError(f"unknown cast kind {kind!r}")


def typed(c: str | Column, kind: str, date_formats: Iterable[str] = ()) -> Column:
    """Cast by a short type name: string, double, int, long, date, decimal(p,s).

    A column given by name is cast through one SQL expression, which the
    driver builds in a single call; a Column goes through the functions above.
    """
    if isinstance(c, str):
        return F.expr(typed_sql(c, kind, date_formats))
    kind = kind.replace(" ", "").lower()
    if kind.startswith("decimal"):
        if kind == "decimal":
            return as_decimal(c)
        p, s = kind[len("decimal("):-1].split(",")
        return as_decimal(c, int(p), int(s))
    if kind == "date":
        return as_date(c, date_formats)
    if kind not in _KINDS:
        raise ValueError(f"unknown cast kind {kind!r}")
    return _KINDS[kind](c)


def cast_columns(df: DataFrame, spec: Mapping[str, str],
                 date_formats: Iterable[str] = ()) -> DataFrame:
    """Replace each named column by its safe cast, in one projection."""
    fmts = tuple(date_formats)
    return df.withColumns({name: typed(name, kind, fmts) for name, kind in spec.items()})
