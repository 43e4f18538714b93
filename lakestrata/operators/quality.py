"""Row-level data-quality labels, a gate on them and a report of them.

A rule adds one label column: ``PASS`` when the row passes, otherwise the
rule's label for a missing value or for a failed test.  Labels stay on the
table; ``report`` counts all of them in one global aggregate, so the shuffle
carries one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.functions.casts import quote_ident, quote_str

# Fixed value: the label of a passed test.
PASS = "correto"


@dataclass(frozen=True)
class Rule:
    """One label column.

    kind ``present``       NULL -> null_label, else PASS.
    kind ``range``         NULL -> null_label; lo <= value <= hi (compared
                           as double, so text columns work) -> PASS; else
                           fail_label, also when the text is not a number.
    kind ``non_negative``  NULL -> null_label; value < 0 -> fail_label; else PASS.
    """

    name: str
    column: str
    kind: str
    null_label: str
    fail_label: str | None = None
    lo: float | None = None
    hi: float | None = None

    def labels(self) -> list[str]:
        """Every label the rule can give."""
        given = [PASS, self.null_label] + ([] if self.kind == "present" else [self.fail_label])
        return list(dict.fromkeys(label for label in given if label is not None))

    def sql(self) -> str:
        """The label as a SQL CASE expression."""
        x, ok = quote_ident(self.column), quote_str(PASS)
        missing = f"WHEN {x} IS NULL THEN {quote_str(self.null_label)}"
        if self.kind == "present":
            return f"CASE {missing} ELSE {ok} END"
        if self.kind == "range":
            lo, hi = float(self.lo), float(self.hi)
            return (f"CASE {missing} WHEN TRY_CAST({x} AS DOUBLE) BETWEEN {lo!r}D AND {hi!r}D "
                    f"THEN {ok} ELSE {quote_str(self.fail_label)} END")
        if self.kind == "non_negative":
            return (f"CASE {missing} WHEN {x} < 0 THEN {quote_str(self.fail_label)} "
                    f"ELSE {ok} END")
        raise ValueError(f"unknown rule kind {self.kind!r}")

    def label(self) -> Column:
        # One SQL expression: built on the driver in one call, whatever the
        # number of branches.
        return F.expr(self.sql())


def annotate(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add every rule's label column in one projection."""
    return df.withColumns({r.name: r.label() for r in rules})


def gate(df: DataFrame, label_cols: Sequence[str]) -> DataFrame:
    """Keep rows that pass every listed label (all rows when none is listed)."""
    if not label_cols:
        return df
    return df.filter(reduce(and_, [F.col(c) == F.lit(PASS) for c in label_cols]))


def report(df: DataFrame, rules: Sequence[Rule], rule_col: str = "RULE",
           label_col: str = "LABEL", count_col: str = "N") -> DataFrame:
    """(rule, label, rows) for the rules' label columns; labels that no row has are left out.

    The labels of a rule are known, so all are counted in one row per task and turned at the end.
    """
    cells = [(r.name, label) for r in rules for label in r.labels()]
    counts = df.agg(*[F.count_if(F.col(name) == F.lit(label)).alias(f"n{i}") for i, (name, label) in enumerate(cells)])
    lines = F.array(*[F.struct(F.lit(name).alias(rule_col), F.lit(label).alias(label_col), F.col(f"n{i}").alias(count_col))
                      for i, (name, label) in enumerate(cells)])
    return counts.select(F.inline(lines)).where(F.col(count_col) > 0)


def ratio(num: str, den: str, scale: float = 100) -> Column:
    """``num / den * scale``; NULL when ``den`` is 0 or NULL."""
    return F.try_divide(F.col(num), F.col(den)) * F.lit(scale)


def ratio_check(num: str, den: str, reported: str, scale: float = 100,
                tolerance: float = 0.0) -> Column:
    """Is the reported ratio the computed one?  NULL when either is NULL.

    With ``tolerance=0`` this is plain equality of the double ratio with the
    reported value, which is almost never true once the reported value has
    been rounded; a tolerance accepts the rounding.
    """
    r = ratio(num, den, scale)
    if tolerance == 0:
        return r == F.col(reported)
    return F.abs(r - F.col(reported).cast("double")) <= F.lit(tolerance)


# The rules of the raw -> trusted quality step, in order.
COVID_RULES = [
    Rule("teste_completude_lat", "LAT", "present", "sem_latitude"),
    Rule("teste_completude_long", "LONG", "present", "sem_longitude"),
    Rule("teste_range_lat", "LAT", "range", "sem_latitude", "latitude_fora_range", -90, 90),
    Rule("teste_range_long", "LONG", "range", "sem_longitude", "long_fora_range", -180, 180),
    Rule("teste_confirmed", "CONFIRMED", "non_negative", "confirmed_nulos", "confirmed_negativos"),
    Rule("teste_deaths", "DEATHS", "non_negative", "deaths_nulos", "deaths_negativos"),
    Rule("teste_recovered", "RECOVERED", "non_negative", "recovered_nulos", "recovered_negativos"),
    Rule("teste_active", "ACTIVE", "non_negative", "active_nulos", "active_negativos"),
    Rule("teste_incident_rate", "INCIDENT_RATE", "non_negative",
         "incident_rate_nulos", "incident_rate_negativos"),
    Rule("teste_case_fatality_ratio", "CASE_FATALITY_RATIO", "non_negative",
         "case_fatality_ratio_nulos", "case_fatality_ratio_negativos"),
]
# Fixed value: the gate covers the first eight rules.
COVID_GATE = [r.name for r in COVID_RULES[:8]]
