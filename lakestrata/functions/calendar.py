"""Calendar attributes of a date column."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The calendar dimension's column names, as published by the
# refined layer (Portuguese, in this order).
YEAR = "Ano"
MONTH_NAME = "Nome do Mês"
MONTH = "Mês"
QUARTER = "Trimestre"
WEEK_OF_YEAR = "Semana do Ano"
DAY_NAME = "Nome do Dia"
DAY_OF_WEEK = "Dia da Semana"


def calendar_attributes(date_col: str) -> dict[str, Column]:
    """Seven attributes per date; ISO week, Sunday = 1, English names."""
    d = F.col(date_col)
    return {
        YEAR: F.year(d),
        MONTH_NAME: F.date_format(d, "MMMM"),
        MONTH: F.month(d),
        QUARTER: F.quarter(d),
        WEEK_OF_YEAR: F.weekofyear(d),
        DAY_NAME: F.date_format(d, "EEEE"),
        DAY_OF_WEEK: F.dayofweek(d),
    }
