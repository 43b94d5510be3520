"""Citation counts over the nested ``citations: array<struct<timespan>>`` column.

A timespan is an ISO-8601 duration as text (``P1Y2M``, negative ``-P0Y3M``). Counting
uses higher-order functions on the array, so no explode/shuffle is needed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _guard(arr: Column, value: Column) -> Column:
    # size(NULL) is -1 when ANSI is off; keep NULL whatever the session setting.
    return F.when(arr.isNotNull(), value)


def cit_total(citations="citations") -> Column:
    arr = _col(citations)
    return _guard(arr, F.size(arr))


def cit_first_year(citations="citations") -> Column:
    """Citations whose timespan text before the first 'Y' is exactly 'P0' (negative spans excluded)."""
    arr = _col(citations)
    return _guard(arr, F.size(F.filter(arr, lambda c: F.get(F.split(c["timespan"], "Y", -1), 0) == F.lit("P0"))))


def _span_years(ts: Column) -> Column:
    # integer between the first 'P' and the following 'Y'; NULL when absent or not a number
    return F.get(F.split(F.get(F.split(ts, "P", -1), 1), "Y", -1), 0).try_cast("int")


def cit_two_years_or_more(citations="citations") -> Column:
    """Citations at two years or later (the sign of the span is ignored, as in the source rule)."""
    arr = _col(citations)
    return _guard(arr, F.size(F.filter(arr, lambda c: _span_years(c["timespan"]) >= F.lit(2))))


def span_months(ts: Column) -> Column:
    """Signed length of a 'P<y>Y<m>M' timespan in months; NULL when it has neither part."""
    y = F.regexp_extract(ts, r"([0-9]+)Y", 1).try_cast("int")
    m = F.regexp_extract(ts, r"([0-9]+)M", 1).try_cast("int")
    sign = F.when(F.startswith(ts, F.lit("-")), F.lit(-1)).otherwise(F.lit(1))
    return F.when(y.isNotNull() | m.isNotNull(), sign * (F.coalesce(y, F.lit(0)) * 12 + F.coalesce(m, F.lit(0))))


def sort_by_span_desc(citations="citations") -> Column:
    """Citations ordered by descending parsed timespan (unparseable spans last, equal ones as they stood), not by text. Each
    span is parsed once, into the key its citation is sorted by."""
    def keyed(c: Column, i: Column) -> Column:
        months = span_months(c["timespan"])
        return F.struct(months.isNull().alias("unknown"), (-months).alias("order"), i.alias("at"), c.alias("citation"))
    return F.transform(F.array_sort(F.transform(_col(citations), keyed)), lambda k: k["citation"])
