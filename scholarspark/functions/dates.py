"""Date handling for text dates that may be year-only, year-month, empty or junk."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

YEAR_ONLY = r"^[0-9]{4}$"
YEAR_MONTH = r"^[0-9]{4}-[0-9]{2}$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def complete_date_text(c) -> Column:
    """'YYYY' -> 'YYYY-01-01', 'YYYY-MM' -> 'YYYY-MM-01', '' -> NULL, anything else unchanged."""
    c = _col(c)
    return (F.when(c.isNull() | (F.trim(c) == ""), F.lit(None).cast("string"))
            .when(c.rlike(YEAR_ONLY), F.concat(c, F.lit("-01-01")))
            .when(c.rlike(YEAR_MONTH), F.concat(c, F.lit("-01")))
            .otherwise(c))


def parse_date(c) -> Column:
    """Tolerant parse: unparseable text becomes NULL instead of failing the job."""
    return F.try_to_date(complete_date_text(c), "yyyy-MM-dd")


def days_between(start, end) -> Column:
    """Whole days from ``start`` to ``end`` (negative when end precedes start)."""
    return F.datediff(_col(end), _col(start))


def month_label(d) -> Column:
    """Abbreviated English month label ('Jan' .. 'Dec') of a date."""
    return F.date_format(_col(d), "MMM")
