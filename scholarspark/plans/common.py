"""Shared pieces of the named queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scholarspark.functions.recode import binary_status, category_group
from scholarspark.operators.records import derive_fields, export_filter, keep_latest, normalise_dates
from scholarspark.sources.fixtures import preprints

ROUND = 6
SNAP = 9


def stable_round(c, digits: int = ROUND, snap: int = SNAP):
    """Round a double the same way in every engine: first to ``snap`` decimals as an exact
    DECIMAL (absorbing summation-order noise in the last bits), then half-up to ``digits``.
    NaN/infinite values become NULL."""
    return F.round(c.try_cast(f"decimal(38,{snap})"), digits).cast("double")


def tidy(df: DataFrame, rounded: bool = True) -> DataFrame:
    """Output types shared with the SQL oracle: integers -> bigint, floats -> double rounded
    to 6 decimals (``stable_round``; not with ``rounded=False``, for results no oracle reads, whose
    small values matter), dates/timestamps -> ISO text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.FloatType, T.DecimalType, T.DoubleType)):
            c = stable_round(c.cast("double")) if rounded else c.cast("double")
        elif isinstance(t, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def r6(c):
    return stable_round(c)


def raw_preprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preprints(spark, sf_dir)


ORDER_COLS = ["doi", "version", "date"]


def latest_preprints(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """Ingested (dates normalised) and de-duplicated to the latest version per DOI.

    ``columns`` limits what travels through the de-duplication shuffle (the winning row is
    carried whole inside ``max_by``, which the optimizer cannot prune field by field).
    """
    df = normalise_dates(preprints(spark, sf_dir))
    if columns:
        df = df.select(*dict.fromkeys(ORDER_COLS + list(columns)))
    return keep_latest(df)


# inputs of the derived fields
DERIVED_INPUTS = ["_id", "server", "category", "title", "abstract", "authors", "published", "publiDate", "citations"]


#: Columns that only feed derived fields, unless a query returns them.
WIDE = ("title", "abstract", "authors", "citations")


def derived_preprints(spark: SparkSession, sf_dir: str, columns: list[str] | None = None,
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """Latest record per DOI with its derived fields. Fields are derived row by row *before* the
    de-duplication, and the wide inputs (text, citation lists) dropped unless in ``keep``, so that only
    numbers and short strings travel through its shuffle."""
    df = normalise_dates(preprints(spark, sf_dir)).select(*dict.fromkeys(ORDER_COLS + list(columns or DERIVED_INPUTS)))
    return keep_latest(derive_fields(df).drop(*[c for c in WIDE if c not in keep]))


RECODE_INPUTS = ["_id", "server", "category", "published", "publiDate", "title", "abstract", "authors"]


def recoded_export(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """The export frame with the recoded analysis columns (category group, binary status, month)."""
    df = export_filter(derived_preprints(spark, sf_dir, columns or RECODE_INPUTS))
    return df.withColumns({
        "category_grouped": category_group("category"),
        "publiStatus_binary": binary_status("publiStatus"),
        "month_upload": F.month("dateConverted"),
    })
