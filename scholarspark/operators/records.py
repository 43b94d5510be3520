"""Record-level operators on preprints: keep-latest, unique keys, derived fields, enrichment, export.

Everything here is a narrow transformation or one keyed aggregation/join; no operator
collects data to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarspark.functions.citations import cit_first_year, cit_total, cit_two_years_or_more
from scholarspark.functions.dates import complete_date_text, parse_date
from scholarspark.functions.recode import publication_status
from scholarspark.functions.text import author_count, code_point_length
from scholarspark.schemas import EXPORT_COLUMNS

DATE_FIELDS = ("date", "publiDate")


def normalise_dates(df: DataFrame, fields=DATE_FIELDS) -> DataFrame:
    """At ingest: empty date text becomes NULL ('NA' in ``published`` is kept as written)."""
    present = [f for f in fields if f in df.columns]
    return df.withColumns({f: F.when(F.trim(F.col(f)) != "", F.col(f)) for f in present})


def version_number(c="version") -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.try_cast("int")


def keep_latest(df: DataFrame, key: str = "doi", version: str = "version",
                tiebreak: tuple[str, ...] = ("date",)) -> DataFrame:
    """One row per ``key``: highest numeric version, then latest ``tiebreak`` columns, then a stable hash.

    Written as ``max_by`` inside a ``groupBy`` (not a window): the aggregate is computed
    partially on the map side, so a key holding a large share of the rows is reduced per
    task before the shuffle instead of being sorted in one task.
    """
    cols = df.columns
    order = F.struct(version_number(version).alias("_v"),
                     *[F.col(c).alias(f"_t{i}") for i, c in enumerate(tiebreak)],
                     F.xxhash64(*[F.col(c) for c in cols]).alias("_h"))
    picked = df.groupBy(key).agg(F.max_by(F.struct(*[F.col(c) for c in cols]), order).alias("_r"))
    return picked.select("_r.*")


def unique_violations(df: DataFrame, key: str = "doi") -> DataFrame:
    """Keys that occur more than once (an empty result means the key is unique)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def add_lengths(df: DataFrame) -> DataFrame:
    """Title/abstract lengths (code points) and author count, for whichever sources are present."""
    new = {}
    if "title" in df.columns:
        new["titleLength"] = code_point_length("title")
    if "abstract" in df.columns:
        new["abstractLength"] = code_point_length("abstract")
    if "authors" in df.columns:
        new["numberAuthors"] = author_count("authors")
    return df.withColumns(new) if new else df


def add_dates_and_status(df: DataFrame) -> DataFrame:
    """Completed/parsed dates and the publication status (both dates kept, see status rules)."""
    df = df.withColumns({
        "dateFormatted": complete_date_text("date"),
        "publiDateFormatted": complete_date_text("publiDate"),
        "dateConverted": parse_date("date"),
        "publiDateConverted": parse_date("publiDate"),
    })
    return df.withColumn("publiStatus", publication_status("published", "dateConverted", "publiDateConverted"))


def add_citation_counts(df: DataFrame) -> DataFrame:
    """citTotal / cit1year / cit2years for published records that have a citation list."""
    has = (~F.col("published").eqNullSafe(F.lit("NA"))) & F.col("citations").isNotNull()
    return df.withColumns({
        "citTotal": F.when(has, cit_total("citations")),
        "cit1year": F.when(has, cit_first_year("citations")),
        "cit2years": F.when(has, cit_two_years_or_more("citations")),
    })


def derive_fields(df: DataFrame) -> DataFrame:
    """Every derived field the frame's columns allow, in one projection chain (Catalyst
    collapses it into one Project): lengths of the text fields present, dates and status
    always, citation counts when the citation list is present."""
    df = add_dates_and_status(add_lengths(df))
    return add_citation_counts(df) if "citations" in df.columns else df


# -- enrichment ---------------------------------------------------------------------------

def needs_enrichment(df: DataFrame) -> Column:
    """Published (or missing 'published'), with neither a publication date nor a citation list."""
    return ((~F.col("published").eqNullSafe(F.lit("NA")))
            & F.col("publiDate").isNull() & F.col("citations").isNull())


def lookup_succeeded(pub_date: Column, date_ok: Column, citations: Column, cit_ok: Column) -> Column:
    """Both lookups landed and succeeded. An empty date counts as failed; a NULL date from a successful
    call passes, and an empty citation list is valid."""
    return date_ok & cit_ok & (~pub_date.eqNullSafe(F.lit(""))) & citations.isNotNull()


def apply_lookups(target: DataFrame, lookups: DataFrame) -> DataFrame:
    """Set publiDate/citations from the lookup table on every record that needs them.

    ``lookups``: (doi, pub_date, date_ok, citations, cit_ok), one row per published DOI. Only records that
    need enrichment and have a published DOI enter the join; all others (every unpublished record,
    whose 'NA' sentinel would be one hot key, and a NULL DOI, which matches nothing) pass through without
    a shuffle. Every version that shares a published DOI is updated. ``target`` is read twice: pass a stored table.
    """
    need = F.coalesce(needs_enrichment(target) & F.col("published").isNotNull(), F.lit(False))
    rest = target.where(~need).withColumn("enriched", F.lit(False))
    todo = target.where(need)
    lk = lookups.select(F.col("doi").alias("_lk_doi"), F.col("pub_date").alias("_lk_date"), F.col("date_ok").alias("_lk_date_ok"),
                        F.col("citations").alias("_lk_cit"), F.col("cit_ok").alias("_lk_cit_ok"))
    j = todo.join(lk, todo["published"] == lk["_lk_doi"], "left")
    take = j["_lk_doi"].isNotNull() & lookup_succeeded(j["_lk_date"], j["_lk_date_ok"], j["_lk_cit"], j["_lk_cit_ok"])
    done = (j.withColumns({
        "publiDate": F.when(take, F.col("_lk_date")).otherwise(F.col("publiDate")),
        "citations": F.when(take, F.col("_lk_cit")).otherwise(F.col("citations")),
        "enriched": take,
    }).drop("_lk_doi", "_lk_date", "_lk_date_ok", "_lk_cit", "_lk_cit_ok"))
    return rest.unionByName(done)


# -- export ---------------------------------------------------------------------------------

def export_filter(df: DataFrame) -> DataFrame:
    """Keep unpublished records, and published ones whose status has dates."""
    return df.where(F.col("published").eqNullSafe(F.lit("NA"))
                    | (~F.col("publiStatus").eqNullSafe(F.lit("publi_nodate"))))


def export_table(df: DataFrame) -> DataFrame:
    """Fixed export columns; a missing column becomes NULL, ``version`` a tolerant int."""
    cols = []
    for c in EXPORT_COLUMNS:
        if c == "version":
            cols.append(version_number("version").alias("version"))
        elif c in df.columns:
            cols.append(F.col(c))
        else:
            cols.append(F.lit(None).cast("string").alias(c))
    return export_filter(df).select(*cols)


def write_csv(df: DataFrame, path: str) -> None:
    """Distributed CSV export with a header (one file per task, no collection to the driver)."""
    df.write.mode("overwrite").option("header", "true").csv(path)
