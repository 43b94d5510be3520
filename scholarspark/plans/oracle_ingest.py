"""SQL oracles for the ingest queries."""

from __future__ import annotations

from scholarspark.plans.ingest import PAGE_SIZE
from scholarspark.plans.oracle import DERIVED, PP, PP_LATEST, PREPRINTS, RECORDS, STRIPPED, with_ctes

_HARVEST = f""",
seq AS (SELECT server, substr(date, 1, 4) AS interval, row_number() OVER (PARTITION BY server, substr(date, 1, 4) ORDER BY _id) - 1 AS i,
          count(*) OVER (PARTITION BY server, substr(date, 1, 4)) AS total FROM preprints),
pages AS (SELECT server, interval, page, total, count(*) AS loaded FROM (SELECT *, i // {PAGE_SIZE} AS page FROM seq)
          WHERE page % 7 <> 3 GROUP BY server, interval, page, total),
ext0 AS (SELECT server, interval, page * {PAGE_SIZE} - CASE WHEN page % 11 = 4 THEN 30 ELSE 0 END AS cursor, loaded,
           CASE WHEN page % 5 = 2 THEN 2 ELSE 1 END AS times, total FROM pages),
ext AS (SELECT *, cursor + loaded AS e, coalesce(max(cursor + loaded) OVER (PARTITION BY server, interval ORDER BY cursor
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reached FROM ext0),
totals AS (SELECT server, interval, max(total) AS declared_total, max(e) AS last FROM ext GROUP BY ALL),
gaps AS (SELECT server, interval, reached::BIGINT AS missing_from, cursor::BIGINT AS missing_to FROM ext WHERE cursor > reached
         UNION ALL SELECT server, interval, last::BIGINT, declared_total::BIGINT FROM totals WHERE declared_total > last)"""

INGEST = {
    "json_props": "SELECT event_id, json_extract(props, '$.k')::BIGINT AS k FROM events",

    "json_pages": PP + f"""
SELECT _id // {PAGE_SIZE} AS page_no, doi, version, server, published, publiDate,
  CASE WHEN citations IS NOT NULL THEN len(citations) END AS n_citations FROM preprints""",

    "page_completeness": PP + f"""
SELECT _id // {PAGE_SIZE} AS page_no, count(*) AS declared_total, count(*) AS declared_new, count(*) AS loaded
FROM preprints GROUP BY 1""",

    "stream_pages": PP_LATEST + """
SELECT doi, version, date, published, publiDate, CASE WHEN citations IS NOT NULL THEN len(citations) END AS n_citations
FROM latest""",

    "harvest_completeness": PP + _HARVEST + """,
g AS (SELECT server, interval, count(*) AS n_gaps, sum(missing_to - missing_from)::BIGINT AS missing_records FROM gaps GROUP BY ALL),
p AS (SELECT server, interval, sum(times)::BIGINT AS n_pages, sum(times - 1)::BIGINT AS repeated_pages,
        sum(greatest(0, least(e, reached) - cursor))::BIGINT AS overlapping_records FROM ext GROUP BY ALL)
SELECT server, interval, declared_total, n_pages, repeated_pages, overlapping_records, coalesce(n_gaps, 0) AS n_gaps,
  coalesce(missing_records, 0) AS missing_records, coalesce(n_gaps, 0) = 0 AS complete
FROM totals JOIN p USING (server, interval) LEFT JOIN g USING (server, interval)""",

    "harvest_gaps": PP + _HARVEST + " SELECT server, interval, missing_from, missing_to FROM gaps",

    "landed_lookups": RECORDS["enrich_lookup"],

    "stream_latest": """
SELECT user_id, event_id, event_type, round(value, 6) AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1""",
}


_ENRICHED = """
j AS (SELECT s.*, l.doi AS lk_doi, l.pub_date AS lk_date, l.citations AS lk_cit,
        (s.published IS DISTINCT FROM 'NA' AND s.publiDate IS NULL AND s.citations IS NULL
         AND l.doi IS NOT NULL AND l.date_ok AND l.cit_ok) AS take
      FROM stripped s LEFT JOIN lookups l ON s.published = l.doi),
enriched AS (SELECT * EXCLUDE (lk_doi, lk_date, lk_cit, take)
               REPLACE (CASE WHEN take THEN lk_date ELSE publiDate END AS publiDate,
                        CASE WHEN take THEN lk_cit ELSE citations END AS citations)
             FROM j),
latest AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY doi ORDER BY try_cast(version AS INTEGER) DESC NULLS LAST,
                                                         date DESC NULLS LAST) AS rn
  FROM enriched) WHERE rn = 1)"""

INGEST["landed_export"] = with_ctes(PREPRINTS, STRIPPED, _ENRICHED, DERIVED) + """
SELECT doi, server, cast(try_cast(version AS INTEGER) AS BIGINT) AS version, category, publiStatus, date,
  author_corresponding_institution, titleLength, abstractLength, numberAuthors, cit1year
FROM derived
WHERE published IS NOT DISTINCT FROM 'NA' OR publiStatus IS DISTINCT FROM 'publi_nodate'"""
