"""Independent SQL (DuckDB dialect) for each named query, run on the same parquet tables.

The ``preprints`` view is re-derived here in SQL from orders/lineitem. Doubles are rounded
to 6 decimals on both sides; integers are BIGINT; dates are ISO text.
"""

from __future__ import annotations

from scholarspark.functions.recode import category_map

PREPRINTS = """
preprints AS (
 WITH ship AS (SELECT l_orderkey, min(cast(l_shipdate AS date)) AS sd FROM lineitem GROUP BY l_orderkey),
 cit AS (
  SELECT l_orderkey, list(struct_pack(timespan := timespan)) AS citations FROM (
   SELECT l_orderkey, CASE WHEN l_linenumber = 5 THEN '' ELSE
     concat(CASE WHEN dd < 0 THEN '-' ELSE '' END, 'P', cast(cast(floor(abs(dd)/365) AS bigint) AS varchar), 'Y',
            cast(cast(floor((abs(dd) % 365)/30) AS bigint) AS varchar), 'M') END AS timespan
   FROM (SELECT l_orderkey, l_linenumber,
                date_diff('day', cast(o_orderdate AS date), cast(l_shipdate AS date)) AS dd
         FROM lineitem JOIN orders ON l_orderkey = o_orderkey) a) b
  GROUP BY l_orderkey)
 SELECT o_orderkey AS _id,
  concat('10.1/', cast(cast(floor(o_orderkey/3) AS bigint) AS varchar)) AS doi,
  cast((o_orderkey % 3)*4+2 AS varchar) AS version,
  CASE WHEN cast(floor(o_orderkey/3) AS bigint) % 2 = 0 THEN 'serverA' ELSE 'serverB' END AS server,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'neuroscience' WHEN '2-HIGH' THEN 'systems biology'
    WHEN '3-MEDIUM' THEN 'oncology' WHEN '4-NOT SPECIFIED' THEN 'hiv aids' ELSE 'marine biology' END AS category,
  concat('Order ', cast(o_orderkey AS varchar), ' ', o_orderpriority) AS title,
  repeat(concat('Customer ', cast(o_custkey AS varchar), ' é. '), cast(1 + o_custkey % 9 AS int)) AS abstract,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE repeat('X, Y;', cast(1 + o_orderkey % 6 AS int)) END AS authors,
  cast(NULL AS varchar) AS author_corresponding_institution,
  cast(cast(o_orderdate AS date) AS varchar) AS date,
  CASE WHEN o_orderstatus = 'O' THEN 'NA' ELSE concat('10.9/', cast(o_orderkey AS varchar)) END AS published,
  CASE WHEN o_orderstatus = 'O' THEN NULL WHEN o_orderkey % 7 = 0 THEN ''
       WHEN o_orderkey % 5 = 0 THEN substr(cast(sd AS varchar), 1, 4) ELSE cast(sd AS varchar) END AS publiDate,
  CASE WHEN o_orderstatus = 'O' THEN NULL ELSE citations END AS citations
 FROM orders LEFT JOIN ship ON ship.l_orderkey = o_orderkey LEFT JOIN cit ON cit.l_orderkey = o_orderkey)"""

# ingest normalisation ('' date text -> NULL) and keep-latest per DOI
LATEST = """
ingested AS (SELECT * REPLACE (CASE WHEN trim(date) <> '' THEN date END AS date,
                               CASE WHEN trim(publiDate) <> '' THEN publiDate END AS publiDate)
             FROM preprints),
latest AS (SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY doi ORDER BY try_cast(version AS INTEGER) DESC NULLS LAST,
                                                         date DESC NULLS LAST) AS rn
  FROM ingested) WHERE rn = 1)"""


def _completed(c: str) -> str:
    return (f"(CASE WHEN {c} IS NULL OR trim({c}) = '' THEN NULL "
            f"WHEN regexp_full_match({c}, '[0-9]{{4}}') THEN {c} || '-01-01' "
            f"WHEN regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}') THEN {c} || '-01' ELSE {c} END)")


DERIVED = f"""
d1 AS (SELECT *,
  length(title) AS titleLength, length(abstract) AS abstractLength,
  CASE WHEN authors IS NOT NULL THEN len(string_split(authors, ';')) END AS numberAuthors,
  {_completed('date')} AS dateFormatted, {_completed('publiDate')} AS publiDateFormatted,
  try_cast({_completed('date')} AS DATE) AS dateConverted,
  try_cast({_completed('publiDate')} AS DATE) AS publiDateConverted
  FROM latest),
d2 AS (SELECT *,
  CASE WHEN published IS NOT DISTINCT FROM 'NA' THEN 'NP'
       WHEN dateConverted IS NULL OR publiDateConverted IS NULL THEN 'publi_nodate'
       WHEN date_diff('day', dateConverted, publiDateConverted) < 365 THEN 'year1'
       WHEN date_diff('day', dateConverted, publiDateConverted) < 730 THEN 'year2'
       ELSE 'year2+' END AS publiStatus,
  (published IS DISTINCT FROM 'NA' AND citations IS NOT NULL) AS has_cit
  FROM d1),
derived AS (SELECT * EXCLUDE (has_cit),
  CASE WHEN has_cit THEN len(citations) END AS citTotal,
  CASE WHEN has_cit THEN len(list_filter(citations, lambda c: string_split(c.timespan, 'Y')[1] = 'P0')) END AS cit1year,
  CASE WHEN has_cit THEN len(list_filter(citations,
       lambda c: try_cast(string_split(string_split(c.timespan, 'P')[2], 'Y')[1] AS INTEGER) >= 2)) END AS cit2years
  FROM d2)"""


def category_case(c: str = "category") -> str:
    whens = " ".join(f"WHEN {c} = '{k}' THEN '{v}'" for k, v in category_map().items())
    return f"coalesce(CASE {whens} END, {c})"


BINARY = ("CASE WHEN publiStatus = 'year1' THEN 'Published_year1' "
          "WHEN publiStatus IN ('NP', 'year2', 'year2+') THEN 'NotPublished_year1' END")

EXPORTED = f"""
exported AS (SELECT * FROM derived
  WHERE published IS NOT DISTINCT FROM 'NA' OR publiStatus IS DISTINCT FROM 'publi_nodate'),
recoded AS (SELECT *, {category_case()} AS category_grouped, {BINARY} AS publiStatus_binary,
  month(dateConverted) AS month_upload FROM exported)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


PP = with_ctes(PREPRINTS)
PP_LATEST = with_ctes(PREPRINTS, LATEST)
PP_DERIVED = with_ctes(PREPRINTS, LATEST, DERIVED)
PP_RECODED = with_ctes(PREPRINTS, LATEST, DERIVED, EXPORTED)

STRIPPED = """
stripped AS (SELECT * REPLACE (CASE WHEN published = 'NA' THEN 'NA' WHEN _id % 31 <> 0 THEN '10.9/' || (_id // 3) END AS published,
                               CASE WHEN _id % 4 <> 0 THEN publiDate END AS publiDate,
                               CASE WHEN _id % 4 <> 0 THEN citations END AS citations)
             FROM (SELECT * REPLACE (CASE WHEN trim(date) <> '' THEN date END AS date,
                                     CASE WHEN trim(publiDate) <> '' THEN publiDate END AS publiDate)
                   FROM preprints)),
responses AS (SELECT _id, _id // 3 AS g, '10.9/' || (_id // 3) AS doi, publiDate, citations,
                row_number() OVER (PARTITION BY _id // 3 ORDER BY (publiDate IS DISTINCT FROM '') DESC, _id DESC) AS date_rn,
                row_number() OVER (PARTITION BY _id // 3 ORDER BY (citations IS NOT NULL) DESC, _id DESC) AS cit_rn
              FROM preprints WHERE published <> 'NA'),
lookups AS (SELECT coalesce(m.doi, c.doi) AS doi, m.publiDate AS pub_date, c.citations,
              coalesce(m.publiDate IS DISTINCT FROM '' AND m.doi IS NOT NULL, FALSE) AS date_ok,
              c.citations IS NOT NULL AS cit_ok
            FROM (SELECT * FROM responses WHERE date_rn = 1 AND g % 11 <> 0) m
            FULL JOIN (SELECT * FROM responses WHERE cit_rn = 1 AND g % 17 <> 0) c ON m.doi = c.doi)"""


def freq_sql(source: str, columns: list[str]) -> str:
    unions = " UNION ALL ".join(
        f"SELECT '{c}' AS variable, cast({c} AS varchar) AS level FROM {source}" for c in columns)
    return f"""counts AS (SELECT variable, level, count(*) AS n FROM ({unions}) GROUP BY variable, level)
SELECT variable, level, n, round(n * 100.0 / sum(n) OVER (PARTITION BY variable), 6) AS pct,
  row_number() OVER (PARTITION BY variable ORDER BY n DESC, level ASC NULLS FIRST) AS freq_rank
FROM counts"""


RECORDS = {
    "published_share_by_category": PP_RECODED + """
SELECT category_grouped, count(*) AS n_items,
  round(avg(CASE WHEN publiStatus_binary IS NULL THEN NULL
                 WHEN publiStatus_binary = 'Published_year1' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6)
    AS proportion_published,
  row_number() OVER (ORDER BY count(*) DESC, category_grouped ASC NULLS FIRST) AS size_rank
FROM recoded WHERE abstractLength <> (SELECT max(abstractLength) FROM recoded)
GROUP BY category_grouped""",

    "dedup_latest": PP_LATEST + """
SELECT doi, _id, version, date, published, publiDate,
  CASE WHEN citations IS NOT NULL THEN len(citations) END AS n_citations FROM latest""",

    "derived_lengths": PP_DERIVED + """
SELECT doi, titleLength, abstractLength, numberAuthors,
  length(concat(title, ' ', abstract)) AS mergedLength FROM derived""",

    "publication_status": PP_DERIVED + """
SELECT doi, cast(dateConverted AS varchar) AS date_converted,
  cast(publiDateConverted AS varchar) AS publi_date_converted,
  date_diff('day', dateConverted, publiDateConverted) AS days_to_publication, publiStatus FROM derived""",

    "citation_counts": PP_DERIVED + """
SELECT doi, citTotal, cit1year, cit2years FROM derived WHERE citTotal IS NOT NULL""",

    "needs_enrichment": with_ctes(PREPRINTS, STRIPPED) + """
SELECT _id, doi, published FROM stripped
WHERE published IS DISTINCT FROM 'NA' AND publiDate IS NULL AND citations IS NULL""",

    "enrich_lookup": with_ctes(PREPRINTS, STRIPPED) + """,
j AS (SELECT s.*, l.doi AS lk_doi, l.pub_date AS lk_date, l.citations AS lk_cit,
        (s.published IS DISTINCT FROM 'NA' AND s.publiDate IS NULL AND s.citations IS NULL
         AND l.doi IS NOT NULL AND l.date_ok AND l.cit_ok) AS take
      FROM stripped s LEFT JOIN lookups l ON s.published = l.doi)
SELECT _id, doi, CASE WHEN take THEN lk_date ELSE publiDate END AS publiDate,
  CASE WHEN take THEN len(lk_cit) WHEN citations IS NOT NULL THEN len(citations) END AS n_citations,
  take AS enriched
FROM j""",

    "export_filter": PP_DERIVED + """
SELECT doi, publiStatus FROM derived
WHERE published IS NOT DISTINCT FROM 'NA' OR publiStatus IS DISTINCT FROM 'publi_nodate'""",

    "export_table": PP_DERIVED + """
SELECT doi, server, cast(try_cast(version AS INTEGER) AS BIGINT) AS version, category, publiStatus, date,
  author_corresponding_institution, titleLength, abstractLength, numberAuthors, cit1year
FROM derived
WHERE published IS NOT DISTINCT FROM 'NA' OR publiStatus IS DISTINCT FROM 'publi_nodate'""",

    "upsert_by_key": """
WITH t AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderkey % 4 <> 3),
s AS (SELECT o_orderkey, lower(o_orderstatus) AS o_orderstatus, o_totalprice * 2 AS o_totalprice,
        CASE WHEN o_orderkey % 4 <> 2 THEN o_orderpriority END AS o_orderpriority
      FROM orders WHERE o_orderkey % 4 <> 0)
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderstatus ELSE t.o_orderstatus END AS o_orderstatus,
  round(CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END, 6) AS o_totalprice,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_orderpriority ELSE t.o_orderpriority END AS o_orderpriority,
  CASE WHEN t.o_orderkey IS NULL THEN 'inserted' WHEN s.o_orderkey IS NOT NULL THEN 'updated'
       ELSE 'unchanged' END AS merge_action
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey""",

    "unique_violations": PP + """
SELECT doi, count(*) AS n_rows FROM preprints GROUP BY doi HAVING count(*) > 1""",

    "category_regroup": PP_LATEST + f"""
SELECT doi, category, {category_case()} AS category_grouped FROM latest""",

    "month_counts": """
SELECT month(cast(o_orderdate AS date)) AS month_num, strftime(cast(o_orderdate AS date), '%b') AS month_label,
  count(*) AS n_orders FROM orders GROUP BY 1, 2""",

    "log_features": PP_DERIVED + """
SELECT doi, round(CASE WHEN numberAuthors > 0 THEN ln(numberAuthors) END, 6) AS numberAuthorsLog,
  round(CASE WHEN cit1year > 0 THEN ln(cit1year) END, 6) AS cit1yearLog,
  round(ln(1 + cit1year), 6) AS log_cit1year FROM derived""",

    "drop_global_max": """
SELECT doc_id, n_chars FROM documents WHERE n_chars <> (SELECT max(n_chars) FROM documents)""",

    "freq_export": PP_RECODED + "," + freq_sql("recoded", ["publiStatus", "server", "month_upload",
                                                           "category_grouped"]),

    "freq_docs": "WITH " + freq_sql("documents", ["lang", "source"]),

    "freq_within": """
SELECT lang, source, count(*) AS n,
  round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY lang), 6) AS pct_within
FROM documents GROUP BY lang, source""",
}


def _months(x: str) -> str:
    y = f"try_cast(regexp_extract({x}, '([0-9]+)Y', 1) AS INTEGER)"
    m = f"try_cast(regexp_extract({x}, '([0-9]+)M', 1) AS INTEGER)"
    return (f"(CASE WHEN {y} IS NOT NULL OR {m} IS NOT NULL THEN "
            f"(CASE WHEN starts_with({x}, '-') THEN -1 ELSE 1 END) * (coalesce({y}, 0) * 12 + coalesce({m}, 0)) END)")


RECORDS["citation_spans"] = PP_LATEST + f"""
SELECT doi, len(citations) AS n_citations,
  list_max(list_transform(citations, lambda c: {_months('c.timespan')}))::BIGINT AS longest_span_months,
  list_min(list_transform(citations, lambda c: {_months('c.timespan')}))::BIGINT AS shortest_span_months
FROM latest WHERE citations IS NOT NULL AND len(citations) > 0"""


RECORDS["freq_all"] = (f"SELECT * FROM ({RECORDS['freq_export']}) UNION ALL "
                       f"SELECT * FROM ({RECORDS['freq_docs']})")

RECORDS["replace_latest"] = RECORDS["dedup_latest"]


def _split_args(inner: str) -> tuple[str, str | None]:
    depth = 0
    for i in range(len(inner) - 1, -1, -1):
        ch = inner[i]
        if ch == ")":
            depth += 1
        elif ch == "(":
            depth -= 1
        elif ch == "," and depth == 0:
            return inner[:i], inner[i + 1:].strip()
    return inner, None


def stable_rounds(sql: str) -> str:
    """Rewrite every ``round(x, 6)`` as ``round(try_cast(x AS DECIMAL(38,9)), 6)::DOUBLE``.

    This is the rounding the Spark side applies to every double (``plans.common.stable_round``):
    snap to 9 decimals exactly, then half-up to 6, so summation-order noise in the last bits and
    binary-vs-decimal tie handling cannot make the engines print different numbers.
    """
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        if j > 0 and (sql[j - 1].isalnum() or sql[j - 1] == "_"):
            out.append(sql[i:j + 6])
            i = j + 6
            continue
        depth, k = 0, j + 5
        while k < len(sql):
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        expr, digits = _split_args(sql[j + 6:k])
        expr = stable_rounds(expr)
        out.append(sql[i:j])
        if digits == "6":
            out.append(f"round(try_cast(({expr}) AS DECIMAL(38,9)), 6)::DOUBLE")
        else:
            out.append(f"round({expr}{', ' + digits if digits else ''})")
        i = k + 1

RECORDS["stored_export"] = RECORDS["export_table"]
