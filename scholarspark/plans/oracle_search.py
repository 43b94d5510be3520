"""SQL oracles for the search queries."""

from __future__ import annotations

from scholarspark.plans.oracle import PP_LATEST
from scholarspark.plans.search import BM25_QUERY, BOOL_PHRASES, THEME, TOP_K


def norm(x: str) -> str:
    return rf"trim(regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"


def toks(x: str) -> str:
    return f"(CASE WHEN {norm(x)} = '' THEN []::VARCHAR[] ELSE string_split({norm(x)}, ' ') END)"


def pad(x: str) -> str:
    return f"(' ' || {norm(x)} || ' ')"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


BOOL_SUM = " + ".join(f"cast(contains({pad('text')}, {pad(_q(p))}) AS BIGINT)" for p in BOOL_PHRASES)
BOOL_HITS = f"hits AS (SELECT doc_id, {BOOL_SUM} AS n_clauses_matched FROM documents)"

THEME_SUM = " + ".join(f"cast(contains({pad('title')}, {pad(_q(p))}) OR contains({pad('abstract')}, {pad(_q(p))}) AS BIGINT)"
                       for p in THEME)

SEARCH = {
    "thematic_subset": PP_LATEST + f""",
hits AS (SELECT doi, version, category, published, {THEME_SUM} AS n_clauses_matched FROM latest)
SELECT * FROM hits WHERE n_clauses_matched >= 1""",

    "phrase_search": f"""
WITH d AS (SELECT doc_id, {pad('text')} AS p, {toks('text')} AS toks FROM documents),
b AS (SELECT item_id, {pad('text')} AS p, {toks('text')} AS ptoks FROM benchmark WHERE {norm('text')} <> ''),
pairs AS (SELECT doc_id, item_id, toks, ptoks FROM d JOIN b ON contains(d.p, b.p))
SELECT doc_id, item_id AS phrase_id,
  len(list_filter(range(1, len(toks) - len(ptoks) + 2), lambda i: toks[i:i + len(ptoks) - 1] = ptoks))
    AS occurrences
FROM pairs""",

    "bool_should": f"WITH {BOOL_HITS} SELECT doc_id, n_clauses_matched FROM hits WHERE n_clauses_matched >= 1",

    "search_count": f"WITH {BOOL_HITS} SELECT count(*) AS n_hits FROM hits WHERE n_clauses_matched >= 1",

    "bm25_topk": f"""
WITH d AS (SELECT doc_id, {toks('text')} AS toks FROM documents),
st AS (SELECT count(*)::DOUBLE AS n, avg(len(toks)) AS avgdl FROM d),
q AS (SELECT DISTINCT unnest({toks(_q(BM25_QUERY))}) AS term),
r AS (SELECT doc_id, len(toks) AS dl, unnest(toks) AS term FROM d),
tf AS (SELECT doc_id, dl, term, count(*) AS tf FROM r WHERE term IN (SELECT term FROM q) GROUP BY ALL),
dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
sc AS (SELECT doc_id, sum(ln(1 + (st.n - df + 0.5) / (df + 0.5)) * tf * (1.2 + 1)
                        / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / st.avgdl))) AS score
       FROM tf JOIN dfq USING (term), st GROUP BY doc_id)
SELECT doc_id, round(score, 6) AS score,
  row_number() OVER (ORDER BY round(score, 9) DESC, doc_id) AS rank
FROM sc ORDER BY round(score, 9) DESC, doc_id LIMIT {TOP_K}""",

    "bm25_phrases": f"""
WITH d AS (SELECT doc_id, {toks('text')} AS toks FROM documents),
st AS (SELECT count(*)::DOUBLE AS n, avg(len(toks)) AS avgdl FROM d),
cl AS (SELECT c, ptoks FROM (VALUES {', '.join(f"({i}, {toks(_q(p))})" for i, p in enumerate(BOOL_PHRASES))}) v(c, ptoks)),
terms AS (SELECT DISTINCT unnest(ptoks) AS term FROM cl),
dfq AS (SELECT term, count(DISTINCT doc_id) FILTER (WHERE hit) AS df FROM (
  SELECT term, doc_id, list_contains(toks, term) AS hit FROM d, terms) GROUP BY term),
w AS (SELECT c, any_value(ptoks) AS ptoks, sum(ln(1 + (n - df + 0.5) / (df + 0.5))) AS idf
      FROM (SELECT c, ptoks, unnest(ptoks) AS term FROM cl) JOIN dfq USING (term), st GROUP BY c),
pf AS (SELECT doc_id, len(toks) AS dl, c, idf,
         len(list_filter(range(1, len(toks) - len(ptoks) + 2), lambda i: toks[i:i + len(ptoks) - 1] = ptoks)) AS pf FROM d, w)
SELECT doc_id, count(*) AS n_clauses_matched, round(sum(idf * pf * 2.2 / (pf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 6) AS score
FROM pf, st WHERE pf > 0 GROUP BY doc_id ORDER BY round(sum(idf * pf * 2.2 / (pf + 1.2 * (0.25 + 0.75 * dl / avgdl))), 9) DESC, doc_id LIMIT {TOP_K}""",

    "subset_semi": f"""WITH {BOOL_HITS}
SELECT doc_id, quality::BIGINT AS quality, toxic::BIGINT AS toxic FROM labels WHERE doc_id IN (SELECT doc_id FROM hits WHERE n_clauses_matched >= 1)""",
}

SEARCH["indexed_search"] = SEARCH["bool_should"]
