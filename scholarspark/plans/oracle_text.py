"""SQL oracles for text processing and embeddings (the hashing embedder is reproduced in SQL)."""

from __future__ import annotations


def clean(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


def ws_tokens(x: str) -> str:
    return f"(CASE WHEN {clean(x)} = '' THEN []::VARCHAR[] ELSE string_split({clean(x)}, ' ') END)"


def norm_tokens(x: str) -> str:
    return (f"list_filter(list_transform({ws_tokens(x)}, lambda t: regexp_replace(t, '[^a-zA-Z0-9]', '', 'g')),"
            f" lambda t: t <> '')")


def sentences(x: str) -> str:
    return rf"(CASE WHEN {clean(x)} = '' THEN []::VARCHAR[] ELSE regexp_split_to_array({clean(x)}, '[.!?]+\s+') END)"


def _hashed(tok_cte: str) -> str:
    return f"""{tok_cte},
u AS (SELECT doc_id, len(toks) AS n, unnest(toks) AS tok FROM t WHERE len(toks) > 0),
h AS (SELECT doc_id, n, md5(tok) AS m FROM u),
g AS (SELECT doc_id, ('0x' || substr(m, 1, 8))::UBIGINT % 64 AS dim,
        sum(CASE WHEN ('0x' || substr(m, 9, 1))::INTEGER % 2 = 0 THEN 1 ELSE -1 END) AS sgn, any_value(n) AS n
      FROM h GROUP BY doc_id, dim)"""


TEXT = {
    "tokenise": f"""
SELECT doc_id, length({clean('text')}) AS clean_chars, len({ws_tokens('text')}) AS n_tokens,
  len({norm_tokens('text')}) AS n_norm_tokens FROM documents""",

    "sentences": f"""
SELECT doc_id, len({sentences('text')}) AS n_sentences, length({sentences('text')}[1]) AS first_sentence_chars
FROM documents""",

    "mean_pool": """
SELECT label::BIGINT AS label, i - 1 AS dim, round(avg(embedding[i]), 6) AS mean
FROM embeddings, range(1, (SELECT max(len(embedding)) FROM embeddings) + 1) r(i)
WHERE i <= len(embedding) GROUP BY label, i""",

    "vector_size": "SELECT len(embedding) AS vector_size, count(*) AS n_rows FROM embeddings GROUP BY 1",

    "first_sentence_vec": "WITH " + _hashed(f"""f AS (SELECT doc_id, {sentences('text')}[1] AS s FROM documents),
t AS (SELECT doc_id, {norm_tokens('s')} AS toks FROM f WHERE s IS NOT NULL)""") + """
SELECT doc_id, dim::BIGINT AS dim, round(sgn / n, 6) AS value FROM g WHERE sgn <> 0
UNION ALL SELECT doc_id, 0, 0.0 FROM t WHERE doc_id NOT IN (SELECT doc_id FROM g WHERE dim = 0 AND sgn <> 0)""",

    "embed_text": "WITH " + _hashed(f"t AS (SELECT doc_id, {norm_tokens('text')} AS toks FROM documents)") + f""",
agg AS (SELECT doc_id, sum(sgn / n) AS vs, sqrt(sum((sgn / n) * (sgn / n))) AS vn FROM g GROUP BY doc_id)
SELECT d.doc_id, len({norm_tokens('d.text')}) AS n_tokens, round(coalesce(vs, 0), 6) AS vec_sum,
  round(coalesce(vn, 0), 6) AS vec_norm
FROM documents d LEFT JOIN agg USING (doc_id)""",
}


TEXT["sentence_vectors"] = f"""
WITH a AS (SELECT doc_id, {sentences('text')} AS arr FROM documents),
s AS (SELECT doc_id, i AS sentence_idx, arr[i + 1] AS sent
      FROM (SELECT doc_id, arr, unnest(range(len(arr))) AS i FROM a)),
t AS (SELECT doc_id, sentence_idx, {norm_tokens('sent')} AS toks FROM s),
u AS (SELECT doc_id, sentence_idx, len(toks) AS n, unnest(toks) AS tok FROM t WHERE len(toks) > 0),
g AS (SELECT doc_id, sentence_idx, ('0x' || substr(md5(tok), 1, 8))::UBIGINT % 64 AS dim,
        sum(CASE WHEN ('0x' || substr(md5(tok), 9, 1))::INTEGER % 2 = 0 THEN 1 ELSE -1 END) AS sgn, any_value(n) AS n
      FROM u GROUP BY doc_id, sentence_idx, dim),
agg AS (SELECT doc_id, sentence_idx, sum(sgn / n) AS vs, sqrt(sum((sgn / n) * (sgn / n))) AS vn
        FROM g GROUP BY doc_id, sentence_idx)
SELECT t.doc_id, t.sentence_idx::BIGINT AS sentence_idx, len(t.toks)::BIGINT AS n_tokens,
  round(coalesce(vs, 0), 6) AS vec_sum, round(coalesce(vn, 0), 6) AS vec_norm
FROM t LEFT JOIN agg USING (doc_id, sentence_idx)"""
