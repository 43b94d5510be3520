"""Full-text search over a text column: analysis, phrase match, boolean should, BM25, subsets.

Analysis (both documents and queries): lower-case, every run of characters that are not
letters or digits is a token break; no stemming. A phrase matches when its token sequence
occurs contiguously in the document's token sequence.

Two phrase strategies:

* ``phrase_query``: a fixed list of phrases (a user query). Each clause is a ``contains``
  test on the space-padded normalised text, which is computed once per row; the phrase side
  is a literal that Catalyst constant-folds. One narrow pass, no shuffle.
* ``phrase_join``: a phrase *table* that grows with the data (e.g. every benchmark
  passage). Each phrase is anchored at the bigram that fewest phrases hold (its token, if it has only
  one), so common bigrams find no candidates; where an anchor stands in a document, the document's
  tokens around it are compared with the phrase's. No document x phrase cross product is formed and
  no prefix of either text is used: every position of every text takes part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarspark.functions.text import padded, tokens
from scholarspark.session import reliable_checkpoint

BM25_K1 = 1.2
BM25_B = 0.75


def with_once(df: DataFrame, expr: Column, name: str) -> DataFrame:
    """Add ``expr`` as a column computed exactly once per row.

    A one-element generator is an optimisation barrier: filters on columns derived from
    ``name`` cannot be pushed below it, so the (regex) expression is not re-inlined into
    every predicate and projection that uses it.
    """
    return df.select("*", F.inline(F.array(F.struct(expr.alias(name)))))


def phrase_query(df: DataFrame, field: str, phrases: list[str]) -> DataFrame:
    """Boolean ``should`` of phrase clauses: rows matching at least one, with the clause count."""
    norm = with_once(df, padded(F.col(field)), "_padded")
    n = sum((F.col("_padded").contains(padded(F.lit(ph))).cast("int") for ph in phrases), F.lit(0))
    return norm.withColumn("n_clauses_matched", n).where(F.col("n_clauses_matched") >= 1).drop("_padded")


def build_index(docs: DataFrame, id_col: str, text_cols: list[str], path: str,
                order_col: str | None = None) -> DataFrame:
    """Write a search index table: per document, the space-padded normalised text of each field.

    With ``order_col`` the last write per key wins (``max_by``, partially aggregated); without
    it the keys are taken as unique. Analysis runs once, at indexing; queries then test
    phrases with plain ``contains`` on the stored columns. Returns the index as read back.
    """
    cols = [padded(F.col(c)).alias(f"{c}_norm") for c in text_cols]
    if order_col:
        latest = docs.groupBy(id_col).agg(
            F.max_by(F.struct(*[F.col(c) for c in text_cols]), F.col(order_col)).alias("_r"))
        docs = latest.select(id_col, "_r.*")
    docs.select(F.col(id_col).alias("doc_id"), *cols).write.mode("errorifexists").parquet(path)
    return docs.sparkSession.read.parquet(path)


def indexed_phrase_query(index: DataFrame, field: str, phrases: list[str]) -> DataFrame:
    """Boolean ``should`` of phrase clauses against an index table's normalised field."""
    norm = F.col(f"{field}_norm")
    n = sum((norm.contains(padded(F.lit(ph))).cast("int") for ph in phrases), F.lit(0))
    return index.withColumn("n_clauses_matched", n).where(F.col("n_clauses_matched") >= 1)


def indexed_fields_query(index: DataFrame, fields: list[str], phrases: list[str]) -> DataFrame:
    """Boolean ``should`` over several fields: a clause matches if its phrase is in any of them."""
    def clause(phrase: str) -> Column:
        hit = F.lit(False)
        for field in fields:
            hit = hit | F.coalesce(F.col(f"{field}_norm").contains(padded(F.lit(phrase))), F.lit(False))
        return hit.cast("int")

    n = sum((clause(p) for p in phrases), F.lit(0))
    return index.withColumn("n_clauses_matched", n).where(F.col("n_clauses_matched") >= 1)


#: Anchors up to so many are literals of the plan, tested where a document is scanned; more are joined.
INLINE_ANCHORS = 5_000


def phrase_anchors(phrases: DataFrame, pid_col: str, text_col: str) -> DataFrame:
    """(phrase_id, ptoks, offset, gram): for each phrase its bigram that fewest phrases hold (of equals the longest, then the
    first), and where it stands; the token of a phrase of one. Phrases without a token are left out."""
    ph = phrases.select(F.col(pid_col).alias("phrase_id"), tokens(F.col(text_col)).alias("ptoks")).where(F.size("ptoks") > 0)
    m = F.size("ptoks")
    grams = F.when(m == 1, F.array(F.struct(F.lit(0).alias("offset"), F.get("ptoks", 0).alias("gram"))))\
        .otherwise(F.transform(F.slice("ptoks", 1, m - 1),
                               lambda t, i: F.struct(i.alias("offset"),
                                                     F.concat(t, F.lit(" "), F.get(F.col("ptoks"), i + 1)).alias("gram"))))
    one = ph.select("phrase_id", "ptoks", F.inline(grams))
    held = one.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    best = F.min(F.struct("n", (-F.length("gram")).alias("long"), "offset", "gram"))
    return (one.join(held, "gram").groupBy("phrase_id", "ptoks").agg(best.alias("best"))
               .select("phrase_id", "ptoks", "best.offset", "best.gram"))


def _gram_positions(toks: Column, single: bool) -> Column:
    """(pos, gram) of all bigrams of a token array, and of all tokens if there are phrases of one."""
    pairs = F.transform(F.slice(toks, F.lit(1), F.greatest(F.size(toks) - 1, F.lit(0))),
                        lambda t, i: F.struct(i.alias("pos"), F.concat(t, F.lit(" "), F.get(toks, i + 1)).alias("gram")))
    return F.concat(pairs, F.transform(toks, lambda t, i: F.struct(i.alias("pos"), t.alias("gram")))) if single else pairs


def phrase_join(docs: DataFrame, id_col: str, text_col: str,
                phrases: DataFrame, pid_col: str, ptext_col: str, inline: int = INLINE_ANCHORS) -> DataFrame:
    """(doc_id, phrase_id, occurrences) for every phrase of a phrase table found in a document.

    Up to ``inline`` distinct anchors the documents are scanned once: positions that hold no anchor are dropped inside the
    row, what is left carries the tokens. Beyond that positions are joined to anchors by gram, and the candidates to the
    documents' tokens by id (ids must then be unique).
    """
    spark = docs.sparkSession
    anchors = reliable_checkpoint(phrase_anchors(phrases, pid_col, ptext_col), "phrase-anchors")
    few = [r["gram"] for r in anchors.select("gram").distinct().limit(inline + 1).collect()]
    if not few:
        return spark.createDataFrame([], anchors.schema).select(F.lit(None).cast(docs.schema[id_col].dataType).alias("doc_id"), "phrase_id",
                                                                F.lit(0).cast("bigint").alias("occurrences"))
    single = not anchors.where(F.size("ptoks") == 1).isEmpty()
    toks = with_once(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col)), tokens(F.col(text_col)), "toks").select("doc_id", "toks")
    places = _gram_positions(F.col("toks"), single)
    if len(few) <= inline:
        found = toks.select("doc_id", "toks", F.inline(F.filter(places, lambda g: g["gram"].isin(few)))).join(anchors, "gram")
    else:
        found = toks.select("doc_id", F.inline(places)).join(anchors, "gram").join(toks.where(F.col("doc_id").isNotNull()), "doc_id")
    start = F.col("pos") - F.col("offset")
    holds = (start >= 0) & (F.slice("toks", F.greatest(start, F.lit(0)) + 1, F.size("ptoks")) == F.col("ptoks"))
    return found.where(holds).groupBy("doc_id", "phrase_id").agg(F.count(F.lit(1)).alias("occurrences"))


def _equals(term: str):
    # a one-argument lambda (a second argument would be taken as the element index)
    return lambda t: t == F.lit(term)


def query_terms(spark, query: str) -> list[str]:
    """The query string analysed exactly like documents (evaluated once on a one-row frame)."""
    return list(spark.range(1).select(F.array_distinct(tokens(F.lit(query)))).first()[0])


def bm25(docs: DataFrame, id_col: str, text_col: str, query: str,
         k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """BM25 score of every document containing at least one query term.

    A query has a handful of terms, so each document's term frequencies are read off its
    own token array (``size(filter(tokens, t -> t = term))`` per term): no explode and no
    shuffle of the corpus. Document frequencies, the corpus size and the mean length come
    from one aggregate over the same projection, used as a scalar subquery.
    """
    terms = query_terms(docs.sparkSession, query)
    toks = with_once(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col)), tokens(F.col(text_col)), "toks")
    per_doc = toks.select("doc_id", F.size("toks").alias("dl"),
                          *[F.size(F.filter("toks", _equals(q))).alias(f"tf{i}") for i, q in enumerate(terms)])
    st = per_doc.select(F.struct(F.count(F.lit(1)).cast("double").alias("n"), F.avg("dl").alias("avgdl"),
                                 *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(terms))])
                        .alias("s")).scalar()
    n, avgdl = st.getField("n"), st.getField("avgdl")
    parts = []
    for i in range(len(terms)):
        tf, dfq = F.col(f"tf{i}"), st.getField(f"df{i}")
        idf = F.ln(F.lit(1.0) + (n - dfq + 0.5) / (dfq + 0.5))
        parts.append(F.when(tf > 0, idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("dl") / avgdl)))
                     .otherwise(F.lit(0.0)))
    any_hit = sum((F.col(f"tf{i}") for i in range(len(terms))), F.lit(0)) > 0
    return per_doc.where(any_hit).select("doc_id", sum(parts, F.lit(0.0)).alias("score"))


def bm25_phrases(docs: DataFrame, id_col: str, text_col: str, phrases: list[str],
                 k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """BM25 score of every document that holds at least one of the phrases (a boolean ``should`` of phrase clauses).

    A clause scores like a term: its frequency is how often the phrase stands in the document (overlaps
    count), read off the token array, and its weight is the sum of its terms' idf. One narrow projection of the corpus and one
    aggregate over it for document frequencies, size and mean length; no shuffle of documents.
    """
    clauses = [c for c in (list(docs.sparkSession.range(1).select(tokens(F.lit(p))).first()[0]) for p in phrases) if c]
    terms = sorted({t for c in clauses for t in c})
    toks = with_once(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col)), tokens(F.col(text_col)), "toks")

    def starts(clause: list[str]) -> Column:
        def here(t: Column, i: Column) -> Column:
            ok = t == F.lit(clause[0])
            for j, term in enumerate(clause[1:], 1):
                ok = ok & (F.coalesce(F.get(F.col("toks"), i + j), F.lit("")) == F.lit(term))
            return ok
        return F.size(F.filter("toks", here))

    per_doc = toks.select("doc_id", F.size("toks").alias("dl"), *[starts(c).alias(f"pf{i}") for i, c in enumerate(clauses)],
                          *[F.array_contains("toks", t).alias(f"has{i}") for i, t in enumerate(terms)])
    st = per_doc.select(F.struct(F.count(F.lit(1)).cast("double").alias("n"), F.avg("dl").alias("avgdl"),
                                 *[F.count_if(f"has{i}").alias(f"df{i}") for i in range(len(terms))]).alias("s")).scalar()
    n, avgdl = st.getField("n"), st.getField("avgdl")
    idf = {t: F.ln(F.lit(1.0) + (n - st.getField(f"df{i}") + 0.5) / (st.getField(f"df{i}") + 0.5)) for i, t in enumerate(terms)}
    score, hit = F.lit(0.0), F.lit(0)
    for i, c in enumerate(clauses):
        pf = F.col(f"pf{i}")
        score = score + F.when(pf > 0, sum((idf[t] for t in c), F.lit(0.0)) * pf * (k1 + 1)
                               / (pf + k1 * (1 - b + b * F.col("dl") / avgdl))).otherwise(F.lit(0.0))
        hit = hit + (pf > 0).cast("int")
    return per_doc.where(hit > 0).select("doc_id", hit.alias("n_clauses_matched"), score.alias("score"))


def top_k(scored: DataFrame, k: int, score_col: str = "score", id_col: str = "doc_id") -> DataFrame:
    """Best ``k`` by score (ties by id): a per-partition top-k merged once (TakeOrderedAndProject)."""
    return scored.orderBy(F.desc(F.round(score_col, 9)), F.asc(id_col)).limit(k)


def subset_by_hits(records: DataFrame, hits: DataFrame, key: str) -> DataFrame:
    """Thematic subset: records whose key is among the hits (semi join; the hit list stays in Spark)."""
    return records.join(hits.select(key), key, "left_semi")
