"""Merkle fingerprints of documents over paragraphs and sections, in DataFrame functions.

Levels. A paragraph is a line. Its pieces are clauses: runs of up to 48 code points closed by punctuation,
so a change within a line touches few of them. A section is a run of paragraphs that ends behind
a paragraph whose digest starts with ``0`` or ``8`` (one in eight), so an insertion moves no later border. Digests:
paragraph = SHA-256 of its text, section = SHA-256 of its paragraphs' digests, root = SHA-256 of its
sections' digests.

A fingerprint is the tree as text: ``root|section section ...``, a section being ``digest:paragraph;paragraph``
and a paragraph ``digest,piece,piece``, digests cut to 32 (root), 12 (section), 10 (paragraph) and 6 (piece)
hex digits. Equal roots mean equal texts; where roots differ, ``differing_paragraphs`` descends only into
differing sections, and ``add_likeness`` compares the pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A clause of at most 48 code points with the punctuation behind it, or punctuation alone.
PIECE = r"[^.,;:!?]{1,48}[.,;:!?]{0,8}|[.,;:!?]{1,8}"
#: Documents a task looks at together for their order; a bucket is a range of ids about this full.
BUCKET_ROWS = 512


def add_fingerprint(df: DataFrame, text: Column, name: str) -> DataFrame:
    """Adds the fingerprint of a text as column ``name``; null counts as the empty text (one empty paragraph)."""
    def paragraph(p: Column) -> Column:
        pieces = F.transform(F.regexp_extract_all(p, F.lit(PIECE), F.lit(0)),
                             lambda x: F.substring(F.md5(x.cast("binary")), 1, 6))
        return F.concat(F.sha2(p, 256), F.lit(","), F.array_join(pieces, ","))

    def close(node: Column) -> Column:
        return F.concat(node, F.when(F.substring(node, 1, 1).isin("0", "8"), " ").otherwise(";"))

    def section(s: Column) -> Column:
        digest = F.sha2(F.regexp_replace(s, ",[0-9a-f,]*", ""), 256)
        return F.concat(digest, F.lit(":"), F.regexp_replace(s, "([0-9a-f]{10})[0-9a-f]{54}", "$1"))

    def tail(col: Column, start: int) -> Column:
        return col.substr(F.lit(start), F.length(col))

    nodes = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), paragraph)
    # one string of all paragraphs, a blank behind the last one of each section; steps of their own, so that
    # each is computed once
    steps = df.withColumn("_all", F.array_join(F.transform(nodes, close), ""))
    steps = steps.withColumn("_all", F.split(F.col("_all").substr(F.lit(1), F.length("_all") - 1), " "))
    steps = steps.withColumn("_all", F.transform("_all", section))
    root = F.sha2(F.array_join(F.transform("_all", lambda t: F.substring(t, 1, 64)), ""), 256)
    body = F.array_join(F.transform("_all", lambda t: F.concat(F.substring(t, 1, 12), tail(t, 65))), " ")
    return steps.withColumn(name, F.concat(F.substring(root, 1, 32), F.lit("|"), body)).drop("_all")


def add_likeness(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Adds the share of distinct pieces that the fingerprints ``a`` and ``b`` have in common (twice the common
    ones over the sum), 0 to 1; 1 for equal roots, so also for two empty texts."""
    def pieces(fp: str) -> Column:
        return F.array_distinct(F.regexp_extract_all(fp, F.lit(",([0-9a-f]{6})"), F.lit(1)))

    both = F.size(F.array_intersect("_pa", "_pb"))
    like = (F.when(F.substring(a, 1, 32) == F.substring(b, 1, 32), F.lit(1.0))
             .otherwise(2.0 * both / F.greatest(F.size("_pa") + F.size("_pb"), F.lit(1))))
    return df.withColumns({"_pa": pieces(a), "_pb": pieces(b)}).withColumn(name, like).drop("_pa", "_pb")


def differing_paragraphs(a: Column, b: Column) -> Column:
    """Digests of the paragraphs of ``a`` below sections that ``b`` does not have, and not in ``b`` themselves:
    where the texts differ, found from the root downwards."""
    def trees(fp: Column) -> Column:
        return F.split(F.substring_index(fp, "|", -1), " ")

    changed = F.array_except(trees(a), trees(b))
    paragraphs = F.flatten(F.transform(changed, lambda s: F.split(F.substring_index(s, ":", -1), ";")))
    other = F.flatten(F.transform(trees(b), lambda s: F.split(F.substring_index(s, ":", -1), ";")))
    return F.transform(F.array_except(paragraphs, other), lambda p: F.substring(p, 1, 10))


def with_next(df: DataFrame, id_col: str, columns: list[str], bucket_rows: int = BUCKET_ROWS,
              derive: Callable[[DataFrame], DataFrame] = lambda d: d, derived: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``next_<c>`` for each column: its value in the row that follows in descending order of the id,
    for the last row that of the first. ``derive`` adds the ``derived`` columns, which are followed as well.

    Rows are grouped by ranges of ids (equally wide, about ``bucket_rows`` rows if ids are dense), each ordered in
    its own group: one shuffle and no single task for all rows. Only each group's first row goes to the
    group before it: tasks hand on the first rows they hold, and the groups' order comes from a table of one
    number a group. Null ids come last; rows that share an id are ordered by their columns.
    """
    ident, followed = F.col(id_col), [*columns, *derived]
    stats = df.agg(F.min(ident).alias("lo"), F.max(ident).alias("hi"), F.count(F.lit(1)).alias("n")).first()
    lo, hi, n = stats["lo"], stats["hi"], stats["n"]
    width = 1 if lo is None else max(1, (hi - lo + 1) * bucket_rows // max(n, 1))
    base = 0 if lo is None else lo
    bucket = F.coalesce(F.floor((ident - F.lit(base)) / F.lit(width)), F.lit(-1)).cast("long")
    tagged = df.withColumn("_bucket", bucket)
    order = Window.partitionBy("_bucket").orderBy(ident.desc_nulls_last(), *columns)
    here = derive(tagged).select("*", F.row_number().over(order).alias("_rank"), F.count(F.lit(1)).over(
        Window.partitionBy("_bucket")).alias("_size"), *[F.lead(c).over(order).alias(f"_lead_{c}") for c in followed])
    first = derive(tagged.withColumn("_r", F.row_number().over(order)).where("_r = 1")).select(
        F.col("_bucket").alias("_next"), F.struct(*followed).alias("_ahead"))
    # the group whose first row follows a group's last: the next lower one that has rows, for the lowest the highest
    groups = df.select(bucket.alias("_bucket")).distinct()
    down = Window.orderBy(F.col("_bucket").desc())
    every = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = groups.select(F.col("_bucket").alias("_b"), F.coalesce(F.lead("_bucket").over(down), F.max("_bucket").over(every)
                                                                   ).alias("_next"))
    joined = here.join(heads.join(first, "_next").select("_b", "_ahead"), F.col("_bucket") == F.col("_b"), "left")
    at_end = F.col("_rank") == F.col("_size")
    return joined.select(*df.columns, *derived, *[F.when(at_end, F.col(f"_ahead.{c}")).otherwise(F.col(f"_lead_{c}"))
                                                  .alias(f"next_{c}") for c in followed])


def edited_text(text: Column, following: Column) -> Column:
    """A text whose last floor(n/3) code points give way to the first as many of another."""
    n = F.length(text)
    cut = F.floor(n / 3).cast("int")
    return F.concat(text.substr(F.lit(1), n - cut), following.substr(F.lit(1), cut))


def document_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses; see ``edited_text``.

    (id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next). Null
    texts count as empty. A table of one row follows itself; an empty table gives no rows. Rows may repeat;
    other columns are not read.
    """
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_next(docs, "id", ["text"], derive=lambda d: add_fingerprint(d, F.col("text"), "fingerprint"),
                     derived=("fingerprint",))
    rows = rows.withColumn("edited", edited_text(F.col("text"), F.col("next_text")))
    rows = rows.select("id", F.length("text").cast("long").alias("n_chars"), "edited", "fingerprint", "next_fingerprint",
                       F.sha2("edited", 256).alias("edited_sha256"))
    rows = add_fingerprint(rows, F.col("edited"), "edited_fingerprint").drop("edited")
    rows = add_likeness(rows, "fingerprint", "edited_fingerprint", "near_edited")
    rows = add_likeness(rows, "fingerprint", "next_fingerprint", "near_next")
    return rows.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       "near_edited", "near_next")


def _sql_fingerprint(text: str) -> str:
    """The fingerprint of a text as DuckDB SQL."""
    pieces = f"list_transform(regexp_extract_all(p, '{PIECE}'), lambda x: substr(md5(x), 1, 6))"
    nodes = f"list_transform(string_split({text}, chr(10)), lambda p: sha256(p) || ',' || array_to_string({pieces}, ','))"
    closed = f"array_to_string(list_transform({nodes}, lambda n: n || CASE WHEN n[1] IN ('0', '8') THEN ' ' ELSE ';' END), '')"
    sections = f"string_split({closed}[:-2], ' ')"
    trees = (f"list_transform({sections}, lambda s: sha256(regexp_replace(s, ',[0-9a-f,]*', '', 'g')) || ':' || "
             "regexp_replace(s, '([0-9a-f]{10})[0-9a-f]{54}', '\\1', 'g'))")
    return (f"list_transform([{trees}], lambda ts: "
            "substr(sha256(array_to_string(list_transform(ts, lambda t: t[1:64]), '')), 1, 32) || '|' || "
            "array_to_string(list_transform(ts, lambda t: t[1:12] || t[65:]), ' '))[1]")


def _sql_likeness(a: str, b: str) -> str:
    def pieces(fp: str) -> str:
        return f"list_distinct(regexp_extract_all({fp}, ',([0-9a-f]{{6}})', 1))"

    return (f"CASE WHEN substr({a}, 1, 32) = substr({b}, 1, 32) THEN 1.0::DOUBLE ELSE "
            f"2.0::DOUBLE * len(list_intersect({pieces(a)}, {pieces(b)})) / "
            f"greatest(len({pieces(a)}) + len({pieces(b)}), 1) END")


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
e AS (SELECT doc_id, text, length(text) AS n, coalesce(lead(text) OVER down, first_value(text) OVER down) AS following
      FROM d WINDOW down AS (ORDER BY doc_id DESC)),
f AS (SELECT doc_id, n, text, following, text[1:n - n // 3] || following[1:n // 3] AS edited FROM e),
g AS (SELECT doc_id, n, sha256(edited) AS edited_sha256, {_sql_fingerprint('text')} AS fingerprint,
             {_sql_fingerprint('edited')} AS edited_fingerprint FROM f),
h AS (SELECT *, coalesce(lead(fingerprint) OVER down, first_value(fingerprint) OVER down) AS following
      FROM g WINDOW down AS (ORDER BY doc_id DESC))
SELECT doc_id, n AS n_chars, edited_sha256, fingerprint, edited_fingerprint,
       {_sql_likeness('fingerprint', 'edited_fingerprint')} AS near_edited,
       {_sql_likeness('fingerprint', 'following')} AS near_next FROM h
"""
