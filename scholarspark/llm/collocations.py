"""Phrase collocations by language: counted level by level over tries of what is frequent, scored by their weakest cut.

Level 1 counts words. Texts are then written once more as word codes (0 where no phrase can go on: the end of a piece, or a
word that is too rare), and each further level is one pass over these codes. A broadcast double-array trie holds the
frequent phrases so far; all text positions advance through it together, a word at a time, in numpy. A phrase is an
Apriori-safe candidate if the phrase without its last word and the one without its first are both frequent; the last
transition is not enumerated beforehand, so candidates are (state, next word) pairs, counted in each task and summed over
tasks. The phrases that reach ``least`` go into the trie of the next level.

What is broadcast is bounded by parameters: ``vocabulary`` words of at most ``WORD_BYTES`` bytes and ``nodes`` phrases,
the most frequent ones. Where more are frequent, the phrases that leave the vocabulary or the trie are counted as
strings by an aggregation, so counts are exact at every size.

Words are what stands between blanks and tabs, pieces end at ``.,;:!?`` and U+000A..U+000D, A-Z are lower-cased. Null texts
count as empty, a null language as ``und``; repeated rows count each time; ids and other columns are not read.
"""

from __future__ import annotations

import sys
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholarspark.llm.double_array import DoubleArray
from scholarspark.session import reliable_checkpoint

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST, LONGEST, TOP = 10, 3, 2_000
#: A longer phrase explains its part from this share of the part's count on.
EXPLAINS = 50
VOCABULARY = 1_000_000
WORD_BYTES = 64
NODES = 1_000_000
#: Entries a task counts before it hands them on, and positions looked at together.
HELD, POSITIONS = 250_000, 500_000

_END = b"."
_PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ,;:!?\n\x0b\x0c\r", b"abcdefghijklmnopqrstuvwxyz" + _END * 9)


def words_of(text: str | None) -> list[bytes]:
    """Lower-cased words in UTF-8, with ``_END`` where a piece ends."""
    return text.encode("utf-8").translate(_PLAIN).replace(_END, b" . ").split() if text else []


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def _flush(counts: dict[str, Counter]) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, n) of what was counted; empties the counters."""
    for lang, seen in counts.items():
        keys = list(seen)
        for at in range(0, len(keys), 50_000):
            part = keys[at:at + 50_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(part), pa.string()), _strings(part), pa.array([seen[k] for k in part], pa.int64())],
                ["lang", "phrase", "n"])
    counts.clear()


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, phrase, n): every word of each language. ``docs`` has lang and text, in this order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                if words:
                    counts[lang].update(words)
            for seen in counts.values():
                seen.pop(_END, None)
            if sum(map(len, counts.values())) > HELD:
                yield from _flush(counts)
        yield from _flush(counts)

    return docs.mapInArrow(run, "lang string, phrase string, n bigint").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


@dataclass
class Names:
    """The words that have a code (1 for the first), and their languages."""
    words: list[bytes]
    lang_of: np.ndarray
    langs: list[str]

    def __len__(self) -> int:
        return len(self.words)

    def tables(self) -> dict[str, dict[bytes, int]]:
        """Word to code, by language."""
        out: dict[str, dict[bytes, int]] = defaultdict(lambda: {_END: 0})
        for code, (lang, word) in enumerate(zip(self.lang_of.tolist(), self.words), 1):
            out[self.langs[lang]][word] = code
        return out


def encode(docs: DataFrame, names: Names, complete: bool) -> DataFrame:
    """(lang, codes, others): each text as word codes with 0 where a phrase ends. Words
    without a code end a phrase if the vocabulary is complete, else they are -1 and listed in ``others``."""
    shared = docs.sparkSession.sparkContext.broadcast(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = shared.value.tables()
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                rows, out, others = batch.slice(first, 256), [], []
                for lang, text in zip(rows.column(0).to_pylist(), rows.column(1)):
                    words = words_of(text.as_py())
                    own = np.fromiter(map(codes[lang].get, words, repeat(0 if complete else -1)), np.int32, len(words))
                    out.append(np.append(own, np.int32(0)))
                    others.append([] if complete else [words[i].decode("utf-8") for i in np.flatnonzero(own < 0)])
                ends = np.cumsum([0, *map(len, out)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(out))),
                     pa.array(others, pa.list_(pa.string()))], ["lang", "codes", "others"])

    return docs.mapInArrow(run, "lang string, codes array<int>, others array<string>")


def _states(trie: DoubleArray, codes: np.ndarray, length: int) -> np.ndarray:
    """The state of the phrase of ``length`` words that begins at each position, 0 where that is not in the trie."""
    states = np.where(codes > 0, codes, 0)
    for k in range(1, length):
        states = trie.step(states, np.append(codes[k:], np.zeros(k, np.int32)))
    return states


def _safe(trie: DoubleArray, codes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """First positions of the safe candidates of so many words, and the states of all positions without the last word."""
    states = _states(trie, codes, words - 1)
    return np.flatnonzero((states[:-1] > 0) & (states[1:] > 0)), states


def count_level(coded: DataFrame, trie: DoubleArray, words: int, least: int) -> DataFrame:
    """(head, last, n): safe candidates of so many words by the state of all but the last word, and the last one's code."""
    shared = coded.sparkSession.sparkContext.broadcast(trie)

    def counted(waiting: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        codes = np.concatenate(waiting)                           # every text ends with 0
        at, states = _safe(shared.value, codes, words)
        keys, n = np.unique(states[at].astype(np.int64) << 32 | codes[at + words - 1], return_counts=True)
        for at in range(0, len(keys), 100_000):
            part = keys[at:at + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array((part >> 32).astype(np.int32)), pa.array((part & 0xFFFFFFFF).astype(np.int32)),
                                              pa.array(n[at:at + 100_000])], ["head", "last", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                waiting.append(batch.column(0).slice(first, 512).flatten().to_numpy(zero_copy_only=False))
                size += len(waiting[-1])
                if size >= POSITIONS:
                    yield from counted(waiting)
                    waiting, size = [], 0
        if waiting:
            yield from counted(waiting)

    return (coded.select("codes").mapInArrow(run, "head int, last int, n bigint").groupBy("head", "last")
                 .agg(F.sum("n").alias("n")).where(F.col("n") >= least))


def count_rest(coded: DataFrame, trie: DoubleArray, names: Names, words: int, least: int, all_words: bool) -> DataFrame:
    """(lang, phrase, n): phrases of so many words that the vocabulary or the trie cannot judge, counted as strings.
    ``all_words``: the vocabulary is complete, so only the trie's limits matter."""
    shared = coded.sparkSession.sparkContext.broadcast((trie, names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, listed = shared.value
        counts: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, codes, others in zip(*(batch.column(i) for i in range(3))):
                codes = codes.values.to_numpy(zero_copy_only=False).astype(np.int32)
                safe, _ = _safe(known, codes, words)
                open_ = np.ones(max(0, len(codes) - words + 1), bool)
                for k in range(words):
                    open_ &= codes[k:k + len(open_)] != 0
                open_[safe] = False
                at = np.flatnonzero(open_)
                if not len(at):
                    continue
                own, rest = others.as_py(), np.cumsum(codes < 0) - 1
                text = [own[rest[i]].encode("utf-8") if c < 0 else listed.words[c - 1] if c else b"" for i, c in enumerate(codes.tolist())]
                counts[lang.as_py()].update(b" ".join(text[i:i + words]) for i in at.tolist())
            if sum(map(len, counts.values())) > HELD:
                yield from _flush(counts)
        yield from _flush(counts)

    return (coded.mapInArrow(run, "lang string, phrase string, n bigint").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
                 .where(F.col("n") >= least))


def spell(level: DataFrame, nodes: list[tuple[np.ndarray, ...]], names: Names) -> DataFrame:
    """(lang, phrase, n) of (head, last, n). ``nodes`` has for each length from two on the states, ascending, and of each the
    state without its last word and that word."""
    shared = level.sparkSession.sparkContext.broadcast((nodes, names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, listed = shared.value
        for batch in batches:
            heads, last = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            columns = [last]
            for states, before, codes in known[::-1]:             # from the last word to the first
                at = np.searchsorted(states, heads)
                columns.append(codes[at])
                heads = before[at]
            columns.append(heads)
            phrases = [b" ".join([listed.words[c - 1] for c in row[::-1]]) for row in zip(*(c.tolist() for c in columns))]
            langs = [listed.langs[i] for i in listed.lang_of[last - 1].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), _strings(phrases), batch.column(2)], ["lang", "phrase", "n"])

    return level.select("head", "last", "n").mapInArrow(run, "lang string, phrase string, n bigint")


def frequent_phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, vocabulary: int = VOCABULARY,
                     nodes: int = NODES) -> tuple[DataFrame, DataFrame]:
    """(lang, words, phrase, n) of all phrases of up to ``longest`` words that occur ``least`` times, and (lang, n): words in all."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    counted = reliable_checkpoint(count_words(texts), "colloc-words")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = counted.where(F.col("n") >= least)
    listed = (frequent.where(F.octet_length("phrase") <= WORD_BYTES).orderBy(F.desc("n"), "lang", "phrase").limit(vocabulary)
              .select("lang", F.col("phrase").cast("binary").alias("word")).toArrow())
    langs = listed.column(0).combine_chunks().dictionary_encode()
    names = Names(listed.column(1).to_pylist(), langs.indices.to_numpy(), langs.dictionary.to_pylist())
    all_words = frequent.count() == len(names)
    coded = reliable_checkpoint(encode(texts, names, all_words), "colloc-codes")
    trie, spelt_by, all_nodes = DoubleArray(len(names)), [], True
    levels = [frequent.select("lang", F.lit(1).alias("words"), "phrase", "n")]
    for words in range(2, longest + 1):
        level = reliable_checkpoint(count_level(coded, trie, words, least), "colloc-level")
        spelt = spell(level, spelt_by, names)
        if not (all_words and all_nodes):
            spelt = spelt.union(count_rest(coded, trie, names, words, least, all_words))
        levels.append(reliable_checkpoint(spelt.select("lang", F.lit(words).alias("words"), "phrase", "n"), "colloc-phrases"))
        if words < longest:
            kept = level.orderBy(F.desc("n"), "head", "last").limit(nodes).select("head", "last").toArrow()
            all_nodes = all_nodes and level.count() == len(kept)
            heads, lasts = kept.column(0).to_numpy(), kept.column(1).to_numpy()
            states = trie.add(heads, lasts)
            order = np.argsort(states)
            spelt_by.append((states[order], heads[order], lasts[order]))
    out = levels[0]
    for level in levels[1:]:
        out = out.union(level)
    return out, totals


def _part(first: Column, n: Column) -> Column:
    """``n`` words of the column ``phrase`` from word ``first`` on (1: the first)."""
    return F.array_join(F.slice(F.split("phrase", " "), first, n), " ")


def weakest_cuts(phrases: DataFrame, longest: int = LONGEST) -> DataFrame:
    """Candidates (two words or more) with l, r and score of the cut that scores least, floor(10^6 a a / (l r)), the first
    of equals. Decimals of 38 digits are exact up to counts of 10^16."""
    whole = phrases.where("words > 1").select("lang", "words", "phrase", F.col("n").alias("a"))
    cuts = whole.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.select("*", _part(F.lit(1), F.col("cut")).alias("left"), _part(F.col("cut") + 1, F.col("words") - F.col("cut")).alias("right"))
    parts = phrases.where(F.col("words") < longest)
    for side in ("left", "right"):
        cuts = cuts.join(parts.select(F.col("lang").alias("of"), F.col("phrase").alias("part"), F.col("n").alias(side[0])),
                         (F.col("lang") == F.col("of")) & (F.col(side) == F.col("part"))).drop("of", "part")
    score = F.expr("(cast(a AS decimal(19,0)) * cast(a AS decimal(19,0)) * 1000000) div (cast(l AS decimal(19,0)) * cast(r AS decimal(19,0)))")
    least = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("cut")
    return cuts.groupBy("lang", "words", "phrase", "a").agg(least).select("lang", "words", "phrase", "a", "cut.l", "cut.r", "cut.score")


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, longest: int = LONGEST, explains: int = EXPLAINS,
                 vocabulary: int = VOCABULARY, nodes: int = NODES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language by score, count and phrase, without
    those of which a longer candidate has ``explains`` percent of the occurrences or more."""
    phrases, totals = frequent_phrases(docs, least, longest, vocabulary, nodes)
    scored = weakest_cuts(phrases, longest)
    inner = phrases.where("words > 2").withColumn("k", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    inner = inner.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("k") + 1)))
    longer = inner.groupBy(F.col("lang").alias("of"), _part(F.col("at"), F.col("k")).alias("part")).agg(F.max("n").alias("most"))
    left = scored.join(longer, (F.col("lang") == F.col("of")) & (F.col("phrase") == F.col("part")), "left").where(
        F.col("most").isNull() | (100 * F.col("most") < explains * F.col("a")))
    best = [F.desc("score"), F.desc("a"), "phrase"]
    # first among some of a language's phrases, then among those: no task sees them all
    some = left.withColumn("place", F.row_number().over(Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(32))).orderBy(*best)))
    few = some.where(F.col("place") <= top).withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)))
    few = few.where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "score")
    return few.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))


ORACLE = """
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
split AS (SELECT lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda x: x <> '') AS w FROM pieces),
grams AS (
  SELECT lang, 1 AS k, unnest(w) AS phrase FROM split
  UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM split WHERE len(w) > 1
  UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
    FROM split WHERE len(w) > 2),
f AS (SELECT lang, k, phrase, count(*) AS c FROM grams GROUP BY lang, k, phrase),
totals AS (SELECT lang, sum(c)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, c AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND c >= 10),
cuts AS (SELECT lang, k, phrase, a, cut, array_to_string(w[1:cut], ' ') AS p, array_to_string(w[cut + 1:k], ' ') AS q
         FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand)),
scored AS (SELECT c.lang, c.phrase, c.a, c.cut, x.c AS l, y.c AS r,
                  (1000000::HUGEINT * c.a * c.a) // (x.c::HUGEINT * y.c) AS score
           FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.p JOIN f y ON y.lang = c.lang AND y.phrase = c.q),
least AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inside AS (SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM cand WHERE k = 3
           UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM cand WHERE k = 3),
longer AS (SELECT lang, phrase, max(a) AS most FROM inside GROUP BY lang, phrase),
ranked AS (
  SELECT t.lang, row_number() OVER (PARTITION BY t.lang ORDER BY t.score DESC, t.a DESC, t.phrase) AS rank,
         t.phrase, t.a, t.l, t.r, t.score
  FROM least t LEFT JOIN longer g ON g.lang = t.lang AND g.phrase = t.phrase
  WHERE g.most IS NULL OR 100 * g.most < 50 * t.a)
SELECT ranked.lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000
"""
