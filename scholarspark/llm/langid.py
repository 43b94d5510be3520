"""Language identification by rank-order profiles.

The letters of a text, lower-cased, give n-grams of 1 to 3 letters (word ends count as a letter). A language's
profile is the order of its most frequent n-grams; a document's own order is compared with each profile by the
out-of-place distance: the sum over the document's n-grams of how far each stands from its place in the profile,
the profile's length where it is missing. The nearest language wins (ties: the first by name).

Profiles are learned from at most ``per_language`` documents of each language, those of lowest hash; every text
is counted and compared whole.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scholarspark.llm.common import worker_state

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PER_LANGUAGE = 4_000
#: Length of a language's profile and of a document's.
PROFILE, DOCUMENT = 600, 400
#: Longer texts are counted block by block, cut at a blank if there is one.
BLOCK = 1 << 20
ROWS = 512
UNKNOWN = "und"


def _letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def _block_grams(text: str, letter: np.ndarray) -> np.ndarray:
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    c = np.where(letter[c], c, 32)
    c = np.concatenate([[32], c, [32]])
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
    c = c[keep]
    two = (c[:-1] << 21) | c[1:]
    three = ((two[:-1] << 21) | c[2:])[c[1:-1] != 32]
    return np.concatenate([c[c != 32], two | (1 << 42), three])


def gram_counts(text: str, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a text as numbers, ascending, and how often each occurs; empty without a letter."""
    blocks, at = [], 0
    while at < len(text):
        end = min(len(text), at + BLOCK)
        if end < len(text):
            blank = text.rfind(" ", at + BLOCK // 2, end)
            end = blank if blank > at else end
        grams = np.sort(_block_grams(text[at:end], letter))
        if len(grams) > 1:                                     # a text without letters leaves one blank pair
            first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
            blocks.append((grams[first], np.diff(np.append(first, len(grams)))))
        at = end
    if not blocks:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(blocks) == 1:
        return blocks[0]
    ids, back = np.unique(np.concatenate([b[0] for b in blocks]), return_inverse=True)
    return ids, np.bincount(back, np.concatenate([b[1] for b in blocks])).astype(np.int64)


def top(ids: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """The k most frequent n-grams in order; ties by the n-gram's number. ``ids`` ascend."""
    key = np.sort((counts << 32) + (len(ids) - 1 - np.arange(len(ids))))[::-1][:k]
    return ids[len(ids) - 1 - (key & 0xFFFFFFFF)]


class Profiles:
    """Ranks of all profiled n-grams in each language."""

    def __init__(self, profiles: dict[str, list[int]]):
        self.langs = sorted(profiles)
        self.ids = np.unique(np.concatenate([np.zeros(0, np.int64), *(np.array(profiles[x], np.int64) for x in self.langs)]))
        self.rank = np.full((len(self.ids), len(self.langs)), -1, np.int64)
        for j, lang in enumerate(self.langs):
            self.rank[np.searchsorted(self.ids, np.array(profiles[lang], np.int64)), j] = np.arange(len(profiles[lang]))

    def nearest(self, own: np.ndarray) -> tuple[str, float]:
        """Nearest language of a document's ordered n-grams, and how much nearer than the second (0 to 1)."""
        if not len(own) or not self.langs:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.ids, own), max(len(self.ids) - 1, 0))
        known = self.ids[at] == own
        rank = np.where(known[:, None], self.rank[at], -1)
        out = np.where(rank >= 0, np.abs(rank - np.arange(len(own))[:, None]), PROFILE).sum(axis=0)
        order = np.argsort(out, kind="stable")
        if len(order) == 1:
            return self.langs[0], 1.0 - float(out[0]) / (PROFILE * len(own))
        best, second = float(out[order[0]]), float(out[order[1]])
        return self.langs[order[0]], (second - best) / second if second > 0 else 0.0


def learn_profiles(docs: DataFrame, learn_from: DataFrame, per_language: int = PER_LANGUAGE) -> dict[str, list[int]]:
    """Profile of each language. ``docs`` has (id, text), ``learn_from`` (id, lang), lang not null."""
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = (learn_from.where("lang IS NOT NULL AND id IS NOT NULL").withColumn("r", F.row_number().over(order))
                        .where(F.col("r") <= per_language).select(F.col("id").alias("_id"), "lang"))
    text = docs.join(F.broadcast(chosen), F.col("id") == F.col("_id")).select("lang", "text")  # bounded ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter = worker_state(("letters",), _letters)
        sums: dict[str, list] = {}

        def fold(lang: str) -> None:
            ids, back = np.unique(np.concatenate([x[0] for x in sums[lang]]), return_inverse=True)
            sums[lang] = [(ids, np.bincount(back, np.concatenate([x[1] for x in sums[lang]])).astype(np.int64))]

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if text:
                    sums.setdefault(lang, []).append(gram_counts(text, letter))
                    if len(sums[lang]) >= 256:
                        fold(lang)
        for lang in sums:
            fold(lang)
            ids, counts = sums[lang][0]
            for at in range(0, len(ids), 50_000):
                part = slice(at, at + 50_000)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(ids[part])), pa.array(ids[part]), pa.array(counts[part])],
                                                 ["lang", "gram", "n"])

    counts = text.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    rows = counts.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= PROFILE).collect()
    out: dict[str, list[int]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["r"])):
        out.setdefault(r["lang"], []).append(r["gram"])
    return out


def identify(docs: DataFrame, profiles: dict[str, list[int]], id_col: str = "doc_id") -> DataFrame:
    """(id, lang_pred, score), a row for each row of ``docs`` (id, text); no shuffle. Null texts and texts without
    a letter are ``und`` with score 0, and so is everything if no profile was learned."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter = worker_state(("letters",), _letters)
        model = Profiles(profiles)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found = [model.nearest(top(*gram_counts(t or "", letter), DOCUMENT)) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                    [id_col, "lang_pred", "score"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")
