"""Toxicity by multiple-instance learning: a document is a bag of sentences, labels belong to documents.

A sentence's probability is logistic in its words and word beginnings; a document's is the noisy-or of its
sentences, 1 - prod(1 - p). Weights are trained on document labels by gradient steps on the likelihood: every step
is a Spark job in which each task sums the gradient of its documents; the driver holds the weights (at most
``features`` numbers). After training, sentence scores say where a document offends.

Two bounds, both parameters: at most ``train_rows`` labelled documents (those of lowest hash) are learned from, and
at most ``features`` features, those most unevenly spread over the labels in them. Scoring reads every text whole.
"""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scholarspark.llm.common import gives_back
from scholarspark.session import reliable_checkpoint

cloudpickle.register_pickle_by_value(sys.modules[__name__])

TRAIN_ROWS = 24_000
FEATURES = 4_000
#: A feature must occur in this many training documents.
LEAST_DOCS = 5
STEPS = 25
#: Beginnings of words that are features besides the words themselves.
HEADS = (4, 5, 6)
ROWS = 512
WORD_CACHE = 200_000

_SENTENCE = re.compile(r"[.!?\n]+")
_WORD = re.compile(r"[^\W_]+")


def word_features(word: str) -> list[str]:
    """A word and its beginnings (marked by a hyphen, which no word holds)."""
    return [word, *(word[:n] + "-" for n in HEADS if len(word) >= n)]


def sentences(text: str) -> list[tuple[int, int]]:
    """Spans of the sentences that hold a word; a text without one has none."""
    out, at = [], 0
    for m in _SENTENCE.finditer(text):
        if _WORD.search(text, at, m.start()):
            out.append((at, m.end()))
        at = m.end()
    if _WORD.search(text, at):
        out.append((at, len(text)))
    return out


def sample_labelled(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, train_rows: int) -> DataFrame:
    """(text, y) of the labelled documents to learn from: the ``train_rows`` of lowest hash of their id. Their ids
    are bounded, so they are broadcast and no text is shuffled. An id labelled both ways counts as positive; rows that
    repeat an id are all learned from; other columns, whatever their names, are not read."""
    labels = labels.select(id_col, label_col)
    chosen = (labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
                    .groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).cast("int").alias("y"))
                    .orderBy(F.xxhash64("_id"), "_id").limit(train_rows))
    texts = docs.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(chosen), F.col("_doc") == F.col("_id")).select("text", "y")


def document_counts(train: DataFrame) -> DataFrame:
    """(feature, y, n): training documents of each label that hold a feature."""
    @gives_back
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for text, y in zip(batch["text"], batch["y"]):
                words = set(_WORD.findall((text or "").lower()))
                seen.update((f, y) for f in {f for w in words for f in word_features(w)})
        for at in range(0, len(keys := list(seen)), 50_000):
            part = keys[at:at + 50_000]
            yield pd.DataFrame({"feature": [k[0] for k in part], "y": [k[1] for k in part], "n": [seen[k] for k in part]})

    return (train.mapInPandas(run, "feature string, y int, n bigint")
                 .groupBy("feature", "y").agg(F.sum("n").alias("n")))


def choose_features(train: DataFrame, features: int) -> tuple[list[str], np.ndarray, float]:
    """The features whose documents differ most in labels (signed likelihood ratio), their log-odds, and the share
    of positive documents."""
    totals = {r["y"]: r["count"] for r in train.groupBy("y").count().collect()}
    pos, neg = totals.get(1, 0), totals.get(0, 0)
    if not pos or not neg:
        return [], np.zeros(0), 0.0 if not pos else 1.0
    per = (document_counts(train).groupBy("feature")
           .agg(F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("a"),
                F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("b"))
           .where(F.col("a") + F.col("b") >= LEAST_DOCS))
    odds = F.log(((F.col("a") + 0.5) / (pos + 1.0)) / ((F.col("b") + 0.5) / (neg + 1.0)))
    share = F.lit(pos / (pos + neg))
    n = F.col("a") + F.col("b")

    def part(count: Column, expected: Column) -> Column:
        return F.when(count > 0, count * F.log(count / expected)).otherwise(0.0)

    gain = part(F.col("a"), n * share) + part(F.col("b"), n * (1 - share))
    rows = per.select("feature", odds.alias("w"), gain.alias("g")).where("g > 5").orderBy(
        F.col("g").desc(), "feature").limit(features).collect()
    return [r["feature"] for r in rows], np.array([r["w"] for r in rows]), pos / (pos + neg)


def bags(train: DataFrame, names: list[str]) -> DataFrame:
    """A training document as (y, sentences, sizes, ids): sentences in all, and for those that hold features the
    number of them and their indices."""
    @gives_back
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = {f: i for i, f in enumerate(names)}
        for batch in batches:
            rows = []
            for text, y in zip(batch["text"], batch["y"]):
                spans, sizes, ids = sentences(text or ""), [], []
                for a, b in spans:
                    words = set(_WORD.findall(text[a:b].lower()))
                    found = sorted({index[f] for w in words for f in word_features(w) if f in index})
                    if found:
                        sizes.append(len(found))
                        ids.extend(found)
                rows.append((y, len(spans), sizes, ids))
            yield pd.DataFrame(rows, columns=["y", "sentences", "sizes", "ids"])

    return train.mapInPandas(run, "y int, sentences int, sizes array<int>, ids array<int>")


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, z)


def gradient(bag: DataFrame, w: np.ndarray, bias: float) -> tuple[np.ndarray, float, float]:
    """Gradient of the negative log-likelihood, of its bias, and the likelihood; one row from each task."""
    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g, gb, loss = np.zeros(len(w)), 0.0, 0.0
        for batch in batches:
            y = batch.column(0).to_numpy()
            empty = batch.column(1).to_numpy().astype(float)
            sizes, per_doc = batch.column(2), np.diff(batch.column(2).offsets.to_numpy())
            counts = sizes.flatten().to_numpy(zero_copy_only=False)
            ids = batch.column(3).flatten().to_numpy(zero_copy_only=False)
            empty = empty - per_doc
            doc = np.repeat(np.arange(len(y)), per_doc)
            sentence = np.repeat(np.arange(len(counts)), counts)
            z = bias + np.bincount(sentence, w[ids], minlength=len(counts))
            p, p0 = 1 / (1 + np.exp(-z)), 1 / (1 + math.exp(-bias))
            mass = np.bincount(doc, _softplus(z), minlength=len(y)) + empty * _softplus(np.array(bias))
            mass = np.maximum(mass, 1e-12)                      # -log(1 - P) of a document
            pos = -np.expm1(-mass)
            loss += float(np.sum(np.where(y == 1, -np.log(pos), mass)))
            scale = np.where(y == 1, -np.exp(-mass) / pos, 1.0)  # d loss / d mass
            gz = scale[doc] * p
            g += np.bincount(ids, gz[sentence], minlength=len(w))
            gb += float(gz.sum() + np.sum(scale * empty) * p0)
        yield pa.RecordBatch.from_arrays([pa.array([g.tolist()], pa.list_(pa.float64())), pa.array([gb]), pa.array([loss])],
                                         ["g", "gb", "loss"])

    rows = bag.mapInArrow(run, "g array<double>, gb double, loss double").collect()
    return (np.sum([r["g"] for r in rows], axis=0) if rows else np.zeros(len(w)),
            sum(r["gb"] for r in rows), sum(r["loss"] for r in rows))


def train_model(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                train_rows: int = TRAIN_ROWS, features: int = FEATURES, steps: int = STEPS,
                penalty: float = 1.0) -> tuple[dict[str, float], float]:
    """(weights by feature, bias). ``labels`` has the id and the label (0, 1 or null: not labelled). Without documents of both labels the weights are
    empty and every sentence has the bias of the one label seen (none: of 0)."""
    train = reliable_checkpoint(sample_labelled(docs, labels, id_col, text_col, label_col, train_rows), "mil-train")
    names, w, share = choose_features(train, features)
    if not len(names):
        return {}, -12.0 if share < 0.5 else 2.0
    bag = reliable_checkpoint(bags(train, names).coalesce(8), "mil-bags")
    # Rprop-like steps: signs and step sizes of each weight; starts at small weights in the direction of the odds
    w, bias = 0.5 * w, -7.0
    size, before = np.full(len(w) + 1, 0.4), np.zeros(len(w) + 1)
    n = bag.count()
    for _ in range(steps):
        g, gb, _ = gradient(bag, w, bias)
        g = np.append(g + penalty * w, gb) / n
        size = np.clip(np.where(g * before > 0, size * 1.2, np.where(g * before < 0, size * 0.5, size)), 1e-4, 1.5)
        g = np.where(g * before < 0, 0.0, g)
        move = np.sign(g) * size
        w, bias, before = w - move[:-1], bias - move[-1], g
    return {f: float(x) for f, x in zip(names, w) if abs(x) > 0.02}, float(bias)


def score_documents(df: DataFrame, weights: dict[str, float], bias: float, text_col: str = "text",
                    offending: float = 0.5, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of ``df`` (all by default) with ``score``, the noisy-or of the text's sentences, and ``offending``, the spans
    of the sentences that alone reach that probability. One pass, no shuffle. A text without words (or null) has no
    sentence and scores 0; columns named like those added are replaced."""
    df = df.drop("score", "offending")
    columns = list(df.columns) if columns is None else columns
    at_text = columns.index(text_col) if text_col in columns else len(columns)      # the text is sent once
    model = df.sparkSession.sparkContext.broadcast(weights)       # at most ``features`` entries
    base_p = 1 / (1 + math.exp(-bias))

    class Words(dict):
        def __missing__(self, word: str) -> float:
            get = model.value.get
            x = sum(get(f, 0.0) for f in word_features(word))
            if len(self) < WORD_CACHE:
                self[word] = x
            return x

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                scores, found = [], []
                for text in part.column(at_text).to_pylist():
                    n, log_rest, bad = 0, 0.0, []
                    start = 0
                    for piece in _SENTENCE.split(text) if text else ():
                        end = start + len(piece)
                        tokens = _WORD.findall(piece.lower())
                        if tokens:
                            z = sum([words[t] for t in set(tokens)])
                            if z:
                                p = 1 / (1 + math.exp(-max(-60.0, min(60.0, z + bias))))
                                log_rest += math.log1p(-min(p, 1 - 1e-12))
                                if p >= offending:
                                    bad.append({"start": start, "end": end, "p": p})
                            else:
                                n += 1
                        start = end
                        while start < len(text) and text[start] in ".!?\n":
                            start += 1
                    scores.append(-math.expm1(log_rest + n * math.log1p(-base_p)))
                    found.append(bad)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:len(columns)], pa.array(scores, pa.float64()), pa.array(found, spans_type)],
                    [*columns, "score", "offending"])

    fields = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)
    return df.select(*dict.fromkeys([*columns, text_col])).mapInArrow(
        run, f"{fields}, score double, offending array<struct<start:int,end:int,p:double>>")
