"""Token counts of whole texts without materialising ids.

A pre-token here is what stands between white space (the tokenizer drops white space, so no token
crosses it). Every distinct pre-token of the corpus is given to the tokenizer library once; per-document
pre-token frequencies are joined to these counts and summed. The most frequent pre-tokens (at most
``head``, a fixed bound) are looked up in the task that reads the text; only the rest is shuffled, as
(document, pre-token, frequency), so no hot pre-token meets in one task.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scholarspark.llm.common import worker_state
from scholarspark.session import reliable_checkpoint

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Most pre-tokens that are broadcast (about 15 bytes each on the wire, 150 in a worker).
HEAD = 250_000
#: Distinct pre-tokens a task gathers before it hands on partial counts.
GATHER = 300_000
ROWS = 256

_WHITE = regex.compile(r"\p{White_Space}+")


def pre_tokens(text: str) -> list[str]:
    """Pieces between white space. str.split also cuts at U+001C..U+001F, which are no white space here."""
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return [p for p in _WHITE.split(text) if p]
    return text.split()


def _texts(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            yield part, part.column(column).to_pylist()


def distinct_pre_tokens(df: DataFrame, text_col: str) -> DataFrame:
    """(piece, freq): every distinct pre-token of the corpus; counted in the tasks before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> Iterator[pa.RecordBatch]:
            rows = pa.table({"piece": pa.array(seen.keys(), pa.string()), "freq": pa.array(seen.values(), pa.int64())})
            yield from rows.to_batches(max_chunksize=20_000)

        for _, texts in _texts(batches, 0):
            for t in texts:
                if t:
                    seen.update(pre_tokens(t))
            if len(seen) > GATHER:
                yield from out()
                seen.clear()
        yield from out()

    return (df.select(F.col(text_col)).mapInArrow(run, "piece string, freq bigint")
              .groupBy("piece").agg(F.sum("freq").alias("freq")))


def count_pieces(pieces: DataFrame, tokenizer_path: str) -> DataFrame:
    """(piece, freq, n): tokens of each distinct pre-token, as the library gives them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        tok = worker_state(("tokenizer", tokenizer_path), lambda: Tokenizer.from_file(tokenizer_path))
        tok.no_truncation()
        tok.no_padding()
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                n = [len(e.ids) for e in tok.encode_batch_fast(part.column(0).to_pylist(), add_special_tokens=False)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(n, pa.int32())], ["piece", "freq", "n"])

    return pieces.mapInArrow(run, "piece string, freq bigint, n int")


def _head(counted: DataFrame, most: int) -> tuple[dict[str, int], int]:
    """The pieces of at least some frequency, a power of two chosen so that they are at most ``most``."""
    bins = counted.groupBy(F.floor(F.log2("freq")).cast("int").alias("p")).count().collect()    # 64 rows at most
    total, least = 0, None
    for p, n in sorted(((r["p"], r["count"]) for r in bins), reverse=True):
        total += n
        if total > most:
            break
        least = 1 << p
    if least is None:
        return {}, 1 << 62
    rows = counted.where(F.col("freq") >= least).select("piece", "n").toArrow()
    return dict(zip(rows.column(0).to_pylist(), rows.column(1).to_pylist())), least


def token_counts(df: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                 head: int = HEAD) -> DataFrame:
    """(id, n_bytes, n_tokens), a row for each row of ``df``.

    Null and empty texts have 0 bytes and 0 tokens. Rows may repeat and ids may be null or repeat: rows are
    told apart by id and text, equal ones are counted. Strings of special tokens inside a text count as
    the library has it by default. Other columns are not read. Pre-tokens hold no white space, so
    a key with a blank in front marks the rows that carry a document itself through the join.
    """
    spark = df.sparkSession
    counted = reliable_checkpoint(count_pieces(distinct_pre_tokens(df, text_col), tokenizer_path), "pieces")
    known, _ = _head(counted, head)
    known = spark.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        get = known.value.get
        for part, texts in _texts(batches, 1):
            ids, keys, sizes = (part.column(i).to_pylist() for i in (0, 2, 3))
            at, piece, freq, base = [], [], [], []
            for i, t in enumerate(texts):
                sure, rest = 0, []
                if t:
                    words = pre_tokens(t)
                    found = list(map(get, words, repeat(-1)))
                    sure = sum(found)
                    missing = found.count(-1)
                    if missing:
                        sure += missing
                        rest = Counter([w for w, n in zip(words, found) if n < 0])
                at.append(i)
                piece.append(f" {keys[i]}")
                freq.append(0)
                base.append(sure)
                if rest:
                    at.extend(repeat(i, len(rest)))
                    piece.extend(rest.keys())
                    freq.extend(rest.values())
                    base.extend(repeat(0, len(rest)))
            rows = pa.array(at, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(rows), part.column(2).take(rows), part.column(3).take(rows),
                 pa.array(piece, pa.string()), pa.array(freq, pa.int64()), pa.array(base, pa.int64())],
                ["id", "key", "n_bytes", "piece", "freq", "sure"])

    kind = df.schema[id_col].dataType.simpleString()
    text = F.col(text_col)
    rows = (df.select(F.col(id_col).alias("id"), text.alias("text"), F.xxhash64(text).alias("key"),
                      F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
              .mapInArrow(run, f"id {kind}, key bigint, n_bytes bigint, piece string, freq bigint, sure bigint"))
    sums = (rows.join(counted.select("piece", "n"), "piece", "left")
                .groupBy("id", "key", "n_bytes")
                .agg(F.sum(F.col("sure") + F.col("freq") * F.coalesce("n", F.lit(0))).alias("tokens"),
                     F.sum(F.when(F.col("freq") == 0, 1).otherwise(0)).alias("rows")))
    per_row = sums.select("id", "n_bytes", F.expr("tokens div rows").alias("n_tokens"),
                          F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))).alias("_row"))
    return per_row.select(F.col("id").alias(id_col), "n_bytes", "n_tokens")
