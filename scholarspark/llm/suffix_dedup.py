"""Exact removal of long repeated byte strings with a logarithmic family of suffix indexes.

Texts are UTF-8 bytes. A byte goes if a string of ``length`` bytes covering it also starts anywhere else.

Sampled suffixes. In every window of ``length`` bytes the ``GRAM``-byte gram of least hash (leftmost on ties) is its
anchor; equal windows have equal anchors at equal offsets. So it is enough to index the suffixes at anchors, about
one in ``length / 2`` bytes: an entry is (key of the gram, text, first and last window it anchors).

Index family. Texts come in batches. In place of a suffix array a batch gets its entries sorted by key within buckets of
the key (a bucketed table, so scans of two of them merge without a shuffle). It is scanned against every existing level for
common keys, then becomes a level; two levels of equal size are merged into one of twice the size, and so on,
so each entry is rewritten log2(batches) times.

Long matches. Entries whose key occurs twice are candidates. Their windows are compared by content: the bytes around
an entry travel to the key's task, a 64-bit hash of each window is computed there, and windows whose hash occurs
twice are removed. Keys with more than ``HOT`` entries are instead counted window by window, with counts
gathered in the tasks before the shuffle, so no group has to fit a task. Copies of a whole text are found by digest
first, and only one of them is indexed.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarspark.llm.common import gives_back, row_key
from scholarspark.session import reliable_checkpoint

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LENGTH = 400
GRAM = 64
BATCHES = 4
#: Entries of one key that are compared in one task (about 600 bytes each).
HOT = 20_000
#: Bytes of a text looked at together, bytes of contexts compared together, and bytes of contexts hashed together.
BLOCK, CHUNK, PIECE = 1 << 22, 1 << 22, 1 << 19
ROWS = 256

#: Odd multipliers of the hash; a byte is mixed before it is used.
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h *= _MIX
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_BYTES = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))


def gram_hashes(data: np.ndarray, *lengths: int) -> list[np.ndarray]:
    """For each length, a 64-bit hash of the gram of that length at every position where one fits. Polynomial, built
    from grams of powers of two, the smallest last in the gram; of the powers only one is held."""
    h, size = _BYTES[data], 1
    ends: list[np.ndarray | None] = [None] * len(lengths)             # hashes of the last ``length % size`` bytes of the grams
    while size <= max(lengths):
        for i, length in enumerate(lengths):
            if length & size:
                end = ends[i]
                if end is None:
                    ends[i] = h
                else:
                    ends[i] = h[:max(len(end) - size, 0)] * np.uint64(pow(_BASE, length % size, 1 << 64))
                    ends[i] += end[size:]
        if size * 2 <= max(lengths):
            longer = h[:-size] * np.uint64(pow(_BASE, size, 1 << 64)) if len(h) > size else h[:0]
            longer += h[size:]
            h = longer
        size *= 2
    return [_mix(end) for end in ends]


def _sliding_min(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every run of w values: of the end of one block and the beginning of the next."""
    n = len(v) - w + 1
    pad = -len(v) % w
    blocks = np.concatenate([v, np.full(pad, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1:w - 1 + n])


def entries(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, first windows, last windows) of the anchors of a text."""
    gram = min(GRAM, length)
    keys, firsts, lasts = [], [], []
    for at in range(0, max(len(data) - length + 1, 0), BLOCK):
        part = np.frombuffer(data, np.uint8, min(len(data) - at, BLOCK + length - 1), at)
        h, = gram_hashes(part, gram)
        v = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
        anchor = (_sliding_min(v, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
        keys.append(h[anchor[first]].view(np.int64))
        firsts.append(first + at)
        lasts.append(np.append(first[1:], len(anchor)) - 1 + at)
    if not keys:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(keys), np.concatenate(firsts), np.concatenate(lasts)


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    cuts = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.concatenate([np.zeros(0, np.int64), *parts]), kind))


def _suffixes(docs: DataFrame, length: int) -> DataFrame:
    """(rep, copies, keys, firsts, lasts): one row a distinct text of at least ``length`` bytes, named by the least of
    its row keys."""
    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                found = [entries(t.encode("utf-8"), length) for t in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), *(_lists([f[i] for f in found], pa.int64()) for i in range(3))],
                    ["rid", "digest", "keys", "firsts", "lasts"])

    rows = (docs.where(F.col("n_bytes") >= length).select("rid", F.unhex(F.md5("text")).alias("digest"), "text")
                .mapInArrow(run, "rid binary, digest binary, keys array<bigint>, firsts array<bigint>, lasts array<bigint>"))
    return (rows.groupBy("digest").agg(F.min("rid").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("keys").alias("keys"),
                                       F.first("firsts").alias("firsts"), F.first("lasts").alias("lasts")).drop("digest"))


class IndexFamily:
    """Levels of sorted suffix entries, (key, rep, first, last), and the keys found more than once so far."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.levels: list[tuple[int, str]] = []      # (number of batches, table), smallest last
        self.repeated: list[DataFrame] = []
        self.buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)

    def _write(self, rows: DataFrame) -> str:
        name = f"suffix_level_{uuid.uuid4().hex[:12]}"
        (rows.repartition(self.buckets, "key").write.bucketBy(self.buckets, "key").sortBy("key", "rep", "first")
             .format("parquet").saveAsTable(name))
        return name

    def add(self, batch: DataFrame) -> None:
        name = self._write(batch)
        keys = self.spark.table(name).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        found = [keys.where("n > 1").select("key")]
        for _, level in self.levels:
            found.append(keys.select("key").join(self.spark.table(level).groupBy("key").agg(F.lit(1).alias("one")), "key")
                             .select("key"))
        out = found[0]
        for more in found[1:]:
            out = out.union(more)
        self.repeated.append(reliable_checkpoint(out, "repeated-keys"))
        self.levels.append((1, name))
        while len(self.levels) > 1 and self.levels[-1][0] == self.levels[-2][0]:
            (n, a), (m, b) = self.levels.pop(), self.levels.pop()
            merged = self._write(self.spark.table(a).union(self.spark.table(b)))
            self.levels.append((n + m, merged))
            for old in (a, b):
                self.spark.sql(f"DROP TABLE {old}")

    def matches(self) -> DataFrame:
        """The entries of all levels whose key occurs more than once, with the number of entries of the key."""
        keys = self.repeated[0]
        for more in self.repeated[1:]:
            keys = keys.union(more)
        rows = self.spark.table(self.levels[0][1])
        for _, level in self.levels[1:]:
            rows = rows.union(self.spark.table(level))
        rows = rows.join(keys.distinct(), "key", "left_semi")
        hot = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).select("key", F.lit(True).alias("hot"))
        return rows.join(hot, "key", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))

    def drop(self) -> None:
        for _, level in self.levels:
            self.spark.sql(f"DROP TABLE {level}")


def _contexts(texts: DataFrame, length: int) -> DataFrame:
    """(key, rid, wanted, hot, first, context) for each candidate entry: the bytes its windows cover."""
    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                rows, context = [], []
                for i, (text, found) in enumerate(zip(part.column(1).to_pylist(), part.column(3).to_pylist())):
                    data = text.encode("utf-8")
                    for m in found:
                        rows.append((i, m["key"], m["hot"], m["first"]))
                        context.append(data[m["first"]:m["last"] + length])
                if rows:
                    at_row = pa.array([r[0] for r in rows], pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[1] for r in rows], pa.int64()), part.column(0).take(at_row), part.column(2).take(at_row),
                         pa.array([r[2] for r in rows], pa.bool_()), pa.array([r[3] for r in rows], pa.int64()),
                         pa.array(context, pa.binary())], ["key", "rid", "wanted", "hot", "first", "context"])

    return (texts.where("found IS NOT NULL").select("rid", "text", F.expr("copies = 1").alias("wanted"), "found")
                 .mapInArrow(run, "key bigint, rid binary, wanted boolean, hot boolean, first bigint, context binary"))


def _windows(context: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of the contexts, one context after the other, and the number of windows of each. What is needed
    for every byte is made for ``PIECE`` bytes at a time."""
    sizes = np.fromiter(map(len, context), np.int64, len(context))
    n, before = sizes - length + 1, np.cumsum(sizes) - sizes
    out, done, low = np.empty(n.sum(), np.uint64), 0, 0
    while low < len(context):
        high = int(np.searchsorted(before, before[low] + PIECE))
        h, = gram_hashes(np.frombuffer(b"".join(context[low:high]), np.uint8), length)
        own = n[low:high]
        out[done:done + own.sum()] = h[np.repeat(before[low:high] - before[low] - np.cumsum(own) + own, own) + np.arange(own.sum())]
        done, low = done + own.sum(), high
    return out, n


def _places(n: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The context of the windows numbered ``at``, and their position there."""
    ends = np.cumsum(n)
    owner = np.searchsorted(ends, at, "right")
    return owner, at - (ends - n)[owner]


def _runs(owner: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Consecutive windows of one context as (context, first, last)."""
    new = np.concatenate([[True], (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1] + 1)]) if len(owner) else np.zeros(0, bool)
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(owner)) - 1 if len(start) else start
    return owner[start], inside[start], inside[end]


def _compare(rows: DataFrame, length: int) -> DataFrame:
    """(rid, lo, hi) byte ranges whose windows occur twice, comparing the entries of a key in one task."""
    def decide(tables: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        t = pa.concat_tables(tables)
        context = t.column("context").to_pylist()
        seen: dict[bytes, int] = {}
        place = [seen.setdefault(c, len(seen)) for c in context]           # equal contexts: repeated throughout
        times = np.bincount(place, minlength=len(seen))
        distinct = list(seen)
        h, n = _windows(distinct, length)
        order = np.argsort(h, kind="stable")
        h = h[order]
        same = h[1:] == h[:-1]
        twice = np.repeat(times > 1, n)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        del h, order, same
        c, a, b = _runs(*_places(n, np.flatnonzero(twice)))
        cuts = np.searchsorted(c, np.arange(len(distinct) + 1))
        rid, wanted, first = (t.column(x).to_pylist() for x in ("rid", "wanted", "first"))
        out = [(rid[i], first[i] + int(a[j]), first[i] + int(b[j]) + length)
               for i in range(len(context)) if wanted[i] for j in range(cuts[place[i]], cuts[place[i] + 1])]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.int64()),
                                              pa.array([o[2] for o in out], pa.int64())], ["rid", "lo", "hi"])

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            t = pa.Table.from_batches([batch])
            keys = batch.column(0).to_numpy()
            starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            bytes_before = np.concatenate([[0], np.cumsum(np.diff(batch.column(4).offsets.to_numpy() if hasattr(
                batch.column(4), "offsets") else np.frombuffer(batch.column(4).buffers()[1], np.int32)[
                    batch.column(4).offset:batch.column(4).offset + batch.num_rows + 1]))])
            done = 0
            for s in starts:
                # a key may go on from the batch before; only a change of key closes what is held
                changed = s > 0 or not held or held[-1].column("key")[-1].as_py() != keys[0]
                if changed and size + bytes_before[s] - bytes_before[done] >= CHUNK:
                    if s > done:
                        held.append(t.slice(done, s - done))
                    if held:
                        yield from decide(held)
                    held, size, done = [], 0, s
            if done < batch.num_rows:
                held.append(t.slice(done))
                size += int(bytes_before[-1] - bytes_before[done])
        if held:
            yield from decide(held)

    spark = rows.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    return (rows.select("key", "rid", "wanted", "first", "context").repartition(n, "key").sortWithinPartitions("key")
                .mapInArrow(run, "rid binary, lo bigint, hi bigint"))


def _compare_hot(rows: DataFrame, length: int) -> DataFrame:
    """As ``_compare``, window by window, for keys with more entries than a task should hold."""
    @gives_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                h, _ = _windows(batch.slice(at, 4096).column(0).to_pylist(), length)
                ids, n = np.unique(h.view(np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], ["h", "n"])

    @gives_back
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                h, n = _windows(part.column(2).to_pylist(), length)
                owner, inside = _places(n, np.arange(len(h)))
                rows = pa.array(owner, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), part.column(0).take(rows), pa.array(part.column(1).to_numpy()[owner] + inside)],
                    ["h", "rid", "lo"])

    twice = (rows.select("context").mapInArrow(count, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))
                 .where("n > 1").select("h"))
    named = rows.where("wanted").select("rid", "first", "context").mapInArrow(name, "h bigint, rid binary, lo bigint")
    return named.join(twice, "h", "left_semi").select("rid", "lo", (F.col("lo") + length).alias("hi"))


def mark_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                 batches: int = BATCHES) -> DataFrame:
    """``df`` with n_bytes (long) and ``spans``: the byte ranges to remove, ascending and apart.

    A null text has 0 bytes and no spans; texts shorter than ``length`` have none. Every row of a text that occurs in
    several rows (also rows alike in all columns) is removed whole if it has ``length`` bytes. Extra columns stay; columns
    named like those added here are replaced. An empty table stays empty.
    """
    spark = df.sparkSession
    # columns of this operator's own, under names a table will hardly have
    rid, rep, copies_, found_, ranges_ = (f"_repeats_{c}" for c in ("rid", "rep", "copies", "found", "ranges"))
    docs = (df.drop("spans").withColumn("n_bytes", F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long"))
              .withColumn(rid, F.unhex(row_key(id_col, text_col))))
    suffixes = reliable_checkpoint(_suffixes(docs.select(F.col(rid).alias("rid"), "n_bytes", F.col(text_col).alias("text")),
                                             length), "suffixes")
    family = IndexFamily(spark)
    for b in range(batches):
        batch = suffixes.where(F.pmod(F.xxhash64("rep"), F.lit(batches)) == b)
        family.add(batch.select("rep", F.inline(F.arrays_zip(F.col("keys").alias("key"), F.col("firsts").alias("first"),
                                                             F.col("lasts").alias("last"))))
                        .toDF("rep", "key", "first", "last").select("key", "rep", "first", "last"))
    found = family.matches().groupBy("rep").agg(F.collect_list(F.struct("key", "first", "last", "hot")).alias(found_))
    known = suffixes.select(F.col("rep").alias(rep), F.col("copies").alias(copies_)).join(
        found, F.col(rep) == F.col("rep"), "left").drop("rep")
    # the texts, kept in buckets of their row key: the spans come back to them without another shuffle
    name = f"suffix_texts_{uuid.uuid4().hex[:12]}"
    (docs.join(known, F.col(rid) == F.col(rep), "left").drop(rep).repartition(family.buckets, rid)
         .write.bucketBy(family.buckets, rid).format("parquet").saveAsTable(name))
    family.drop()
    texts = spark.table(name)
    rows = _contexts(texts.select(F.col(rid).alias("rid"), F.col(text_col).alias("text"), F.col(copies_).alias("copies"),
                                  F.col(found_).alias("found")), length)
    hot = texts.where(F.exists(found_, lambda x: x["hot"])).limit(1).count() > 0
    ranges = _compare(rows.where("NOT hot"), length)
    if hot:
        ranges = ranges.union(_compare_hot(rows.where("hot"), length))
    spans = ranges.groupBy("rid").agg(F.collect_list(F.struct("lo", "hi")).alias(ranges_)).withColumnRenamed("rid", rep)
    copies = F.coalesce(F.col(copies_), F.lit(2))
    whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("end")))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    # ascending ranges folded into maximal runs
    zero = F.struct(none.alias("done"), F.lit(-1).cast("long").alias("lo"), F.lit(-1).cast("long").alias("hi"))

    def close(acc):
        return F.when(acc["lo"] >= 0, F.concat(acc["done"], F.array(F.struct(acc["lo"].alias("start"), acc["hi"].alias("end"))))
                      ).otherwise(acc["done"])

    merged = F.aggregate(
        F.array_sort(F.coalesce(ranges_, F.array().cast("array<struct<lo:bigint,hi:bigint>>"))), zero,
        lambda acc, r: F.when(r["lo"] <= acc["hi"], F.struct(acc["done"].alias("done"), acc["lo"].alias("lo"),
                                                             F.greatest(acc["hi"], r["hi"]).alias("hi")))
                        .otherwise(F.struct(close(acc).alias("done"), r["lo"].alias("lo"), r["hi"].alias("hi"))), close)
    joined = texts.join(spans, F.col(rid) == F.col(rep), "left")
    out = joined.withColumn("spans", F.when(F.col("n_bytes") < length, none).when(copies > 1, whole).otherwise(merged))
    return out.drop(rid, rep, copies_, found_, ranges_)


def remove_spans(df: DataFrame, text_col: str = "text", as_text: bool = False) -> DataFrame:
    """Adds ``kept`` (binary): the bytes of the text outside the spans; they may break a character at a border. With
    ``as_text`` it is a string without broken characters, null for a null text."""
    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at_text, at_spans = (batch.schema.get_field_index(c) for c in (text_col, "spans"))
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                kept = []
                for text, spans in zip(part.column(at_text).to_pylist(), part.column(at_spans).to_pylist()):
                    data, parts, last = (text or "").encode("utf-8"), [], 0
                    for s in spans or []:
                        parts.append(data[last:s["start"]])
                        last = s["end"]
                    rest = b"".join([*parts, data[last:]])
                    kept.append(rest if not as_text else None if text is None else rest.decode("utf-8", "ignore"))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(kept, pa.string() if as_text else pa.binary())],
                                                 [*part.schema.names, "kept"])

    df = df.drop("kept")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{fields}, kept {'string' if as_text else 'binary'}")
