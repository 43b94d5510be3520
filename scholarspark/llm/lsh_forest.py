"""Near-duplicate join: word-shingle Jaccard by a MinHash LSH forest, verified exactly.

Sets. A text's set holds its runs of ``WORDS`` words (lower-cased letters, digits and underscores) as 64-bit hashes; a shorter
text has one run of all its words, a text without words itself as its only element. A null text has no set and no link.
Rows with equal sets are collapsed first and counted, so copies cost one member.

Forest. A signature is ``TREES`` labels of up to ``DEPTH`` MinHash values. In each tree texts whose labels share a prefix are
neighbours in the sorted trie. The matched prefix starts at the longest that finds a pair at the threshold with the
target probability, 1 - (1 - s^depth)^trees. After verification the links found say (each counted by the inverse of
its own probability) what recall was reached; below the target the prefix is shortened and the join repeated.

Verification. Sharing a prefix is turned into star edges (each text of a trie node to its least one, never all pairs) and their
components put candidates together. Inside a component every pair is verified on the full sets, as a matrix
product in blocks of ``BLOCK`` members: a large component becomes many block pairs, which are tasks of bounded size, and only
counts of links and spanning edges leave a task.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarspark.llm.common import gives_back, row_key
from scholarspark.llm.components import components
from scholarspark.session import reliable_checkpoint

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORDS = 5
THRESHOLD = 0.8
TREES = 18
DEPTH = 8
RECALL = 0.99
BLOCK = 512
ROWS = 256
WORD_CACHE = 200_000

_WORD = re.compile(r"\w+")


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < WORD_CACHE:
            self[word] = h
        return h


def shingle_set(text: str | None, cache: dict[str, int], words: int) -> np.ndarray:
    """The set of a text, ascending 64-bit hashes; empty for a null text."""
    if text is None:
        return np.zeros(0, np.uint64)
    found = _WORD.findall(text.lower())
    if not found:
        return np.array([xxhash.xxh64_intdigest("\x00" + text)], np.uint64)
    h = np.fromiter(map(cache.__getitem__, found), np.uint64, len(found))
    k = min(words, len(h))
    total = np.full(len(h) - k + 1, np.uint64(k))
    for i in range(k):
        total = (total ^ h[i:len(h) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    total = np.sort(total)
    return total[np.concatenate([[True], total[1:] != total[:-1]])]


def _permutations(trees: int, depth: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return (rng.integers(0, 1 << 32, trees * depth, np.uint32), rng.integers(0, 1 << 31, trees * depth, np.uint32) * 2 + 1)


def signature(hashes: np.ndarray, xor: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """MinHash values of a set, one a permutation."""
    low = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(xor), np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(low), 256):
        part = (low[at:at + 256, None] ^ xor) * factor
        np.minimum(out, part.min(axis=0), out=out)
    return out


def find_probability(similarity: float, depth: int, trees: int) -> float:
    """Probability that a pair shares a prefix of this depth in one of the trees."""
    return 1.0 - (1.0 - similarity ** depth) ** trees


def start_depth(threshold: float, recall: float, trees: int, depth: int) -> int:
    return next((d for d in range(depth, 0, -1) if find_probability(threshold, d, trees) >= recall), 1)


def signatures(docs: DataFrame, words: int, trees: int, depth: int) -> DataFrame:
    """(rid, id, set_key, labels): digest of the set, and the labels, ``depth`` 4-byte values a tree."""
    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, (xor, factor) = WordHashes(), _permutations(trees, depth)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                keys, labels = [], []
                for rid, text in zip(part.column(0).to_pylist(), part.column(2).to_pylist()):
                    found = shingle_set(text, cache, words)
                    keys.append(xxhash.xxh128_digest(found.tobytes()) if len(found) else xxhash.xxh128_digest(b"null" + rid))
                    labels.append(signature(found, xor, factor).tobytes() if len(found) else None)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(keys, pa.binary()),
                                                  pa.array(labels, pa.binary())], ["rid", "id", "set_key", "labels"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"rid binary, id {kind}, set_key binary, labels binary")


def candidates(members: DataFrame, trees: int, depth: int, full: int) -> DataFrame:
    """(u, v) star edges between members that share a prefix of ``depth`` values in some tree."""
    labels = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)),
                         lambda t: F.struct(t.alias("tree"), F.xxhash64(t, F.substr(
                             F.col("labels"), t * (4 * full) + 1, F.lit(4 * depth))).alias("prefix")))
    nodes = members.where("labels IS NOT NULL").select("rep", F.inline(labels))
    hubs = (nodes.groupBy("tree", "prefix").agg(F.min("rep").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
                 .select(F.col("tree").alias("t"), F.col("prefix").alias("p"), "hub"))
    return (nodes.join(hubs, (F.col("tree") == F.col("t")) & (F.col("prefix") == F.col("p"))).where("rep <> hub")
                 .select("rep", "hub").distinct())


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    both = np.diag(sizes).astype(np.float32)
    values, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    new = np.concatenate([[True], values[1:] != values[:-1]])
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1                # an element of one set only meets no other
    owner, column = owner[shared], np.cumsum(new)[shared]
    if len(column):
        column = np.cumsum(np.concatenate([[True], column[1:] != column[:-1]])) - 1
        both = np.zeros((n, n), np.float32)
        for first in range(0, int(column[-1]) + 1, 4096):
            a, b = np.searchsorted(column, [first, first + 4096])
            m = np.zeros((n, min(4096, int(column[-1]) + 1 - first)), np.float32)
            m[owner[a:b], column[a:b] - first] = 1
            both += m @ m.T
        both[np.arange(n), np.arange(n)] = sizes
    return both


def _verify(rows: DataFrame, threshold: float, depth: int, trees: int) -> DataFrame:
    """(rep, root, links, found, expected) of the members of each block pair that have a link: the least member
    linked to it there, links counted with copies, and for the recall the pairs found and expected.

    Rows of a block pair must be together in a partition, in order."""
    def decide(group: pa.Table) -> Iterator[pa.RecordBatch]:
        reps, copies = group.column("rep").to_pylist(), group.column("copies").to_numpy().astype(float)
        sets = [np.frombuffer(s, "<u8") for s in group.column("shingles").to_pylist()]
        side, i, j = group.column("block").to_numpy(), group.column("bi")[0].as_py(), group.column("bj")[0].as_py()
        sizes = np.array([len(s) for s in sets], float)
        both = _intersections(sets).astype(float)
        like = both / np.maximum(sizes[:, None] + sizes[None, :] - both, 1)
        linked = like >= threshold
        np.fill_diagonal(linked, False)
        if i != j:                                          # pairs within a block belong to its own pair (i, i)
            linked &= side[:, None] != side[None, :]
        a, b = np.nonzero(linked)
        if not len(a):
            return
        root = np.arange(len(reps))
        order = {r: k for k, r in enumerate(sorted(range(len(reps)), key=reps.__getitem__))}
        rank = np.array([order[k] for k in range(len(reps))])
        least = rank.copy()
        while True:                                         # least rank over links, until it settles
            new = least.copy()
            np.minimum.at(new, a, least[b])
            if (new == least).all():
                break
            least = new
        by_rank = np.argsort(rank)
        root = by_rank[least]
        links = linked @ copies
        chance = 1.0 / (1.0 - (1.0 - like[a, b] ** depth) ** trees)
        expected = np.bincount(a, chance, minlength=len(reps))
        count = linked.sum(axis=1)
        keep = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array([reps[k] for k in keep], pa.binary()), pa.array([reps[root[k]] for k in keep], pa.binary()),
             pa.array(links[keep].astype(np.int64)), pa.array(count[keep].astype(np.int64)), pa.array(expected[keep])],
            ["rep", "root", "links", "found", "expected"])

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key = [], None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            start = 0
            for k in range(len(keys)):
                if keys[k] != key:
                    if k > start:
                        held.append(t.slice(start, k - start))
                    if held:
                        yield from decide(pa.concat_tables(held))
                    held, key, start = [], keys[k], k
            held.append(t.slice(start))
        if held:
            yield from decide(pa.concat_tables(held))

    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    return (rows.select("comp", "bi", "bj", "block", "rep", "copies", "shingles").repartition(n, "comp", "bi", "bj")
                .sortWithinPartitions("comp", "bi", "bj")
                .mapInArrow(run, "rep binary, root binary, links bigint, found bigint, expected double"))


def _sets(rows: DataFrame, words: int) -> DataFrame:
    """(rep, copies, comp, size, shingles) from (rep, copies, comp, size, text)."""
    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                sets = [shingle_set(t, cache, words).tobytes() for t in part.column(4).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(sets, pa.binary())],
                                                 ["rep", "copies", "comp", "size", "shingles"])

    return rows.mapInArrow(run, "rep binary, copies bigint, comp binary, size bigint, shingles binary")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
                    words: int = WORDS, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> DataFrame:
    """(rid, id, class_id, class_key, n_links), a row for each row of ``df``.

    ``rid`` is the row key of id and text; ``n_links`` the number of other rows at ``threshold`` or more; ``class_key`` names the
    class (connected by links) and ``class_id`` is its least id (null ids do not count). A null text is a class of its own row key;
    equal rows are links of each other. Other columns are not read; an empty table gives no rows.
    """
    docs = df.select(F.unhex(row_key(id_col, text_col)).alias("rid"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = reliable_checkpoint(signatures(docs, words, trees, depth), "signatures")
    members = reliable_checkpoint(rows.groupBy("set_key").agg(F.min("rid").alias("rep"), F.count(F.lit(1)).alias("copies"),
                                                              F.min("id").alias("least_id"), F.first("labels").alias("labels")),
                                  "members")
    prefix = start_depth(threshold, recall, trees, depth)
    while True:
        comps = components(candidates(members, trees, prefix, depth))
        sizes = comps.groupBy("root").agg(F.count(F.lit(1)).alias("size")).withColumnRenamed("root", "comp")
        inside = (members.select("rep", "copies").join(comps, F.col("rep") == F.col("node"))
                         .select("rep", "copies", F.col("root").alias("comp")).join(sizes, "comp")
                         .select("rep", "copies", "comp", "size"))
        texts = inside.join(docs, F.col("rep") == F.col("rid")).select("rep", "copies", "comp", "size", "text")
        texts = texts.dropDuplicates(["rep"])             # rows alike in id and text share a row key
        blocks = (F.col("size") + F.lit(BLOCK - 1)) / BLOCK
        placed = (_sets(texts, words).withColumn("nb", F.floor(blocks).cast("int"))
                  .withColumn("block", F.pmod(F.xxhash64("rep"), F.col("nb")).cast("int"))
                  .select("*", F.explode(F.sequence(F.lit(0), F.col("nb") - 1)).alias("other"))
                  .withColumn("bi", F.least("block", "other")).withColumn("bj", F.greatest("block", "other")))
        verified = reliable_checkpoint(_verify(placed, threshold, prefix, trees), "verified")
        reached = verified.agg(F.sum("found").alias("found"), F.sum("expected").alias("expected")).first()
        if prefix == 1 or not reached["found"] or reached["found"] >= recall * reached["expected"]:
            break
        prefix -= 1
    classes = components(verified.select("rep", "root")).select(F.col("node").alias("n"), F.col("root").alias("class"))
    links = verified.groupBy("rep").agg(F.sum("links").alias("links")).withColumnRenamed("rep", "r")
    named = (members.select("set_key", "rep", "copies", "least_id").join(classes, F.col("rep") == F.col("n"), "left")
                    .join(links, F.col("rep") == F.col("r"), "left")
                    .select("set_key", "least_id", F.coalesce("class", "rep").alias("class_key"),
                            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    least = named.groupBy("class_key").agg(F.min("least_id").alias("class_id"))
    named = named.join(least, "class_key").select(F.col("set_key").alias("k"), "class_id", "class_key", "n_links")
    # a hot set_key is many rows on one side only: adaptive execution splits it
    return rows.select("rid", "id", "set_key").join(named, F.col("set_key") == F.col("k")).select(
        "rid", F.col("id").alias(id_col), "class_id", "class_key", "n_links")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``df`` without near-duplicates: of each class the row of least id (null last; then least row key)."""
    near = near_duplicates(df, id_col, text_col, **options)
    order = F.struct(F.col(id_col).isNull().alias("null"), F.col(id_col).alias("id"), F.col("rid").alias("rid"))
    kept = near.groupBy("class_key").agg(F.min(order).alias("first")).select(F.col("first.rid").alias("kept"))
    keyed = df.select(F.struct(*df.columns).alias("row"), F.unhex(row_key(id_col, text_col)).alias("rid"))     # any column names
    return keyed.join(kept, F.col("rid") == F.col("kept"), "left_semi").dropDuplicates(["rid"]).select("row.*")
