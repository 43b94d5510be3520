"""Benchmark decontamination by latent semantic retrieval.

Terms are the words of the benchmark items (the stated query set: items, their vocabulary and everything of that size are
sent to the tasks). Their document frequencies are counted over all documents. Passages are runs of blocks of ``BLOCK``
words; TF-IDF passages are projected to ``RANK`` dimensions by a randomised SVD, fitted on the passages of the items and of
all documents: one job sums the products of the terms that passages share (terms x terms, a partial sum from each core), the products of
the SVD are jobs over the rows of that matrix. Search and checks cover every word of every text.

Items that a text holds word by word are looked up by a hash of their rarest run of words; none of these is missed.
Every run of blocks about as long as an item is compared with it by cosine in the latent space. What reaches
``cosine`` is checked on its words: the longest common subsequence with the item must hold ``lcs`` of the item's words, or
``loose`` of them if it also holds half of the answer (the item's last sentence). Paraphrases that keep most words in
order, with words changed, put in or left out, are found; documents are never compared with one another, and nothing is shuffled.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarspark.llm.chunk_ids import spread
from scholarspark.llm.common import gives_back
from scholarspark.session import reliable_checkpoint

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 10
#: Dimensions; one for every ``ITEMS_PER_RANK`` items if that is more.
RANK, ITEMS_PER_RANK = 96, 4
POWER = 2
#: Weight of an item's passages in the fit, in passages of documents for each item's share of the documents.
ITEM_WEIGHT = 10.0
#: Cells of the terms' products that a task sums in one pass (8 bytes each); more take more passes.
CELLS = 1 << 23
#: Words of texts encoded together.
PACK_WORDS = 200_000
#: Bytes of an Arrow batch while the space is fitted: executor and worker hold one each, some times over.
BATCH_BYTES = 8 << 20
COSINE = 0.5
LCS, LOOSE, ANSWER = 0.75, 0.6, 0.5
#: Bounds of a term's weight in the search.
LEAST, MOST = 0.3, 5.0
#: Words in a row by which verbatim items are looked up.
RUN = 4
#: Words looked at together (their vectors stay in the processor's cache); a longer text is cut into parts that overlap.
BATCH_WORDS = 30_000
#: Items searched for in one pass over the documents, about; more take more passes, so what a task holds is bounded.
ITEMS = 1_000

_WORD = re.compile(r"\w+")
_SENTENCE = re.compile(r"[.!?\n]+")
_LATIN = bytes(c if re.match(r"\w", chr(c)) else 32 for c in range(256))


def words_of(text: str | None) -> list[str]:
    """Lower-cased runs of letters, digits and underscores."""
    if not text:
        return []
    text = text.lower()
    try:
        return text.encode("latin-1").translate(_LATIN).decode("latin-1").split()
    except UnicodeEncodeError:
        return _WORD.findall(text)


def answer_of(text: str) -> list[str]:
    """Words of the last sentence that has three or more (none: of the whole item)."""
    found = [w for w in map(words_of, _SENTENCE.split(text)) if len(w) >= 3]
    return found[-1] if found else words_of(text)


def common_subsequence(item: list[str], passage: list[str]) -> int:
    """Length of the longest common subsequence, a bit for each word of the item."""
    masks: dict[str, int] = {}
    for i, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << i
    full = (1 << len(item)) - 1
    rest = full
    for w in passage:
        hit = rest & masks.get(w, 0)
        if hit:
            rest = ((rest + hit) | (rest - hit)) & full
    return len(item) - rest.bit_count()


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs that run within read Arrow batches of about ``BATCH_BYTES``."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def encode_passages(docs: DataFrame, index: dict[str, int], size: int) -> DataFrame:
    """Term ids of all texts, some texts a row: their number, the ids one behind the other, how many each text and how many each of
    its passages of ``size`` words holds (int32 in bytes). Words that are no terms are left out."""
    def pack(texts: list[list[str]]) -> pa.RecordBatch:
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ids = np.fromiter(map(index.get, chain.from_iterable(texts), repeat(-1)), np.int32, int(lengths.sum()))
        passages = -(-lengths // size)
        owner = np.repeat(np.arange(len(texts)), lengths)
        inside = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        passage = inside // size + (np.cumsum(passages) - passages)[owner]
        known = ids >= 0
        columns = (ids[known], np.bincount(owner[known], minlength=len(texts)), np.bincount(passage[known], minlength=int(passages.sum())))
        return pa.RecordBatch.from_arrays([pa.array([len(texts)], pa.int64()),
                                           *(pa.array([c.astype("<i4").tobytes()], pa.binary()) for c in columns)],
                                          ["docs", "ids", "per_doc", "per_passage"])

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, words = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                for text in batch.column(0).slice(at, 512).to_pylist():
                    held.append(words_of(text))
                    words += len(held[-1])
                    if words >= PACK_WORDS:
                        yield pack(held)
                        held, words = [], 0
        if held:
            yield pack(held)

    return docs.select("text").mapInArrow(run, "docs bigint, ids binary, per_doc binary, per_passage binary")


def _unpacked(row: dict, *columns: str) -> list[np.ndarray]:
    return [np.frombuffer(row[c], "<i4").astype(np.int64) for c in columns]


def document_frequencies(encoded: DataFrame, n_terms: int) -> tuple[np.ndarray, int]:
    """Documents that hold each term, and documents in all; a partial count from each task."""
    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(n_terms + 1, np.int64), 0
        for batch in batches:
            for row in chain.from_iterable(batch.slice(at, 1).to_pylist() for at in range(batch.num_rows)):
                ids, per_doc = _unpacked(row, "ids", "per_doc")
                owner = np.repeat(np.arange(len(per_doc)), per_doc)
                seen += np.bincount(np.unique(owner * n_terms + ids) % max(1, n_terms), minlength=n_terms + 1)
                n += row["docs"]
        seen[n_terms] = n
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen)), pa.array(seen[seen > 0])], ["term", "n"])

    rows = encoded.select("docs", "ids", "per_doc").mapInArrow(run, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(n_terms + 1, np.int64)                        # one entry a term
    for r in rows:
        counts[r["term"]] = r["n"]
    return counts[:n_terms], int(counts[n_terms])


def term_weights(counts: np.ndarray, n: int, items: list[list[str]], vocabulary: list[str]) -> np.ndarray:
    """Inverse document frequencies within bounds; a term counts as no more frequent than it is among the other items.

    Copies of an item in a large part of the documents make the words they keep frequent, not those they change. Other
    items do not hold the kept words for that, so these weigh about as much as before; common words are in many items.
    """
    texts = {tuple(w) for w in items}
    held = Counter(w for t in texts for w in set(t))
    among = np.array([(held[w] - 1) / len(texts) for w in vocabulary])
    share = np.minimum((counts + 0.5) / (n + 1), among)
    return np.clip(-np.log(np.maximum(share, 1e-9)), LEAST, MOST)


def _block_sums(lengths: np.ndarray, ids: np.ndarray, vectors: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the term vectors of every block, texts one behind the other with ``pad`` empty blocks between them,
    and the first block of each text. The last of ``vectors`` is zero, for words that are no terms (-1)."""
    blocks = -(-lengths // BLOCK) + pad
    first = np.cumsum(blocks) - blocks
    inside = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    words = np.full((int(blocks.sum()), BLOCK), -1)
    words[np.repeat(first, lengths) + inside // BLOCK, inside % BLOCK] = ids
    out = np.zeros((len(words), vectors.shape[1]), np.float32)
    for j in range(BLOCK):
        out += vectors[words[:, j]]
    return out, first


def _run_hashes(ids: np.ndarray, n: int) -> np.ndarray:
    """A hash of every ``n`` ids in a row."""
    out = np.zeros(max(0, len(ids) - n + 1), np.int64)
    for j in range(n):
        out = out * 6364136223846793005 + ids[j:j + len(out)]
    return out


def shared_terms(encoded: DataFrame, idf: np.ndarray) -> DataFrame:
    """A'A, A being the normalised TF-IDF passages times the root of their weight: (row, values from the diagonal on, float64 in bytes).

    Each core sums its share of all passages; of a large vocabulary some rows (``CELLS`` cells) at a time.
    """
    n, sent = len(idf), np.asarray(idf, float).tobytes()
    before = np.append(0, np.cumsum(np.arange(n, 0, -1)))           # cells of the rows before each
    cuts = [0]
    while cuts[-1] < n:
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(before, before[cuts[-1]] + CELLS, "right")) - 1))

    def partial_sums(low: int, high: int):
        @gives_back
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # made here: arrays that were pickled carry types of their own, with which ``add.at`` takes ten times as long
            own = np.frombuffer(sent)
            row_at = np.cumsum(np.arange(n, 0, -1)) - n - int(before[low])      # of cell (i, j): row_at[i] + j
            cells = np.zeros(int(before[high] - before[low]))
            for batch in batches:
                for row in chain.from_iterable(batch.slice(at, 1).to_pylist() for at in range(batch.num_rows)):
                    ids, per_passage = _unpacked(row, "ids", "per_passage")
                    codes, tf = np.unique(np.repeat(np.arange(len(per_passage)), per_passage) * n + ids, return_counts=True)
                    passage, terms = np.divmod(codes, n)
                    x = tf * own[terms]
                    x *= np.sqrt(row["weight"] / np.maximum(np.bincount(passage, x * x), 1e-30))[passage]
                    distinct = np.bincount(passage)
                    first = np.cumsum(distinct) - distinct
                    for k in np.unique(distinct[distinct > 0]).tolist():       # passages of k distinct terms, ascending
                        a, b = np.triu_indices(k)
                        begins = first[distinct == k]
                        step = max(1, 250_000 // len(a))
                        for at in range(0, len(begins), step):
                            held = np.arange(k)[:, None] + begins[at:at + step]
                            t, v = terms[held], x[held]
                            i, where, value = t[a], row_at[t][a] + t[b], v[a] * v[b]
                            if high - low < n:
                                mine = (i >= low) & (i < high)
                                where, value = where[mine], value[mine]
                            np.add.at(cells, where.ravel(), value.ravel())
            for at in range(low, high, 64):
                rows = [(i, cells[row_at[i] + i:row_at[i] + n]) for i in range(at, min(high, at + 64))]
                rows = [(i, values.tobytes()) for i, values in rows if values.any()]
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in rows], pa.int32()), pa.array([v for _, v in rows], pa.binary())],
                                                 ["row", "part"])
        return run

    @gives_back
    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, part in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if i in sums:
                    sums[i] += np.frombuffer(part)
                else:
                    sums[i] = np.frombuffer(part).copy()
        for i, values in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([values.tobytes()], pa.binary())], ["row", "part"])

    few = encoded.select("ids", "per_passage", "weight").coalesce(max(1, encoded.sparkSession.sparkContext.defaultParallelism))
    parts = [few.mapInArrow(partial_sums(low, high), "row int, part binary") for low, high in zip(cuts[:-1], cuts[1:])]
    return reduce(DataFrame.union, parts).repartition("row").mapInArrow(total, "row int, part binary")


def fit_latent(encoded: DataFrame, idf: np.ndarray, rank: int) -> np.ndarray:
    """Term vectors (terms x rank): right singular vectors of the TF-IDF passages, by a randomised range finder."""
    rows = reliable_checkpoint(shared_terms(encoded, idf), "svd-terms").coalesce(8)

    def product(right: np.ndarray) -> np.ndarray:
        """A'A right."""
        @gives_back
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(right.shape)
            for batch in batches:
                for at in range(0, batch.num_rows, 128):
                    part = batch.slice(at, 128)
                    i = part.column(0).to_numpy()
                    upper = np.zeros((len(i), len(right)))
                    for to, k, values in zip(upper, i, part.column(1).to_pylist()):
                        to[k:] = np.frombuffer(values)
                    out[i] += upper @ right
                    upper[np.arange(len(i)), i] = 0.0
                    out += upper.T @ right[i]
            yield pa.RecordBatch.from_arrays([pa.array([out.ravel().tobytes()], pa.binary())], ["part"])

        total = np.zeros(right.shape)
        for row in rows.mapInArrow(run, "part binary").toLocalIterator():            # one a task
            total += np.frombuffer(row["part"]).reshape(right.shape)
        return total

    rng = np.random.default_rng(7)
    rank = min(rank, len(idf))
    q = np.linalg.qr(product(rng.standard_normal((len(idf), min(rank + 8, len(idf))))))[0]
    for _ in range(POWER - 1):
        q = np.linalg.qr(product(q))[0]
    values, turn = np.linalg.eigh(q.T @ product(q))
    return q @ turn[:, np.argsort(values)[::-1][:rank]]


class Searcher:
    """Items, their latent vectors by length, and the checks."""

    def __init__(self, items: list[tuple], index: dict[str, int], idf: np.ndarray, latent: np.ndarray, limits: tuple):
        self.ids = [i for i, _ in items]
        self.words = [words_of(t) for _, t in items]
        self.answers = [answer_of(t) for _, t in items]
        self.index = index
        self.vectors = np.vstack([latent * idf[:, None], np.zeros((1, latent.shape[1]))]).astype(np.float32)
        self.cosine, self.lcs, self.loose = limits
        self.spans: dict[int, list[int]] = {}
        for k, w in enumerate(self.words):
            if w:
                # no wider than a short item, and long enough to hold it wherever it begins in a block, or nearly so
                for n in {max(1, round(len(w) / BLOCK)), max(2, round(len(w) / BLOCK + 0.5))}:
                    self.spans.setdefault(n, []).append(k)
        self.pad = max(self.spans, default=1)
        self.units = {}
        for n, ks in self.spans.items():
            v = np.array([self.vectors[[self.index[w] for w in self.words[k] if w in self.index]].sum(axis=0) for k in ks])
            self.units[n] = (v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-9)).T
        # the words of each item, padded with the term that no passage holds
        self.terms = np.full((len(self.words), max(map(len, self.words), default=0)), len(idf), np.int32)
        for k, w in enumerate(self.words):
            self.terms[k, :len(w)] = [index[x] for x in w]
        self.sizes = np.array([len(w) for w in self.words])
        # beyond a text's part: what windows and passages that begin in it may reach
        longest = max(map(len, self.words), default=0)
        self.reach = -(-(self.pad * BLOCK + longest + 2 * BLOCK) // BLOCK) * BLOCK
        # each item's rarest run of RUN words (of all its words, if fewer), by length and hash
        self.runs: dict[int, dict[int, list[tuple[int, int]]]] = {}
        for k, w in enumerate(self.words):
            if w:
                own = np.array([index[x] for x in w])
                n = min(RUN, len(w))
                at = int(np.argmax(np.convolve(idf[own], np.ones(n), "valid")))
                self.runs.setdefault(n, {}).setdefault(int(_run_hashes(own[at:at + n], n)[0]), []).append((k, at))

    def check(self, k: int, passage: list[str]) -> tuple[float, float]:
        """Shares of the item's words and of its answer's that the passage holds in order."""
        share = common_subsequence(self.words[k], passage) / len(self.words[k])
        if share < self.loose:
            return share, 0.0
        return share, common_subsequence(self.answers[k], passage) / len(self.answers[k])

    def verbatim(self, texts: list[list[str]], ids: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Text, item and first word of every place where a text holds an item word by word."""
        ends = np.cumsum(lengths)
        for n, runs in self.runs.items():
            hashes = _run_hashes(ids, n)
            for p in np.flatnonzero(np.isin(hashes, np.fromiter(runs, np.int64))):
                d = int(np.searchsorted(ends, p, "right"))
                for k, before in runs[int(hashes[p])]:
                    at = int(p - ends[d] + lengths[d]) - before
                    if at >= 0 and texts[d][at:at + len(self.words[k])] == self.words[k]:
                        yield d, k, at

    def _enough(self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray, owner: np.ndarray, ks: np.ndarray) -> np.ndarray:
        """Whether passage ``owner`` (words starts..ends) holds at least ``loose`` of the words of item ``ks``, in any order."""
        out = np.zeros(len(ks), bool)
        width = len(self.vectors)
        before = np.append(0, np.cumsum(ids >= 0))                # of the words only terms matter
        ids, starts, ends = ids[ids >= 0], before[starts], before[ends]
        for first in range(0, len(starts), 500):                  # which terms each of some passages holds
            pairs = slice(*np.searchsorted(owner, [first, first + 500]))
            items = ks[pairs]
            if not len(items):
                continue
            lengths = (ends - starts)[first:first + 500]
            there = np.zeros(len(lengths) * width, bool)          # the last term of each passage is the padding
            there[np.repeat(np.arange(len(lengths)) * width, lengths) + ids[spread(starts[first:first + 500], lengths)]] = True
            at = ((owner[pairs] - first) * width).astype(np.int32)[:, None] + self.terms[items]
            held = there.take(at).view(np.uint8)
            shared = held.sum(axis=1, dtype=np.uint8 if held.shape[1] < 256 else np.uint32)
            out[pairs] = shared >= self.loose * self.sizes[items]
        return out

    def parts(self, words: list[str]) -> Iterator[tuple[int, list[str], int, int]]:
        """A text as (first word, words, from, to): what begins at from..to belongs to the part, the rest is around it."""
        if len(words) <= 2 * BATCH_WORDS:
            yield 0, words, 0, len(words)
            return
        step = BATCH_WORDS // BLOCK * BLOCK
        for at in range(0, len(words), step):
            before = max(0, at - self.reach)
            yield before, words[before:at + step + self.reach], at - before, at - before + step

    def search(self, parts: list[tuple[int, list[str], int, int]]) -> list[dict[int, dict]]:
        """Hits of each part, best by item: by share, then cosine, then the earlier word."""
        texts = [words for _, words, _, _ in parts]
        lengths = np.array([len(t) for t in texts])
        offset = np.cumsum(lengths) - lengths
        begins, ends = (np.array([p[i] for p in parts]) for i in (2, 3))
        ids = np.fromiter(map(self.index.get, chain.from_iterable(texts), repeat(-1)), np.int64, int(lengths.sum()))
        sums, first = _block_sums(lengths, ids, self.vectors, self.pad)
        best: list[dict[int, dict]] = [{} for _ in texts]
        for d, k, at in self.verbatim(texts, ids, lengths):
            if begins[d] <= at < ends[d] and k not in best[d]:
                best[d][k] = {"item_id": self.ids[k], "cosine": 1.0, "lcs": 1.0, "answer": 1.0, "word": at + parts[d][0]}
        owners = np.repeat(np.arange(len(texts)), np.diff(np.append(first, len(sums))))
        word = (np.arange(len(sums)) - first[owners]) * BLOCK
        mine = (word >= begins[owners]) & (word < ends[owners])
        runs, n = sums, 1
        for longer, ks in sorted(self.spans.items()):
            for n in range(n + 1, longer + 1):               # runs of n blocks
                runs = runs[:-1] + sums[n - 1:]
            norm = np.sqrt(np.einsum("ij,ij->i", runs, runs))
            cos = runs @ self.units[n]
            cos /= np.maximum(norm, 1e-6)[:, None]
            some = mine[:len(runs)] & (norm > 1e-6)
            near = np.flatnonzero((cos >= self.cosine) & some[:, None])
            if not len(near):
                continue
            rows, items = near // len(ks), np.array(ks)[near % len(ks)]
            cosines = cos.ravel()[near]
            # the words around each window, by the item's length
            half = self.sizes[items] // 2 + BLOCK
            d, at = owners[rows], word[rows]
            low, high = np.maximum(0, at - half), np.minimum(lengths[d], at + n * BLOCK + half)
            spans, owner = np.unique(rows * 1_000_000 + half, return_inverse=True)
            pick = np.zeros(len(spans), np.int64)
            pick[owner] = np.arange(len(rows))
            order = np.argsort(owner, kind="stable")
            enough = np.zeros(len(rows), bool)
            enough[order] = self._enough(ids, (offset[d] + low)[pick], (offset[d] + high)[pick], owner[order], items[order])
            for i in np.flatnonzero(enough).tolist():
                t, k = int(d[i]), int(items[i])
                hit = best[t].get(k)
                if hit is not None and hit["lcs"] == 1.0:
                    continue
                share, answer = self.check(k, texts[t][int(low[i]):int(high[i])])
                if share >= self.lcs or share >= self.loose and answer >= ANSWER:
                    if hit is None or (share, min(1.0, float(cosines[i]))) > (hit["lcs"], hit["cosine"]):
                        best[t][k] = {"item_id": self.ids[k], "cosine": min(1.0, float(cosines[i])), "lcs": share,
                                      "answer": answer, "word": int(at[i]) + parts[t][0]}
        return best

    def hits(self, texts: Iterator[list[str]]) -> Iterator[list[dict]]:
        """Hits of each text, by item; ``BATCH_WORDS`` words, about, are searched together."""
        held, size, done = [], 0, 0
        found: list[dict[int, dict]] = []

        def search() -> None:
            for (t, _), hits in zip(held, self.search([p for _, p in held])):
                for k, hit in hits.items():
                    old = found[t - done].get(k)
                    if old is None or (hit["lcs"], hit["cosine"]) > (old["lcs"], old["cosine"]):
                        found[t - done][k] = hit

        for t, words in enumerate(texts):
            found.append({})
            for part in self.parts(words):
                held.append((t, part))
                size += len(part[1])
                if size >= BATCH_WORDS:
                    search()
                    held, size = [], 0
            if not held:
                yield from ([h for _, h in sorted(hits.items())] for hits in found)
                found, done = [], t + 1
        if held:
            search()
        yield from ([h for _, h in sorted(hits.items())] for hits in found)


HITS = "array<struct<item_id:bigint,cosine:double,lcs:double,answer:double,word:int>>"


def mark_contamination(df: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                       item_text: str = "text", rank: int | None = None, cosine: float = COSINE,
                       lcs: float = LCS, loose: float = LOOSE, at_once: int = ITEMS) -> DataFrame:
    """``df`` with ``hits``: the benchmark items a text holds, each with cosine, share of the item's words and of its answer's
    in order, and the word where the passage begins. Empty for clean, null and wordless texts.

    Items without a word (or null) match nothing; with no items nothing is marked. Rows may repeat; other columns
    stay, one named ``hits`` is replaced. ``item_col`` must be an integer. More than ``at_once`` items are dealt by hash into
    groups of about that many, each with a space, a broadcast and a pass of its own.
    """
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text).alias("text")).where("text IS NOT NULL").distinct()
    groups = max(1, -(-items.count() // at_once))
    group = F.pmod(F.xxhash64("item", "text"), F.lit(groups))
    df = df.drop("hits")
    own, out = df.columns, df.withColumn("hits", F.array().cast(HITS))
    for g in range(groups):
        out = _mark_group(out, df, [(r["item"], r["text"]) for r in items.where(group == g).collect()], text_col, rank,
                          (cosine, lcs, loose))
    by_item = F.array_sort("hits", lambda a, b: F.when(a["item_id"] < b["item_id"], -1).when(a["item_id"] > b["item_id"], 1).otherwise(0))
    return out.select(*own, "hits") if groups == 1 else out.select(*own, by_item.alias("hits"))


def _mark_group(df: DataFrame, docs: DataFrame, items: list[tuple], text_col: str, rank: int | None, limits: tuple) -> DataFrame:
    """Adds the hits of a bounded list of items to the column ``hits``."""
    items = sorted(((i, t) for i, t in items if words_of(t)), key=lambda x: (x[0] is None, x))
    if not items:
        return df
    docs = docs.select(F.col(text_col).alias("text"))
    words = [words_of(t) for _, t in items]
    vocabulary = sorted({w for t in words for w in t})
    index = {w: i for i, w in enumerate(vocabulary)}
    size = max(2, round(float(np.median([len(w) for w in words])) / BLOCK)) * BLOCK
    with small_batches(df.sparkSession):
        encoded = reliable_checkpoint(encode_passages(docs, index, size), "svd-passages")
        counts, n = document_frequencies(encoded, len(vocabulary))
        idf = term_weights(counts, n, words, vocabulary)
        rank = rank or max(RANK, len(items) // ITEMS_PER_RANK)
        # items weigh as much as the documents, else the space would hold the corpus' common themes alone
        weight = max(1.0, ITEM_WEIGHT * n / len(items))
        own = encode_passages(df.sparkSession.createDataFrame([(" ".join(w),) for w in words], "text string").coalesce(1), index, size)
        latent = fit_latent(encoded.withColumn("weight", F.lit(1.0)).union(own.withColumn("weight", F.lit(weight))), idf, rank)
    model = df.sparkSession.sparkContext.broadcast((items, index, idf, latent, limits))

    @gives_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(*model.value)
        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("lcs", pa.float64()),
                                   ("answer", pa.float64()), ("word", pa.int32())]))
        for batch in batches:
            at_text, at_hits = (batch.schema.get_field_index(c) for c in (text_col, "hits"))
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts = part.column(at_text)
                found = list(searcher.hits(words_of(texts[i].as_py()) for i in range(len(texts))))
                hits = [old + new for old, new in zip(part.column(at_hits).to_pylist(), found)]
                columns = list(part.columns)
                columns[at_hits] = pa.array(hits, kind)
                yield pa.RecordBatch.from_arrays(columns, part.schema.names)

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, fields)
