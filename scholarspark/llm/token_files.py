"""Token ids as Parquet files laid out for selective reads.

Layout: one row per document in ascending id order over all files: (id, part, start_in_part, n_tokens, ids).
``ids`` is a list column, dictionary-encoded while its dictionary page holds (the whole vocabulary does) and
delta-encoded beyond (format v2); the metadata columns are separate chunks, so they are read without
the tokens. Row groups are small and pages bounded in rows, with the page indexes Parquet writes,
so a range of ids reads few pages. The position of a document among all tokens is start_in_part plus the
tokens of the files before its own, a sum over one number a file.
"""

from __future__ import annotations

import os
import re
import sys
import zlib
from collections.abc import Iterator
from itertools import chain
from operator import attrgetter

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from scholarspark.llm.chunk_ids import ChunkIds, IdTable, joined_matches, segments, spread
from scholarspark.llm.common import worker_state
from scholarspark.session import reliable_checkpoint

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Entries a worker keeps in its tables of encoded pieces, and of chunks of texts that are not cut here (about 200 bytes each).
CHUNK_CACHE = 100_000
PIECE_CACHE = 1_000_000
#: Rows of an Arrow batch that is handed back, and characters that are cut together.
ROWS, CHARS = 2048, 4_000_000
#: Offsets of so many files are broadcast (16 bytes each); of more they are joined.
MOST_FILES = 500_000

#: Options of the Parquet writer: format v2 (delta encodings), dictionary of up to 1 MB, row groups of 32 MB,
#: pages of at most 256 KB or 2,000 rows.
LAYOUT = {
    "parquet.writer.version": "v2",
    "parquet.enable.dictionary": "true",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "compression": "zstd",
}


#: The pattern whose matches ``latin_pieces`` gives.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Behind each text that is cut; a piece of its own.
END = "\x1f"
_SPACE, _LETTER, _NUMBER, _OTHER, _END = range(5)
_KINDS = np.array([_END if chr(c) == END else next(k for k, p in enumerate((r"\s", r"\p{L}", r"\p{N}", ".")) if regex.match(p, chr(c), regex.S))
                   for c in range(0x250)], np.uint8)

_id_of = attrgetter("id")


def latin_pieces(joined: str) -> tuple[pa.StringArray, np.ndarray]:
    """The matches of ``BYTE_LEVEL`` in texts that each end in ``END``, and the places of these ends among them. Characters up to
    U+024F. Which characters begin a match follows from them and their neighbours."""
    data = joined.encode("utf-8")
    chars = np.frombuffer(data, np.uint8) if joined.isascii() else np.frombuffer(joined.encode("utf-32-le"), "<u4")
    kind = _KINDS.take(chars)
    before, after = np.append(np.uint8(_END), kind[:-1]), np.append(kind[1:], np.uint8(_END))
    begins = before != kind
    begins[1:] &= (kind[1:] == _SPACE) | (chars[:-1] != 32)        # a blank belongs to what follows it,
    begins |= (kind == _SPACE) & (after != _SPACE) & (after != _END)   # so the last of some white space stands alone
    begins |= kind == _END
    quote = np.flatnonzero(begins & (chars == 39))
    one, two = (chars[np.minimum(quote + k, len(chars) - 1)] for k in (1, 2))
    for ending, size in ((np.isin(one, list(b"stmd")), 2), (np.isin(one, list(b"rv")) & (two == 101) | (one == 108) & (two == 108), 3)):
        begins[quote[ending] + 1] = False
        begins[quote[ending] + size] = True
    first = np.flatnonzero(begins)
    ends = np.flatnonzero(kind[first] == _END)
    if len(data) > len(chars):
        first = (np.cumsum(1 + (chars >= 128)) - 1 - (chars >= 128))[first]
    offsets = np.append(first, len(data)).astype(np.int32)
    return pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(data)), ends


def _byte_letters() -> dict[int, str]:
    """The printable letter byte-level vocabularies write for each byte: printable Latin-1 for itself, the
    others from U+0100 on in order."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class Library:
    """Ids by the tokenizers library for many texts at once.

    Latin texts without special strings are cut by the byte-level pattern and each distinct piece goes to the library's model
    while it is not known; other texts (with another pattern, all) are cut into chunks, of which those that are not Latin go
    through the library whole.
    """

    def __init__(self, path: str, pattern: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        self.cut = pattern == BYTE_LEVEL
        self.findall = regex.compile(pattern).findall
        self.letters = _byte_letters()
        self.special = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.odd = re.compile("|".join(["[^\x00-\u024f]", *map(re.escape, self.special)])).search
        self.apart = re.compile("|".join(["[^\x00-\x1b\x20-\x84\x86-\u024f]", *map(re.escape, self.special)])).search
        self.pieces = IdTable(self._model, PIECE_CACHE)
        self.chunks = ChunkIds(self._chunk_ids, CHUNK_CACHE)

    def _model(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        run = self.tok.model.tokenize
        found = [run(p) for p in END.join(pieces).encode("utf-8").decode("latin-1").translate(self.letters).split(self.letters[ord(END)])]
        if len(found) != len(pieces):                              # pieces that hold the mark
            found = [run(p.encode("utf-8").decode("latin-1").translate(self.letters)) for p in pieces]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(map(_id_of, chain.from_iterable(found)), np.int64, int(counts.sum())), counts

    def _chunk_ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        odd = np.fromiter((self.odd(c) is not None for c in chunks), bool, len(chunks))
        pieces, per_chunk = joined_matches(self.findall, [c for c, o in zip(chunks, odd) if not o])
        ids, per_piece = self.pieces.ids(pieces)
        counts = np.zeros(len(chunks), np.int64)
        counts[~odd] = np.diff(np.append(0, np.cumsum(per_piece))[np.append(0, np.cumsum(per_chunk))])
        if not odd.any():
            return ids, counts
        whole = [e.ids for e in self.tok.encode_batch_fast([c for c, o in zip(chunks, odd) if o], add_special_tokens=False)]
        counts[odd] = [len(w) for w in whole]
        first = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.int64)
        out[spread(first[~odd], counts[~odd])] = ids
        out[spread(first[odd], counts[odd])] = [i for w in whole for i in w]
        return out, counts

    def _latin(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        pieces, ends = latin_pieces(END.join([*texts, ""]))
        told = pieces.dictionary_encode()
        keys = told.dictionary.to_numpy(zero_copy_only=False).tolist()
        keys[keys.index(END)] = ""                                 # has no ids
        ids, per_piece = self.pieces.ids(keys, told.indices.to_numpy())
        return ids, np.diff(np.append(0, np.cumsum(per_piece)[ends]))

    def _apart(self, texts: list[str]) -> np.ndarray:
        """Whether each text is to be cut into chunks."""
        joined = "".join(texts)
        if not any(s in joined for s in (*self.special, "\x1c", "\x1d", "\x1e", END, "\x85")):
            if joined.isascii() or int(np.frombuffer(joined.encode("utf-32-le"), "<u4").max()) < len(_KINDS):
                return np.zeros(len(texts), bool)
        return np.fromiter((self.apart(t) is not None for t in texts), bool, len(texts))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one behind the other, and how many each has. Null counts as empty."""
        if not self.cut:
            return self.chunks.encode(texts)
        counts = np.zeros(len(texts), np.int64)
        out: list[np.ndarray] = [np.zeros(0, np.int32)]
        held: list[str] = []
        owner: list[int] = []
        size = 0

        def add() -> None:
            apart = self._apart(held)
            if apart.any():
                parts = [f([t for t, a in zip(held, apart) if a == which]) for which, f in ((False, self._latin), (True, self.chunks.encode))]
                sizes = np.zeros(len(held), np.int64)
                sizes[~apart], sizes[apart] = parts[0][1], parts[1][1]
                first = np.cumsum(sizes) - sizes
                ids = np.zeros(int(sizes.sum()), np.int32)
                for which, (own, n) in zip((~apart, apart), parts):
                    ids[spread(first[which], n)] = own
            else:
                ids, sizes = self._latin(held)
            np.add.at(counts, owner, sizes)
            out.append(ids)

        for i, text in enumerate(texts):
            for part in segments(text) if text else ():
                held.append(part)
                owner.append(i)
                size += len(part)
                if size >= CHARS:
                    add()
                    held, owner, size = [], [], 0
        if held:
            add()
        return np.concatenate(out), counts


def library_encoder(path: str, pattern: str) -> Library:
    return Library(path, pattern)


def write_tokens(df: DataFrame, path: str, tokenizer_path: str, pattern: str, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text", num_partitions: int | None = None) -> None:
    """Encode every whole text, append ``end_id`` and write the files of the layout above to ``path``.

    One shuffle (documents by ranges of id). Null and empty texts hold the end id alone; null ids come first;
    rows that share an id are ordered by text, equal rows stay as often as they occur; other columns are not read.
    """
    spark = df.sparkSession
    n = num_partitions or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        library = worker_state(("library", tokenizer_path, pattern), lambda: library_encoder(tokenizer_path, pattern))
        start = 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids, sizes = library.encode(part.column(1).to_pylist())
                ids, sizes = np.insert(ids, np.cumsum(sizes), end_id).astype(np.int32), sizes + 1
                ends = np.cumsum(sizes)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(start + ends - sizes), pa.array(sizes), lists],
                    ["id", "part", "start_in_part", "n_tokens", "ids"])
                start += int(ends[-1])

    kind = df.schema[id_col].dataType.simpleString()
    (df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
       .repartitionByRange(n, F.col("id").asc_nulls_first(), F.xxhash64("text"))
       .sortWithinPartitions(F.col("id").asc_nulls_first(), F.col("text").asc_nulls_first())
       .withColumn("part", F.spark_partition_id())
       .mapInArrow(run, f"id {kind}, part int, start_in_part bigint, n_tokens bigint, ids array<int>")
       .write.options(**LAYOUT).parquet(path))


def read_tokens(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids) from the files; filters on the id and column choice reach the scan."""
    files = spark.read.parquet(path)
    sums = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))           # one row a file
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = reliable_checkpoint(sums.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")), "token-offsets")
    if offsets.count() <= MOST_FILES:                  # 16 bytes each; the ids stay where they are read
        offsets = F.broadcast(offsets)
    return files.join(offsets, "part").select(
        F.col("id").alias(id_col), (F.col("offset") + F.col("start_in_part")).alias("start"), "n_tokens", "ids")


def ids_crc32(df: DataFrame, ids_col: str = "ids") -> DataFrame:
    """Replaces the id list by ``ids_crc32``: of the ids as little-endian unsigned 32-bit integers."""
    others = [f for f in df.schema if f.name != ids_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index(ids_col))
            values = memoryview(np.ascontiguousarray(ids.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            cuts = ids.offsets.to_numpy().astype(np.int64) * 4
            crc = [zlib.crc32(values[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(f.name)) for f in others), pa.array(crc, pa.int64())],
                [*(f.name for f in others), "ids_crc32"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)
    return df.select(*(f.name for f in others), ids_col).mapInArrow(run, f"{fields}, ids_crc32 bigint")
