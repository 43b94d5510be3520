"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decode.

Encoding. For ranked merges, a sequence of tokens is the encoding of its bytes exactly if every
neighbouring pair of tokens encodes to itself. Hence the last token of the encoding of every
prefix is the one vocabulary suffix that is compatible with the last token of the prefix
before it. The transducer reads a byte at a time and says which token ends there; its state is the
bytes from which a longer token may still grow, with the tokens that end at their starts. Tokens up to
the last boundary that all those starts share cannot change any more and are emitted. States and
transitions are built when first needed; beyond ``max_states`` all are dropped and built anew, so memory is bounded.
``encode_many`` moves many pre-tokens through the transducer at once, a byte at a time, in numpy.

Decoding. Tokens are byte strings that may end inside a character. ``Utf8Machine`` is
fed pieces of the byte stream and gives back what is complete, holding at most three bytes.
"""

from __future__ import annotations

import base64
import struct
import sys
from collections.abc import Iterable, Iterator
from functools import partial
from itertools import count

import numpy as np
import pyarrow as pa
import regex
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scholarspark.llm.chunk_ids import ChunkIds, joined_matches, spread
from scholarspark.llm.common import gives_back, worker_state

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: States kept (about 300 bytes each with their transitions), and pairs of tokens known to fit or not.
MAX_STATES, MAX_PAIRS = 160_000, 200_000
#: Longer pre-tokens go through the transducer alone.
TOGETHER = 64
#: Rows per record batch handed back to the JVM.
OUT_ROWS = 512

_BYTES = [bytes((b,)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file of base64 tokens and ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


def merge_bytes(ranks: dict[bytes, int], data: bytes) -> list[int]:
    """Encoding by the definition: merge the pair of lowest rank, leftmost first, while there is one."""
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > 1:
        best, at = None, -1
        for i in range(len(parts) - 1):
            r = ranks.get(parts[i] + parts[i + 1])
            if r is not None and (best is None or r < best):
                best, at = r, i
        if at < 0:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[p] for p in parts]


class Transducer:
    """Bytes of one pre-token to the ids of its tokens.

    A state is (start, end, start, end, ..., b"", last): the strings from which a token may still grow, longest first, each
    with the token that ends where it begins (-1: none, at the beginning); the last one has not begun.
    """

    def __init__(self, ranks: dict[bytes, int], max_states: int = MAX_STATES):
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.heads = {h: h for t in ranks for i in range(1, len(t)) for h in (t[:i],)}
        self.max_states = max_states
        self.sizes = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)
        self.halves: dict[int, tuple[int, int] | None] = {}
        self._empty()

    def _empty(self) -> None:
        """Forget all states and transitions."""
        self.pairs: dict[int, bool] = {}
        self.numbers: dict[tuple, int] = {}
        self.states: list[tuple] = []
        # transitions by state << 8 | byte, with open addressing: keys, next states, tokens
        self.keys, self.next = np.full(1 << 16, -1, np.int64), np.zeros((2, 1 << 16), np.int32)
        self.n_moves = 0
        self.start = self._number((b"", -1))

    def _number(self, state: tuple) -> int:
        n = self.numbers.setdefault(state, len(self.states))
        if n == len(self.states):
            self.states.append(state)
        return n

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte."""
        if token not in self.halves:
            parts = [self.ranks[bytes((b,))] for b in self.tokens[token]]
            while len(parts) > 2:
                joined = [self.ranks.get(self.tokens[x] + self.tokens[y]) for x, y in zip(parts, parts[1:])]
                at = min((r, i) for i, r in enumerate(joined) if r is not None)[1]
                parts[at:at + 2] = [joined[at]]
            self.halves[token] = tuple(parts) if len(parts) == 2 else None
        return self.halves[token]

    def _fits(self, left: int, right: int) -> bool:
        """Whether two tokens, one behind the other, are the encoding of their bytes (left -1: none).

        Take the border back in time: undo the merges next to it, the latest (highest rank; of equal ranks
        the right one, since merges run from the left) first. The tokens fit unless, at some moment, the
        two pieces at the border could have merged before the merge undone last.
        """
        if left < 0:
            return True
        key = left << 32 | right
        fits = self.pairs.get(key)
        if fits is not None:
            return fits
        fits, ranks, tokens = True, self.ranks, self.tokens
        until, later = len(ranks) + 1, False          # the merge undone last, and whether it lay to the right
        while True:
            joined = ranks.get(tokens[left] + tokens[right])
            if joined is not None and (joined < until or joined == until and later):
                fits = False
                break
            lh, rh = self._halves(left), self._halves(right)
            if lh is None and rh is None:
                break
            if rh is None or lh is not None and left > right:
                until, later, left = left, False, lh[1]
            else:
                until, later, right = right, True, rh[0]
        if len(self.pairs) >= MAX_PAIRS:
            self.pairs.clear()
        self.pairs[key] = fits
        return fits

    def _step(self, state: tuple, byte: bytes) -> tuple[tuple, int]:
        """The next state, and the last token of the encoding up to this byte."""
        token, kept = None, []
        for i in range(0, len(state), 2):
            grown = state[i] + byte
            if token is None:
                rank = self.ranks.get(grown)
                if rank is not None and self._fits(state[i + 1], rank):
                    token = rank
            head = self.heads.get(grown)
            if head is not None:
                kept += head, state[i + 1]
        return (*kept, b"", token), token

    def _back(self, lasts: list[int], at: int) -> list[int]:
        """Tokens of the encoding of the first ``at`` bytes."""
        out = []
        while at > 0:
            out.append(lasts[at - 1])
            at -= len(self.tokens[lasts[at - 1]])
        return out[::-1]

    def _settled(self, lasts: list[int], state: tuple) -> int:
        """The last boundary that every encoding still possible goes through."""
        open_ = {len(lasts) - len(start) for start in state[::2]} - {0}
        while len(open_) > 1:
            at = max(open_)
            open_.discard(at)
            open_.add(at - len(self.tokens[lasts[at - 1]]))
        return min(open_)

    def encode(self, data: bytes, window: int = 4096) -> bytes:
        """Little-endian 32-bit ids of one pre-token of any length. Tokens are emitted behind a bounded lookahead, at the latest
        after a window, and transitions are forgotten as often, so memory does not grow with the pre-token."""
        whole = self.ranks.get(data)
        if whole is not None:
            return struct.pack("<I", whole)
        state, lasts, out, known = (b"", -1), [], [], {}
        for at in range(len(data)):
            byte = data[at:at + 1]
            move = known.get((state, byte))
            if move is None:
                move = known[state, byte] = self._step(state, byte)
            state, last = move
            lasts.append(last)
            if len(lasts) >= window:
                done = self._settled(lasts, state)
                out += self._back(lasts, done)
                del lasts[:done]
                known.clear()
        out += self._back(lasts, len(lasts))
        return struct.pack(f"<{len(out)}I", *out)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        """For each key its slot in the table of transitions, or the free one where it would go."""
        mask = len(self.keys) - 1
        slots = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)).astype(np.int64) & mask
        there = self.keys[slots]
        going = np.flatnonzero((there != keys) & (there >= 0))
        while len(going):
            slots[going] = (slots[going] + 1) & mask
            there = self.keys[slots[going]]
            going = going[(there != keys[going]) & (there >= 0)]
        return slots

    def _learn(self, keys: np.ndarray) -> None:
        """Build the transitions of new keys."""
        made = []
        for key in keys.tolist():
            state, token = self._step(self.states[key >> 8], _BYTES[key & 255])
            made.append((self._number(state), token))
        moves = np.array(made, np.int32).T
        self.n_moves += len(keys)
        if 3 * self.n_moves > 2 * len(self.keys):
            held = self.keys >= 0
            keys, moves = np.append(self.keys[held], keys), np.append(self.next[:, held], moves, axis=1)
            size = len(self.keys)
            while 3 * self.n_moves > 2 * size:
                size *= 2
            self.keys, self.next = np.full(size, -1, np.int64), np.zeros((2, size), np.int32)
        while len(keys):                                           # of keys that want the same slot the last one gets it
            slots = self._slots(keys)
            self.keys[slots] = keys
            own = self.keys[slots] == keys
            self.next[:, slots[own]] = moves[:, own]
            keys, moves = keys[~own], moves[:, ~own]

    def _walk(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens of at most ``TOGETHER`` bytes, one behind the other, and how many each has."""
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        data = np.frombuffer(b"".join(pieces), np.uint8).astype(np.int64)
        first = np.cumsum(sizes) - sizes
        order = np.argsort(-sizes, kind="stable")
        state, lasts = np.full(len(pieces), self.start, np.int64), np.zeros(len(data), np.int64)
        alive = np.searchsorted(-sizes[order], -np.arange(int(sizes.max(initial=0))), "left")     # pieces longer than k
        for k, n in enumerate(alive.tolist()):
            at = first[order[:n]] + k
            keys = state[:n] << 8 | data[at]
            slots = self._slots(keys)
            missing = self.keys[slots] != keys
            if missing.any():
                self._learn(np.unique(keys[missing]))
                slots = self._slots(keys)
            state[:n], lasts[at] = self.next[0][slots], self.next[1][slots]
        # back from the ends: a token a round
        left, ends, rounds = np.flatnonzero(sizes), first + sizes, []
        while len(left):
            tokens = lasts[ends[left] - 1]
            rounds.append((left, tokens))
            ends[left] -= self.sizes[tokens]
            left = left[ends[left] > first[left]]
        counts = np.zeros(len(pieces), np.int64)
        for who, _ in rounds:
            counts[who] += 1
        out, last = np.zeros(int(counts.sum()), np.int64), np.cumsum(counts) - 1
        for r, (who, tokens) in enumerate(rounds):
            out[last[who] - r] = tokens
        return out, counts

    def encode_many(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pre-tokens, one behind the other, and how many each has."""
        if len(self.states) > self.max_states:
            self._empty()
        whole = np.fromiter((self.ranks.get(p, -1) for p in pieces), np.int64, len(pieces))
        counts, parts = np.ones(len(pieces), np.int64), np.flatnonzero(whole < 0)
        together = [i for i in parts.tolist() if len(pieces[i]) <= TOGETHER]
        ids, sizes = self._walk([pieces[i] for i in together])
        counts[together] = sizes
        alone = {i: np.frombuffer(self.encode(pieces[i]), "<u4").astype(np.int64) for i in parts.tolist() if len(pieces[i]) > TOGETHER}
        for i, own in alone.items():
            counts[i] = len(own)
        first = np.cumsum(counts) - counts
        out = np.zeros(int(counts.sum()), np.int64)
        out[first[whole >= 0]] = whole[whole >= 0]
        out[spread(first[together], sizes)] = ids
        for i, own in alone.items():
            out[first[i]:first[i] + len(own)] = own
        return out, counts


def chunk_encoder(ranks: dict[bytes, int], pattern: str) -> ChunkIds:
    """Encodes texts: chunks are cut by the pattern, the pre-tokens go through the transducer."""
    machine, findall = Transducer(ranks), regex.compile(pattern).findall

    def encode_many(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        pieces, per_chunk = joined_matches(findall, chunks)
        distinct: dict[str, int] = {}
        codes = np.fromiter(map(distinct.setdefault, pieces, count()), np.int64, len(pieces))
        first = np.zeros(len(pieces), np.int64)
        first[np.fromiter(distinct.values(), np.int64, len(distinct))] = np.arange(len(distinct))
        codes = first[codes]
        ids, counts = machine.encode_many([p.encode("utf-8") for p in distinct])
        ends = np.append(0, np.cumsum(counts[codes]))
        cuts = np.append(0, np.cumsum(per_chunk))
        return ids[spread((np.cumsum(counts) - counts)[codes], counts[codes])], np.diff(ends[cuts])

    return ChunkIds(encode_many)


class Utf8Machine:
    """Incremental UTF-8: ``feed`` gives the longest complete part of what came so far."""

    def __init__(self) -> None:
        self.held = b""

    @staticmethod
    def missing(data: bytes) -> int:
        """Bytes at the end of ``data`` that begin a character not yet complete."""
        for back in range(1, min(3, len(data)) + 1):
            b = data[-back]
            if b & 0xC0 == 0x80:            # continuation: the lead byte is further left
                continue
            need = 2 if b & 0xE0 == 0xC0 else 3 if b & 0xF0 == 0xE0 else 4 if b & 0xF8 == 0xF0 else 1
            return back if need > back else 0
        return 0

    def feed(self, data: bytes) -> bytes:
        data = self.held + data
        n = self.missing(data)
        self.held = data[len(data) - n:] if n else b""
        return data[:len(data) - n] if n else data

    def close(self) -> bytes:
        """What is left; empty for well-formed text."""
        rest, self.held = self.held, b""
        return rest


class Vocabulary:
    """Bytes of the tokens, for gathering those of many ids at once."""

    def __init__(self, ranks: dict[bytes, int]):
        self.sizes = np.zeros(max(ranks.values(), default=0) + 1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)
        self.starts = np.cumsum(self.sizes) - self.sizes
        tokens = [b""] * len(self.sizes)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.known = np.array([bool(t) for t in tokens])
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def bytes_of(self, ids: np.ndarray) -> bytes:
        if len(ids) and (int(ids.max()) >= len(self.known) or not self.known[ids].all()):
            raise KeyError("an id is not in the vocabulary")
        return self.data[spread(self.starts[ids], self.sizes[ids])].tobytes()


def decode_stream(vocabulary: Vocabulary, ids: Iterable[bytes]) -> Iterator[str]:
    """Text of a stream of id blocks (little-endian 32-bit), characters never cut in two."""
    machine = Utf8Machine()
    for block in ids:
        whole = machine.feed(vocabulary.bytes_of(np.frombuffer(block, "<u4")))
        if whole:
            yield whole.decode("utf-8", "replace")
    rest = machine.close()
    if rest:
        yield rest.decode("utf-8", "replace")


def _ranks(path: str) -> dict[bytes, int]:
    return worker_state(("bpe", "ranks", path), lambda: read_ranks(path))


def _vocabulary(path: str) -> Vocabulary:
    return worker_state(("bpe", "vocabulary", path), lambda: Vocabulary(_ranks(path)))


def _decoded(vocabulary: Vocabulary, ids: list, block: int) -> pa.Array:
    return pa.array(["".join(decode_stream(vocabulary, (x[i:i + block] for i in range(0, len(x), block)))) if x else "" for x in ids],
                    pa.string())


#: Bytes of ids decoded at a time.
STREAM_BLOCK = 1 << 18


def encode_documents(df: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id",
                     text_col: str = "text", decoded: bool = False) -> DataFrame:
    """(id, n_tokens, ids): every text encoded whole, ids as little-endian unsigned 32-bit integers. With ``decoded`` also
    the string that the ids decode to, from the same pass.

    One pass, no shuffle. Null text counts as empty and gives no ids; repeated rows, null or repeated ids
    and other columns are of no concern (rows are encoded one by one, only id and text are read).
    ``ranks_path`` must be readable on the executors.
    """
    @partial(gives_back, keep="bpe")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = worker_state(("bpe", "chunks", ranks_path, pattern), lambda: chunk_encoder(_ranks(ranks_path), pattern))
        for batch in batches:
            for at in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(at, OUT_ROWS)
                ids, counts = chunks.encode(part.column(1).to_pylist())
                ends = (np.append(0, np.cumsum(counts)) * 4).astype(np.int32)
                data = pa.py_buffer(ids.astype("<u4"))
                own = pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(ends), data])
                columns = [part.column(0), pa.array(counts), own]
                if decoded:
                    columns.append(_decoded(_vocabulary(ranks_path), own.to_pylist(), STREAM_BLOCK))
                yield pa.RecordBatch.from_arrays(columns, ["id", "n_tokens", "ids", "decoded"][:len(columns)])

    kind = df.schema[id_col].dataType.simpleString()
    return (df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
              .mapInArrow(run, f"id {kind}, n_tokens bigint, ids binary" + ", decoded string" * decoded).withColumnRenamed("id", id_col))


def decode_documents(df: DataFrame, ranks_path: str, ids_col: str = "ids", block: int = STREAM_BLOCK) -> DataFrame:
    """Adds ``decoded`` (string): the ids decoded as a stream of blocks. Null ids decode to an empty text; a column named
    ``decoded`` is replaced."""
    df = df.drop("decoded")

    @partial(gives_back, keep="bpe")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(ids_col)
            for first in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(first, OUT_ROWS)
                texts = _decoded(_vocabulary(ranks_path), part.column(at).to_pylist(), block)
                yield pa.RecordBatch.from_arrays([*part.columns, texts], [*part.schema.names, "decoded"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    return df.mapInArrow(run, f"{fields}, decoded string")
