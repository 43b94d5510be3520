"""Token ids of many texts at once: each distinct chunk (white space and the word behind it) is encoded once, all
texts are then put together from the ids of their chunks by numpy."""

from __future__ import annotations

import re
import sys
from collections.abc import Callable, Iterator
from itertools import count, repeat

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

from scholarspark.llm.common import spaced_chunks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: White space, then something else, no separators that libraries class differently.
is_plain = re.compile(r"[ \n\t][^\x1c-\x1f\x85]*[^\s\x1c-\x1f\x85]", re.DOTALL).fullmatch

#: Chunks and ids a worker keeps (about 200 bytes a chunk); beyond that its tables are emptied and fill again.
CHUNKS, IDS = 200_000, 3_000_000
#: Longer chunks are not kept.
KEPT_CHARS = 256
#: Characters looked at together; longer texts are cut between chunks.
CHARS = 800_000


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions starts[i], starts[i] + 1, ... of every slice, one behind the other."""
    ends = np.cumsum(lengths)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def segments(text: str) -> Iterator[str]:
    """A text in parts of about ``CHARS`` characters, cut where white space follows something else."""
    if len(text) <= CHARS or any(c in text for c in "\x1c\x1d\x1e\x1f"):
        yield text
        return
    at = 0
    while at < len(text):
        end = at + CHARS
        while end < len(text) and not (text[end] in " \n\t" and not text[end - 1].isspace()):
            end += 1
        yield text[at:end]
        at = end


class IdTable:
    """Ids of strings, each distinct one encoded once while it is kept. ``encode_many`` gives for a list of strings their
    ids, one behind the other, and how many each has."""

    def __init__(self, encode_many: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], strings: int = CHUNKS, ids: int = IDS):
        self.encode_many, self.most_strings, self.most_ids = encode_many, strings, ids
        self.clear()

    def clear(self) -> None:
        self.table: dict[str, int] = {}
        self.values, self.starts, self.lengths = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def ids(self, strings: list[str], order: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all strings, one behind the other, and how many each has. With ``order``, of those that it names; each of
        ``strings`` stands there once then."""
        if len(self.table) > self.most_strings or len(self.values) > self.most_ids:
            self.clear()
        base = len(self.lengths)
        if order is None:
            codes = np.fromiter(map(self.table.setdefault, strings, count(base)), np.int64, len(strings))
            fresh = codes >= base
            first = np.unique(codes[fresh]) - base                # where each new string stands first
        else:                                                     # each stands once
            codes = np.fromiter(map(self.table.get, strings, repeat(base)), np.int64, len(strings))
            fresh = codes >= base
            first = np.flatnonzero(fresh)
        new = [strings[i] for i in first.tolist()]
        if new:
            if order is None:
                place = np.zeros(len(strings), np.int64)
                place[first] = np.arange(base, base + len(new))
                codes[fresh] = place[codes[fresh] - base]
            else:
                codes[fresh] = np.arange(base, base + len(new))
            ids, lengths = self.encode_many(new)
            self.starts = np.append(self.starts, len(self.values) + np.cumsum(lengths) - lengths)
            self.lengths = np.append(self.lengths, lengths)
            self.values = np.append(self.values, ids.astype(np.int32))
            self.table.update(zip(new, range(base, base + len(new))))
            for string in new if max(map(len, new)) > KEPT_CHARS else ():
                if len(string) > KEPT_CHARS:
                    del self.table[string]
        lengths = self.lengths[codes]
        ids = self.values[spread(self.starts[codes], lengths)]
        if order is None:
            return ids, lengths
        lists = pa.ListArray.from_arrays(np.append(0, np.cumsum(lengths)).astype(np.int32), ids).take(pa.array(order))
        return lists.flatten().to_numpy(), lengths[order]


class ChunkIds:
    """Ids of texts from those of their chunks."""

    def __init__(self, encode_many: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], chunks: int = CHUNKS):
        self.chunks = IdTable(encode_many, chunks)

    def _part(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        listed: list[str] = []
        sizes = [0]
        for text in texts:
            chunks = spaced_chunks(text)
            listed += [text] if chunks is None else chunks
            sizes.append(len(listed))
        ids, per_chunk = self.chunks.ids(listed)
        return ids, np.diff(np.append(0, np.cumsum(per_chunk))[sizes])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one behind the other, and how many each has. Null counts as empty."""
        ids, counts = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64)
        held: list[str] = []
        owner: list[int] = []
        size = 0
        for i, text in enumerate(texts):
            for part in segments(text) if text else ():
                held.append(part)
                owner.append(i)
                size += len(part)
                if size >= CHARS:
                    ids.append(self._add(held, owner, counts))
                    held, owner, size = [], [], 0
        if held:
            ids.append(self._add(held, owner, counts))
        return np.concatenate(ids), counts

    def _add(self, parts: list[str], owner: list[int], counts: np.ndarray) -> np.ndarray:
        ids, sizes = self._part(parts)
        np.add.at(counts, owner, sizes)
        return ids


def joined_matches(findall: Callable[[str], list[str]], chunks: list[str]) -> tuple[list[str], np.ndarray]:
    """All matches of a pre-tokenisation pattern in the chunks, in order, and how many each chunk has. Chunks of white space
    and a word are matched in one string, since no match crosses from one to the next; others one by one."""
    plain = [is_plain(c) is not None for c in chunks]
    together = [c for c, p in zip(chunks, plain) if p]
    found = findall("".join(together))
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
    if len(ends) and int(ends[-1]) == sum(map(len, together)):
        counts = np.diff(np.append(0, np.searchsorted(ends, np.cumsum(np.fromiter(map(len, together), np.int64, len(together))), "right")))
    else:                                                          # the pattern leaves characters out
        each = [findall(c) for c in together]
        found, counts = [m for ms in each for m in ms], np.array([len(ms) for ms in each], np.int64)
    if len(together) == len(chunks):
        return found, counts
    out, sizes, at, k = [], np.zeros(len(chunks), np.int64), 0, 0
    for i, (chunk, p) in enumerate(zip(chunks, plain)):
        if p:
            sizes[i] = counts[k]
            out += found[at:at + int(counts[k])]
            at, k = at + int(counts[k]), k + 1
        else:
            own = findall(chunk)
            sizes[i] = len(own)
            out += own
    return out, sizes
