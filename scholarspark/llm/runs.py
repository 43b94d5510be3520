"""Periodic runs of words, by string synchronising sets, and texts with the repetitions collapsed.

A run is a stretch of words with smallest period q that neither neighbour extends and that repeats often enough:
``exponent`` times q, and ``least`` words. Texts are looked at whole, several short ones together, and none leaves its
task; memory grows with the longest text (about 200 bytes a word).

Periods under ``SMALL`` are found as highly periodic regions, stretches equal to themselves shifted by the period. Longer
ones come from synchronising sets at the scales SMALL, 2 SMALL, 4 SMALL, ...: of the windows of t words, position i is chosen if
the least window hash among i..i+t is that of i or of i+t. Windows inside regions already found with a period of at most t/4 do not take
part, so periodic stretches do not fill the set. Whether i is chosen depends on the 2t words from i alone, and
among any t positions one is chosen unless their windows are highly periodic. So a run of period q, t <= q < 2t, that is at
least 4q long holds a chosen position whose context of 2t words comes again exactly q further on: neighbours in the
order of (context, position) propose q, and the words themselves decide how far the run reaches. No proposal is trusted,
and none is missed unless 64-bit hashes of different windows collide.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: First scale: a power of two, 8 or more. Smaller periods are compared directly.
SMALL = 8
LEAST, EXPONENT = 6, 4
#: Words looked at together; a longer text is alone.
BATCH_WORDS = 300_000

_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def words_of(text: str | None) -> list[bytes]:
    """Words between blanks, tabs and U+000A..U+000D, in UTF-8 (bytes know no other white space)."""
    return text.encode("utf-8").split() if text else []


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Hash of two windows, one behind the other."""
    out = left * _A + (right ^ (right >> np.uint64(29))) * _B
    return out ^ (out >> np.uint64(32))


def _least_ahead(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each value and the width - 1 behind it, by running minima inside blocks."""
    n = len(values)
    padded = np.full((-(-n // width) + 1) * width, _TOP)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def _reach(x: np.ndarray, at: int, period: int) -> tuple[int, int]:
    """The longest stretch around ``at`` that keeps the period; different neighbours stand at both ends of ``x``."""
    end, step = at + period, 64
    while True:
        differ = x[end:end + step] != x[end - period:end - period + len(x[end:end + step])]
        k = int(differ.argmax())
        if differ[k]:
            end += k
            break
        end, step = end + len(differ), 2 * step
    start, step = at, 64
    while start > 0:
        n = min(step, start)
        differ = np.flatnonzero(x[start - n:start] != x[start - n + period:start + period])
        if len(differ):
            start -= n - 1 - int(differ[-1])
            break
        start, step = start - n, 2 * step
    return start, end


class Finder:
    """The runs of a batch of texts, given as word numbers."""

    def __init__(self, texts: list[np.ndarray], least: int = LEAST, exponent: int = EXPONENT):
        self.least, self.exponent = least, exponent
        self.found: dict[tuple[int, int, int], int] = {}        # (text, first word, end): smallest period
        self.lengths = np.array([len(t) for t in texts], np.int64)
        # every text is followed by a number of its own, and one stands in front
        self.x = np.concatenate([[-1], *[part for d, t in enumerate(texts) for part in (t, [-2 - d])]]).astype(np.int64)
        self.first = 1 + np.cumsum(self.lengths + 1) - (self.lengths + 1)

    def _keep(self, first: np.ndarray, text: int, start: int, end: int, period: int) -> None:
        if end - start >= max(self.least, self.exponent * period):
            at = int(first[text])
            key = (text, start - at, end - at)
            self.found[key] = min(period, self.found.get(key, period))

    def regions(self) -> None:
        """Runs of the small periods: stretches that equal themselves shifted."""
        for period in range(1, SMALL):
            if len(self.x) <= period:
                break
            same = np.flatnonzero(self.x[:-period] == self.x[period:])
            if not len(same):
                continue
            cut = np.flatnonzero(np.diff(same) > 1)
            starts, ends = same[np.append(0, cut + 1)], same[np.append(cut, len(same) - 1)] + 1 + period
            long = ends - starts >= max(self.least, self.exponent * period)
            for a, b in zip(starts[long].tolist(), ends[long].tolist()):
                self._keep(self.first, int(np.searchsorted(self.first, a, "right")) - 1, a, b, period)

    def scales(self) -> None:
        """Runs of the other periods, scale by scale; each takes only texts long enough for a run of its periods."""
        x, lengths, texts = self.x, self.lengths, np.arange(len(self.lengths))
        first = self.first
        windows = _joined(x.astype(np.uint64), x.astype(np.uint64) * _B)
        size, t = 1, SMALL
        while len(lengths) and int(lengths.max()) >= self.exponent * t:
            while size < t:
                windows = np.append(_joined(windows[:-size], windows[size:]), np.full(size, _TOP))
                size *= 2
            keep = lengths >= self.exponent * t
            if not keep.all():
                mask = np.concatenate([[True], np.repeat(keep, lengths + 1)])
                x, windows, lengths, texts = x[mask], windows[mask], lengths[keep], texts[keep]
                first = 1 + np.cumsum(lengths + 1) - (lengths + 1)
            wider = np.append(_joined(windows[:-t], windows[t:]), np.full(t, _TOP))
            self._scale(t, x, windows, wider, first, lengths, texts)
            windows, size, t = wider, 2 * t, 2 * t

    def _scale(self, t: int, x: np.ndarray, windows: np.ndarray, contexts: np.ndarray, first: np.ndarray, lengths: np.ndarray,
               texts: np.ndarray) -> None:
        room = np.zeros(len(x), np.int64)                        # words from here to the end of the text
        room[1:] = np.repeat(first + lengths, lengths + 1) - np.arange(1, len(x))
        windows = windows.copy()
        place = {int(d): k for k, d in enumerate(texts)}
        inside = [(int(first[place[d]]) + a, int(first[place[d]]) + b) for (d, a, b), q in self.found.items()
                  if 4 * q <= t <= b - a and d in place]
        if inside:                                               # windows in highly periodic regions
            edges = np.zeros(len(x) + 1, np.int64)
            for a, b in inside:
                edges[a] += 1
                edges[b - t + 1] -= 1
            windows[np.cumsum(edges)[:-1] > 0] = _TOP
        windows[room < t] = _TOP
        least = _least_ahead(windows, t + 1)
        far = np.append(windows[t:], np.full(t, _TOP))
        chosen = np.flatnonzero((room >= 2 * t) & (least != _TOP) & ((least == windows) | (least == far)))
        order = chosen[np.argsort(contexts[chosen], kind="stable")]
        gap = np.diff(order)
        near = np.flatnonzero((contexts[order[1:]] == contexts[order[:-1]]) & (gap >= t) & (gap < 2 * t))
        proposals = np.stack([gap[near], order[near]], axis=1)
        proposals = proposals[np.lexsort((proposals[:, 1], proposals[:, 0]))]
        period, end = 0, 0
        for q, at in proposals.tolist():
            if q == period and at + q < end:                     # in the stretch looked at last
                continue
            period, (start, end) = q, _reach(x, at, q)
            k = int(np.searchsorted(first, at, "right")) - 1
            self._keep_from(first, k, int(texts[k]), start, end, q)

    def _keep_from(self, first: np.ndarray, k: int, text: int, start: int, end: int, period: int) -> None:
        shift = int(self.first[text]) - int(first[k])
        self._keep(self.first, text, start + shift, end + shift, period)

    def runs(self) -> list[list[tuple[int, int, int]]]:
        """(start, length, period) of each text, by start and period."""
        self.regions()
        self.scales()
        out: list[list[tuple[int, int, int]]] = [[] for _ in self.lengths]
        for (d, a, b), q in self.found.items():
            out[d].append((a, b - a, q))
        return [sorted(r, key=lambda r: (r[0], r[2])) for r in out]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that some run holds behind its first period, joined by blanks."""
    if runs:
        drop = np.zeros(len(words), bool)
        for start, length, period in runs:
            drop[start + period:start + length] = True
        words = [w for w, gone in zip(words, drop.tolist()) if not gone]
    return b" ".join(words)


def find_runs(df: DataFrame, text_col: str = "text", least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """The columns of ``df`` without the text, with ``n_words``, ``runs`` (start, length and period in words, by start, then period) and
    ``collapsed``, the text without the words that a run repeats, joined by blanks.

    One pass, no shuffle; rows are independent, so repeated rows and ids and null ids are of no concern. Null,
    empty and blank texts have no words, no runs and collapse to an empty text. Columns named like those added are replaced.
    """
    if exponent < 4 or least < exponent:
        raise ValueError("scales assume that a run holds its period four times or more")
    added = ("n_words", "runs", "collapsed")
    own = [f for f in df.schema if f.name not in (*added, text_col)]
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def batch_runs(texts: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
        numbers: dict[bytes, int] = {}
        fresh = count()
        return Finder([np.fromiter(map(numbers.setdefault, w, fresh), np.int64, len(w)) for w in texts], least, exponent).runs()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                held, size, first = [], 0, at
                while at < batch.num_rows and (not held or size < BATCH_WORDS and len(held) < 2048):
                    held.append(words_of(batch.column(0)[at].as_py()))
                    size += len(held[-1])
                    at += 1
                runs = batch_runs(held)
                rows = batch.slice(first, at - first)
                texts = pa.array([collapse(w, r).decode("utf-8") for w, r in zip(held, runs)], pa.string())
                listed = [[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in runs]
                yield pa.RecordBatch.from_arrays([*rows.columns[1:], pa.array([len(w) for w in held], pa.int64()), pa.array(listed, kind), texts],
                                                 [*(f.name for f in own), *added])

    fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in own)
    return df.select(F.col(text_col), *[F.col(f"`{f.name}`") for f in own]).mapInArrow(
        run, f"{fields}n_words bigint, runs {RUNS}, collapsed string")
