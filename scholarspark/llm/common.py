"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import json
import re
import sys
import types
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import wraps

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# functions run in Python workers travel by value, so executors need not have the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, whole; any path that Spark's readers can open."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def row_key(id_col: str, text_col: str) -> Column:
    """Digest naming a row by id and text (nulls told apart from empty texts). Rows that share it are
    alike in both, so results computed per key hold for each of them."""
    return F.md5(F.concat_ws("\x1f", F.coalesce(F.col(id_col).cast("string"), F.lit("\x00")),
                             F.coalesce(F.col(text_col), F.lit("\x00"))))


def literal_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A bounded table known to the driver as a literal of the plan (no Python on the executors)."""
    entry = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.inline(entry))


def worker_state(key: tuple, make: Callable[[], object]) -> object:
    """Something costly to build that a Python worker keeps between the tasks of an operator (tables, tokenizers).
    The first part of the key names the operator; what others left is dropped."""
    store = release_worker_state(key[0])
    if key not in store:
        store[key] = make()
    return store[key]


def release_worker_state(keep: str = "") -> dict:
    """Drop what operators other than ``keep`` left in this worker."""
    module = sys.modules.setdefault("_scholarspark_worker_state", types.ModuleType("_scholarspark_worker_state"))
    store = module.__dict__.setdefault("store", {})
    for key in [k for k in store if k[0] != keep]:
        del store[key]
    return store


def give_back() -> None:
    """Hand the system the memory that this worker has freed. Workers live on between tasks, and the allocators of C and of
    Arrow would keep it for later."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):                       # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def gives_back(run: Callable[[Iterator], Iterator], keep: str = "") -> Callable[[Iterator], Iterator]:
    """A function for ``mapInArrow`` that drops what operators other than ``keep`` left in the worker and hands back what it
    frees itself."""
    @wraps(run)
    def within(batches: Iterator) -> Iterator:
        release_worker_state(keep)
        try:
            yield from run(batches)
        finally:
            give_back()

    return within


_SPACED = re.compile(r"\s*\S+|\s+")


def spaced_chunks(text: str) -> list[str] | None:
    """Cut a text where white space follows something else, so that each chunk is white space (kept) and
    the word behind it. Joined, the chunks are the text. None if the text holds the separators
    U+001C..U+001F, which libraries do not class alike: such a text must be handled whole.

    The pre-tokenisation patterns used here look at no text to their left and never match across
    such a cut, so chunks can be tokenised one by one.
    """
    flat = text.replace("\n", " ")
    if " ".join(flat.split()) == flat:      # single blanks and line feeds between words only
        pieces = text.replace("\n", " \n").split(" ")
        return pieces[:1] + [p if p[:1] == "\n" else " " + p for p in pieces[1:]]
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return None
    return _SPACED.findall(text)
