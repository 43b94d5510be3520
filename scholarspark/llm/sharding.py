"""Shards by a consistent-hash ring with virtual nodes and bounded loads, in DataFrame operations.

A key hashes to one of ``CELLS`` equal cells of the ring. Each shard owns virtual nodes, placed at cells by
hash; a key's home is the first node clockwise. Every shard has a capacity; capacities add up to the number
of rows, one apart at most. Keys beyond a full shard's capacity go on clockwise to the next shard that has
room. Keys are taken in rounds: in round k each cell asks its k-th distinct shard clockwise, and the shard
accepts cells in ring order (and keys in hash order within a cell) until it is full.

Within a round all rows of a cell are alike, so the plan needs only the number of rows of each cell: a
table of ``CELLS`` numbers whatever the size of the input. The driver settles the rounds on these numbers
and gives back segments (cell, shard, range of ranks, first slot); rows find theirs by their rank within
the cell. Only narrow rows (id, size, checksum, hash) are shuffled, by cell.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scholarspark.llm.common import literal_table
from scholarspark.session import reliable_checkpoint

#: Cells of the ring and virtual nodes of a shard.
CELLS = 4096
NODES = 64


def _hash(text: str) -> int:
    return int(hashlib.md5(text.encode("utf-8")).hexdigest()[:8], 16)


def ring(shards: int, nodes: int = NODES, cells: int = CELLS) -> list[list[int]]:
    """For each cell the shards in the order in which their nodes come clockwise from it. A cell taken by an
    earlier node is passed on to the next free one, so that every node has a place."""
    if shards * nodes > cells:
        raise ValueError("more virtual nodes than cells")
    owner: dict[int, int] = {}
    for node in range(nodes):
        for shard in range(shards):
            cell = _hash(f"shard-{shard}-node-{node}") % cells
            while cell in owner:
                cell = (cell + 1) % cells
            owner[cell] = shard
    orders: list[list[int]] = [[] for _ in range(cells)]
    order: list[int] = []
    for cell in [*range(cells - 1, -1, -1)] * 2:      # twice round, so that the last cells see the first nodes
        if cell in owner:
            order = [owner[cell]] + [s for s in order if s != owner[cell]]
        orders[cell] = order
    return orders


def place(counts: dict[int, int], shards: int, nodes: int = NODES, cells: int = CELLS) -> list[dict]:
    """Segments (cell, lo, hi, shard, slot): ranks lo..hi-1 of a cell go to the shard, the first to the slot."""
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used, taken = [0] * shards, dict.fromkeys(counts, 0)
    orders, out = ring(shards, nodes, cells), []
    for k in range(shards):
        for cell in sorted(counts):
            shard = orders[cell][k]
            n = min(counts[cell] - taken[cell], room[shard] - used[shard])
            if n > 0:
                out.append({"cell": cell, "lo": taken[cell], "hi": taken[cell] + n, "shard": shard,
                            "slot": used[shard], "hops": k})
                taken[cell] += n
                used[shard] += n
    return out


def ring_hash(col: Column) -> Column:
    """Unsigned 32-bit hash of a key (null: of the empty text)."""
    return F.conv(F.substring(F.md5(F.coalesce(col.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")


def assign_shards(df: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text",
                  nodes: int = NODES, cells: int = CELLS) -> DataFrame:
    """(id, size, text_crc32, law, shard, slot, grown_shard, hops), a row for each row of ``df``.

    ``size`` is the text's UTF-8 bytes plus 1 (null: 1). Counts of the shards are at most one apart (law
    ``rows``); slots of a shard run from 0 without gaps; ``hops`` counts the full shards a row has passed.
    ``grown_shard`` is null: with another shard every capacity changes. Null and repeated ids are keys like
    others; rows alike in id, checksum and size may swap places, which changes nothing. An empty table gives
    no rows; other columns are not read.
    """
    spark = df.sparkSession
    narrow = df.select(F.col(id_col).alias("id"),
                       (F.coalesce(F.octet_length(text_col), F.lit(0)) + 1).cast("long").alias("size"),
                       F.crc32(F.coalesce(F.col(text_col), F.lit("")).cast("binary")).alias("text_crc32"),
                       ring_hash(F.col(id_col)).alias("h"))
    narrow = reliable_checkpoint(narrow.withColumn("cell", (F.col("h") % cells).cast("int")), "ring-rows")
    counts = {r["cell"]: r["count"] for r in narrow.groupBy("cell").count().collect()}       # at most ``cells``
    kind = "cell int, lo bigint, hi bigint, shard int, slot bigint, hops int"
    plan = literal_table(spark, place(counts, shards, nodes, cells), kind.replace(" ", ":").replace(",:", ","))
    within = Window.partitionBy("cell").orderBy("h", "id", "text_crc32", "size")
    ranked = narrow.withColumn("rank", F.row_number().over(within) - 1)
    rank = F.col("rank")
    # a cell has a segment for each shard at most
    return (ranked.join(plan.withColumnRenamed("cell", "p_cell"),
                        (F.col("cell") == F.col("p_cell")) & (rank >= F.col("lo")) & (rank < F.col("hi")))
                  .select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                          (F.col("slot") + rank - F.col("lo")).alias("slot"),
                          F.lit(None).cast("int").alias("grown_shard"), "hops"))
