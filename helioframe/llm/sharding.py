"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has 4096 ticks; every shard owns a number of virtual nodes at ticks
given by a hash of its number. A row belongs to the arc that ends at the next
virtual node clockwise from the hash of its id. Each shard has a capacity, and
the capacities differ by one at most and sum to the number of rows, so counts
do too: rows that overflow a full shard continue clockwise to the next virtual
node with room. Which rows of an arc stay and which go on depends on their
rank within the arc, so the overflow is settled on the counts of the arcs
alone (one number for each virtual node on the driver), and rows only look up
their place. Adding a shard moves the rows of its arcs and what overflows.

DataFrame functions only. A null text has no bytes and the CRC of an empty
one; null ids share a place on the ring; rows of equal id lie side by side and
are told apart by their row number, so repeated rows get slots of their own;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helioframe.llm.common import Scratch, rank_within

TICKS = 4096
VIRTUAL_NODES = 64


def ring(shards: int, nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """Virtual nodes ``(tick, shard)`` clockwise; of two at one tick the later moves on to the next free tick."""
    if shards * nodes > TICKS:
        raise ValueError("more virtual nodes than ticks")
    taken: dict[int, int] = {}
    for shard in range(shards):
        for k in range(nodes):
            tick = int.from_bytes(hashlib.sha256(f"{shard}/{k}".encode()).digest()[:4], "big") % TICKS
            while tick in taken:
                tick = (tick + 1) % TICKS
            taken[tick] = shard
    return sorted(taken.items())


def arcs(nodes: list[tuple[int, int]]) -> list[int]:
    """For each tick, the number of the first virtual node at it or clockwise of it."""
    out, at = [], 0
    for tick in range(TICKS):
        while at < len(nodes) and nodes[at][0] < tick:
            at += 1
        out.append(at % len(nodes))
    return out


def settle(nodes: list[tuple[int, int]], counts: dict[int, int], shards: int) -> list[tuple[int, int, int, int, int]]:
    """Ranges of ranks ``(arc, from, to, shard, slot of the first)`` that fill every shard to its capacity."""
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    filled = [0] * shards
    waiting = {a: [(a, 0, n)] for a, n in counts.items() if n}
    out = []
    while waiting:
        onward: dict[int, list] = {}
        for node in sorted(waiting):
            shard = nodes[node][1]
            for arc, low, high in waiting[node]:
                take = min(room[shard] - filled[shard], high - low)
                if take:
                    out.append((arc, low, low + take, shard, filled[shard]))
                    filled[shard] += take
                if low + take < high:
                    onward.setdefault((node + 1) % len(nodes), []).append((arc, low + take, high))
        waiting = onward
    return out


def shard(docs: DataFrame, shards: int = 8, nodes: int = VIRTUAL_NODES) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)``: counts of the shards differ by one at most."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    virtual = ring(shards, nodes)
    place = F.xxhash64("doc_id")
    tick = F.shiftrightunsigned(place, 64 - (TICKS - 1).bit_length()).cast("int")
    rows = scratch.keep(
        docs.select("doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
                    F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
                    F.element_at(F.lit(arcs(virtual)), tick + 1).alias("arc"), place.alias("place"),
                    F.monotonically_increasing_id().alias("row")), "ring")
    counts = {r["arc"]: r["count"] for r in rows.groupBy("arc").count().collect()}
    # The ranges are as many as virtual nodes, and a few more for each shard that fills up.
    ranges = ", ".join(f"({a}, {lo}L, {hi}L, {s}, {f}L)" for a, lo, hi, s, f in settle(virtual, counts, shards))
    seats = spark.sql(f"select * from values {ranges or '(0, 0L, 0L, 0, 0L)'} as t(arc, low, high, shard, first)")
    ranked = rank_within(rows, "arc", ["place", "row"], sum(counts.values()))
    return (ranked.join(F.broadcast(seats), "arc").where("rank >= low and rank < high")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("first") + F.col("rank") - F.col("low")).alias("slot")))
