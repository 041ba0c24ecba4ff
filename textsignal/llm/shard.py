"""Sharding on a consistent-hash ring with virtual nodes and bounded loads."""

from __future__ import annotations

import hashlib
from bisect import bisect_left

from pyspark.sql import Column, DataFrame, functions as F

from textsignal.llm.common import box, gapless

ARCS = 1 << 16  # the ring is cut into this many equal arcs
SUB_ARCS = 256  # parts of an arc too heavy for any one shard
VIRTUAL_NODES = 128
SLACK = 0.005  # a shard may hold this share more than the mean


def ring_points(shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """(arc, shard) of all virtual nodes, clockwise."""
    points = []
    for shard in range(shards):
        for v in range(virtual_nodes):
            digest = hashlib.md5(f"{shard}/{v}".encode()).digest()
            points.append((int.from_bytes(digest[:8], "big") % ARCS, shard))
    return sorted(points)


def place(
    loads: dict[int, int], parts: dict[int, dict[int, int]], shards: int, virtual_nodes: int, slack: float
) -> dict[tuple[int, int], int]:
    """Shard of every arc, or of every part of an arc that fits nowhere whole.

    Heavier arcs choose first; each goes to the first virtual node clockwise whose shard has
    room.  An arc that no shard can take is dealt by its parts, from its home onwards.  A
    single part that still fits nowhere goes to the emptiest shard, so no shard exceeds
    its bound by more than one part.
    """
    points = ring_points(shards, virtual_nodes)
    arcs = [a for a, _ in points]
    owners = [s for _, s in points]
    total = sum(loads.values())
    room = [int(-(-total * (1 + slack) // shards))] * shards
    # Shards in the order in which they are met clockwise from each virtual node.
    clockwise: list[tuple[int, ...]] = [()] * len(owners)
    order: list[int] = list(dict.fromkeys(owners))
    for i in range(len(owners) - 1, -1, -1):
        order = [owners[i], *[s for s in order if s != owners[i]]]
        clockwise[i] = tuple(order)

    def settle(arc: int, load: int) -> int | None:
        for shard in clockwise[bisect_left(arcs, arc) % len(arcs)]:
            if load <= room[shard]:
                room[shard] -= load
                return shard
        return None

    placed: dict[tuple[int, int], int] = {}
    for arc, load in sorted(loads.items(), key=lambda x: (-x[1], x[0])):
        shard = settle(arc, load)
        if shard is not None:
            placed[arc, -1] = shard
            continue
        for part, share in sorted(parts.get(arc, {-1: load}).items()):
            shard = settle(arc, share)
            if shard is None:
                shard = max(range(shards), key=lambda s: (room[s], -s))
                room[shard] -= share
            placed[arc, part] = shard
    return placed


def shard_by_ring(
    df: DataFrame,
    key: Column,
    size: Column,
    row_id: Column,
    shards: int = 8,
    virtual_nodes: int = VIRTUAL_NODES,
    slack: float = SLACK,
) -> DataFrame:
    """``df`` with ``shard`` and ``slot`` (gapless from 0 within the shard).

    Rows of one ``key`` share a place on the ring, so they stay together unless the key is
    heavier than any shard's room; then its rows are dealt by ``row_id`` in parts that
    continue clockwise.  No shard's summed ``size`` exceeds the mean by more than
    ``slack`` (plus one part); one more shard takes about its share of the rows and
    little else moves.

    The driver sees loads of ring arcs, never rows: at most ``ARCS`` arcs and
    ``SUB_ARCS`` parts of each arc above 1/64 of a mean shard, of which there are at most
    64 x ``shards``.  ``df`` is read four times: store it first if it is costly.

    Null keys form one key; a null ``size`` counts as 0; repeated rows get slots of their own;
    an empty table gives an empty table.  Other columns stay; columns named ``shard`` or
    ``slot`` are replaced.
    """
    keyed = df.select(
        box(df, "shard", "slot"),
        F.pmod(F.shiftrightunsigned(F.xxhash64(key), 1), F.lit(ARCS)).cast("int").alias("_arc"),
        F.pmod(F.xxhash64(row_id), F.lit(SUB_ARCS)).cast("int").alias("_part"),
        F.coalesce(size.cast("long"), F.lit(0)).alias("_size"),
        row_id.alias("_row"),
    )
    loads = {r["_arc"]: r["load"] for r in keyed.groupBy("_arc").agg(F.sum("_size").alias("load")).collect()}
    total = sum(loads.values())
    heavy = [a for a, load in loads.items() if load * shards * 64 > total]
    parts: dict[int, dict[int, int]] = {}
    if heavy:
        found = keyed.filter(F.col("_arc").isin(heavy)).groupBy("_arc", "_part").agg(F.sum("_size").alias("load"))
        for r in found.collect():
            parts.setdefault(r["_arc"], {})[r["_part"]] = r["load"]
    placed = place(loads, parts, shards, virtual_nodes, slack)
    split = sorted({arc for arc, part in placed if part >= 0})
    table = df.sparkSession.createDataFrame(
        [(arc, part, shard) for (arc, part), shard in placed.items()], "_a int, _p int, shard int"
    )
    part = F.when(F.col("_arc").isin(split), F.col("_part")).otherwise(-1) if split else F.lit(-1)
    keyed = keyed.withColumn("_part", part)
    same = (F.col("_arc") == F.col("_a")) & (F.col("_part") == F.col("_p"))
    # The table has at most one row per arc and part: 65,536 + 64 x shards x 256.
    dealt = keyed.join(F.broadcast(table), same).drop("_arc", "_part", "_a", "_p")
    return gapless(dealt, "shard", [F.col("_row"), F.col("_size")], "slot").select("row.*", "shard", "slot")
