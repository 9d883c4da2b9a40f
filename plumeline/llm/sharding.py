"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

A row's key falls on a point of the ring and belongs to the virtual node that
ends its arc.  Every shard has a capacity; keys that overflow a full shard
continue clockwise to the next virtual node whose shard has room.  Rows are
ordered inside an arc, so the outcome is a small table of (arc, ranks, shard)
ranges, found from row counts per arc alone, and each row finds its place by
its rank.  Capacities differ by at most one and add up to the number of rows,
so shard counts differ by at most one.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from .text import whole, written

SHARDS = 40
VIRTUAL_NODES = 64
# Points of the ring.
RING = 1 << 32
# Arcs are cut into cells of about this many rows for ranking.
CELL_ROWS = 50_000


@dataclass(frozen=True)
class Range:
    """Rows of an arc with rank in [start, start + count) go to a shard from a slot on."""

    arc: int
    start: int
    count: int
    shard: int
    slot: int


def virtual_nodes(df: DataFrame, shards: int, per_shard: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """(end point, shard) of every virtual node in ring order; arcs are numbered so.

    Each point depends on its shard and replica only, so a ring with one more
    shard has the same points and some new ones.
    """
    grid = df.sparkSession.range(shards * per_shard).select(
        (F.col("id") % shards).cast("int").alias("shard"), F.floor(F.col("id") / shards).alias("replica"))
    points = grid.select(F.pmod(F.xxhash64(F.lit("node"), "shard", "replica"), F.lit(RING)).alias("at"), "shard")
    return sorted(tuple(r) for r in points.collect())  # shards * per_shard, a parameter


def capacities(rows: int, shards: int) -> list[int]:
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def place(counts: dict[int, int], nodes: list[tuple[int, int]], shards: int) -> list[Range]:
    """Ranges of every arc, from the number of rows per arc.

    First every arc's own shard takes what it has room for, arcs in ring order;
    then what is left moves on clockwise.
    """
    room = capacities(sum(counts.values()), shards)
    used = [0] * shards
    ranges: list[Range] = []

    def take(arc: int, start: int, count: int, shard: int) -> int:
        taken = min(count, room[shard])
        if taken:
            ranges.append(Range(arc, start, taken, shard, used[shard]))
            used[shard] += taken
            room[shard] -= taken
        return taken

    left = {}
    for arc, (_, shard) in enumerate(nodes):
        own = counts.get(arc, 0)
        stay = take(arc, 0, own, shard)
        if stay < own:
            left[arc] = stay
    for arc, start in left.items():
        step = 1
        while start < counts[arc]:
            start += take(arc, start, counts[arc] - start, nodes[(arc + step) % len(nodes)][1])
            step += 1
    return ranges


def _arc(point: Column, nodes: list[tuple[int, int]]) -> Column:
    """Number of the arc that holds a point: a search by halves over the end points."""
    ends = F.array(*[F.lit(at).cast("bigint") for at, _ in nodes])
    n = len(nodes)
    state = F.struct(F.lit(0).alias("lo"), F.lit(n).alias("hi"))

    def halve(acc: Column, _: Column) -> Column:
        middle = F.call_function("div", acc["lo"] + acc["hi"], F.lit(2)).cast("int")
        below = F.get(ends, F.least(middle, F.lit(n - 1))) < point
        open_ = acc["lo"] < acc["hi"]
        return F.struct(F.when(open_ & below, middle + 1).otherwise(acc["lo"]).alias("lo"),
                        F.when(open_ & ~below, middle).otherwise(acc["hi"]).alias("hi"))

    steps = F.array(*[F.lit(0)] * n.bit_length())
    return F.aggregate(steps, state, halve, lambda acc: (acc["lo"] % n).cast("int"))


def arc_of(point: int, nodes: list[tuple[int, int]]) -> int:
    """The same for one number, as the tests use it."""
    return bisect_left([at for at, _ in nodes], point) % len(nodes)


def shard_rows(df: DataFrame, keep: dict[str, Column], *, key: str = "doc_id", text: str = "text",
               shards: int = SHARDS, per_shard: int = VIRTUAL_NODES,
               cell_rows: int = CELL_ROWS) -> DataFrame:
    """``keep`` plus ``size, text_crc32, shard, slot``.

    ``size`` is the text's UTF-8 bytes plus 16.  A NULL text is empty.  The
    ring point comes from key and text checksum, so NULL or repeated keys
    spread; repeated rows are all placed, in any order among themselves.  An
    empty table gives an empty result.
    """
    body = F.encode(whole(text), "UTF-8")
    rows = df.select(*[c.alias(k) for k, c in keep.items()], df[key].alias("_key"),
                     (F.length(body) + 16).cast("bigint").alias("size"),
                     F.crc32(body).alias("text_crc32"))
    point = F.pmod(F.xxhash64(F.lit("row"), "_key", "text_crc32"), F.lit(RING))
    nodes = virtual_nodes(df, shards, per_shard)
    rows = rows.withColumn("_point", point)
    rows = written(rows.withColumn("_arc", _arc(F.col("_point"), nodes)), "ring")
    counts = dict(map(tuple, rows.groupBy("_arc").count().collect()))  # one row per virtual node
    ranges = place(counts, nodes, shards)

    # Ranks inside an arc: cells of the ring are ranked one by one and shifted.
    cells = max(1, -(-max(counts.values(), default=0) // cell_rows))
    width = -(-RING // (len(nodes) * cells))
    rows = rows.withColumn("_cell", F.floor(F.col("_point") / width))
    per_cell = rows.groupBy("_arc", "_cell").agg(F.count(F.lit(1)).alias("_n"), F.min("_point").alias("_first"))
    before = Window.partitionBy("_arc").orderBy("_turn", "_cell").rowsBetween(Window.unboundedPreceding, -1)
    wraps = F.col("_arc") == 0  # the arc over the ring's zero starts behind the last node
    per_cell = per_cell.withColumn("_turn", F.when(wraps & (F.col("_first") > nodes[0][0]), 0).otherwise(1))
    offsets = per_cell.select("_arc", "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_arc", "_cell").orderBy("_point", "_key", "text_crc32", "size")
    ranked = rows.join(offsets, ["_arc", "_cell"]).withColumn(
        "_rank", F.col("_before") + F.row_number().over(inside) - 1)

    by_arc: dict[int, list[Range]] = {}
    for r in ranges:
        by_arc.setdefault(r.arc, []).append(r)
    table = [(arc, [(r.start, r.count, r.shard, r.slot) for r in rs]) for arc, rs in by_arc.items()]
    placed = df.sparkSession.createDataFrame(
        table, "_arc int, _ranges array<struct<start:bigint,count:bigint,shard:int,slot:bigint>>")
    found = ranked.join(F.broadcast(placed), "_arc")  # a row per virtual node, ranges bounded likewise
    mine = F.get(F.filter("_ranges", lambda r: (F.col("_rank") >= r["start"]) & (
        F.col("_rank") < r["start"] + r["count"])), 0)
    found = found.withColumn("_mine", mine)
    return found.select(*keep, "size", "text_crc32", F.col("_mine.shard").alias("shard"),
                        (F.col("_mine.slot") + F.col("_rank") - F.col("_mine.start")).alias("slot"))
