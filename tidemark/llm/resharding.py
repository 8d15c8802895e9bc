"""Resharding by minimum-cost flow: the fewest bytes move from old shards to new ones of given capacities.

Rows live in ``old`` shards (by hash of the row). Their sizes are summed by block, a hash range of a shard of about
``BLOCK_ROWS`` rows. A flow network from old to new shards, in which staying costs nothing and moving costs its bytes,
is solved on the driver; it has as many edges as old times new shards, whatever the number of rows. The flow of an old
shard is laid over its blocks in order, so nearly all blocks move whole. In the few that the border of two flows
cuts, rows go largest first to the part with most room left. Slots count blocks first, then rows within a block, so
no task sees more than a block.

A size is the UTF-8 bytes of the text (null: none) plus ``ROW_BYTES``. Equal texts are not held together: a third of
all rows may be copies of one text, and shards of nearly equal size cannot hold that.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import settled

ROW_BYTES = 16
OLD, NEW = 32, 40
BLOCK_ROWS = 50_000
PLACED = "doc_id long, size long, text_crc32 long, text_hash long, old_shard int, block int, shard int, rank long"


def min_cost_flow(supply: list[int], room: list[int], cost) -> np.ndarray:
    """flow[i, j] that sends all supply into the rooms at least ``cost(i, j)`` per byte, by shortest augmenting paths.

    The rooms must hold the supply. Dijkstra runs on reduced costs, so every path found is a cheapest one.
    """
    n, m = len(supply), len(room)
    price = np.array([[cost(i, j) for j in range(m)] for i in range(n)], dtype=float)
    flow = np.zeros((n, m), dtype=np.int64)
    left, free = list(map(int, supply)), list(map(int, room))
    if sum(left) > sum(free):
        raise ValueError("the new shards are too small")
    potential = np.zeros(n + m)
    while any(left):
        distance, parent = np.full(n + m, math.inf), [-1] * (n + m)
        queue = [(0.0, i) for i in range(n) if left[i]]
        for _, i in queue:
            distance[i] = 0
        heapq.heapify(queue)
        while queue:
            d, u = heapq.heappop(queue)
            if d > distance[u]:
                continue
            if u < n:
                steps = [(n + j, price[u, j]) for j in range(m)]
            else:
                steps = [(i, -price[i, u - n]) for i in range(n) if flow[i, u - n]]
            for v, c in steps:
                reach = d + c + potential[u] - potential[v]
                if reach < distance[v] - 1e-9:
                    distance[v], parent[v] = reach, u
                    heapq.heappush(queue, (reach, v))
        potential += np.where(np.isfinite(distance), distance, 0)
        target = min((j for j in range(m) if free[j]), key=lambda j: (potential[n + j], j))
        path, v = [], n + target
        while parent[v] >= 0:
            path.append((parent[v], v))
            v = parent[v]
        amount = min([left[v], free[target]] + [int(flow[b, a - n]) for a, b in path if a >= n])
        for a, b in path:
            if a < n:
                flow[a, b - n] += amount
            else:
                flow[b, a - n] -= amount
        left[v] -= amount
        free[target] -= amount
    return flow


def capacities(total: int, shards: int) -> list[int]:
    """Nearly equal rooms that hold ``total`` bytes exactly."""
    return [total // shards + (j < total % shards) for j in range(shards)]


def _segments(spark: SparkSession, flow: np.ndarray) -> DataFrame:
    """The byte range of each old shard that goes to each new one; what stays comes first."""
    rows = []
    for i, row in enumerate(flow):
        at = 0
        for j in sorted(np.flatnonzero(row), key=lambda j: (j != i, j)):
            rows.append((i, int(j), at, at + int(row[j])))
            at += int(row[j])
    return spark.createDataFrame(rows, "old_shard int, to int, low long, high long")


def _split(block: pd.DataFrame) -> pd.DataFrame:
    """Rows of a block that goes to several shards: largest first, to the shard with most room left."""
    block = block.sort_values(["size", "text_hash", "doc_id"], ascending=[False, True, True], kind="stable").reset_index(drop=True)
    rooms = [(-int(p["bytes"]), int(p["to"])) for p in block["parts"].iloc[0]]
    heapq.heapify(rooms)
    shard = np.empty(len(block), np.int32)
    for k, size in enumerate(block["size"]):
        room, to = rooms[0]
        shard[k] = to
        heapq.heapreplace(rooms, (room + int(size), to))
    block["shard"] = shard
    block["rank"] = block.groupby("shard").cumcount()
    return block.drop(columns="parts")


def resharded(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    old: int = OLD,
    new: int = NEW,
    rooms: list[int] | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """doc_id, size, text_crc32, old_shard, shard and slot (gapless from 0 in each shard) of every row.

    ``rooms`` are the capacities of the new shards in bytes, nearly equal ones by default. A negative or null id is fine.
    """
    spark = docs.sparkSession
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("long").alias("text_crc32"),
        F.xxhash64(F.col(id_col), text).alias("text_hash"),
    )
    rows = settled(rows.withColumn("old_shard", F.pmod("text_hash", F.lit(old)).cast("int")), "rows")
    sizes = {r["old_shard"]: r for r in rows.groupBy("old_shard").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect()}
    supply = [sizes[i]["size"] if i in sizes else 0 for i in range(old)]
    flow = min_cost_flow(supply, rooms or capacities(sum(supply), new), lambda i, j: 0 if i == j else 1)
    blocks = max(1, math.ceil(max((r["n"] for r in sizes.values()), default=0) / block_rows))
    rows = rows.withColumn("block", F.pmod(F.floor(F.col("text_hash") / old), F.lit(blocks)).cast("int"))
    place = ["old_shard", "block"]
    sums = rows.groupBy(*place).agg(F.sum("size").alias("bytes"))
    before = Window.partitionBy("old_shard").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = sums.withColumn("end", F.sum("bytes").over(before)).withColumn("begin", F.col("end") - F.col("bytes"))
    part = F.struct(F.col("to"), (F.least("end", "high") - F.greatest("begin", "low")).alias("bytes"))
    parts = (
        sums.join(_segments(spark, flow), "old_shard")
        .where("low < end and high > begin")
        .groupBy(*place)
        .agg(F.array_sort(F.collect_list(part)).alias("parts"))
    )
    dealt = rows.join(parts, place)
    order = Window.partitionBy(*place).orderBy(F.desc("size"), "text_hash", "doc_id")
    whole = (
        dealt.where(F.size("parts") == 1)
        .withColumn("shard", F.col("parts")[0]["to"])
        .withColumn("rank", F.row_number().over(order).cast("long") - 1)
        .drop("parts")
    )
    cut = dealt.where(F.size("parts") > 1).groupBy(*place).applyInPandas(_split, PLACED)
    placed = settled(whole.select(cut.columns).unionByName(cut), "placed")
    counts = placed.groupBy("shard", *place).agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("shard").orderBy(*place).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = counts.withColumn("first", F.sum("n").over(ahead) - F.col("n")).drop("n")
    return placed.join(first, ["shard", *place]).select(
        "doc_id", "size", "text_crc32", "old_shard", "shard", (F.col("first") + F.col("rank")).alias("slot"), "text_hash"
    )


def moves(placed: DataFrame) -> DataFrame:
    """Rows and bytes that go from each old shard to each other new one."""
    return placed.where("old_shard <> shard").groupBy("old_shard", "shard").agg(F.count("*").alias("n_rows"), F.sum("size").alias("bytes"))


def rewrite(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the rows of every new shard that gains or loses rows below ``path``, one folder per shard; others stay.

    A shard is affected if a row enters it, or leaves the old shard of its number.
    """
    moved = placed.where("old_shard <> shard")
    affected = moved.select(F.col("shard").alias("s")).unionByName(moved.select(F.col("old_shard").alias("s"))).distinct()
    content = placed.join(affected, placed["shard"] == affected["s"]).select("doc_id", "text_hash", "shard", "slot")
    keyed = docs.withColumn("__hash", F.xxhash64(F.col(id_col), F.col(text_col)))
    numbered = Window.partitionBy("__hash").orderBy(F.lit(0))
    same = Window.partitionBy("text_hash").orderBy("shard", "slot")
    left = keyed.withColumn("__copy", F.row_number().over(numbered))
    right = content.withColumn("copy", F.row_number().over(same))
    rows = left.join(right, (left["__hash"] == right["text_hash"]) & (left["__copy"] == right["copy"]))
    rows = rows.select(*(left[c] for c in docs.columns), right["shard"].alias("shard"), right["slot"].alias("slot"))
    block = F.floor(F.col("slot") / BLOCK_ROWS)
    rows.repartition("shard", block).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
