"""Resharding by minimum-cost flow: from old shard sizes to new capacities with the fewest bytes moved.

Every old shard is cut into ``BLOCKS`` blocks by a hash of the rows. Block sizes, whose number is
fixed by parameters, go to the driver. There a minimum-cost flow between old shards and new ones
says how many bytes go where (staying costs nothing), and whole blocks are dealt out, largest
first, to the flows with the most bytes left. Rows find their new shard by a join with the block
table. Slots count the rows of a shard block by block, so no task sees a whole shard.

``round_trip`` does the whole job on files: it writes the old shards, plans from them, rewrites the
affected shards, and reads every shard back. The rows travel once, grouped by new shard and part of it.

Defined results: a null text has no bytes; rows may repeat, and equal rows stay in one block; a null
key is hashed like any other; a table without rows gives none.
"""

from __future__ import annotations

import heapq
from collections import defaultdict

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from murmurio.session import scratch_path

BLOCKS = 1024
PARTS = 64      # files of a new shard


def min_cost_flow(supply: list[int], capacity: list[int], cost: list[list[int]]) -> dict[tuple[int, int], int]:
    """Bytes from each source to each sink at least total cost, by successive shortest paths.

    The capacities must hold the supply. Potentials keep reduced costs from falling below zero, so
    every path is found by Dijkstra's method.
    """
    n, m = len(supply), len(capacity)
    if sum(supply) > sum(capacity):
        raise ValueError("the capacities are too small")
    source, sink = n + m, n + m + 1
    room: dict[int, dict[int, int]] = defaultdict(dict)
    price: dict[tuple[int, int], int] = {}

    def link(a: int, b: int, cap: int, c: int) -> None:
        room[a][b], room[b][a] = cap, 0
        price[a, b], price[b, a] = c, -c

    for i, s in enumerate(supply):
        link(source, i, s, 0)
        for j in range(m):
            link(i, n + j, s, cost[i][j])
    for j, c in enumerate(capacity):
        link(n + j, sink, c, 0)
    height = [0] * (n + m + 2)
    while True:
        far, before, queue = {source: 0}, {}, [(0, source)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > far[a]:
                continue
            for b, free in room[a].items():
                if free > 0 and d + price[a, b] + height[a] - height[b] < far.get(b, 1 << 62):
                    far[b] = d + price[a, b] + height[a] - height[b]
                    before[b] = a
                    heapq.heappush(queue, (far[b], b))
        if sink not in far:
            break
        for v, d in far.items():
            height[v] += d
        path, v = [], sink
        while v != source:
            path.append((before[v], v))
            v = before[v]
        amount = min(room[a][b] for a, b in path)
        for a, b in path:
            room[a][b] -= amount
            room[b][a] += amount
    return {(i, j): room[n + j][i] for i in range(n) for j in range(m) if room[n + j][i] > 0}


def deal_blocks(sizes: dict[tuple[int, int], int], capacity: list[int], home: dict[int, int]
                ) -> dict[tuple[int, int], int]:
    """New shard of each (old shard, block)."""
    old = sorted({s for s, _ in sizes})
    total = {s: sum(b for (o, _), b in sizes.items() if o == s) for s in old}
    cost = [[0 if home.get(s) == j else 1 for j in range(len(capacity))] for s in old]
    flow = min_cost_flow([total[s] for s in old], capacity, cost)
    left = defaultdict(dict)
    for (i, j), amount in flow.items():
        left[old[i]][j] = amount
    out, spare = {}, list(capacity)
    for (s, b), size in sorted(sizes.items(), key=lambda x: (-x[1], x[0])):
        # rounding adds up over old shards, so room in the new shard counts beside the flow
        to = max(left[s], key=lambda j: (min(left[s][j], spare[j]), -j))
        out[s, b] = to
        left[s][to] -= size
        spare[to] -= size
    return out


def block_of(*columns: Column, blocks: int = BLOCKS) -> Column:
    return F.pmod(F.xxhash64(F.lit(7), *columns), F.lit(blocks)).cast("int")


def _measured(df: DataFrame, old_shard: Column, key: str, text: str, blocks: int) -> DataFrame:
    """``df`` with size, text_crc32, old_shard and block."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    return (df.withColumns({"size": (F.octet_length(body) + 1).cast("long"), "text_crc32": F.crc32(body),
                            "old_shard": old_shard.cast("int")})
            .withColumn("block", block_of(F.col(key), F.col("text_crc32"), blocks=blocks)))


def _plan(rows: DataFrame, n_new: int) -> list[tuple[int, int, int, int]]:
    """(old shard, block, new shard, first slot) of each block."""
    measured = rows.groupBy("old_shard", "block").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    total = sum(r["b"] for r in measured)
    capacity = [total // n_new + (j < total % n_new) for j in range(n_new)]
    to = deal_blocks({(r["old_shard"], r["block"]): r["b"] for r in measured}, capacity,
                     {s: s for s in range(n_new)})
    place, filled = [], [0] * n_new
    for r in sorted(measured, key=lambda r: (r["old_shard"], r["block"])):
        shard = to[r["old_shard"], r["block"]]
        place.append((r["old_shard"], r["block"], shard, filled[shard]))
        filled[shard] += r["n"]
    return place


def _placed(rows: DataFrame, place: list[tuple[int, int, int, int]], key: str) -> DataFrame:
    """``rows`` with shard and slot, grouped by shard and part of it."""
    table = rows.sparkSession.createDataFrame(place, "old_shard int, block int, shard int, first long")
    # the block table has at most (old shards) * blocks rows
    rows = (rows.join(F.broadcast(table), ["old_shard", "block"])
            .withColumn("_part", F.pmod("block", F.lit(PARTS))).repartition("shard", "_part"))
    rank = F.row_number().over(Window.partitionBy("shard", "_part", "old_shard", "block")
                               .orderBy(key, "text_crc32", "size"))
    return rows.withColumn("slot", F.col("first") + rank - 1).drop("first", "_part")


def reshard(df: DataFrame, old_shard: Column, n_new: int, *, key: str = "doc_id", text: str = "text",
            blocks: int = BLOCKS) -> DataFrame:
    """Rows (key, size, text_crc32, old_shard, shard, slot); old shard i stays at home in new shard i.

    ``old_shard`` is a small whole number from 0. Shard sizes differ by about a block's.
    """
    rows = _measured(df, old_shard, key, text, blocks).select(key, "size", "text_crc32", "old_shard", "block")
    return _placed(rows, _plan(rows, n_new), key).select(
        key, "size", "text_crc32", "old_shard", "block", "shard", "slot")


def round_trip(df: DataFrame, old_shard: Column, n_new: int, *, key: str = "doc_id", text: str = "text",
               blocks: int = BLOCKS) -> DataFrame:
    """Rows (key, size, text_crc32, old_shard, shard, slot) as they stand in the files after resharding.

    A shard that neither gives nor takes a row keeps its old files; a slot there is the row's rank.
    """
    spark = df.sparkSession
    old_path, new_path = scratch_path(spark, "old-shards"), scratch_path(spark, "new-shards")
    old = df.select(F.col(key).alias("_key"), F.col(text).alias("_text"), old_shard.cast("int").alias("old_shard"))
    old.write.partitionBy("old_shard").option("compression", "zstd").parquet(old_path)
    kept = spark.read.schema(old.schema).parquet(old_path)
    rows = _measured(kept, F.col("old_shard"), "_key", "_text", blocks)
    place = _plan(rows.select("size", "old_shard", "block"), n_new)
    affected = sorted({s for o, _, n, _ in place if o != n for s in (o, n)})
    moving = [p for p in place if p[2] in affected]
    staying = [p for p in place if p[2] not in affected]
    # the old shard goes into the files, so that they alone say where a row came from
    new = _placed(rows, moving, "_key").select("_key", "_text", F.col("old_shard").alias("origin"), "shard", "slot")
    write_shards(new, new_path)
    back = (spark.read.schema(new.schema).parquet(new_path).withColumnRenamed("origin", "old_shard")
            .withColumns({"shard": F.col("shard").cast("int"), "slot": F.col("slot").cast("long")}))
    if staying:
        same = _placed(rows.where(~F.col("old_shard").isin(affected)), staying, "_key")
        back = back.unionByName(same.select("_key", "_text", "old_shard", "shard", "slot"))
    return _measured(back, F.col("old_shard"), "_key", "_text", blocks).select(
        F.col("_key").alias(key), "size", "text_crc32", "old_shard", "block", "shard", "slot")


def write_shards(rows: DataFrame, path: str) -> str:
    """Write rows that are grouped by shard below ``path``, as shard=N folders."""
    (rows.sortWithinPartitions("shard", "slot").write.partitionBy("shard")
     .option("compression", "zstd").parquet(path))
    return path


def rewrite(df: DataFrame, placed: DataFrame, path: str, *, key: str = "doc_id", text: str = "text",
            affected_only: bool = True) -> str:
    """Write the rows of each new shard below ``path``, as shard=N folders.

    With ``affected_only`` shards that neither give nor take a row are left out: their old files
    stay as they are.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    where = placed.select(F.col(key).alias("_k"), F.col("text_crc32").alias("_c"), "shard", "slot", "old_shard",
                          F.row_number().over(Window.partitionBy(key, "text_crc32").orderBy("shard", "slot"))
                          .alias("_n"))
    rows = df.withColumn("_crc", F.crc32(body))
    rows = rows.withColumn("_i", F.row_number().over(Window.partitionBy(key, "_crc").orderBy(F.col("_crc"))))
    out = rows.join(where, rows[key].eqNullSafe(where["_k"]) & (rows["_crc"] == where["_c"])
                    & (rows["_i"] == where["_n"])).drop("_k", "_c", "_n", "_i", "_crc")
    if affected_only:
        moved = placed.where("shard <> old_shard").select(F.explode(F.array("shard", "old_shard")).alias("shard"))
        out = out.join(F.broadcast(moved.distinct()), "shard", "left_semi")  # one row per shard
    return write_shards(out.drop("old_shard").repartition("shard", F.pmod("slot", F.lit(16))), path)
