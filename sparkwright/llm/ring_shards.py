"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every row hashes to one of ``CELLS`` ring cells; every shard owns ``vnodes`` virtual nodes at hashed
cell positions. A cell's rows go to the shard of the first virtual node clockwise; once that shard
holds its capacity, the rest of the cell continues clockwise to the next shard with room. Capacities are
floor(n / shards), one more for the first n mod shards, so row counts differ by at most one whatever the
key distribution is. Only cell counts (a fixed-size table) reach the driver; rows are ranked inside
(cell, lane) groups, lanes spreading rows that share one hash. The lane comes from the row number, so rows are stored
with it first: a lane counted by one job is the same lane when another ranks it.

Defined cases: null doc_id and null text hash like any other value; repeated rows are separate rows
with separate slots; an empty table gives an empty result; fewer rows than shards leaves shards empty.
"""

from __future__ import annotations

import bisect
import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from sparkwright.session import stored
from sparkwright.llm.textutil import whole_row

CELLS = 1 << 14
LANES = 8


def _cell_of(label: str) -> int:
    return int.from_bytes(hashlib.sha256(label.encode()).digest()[:8], "big") % CELLS


def ring(n_shards: int, vnodes: int = 64, seed: int = 0) -> list[tuple[int, int]]:
    """Virtual nodes as sorted (cell, shard); a shard's nodes do not depend on the shard count."""
    return sorted((_cell_of(f"{seed}/{s}/{v}"), s) for s in range(n_shards) for v in range(vnodes))


def place(counts: np.ndarray, n_shards: int, vnodes: int = 64, seed: int = 0) -> list[tuple[int, int, int]]:
    """Fill the ring from cell counts. Returns (cell, shard, rows) in filling order.

    Cells are served in a seeded pseudorandom order so that no stretch of the ring is favoured.
    """
    nodes = ring(n_shards, vnodes, seed)
    at = [c for c, _ in nodes]
    total = int(counts.sum())
    free = [total // n_shards + (s < total % n_shards) for s in range(n_shards)]
    onward = list(range(len(nodes)))          # next virtual node whose shard still has room

    def open_node(i: int) -> int:
        path = []
        while free[nodes[i][1]] == 0:
            path.append(i)
            i = onward[i] if onward[i] != i else (i + 1) % len(nodes)
        for p in path:
            onward[p] = i
        return i

    out = []
    for cell in np.random.default_rng(seed).permutation(CELLS):
        left = int(counts[cell])
        i = bisect.bisect_left(at, int(cell)) % len(nodes)
        while left:
            i = open_node(i)
            shard = nodes[i][1]
            taken = min(left, free[shard])
            free[shard] -= taken
            left -= taken
            out.append((int(cell), shard, taken))
    return out


def _segments(counts: np.ndarray, n_shards: int, vnodes: int, seed: int) -> pd.DataFrame:
    """(cell, lane) -> rank ranges with their shard and first slot. counts: CELLS x LANES."""
    slot = [0] * n_shards
    lane, used = np.zeros(CELLS, int), np.zeros(CELLS, int)
    rows = []
    for cell, shard, taken in place(counts.sum(axis=1), n_shards, vnodes, seed):
        while taken:
            k = lane[cell]
            room = int(counts[cell, k] - used[cell])
            if room == 0:
                lane[cell], used[cell] = k + 1, 0
                continue
            part = min(room, taken)
            rows.append((cell, int(k), int(used[cell]), int(used[cell]) + part, shard, slot[shard]))
            slot[shard] += part
            used[cell] += part
            taken -= part
    return pd.DataFrame(rows, columns=["_cell", "_lane", "_lo", "_hi", "_shard", "_slot"]).astype("int64")


def assign(df: DataFrame, n_shards: int, key_cols: list[str], vnodes: int = 64, seed: int = 0) -> DataFrame:
    """df with ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard); columns of these names are replaced."""
    spark = df.sparkSession
    df = df.drop("shard", "slot")
    keyed = stored(df.select(
        whole_row(df), F.xxhash64(*key_cols, F.lit(seed)).alias("_h"),
        F.pmod(F.monotonically_increasing_id(), F.lit(LANES)).alias("_lane"),
    ).withColumn("_cell", F.pmod("_h", F.lit(CELLS))), "keyed")
    counts = np.zeros((CELLS, LANES), int)
    for r in keyed.groupBy("_cell", "_lane").count().collect():   # at most CELLS x LANES rows
        counts[r["_cell"], r["_lane"]] = r["count"]
    segs = _segments(counts, n_shards, vnodes, seed)
    if segs.empty:
        return df.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")}).limit(0)
    segs = (segs.groupby(["_cell", "_lane"])[["_lo", "_hi", "_shard", "_slot"]]
            .apply(lambda g: g.values.tolist()).rename("_segs").reset_index())
    table = spark.createDataFrame(segs, "_cell long, _lane long, _segs array<array<long>>")
    ranked = keyed.withColumn("_r", F.row_number().over(Window.partitionBy("_cell", "_lane").orderBy("_h")) - 1)
    hit = F.filter("_segs", lambda s: (s[0] <= F.col("_r")) & (F.col("_r") < s[1]))[0]
    return (ranked.join(table, ["_cell", "_lane"]).withColumn("_seg", hit)
            .select("_row.*", F.col("_seg")[2].cast("int").alias("shard"),
                    (F.col("_seg")[3] + F.col("_r") - F.col("_seg")[0]).alias("slot")))
