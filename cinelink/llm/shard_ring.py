"""Sharding: consistent-hash ring with virtual nodes and bounded loads.

Every shard owns `virtual` points of a 64-bit ring; a key belongs to the arc of the next
point clockwise. Loads are bounded: a shard takes rows up to its capacity, its own arcs
first, and what does not fit continues clockwise to the next point whose shard has room.
With `slack` 0 the capacities add up to the number of rows, so counts differ by one at
most; with slack e a shard holds at most (1 + e) times the mean.

Only the counts per arc, one per virtual node, reach the driver. They are turned into
segments (arc, ranks lo to hi, shard, first slot), of which there are at most three per
virtual node, and every row finds its segment by its rank in its arc. One shuffle by arc
carries the rows.

Defined results: null keys are a key of their own; rows with the same key are ordered by
`ties`, equal rows are interchangeable; an empty table gives no rows; other columns pass
through, and where one is called shard or slot, the added one is shard_2 or slot_2. Rows of one key stay together on the ring unless a shard is full.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from cinelink.llm.texts import free_name

VIRTUAL = 64


def ring(spark, shards, virtual=VIRTUAL):
    """(positions, owners) of the virtual nodes, sorted; the points of a shard do not depend on the others."""
    rows = spark.range(shards * virtual).select(
        (F.col("id") % shards).cast("int").alias("shard"),
        F.xxhash64(F.lit("point"), F.col("id") % shards, F.floor(F.col("id") / shards)).alias("at"),
    ).collect()  # shards * virtual rows, whatever the data
    rows.sort(key=lambda r: (r["at"], r["shard"]))
    return np.array([r["at"] for r in rows], dtype=np.int64), np.array([r["shard"] for r in rows], dtype=np.int64)


def capacities(rows, shards, slack=0.0):
    """Rows each shard may take: equal but for one, and `slack` more."""
    exact = rows // shards + (np.arange(shards) < rows % shards)
    return exact if slack == 0 else np.maximum(exact, int(np.ceil(rows * (1 + slack) / shards)))


def place(counts, owners, capacity):
    """Segments (arc, lo, hi, shard, slot) for `counts` rows per arc.

    First every arc fills its own shard; the rest walks clockwise until it is placed.
    """
    room, used, arcs, segments = capacity.copy(), np.zeros_like(capacity), len(owners), []

    def take(arc, lo, hi, shard):
        n = int(min(hi - lo, room[shard]))
        if n:
            segments.append((arc, lo, lo + n, int(shard), int(used[shard])))
            room[shard] -= n
            used[shard] += n
        return lo + n

    over = []
    for arc in range(arcs):
        lo = take(arc, 0, int(counts[arc]), owners[arc])
        over.append([(arc, lo, int(counts[arc]))] if lo < counts[arc] else [])
    walking = []
    for step in range(2 * arcs):
        at = step % arcs
        left = []
        for arc, lo, hi in walking:
            lo = take(arc, lo, hi, owners[at])
            if lo < hi:
                left.append((arc, lo, hi))
        walking = left + over[at]
        over[at] = []
    if walking:
        raise ValueError("capacities are smaller than the rows")
    return segments


def assign(rows, key, ties=(), shards=40, virtual=VIRTUAL, slack=0.0):
    """`rows` with `shard` and `slot`, gapless from 0 in every shard. `key` and `ties` are Columns."""
    spark = rows.sparkSession
    positions, owners = ring(spark, shards, virtual)

    @F.pandas_udf("int")
    def arc_of(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(positions, at.to_numpy(), side="left") % len(positions)).astype("int32")

    ties = [F.struct(*ties).alias("ties")] if ties else []
    placed = rows.select(F.struct("*").alias("row"), F.xxhash64(F.lit("key"), key).alias("at"), *ties)
    placed = placed.withColumn("arc", arc_of("at"))
    counts = np.zeros(len(positions), dtype=np.int64)
    for r in rows.select(F.xxhash64(F.lit("key"), key).alias("at")).groupBy(arc_of("at").alias("arc")).count().collect():
        counts[r["arc"]] = r["count"]
    segments = place(counts, owners, capacities(int(counts.sum()), shards, slack))
    schema = "arc int, lo long, hi long, shard int, first long"
    table = spark.createDataFrame(segments, schema)
    by_arc = Window.partitionBy("arc").orderBy("at", *["ties"] * bool(ties))
    ranked = placed.withColumn("rank", F.row_number().over(by_arc).cast("long") - 1)
    return ranked.join(
        F.broadcast(table.withColumnRenamed("arc", "s_arc")),  # at most three rows per virtual node
        (F.col("arc") == F.col("s_arc")) & (F.col("rank") >= F.col("lo")) & (F.col("rank") < F.col("hi")),
    ).select(
        "row.*", F.col("shard").alias(free_name(rows.columns, "shard")),
        (F.col("first") + F.col("rank") - F.col("lo")).alias(free_name(rows.columns, "slot")))
