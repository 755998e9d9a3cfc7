"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

How many rows each input partition sends to each shard is drawn first, from the distribution
that a uniform permutation of all rows would give: row by row of the matrix, multivariate
hypergeometric, the margins being the partitions' sizes and the shards' exact sizes. Then each
partition permutes its rows and deals them out by its row of the matrix, and each shard permutes
what it got.

Only built-in functions touch rows. The driver sees one count per input partition and draws the
matrix (partitions times shards numbers); partition and position of a row are written to the
shared folder first, so a lost executor can't deal a row twice.

Shards have no single large task: a shard's permutation is cut into slices by the leading part
of the random key, slices are ranked alone and offset by the sizes of those before them.

Defined cases: nulls and repeated rows are rows like any other; an empty table gives an empty
result; more shards than rows leaves shards empty; input columns of the output's names are
replaced.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import named
from tidemark.llm.common import staged

#: Rows that one slice of a shard's permutation holds on average.
SLICE_ROWS = 20_000
#: numpy's sampler takes populations below this.
NUMPY_MOST = 10**9


def exact_sizes(rows: int, shards: int) -> list[int]:
    """Sizes at most one apart."""
    return [rows // shards + (k < rows % shards) for k in range(shards)]


def draw(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """One hypergeometric number. Above numpy's limit by inversion from the mode outward."""
    if good + bad < NUMPY_MOST:
        return int(rng.hypergeometric(good, bad, sample)) if good and sample else 0
    low, high = max(0, sample - bad), min(good, sample)
    mode = min(high, max(low, (sample + 1) * (good + 1) // (good + bad + 2)))
    log = lambda n, k: math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    p = math.exp(log(good, mode) + log(bad, sample - mode) - log(good + bad, sample))
    left, up, p_left, p_up, u = mode, mode, p, p, rng.random() - p
    while u > 0 and (left > low or up < high):
        if up < high:
            p_up *= (good - up) * (sample - up) / ((up + 1) * (bad - sample + up + 1))
            up += 1
            if (u := u - p_up) <= 0:
                return up
        if left > low:
            p_left *= left * (bad - sample + left) / ((good - left + 1) * (sample - left + 1))
            left -= 1
            if (u := u - p_left) <= 0:
                return left
    return mode


def communication_matrix(
    partition_rows: list[int], shard_rows: list[int], seed: int
) -> list[list[int]]:
    """How many rows each partition sends to each shard, margins exact."""
    rng, room = np.random.default_rng(seed), list(shard_rows)
    matrix = []
    for rows in partition_rows:
        sent, left, others = [], rows, sum(room)
        for k, free in enumerate(room):
            others -= free
            n = left if k == len(room) - 1 else draw(rng, free, others, left)
            sent.append(n)
            left -= n
            room[k] -= n
        matrix.append(sent)
    return matrix


def shuffle_into_shards(df: DataFrame, shards: int, seed: int = 0) -> DataFrame:
    """All rows of ``df`` with ``shard`` and ``slot``, the place in the shard, gapless from 0."""
    spark = df.sparkSession
    df = df.select(*[named(c) for c in df.columns if c.lower() not in ("shard", "slot")])
    row = F.struct(*map(named, df.columns))
    rows = staged(
        df.select(
            row.alias("row"),
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("at"),
        ),
        "rows",
    )
    counts = sorted((r["part"], r["n"]) for r in rows.groupBy("part").agg(F.count("at").alias("n")).collect())
    total = sum(n for _, n in counts)
    matrix = communication_matrix([n for _, n in counts], exact_sizes(total, shards), seed)
    bounds = spark.createDataFrame(
        [(p, [int(x) for x in np.cumsum(sent)]) for (p, _), sent in zip(counts, matrix, strict=True)],
        "part int, bounds array<bigint>",
    )
    first = Window.partitionBy("part").orderBy(F.xxhash64(F.lit(seed), "at"), "at")
    slices = max(1, math.ceil(total / shards / SLICE_ROWS))
    dealt = (
        rows.withColumn("rank", F.row_number().over(first).cast("long"))
        .join(bounds, "part")
        .withColumn("shard", F.size(F.filter("bounds", lambda b: b < F.col("rank"))))
        .withColumn("key", F.xxhash64(F.lit(seed + 1), "at"))
        .withColumn("slice", F.pmod(F.col("key"), F.lit(slices)))
        .select("row", "shard", "slice", "key", "at")
    )
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("shard", "slice")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("shard", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    second = Window.partitionBy("shard", "slice").orderBy("key", "at")
    return (
        dealt.withColumn("rank", F.row_number().over(second))
        .join(offsets, ["shard", "slice"])
        .select("row.*", "shard", (F.col("offset") + F.col("rank") - 1).cast("long").alias("slot"))
    )
