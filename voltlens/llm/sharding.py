"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

1. The rows are checkpointed, so a row's source partition and place in it stay the same
   when a task is run again.
2. Shard sizes are fixed: ``n // shards``, one more for the first ``n % shards``. For every
   source partition the numbers of its rows that go to each shard are drawn on the
   driver from the multivariate hypergeometric law: partitions x shards integers, from
   one count per partition. This is the law of a uniform permutation's block counts.
3. Every partition is permuted locally (sorted by a seeded hash within the partition, no
   shuffle); consecutive stretches of that order go to the shards by the matrix.
4. After the exchange each shard is permuted again: rows fall into hash ranges of about
   ``range_rows`` rows, are ordered by hash within a range, and ``slot`` is the range's
   offset plus the place within it, so no task holds a whole shard.

Only DataFrame functions touch rows; the driver sees counts per partition.

Cases: null ids and texts are ordinary rows; repeated rows are told apart by their place
in the source; an empty table gives no rows; extra columns are carried, those named
``shard`` or ``slot`` (without case) are replaced.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F, types as T

from voltlens.session import checkpoint_dir

#: A table of at most this many numbers is broadcast; larger ones are joined by shuffle.
BROADCAST_NUMBERS = 2_000_000
LOW_33 = (1 << 33) - 1


def hypergeometric(good: int, bad: int, n: int, u: float) -> int:
    """The ``u`` quantile of the number of good ones among ``n`` drawn from good + bad.

    Weights relative to the mode follow from ratios of neighbours, so no factorial and
    no limit on the sizes is needed; terms beyond 12 standard deviations are below 1e-30.
    """
    low, high = max(0, n - bad), min(good, n)
    if low == high:
        return low
    total = good + bad
    mode = min(max(((n + 1) * (good + 1)) // (total + 2), low), high)
    sd = math.sqrt(n * (good / total) * (bad / total) * max(total - n, 1) / max(total - 1, 1))
    reach = int(12 * sd) + 30
    a, b = max(low, mode - reach), min(high, mode + reach)
    k = np.arange(a, b, dtype=np.float64)
    ratio = (good - k) * (n - k) / ((k + 1) * (bad - n + k + 1))  # weight(k + 1) / weight(k)
    at = mode - a
    up = np.cumprod(ratio[at:])
    down = np.cumprod(1 / ratio[:at][::-1])[::-1]
    cdf = np.cumsum(np.concatenate([down, [1.0], up]))
    return a + int(min(np.searchsorted(cdf, u * cdf[-1], side="right"), b - a))


def communication_matrix(counts: list[int], sizes: list[int], seed: int) -> list[list[int]]:
    """Rows to send from each partition to each shard: row sums ``counts``, column sums ``sizes``."""
    rng = np.random.default_rng(seed)
    left, matrix = list(sizes), []
    for n in counts:
        rest, row = sum(left), []
        for k, cap in enumerate(left):
            x = hypergeometric(cap, rest - cap, n, rng.random())
            rest, n = rest - cap, n - x
            left[k] = cap - x
            row.append(x)
        matrix.append(row)
    return matrix


def shard_sizes(n: int, shards: int) -> list[int]:
    return [n // shards + (k < n % shards) for k in range(shards)]


def small(df: DataFrame, numbers: int) -> DataFrame:
    return F.broadcast(df) if numbers <= BROADCAST_NUMBERS else df


def shuffle_into_shards(df: DataFrame, shards: int = 24, seed: int = 42, range_rows: int = 1 << 18) -> DataFrame:
    """All input columns plus ``shard`` (int) and ``slot`` (long, gapless from 0 in each shard)."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    carried = [i for i, c in enumerate(df.columns) if c.lower() not in ("shard", "slot")]
    names = [df.columns[i] for i in carried]
    rows = df.toDF(*(f"c{i}" for i in range(len(df.columns)))).select(*(f"c{i}" for i in carried)).checkpoint()
    placed = rows.withColumn("rid", F.monotonically_increasing_id())
    per_part = sorted((r.part, r.n) for r in placed.groupBy(F.shiftright("rid", 33).alias("part")).agg(
        F.count("*").alias("n")).collect())
    total = sum(n for _, n in per_part)
    matrix = communication_matrix([n for _, n in per_part], shard_sizes(total, shards), seed)
    bounds = spark.createDataFrame(
        [(part, [int(x) for x in np.cumsum(row)]) for (part, _), row in zip(per_part, matrix)],
        T.StructType([T.StructField("part", T.LongType()), T.StructField("ends", T.ArrayType(T.LongType()))]))

    local = placed.withColumn("h", F.xxhash64(F.lit(seed), "rid")).sortWithinPartitions("h", "rid")
    local = local.withColumn("at", F.monotonically_increasing_id())
    local = local.withColumn("part", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND(F.lit(LOW_33)))
    sent = local.join(small(bounds, len(per_part) * shards), "part").withColumn(
        "shard", F.size(F.filter("ends", lambda e: e <= F.col("at"))))

    ranges = 1 + total // (shards * range_rows)
    sent = sent.withColumn("h", F.xxhash64(F.lit(seed + 1), "rid")).withColumn(
        "range", F.pmod(F.xxhash64(F.lit(seed + 2), "rid"), F.lit(ranges)))
    ends = Window.partitionBy("shard").orderBy("range")
    filled = sent.groupBy("shard", "range").agg(F.count("*").alias("n")).withColumn(
        "before", F.sum("n").over(ends) - F.col("n")).drop("n")
    order = Window.partitionBy("shard", "range").orderBy("h", "rid")
    out = sent.withColumn("place", F.row_number().over(order)).join(
        small(filled, shards * ranges * 3), ["shard", "range"])
    return out.select(*(f"c{i}" for i in carried), F.col("shard").cast("int").alias("shard"),
                      (F.col("before") + F.col("place") - 1).cast("long").alias("slot")).toDF(*names, "shard", "slot")
