"""Duplicates: distinct, keep-first, counts and flags.

Keep-first is a hash aggregation (``min`` of the BIGINT ingest ordinal) rather than
``row_number`` over a window: ordinals are combined map-side, so a key that holds a
third of the table never lands whole in one task, and only the keys that occur
more than once are joined back to the rows. Group sizes are a ``count`` joined back; adaptive execution
splits a skewed join partition, and NULL keys of a single column are counted
apart, without a join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlens.functions.schema import q
from voltlens.functions.scalars import is_missing_text
from voltlens.operators.prefix import broadcast_checked


def distinct_rows(df: DataFrame) -> DataFrame:
    """A1: full-row distinct; NULLs compare equal."""
    return df.distinct()


def distinct_spread(df: DataFrame) -> DataFrame:
    """Full-row distinct of rows that are first dealt by a hash of all columns. A map task that combines its rows
    before the shuffle holds every row of its file split, and a split of well compressed text is many rows; here
    a task holds one shuffle partition, whose size adaptive execution bounds."""
    return df.repartition(*[F.col(q(c)) for c in df.columns]).distinct()


def row_hash(df: DataFrame, names=None) -> "F.Column":
    """64-bit hash of a row's columns."""
    return F.xxhash64(*[F.col(q(c)) for c in names or df.columns])


def keep_first(df: DataFrame, keys, order_col: str | None = "_ord", keep_order: bool = True, unique: bool = True) -> DataFrame:
    """First row per ``keys`` by ``order_col``, a BIGINT ordinal that no two rows share (see
    ``files.with_ordinal``). NULL keys are equal.

    A hash aggregation finds the keys with more than one row and their first ordinal; only
    these are joined back (broadcast when they are few, by shuffle beyond), so neither
    rows nor text are sorted. The ordinal column is kept when ``keep_order``.

    ``unique=False``: rows may share an ordinal (a join has repeated them) or have none
    (``order_col=None``); the smallest row hash then decides, so the result is repeatable.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if not unique or order_col is None:
        # ordinal and hash side by side in one fixed-width number
        wide = F.lit(0) if order_col is None else F.col(q(order_col))
        packed = wide.cast("decimal(19,0)") * F.lit("18446744073709551616").cast("decimal(20,0)") + row_hash(df).cast("decimal(20,0)")
        first = keep_first(df.withColumn("_vl_packed", packed.cast("decimal(38,0)")), keys, "_vl_packed", False).distinct()
        return first if keep_order or order_col is None else first.drop(order_col)
    low = F.min(F.col(q(order_col)))
    if not [c for c in df.columns if c not in keys and c != order_col]:
        first = df.groupBy(*[q(k) for k in keys]).agg(low.alias(order_col)).select(*[q(c) for c in df.columns])
        return first if keep_order else first.drop(order_col)
    several = df.groupBy(*[F.col(q(k)).alias(f"_vl_k{i}") for i, k in enumerate(keys)]).agg(
        low.alias("_vl_first"), F.count(F.lit(1)).alias("_vl_n")).where("_vl_n > 1").drop("_vl_n")
    cond = None
    for i, k in enumerate(keys):
        same = F.col(q(k)).eqNullSafe(F.col(f"_vl_k{i}"))
        cond = same if cond is None else cond & same
    out = df.join(broadcast_checked(several), cond, "left")
    out = out.where(F.col("_vl_first").isNull() | (F.col(q(order_col)) == F.col("_vl_first")))
    return out.select(*[q(c) for c in df.columns if keep_order or c != order_col])


def group_sizes(df: DataFrame, keys, name: str = "_vl_n", null_keys_equal: bool = True,
                salt: int = 1) -> DataFrame:
    """Attach the size of each row's key group (W1 building block).

    Counts are pre-aggregated map-side; adaptive execution splits a skewed
    join partition. With ``salt > 1`` the join is also salted explicitly: every
    row gets a deterministic salt from a hash of its content (stable when a
    task is recomputed) and the count table is replicated ``salt`` times, so
    one hot key is spread over ``salt`` join tasks even without AQE."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    counts = df.groupBy(*[q(k) for k in keys]).agg(F.count(F.lit(1)).alias(name))
    if salt > 1:
        s = "_vl_salt"
        big = df.withColumn(s, F.pmod(F.xxhash64(*[F.col(q(c)) for c in df.columns]), F.lit(salt)))
        small = counts.withColumn(s, F.explode(F.sequence(F.lit(0), F.lit(salt - 1)).cast("array<bigint>")))
        renamed = small.withColumnsRenamed({k: f"_vl_k_{i}" for i, k in enumerate(keys)})
        cond = [big[q(k)].eqNullSafe(F.col(f"_vl_k_{i}")) if null_keys_equal else big[q(k)] == F.col(f"_vl_k_{i}")
                for i, k in enumerate(keys)] + [big[s] == renamed[s]]
        return big.join(renamed, on=cond, how="left").drop(s, *[f"_vl_k_{i}" for i in range(len(keys))])
    if null_keys_equal and len(keys) == 1:
        # the NULL group is one number: it needs no join, so it is no hot key
        k = q(keys[0])
        nulls = df.where(F.col(k).isNull()).count()
        known = counts.where(F.col(k).isNotNull()).withColumnsRenamed({keys[0]: "_vl_k_0", name: "_vl_known"})
        out = df.join(known, F.col(k) == F.col("_vl_k_0"), "left")
        size = F.when(F.col(k).isNull(), F.lit(nulls).cast("long")).otherwise(F.col("_vl_known"))
        return out.withColumn(name, size).drop("_vl_k_0", "_vl_known")
    if null_keys_equal:
        renamed = counts.withColumnsRenamed({k: f"_vl_k_{i}" for i, k in enumerate(keys)})
        cond = [df[q(k)].eqNullSafe(F.col(f"_vl_k_{i}")) for i, k in enumerate(keys)]
        return df.join(renamed, on=cond, how="left").drop(*[f"_vl_k_{i}" for i in range(len(keys))])
    return df.join(counts, on=keys, how="left")


def duplicated_flag(df: DataFrame, keys, name: str = "is_dup") -> DataFrame:
    """``duplicated(keep=False)``: true for every row of a group with > 1 rows."""
    out = group_sizes(df, keys)
    return out.withColumn(name, F.col("_vl_n") > 1).drop("_vl_n")


def recurrence_flag(df: DataFrame, key: str = "item_288", name: str = "reincidente") -> DataFrame:
    """SI when the customer number occurs more than once, else NO."""
    out = group_sizes(df, [key])
    return out.withColumn(name, F.when(F.col("_vl_n") > 1, F.lit("SI")).otherwise(F.lit("NO"))).drop("_vl_n")


def duplicate_count(df: DataFrame, keys) -> DataFrame:
    """A3: number of rows that belong to a key group of size > 1 (one row)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    g = df.groupBy(*[q(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).cast("long").alias("duplicate_rows"),
                 F.coalesce(F.sum(F.when(F.col("n") > 1, F.lit(1))), F.lit(0)).cast("long").alias("duplicate_groups"))


def drop_unrevised_duplicates(df: DataFrame, key: str = "Orden", revision: str = "Revision") -> DataFrame:
    """Drop rows duplicated on ``key`` whose revision is missing (NULL or 'nan').

    A revised row stays whatever its group, so it is not moved. A missing row stays where it is alone: only these
    rows meet the keys that occur once, with no revised row. NULL keys are equal; of several NULL keys none is alone."""
    missing = is_missing_text(revision)
    alone = df.groupBy(F.col(q(key)).alias("_vl_k")).agg(
        F.count(F.lit(1)).alias("_vl_n"), F.count(F.when(missing, 1)).alias("_vl_m")).where("_vl_n = 1 AND _vl_m = 1")
    few = df.where(missing).join(alone, F.col(q(key)).eqNullSafe(F.col("_vl_k")), "left_semi")
    return df.where(~missing).union(few)
