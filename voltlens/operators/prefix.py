"""Running totals and ranks along an ordered key without an un-partitioned window.

A window with no PARTITION BY (or partitioned by a key that may hold a third
of the rows) funnels everything through one task. Here the rows are dealt into
ranges of the order key by Spark's range partitioning (bounds from a sample of
the rows, any sortable type), written once with their range number, and every
range is summed. The range offsets come from a window over that small table
(groups x ranges rows) and the running total is finished by a window
partitioned by (group, range). There are as many ranges as shuffle partitions,
whatever the size of the input, and one code path for every size.

Callers pass rows that are unique on (group, order key): aggregate ties first
(counts per distinct score), which also removes hot keys. Order values sort as
Spark sorts them: NaN is the largest number; NULL comes last in either direction.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_BUCKET = "_vl_bucket"
#: A table of at most this many rows may be broadcast.
BROADCAST_ROWS = 200_000


def _as_list(x):
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def materialize(df: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and continue from the
    files: later passes read them instead of recomputing the plan below, and
    lineage is cut for recovery. Its shuffles go when it is written. ``path``: where, for a
    caller that removes the table; ``options``: of the writer."""
    from voltlens.session import FREE_SHUFFLES, scratch_path, settings

    path = path or scratch_path(df.sparkSession, "table")
    with settings(df.sparkSession, FREE_SHUFFLES):
        df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_checked(small: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``small`` written once and, if it has at most ``max_rows`` rows, hinted
    for a broadcast; larger tables join by shuffle, where adaptive execution
    splits skewed partitions."""
    kept = materialize(small)
    return F.broadcast(kept) if kept.count() <= max_rows else kept


def with_group_values(df: DataFrame, small: DataFrame, by) -> DataFrame:
    """Attach per-group values (totals, cut points) to every row.

    With group keys this is an equi-join with a side of checked size, so rows of
    a large group are not moved; for a global value (no keys) the single
    aggregate row is read on the driver and added as literals, so no join
    without keys (and no nested-loop join) is planned."""
    by = _as_list(by)
    if by:
        return df.join(broadcast_checked(small), on=by, how="inner")
    row = small.first()
    vals = {c: F.lit(None if row is None else row[c]).cast(small.schema[c].dataType)
            for c in small.columns}
    return df.withColumns(vals)


def running_sum(df: DataFrame, order_cols, sum_cols, by=None, descending: bool = False,
                ranges: int | None = None, suffix: str = "_cum", totals: bool = False) -> DataFrame:
    """Inclusive running sums of ``sum_cols`` along ``order_cols`` inside ``by``.

    Adds ``<c><suffix>`` for every summed column and, with ``totals``, the
    group's sum as ``<c>_total``. ``ranges``: number of ranges (default: the
    session's shuffle partitions); it never changes the result.
    """
    order_cols, sum_cols, by = _as_list(order_cols), _as_list(sum_cols), _as_list(by)
    n = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sort = [F.col(c).desc_nulls_last() if descending else F.col(c).asc_nulls_last() for c in order_cols]
    # the groups' columns follow the order key, so many groups at one value are cut as well
    dealt = materialize(df.repartitionByRange(n, *sort, *[F.col(c).asc() for c in by])
                          .withColumn(_BUCKET, F.spark_partition_id()))

    tot = dealt.groupBy(*by, _BUCKET).agg(*[F.sum(c).alias(c) for c in sum_cols])
    group = Window.partitionBy(*[F.col(c) for c in by]) if by else Window.partitionBy(F.lit(0))
    before = group.orderBy(_BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    keys = [F.col(c).alias(f"_vl_g{i}") for i, c in enumerate(by)]
    off = tot.select(*keys, F.col(_BUCKET).alias("_vl_b"),
                     *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_off_{c}") for c in sum_cols],
                     *([F.sum(c).over(group).alias(f"{c}_total") for c in sum_cols] if totals else []))
    cond = F.col(_BUCKET) == F.col("_vl_b")
    for i, c in enumerate(by):
        cond = cond & F.col(c).eqNullSafe(F.col(f"_vl_g{i}"))
    joined = dealt.join(off, cond, "inner")

    w = (Window.partitionBy(*[F.col(c) for c in by], F.col(_BUCKET)).orderBy(*sort)
               .rowsBetween(Window.unboundedPreceding, 0))
    out = joined.select("*", *[(F.sum(c).over(w) + F.col(f"_off_{c}")).alias(f"{c}{suffix}") for c in sum_cols])
    return out.drop(_BUCKET, "_vl_b", *[f"_vl_g{i}" for i in range(len(by))], *[f"_off_{c}" for c in sum_cols])


def row_rank(df: DataFrame, order_cols, by=None, descending: bool = False,
             name: str = "rank", ranges: int | None = None, size_name: str | None = None) -> DataFrame:
    """1-based position along ``order_cols`` inside ``by`` (a scalable
    row_number); with ``size_name`` also the group's number of rows."""
    one = "_vl_one"
    out = running_sum(df.withColumn(one, F.lit(1).cast("long")), order_cols, [one], by=by,
                      descending=descending, ranges=ranges, totals=bool(size_name))
    out = out.withColumnRenamed(f"{one}_cum", name).drop(one)
    return out.withColumnRenamed(f"{one}_total", size_name) if size_name else out


def dense_codes(df: DataFrame, value_col: str, by=None, name: str = "code",
                ranges: int | None = None) -> DataFrame:
    """Dictionary of distinct non-null values -> 0..n-1 in sorted order, per ``by``.

    Returns ``(by..., value_col, name)``. Text sorts by its UTF-8 bytes; the
    ranges are cut on the whole value."""
    by = _as_list(by)
    d = df.select(*by, value_col).where(F.col(value_col).isNotNull()).distinct()
    r = row_rank(d, [value_col], by=by, name=name, ranges=ranges)
    return r.select(*by, value_col, (F.col(name) - 1).alias(name))
