"""Latest-row-per-key and global ranking without single-task bottlenecks.

``latest_per_key`` replaces ``ROW_NUMBER() OVER (PARTITION BY key ORDER BY d DESC) = 1``
with a ``max_by`` aggregate. An aggregate is combined map-side before the shuffle,
so a key that holds a third of all rows is reduced to one row per task first; a
window would pull the whole key into one task.

``global_row_number`` replaces ``ROW_NUMBER() OVER (ORDER BY ...)`` (no partition:
Spark would move every row into one task) with the classic two-pass scheme:
range-partition by the sort key, number rows inside each partition, then add the
row count of all earlier partitions. The per-partition count table has exactly
``num_partitions`` rows, so broadcasting it has a proven bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterdeck.plans.storage import checkpointed


def order_key(order: Column | str, tie_break: Column) -> Column:
    """Sort key of "latest": a NULL loses against any value (DESC NULLS LAST), ties go to the greatest ``tie_break``."""
    c = F.col(order) if isinstance(order, str) else order
    return F.struct(c.isNotNull().alias("_nn"), c.alias("_v"), tie_break.alias("_tie"))


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str] | str,
    order: str = "report_date",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One row per ``keys``: the row with the greatest ``order`` value (NULL orders last).

    Equivalent to keeping ``row_number() = 1`` over ``ORDER BY order DESC, <all other columns> DESC``:
    rows that tie on ``order`` are decided by their values, so the result does not depend
    on partitioning. NULL keys are kept (one row for the NULL group), as a window partition would.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = [c for c in (columns or df.columns) if c not in keys]
    payload = F.struct(*[F.col(c) for c in cols])
    return (
        df.groupBy(*keys)
        .agg(F.max_by(payload, order_key(order, payload)).alias("_latest"))
        .select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in cols])
    )


def global_row_number(
    df: DataFrame,
    order: Sequence[Column],
    name: str = "row_number",
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``name`` = 1-based position of each row in the total order ``order``.

    ``order`` must be a total order (end it with a unique column) so that the
    numbering is deterministic. Steps:

    1. ``repartitionByRange`` on the full sort key: Spark samples the key and cuts
       balanced ranges, so heavy ties in the leading column still spread out;
    2. sort inside each partition and take the position from
       ``monotonically_increasing_id`` (partition id in the upper bits);
    3. materialise that once (reliable checkpoint), so both uses below see the same
       partition assignment even if an executor is lost;
    4. count rows per partition once: ``num_partitions`` numbers, the same
       per-partition counts RDD ``zipWithIndex`` gathers; prefix-sum them and
       broadcast the offsets back (a table of exactly ``num_partitions`` rows).
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    pid = F.spark_partition_id()
    tagged = (
        df.repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .withColumn("_pid", pid)
        .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(pid.cast("bigint"), 33))
    )
    tagged = checkpointed(tagged)
    counts = {r["_pid"]: r["_n"] for r in tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n")).collect()}
    running, rows = 0, []
    for p in range(n):
        rows.append((p, running))
        running += counts.get(p, 0)
    offsets = spark.createDataFrame(rows, "_pid int, _off bigint")
    return (
        tagged.join(F.broadcast(offsets), "_pid")
        .withColumn(name, F.col("_off") + F.col("_pos") + 1)
        .drop("_pid", "_pos", "_off")
    )


def report_rank(desc_by: str = "report_date", key: str = "ticker") -> Column:
    """``RANK() OVER (PARTITION BY key ORDER BY desc_by DESC)`` as BIGINT."""
    return F.rank().over(Window.partitionBy(key).orderBy(F.col(desc_by).desc())).cast("bigint")


def previous_and_rank(
    df: DataFrame,
    key: str,
    order: str,
    lag_columns: Sequence[str],
    rank_name: str = "report_rank",
) -> DataFrame:
    """LAG of ``lag_columns`` over ``(key, order)`` and RANK over ``order`` DESC, without a
    window: no task ever holds a whole key.

    Adds ``_prev_<col>`` for each lag column and ``rank_name`` (BIGINT). Same values
    as ``LAG(col) OVER (PARTITION BY key ORDER BY order)`` and
    ``RANK() OVER (PARTITION BY key ORDER BY order DESC)`` (NULL keys form their own
    group, NULL orders sort first ascending / last descending; rows tied on
    ``order`` take an arbitrary but fixed order, as in the window form).

    1. every row gets its global position ``_g`` in ``(key, order)`` order from
       :func:`global_row_number`: range partitions split a heavy key over many tasks;
    2. the previous row is the row at ``_g - 1`` when it has the same key: an equi-join
       on the unique position, so both sides are evenly spread;
    3. ``rank = 1 + last position of the key - last position of (key, order)``; the
       two "last position" tables are map-side-combined aggregates joined back with
       null-safe keys (AQE splits a heavy key on the probe side).
    """
    ordering = [F.col(key).asc_nulls_first(), F.col(order).asc_nulls_first()]
    ranked = global_row_number(df, ordering, "_g")
    prev = ranked.select(
        (F.col("_g") + 1).alias("_g"),
        F.col(key).alias("_pk"),
        *[F.col(c).alias(f"_pv_{c}") for c in lag_columns],
    )
    out = ranked.join(prev, "_g", "left")
    same = F.col("_pk").eqNullSafe(F.col(key))
    out = out.select(
        *[F.col(c) for c in ranked.columns],
        *[F.when(same, F.col(f"_pv_{c}")).alias(f"_prev_{c}") for c in lag_columns],
    )
    last_k = ranked.groupBy(F.col(key).alias("_k1")).agg(F.max("_g").alias("_last_k"))
    last_kd = ranked.groupBy(F.col(key).alias("_k2"), F.col(order).alias("_o2")).agg(F.max("_g").alias("_last_kd"))
    out = out.join(last_k, F.col(key).eqNullSafe(F.col("_k1")), "left")
    out = out.join(last_kd, F.col(key).eqNullSafe(F.col("_k2")) & F.col(order).eqNullSafe(F.col("_o2")), "left")
    rank = (F.lit(1) + F.col("_last_k") - F.col("_last_kd")).cast("bigint")
    return out.withColumn(rank_name, rank).drop("_g", "_k1", "_last_k", "_k2", "_o2", "_last_kd")
