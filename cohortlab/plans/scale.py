"""Plan helpers that keep operators distributed at any scale.

* :func:`with_scalars` attaches a global aggregate (exactly one row by
  construction) to every row of a frame.  The one-row side is broadcast; its
  size bound is structural, not data dependent.
* :func:`exact_ntile` is an exact, tie-deterministic ``NTILE(n) OVER (ORDER BY
  ...)`` that never moves all rows into one task (a window without
  ``PARTITION BY`` would).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_POS_BITS = 33  # monotonically_increasing_id = (partition index << 33) + position


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row global aggregate to every row of ``df``.

    ``one_row`` must be an ungrouped aggregate (``df.agg(...)``), which Spark
    guarantees to return exactly one row, so broadcasting it is always safe.
    """
    return df.join(F.broadcast(one_row), how="inner")


def scalars(*frames: DataFrame) -> DataFrame:
    """Combine several one-row aggregates into one row."""
    out = frames[0]
    for f in frames[1:]:
        out = out.join(F.broadcast(f), how="inner")
    return out


def _ordering(order_cols) -> list[Column]:
    out = []
    for c in order_cols:
        out.append(F.col(c).asc_nulls_first() if isinstance(c, str) else c)
    return out


def global_ranks(df: DataFrame, order_cols, group_cols=(), num_ranges: int | None = None, max_groups: int | None = None) -> DataFrame:
    """Add ``_rank`` (1-based position in ``order_cols`` order within each
    group) and ``_total`` (rows in the group) without a single-task window.

    ``order_cols`` should end with a unique key when ties must be
    deterministic.  Plan:

    1. range-partition on (group, order) — the sampled bounds split even one
       hot value when a unique key is part of the range key — sort within
       partitions and number rows with ``monotonically_increasing_id``;
    2. checkpoint that numbered frame to the shared checkpoint folder, so the
       sampled ranges and positions are fixed for the passes below and the
       lineage survives executor loss;
    3. count rows per (range, group): ranges hold contiguous blocks of
       groups, so this frame has at most ``num_ranges + #groups`` rows, and
       running sums over it give each range's offset within its group;
    4. join the offsets back and derive the rank.  The offsets are broadcast
       when their size is proven: no groups (≤ ``num_ranges`` rows) or a
       caller-supplied bound ``max_groups`` (≤ ``num_ranges + max_groups``
       rows); otherwise the planner decides from its size estimate.
    """
    from cohortlab.session import checkpoint_dir

    spark = df.sparkSession
    if num_ranges is None:
        num_ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = list(group_cols)
    order = _ordering(groups) + _ordering(order_cols)
    numbered = (
        df.repartitionByRange(num_ranges, *order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
        .withColumn("_pid", F.shiftright(F.col("_mid"), _POS_BITS))
        .withColumn("_pos", F.col("_mid").bitwiseAND((1 << _POS_BITS) - 1))
        .drop("_mid")
    )
    checkpoint_dir(spark)
    numbered = numbered.checkpoint(eager=True)
    counts = numbered.groupBy("_pid", *groups).agg(F.count(F.lit(1)).alias("_cnt"), F.min("_pos").alias("_first"))
    before = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups).orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = counts.select(
        "_pid",
        *groups,
        F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"),
        F.sum("_cnt").over(whole).alias("_total"),
        "_first",
    )
    n, o = numbered.alias("_n"), offsets.alias("_o")
    if not groups or max_groups is not None:
        o = F.broadcast(o)
    # null-safe on the group columns: a NULL group is a group of its own
    cond = F.col("_n._pid") == F.col("_o._pid")
    for g in groups:
        cond = cond & F.col(f"_n.{g}").eqNullSafe(F.col(f"_o.{g}"))
    ranked = n.join(o, cond).select("_n.*", "_o._off", "_o._total", "_o._first")
    ranked = ranked.withColumn("_rank", F.col("_off") + F.col("_pos") - F.col("_first") + 1)
    return ranked.drop("_pid", "_pos", "_off", "_first")


def staged(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read
    back.  The planner then knows its true size: it broadcasts a small frame
    without shuffling what it is joined with, and sort-merges a large one."""
    import uuid

    from cohortlab.session import checkpoint_dir

    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a :func:`staged` frame that is no longer needed."""
    files = df.inputFiles()
    folder = files[0].rsplit("/", 1)[0] if files else ""
    if "/staged-" in folder:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def ntile_of_rank(rank: str, total: str, n: int) -> Column:
    """Tile of a 1-based rank among ``total`` rows: with ``q = N // n`` and
    ``r = N % n`` the first ``r`` tiles hold ``q + 1`` rows."""
    rank, total = F.col(rank), F.col(total)
    q = F.floor(total / n).cast("long")
    r = (total % n).cast("long")
    big = r * (q + 1)
    late = F.floor(F.try_divide(rank - big - 1, q))
    return F.when(rank <= big, F.floor((rank - 1) / (q + 1)) + 1).otherwise(r + late + 1).cast("long")


def exact_ntile(df: DataFrame, n: int, order_cols, out_col: str = "tile", num_ranges: int | None = None) -> DataFrame:
    """Exact ``NTILE(n) OVER (ORDER BY order_cols)`` on top of
    :func:`global_ranks`."""
    ranked = global_ranks(df, order_cols, (), num_ranges)
    return ranked.withColumn(out_col, ntile_of_rank("_rank", "_total", n)).drop("_total", "_rank")


def exact_quantiles(df: DataFrame, value_col: str, probs, group_cols=(), num_ranges: int | None = None, max_groups: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (position ``(n-1)·p``) per
    group, NULLs ignored.  Distributed: ranks come from :func:`global_ranks`
    and only the (at most two) rows bracketing each position are kept by a
    partial aggregate — no group's values are gathered in one task.
    Output: group columns, ``q0``, ``q1``, … in the order of ``probs``."""
    groups = list(group_cols)
    vals = df.select(*groups, F.col(value_col).cast("double").alias("_v")).filter(F.col("_v").isNotNull())
    ranked = global_ranks(vals, ["_v"], groups, num_ranges, max_groups)
    n1 = F.col("_total") - 1
    aggs = [F.max("_total").alias("_n")]
    for i, p in enumerate(probs):
        h = n1.cast("double") * float(p)
        lo = F.floor(h).cast("long") + 1
        hi = F.ceil(h).cast("long") + 1
        aggs.append(F.max(F.when(F.col("_rank") == lo, F.col("_v"))).alias(f"_lo{i}"))
        aggs.append(F.max(F.when(F.col("_rank") == hi, F.col("_v"))).alias(f"_hi{i}"))
    agg = ranked.groupBy(*groups).agg(*aggs)
    outs = []
    for i, p in enumerate(probs):
        h = (F.col("_n") - 1).cast("double") * float(p)
        frac = h - F.floor(h).cast("double")
        outs.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * frac).alias(f"q{i}"))
    return agg.select(*groups, *outs)
