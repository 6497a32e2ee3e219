"""Exact, interpolated percentiles without one task per group.

Spark's ``percentile`` merges every distinct value of a group into one
buffer on one task.  Here the work is spread out:

1. ``(key, x) -> c``: value frequencies, combined map-side.
2. Blocks of distinct values per key, balanced by an approximate quantile
   sketch of those values (bounded memory); a block is a contiguous value
   range, so ranks can be counted block by block.
3. Exclusive prefix counts: per block (a small table), then a running count
   inside each block (a window over one block's distinct values).
4. The two ranks around ``p * (n - 1)`` are first looked up in the table of
   blocks, and then in those blocks alone, by joins; the value is interpolated linearly
   (same definition as ``percentile`` / ``quantile_cont``).

No group is ever gathered whole: the largest unit of work is one block's
distinct values, about ``distinct / blocks``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def frequencies(df: DataFrame, key: str, x: str, materialize: bool = True) -> DataFrame:
    """``key, x, _c``: how often each value occurs per key (map-side combined).

    The result is referenced several times by the percentile plan, so it is
    checkpointed to the shared folder (``spark.checkpoint.dir``): the input is
    scanned and aggregated once, and a lost executor does not force a
    recomputation from the source.
    """
    freq = df.where(F.col(x).isNotNull()).groupBy(key, x).agg(F.count(F.lit(1)).alias("_c"))
    if materialize:
        from celltide.storage import shared_root
        shared_root(df.sparkSession)
        freq = freq.checkpoint(eager=True)
    return freq


def exact_percentiles(df: DataFrame, key: str, x: str, ps: list[float], blocks: int = 64,
                      accuracy: int = 10_000, freq: DataFrame | None = None) -> DataFrame:
    """``key, p, value`` for each key and each fraction in ``ps`` (NULL ``x`` ignored).

    Pass ``freq`` (from ``frequencies``) to reuse one aggregation for several
    statistics.
    """
    if freq is None:
        freq = frequencies(df, key, x)
    cuts = [i / blocks for i in range(1, blocks)]
    if cuts:
        per_key = freq.groupBy(key).agg(F.sum("_c").alias("_n"),
                                        F.percentile_approx(x, cuts, accuracy).alias("_bounds"))
        # block = number of bounds <= x: monotone in x, about D / blocks values each
        freq = freq.join(per_key, key).withColumn(
            "_blk", F.size(F.filter("_bounds", lambda b: b <= F.col(x)))).drop("_bounds", "_n")
    else:
        per_key = freq.groupBy(key).agg(F.sum("_c").alias("_n"))
        freq = freq.withColumn("_blk", F.lit(0))
    blk_tot = freq.groupBy(key, "_blk").agg(F.sum("_c").alias("_bc"))
    before_blk = blk_tot.withColumn(
        "_before_blk",
        F.coalesce(F.sum("_bc").over(Window.partitionBy(key).orderBy("_blk")
                                     .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    in_blk = Window.partitionBy(key, "_blk").orderBy(x).rowsBetween(Window.unboundedPreceding, 0)
    ranked = (freq.join(before_blk.select(key, "_blk", "_before_blk"), [key, "_blk"])
              .withColumn("_start", F.col("_before_blk") + F.sum("_c").over(in_blk) - F.col("_c"))
              .withColumn("_end", F.col("_start") + F.col("_c") - 1))
    targets = per_key.select(key, "_n", F.explode(F.array(*[F.lit(float(p)) for p in ps])).alias("p")) \
        .withColumn("_h", F.col("p") * (F.col("_n") - 1)) \
        .withColumn("_rank", F.explode(F.array_distinct(F.array(F.floor("_h"), F.ceil("_h")))))
    # the block of each rank, then the value within it: (key, block) spreads a key over its blocks
    inside = (F.col("_rank") >= F.col("_before_blk")) & (F.col("_rank") < F.col("_before_blk") + F.col("_bc"))
    located = targets.join(before_blk, key).where(inside).select(key, "_blk", "p", "_h", "_rank")
    hit = (F.col("_start") <= F.col("_rank")) & (F.col("_rank") <= F.col("_end"))
    picked = ranked.select(key, "_blk", "_start", "_end", x).join(located, [key, "_blk"]).where(hit)
    v, low = F.col(x).cast("double"), F.floor("_h")
    return (picked.groupBy(key, "p", "_h")
            .agg(F.max(F.when(F.col("_rank") == low, v)).alias("_xlo"), F.max(F.when(F.col("_rank") == F.ceil("_h"), v)).alias("_xhi"))
            .select(key, "p", (F.col("_xlo") + (F.col("_h") - low) * (F.col("_xhi") - F.col("_xlo"))).alias("value")))
