"""Mergeable quantile sketches per interval (A3).

A sketch is the histogram of a metric over cells whose bounds grow by a fixed ratio: cell ``i`` holds the values from above
``g**(i-1)`` to ``g**i`` with ``g = (1 + e) / (1 - e)``, mirrored for negative values, and 0 has a cell of its own.  A value is known
from its cell within the relative error ``e``, so each quantile is too.  Sketches are rows (interval, metric, cell, n): they
are built by a map-side combined count, also in a stream, and merged over any longer range by adding counts.  A metric has
at most a few thousand cells, however many values.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Added to a cell's exponent, so that the sign of the value can be the sign of the cell.
_SHIFT = 1 << 40


def _log_ratio(error: float) -> float:
    if not 0 < error < 1:
        raise ValueError(f"error is between 0 and 1, not {error}")
    return math.log((1 + error) / (1 - error))


def cell_of(x: Column, error: float) -> Column:
    """The cell of a value; cells ascend with the values."""
    exponent = F.ceil(F.ln(F.abs(x)) / F.lit(_log_ratio(error))) + F.lit(_SHIFT)
    return F.when(x == 0, F.lit(0)).when(x > 0, exponent).otherwise(-exponent).cast("long")


def value_of(cell: Column, error: float) -> Column:
    """The value that stands for a cell: no value of the cell is further from it than ``error`` times itself."""
    ratio = math.exp(_log_ratio(error))
    middle = F.exp((F.abs(cell) - F.lit(_SHIFT)) * F.lit(_log_ratio(error))) * F.lit(2 / (1 + ratio))
    return F.when(cell == 0, F.lit(0.0)).otherwise(F.signum(cell) * middle)


def interval_sketches(samples: DataFrame, every: str, error: float = 0.01, ts_col: str = "ts", x_col: str = "x", keys: tuple[str, ...] = ("metric",)) -> DataFrame:
    """``bucket, <keys>, cell, n`` of each interval; null, NaN and infinite values are left out.  Also for a stream (update mode)."""
    x = F.col(x_col).cast("double")
    finite = samples.where(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(math.inf)))
    return finite.groupBy(F.window(ts_col, every).alias("w"), *keys, cell_of(x, error).alias("cell")).agg(F.count(F.lit(1)).alias("n")) \
        .select(F.col("w.start").alias("bucket"), *keys, "cell", "n")


def interval_sketches_stream(samples: DataFrame, every: str, delay: str = "0 seconds", error: float = 0.01, ts_col: str = "ts", **columns) -> DataFrame:
    """The same of a stream: state holds the cells of intervals that the watermark has not passed."""
    return interval_sketches(samples.withWatermark(ts_col, delay), every, error, ts_col, **columns)


def merged(sketches: DataFrame, by: tuple[Column | str, ...]) -> DataFrame:
    """Sketches added up over ``by``, such as a day and a metric."""
    return sketches.groupBy(*by, "cell").agg(F.sum("n").alias("n"))


def sketch_quantiles(sketches: DataFrame, keys: tuple[str, ...], ps: list[float], error: float = 0.01) -> DataFrame:
    """``<keys>, p, n, value``: the value at rank ``floor(p * (n - 1))``, within ``error`` of it."""
    order = Window.partitionBy(*keys).orderBy("cell")
    upto = sketches.withColumn("_upto", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("_all", F.sum("n").over(Window.partitionBy(*keys)))
    wanted = F.explode(F.array(*(F.lit(float(p)) for p in ps)))
    ranked = upto.select(*keys, "cell", "n", "_upto", "_all", wanted.alias("p")).withColumn("_rank", F.floor(F.col("p") * (F.col("_all") - 1)))
    return ranked.where((F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("n"))) \
        .select(*keys, "p", F.col("_all").alias("n"), value_of(F.col("cell"), error).alias("value"))
