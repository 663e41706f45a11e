"""Exact medians and percentiles of groups of any size, by rounds of range counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ferrywright.scratch import checkpoint

#: Groups with open ranks up to which they are broadcast to the rows; beyond it both sides are shuffled.
BROADCAST_GROUPS = 100_000


def group_percentiles(df: DataFrame, by: Sequence[str], value: str, fractions: Sequence[float] = (0.5,), bins: int = 256) -> DataFrame:
    """``(*by, fraction, value)``: the percentiles of a column, between two values in proportion, as the built-in ones have it.

    The built-in functions hold all values of a group. Here each wanted rank has a range of values; a round counts the rows of the range
    in ``bins`` parts of equal width, with the least and greatest value of each, and the part that holds the rank is the next
    range, until it is one value. Only counts are shuffled, at most ``bins`` for a task and rank, so a group may hold any share of
    all rows. A round reads ``df`` once; a range of w values apart by d takes about log(w / d) / log(bins) rounds. Null values and NaN count
    nowhere; a null group is a group; groups without values have no row; the values come as doubles.
    """
    by = list(by)
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).where("_v is not null and not isnan(_v)")
    sizes = checkpoint(rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")))
    wanted = sizes.withColumn("fraction", F.explode(F.array(*[F.lit(float(f)) for f in fractions])))
    at = F.col("fraction") * (F.col("_n") - 1)
    wanted = wanted.withColumns({"_k0": F.floor(at).cast("long"), "_k1": F.ceil(at).cast("long"), "_part": at - F.floor(at)})
    state = checkpoint(wanted.select(*by, "_lo", "_hi", F.explode(F.array("_k0", "_k1")).alias("_k")).distinct().withColumn("_below", F.lit(0).cast("long")))
    same = lambda a, b: reduce(lambda x, y: x & y, [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in by], F.lit(True))
    while True:
        still = state.where("_lo < _hi")
        n = still.count()
        if not n:
            break
        asked = F.broadcast(still) if n <= BROADCAST_GROUPS else still
        held = rows.alias("r").join(asked.alias("s"), same("r", "s") & F.col("r._v").between(F.col("s._lo"), F.col("s._hi"))).select("s.*", "r._v")
        # Halves, as the distance of two doubles may be beyond the greatest one.
        share = (F.col("_v") / 2 - F.col("_lo") / 2) / (F.col("_hi") / 2 - F.col("_lo") / 2)
        bin_of = F.least(F.lit(bins - 1), F.floor(share * bins).cast("int"))
        counts = held.groupBy(*by, "_k", "_below", bin_of.alias("_bin")).agg(F.count(F.lit(1)).alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        # At most ``bins`` rows of a rank in a window.
        upto = F.sum("_c").over(Window.partitionBy(*by, "_k").orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0))
        placed = counts.withColumn("_upto", F.col("_below") + upto).where("_k < _upto and _k >= _upto - _c")
        following = placed.select(*by, "_lo", "_hi", "_k", (F.col("_upto") - F.col("_c")).alias("_below"))
        state = checkpoint(state.where("_lo >= _hi").unionByName(following))
    low, high = state.alias("a"), state.alias("b")
    out = wanted.alias("w").join(low, same("w", "a") & (F.col("w._k0") == F.col("a._k"))).join(high, same("w", "b") & (F.col("w._k1") == F.col("b._k")))
    between = F.col("a._lo") + (F.col("b._lo") - F.col("a._lo")) * F.col("w._part")
    return out.select(*[F.col(f"w.{c}").alias(c) for c in by], F.col("w.fraction").alias("fraction"), between.alias("value"))


def group_median(df: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """``(*by, value)``: the exact median of each group."""
    return group_percentiles(df, by, value).drop("fraction")
