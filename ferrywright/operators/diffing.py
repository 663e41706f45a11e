"""What changed between two versions of a table, and applying it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def datadiff(old: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows to delete and rows to insert, as multisets; rows on both sides are neither."""
    new = new.select(*old.columns)
    return old.exceptAll(new), new.exceptAll(old)


def datadiff_by_key(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(op, old, new)``: del, upd or ins for each key that differs, with both rows as structs.

    One full outer join on the key; columns are compared null-safe; unchanged rows go
    right after the join.
    """
    columns = old.columns
    values = [c for c in columns if c not in keys]
    o = old.select(F.struct(*columns).alias("old"), *[F.col(k).alias(f"_o_{k}") for k in keys])
    n = new.select(F.struct(*columns).alias("new"), *[F.col(k).alias(f"_n_{k}") for k in keys])
    both = o.join(n, [F.col(f"_o_{k}") == F.col(f"_n_{k}") for k in keys], "full_outer")
    same = F.lit(True)
    for c in values:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    op = F.when(F.col("new").isNull(), "del").when(F.col("old").isNull(), "ins").when(~same, "upd")
    return both.withColumn("op", op).where("op is not null").select("op", "old", "new")


def apply_diff(target: DataFrame, diff: DataFrame, keys: Sequence[str], before: Callable | None = None, after: Callable | None = None, after_all: Callable | None = None) -> DataFrame:
    """The target with a keyed diff applied; hooks get (target, deleted, updated, inserted) before and after, ``after_all`` the result."""
    gone, changed, fresh = (diff.where(F.col("op") == op) for op in ("del", "upd", "ins"))
    if before:
        before(target, gone, changed, fresh)
    touched = diff.where("op in ('del', 'upd')").select(*[F.col(f"old.{k}").alias(k) for k in keys])
    out = target.join(touched, list(keys), "left_anti").select(*target.columns).unionByName(diff.where("op in ('upd', 'ins')").select("new.*"))
    if after:
        after(out, gone, changed, fresh)
    if after_all:
        after_all(out)
    return out


def append_ignoring(target: DataFrame, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Insert rows whose key the target lacks; of repeated new keys the least row counts, by all its columns."""
    rows = rows.select(*target.columns)
    rest = [c for c in target.columns if c not in keys]
    one = rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_r")).select(*keys, "_r.*").select(*target.columns) if rest else rows.distinct()
    return target.unionByName(one.join(target.select(*keys), list(keys), "left_anti").select(*target.columns))


def replace_where(target: DataFrame, rows: DataFrame, condition: str) -> DataFrame:
    """Delete rows that meet a condition, then append; rows for which it is unknown stay."""
    return target.where(~F.coalesce(F.expr(condition), F.lit(False))).unionByName(rows.select(*target.columns))
