"""Routing rows to named partitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def partition_name(table: str, position: Column | int | None, sub: Column | int | None = None) -> Column:
    """``<table>_part<n>[_subpart<m>]``, and ``<table>_part_default`` without a position."""
    as_text = lambda p: p.cast("string") if isinstance(p, Column) else F.lit(str(p))
    if position is None:
        return F.lit(f"{table}_part_default")
    name = F.concat(F.lit(f"{table}_part"), as_text(position))
    return name if sub is None else F.concat(name, F.lit("_subpart"), as_text(sub))


def range_position(columns: Sequence[Column], bounds: Sequence[Sequence]) -> Column:
    """Number of the first partition whose upper bounds are above the row, compared column by column; None stands for MAXVALUE; null if there is none.

    Bounds are a catalog's list, a literal; nulls belong to no bound but MAXVALUE.
    """
    out = F.lit(None).cast("int")
    for position in range(len(bounds), 0, -1):
        below, tied = F.lit(False), F.lit(True)
        for c, bound in zip(columns, bounds[position - 1], strict=True):
            if bound is None:
                below = below | tied
                break
            below = below | (tied & F.coalesce(c < F.lit(bound), F.lit(False)))
            tied = tied & F.coalesce(c == F.lit(bound), F.lit(False))
        out = F.when(below, position).otherwise(out)
    return out


def range_partition(df: DataFrame, table: str, columns: Sequence[str], bounds: Sequence[Sequence], default: bool = True) -> DataFrame:
    """Add ``partition_name`` by RANGE; rows above all bounds go to the default, or are an error at write time if there is none (null)."""
    position = range_position([F.col(c) for c in columns], bounds)
    return df.withColumn("partition_name", F.when(position.isNotNull(), partition_name(table, position)).otherwise(partition_name(table, None) if default else F.lit(None)))


def list_position(column: Column, lists: Sequence[Sequence]) -> Column:
    out = F.lit(None).cast("int")
    for position in range(len(lists), 0, -1):
        values = [v for v in lists[position - 1] if v is not None]
        hit = F.coalesce(column.isin(*values), F.lit(False)) if values else F.lit(False)
        if len(values) < len(lists[position - 1]):
            hit = hit | column.isNull()
        out = F.when(hit, position).otherwise(out)
    return out


def list_partition(df: DataFrame, table: str, column: str, lists: Sequence[Sequence], default: bool = True) -> DataFrame:
    position = list_position(F.col(column), lists)
    return df.withColumn("partition_name", F.when(position.isNotNull(), partition_name(table, position)).otherwise(partition_name(table, None) if default else F.lit(None)))


def hash_position(columns: Sequence[str], n: int, modulo: bool = False) -> Column:
    """Partition 1..n: by a hash of the columns, or with ``modulo`` by the value of one whole number."""
    value = F.col(columns[0]).cast("long") if modulo else F.xxhash64(*columns)
    return (F.pmod(F.coalesce(value, F.lit(0)), F.lit(n)) + 1).cast("int")


def hash_partition(df: DataFrame, table: str, columns: Sequence[str], n: int, modulo: bool = False) -> DataFrame:
    return df.withColumn("partition_name", partition_name(table, hash_position(columns, n, modulo)))


def reference_partition(child: DataFrame, parent: DataFrame, foreign: str, key: str, table: str, parent_table: str) -> DataFrame:
    """A child row goes to the partition of its parent, under its own table's name; orphans to the default."""
    names = parent.select(F.col(key).alias("_key"), F.col("partition_name").alias("_parent"))
    joined = child.join(names, F.col(foreign) == F.col("_key"), "left")
    own = F.concat(F.lit(table), F.expr(f"substr(_parent, {len(parent_table) + 1})"))
    return joined.withColumn("partition_name", F.coalesce(own, partition_name(table, None))).drop("_key", "_parent")


def sub_partition(df: DataFrame, table: str, outer: Column, inner: Column) -> DataFrame:
    """Composite: two positions in one name."""
    return df.withColumn("partition_name", F.coalesce(partition_name(table, outer, inner), partition_name(table, outer), partition_name(table, None)))


def write_partitions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A folder per partition: rows of a partition are brought together, large ones in several files."""
    df.hint("rebalance", "partition_name").write.mode(mode).partitionBy("partition_name").parquet(path)


def merge_partitions(df: DataFrame) -> DataFrame:
    """All partitions as one table."""
    return df.drop("partition_name")


def reference_by_hash(child: DataFrame, table: str, key: str, n: int, modulo: bool = False) -> DataFrame:
    """Reference partitioning where the parent is hashed by its key: the child's own reference gives the same partition, without a join."""
    return hash_partition(child, table, [key], n, modulo=modulo)


def subpartition_counts(parts: DataFrame) -> DataFrame:
    """``(table_name, position, n_subparts)`` with totals per table (position null) and over all (both null)."""
    return parts.rollup("table_name", "position").agg(F.count_distinct("sub_position").alias("n_subparts"), F.count(F.lit(1)).alias("n_rows"))


def partition_counts(parts: DataFrame) -> DataFrame:
    """``(table_name, method, n_parts)`` with a total per method (table_name null) and over all."""
    return parts.rollup("method", "table_name").agg(F.count_distinct("position").alias("n_parts"))
