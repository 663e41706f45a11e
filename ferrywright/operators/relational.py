"""Joins, aggregates, windows, limits and set operations with the meaning that other dialects give them."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrywright.scratch import checkpoint

# Joins


def outer_plus(left: DataFrame, right: DataFrame, on: Column, where: Column | None = None, side: str = "right") -> DataFrame:
    """Marked outer join: predicates with the mark are ``on``, the others ``where``, applied after it. ``side`` is the marked, optional one."""
    joined = left.join(right, on, "left" if side == "right" else "right")
    return joined if where is None else joined.where(where)


def outer_chain(base: DataFrame, steps: Sequence[tuple[DataFrame, Column]]) -> DataFrame:
    """Several marked joins in the order of the FROM list."""
    return reduce(lambda df, step: df.join(step[0], step[1], "left"), steps, base)


def comma_join(tables: Sequence[DataFrame], condition: Column | None = None) -> DataFrame:
    """A FROM list. With a condition Catalyst makes joins on its equalities; without one it is a product, and a table of any size on both sides is refused by Spark unless allowed."""
    joined = reduce(lambda a, b: a.join(b), tables)
    return joined if condition is None else joined.where(condition)


def anti(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose keys the other table lacks; null keys never match."""
    return df.join(other.select(*keys), list(keys), "left_anti")


def changed_since(df: DataFrame, changes: DataFrame, key: str, since: Column) -> DataFrame:
    """Rows that a change list names since a date."""
    return df.join(changes.where(since).select(key), key, "left_semi")


# Aggregates


def listagg(value: str, separator: str = "", order: str | None = None, distinct: bool = False) -> Column:
    """LISTAGG with its own order and an empty default separator."""
    sep = separator.replace("\\", "\\\\").replace("'", "\\'")
    return F.expr(f"listagg({'distinct ' if distinct else ''}{value}, '{sep}') within group (order by {order or value})")


def group_concat(value: str, separator: str = ",", order: str | None = None, distinct: bool = False) -> Column:
    """GROUP_CONCAT: a comma by default."""
    return listagg(f"cast({value} as string)" if order else value, separator, order, distinct)


def mysql_std(column: Column | str) -> Column:
    return F.stddev_pop(column)


def keep_dense_rank(df: DataFrame, by: Sequence[str], order: Sequence[Column], aggregates: Sequence[Column], first: bool = True) -> DataFrame:
    """``AGG(x) KEEP (DENSE_RANK FIRST | LAST ORDER BY k)`` of all rows that tie for the place.

    ``order`` has one key (min or max of which is joined back, so that no window sorts whole groups) or several (a window ranks them).
    """
    if len(order) == 1 and by:
        end = df.groupBy(*by).agg((F.min if first else F.max)(order[0]).alias("_end"))
        kept = df.withColumn("_key", order[0]).alias("d").join(end.alias("e"), [F.col(f"d.{c}").eqNullSafe(F.col(f"e.{c}")) for c in by] + [F.col("d._key").eqNullSafe(F.col("e._end"))])
        return kept.select("d.*").groupBy(*by).agg(*aggregates)
    ranks = Window.partitionBy(*by).orderBy(*[(o.asc() if first else o.desc()) for o in order])
    return df.withColumn("_rank", F.dense_rank().over(ranks)).where("_rank = 1").groupBy(*by).agg(*aggregates)


def keep_over(value: str, partition: Sequence[str], order: str, first: bool = True) -> Column:
    """The KEEP form as a window: the value of the first or last row by the order, nulls last; of rows that tie the least value, however they are read."""
    by = F.col(order).asc_nulls_last() if first else F.col(order).desc_nulls_last()
    return F.first(value).over(Window.partitionBy(*partition).orderBy(by, F.col(value).asc_nulls_last()))


def group_having(df: DataFrame, keys: Sequence[str], aggregates: Sequence[Column], having: str) -> DataFrame:
    return df.groupBy(*keys).agg(*aggregates).where(having)


def count_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, n_rows)`` of several tables in one job."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def array_agg_distinct(value: str) -> Column:
    """ARRAY_AGG(DISTINCT x): each value once, in order, without nulls."""
    return F.array_sort(F.collect_set(value))


def distinct(df: DataFrame, columns: Sequence[str] = ()) -> DataFrame:
    """SELECT DISTINCT, or UNIQUE, of some columns."""
    return df.select(*columns).distinct() if columns else df.distinct()


def column_counts(catalog: DataFrame, by: Sequence[str] = ("table_name",)) -> DataFrame:
    """``(*by, n_columns)`` of a catalog of columns."""
    return catalog.groupBy(*by).agg(F.count(F.lit(1)).alias("n_columns"))


def sequence_restart(df: DataFrame, column: str, increment: int = 1) -> DataFrame:
    """The next value of a sequence that fills ``column``: 1 for an empty table."""
    return df.agg(F.coalesce(F.max(column) + increment, F.lit(1)).cast("long").alias("next_value"))


# Row numbers


def with_rownum(df: DataFrame, order: Sequence[Column], name: str = "rownum") -> DataFrame:
    """Number all rows by an order, without a window over one partition.

    Rows are dealt into ranges; counts of the ranges, one number each, are summed
    before them. Rows that tie on the order are numbered in the order of a hash of
    the row, by which an order of few values is many ranges too; equal rows in any order.
    """
    hashable = [c for c, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    keys = [*order, F.xxhash64(*hashable)] if hashable else list(order)
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()})
    # The ranges are used twice and must be the same.
    ranged = checkpoint(ranged)
    counts = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_low"))
    # One row per range: as many as there are partitions.
    starts = counts.select("_range", "_low", F.coalesce(F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_start"))
    # Within a partition the ids are consecutive.
    return ranged.join(F.broadcast(starts), "_range").withColumn(name, (F.col("_start") + F.col("_at") - F.col("_low") + 1).cast("long")).drop("_range", "_at", "_low", "_start")


def assign_rownum(df: DataFrame, key: str, order: Sequence[Column], column: str) -> DataFrame:
    """UPDATE with a row number: rows are numbered in place, so that a repeated key keeps its rows and each gets a number. ``key`` breaks ties."""
    names = [c for c in df.columns if c != column]
    return with_rownum(df, [*order, F.col(key)], "_number").select(*names, F.col("_number").alias(column))


# Limits


def rownum_limit(df: DataFrame, operator: str, n: int, order: Sequence[Column] = ()) -> DataFrame:
    """``ROWNUM <op> n``. For > and >= the meaning is that of a page, rows after the first ones, found by row numbers over ranges."""
    first = df.orderBy(*order) if order else df
    if operator == "<=":
        return first.limit(max(0, n))
    if operator == "<":
        return first.limit(max(0, n - 1))
    if operator == "=":
        return first.offset(max(0, n - 1)).limit(1)
    skipped = max(0, n if operator == ">" else n - 1)
    return with_rownum(df, order or [F.monotonically_increasing_id()], "_rownum").where(F.col("_rownum") > skipped).drop("_rownum")


def page(df: DataFrame, low: int, high: int, order: Sequence[Column]) -> DataFrame:
    """Rows after the first ``low`` up to number ``high``."""
    return df.orderBy(*order).offset(low).limit(max(0, high - low))


def mysql_limit(df: DataFrame, offset: int, n: int, order: Sequence[Column] = ()) -> DataFrame:
    return (df.orderBy(*order) if order else df).offset(offset).limit(n)


def top(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    return df.orderBy(*order).limit(n)


def top_n(df: DataFrame, metric: str, name: str, n: int = 10) -> DataFrame:
    """The n largest by a metric, ties by name."""
    return df.orderBy(F.desc_nulls_last(metric), name).limit(n)


def nls_sort(column: Column, collation: str = "UNICODE") -> Column:
    return F.collate(column, collation)


def pipe_rows(df: DataFrame, rows: Column, name: str = "row") -> DataFrame:
    """A function that returns rows, by an array expression: one row per element, none for an empty array."""
    return df.withColumn(name, F.explode(rows))


def pipe_partitions(df: DataFrame, handler: type, returns: str, partition: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A function that returns rows over the rows of each partition, in order: a Spark table function.

    ``handler`` is a class with ``eval(self, row)`` and, if it likes, ``terminate(self)``, both of which yield tuples of the schema ``returns``. Each
    partition has an instance of its own, to which rows come one after another, so that it holds what it keeps and no more.
    """
    spark = df.sparkSession
    name = f"pipe_{uuid.uuid4().hex}"
    spark.udtf.register(name, F.udtf(handler, returnType=returns))
    df.createOrReplaceTempView(f"{name}_rows")
    quoted = lambda names: ", ".join(f"`{n}`" for n in names)
    return spark.sql(f"SELECT * FROM {name}(TABLE({name}_rows) PARTITION BY {quoted(partition)} ORDER BY {quoted(order)})")


def category_summary(df: DataFrame, category: str, value: str) -> DataFrame:
    """``(category, n, least, greatest)``: the aggregate view that is exported as a table."""
    return df.groupBy(F.col(category).alias("category")).agg(F.count(F.lit(1)).alias("n"), F.min(value).alias("least"), F.max(value).alias("greatest"))


# Sets


def minus(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def union(a: DataFrame, b: DataFrame, all: bool = False) -> DataFrame:
    both = a.union(b)
    return both if all else both.distinct()


def intersect(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)
