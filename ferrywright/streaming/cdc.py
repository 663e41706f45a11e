"""High-water marks, incremental extracts, and applying a stream of them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrywright.operators.diffing import apply_diff, datadiff_by_key


def register_marks(tables: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """``(table_name, mark)``: the highest value of each table's mark column, as text that sorts as the value does for whole numbers cast to long and timestamps."""
    parts = [df.agg(F.max(c).cast("string").alias("mark")).select(F.lit(name).alias("table_name"), "mark") for name, (df, c) in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def incremental(df: DataFrame, marks: DataFrame, table: str, column: str) -> DataFrame:
    """Rows beyond the last mark of the table, all rows if it has none. The mark is one value, so it reaches the scan as a filter."""
    row = marks.where(F.col("table_name") == table).agg(F.max(F.col("mark").cast(df.schema[column].dataType)).alias("m")).first()
    return df if row.m is None else df.where(F.col(column) > F.lit(row.m))


def latest_changes(changes: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Of several changes of a key in one batch the last one."""
    rest = [c for c in changes.columns if c not in keys]
    return changes.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r")).select(*keys, "_r.*").select(*changes.columns)


def merge_extract(target: DataFrame, extract: DataFrame, keys: Sequence[str], order: str | None = None, partial: bool = True) -> DataFrame:
    """The target after an extract: its keys replace the target's; of a full extract (``partial`` false) other keys are deleted."""
    new = latest_changes(extract, keys, order) if order else extract
    diff = datadiff_by_key(target, new, keys)
    return apply_diff(target, diff.where("op <> 'del'") if partial else diff, keys)


def stream_apply(stream: DataFrame, target_path: str, keys: Sequence[str], order: str, checkpoint: str, late: tuple[str, str] | None = None):
    """Apply a stream of extracts to a Parquet target, a version of it per batch: ``<target_path>/v=<batch>``.

    A batch that runs again writes the same version again from the one before it,
    so each change counts once; versions older than that are deleted. A batch writes the
    whole target anew, so batches should be large: ``availableNow`` makes few of them.
    ``late`` (column, delay) drops repeats within a watermark.
    """
    spark = stream.sparkSession
    if late:
        stream = stream.withWatermark(*late).dropDuplicatesWithinWatermark([*keys, order])

    def batch(rows: DataFrame, number: int) -> None:
        new = latest_changes(rows, keys, order)
        if number:
            new = merge_extract(spark.read.schema(rows.schema).parquet(f"{target_path}/v={number - 1}"), new, keys)
        new.write.mode("overwrite").parquet(f"{target_path}/v={number}")
        if number > 1:
            old = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{target_path}/v={number - 2}")
            old.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(old, True)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(stream: DataFrame, time: str, delay: str, window: str, by: Sequence[str]) -> DataFrame:
    """Counts by event-time window, late rows beyond the watermark left out; works on a stream and on a table."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).groupBy(F.window(time, window), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("window_start"), *by, "n")
