"""Keyed upserts into a bucketed, versioned target, of which a batch rewrites only the buckets it touches.

Layout under the target's root, all of it written by Spark, so that any store that Spark writes will hold it:

* ``data/v=<batch>/b=<bucket>``: the rows of a bucket as of the batch that last wrote it;
* ``manifest/v=<batch>``: ``(bucket, version)`` of every bucket that has rows. A batch is there once its manifest is,
  which the commit of the write decides; files of a batch that was killed before are unseen, and written anew when it runs again.

Readers take the newest manifest. Files that neither it nor the one before names are deleted after a batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrywright.scratch import checkpoint

MANIFEST = "bucket int, version long"


def bucket_of(keys: Sequence[str], buckets: int, locality: str | None = None) -> Column:
    """The bucket of a key: by its hash, or by an expression of the caller's for a number that keys which change together share."""
    number = F.xxhash64(*keys) if locality is None else F.coalesce(F.expr(locality).cast("long"), F.lit(0).cast("long"))
    return F.pmod(number, F.lit(buckets)).cast("int")


def _files(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def committed(spark: SparkSession, root: str) -> list[int]:
    """The batches whose manifests are complete, ascending."""
    store, folder = _files(spark, f"{root}/manifest")
    if not store.exists(folder):
        return []
    found = [s.getPath().getName() for s in store.listStatus(folder)]
    done = [n for n in found if n.startswith("v=") and store.exists(_files(spark, f"{root}/manifest/{n}/_SUCCESS")[1])]
    return sorted(int(n[2:]) for n in done)


def manifest(spark: SparkSession, root: str, batch: int) -> dict[int, int]:
    """The version of each bucket as of a batch: as many entries as there are buckets."""
    return {r.bucket: r.version for r in spark.read.schema(MANIFEST).parquet(f"{root}/manifest/v={batch}").collect()}


def _read_buckets(spark: SparkSession, root: str, schema, found: dict[int, int]) -> DataFrame:
    if not found:
        return spark.createDataFrame([], schema)
    paths = [f"{root}/data/v={v}/b={b}" for b, v in sorted(found.items())]
    return spark.read.schema(schema).parquet(*paths)


def read_upserts(spark: SparkSession, root: str, schema, batch: int | None = None) -> DataFrame:
    """The target as of its last batch, or of an earlier one that is still kept."""
    done = committed(spark, root)
    if not done:
        return spark.createDataFrame([], schema)
    return _read_buckets(spark, root, schema, manifest(spark, root, done[-1] if batch is None else batch))


def upsert_batch(rows: DataFrame, root: str, batch: int, keys: Sequence[str], order: str, buckets: int, locality: str | None = None) -> int:
    """Apply one batch of changes and return how many buckets it rewrote.

    Of several rows of a key that with the highest ``order`` counts, of the target's rows too, so late changes
    never undo newer ones; on equal orders the batch's row counts. Deletions are rows like others, with a flag that
    :func:`live_rows` reads: a key that was taken out stays as a mark, so that a late change does not bring it back. Keys that
    are null are one key. A batch that is committed already is left as it is, so a replay changes nothing.
    """
    spark, schema = rows.sparkSession, rows.schema
    done = committed(spark, root)
    if batch in done:
        return 0
    before = [b for b in done if b < batch]
    current = manifest(spark, root, before[-1]) if before else {}
    # Read twice: for the buckets it touches and for its rows.
    fresh = checkpoint(rows.withColumn("_b", bucket_of(keys, buckets, locality)))
    touched = [r._b for r in fresh.select("_b").distinct().collect()]
    old = _read_buckets(spark, root, schema, {b: current[b] for b in touched if b in current}).withColumn("_b", bucket_of(keys, buckets, locality))
    both = old.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1)))
    rest = [c for c in rows.columns if c not in keys]
    newest = both.groupBy("_b", *keys).agg(F.max_by(F.struct(*rest), F.struct(F.col(order), F.col("_new"))).alias("_r"))
    merged = newest.select(F.col("_b").alias("b"), *keys, "_r.*").select("b", *rows.columns)
    merged.repartition("b").write.mode("overwrite").partitionBy("b").parquet(f"{root}/data/v={batch}")
    following = {**current, **dict.fromkeys(touched, batch)}
    spark.createDataFrame(sorted(following.items()), MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{root}/manifest/v={batch}")
    _delete_unread(spark, root, [*before, batch])
    return len(touched)


def _delete_unread(spark: SparkSession, root: str, done: Sequence[int]) -> None:
    """Delete what only manifests older than the last two name."""
    kept = {x for b in done[-2:] for x in manifest(spark, root, b).items()}
    for old in done[:-2]:
        for bucket, version in manifest(spark, root, old).items():
            if (bucket, version) not in kept:
                store, path = _files(spark, f"{root}/data/v={version}/b={bucket}")
                store.delete(path, True)
        store, path = _files(spark, f"{root}/manifest/v={old}")
        store.delete(path, True)


def live_rows(df: DataFrame, deleted: str) -> DataFrame:
    """The target without the keys that a change took out."""
    return df.where(~F.coalesce(F.col(deleted), F.lit(False))).drop(deleted)


def stream_upserts(stream: DataFrame, root: str, keys: Sequence[str], order: str, checkpoint_at: str, buckets: int = 64, locality: str | None = None, late: tuple[str, str] | None = None):
    """Apply a stream of extracts; batches have the stream's numbers, so that one which runs again after a fault counts once.

    ``late`` (column, delay) drops repeats within a watermark before they reach a batch.
    """
    if late:
        stream = stream.withWatermark(*late).dropDuplicatesWithinWatermark([*keys, order])

    def batch(rows: DataFrame, number: int) -> None:
        upsert_batch(rows, root, number, keys, order, buckets, locality)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint_at).trigger(availableNow=True).start()
