"""What the corpus operators share: scratch tables, column picking and hot-key cells.

Scratch tables are Parquet in the folder that all executors share
(``spark.checkpoint.dir``). Reading a written table cuts the lineage, so that a
lost executor costs a few tasks and never a whole recomputation.
"""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_own_roots: dict[str, str] = {}
_staged: dict[str, list[str]] = {}
_watch = threading.local()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for scratch tables of this application.

    The session's ``spark.checkpoint.dir`` is used as it is. Only where it is
    unset a temporary folder takes its place in local sessions, as in tests; on a
    cluster, whose machines do not share such a folder, that is an error.
    """
    app = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if app not in _own_roots:
            _own_roots[app] = tempfile.mkdtemp(prefix="spark-ferrywright-")
        base = f"file://{_own_roots[app]}"
    return f"{base.rstrip('/')}/ferrywright-{app}"


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name in the scratch root, remembered for :func:`release`."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    for held in getattr(_watch, "lists", ()):
        held.append(path)
    return path


@contextlib.contextmanager
def staging() -> Iterator[list[str]]:
    """The paths that this thread makes inside the block."""
    held: list[str] = []
    _watch.lists = [*getattr(_watch, "lists", ()), held]
    try:
        yield held
    finally:
        _watch.lists = [x for x in _watch.lists if x is not held]


@contextlib.contextmanager
def settings(spark: SparkSession, **conf: str):
    """Session settings (dots written as double underscores) that hold inside the block."""
    named = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in named}
    try:
        for k, v in named.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def stage(df: DataFrame, name: str, partition_by: Sequence[str] = (), level: int = 3) -> DataFrame:
    """Write ``df`` as a scratch table and read it back.

    The shuffle files behind it are dropped as soon as the table is written:
    whoever reads on reads the table. ``level`` is that of zstd.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with settings(spark, **{CLEANUP: "true"}):
        writer = df.write.option("compression", "zstd").option("parquet.compression.codec.zstd.level", str(level))
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def staged_paths(spark: SparkSession) -> list[str]:
    """The scratch tables of this application that were not released."""
    return list(_staged.get(spark.sparkContext.applicationId, []))


def pieces(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Slices of an Arrow batch, so that few rows at a time become Python objects."""
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def release(spark: SparkSession, paths: Sequence[str]) -> None:
    """Delete scratch tables that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    known = _staged.get(spark.sparkContext.applicationId, [])
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
        if path in known:
            known.remove(path)


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Select columns by exact name: ``pick(df, id="doc_id")``.

    Extra columns never clash with what an operator adds, and a second column
    whose name differs in case only is no ambiguity; of two columns of the same
    name the first counts.
    """
    names = df.columns
    at = {new: names.index(old) for new, old in columns.items()}
    plain = df.toDF(*[f"_c{i}" for i in range(len(names))])
    return plain.select(*[F.col(f"_c{i}").alias(new) for new, i in at.items()])


class Hidden:
    """A DataFrame whose columns carry neutral names while an operator works on it.

    ``frame`` has the columns ``_c0 .. _cn``; ``ref(name)`` finds one by its exact
    name; ``restore(df)`` brings the old names back, in order, and nothing else.
    """

    def __init__(self, df: DataFrame):
        self.names = df.columns
        self.frame = df.toDF(*[f"_c{i}" for i in range(len(self.names))])

    def ref(self, name: str) -> Column:
        return F.col(f"_c{self.names.index(name)}")

    def restore(self, df: DataFrame) -> DataFrame:
        return df.select(*[f"_c{i}" for i in range(len(self.names))]).toDF(*self.names)


def text_or_empty(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("string"), F.lit(""))


def with_file_rows(scan: DataFrame, file: str, row: str) -> DataFrame:
    """A plain scan of Parquet files with two long columns that tell each row from all others in every scan: its file and its number there.

    The file is a hash of its path; that no two paths share one is checked, on paths alone.
    """
    paths = scan.select(F.col("_metadata.file_path").alias("p")).distinct().select(F.xxhash64("p").alias("h"))
    seen = paths.agg(F.count("h").alias("n"), F.count_distinct("h").alias("d")).first()
    if seen.n != seen.d:
        raise ValueError("two files share a hash: stage the table and number its rows")
    return scan.select("*", F.xxhash64("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row))


def pair_cells(rows: DataFrame, key: str, item: str, max_shard: int) -> DataFrame:
    """Deal the rows of each key into cells, so that each pair of a key meets in some cell.

    A key of up to ``max_shard`` rows is one cell. A larger one is cut by a hash of
    ``item`` into shards of about ``max_shard`` rows, and each two shards are a cell, so
    that no cell has more than about twice as many. Keys of one row are left out.
    Column added: ``cell`` (long). No pair of rows is made here, and no key is gathered in one task.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    shards = F.when(F.col("_n") <= max_shard, 1).otherwise(F.greatest(F.lit(2), F.ceil(F.col("_n") / max_shard))).cast("long")
    kept = rows.join(counts.select(key, shards.alias("_shards")), key)
    dealt = kept.withColumn("_own", F.pmod(F.xxhash64(F.col(item), F.lit("cell")), F.col("_shards")))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("_shards") - 1), lambda s: (s != F.col("_own")) | (F.col("_shards") == 1))
    cell = F.least("_own", "_other") * F.col("_shards") + F.greatest("_own", "_other")
    return dealt.withColumn("_other", F.explode(others)).withColumn("cell", cell).drop("_own", "_other", "_shards")


def filter_rows(docs: DataFrame, columns: Sequence[str], judge: Callable[[], Callable[[pa.RecordBatch], Sequence[bool]]]) -> DataFrame:
    """The rows of ``docs`` that a Python judge keeps, all columns untouched and nothing shuffled.

    ``judge`` is called once in each task and gives a function from a batch of the
    named columns to a flag per row.
    """
    whole = Hidden(docs)
    at = [whole.names.index(c) for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decide = judge()
        for batch in batches:
            for piece in pieces(batch):
                keep = decide(pa.RecordBatch.from_arrays([piece.column(i) for i in at], list(columns)))
                yield piece.filter(pa.array(keep, pa.bool_()))

    return whole.restore(whole.frame.mapInArrow(run, whole.frame.schema))
