"""Mixing sources to target weights by systematic sampling (operator 5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

#: Weights of the sources by code point, repeating; the null source comes last.
WEIGHTS = (3, 1, 2)
#: The mix has so many times the words of all sources, and no source more than so many times its own.
TOTAL_SHARE = 1.5
MOST_COPIES = 2
SEED = "mix-1"

WORDS = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.regexp_count(common.text_or_empty(text), F.lit(WORDS)).cast("long")


def source_targets(sources: DataFrame) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, source_size)``, one row per source.

    Targets share TOTAL_SHARE of all sizes by weight. One that would pass
    MOST_COPIES times its source's size stops there and the excess goes to the
    others by weight, until none is above: target = min(cap, level * weight) for one
    level, found by rounds of one two-number aggregate each. An empty source has target 0.
    """
    # The number of a source is its rank; windows over the source table alone, a row per source.
    order = Window.orderBy(F.col("source").isNull(), "source")
    weights = F.element_at(F.array(*map(F.lit, WEIGHTS)), ((F.row_number().over(order) - 1) % len(WEIGHTS) + 1).cast("int"))
    ranked = common.stage(sources.withColumn("weight", weights), "sources")
    cap = MOST_COPIES * F.col("source_size")
    whole = ranked.agg(F.sum("source_size").alias("n"), F.sum("weight").alias("w")).first()
    if not whole.w or not whole.n:
        return ranked.select("source", "source_size", F.lit(0.0).alias("target"))
    level, before = TOTAL_SHARE * whole.n / whole.w, None
    while level != before:
        full = cap < level * F.col("weight")
        x = ranked.agg(F.coalesce(F.sum(F.when(full, cap)), F.lit(0)).alias("capped"), F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0)).alias("open")).first()
        before, level = level, (TOTAL_SHARE * whole.n - x.capped) / x.open if x.open else level
    return ranked.select("source", "source_size", F.when(cap < level * F.col("weight"), cap.cast("double")).otherwise(level * F.col("weight")).alias("target"))


def source_offset(source: Column) -> Column:
    """The random offset of a source in [0, 1): the same in every run with one seed."""
    digest = F.md5(F.concat(F.lit(SEED + ":"), F.coalesce(source, F.lit("\x00null"))).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def mix(rows: DataFrame) -> DataFrame:
    """Add ``source_size``, ``target`` and ``copies`` to rows with ``source`` and ``size``.

    ``rows`` further needs the columns ``doc_id`` and ``tie``, by which equal sizes are
    ordered, and may carry others. Each row of a source expects target / source_size
    copies. The rows of a source are numbered by size, so that each stretch of like
    sizes gives its share of words; the running sum of expected copies plus one
    random offset per source emits a copy at each integer it crosses.

    A range partitioning deals a source out over tasks, however large it is; only
    row counts per (range, source) are summed before ranges.
    """
    keys = [F.col("source").isNull(), F.col("source"), F.col("size"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("tie")]
    ranged = common.stage(rows.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()), "mix-ranges")
    per_range = ranged.groupBy("source", "_range").agg(F.count(F.lit(1)).alias("_n"), F.sum("size").alias("_s"))
    per_range = common.stage(per_range, "mix-counts")
    # One row per range that holds rows of the source: at most the number of ranges in a window.
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    targets = source_targets(per_range.groupBy("source").agg(F.sum("_s").alias("source_size")))
    starts = per_range.withColumn("_before", before).alias("r").join(targets.alias("t"), F.expr("r.source <=> t.source"))
    starts = starts.select("r.source", "r._range", "_before", "source_size", "target")
    joined = ranged.alias("d").join(starts.alias("s"), F.expr("d.source <=> s.source and d._range = s._range"))
    joined = joined.select("d.*", "s._before", "s.source_size", "s.target")
    within = Window.partitionBy("_range", "source").orderBy("size", F.col("doc_id").isNull(), "doc_id", "tie")
    at = F.col("_before") + F.row_number().over(within)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = source_offset(F.col("source"))
    copies = F.floor(at * rate + offset) - F.floor((at - 1) * rate + offset)
    return joined.withColumn("copies", copies.cast("long")).drop("_range", "_before")


def mix_sizes(docs: DataFrame) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)``, one row per row of ``docs``.

    size counts the words of the whole text, 0 for a null or empty one; a null
    source is a source of its own, the last; rows without a doc_id and repeated
    rows are rows like others, ordered after the rest and by their texts' hashes;
    an empty table gives no row. Extra columns are ignored.
    """
    slim = common.pick(docs, doc_id="doc_id", text="text", source="source")
    rows = slim.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("tie"))
    mixed = mix(rows)
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def mix_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, all columns as they are.

    Nulls, empty texts and repeated rows count as in :func:`mix_sizes`; ties are broken by the row's number in the staged table.
    """
    whole = common.Hidden(docs)
    rows = common.stage(whole.frame.withColumn("_row", F.monotonically_increasing_id()), "rows")
    sizes = rows.select("_row", whole.ref("doc_id").cast("long").alias("doc_id"), whole.ref("source").cast("string").alias("source"), n_words(whole.ref("text")).alias("size"), F.col("_row").alias("tie"))
    taken = mix(sizes).where("copies > 0").select("_row", "copies")
    repeated = rows.join(taken, "_row").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return whole.restore(repeated)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document of ``documents``."""
    return mix_sizes(common.table(spark, sf_dir, "documents"))


#: The level is found among the sources sorted by cap / weight: the first prefix of capped sources that leaves none above.
ORACLE_SQL = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n FROM d GROUP BY source),
w AS (SELECT source, n, [3, 1, 2][((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::INT] AS w FROM s),
p AS (SELECT *, {MOST_COPIES} * n AS cap,
  coalesce(sum({MOST_COPIES} * n) OVER (ORDER BY {MOST_COPIES} * n / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS capped,
  sum(w) OVER (ORDER BY {MOST_COPIES} * n / w, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS open,
  row_number() OVER (ORDER BY {MOST_COPIES} * n / w, source IS NULL, source) AS i,
  sum(n) OVER ()::BIGINT AS total FROM w),
lv AS (SELECT arg_min(({TOTAL_SHARE}::DOUBLE * total - capped) / open, i) FILTER (WHERE cap >= ({TOTAL_SHARE}::DOUBLE * total - capped) / open * w) AS level FROM p),
t AS (SELECT source, n, CASE WHEN cap < level * w THEN cap::DOUBLE ELSE level * w END AS target,
  ('0x' || substr(md5('{SEED}:' || coalesce(source, chr(0) || 'null')), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u FROM p, lv),
r AS (SELECT d.doc_id, d.size, t.n, t.target, t.u, CASE WHEN t.n > 0 THEN t.target / t.n ELSE 0.0::DOUBLE END AS rate,
  row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id IS NULL, d.doc_id) AS i FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size::BIGINT AS size, n AS source_size, target,
  ((floor(i * rate + u) - floor((i - 1) * rate + u)) * size)::BIGINT AS taken FROM r
"""
