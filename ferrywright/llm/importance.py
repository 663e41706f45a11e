"""Target-distribution importance resampling: array-scored weights and a distributed radix sort (operator 11).

Words and word pairs are hashed into buckets. A bucket's gain says how much more often the target has it
than the corpus; a document's weight is its features' mean gain, and a Gumbel draw on top makes the highest
scores a sample without replacement. Gains are one array of BUCKETS numbers, broadcast whole.

Ranks come from a least-significant-digit radix sort over blocks of rows. A pass counts digits by block, sums
the counts before each (digit, block), and deals each row to its destination, which is the sum for its
(digit, block) and its place among its block's rows of that digit; so a pass is stable, no group is larger than
a block, and a digit that a third of all rows share is many blocks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

BUCKETS = 10_000
#: Documents of fewer words are never drawn; of the others so many in a hundred are.
LEAST_WORDS = 20
PERCENT = 25
SEED = "7"
#: Bits of a digit, and most rows in a block, which one task holds.
DIGIT_BITS = 11
BLOCK_ROWS = 1 << 20

#: A-Z lowered, every other byte that is no word a space; bytes above 0x7F are words.
_FOLD = bytes((b | 0x20) if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b > 0x7F else 0x20 for b in range(256))


def feature_hashes(text: bytes) -> list[int]:
    """crc32 of every word of a UTF-8 text and of every two consecutive ones; a pair's is carried on from its first word's."""
    words = text.translate(_FOLD).split()
    ones = list(map(crc32, words))
    ones.extend([crc32(word, crc32(b" ", before)) for word, before in zip(words[1:], ones, strict=False)])
    return ones


def feature_buckets(text: bytes) -> np.ndarray:
    return np.array(feature_hashes(text), dtype=np.int64) % BUCKETS


def count_buckets(texts: DataFrame) -> DataFrame:
    """``(bucket, n)`` of all texts: each task counts into one array of BUCKETS, whose rows are summed."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(BUCKETS, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                held += np.bincount(feature_buckets(text.as_py()), minlength=BUCKETS)
        used = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(held[used])], ["bucket", "n"])

    raw = common.pick(texts, text="text").select(common.text_or_empty("text").cast("binary").alias("text"))
    return raw.mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """The gain of each bucket, in thousandths. The counts that come to the driver are 2 x BUCKETS numbers."""
    held = {}
    for name, texts in (("corpus", docs), ("target", target)):
        held[name] = np.zeros(BUCKETS, dtype=np.int64)
        for r in count_buckets(texts).collect():
            held[name][r.bucket] = r.n
    s, t = held["corpus"].tolist(), held["target"].tolist()
    whole_s, whole_t = float(sum(s) + BUCKETS), float(sum(t) + BUCKETS)
    return np.array([math.floor(1000 * math.log((float(b) + 1) * whole_s / ((float(a) + 1) * whole_t))) for a, b in zip(s, t, strict=True)], dtype=np.int64)


def score_documents(docs: DataFrame, gains: np.ndarray, carry: Sequence[str] = ()) -> DataFrame:
    """``(doc_id, n_features, weight, score, n_words, *carry)`` of every document; ``carry`` names long columns that go along."""
    shared = docs.sparkSession.sparkContext.broadcast(gains)
    names = ["doc_id", "n_features", "weight", "score", "n_words"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gains = shared.value
        for batch in batches:
            out: list[list[int]] = [[] for _ in names[1:]]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                hashed = feature_buckets(text.as_py())
                n = len(hashed)
                weight = int(gains[hashed].sum()) // n if n else 0
                h = int(hashlib.sha256(f"{SEED}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
                draw = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
                for column, value in zip(out, (n, weight, weight + draw, (n + 1) // 2), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in out], *batch.columns[2:]], [*names, *carry])

    slim = common.pick(docs, doc_id="doc_id", text="text", **{c: c for c in carry})
    slim = slim.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty("text").cast("binary").alias("text"), *carry)
    return slim.mapInArrow(score, ", ".join(f"{c} long" for c in [*names, *carry]))


@dataclass
class Digit:
    """Some bits of a non-negative long column."""

    column: str
    shift: int

    def of(self) -> Column:
        return F.shiftrightunsigned(F.col(self.column), self.shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1).cast("long"))


def radix_sort(rows: DataFrame, keys: list[str], place: str, blocks: int | None = None) -> DataFrame:
    """``rows`` with ``place``, their number from 0 in ascending order of ``keys``, the first of which counts most.

    Keys are long columns read as unsigned, without nulls; rows of equal keys keep an order of their own that is the
    same in every run over the same staged table. Only digits in which keys differ at all cost a pass. ``blocks`` is the number of
    blocks at least, by default a few for each shuffle partition.
    """
    spark = rows.sparkSession
    # Rows are told apart by file and row of the staged table, which lost executors do not change.
    first = common.stage(rows, "radix-rows")
    staged = common.with_file_rows(first, "_radix_file", "_radix_at")
    spread = [F.bit_or(k).bitwiseXOR(F.bit_and(k)).alias(k) for k in keys]
    whole = staged.agg(F.count(F.lit(1)).alias("n"), *spread).first()
    if not whole.n:
        return rows.withColumn(place, F.lit(None).cast("long"))
    least = blocks or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = max(1, min(BLOCK_ROWS, math.ceil(whole.n / least)))
    mask = (1 << DIGIT_BITS) - 1
    digits = [Digit(k, shift) for k in reversed(keys) for shift in range(0, 64, DIGIT_BITS) if (getattr(whole, k) >> shift) & mask]
    # First places: the rows of each file, one file after another; as many rows in this window as there are files.
    before = Window.orderBy("_radix_file").rowsBetween(Window.unboundedPreceding, -1)
    starts = staged.groupBy("_radix_file").agg(F.count(F.lit(1)).alias("_n")).select("_radix_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    current, path = staged.join(F.broadcast(starts), "_radix_file").withColumn(place, F.col("_start") + F.col("_radix_at")).drop("_radix_file", "_radix_at", "_start"), first.staged_at
    for digit in digits:
        following = common.stage(_counting_pass(current, digit, place, size), "radix-pass")
        common.release(spark, [path])
        current, path = following, following.staged_at
    return current


def _counting_pass(rows: DataFrame, digit: Digit, place: str, size: int) -> DataFrame:
    """One stable pass: ``place`` becomes the destination of each row."""
    blocked = rows.withColumns({"_block": F.floor(F.col(place) / size).cast("long"), "_digit": digit.of()})
    counts = blocked.groupBy("_block", "_digit").agg(F.count(F.lit(1)).alias("_n"))
    # A digit's rows are dealt one block after another: a window over at most as many rows as there are blocks.
    within = Window.partitionBy("_digit").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy("_digit").agg(F.sum("_n").alias("_all"))
    # At most 2 ** DIGIT_BITS rows.
    bases = totals.select("_digit", F.coalesce(F.sum("_all").over(Window.orderBy("_digit").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(within), F.lit(0))).join(F.broadcast(bases), "_digit").select(F.col("_block").alias("_from"), F.col("_digit").alias("_of"), (F.col("_base") + F.col("_before")).alias("_offset"))
    names = rows.columns

    def deal(block: pa.Table, begins: pa.Table) -> pa.Table:
        block = block.take(pa.array(np.argsort(block.column(place).to_numpy(), kind="stable")))
        found = block.column("_digit").to_numpy()
        first = np.zeros(1 << DIGIT_BITS, dtype=np.int64)
        first[begins.column("_of").to_numpy()] = begins.column("_offset").to_numpy()
        held = np.bincount(found, minlength=len(first))
        order = np.argsort(found, kind="stable")
        nth = np.empty(len(found), dtype=np.int64)
        nth[order] = np.arange(len(found)) - np.repeat(np.cumsum(held) - held, held)
        out = block.select(names)
        return out.set_column(names.index(place), place, pa.array(first[found] + nth))

    return blocked.groupBy("_block").cogroup(offsets.groupBy("_from")).applyInArrow(deal, rows.schema)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``(doc_id, n_features, weight, score, rank)``, one row per row of ``docs``; rank is null where a document is not drawn.

    A null or empty text has no features and weight 0, and like any of fewer than LEAST_WORDS words is never drawn;
    an empty ``target`` gives every feature gains by the corpus alone; ties of scores go to the smaller doc_id, those
    without one last, and repeated rows get ranks one after another; very long texts are read whole; an empty table gives no
    row. Extra columns are ignored.
    """
    return _ranked(docs, target, percent)


def _ranked(docs: DataFrame, target: DataFrame, percent: int, carry: Sequence[str] = ()) -> DataFrame:
    scored = common.stage(score_documents(docs, bucket_gains(docs, target), carry), "scored")
    fit = scored.where(F.col("n_words") >= LEAST_WORDS)
    low, high, top, n = fit.agg(F.min("doc_id"), F.max("doc_id"), F.max("score"), F.count(F.lit(1))).first()
    names = ["doc_id", "n_features", "weight", "score", *carry]
    rest = scored.where(F.col("n_words") < LEAST_WORDS).select(*names, F.lit(None).cast("long").alias("rank"))
    if not n:
        return rest
    # Ids count from the smallest where that fits a long; else their sign bit is turned, which orders them as unsigned numbers.
    if low is None or high - low < 1 << 63:
        number = F.col("doc_id") - F.lit(low or 0)
    else:
        number = F.col("doc_id").bitwiseXOR(F.lit(-(1 << 63)).cast("long"))
    keys = {"_high": F.lit(top) - F.col("score"), "_none": F.col("doc_id").isNull().cast("long"), "_low": F.coalesce(number, F.lit(0).cast("long"))}
    ranked = radix_sort(fit.drop("n_words").withColumns(keys), list(keys), "_place")
    drawn = F.when(F.col("_place") < n * percent // 100, F.col("_place") + 1)
    return ranked.select(*names, drawn.alias("rank")).unionAll(rest)


def draw_documents(docs: DataFrame, target: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The drawn rows of ``docs``, all columns as they are; nulls, ties and repeats count as in :func:`resample`."""
    whole = common.Hidden(docs)
    rows = common.with_file_rows(common.stage(whole.frame, "rows"), "_file", "_row")
    slim = rows.select(whole.ref("doc_id").alias("doc_id"), whole.ref("text").alias("text"), "_file", "_row")
    drawn = _ranked(slim, target, percent, ("_file", "_row")).where("rank is not null").select("_file", "_row")
    return whole.restore(rows.join(drawn, ["_file", "_row"], "left_semi"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's weight, score and rank against the benchmark's texts."""
    return resample(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))


#: crc32 is worked out once per distinct feature, a byte at a time.
ORACLE_SQL = f"""
WITH RECURSIVE tab AS (SELECT list(c ORDER BY i) AS t FROM (SELECT i, list_reduce(list_concat([i::BIGINT], range(8)), lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c FROM range(256) r(i))),
d AS (SELECT 'd' AS k, doc_id, row_number() OVER () AS r, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS w FROM documents
 UNION ALL SELECT 'b', item_id, row_number() OVER (), list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') FROM benchmark),
f AS (SELECT k, r, f, count(*) AS n FROM (SELECT k, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM d) GROUP BY ALL),
u AS (SELECT f, xor(list_reduce(list_concat([4294967295], list_transform(range(1, strlen(f) + 1), lambda i: ('0x' || hex(f)[2 * i - 1:2 * i])::BIGINT)), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % {BUCKETS} AS b FROM (SELECT DISTINCT f FROM f), tab),
c AS (SELECT b, coalesce(sum(n) FILTER (WHERE k = 'd'), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (WHERE k = 'b'), 0)::DOUBLE AS t FROM f JOIN u USING (f) GROUP BY b),
a AS (SELECT sum(s) AS s, sum(t) AS t FROM c),
g AS (SELECT c.b, floor(1000 * ln((c.t + 1) * (a.s + {BUCKETS}) / ((c.s + 1) * (a.t + {BUCKETS}))))::BIGINT AS g FROM c, a),
m AS (SELECT r, sum(n)::BIGINT AS n, floor(sum(n * g) / sum(n))::BIGINT AS weight FROM f JOIN u USING (f) JOIN g USING (b) WHERE k = 'd' GROUP BY r),
s AS (SELECT doc_id, len(w) AS words, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score FROM d LEFT JOIN m USING (r) WHERE k = 'd'),
o AS (SELECT *, CASE WHEN words >= {LEAST_WORDS} THEN row_number() OVER (PARTITION BY words >= {LEAST_WORDS} ORDER BY score DESC, doc_id) END AS i, count(*) FILTER (WHERE words >= {LEAST_WORDS}) OVER () AS n FROM s)
SELECT doc_id, n_features, weight, score, CASE WHEN i <= {PERCENT} * n // 100 THEN i END AS rank FROM o
"""
