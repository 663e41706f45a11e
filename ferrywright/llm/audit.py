"""Filter interaction audit: what each filter of a chain removes, in every order (operator 12).

A document's five verdicts are five bits. Per part of the corpus the counts of the 32 patterns are a 2x2x2x2x2
tensor, and every figure of every order is a contraction of it: an earlier filter keeps its axis at pass, the
filter at hand at fail, and a later one sums its axis. So the corpus is read once, whatever the number of orders.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

FILTERS = "ABCDE"
LEAST_WORDS = 100
#: Percent of words that are distinct at least, and of code points that are A-Z at most.
LEAST_DISTINCT = 80
MOST_CAPITALS = 10
MARKS = b"#$%&*|"

_CAPITALS = bytes(range(0x41, 0x5B))
_INNER = bytes(range(0x80, 0xC0))
AUDIT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def failed_filters(text: bytes) -> int:
    """The filters A to D that a UTF-8 text fails, as bits 0 to 3."""
    words = text.split()
    points = len(text.translate(None, _INNER))
    capitals = len(text) - len(text.translate(None, _CAPITALS))
    return (
        (len(words) < LEAST_WORDS)
        | (100 * len(set(words)) < LEAST_DISTINCT * len(words)) << 1
        | (100 * capitals > MOST_CAPITALS * points) << 2
        | (len(text.translate(None, MARKS)) < len(text)) << 3
    )


def verdicts(docs: DataFrame) -> DataFrame:
    """``(doc_id, part, failed, digest)``: filters A to D as bits, and the SHA-256 of the text, by which equal texts are told."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in common.pieces(batch):
                texts = piece.column(2).to_pylist()
                failed = pa.array([failed_filters(t) for t in texts], pa.int32())
                digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), failed, digests], ["doc_id", "part", "failed", "digest"])

    slim = common.pick(docs, doc_id="doc_id", part="lang", text="text")
    slim = slim.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty("part").alias("part"), common.text_or_empty("text").cast("binary").alias("text"))
    return slim.mapInArrow(judge, "doc_id long, part string, failed int, digest binary")


def pattern_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, failed, n, good, toxic)``: documents by part and by the pattern of filters they fail, E in bit 4.

    Equal rows are counted before anything is shuffled further. E is passed by the smallest doc_id of a text alone: the join
    that tells them has the doc_id in its key, so that a text of very many copies is no hot key.
    """
    rows = verdicts(docs).groupBy("doc_id", "part", "failed", "digest").agg(F.count(F.lit(1)).alias("n"))
    # Computed once: it is read for the first of each text and for the counts.
    rows = common.stage(rows, "verdicts")
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "digest", F.lit(True).alias("first"))
    marks = common.pick(labels, doc_id="doc_id", quality="quality", toxic="toxic").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    marks = marks.agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("is_good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("is_toxic"))
    r, f = rows.alias("r"), first.alias("f")
    told = r.join(f, F.expr("r.doc_id <=> f.doc_id and r.digest = f.digest"), "left").select("r.*", F.when(F.col("f.first"), 0).otherwise(1 << 4).alias("copy"))
    told = told.join(marks, "doc_id", "left").withColumn("failed", F.col("failed").bitwiseOR(F.col("copy")))
    sums = {"n": F.sum("n"), "good": F.sum(F.col("n") * F.coalesce("is_good", F.lit(0))), "toxic": F.sum(F.col("n") * F.coalesce("is_toxic", F.lit(0)))}
    return told.groupBy("part", "failed").agg(*[total.cast("long").alias(name) for name, total in sums.items()])


def contract_orders(counts: np.ndarray) -> list[tuple]:
    """``(filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)`` of all orders.

    ``counts`` is a tensor of 3 x 2 x 2 x 2 x 2 x 2: all, good and toxic documents, by pass or fail of each filter.
    """
    choice = {"pass": np.array([1, 0]), "fail": np.array([0, 1]), "all": np.array([1, 1])}

    @lru_cache(maxsize=None)
    def contract(*kinds: str) -> tuple[int, int, int]:
        return tuple(np.einsum("kabcde,a,b,c,d,e->k", counts, *[choice[k] for k in kinds]).tolist())

    def along(passed: str, failed: str, rest: str = "all") -> tuple[int, int, int]:
        return contract(*["pass" if f in passed else "fail" if f in failed else rest for f in FILTERS])

    orders = ["".join(p) for p in permutations(FILTERS)]
    shares = {f: sum(along(o[: o.index(f)], f)[0] for o in orders) for f in FILTERS}
    out = []
    for order in orders:
        for step, f in enumerate(order, 1):
            earlier = order[: step - 1]
            removed, good, toxic = along(earlier, f)
            out.append((order, step, along(earlier + f, "")[0], removed, along("", f)[0] - removed, along("", f, "pass")[0], good, toxic, shares[f]))
    return out


def audit_filters(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step.

    A null text is an empty one, a null part the part of the empty name; a document without words passes B and C; of equal texts the
    smallest doc_id passes E, rows without a doc_id come last and pass only where the text has no other, and repeated rows of
    one doc_id and text pass or fail together; of a doc_id's labels one that is 1 is enough, null labels count as 0; very long texts are
    read whole; an empty table gives no row. Extra columns are ignored.
    """

    def contract(key: tuple, group: pa.Table) -> pa.Table:
        counts = np.zeros((3, 32), dtype=np.int64)
        at = group.column("failed").to_numpy()
        for i, name in enumerate(("n", "good", "toxic")):
            counts[i, at] = group.column(name).to_numpy()
        # Bit 0, filter A, is the last axis of a plain reshape.
        tensor = counts.reshape(3, 2, 2, 2, 2, 2).transpose(0, 5, 4, 3, 2, 1)
        rows = contract_orders(tensor)
        columns = list(zip(*rows, strict=True))
        arrays = [pa.array([key[0].as_py()] * len(rows), pa.string()), pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int32())]
        return pa.Table.from_arrays([*arrays, *[pa.array(c, pa.int64()) for c in columns[2:]]], names=[c.split()[0] for c in AUDIT.split(", ")])

    # At most 32 rows a group.
    return pattern_counts(docs, labels).groupBy("part").applyInArrow(contract, AUDIT)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of five filters over ``documents``, by language."""
    return audit_filters(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"))


ORACLE_SQL = f"""
WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1),
m AS (SELECT t, min(doc_id) AS m FROM w GROUP BY 1),
d AS (SELECT part, [len(w) < {LEAST_WORDS}, 100 * len(list_distinct(w)) < {LEAST_DISTINCT} * len(w), 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > {MOST_CAPITALS} * length(t),
  regexp_matches(t, '[#$%&*|]'), w.doc_id IS DISTINCT FROM m.m] AS f, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic FROM w JOIN m USING (t) LEFT JOIN l ON l.doc_id = w.doc_id),
c AS (SELECT part, f, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM d GROUP BY ALL),
x AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT part, o, i AS step, o[i] AS k, n, good, toxic, list_bool_or(list_concat([false], list_transform(o[:i - 1], lambda j: f[j]))) AS gone, f[o[i]] AS bad, len(list_filter(f, lambda v: v)) AS bads FROM c, o, x),
g AS (SELECT part, o, step, k, coalesce(sum(n) FILTER (WHERE NOT gone AND NOT bad), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (WHERE NOT gone AND bad), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (WHERE gone AND bad), 0)::BIGINT AS redundant,
  coalesce(sum(n) FILTER (WHERE bad AND bads = 1), 0)::BIGINT AS unique_fails, coalesce(sum(good) FILTER (WHERE NOT gone AND bad), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (WHERE NOT gone AND bad), 0)::BIGINT AS toxic_lost FROM s GROUP BY 1, 2, 3, 4)
SELECT part, array_to_string(list_transform(o, lambda j: 'ABCDE'[j]), '') AS filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, k))::BIGINT AS shapley FROM g
"""
