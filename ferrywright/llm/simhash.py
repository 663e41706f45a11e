"""SimHash near-duplicates through sharded BK-trees (operator 8).

Fingerprints grow with the corpus, so the trees are not broadcast: two
fingerprints at most ``RADIUS`` bits apart agree on at least ``blocks - RADIUS``
of ``blocks`` bit blocks, and each choice of so many blocks is a shard key. The
shards are dealt by shuffle, those with very many fingerprints in cells of bounded
size, and within a cell a BK-tree answers each fingerprint's radius query. A cell
returns a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, graph

SEED = 42
SHINGLE_WORDS = 3
RADIUS = 3
#: Fingerprints of one cut of a shard; a tree holds two cuts at most, and all cuts meet.
MAX_CELL = 2048
#: Up to so many distinct fingerprints four blocks make the shard keys, then five, then six.
BLOCK_STEPS = ((1 << 26, 4), (1 << 33, 5), (None, 6))
_MASK = (1 << 64) - 1


def fingerprint(text: str | None, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """Majority bits of the XXH64 of all word shingles, repeats included; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - words_per_shingle + 1)
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[-n:].tolist(), strict=True)]
    ones = np.zeros(64, dtype=np.int64)
    values = np.array(hashes, dtype=np.uint64)
    for at in range(0, n, 1 << 16):
        ones += np.unpackbits(values[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = 2 * ones > n
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp)`` of whole texts; fp is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in common.pieces(batch):
                found = [fingerprint(t) for t in piece.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(np.array(found, dtype=np.uint64).view(np.int64))], ["doc_id", "fp"])

    slim = common.pick(docs, doc_id="doc_id", text="text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, fp long")


def shard_keys(fp: Column, blocks: int, radius: int = RADIUS) -> Column:
    """An array of shard keys; fingerprints within ``radius`` bits share at least one."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    masks = [sum(1 << b for b in range(lo, hi)) for lo, hi in zip(edges, edges[1:], strict=False)]
    keys = []
    for i, chosen in enumerate(combinations(masks, blocks - radius)):
        mask = sum(chosen)
        keys.append(F.struct(F.lit(i).alias("t"), fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")).alias("v")))
    return F.array(*keys)


class BKTree:
    """Children are keyed by their integer Hamming distance to the parent."""

    def __init__(self):
        self.items: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, item: int) -> None:
        if not self.items:
            self.items.append(item)
            self.children.append({})
            return
        at = 0
        while True:
            distance = (self.items[at] ^ item).bit_count()
            if distance == 0:
                return
            following = self.children[at].get(distance)
            if following is None:
                self.children[at][distance] = len(self.items)
                self.items.append(item)
                self.children.append({})
                return
            at = following

    def within(self, item: int, radius: int) -> list[int]:
        """All items at most ``radius`` away: only edges within the radius are followed."""
        found, open_nodes = [], [0] if self.items else []
        items, children = self.items, self.children
        while open_nodes:
            at = open_nodes.pop()
            distance = (items[at] ^ item).bit_count()
            if distance <= radius:
                found.append(items[at])
            low, high = distance - radius, distance + radius
            for edge, child in children[at].items():
                if low <= edge <= high:
                    open_nodes.append(child)
        return found


def link_cells(cells: DataFrame, radius: int = RADIUS) -> DataFrame:
    """A spanning forest ``(a, b)`` of the links within each (key, cell)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_key, tree, sets = None, BKTree(), graph.UnionFind()

        def close() -> pa.RecordBatch:
            pairs = sets.edges()
            signed = lambda k: pa.array(np.array([p[k] for p in pairs], dtype=np.uint64).view(np.int64))
            return pa.RecordBatch.from_arrays([signed(0), signed(1)], ["a", "b"])

        for batch in batches:
            t, v, cell, fps = (batch.column(i).to_pylist() for i in range(4))
            for key, fp in zip(zip(t, v, cell, strict=True), fps, strict=True):
                fp &= _MASK
                if key != open_key:
                    if sets.parent:
                        yield close()
                    open_key, tree, sets = key, BKTree(), graph.UnionFind()
                for other in tree.within(fp, radius):
                    if other != fp:
                        sets.union(fp, other)
                tree.add(fp)
        if sets.parent:
            yield close()

    dealt = cells.repartition("key", "cell").sortWithinPartitions("key", "cell", "fp")
    return dealt.select("key.t", "key.v", "cell", "fp").mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per row of ``docs``.

    Fingerprints at most ``radius`` bits apart are linked, and component_id is the
    smallest doc_id that links reach. A null text is an empty one; texts without
    words share the fingerprint zero and are linked like any others; a row with a
    null doc_id gets its component's smallest id, null if there is none; repeated
    rows stay; an empty table gives no row. Extra columns are ignored.
    """
    own = common.stage(fingerprints(docs), "fingerprints")
    distinct = common.stage(own.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    n = distinct.count()
    blocks = next(b for most, b in BLOCK_STEPS if most is None or n <= most)
    keyed = distinct.select("fp", F.explode(shard_keys(F.col("fp"), max(blocks, radius + 1), radius)).alias("key"))
    # The links are staged, so that no task runs two Python workers at once, which would both stay and double an executor's memory.
    links = common.stage(link_cells(common.pair_cells(keyed, "key", "fp", MAX_CELL), radius), "links")
    roots = graph.connected_components(links)
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(least, "root").select("fp", "component_id")
    return own.join(labels, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay when each component keeps one: its smallest doc_id.

    Of repeated rows of that id one stays, by the order of its text's hash and its
    place in the table; a component without any doc_id keeps one row likewise. All
    columns stay as they are.
    """
    whole = common.Hidden(docs)
    # Rows get a number here, and are staged once, so that both sides of the join see the same one.
    rows = common.stage(whole.frame.withColumn("_row", F.monotonically_increasing_id()), "rows")
    ids = rows.select(F.col("_row").alias("doc_id"), whole.ref("text").alias("text"))
    found = near_duplicates(ids, radius).select(F.col("doc_id").alias("_row"), F.col("component_id").alias("_component"))
    tagged = rows.select("_row", whole.ref("doc_id").alias("_id")).join(found, "_row")
    first = tagged.groupBy("_component").agg(F.min(F.struct(F.col("_id").isNull().alias("n"), F.col("_id").cast("long").alias("i"), F.col("_row").alias("r"))).alias("f")).select(F.col("f.r").alias("_row"))
    return whole.restore(rows.join(first, "_row", "left_semi"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document of ``documents``."""
    return near_duplicates(common.table(spark, sf_dir, "documents"))
