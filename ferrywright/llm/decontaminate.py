"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment (operator 9)."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

#: Words of a seed. Items with fewer words are sought as a whole.
SEED_WORDS = 3
#: A seed is rare if chance, by the corpus's counts of its words, brings it into at most so many of the documents of mean length.
RARE_SHARE = 0.01
#: An item's seeds are chosen by stretches of so many, so that each part of it has some.
STRETCH_SEEDS = 8
#: Scores of the word alignment, and the share of an item's best score from which a document counts as contaminated.
MATCH, MISMATCH, GAP = 2, -1, -1
MIN_SCORE = 0.4
#: Items are taken in blocks of at most so many words, each broadcast, about 30 bytes a word; the whole corpus meets every block.
BLOCK_WORDS = 8_000_000

PAIRS = "doc_id long, item_id long, score double, matched long, start_word long, end_word long"
_TO_SPACE = bytes(c if chr(c).isalnum() and c < 128 or c >= 128 else 32 for c in range(256))


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words; ASCII characters that are neither letters nor digits part them."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_TO_SPACE).split()


class SeedIndex:
    """The seeds of a block of items, as sorted keys over the block's own word numbers; arrays throughout, so that a block of millions of words is one broadcast."""

    def __init__(self, items: list[tuple[int | None, list[bytes]]], counts: dict[bytes, int] | None = None, n_words: int = 0, n_docs: int = 0):
        kept = [(i, w) for i, w in items if w]
        self.item_ids = [i for i, _ in kept]
        self.vocabulary: dict[bytes, int] = {}
        self.ids = [np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws], dtype=np.int32) for _, ws in kept]
        self.base = len(self.vocabulary) + 1
        share = np.zeros(len(self.vocabulary))
        for w, n in (counts or {}).items():
            share[self.vocabulary[w]] = n / max(1, n_words)
        found: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = defaultdict(list)
        for k, ids in enumerate(self.ids):
            n = min(SEED_WORDS, len(ids))
            keys, chance = self.keys(ids, n), np.full(len(ids) - n + 1, n_words / max(1, n_docs))
            for j in range(n):
                chance *= share[ids[j : len(ids) - n + 1 + j]]
            # Seeds with a word that the corpus lacks are in no document.
            held = np.flatnonzero(chance > 0) if counts is not None else np.arange(len(keys))
            stretch, rare = np.arange(len(held)) // STRETCH_SEEDS, chance[held] <= RARE_SHARE
            # A stretch of common words alone keeps all its seeds.
            chosen = held[rare | (np.bincount(stretch, weights=rare) == 0)[stretch]] if len(held) else held
            found[n].append((keys[chosen], np.full(len(chosen), k, dtype=np.int32), chosen.astype(np.int32)))
        self.tables = {}
        for n, parts in found.items():
            keys, items_of, places = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(keys, kind="stable")
            distinct, first = np.unique(keys[order], return_index=True)
            if len(distinct):
                self.tables[n] = (distinct, np.append(first, len(order)), np.stack([items_of, places], axis=1)[order])

    def keys(self, ids: np.ndarray, n: int) -> np.ndarray:
        """Numbers of all runs of n words; of more than two million distinct words they wrap round, and seeds that share one are told apart by the alignment."""
        key = np.zeros(max(0, len(ids) - n + 1), dtype=np.int64)
        for j in range(n):
            key = key * self.base + ids[j : len(ids) - n + 1 + j] + 1
        return key

    def number(self, words: list[bytes]) -> np.ndarray:
        """The words' numbers in the block's vocabulary, -1 for any other word."""
        return np.fromiter(map(self.vocabulary.get, words, repeat(-1)), dtype=np.int64, count=len(words))

    def seeds(self, ids: np.ndarray) -> dict[int, list[int]]:
        """For each item with a seed in the document, where the item would begin, sorted."""
        out: dict[int, list[int]] = defaultdict(list)
        known = ids >= 0
        for n, (keys, offsets, hits) in self.tables.items():
            if len(ids) < n:
                continue
            whole = known[: len(ids) - n + 1].copy()
            for j in range(1, n):
                whole &= known[j : len(ids) - n + 1 + j]
            at = np.flatnonzero(whole)
            if not len(at):
                continue
            key = np.zeros(len(at), dtype=np.int64)
            for j in range(n):
                key = key * self.base + ids[at + j] + 1
            slot = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            for a, s in zip(at[good := keys[slot] == key].tolist(), slot[good].tolist(), strict=True):
                for k, j in hits[offsets[s] : offsets[s + 1]].tolist():
                    out[k].append(a - j)
        return {k: sorted(v) for k, v in out.items()}

    def windows(self, starts: list[int], item_words: int, doc_words: int) -> Iterator[tuple[int, int]]:
        """Stretches of the document round the seeds, wide enough for inserted words; overlapping ones are one."""
        slack = item_words // 2 + 2
        low = high = None
        for s in starts:
            a, b = max(0, s - slack), min(doc_words, s + item_words + slack)
            if high is None or a > high:
                if high is not None:
                    yield low, high
                low, high = a, b
            high = max(high, b)
        if high is not None:
            yield low, high

    def matches(self, text: str | None, min_score: float = MIN_SCORE, first_only: bool = False) -> list[tuple[int | None, float, int, int, int]]:
        """``(item_id, score, matched, start_word, end_word)`` of each item whose best alignment scores enough."""
        ids = self.number(words_of(text))
        out = []
        for k, starts in self.seeds(ids).items():
            item, best = self.ids[k], None
            for a, b in self.windows(starts, len(item), len(ids)):
                window = ids[a:b]
                # No alignment scores more than all item words that the window has.
                if np.isin(item, window).sum() < min_score * len(item):
                    continue
                score, matched, start, end = align(item, window)
                share = score / (MATCH * len(item))
                if share >= min_score and (best is None or share > best[1]):
                    best = (self.item_ids[k], share, matched, a + start, a + end)
            if best:
                out.append(best)
                if first_only:
                    break
        return out


def align(item: np.ndarray, window: np.ndarray) -> tuple[int, int, int, int]:
    """Smith-Waterman: best local score, matched words, and the aligned stretch of the window.

    One row of the table is held at a time; each cell carries where its alignment begins
    and how many words match, so that memory goes with the window alone. Of equal
    scores the first item word and the first window word to reach it count.
    """
    n = len(window)
    at = np.arange(n + 1, dtype=np.int64)
    score, begin, matched = np.zeros(n + 1, dtype=np.int64), at.copy(), np.zeros(n + 1, dtype=np.int64)
    best = (0, 0, 0, 0)
    for word in item:
        same = window == word
        # From the cell before in both: an alignment that has no score yet begins here.
        diagonal = score[:-1] + np.where(same, MATCH, MISMATCH)
        up = score[1:] + GAP
        take = diagonal >= up
        row = np.concatenate([[0], np.maximum(np.maximum(diagonal, up), 0)])
        own = score[:-1] > 0
        row_begin = np.concatenate([[0], np.where(take, np.where(own, begin[:-1], at[:-1]), begin[1:])])
        row_matched = np.concatenate([[0], np.where(take, np.where(own, matched[:-1], 0) + same, matched[1:])])
        # A run of gaps in the item: the best of all cells to the left, less a gap a step.
        reach = row - GAP * at
        most = np.maximum.accumulate(reach)
        source = np.maximum.accumulate(np.where(reach == most, at, 0))
        score = np.maximum(most + GAP * at, 0)
        begin, matched = row_begin[source], row_matched[source]
        j = int(score.argmax())
        if score[j] > best[0]:
            best = (int(score[j]), int(matched[j]), int(begin[j]), j)
    return best


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[list[tuple[int | None, list[bytes]]]]:
    """The items in blocks of at most ``block_words`` words (a longer item is its own block)."""
    block, held = [], 0
    slim = common.pick(benchmark, item_id="item_id", text="text").select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    for row in slim.orderBy("item_id", "text").toLocalIterator():
        words = words_of(row[1])
        if block and held + len(words) > block_words:
            yield block
            block, held = [], 0
        block.append((row[0], words))
        held += len(words)
    if block:
        yield block


def word_counts(docs: DataFrame, vocabulary: list[bytes]) -> tuple[dict[bytes, int], int, int]:
    """Counts over the whole corpus of a block's words, and of all words and documents."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast({w: k for k, w in enumerate(vocabulary)})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, tally = shared.value, np.zeros(len(shared.value) + 1, dtype=np.int64)
        n_words = n_docs = 0
        for batch in batches:
            for piece in common.pieces(batch):
                for text in piece.column(0).to_pylist():
                    words = words_of(text)
                    n_words, n_docs = n_words + len(words), n_docs + 1
                    if words:
                        tally += np.bincount(np.fromiter(map(known.get, words, repeat(len(known))), dtype=np.int64, count=len(words)), minlength=len(tally))
        at = np.flatnonzero(tally[:-1])
        yield pa.RecordBatch.from_pydict({"k": pa.array([*at.tolist(), -1, -2], pa.int64()), "n": pa.array([*tally[at].tolist(), n_words, n_docs], pa.int64())})

    rows = common.pick(docs, text="text").select(F.col("text").cast("string")).mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    found = {r.k: r.n for r in rows}
    return {w: found.get(k, 0) for k, w in enumerate(vocabulary)}, found.get(-1, 0), found.get(-2, 0)


def indexes(docs: DataFrame, benchmark: DataFrame) -> Iterator[SeedIndex]:
    """A seed index per block of items; the rarity of seeds is over all of ``docs``."""
    for block in item_blocks(benchmark):
        words = list(dict.fromkeys(w for _, ws in block for w in ws))
        if words:
            yield SeedIndex(block, *word_counts(docs, words))


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """``(doc_id, item_id, score, matched, start_word, end_word)``: documents that hold an item, whole or edited.

    score is the best local alignment's over the item's best possible one; start and
    end are word numbers in the document. A null or empty text or item matches
    nothing; a null id is carried as null; repeated rows have their pairs each; empty
    tables give no pair. Extra columns are ignored.
    """
    spark = docs.sparkSession
    slim = common.pick(docs, doc_id="doc_id", text="text").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = spark.createDataFrame([], PAIRS)
    for index in indexes(docs, benchmark):
        out = out.unionByName(slim.mapInArrow(_pair_rows(spark.sparkContext.broadcast(index), min_score), PAIRS))
    return out


def _pair_rows(shared, min_score: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = shared.value
        for batch in batches:
            for piece in common.pieces(batch):
                rows = [(doc, *m) for doc, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True) for m in index.matches(text, min_score)]
                if rows:
                    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], ["doc_id", "item_id", "score", "matched", "start_word", "end_word"])

    return run


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns as they are; nothing is shuffled.

    A null or empty text holds nothing and stays, as does a row with null ids; repeated rows are judged each and stay
    or go together; very long texts are aligned in memory that goes with the text; without items all rows stay; an
    empty table gives no row; columns of any name, clashing ones too, are carried.
    """
    context = docs.sparkSession.sparkContext
    out = docs
    for index in indexes(docs, benchmark):
        shared = context.broadcast(index)

        def judge(shared=shared):
            return lambda batch: [not shared.value.matches(t, min_score, first_only=True) for t in batch.column(0).to_pylist()]

        out = common.filter_rows(out, ["text"], judge)
    return out


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of a document of ``documents`` and an item of ``benchmark`` that it holds."""
    return contaminated_pairs(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark"))
