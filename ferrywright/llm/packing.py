"""Best-fit packing of token ids into sequences of a fixed capacity, planned over counts of lengths (operator 13).

Documents become ids and, where longer than a sequence, are cut into pieces. Only the histogram of piece lengths comes to
the driver, a number per length. Best fit runs over it, longest pieces first, on runs of sequences that are filled
alike: so many pieces of a length go into so many sequences at once, exactly as if they came one by one. The
plan is a table of slots ``(length, first rank, ..)``, whose size goes with the capacity and not with the corpus. A piece's
rank among all of its length is its number within the task that cut it, plus the counts of the tasks before.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .tokens import END_ID, WordEncoder

CAPACITY = 2048
PIECES = "part int, at long, doc_id long, piece int, start long, length int, nth long, ids binary"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, part int, at long"

#: Beyond these characters Python's classes or lower case may part from the library's, or composition may change a text; such texts go to the library whole.
_ODD = re.compile("[^\t\n\r\x20-\x7e\xa0-\xa9\xab-\xb1\xb4-\xb8\xbb\xbf-įı-žЀ-ҁҊ-ԯ‐-‧‰-⁞₠-₿]")
#: The word-end vocabulary's rule for Python's re: the same words in texts that are not odd, once in lower case.
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\s\w]|_)+")


class PlainWordEncoder(WordEncoder):
    """The lower-casing word-end vocabulary: each distinct word goes through the library's model once."""

    def encode(self, text: str) -> bytes:
        if _ODD.search(text) or any(t in text for t in self.added):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()
        return b"".join(map(self.__getitem__, _WORDS.findall(text.lower())))


_encoders: dict[str, PlainWordEncoder] = {}


def _encoder(path: str) -> PlainWordEncoder:
    if path not in _encoders:
        _encoders[path] = PlainWordEncoder(path)
    return _encoders[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def cut_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """The staged pieces of all documents: ``(part, at, doc_id, piece, start, length, nth, ids)``.

    ``ids`` are little-endian unsigned 32-bit numbers, the end id behind a document's own; ``nth`` numbers the pieces of one length within
    ``part``, the task that wrote them, and ``at`` all of its pieces. Staged, so that both stay what they are.
    """
    slim = common.pick(docs, doc_id="doc_id", text="text").select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty("text").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, at = _encoder(tokenizer or default_tokenizer()), TaskContext.get().partitionId(), 0
        held: dict[int, int] = defaultdict(int)
        names = [c.split()[0] for c in PIECES.split(", ")]
        for batch in batches:
            for some in common.pieces(batch):
                rows = []
                for doc, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist(), strict=True):
                    ids = np.append(np.frombuffer(encoder.encode(text), dtype=encoder.dtype), np.array([END_ID], dtype=encoder.dtype)).astype("<u4")
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        length = min(capacity, len(ids) - start)
                        rows.append((part, at, doc, piece, start, length, held[length], ids[start : start + length].tobytes()))
                        held[length] += 1
                        at += 1
                kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    with common.settings(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch="2000"):
        return common.stage(slim.mapInArrow(cut, PIECES), "pieces")


@dataclass
class Slots:
    """Room for ``n`` pieces of one length from a rank on: ``each`` of them in every sequence from ``sequence`` on, behind ``offset`` ids."""

    length: int
    rank: int
    n: int
    sequence: int
    each: int
    offset: int


def plan_packing(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[Slots]:
    """Best fit of ``counts[length]`` pieces, longest first, each into the fullest sequence that has room for it.

    Sequences of equal room stand as runs ``(first, number)``. A piece that fits the fullest run makes its sequence fuller
    still, so the following pieces of the length go there until it has no more room: a run takes ``room // length`` a sequence.
    """
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)
    rooms: list[int] = []  # those that have runs, ascending
    plan, sequences = [], 0

    def add(room: int, run: tuple[int, int]) -> None:
        if room and run[1]:
            if not runs[room]:
                insort(rooms, room)
            runs[room].append(run)

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, number = runs[room].pop()
                if not runs[room]:
                    del rooms[at]
            else:
                room, first = capacity, sequences
                number = -(-left // (capacity // length))
                sequences += number
            each = min(left, room // length)
            taken = min(number, left // each)
            plan.append(Slots(length, rank, taken * each, first, each, capacity - room))
            rank, left = rank + taken * each, left - taken * each
            add(room - each * length, (first, taken))
            add(room, (first + taken, number - taken))
    return plan


def place_pieces(staged: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset, part, at)`` of staged pieces.

    The counts that come to the driver are at most ``capacity`` numbers; the plan that goes to the tasks is bounded by the capacity too.
    """
    tally = staged.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    counts = {r.length: r.n for r in tally.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = sorted(plan_packing(counts, capacity), key=lambda s: (s.length, s.rank))
    shared = staged.sparkSession.sparkContext.broadcast({f: np.array([getattr(s, f) for s in plan], dtype=np.int64) for f in ("length", "rank", "sequence", "each", "offset")})
    # One row per task that wrote pieces of the length in a window.
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = tally.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = staged.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "nth", "part", "at").join(bases, ["part", "length"])
    ranked = ranked.select("doc_id", "piece", "start", F.col("length").cast("long").alias("length"), "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"), "part", "at")

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = shared.value
        ends = np.cumsum(np.bincount(slots["length"], minlength=capacity + 1)) if len(slots["length"]) else np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            at = np.empty(len(rank), dtype=np.int64)
            for own in np.unique(length):
                mine = length == own
                at[mine] = ends[own - 1] + np.searchsorted(slots["rank"][ends[own - 1] : ends[own]], rank[mine], side="right") - 1
            nth, each = rank - slots["rank"][at], slots["each"][at]
            sequence, offset = slots["sequence"][at] + nth // each, slots["offset"][at] + nth % each * length
            columns = [*batch.columns[:5], pa.array(sequence), pa.array(offset), *batch.columns[6:]]
            yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PLACED.split(", ")])

    return ranked.mapInArrow(take, PLACED)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``, one row per piece of every document.

    A null or empty text is the end id alone; a text longer than ``capacity`` ids is cut, however long it is, and nothing else is; null and
    repeated doc_ids are documents like others, and equal lengths are told apart by their places in the staged table; an added
    token's string in a text is that token, as the library has it; an empty table gives no row. Extra columns are ignored.
    """
    return place_pieces(cut_pieces(docs, capacity, tokenizer), capacity).drop("part", "at")


def packed_sequences(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """``(sequence_id, n_ids, ids, doc_ids, lengths)``: the sequences themselves, ids as little-endian unsigned 32-bit numbers, and what they hold in order.

    Handling of nulls and repeats is that of :func:`pack_documents`. A sequence gathers at most ``capacity`` pieces.
    """
    staged = cut_pieces(docs, capacity, tokenizer)
    placed = place_pieces(staged, capacity).select("part", "at", "sequence_id", "offset")
    whole = staged.join(placed, ["part", "at"]).groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "doc_id", "length", "ids"))).alias("held"), F.sum("length").alias("n_ids"))
    ids = F.aggregate("held", F.lit(b""), lambda so_far, x: F.concat(so_far, x["ids"]))
    return whole.select("sequence_id", "n_ids", ids.alias("ids"), F.col("held.doc_id").alias("doc_ids"), F.col("held.length").alias("lengths"))


def op13_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of ``documents`` and its place in a sequence."""
    return pack_documents(common.table(spark, sf_dir, "documents"))
