"""Token ids in a compressed, seekable binary format (operator 7).

Layout of one shard: the magic ``FWT1``, seven little-endian int64 (global start
of its first id, documents, ids, ids per block, blocks, bytes of the zlib-packed
code lengths, bytes of bits), the code lengths, per document its id, whether that
id is null, and its number of ids, per block the bit offset at which it begins,
and the bits. Shards are rows ``(part, chunk, shard)`` of a Parquet table, in
ascending doc_id by (part, chunk), so any store that Spark writes will hold them
and the commit protocol covers lost executors. A reader can start at any block.
"""

from __future__ import annotations

import re
import struct
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, huffman

MAGIC = b"FWT1"
HEAD = "<4s7q"
END_ID = 0
#: Ids in one shard (a longer document has a shard of its own), and in one block.
CHUNK_IDS = 1 << 20
BLOCK_IDS = 512
#: Distinct words whose ids one Python worker keeps, about 200 MB; others are encoded when they come.
CACHED_WORDS = 700_000

STAGED = "part int, chunk int, part_offset long, n_ids long, doc_ids array<long>, doc_sizes array<long>, ids binary, used array<int>, used_counts array<long>"
SHARDS = "part int, chunk int, n_ids long, shard binary"
READ = "doc_id long, start long, n_tokens long, ids_crc32 long"

#: Anything beyond the characters that Python's re and the library class alike, such as numerals that are no decimal digits; such texts go to the library whole.
_ODD = re.compile("[^\x00-\x1b\x20-\xb1\xb4-\xb8\xba\xbb\xbf-\u052f\u2000-\u206f\u20a0-\u20bf]")
#: The letters among those characters, listed, as Python's re looks a listed one up at once and asks of any other three questions.
_LETTERS = "".join(re.findall(r"[^\W\d_]", _ODD.sub("", "".join(map(chr, range(0x20C0))))))
#: The byte-level pre-tokeniser's rule, for Python's re: the same words in texts that are not odd.
_WORDS = re.compile(rf" ?[{_LETTERS}]+|'s|'t|'re|'ve|'m|'ll|'d| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")


def _byte_letters() -> dict[int, str]:
    """The byte-level vocabulary's letter for each byte: itself if it shows in print, else the next one from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(0x100) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


class WordEncoder(dict):
    """Encodes texts through the tokenizers library, each distinct word once: a dict of words' ids as bytes that fills itself.

    A word goes straight to the library's model, in the letters of its byte-level vocabulary.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(path)
        #: What the library takes out of a text before it cuts words; such texts go to it whole.
        self.added = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.model = self.library.model
        self.letters = _byte_letters()
        self.dtype = "<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4"
        self.code = array("H").typecode if self.dtype == "<u2" else array("I").typecode

    def __missing__(self, word: str) -> bytes:
        # Of ASCII in print the space alone is spelt with another letter.
        spelt = word.replace(" ", self.letters[0x20]) if word.isascii() and word.isprintable() else word.encode("utf-8").decode("latin-1").translate(self.letters)
        ids = array(self.code, [t.id for t in self.model.tokenize(spelt)]).tobytes()
        if len(self) < CACHED_WORDS:
            self[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        if _ODD.search(text) or any(t in text for t in self.added):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()
        return b"".join(map(self.__getitem__, _WORDS.findall(text)))


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def stage_ids(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """Encode whole texts in ascending doc_id order and stage the ids in chunks.

    ``tokenizer`` names the vocabulary file on the executors; None takes the
    installed public one there.
    """
    slim = common.pick(docs, doc_id="doc_id", text="text").select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty("text").alias("text"))
    # Repeated ids are told apart by their texts, so that a hot id spreads over ranges too.
    keys = [F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text")]
    ranged = slim.repartitionByRange(*keys).sortWithinPartitions(*keys)

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer or default_tokenizer())
        part = TaskContext.get().partitionId()
        width = np.dtype(encoder.dtype).itemsize
        end = np.array([END_ID], dtype=encoder.dtype).tobytes()
        counts = np.zeros(1 << 16, dtype=np.int64)
        waiting: list[tuple[int | None, bytes]] = []
        held, chunk, offset = 0, 0, 0

        def flush(last: bool) -> pa.RecordBatch:
            nonlocal waiting, held, chunk, offset, counts
            blob = b"".join(x for _, x in waiting)
            ids = np.frombuffer(blob, dtype=encoder.dtype)
            found = np.bincount(ids, minlength=len(counts))
            if len(found) > len(counts):
                counts = np.pad(counts, (0, len(found) - len(counts)))
            counts[: len(found)] += found
            used = np.flatnonzero(counts) if last else np.zeros(0, dtype=np.int64)
            row = pa.RecordBatch.from_pydict(
                {
                    "part": pa.array([part], pa.int32()), "chunk": pa.array([chunk], pa.int32()), "part_offset": [offset], "n_ids": [len(ids)],
                    "doc_ids": pa.array([[d for d, _ in waiting]], pa.list_(pa.int64())), "doc_sizes": pa.array([[len(x) // width for _, x in waiting]], pa.list_(pa.int64())),
                    "ids": pa.array([blob], pa.binary()),
                    "used": pa.array([used.tolist()], pa.list_(pa.int32())), "used_counts": pa.array([counts[used].tolist()], pa.list_(pa.int64())),
                }
            )
            offset, chunk, waiting, held = offset + len(ids), chunk + 1, [], 0
            return row

        for batch in batches:
            for piece in common.pieces(batch):
                for doc, text in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist(), strict=True):
                    blob = encoder.encode(text) + end
                    if waiting and held + len(blob) // width > CHUNK_IDS:
                        yield flush(False)
                    waiting.append((doc, blob))
                    held += len(blob) // width
        yield flush(True)

    with common.settings(docs.sparkSession, spark__sql__execution__arrow__maxRecordsPerBatch="2000"):
        return common.stage(ranged.mapInArrow(chunks, STAGED), "token-ids")


def write_shards(staged: DataFrame, path: str) -> None:
    """Write the staged ids as Huffman-coded shards to ``path``.

    The counts of ids are global. They come to the driver by distinct id, at most
    the size of the vocabulary; the starts come by range partition.
    """
    spark = staged.sparkSession
    tally = staged.select(F.explode(F.arrays_zip("used", "used_counts")).alias("u")).groupBy(F.col("u.used").alias("id")).agg(F.sum("u.used_counts").alias("n")).collect()
    counts = np.zeros(max([r.id for r in tally], default=0) + 1, dtype=np.int64)
    for r in tally:
        counts[r.id] = r.n
    lengths = huffman.code_lengths(counts)
    totals = sorted((r.part, r.n) for r in staged.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    starts, run = {}, 0
    for part, n in totals:
        starts[part], run = run, run + n
    shared = spark.sparkContext.broadcast((lengths, starts))

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, starts = shared.value
        encoder, book = huffman.Encoder(lengths), zlib.compress(lengths.tobytes(), 6)
        for batch in batches:
            for row in batch.to_pylist():
                wide = row["n_ids"] and len(row["ids"]) == 4 * row["n_ids"]
                ids = np.frombuffer(row["ids"], dtype="<u4" if wide else "<u2")
                bits, offsets = encoder.encode(ids.astype(np.int64), BLOCK_IDS)
                docs = row["doc_ids"]
                head = struct.pack(HEAD, MAGIC, starts[row["part"]] + row["part_offset"], len(docs), len(ids), BLOCK_IDS, len(offsets), len(book), len(bits))
                shard = b"".join([
                    head, book, np.array([d or 0 for d in docs], dtype="<i8").tobytes(), np.array([d is None for d in docs], dtype="u1").tobytes(),
                    np.array(row["doc_sizes"], dtype="<i8").tobytes(), offsets.astype("<i8").tobytes(), bits,
                ])
                yield pa.RecordBatch.from_pydict({"part": pa.array([row["part"]], pa.int32()), "chunk": pa.array([row["chunk"]], pa.int32()), "n_ids": [len(ids)], "shard": pa.array([shard], pa.binary())})

    with common.settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch="4"):
        staged.select("part", "chunk", "part_offset", "n_ids", "doc_ids", "doc_sizes", "ids").mapInArrow(shards, SHARDS).write.option("compression", "uncompressed").parquet(path)


def open_shard(shard: bytes) -> dict:
    """The parts of one shard, without decoding ids."""
    magic, start, n_docs, n_ids, block, n_blocks, n_book, n_bits = struct.unpack_from(HEAD, shard)
    if magic != MAGIC:
        raise ValueError("not a token shard")
    at = struct.calcsize(HEAD)
    lengths = np.frombuffer(zlib.decompress(shard[at : at + n_book]), dtype="u1")
    at += n_book
    docs = np.frombuffer(shard, "<i8", n_docs, at)
    nulls = np.frombuffer(shard, "u1", n_docs, at + 8 * n_docs)
    sizes = np.frombuffer(shard, "<i8", n_docs, at + 9 * n_docs)
    offsets = np.frombuffer(shard, "<i8", n_blocks, at + 17 * n_docs)
    at += 17 * n_docs + 8 * n_blocks
    return {"start": start, "docs": docs, "nulls": nulls, "sizes": sizes, "n_ids": n_ids, "block": block, "offsets": offsets, "lengths": lengths, "bits": shard[at : at + n_bits]}


def decode_shard(shard: bytes, decoders: dict | None = None) -> tuple[dict, np.ndarray]:
    """The parts of a shard and all its ids."""
    x = open_shard(shard)
    key = x["lengths"].tobytes()
    decoders = {} if decoders is None else decoders
    if key not in decoders:
        decoders.clear()
        decoders[key] = huffman.Decoder(x["lengths"])
    return x, decoders[key].decode(x["bits"], x["offsets"], x["n_ids"], x["block"]) if x["n_ids"] else np.zeros(0, dtype=np.uint32)


def read_block(shard: bytes, block: int) -> np.ndarray:
    """The ids of one block alone, from its bit-offset checkpoint."""
    x = open_shard(shard)
    n = min(x["block"], x["n_ids"] - block * x["block"])
    return huffman.Decoder(x["lengths"]).decode(x["bits"], x["offsets"][block : block + 1], n, x["block"])


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files at ``path``: doc_id, start, n_tokens and the crc32 of its ids."""

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoders: dict = {}
        for batch in batches:
            for blob in batch.column(0):
                x, ids = decode_shard(blob.as_py(), decoders)
                raw = memoryview(ids.astype("<u4").tobytes())
                ends = np.cumsum(x["sizes"])
                first = ends - x["sizes"]
                crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": pa.array(x["docs"], pa.int64(), mask=x["nulls"].astype(bool)), "start": pa.array(x["start"] + first, pa.int64()), "n_tokens": pa.array(x["sizes"], pa.int64()), "ids_crc32": pa.array(crcs, pa.int64())}
                )

    return spark.read.schema(SHARDS).parquet(path).select("shard").mapInArrow(documents, READ)


def encode_corpus(docs: DataFrame, path: str | None = None, tokenizer: str | None = None) -> DataFrame:
    """Encode ``docs`` into shards at ``path`` (a scratch folder if None) and read them back.

    Every document has the end id 0 after its ids. A null or empty text is the end
    id alone; a null doc_id sorts last; repeated ids keep a row each, in the order
    of their texts' hashes; an empty table gives no row. Extra columns are ignored.
    The string of one of the tokenizer's added tokens is that token wherever a text has it, as in the library itself.
    """
    spark = docs.sparkSession
    path = path or common.new_path(spark, "token-shards")
    staged = stage_ids(docs, tokenizer)
    write_shards(staged, path)
    common.release(spark, [staged.staged_at])
    return read_shards(spark, path)


def op7_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document of ``documents`` as ids in shards, read back from them."""
    return encode_corpus(common.table(spark, sf_dir, "documents"))
