"""Token shards: exact round trip against the tokenizers library."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ferrywright.llm import common, huffman, tokens


@given(st.lists(st.integers(0, 10**6), min_size=0, max_size=300), st.integers(9, 20))
@settings(max_examples=60, deadline=None)
def test_code_lengths_are_complete_and_limited(counts, limit):
    lengths = huffman.code_lengths(np.array(counts, dtype=np.int64), limit)
    used = [n for n, c in zip(lengths, counts, strict=True) if c]
    assert all(n == 0 for n, c in zip(lengths, counts, strict=True) if not c)
    assert max(used, default=0) <= limit
    if len(used) > 1:
        assert sum(2.0**-n for n in used.__iter__() for n in [int(n)]) == 1.0


def test_code_lengths_are_optimal_without_pressure():
    import heapq

    rng = np.random.default_rng(1)
    counts = rng.integers(1, 1000, 200)
    heap = [int(c) for c in counts]
    heapq.heapify(heap)
    cost = 0
    while len(heap) > 1:
        a = heapq.heappop(heap) + heapq.heappop(heap)
        cost += a
        heapq.heappush(heap, a)
    assert int((huffman.code_lengths(counts) * counts).sum()) == cost


def test_limit_holds_under_pressure():
    counts = np.array([2**i for i in range(30)], dtype=np.int64)
    lengths = huffman.code_lengths(counts, 8)
    assert lengths.max() == 8 and sum(2.0 ** -int(n) for n in lengths) == 1.0


@pytest.mark.parametrize("n", [0, 1, 7, 512, 513, 5000])
def test_bits_round_trip(n):
    rng = np.random.default_rng(n)
    ids = rng.zipf(1.3, n).clip(0, 4000)
    lengths = huffman.code_lengths(np.bincount(ids, minlength=4001))
    packed, offsets = huffman.Encoder(lengths).encode(ids, 512)
    if n:
        decoder = huffman.Decoder(lengths)
        assert decoder.decode(packed, offsets, n, 512).tolist() == ids.tolist()
        last = len(offsets) - 1
        assert decoder.decode(packed, offsets[last:], n - 512 * last, 512).tolist() == ids[512 * last :].tolist()


def library_rows(rows):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.default_tokenizer())
    out, start = [], 0
    for doc, text in rows:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((doc, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def test_edge_rows(spark):
    odd = "x² ½ 𝟘 Ⅷ a\x1cb _under_score don't  \n\n  end \u0085 <|endoftext|> naïve — “q” 漢字 १२"
    rows = [(7, "b b"), (3, None), (3, "same id"), (None, "no id"), (1, ""), (5, odd), (6, "word " * 4000), (9, " \t ")]
    docs = spark.createDataFrame([(d, t, 1, "z") for d, t in rows], "doc_id long, text string, start int, TEXT string")
    got = [tuple(r) for r in tokens.encode_corpus(docs.toDF("doc_id", "text", "start", "part")).orderBy("start").collect()]
    ends = [r for r in got if r[0] == 3]
    order = [(1, "")] + [(3, t) for _, _, n, _ in ends for t in ([None] if n == 1 else ["same id"])] + [(5, odd), (6, "word " * 4000), (7, "b b"), (9, " \t "), (None, "no id")]
    assert got == library_rows(order)


def test_no_rows(spark):
    assert tokens.encode_corpus(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_one_symbol(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert [r.start for r in tokens.encode_corpus(docs).orderBy("start").collect()] == [0, 1]


def test_table_matches_library_and_blocks_can_be_read_alone(spark, data):
    path = common.new_path(spark, "test-shards")
    docs = common.table(spark, data, "documents")
    got = [tuple(r) for r in tokens.encode_corpus(docs, path).orderBy("start").collect()]
    rows = [(r.doc_id, r.text) for r in docs.orderBy("doc_id").collect()]
    assert got == library_rows(rows)
    shard = bytes(spark.read.parquet(path).orderBy("part", "chunk").first().shard)
    _, ids = tokens.decode_shard(shard)
    assert tokens.read_block(shard, 1).tolist() == ids[512:1024].tolist()


def test_added_tokens_are_those_of_the_library_as_it_is(spark):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.default_tokenizer())
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>", "  <|endoftext|>\n漢字", "a <|endoftext| > b", "plain words"]
    got = tokens.encode_corpus(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("start").collect()
    ids = [[*library.encode(t, add_special_tokens=False).ids, 0] for t in texts]
    assert 50256 in ids[0] and 50256 not in ids[3]
    assert [(r.n_tokens, r.ids_crc32) for r in got] == [(len(x), zlib.crc32(np.array(x, dtype="<u4").tobytes())) for x in ids]
