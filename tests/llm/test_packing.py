"""Packing against the library's ids and against best fit piece by piece."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ferrywright.llm import common, packing


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(packing.default_tokenizer())


def one_by_one(lengths, capacity):
    """Rooms of the sequences of plain best fit, longest first."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fit = [i for i, r in enumerate(rooms) if r >= length]
        if fit:
            rooms[min(fit, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(capacity - length)
    return rooms


def check(got, docs, library, capacity):
    found = Counter()
    ids_of = {}
    for doc, text in docs:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        ids_of[doc] = ids
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            found[doc, piece, start, len(part), zlib.crc32(np.array(part, dtype="<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == found
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    rooms = one_by_one([r.length for r in got], capacity)
    assert sorted(capacity - sum(n for _, n in held) for held in sequences.values()) == sorted(rooms)
    return ids_of


def test_table(spark, data, library):
    docs = common.table(spark, data, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check(packing.pack_documents(docs).collect(), rows, library, packing.CAPACITY)


def test_edge_rows_and_sequences(spark, library):
    rnd = random.Random(2)
    words = ["Don't", "café", "İst", "x<|endoftext|>y", "12³", "--", "\x1cq", "ΣΑΣ", "é"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 12)))) for i in range(150)] + [(900, None), (901, ""), (902, "long text " * 4000), (None, "no id")] + [(903, "same same same")] * 40
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"part": F.lit("p"), "offset": F.lit(1)}).repartition(5)
    got = packing.pack_documents(docs, 64).collect()
    ids_of = check(got, rows, library, 64)
    sequences = packing.packed_sequences(docs, 64).collect()
    assert len(sequences) == len({r.sequence_id for r in got})
    pieces = Counter()
    for s in sequences:
        ids, at = np.frombuffer(bytes(s.ids), dtype="<u4").tolist(), 0
        assert len(ids) == s.n_ids == sum(s.lengths) <= 64
        for doc, length in zip(s.doc_ids, s.lengths, strict=True):
            pieces[doc, tuple(ids[at : at + length])] += 1
            at += length
    want = Counter()
    for doc, _ in rows:
        for start in range(0, len(ids_of[doc]), 64):
            want[doc, tuple(ids_of[doc][start : start + 64])] += 1
    assert pieces == want
    assert packing.pack_documents(docs.limit(0)).collect() == [] and packing.packed_sequences(docs.limit(0)).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_plan_equals_best_fit_one_by_one(seed):
    rnd = random.Random(seed)
    capacity = rnd.choice([7, 30, 100])
    lengths = [rnd.randint(1, capacity if seed % 2 else max(2, capacity // 3)) for _ in range(rnd.randint(0, 400))]
    plan = packing.plan_packing(Counter(lengths), capacity)
    rooms = Counter()
    for s in plan:
        for i in range(s.n):
            rooms[s.sequence + i // s.each] += s.length
    assert sorted(capacity - n for n in rooms.values()) == sorted(one_by_one(lengths, capacity))
    assert len(plan) <= 40 * capacity and sum(s.n for s in plan) == len(lengths)


def test_plan_size_does_not_grow_with_counts():
    few = packing.plan_packing({n: 3 + n % 5 for n in range(1, 2049)})
    many = packing.plan_packing({n: 10**7 * (3 + n % 5) for n in range(1, 2049)})
    assert len(many) < 4 * len(few) and sum(s.n for s in many) == sum(10**7 * (3 + n % 5) for n in range(1, 2049))
