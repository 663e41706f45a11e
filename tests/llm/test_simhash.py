"""SimHash links against a comparison of all pairs, and the component job against a plain union-find."""

import random
import re

import pytest
import xxhash

from ferrywright.llm import common, graph, simhash


def plain_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    fps = sorted({f for _, f in rows})
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for d, f in rows:
        if d is not None:
            r = find(f)
            least[r] = min(least.get(r, d), d)
    return sorted(((d, f"{f:016x}", least.get(find(f))) for d, f in rows), key=str)


def test_table_matches_all_pairs(spark, data):
    docs = common.table(spark, data, "documents")
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str) == plain_components(rows)


@pytest.mark.parametrize("max_cell", [4096, 3])
def test_planted_bits_and_hot_cells(spark, monkeypatch, max_cell):
    monkeypatch.setattr(simhash, "MAX_CELL", max_cell)
    rng = random.Random(5)
    fps = []
    for _ in range(40):
        f = rng.getrandbits(64)
        fps.append(f)
        for _ in range(6):
            g = f
            for b in rng.sample(range(64), rng.randint(1, 4)):
                g ^= 1 << b
            fps.append(g)
            f = g
    rows = list(enumerate(fps))
    frame = spark.createDataFrame([(d, f - (1 << 64) if f >> 63 else f) for d, f in rows], "doc_id long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs: docs)
    assert sorted(map(tuple, simhash.near_duplicates(frame).collect()), key=str) == plain_components(rows)


@pytest.mark.parametrize("blocks", [4, 5, 6])
def test_shard_keys_meet_within_the_radius(spark, blocks):
    from pyspark.sql import functions as F

    rng = random.Random(blocks)
    pairs = []
    for _ in range(200):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), 3):
            b ^= 1 << bit
        pairs.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    frame = spark.createDataFrame(pairs, "a long, b long")
    met = frame.where(F.arrays_overlap(simhash.shard_keys(F.col("a"), blocks), simhash.shard_keys(F.col("b"), blocks)))
    assert met.count() == 200


def test_edge_rows(spark):
    long_text = "very long text " * 20000
    rows = [(5, None), (4, ""), (None, " \t\n"), (9, "one two"), (9, "one two"), (8, "ONE\x0btwo"), (7, long_text), (6, long_text + "x"), (None, "alone here now")]
    docs = spark.createDataFrame([(d, t, "c", 1) for d, t in rows], "doc_id long, text string, fingerprint string, fp int")
    got = sorted(map(tuple, simhash.near_duplicates(docs).collect()), key=str)
    assert got == plain_components([(d, plain_fingerprint(t)) for d, t in rows])
    assert simhash.near_duplicates(docs.limit(0)).collect() == []
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [4, 6, 8, None]


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(1, 2), (2, 1), (2, 3)], [(i, i + 1) for i in range(0, 70)], [(0, i) for i in range(1, 60)] + [(100, 60), (60, 59)]])
def test_components(spark, edges):
    got = {r.node: r.root for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    sets = graph.UnionFind()
    for a, b in edges:
        sets.union(a, b)
    assert got == {x: sets.find(x) for e in edges for x in e if e[0] != e[1]}
