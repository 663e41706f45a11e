"""Alignment against a plain Smith-Waterman, and seeds against the alignment of all pairs."""

import random
import tracemalloc

import numpy as np

from ferrywright.llm import common, decontaminate as dc


def plain_score(item, doc):
    best, above = 0, [0] * (len(doc) + 1)
    for a in item:
        row = [0]
        for j, b in enumerate(doc, 1):
            row.append(max(0, above[j - 1] + (2 if a == b else -1), above[j] - 1, row[-1] - 1))
        best = max(best, *row)
        above = row
    return best


def test_alignment_matches_plain_recursion():
    rng = random.Random(3)
    for _ in range(60):
        item = [rng.randrange(6) for _ in range(rng.randint(1, 20))]
        doc = [rng.randrange(7) for _ in range(rng.randint(1, 40))]
        score, matched, start, end = dc.align(np.array(item), np.array(doc))
        assert score == plain_score(item, doc)
        assert plain_score(item, doc[start:end]) == score and matched * 2 >= score


def edited(words, rng, rate):
    out = []
    for w in words:
        x = rng.random()
        if x < rate / 3:
            continue
        out.append("zzz" + w if x < 2 * rate / 3 else w)
        if x > 1 - rate / 3:
            out.append("extra")
    return out


def test_table_matches_alignment_of_all_pairs(spark, data):
    docs, bench = common.table(spark, data, "documents"), common.table(spark, data, "benchmark")
    rows = [(r.doc_id, dc.words_of(r.text)) for r in docs.collect()]
    items = [(r.item_id, dc.words_of(r.text)) for r in bench.collect()]
    want = set()
    for d, words in rows:
        held = set(words)
        for i, item in items:
            if sum(w in held for w in item) >= dc.MIN_SCORE * len(item):
                number = {w: n for n, w in enumerate(held | set(item))}
                score, *_ = dc.align(np.array([number[w] for w in item]), np.array([number[w] for w in words]))
                if score >= dc.MIN_SCORE * 2 * len(item):
                    want.add((d, i))
    got = {(r.doc_id, r.item_id) for r in dc.contaminated_pairs(docs, bench).collect()}
    assert got == want and want


def test_edited_copies_and_edge_rows(spark, data):
    rng = random.Random(9)
    items = [r.text for r in common.table(spark, data, "benchmark").orderBy("item_id").limit(12).collect()]
    filler = "plain words of no interest at all go here and there "
    docs = [(n, filler + " ".join(edited(t.split(), rng, 0.25)).upper() + " " + filler) for n, t in enumerate(items)]
    docs += [(100, None), (101, ""), (None, items[0]), (102, filler * 50), (103, items[1] + " " + items[1]), (103, items[1] + " " + items[1]), (104, filler * 20000 + items[2])]
    frame = spark.createDataFrame([(*r, 5, "c") for r in docs], "doc_id long, text string, item_id int, score string")
    bench = spark.createDataFrame([*enumerate(items), (50, None), (51, "..."), (None, "two words"), (53, "one")], "item_id long, text string")
    got = dc.contaminated_pairs(frame, bench).collect()
    assert sorted([r.doc_id for r in got], key=str) == sorted([*range(12), None, 103, 103, 104], key=str)
    assert all(r.item_id == r.doc_id for r in got if r.doc_id is not None and r.doc_id < 12)
    kept = dc.drop_contaminated(frame, bench)
    assert kept.columns == frame.columns and sorted(r.doc_id for r in kept.collect()) == [100, 101, 102]
    assert dc.contaminated_pairs(frame.limit(0), bench).collect() == []
    assert dc.contaminated_pairs(frame, bench.limit(0)).collect() == []


def test_blocks_of_items_give_the_same_pairs(spark, data, monkeypatch):
    docs, bench = common.table(spark, data, "documents"), common.table(spark, data, "benchmark")
    whole = sorted(map(tuple, dc.contaminated_pairs(docs, bench).collect()))
    monkeypatch.setattr(dc.item_blocks, "__defaults__", (300,))
    assert sorted(map(tuple, dc.contaminated_pairs(docs, bench).collect())) == whole


def test_common_words_with_an_unseen_or_rare_one(spark):
    rng = random.Random(8)
    common_words = "the of and to in a is that".split()
    text = lambda n: [rng.choice(common_words) for _ in range(n)]
    item, other = text(40), text(40)
    docs = [(n, " ".join(text(200))) for n in range(50)] + [(100, " ".join(text(80) + item + text(80))), (101, " ".join(text(80) + other[:19] + ["of"] + other[20:] + text(80))), (102, "rare " * 3)]
    unseen, rare = item[:20] + ["unseen"] + item[21:], other[:19] + ["rare"] + other[20:]
    bench = spark.createDataFrame([(1, " ".join(unseen)), (2, " ".join(rare))], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in dc.contaminated_pairs(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()}
    assert {(100, 1), (101, 2)} <= got


def test_long_items_and_texts_need_little_memory():
    rng = np.random.default_rng(4)
    item, text = rng.integers(0, 500, 1500), rng.integers(0, 500, 30_000)
    text[12_000:13_500] = item
    tracemalloc.start()
    score, matched, start, end = dc.align(item, text)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (score, matched, start, end) == (3000, 1500, 12_000, 13_500) and peak < 20_000_000


def plain_seeds(items, counts, n_words, n_docs):
    """The chosen (item, place) by loops over seeds."""
    chosen = set()
    for k, ws in enumerate(items):
        n = min(dc.SEED_WORDS, len(ws))
        chance = {}
        for j in range(len(ws) - n + 1):
            chance[j] = n_words / n_docs
            for w in ws[j : j + n]:
                chance[j] *= counts.get(w, 0) / n_words
        held = [j for j in chance if chance[j] > 0]
        for low in range(0, len(held), dc.STRETCH_SEEDS):
            stretch = held[low : low + dc.STRETCH_SEEDS]
            chosen |= {(k, j) for j in [j for j in stretch if chance[j] <= dc.RARE_SHARE] or stretch}
    return chosen


def test_seeds_are_those_of_plain_loops():
    rng = random.Random(6)
    words = [b"w%d" % i for i in range(40)]
    items = [[rng.choice(words[: rng.choice([3, 40])]) for _ in range(rng.randint(1, 60))] for _ in range(50)]
    counts = {w: rng.choice([0, 1, 10, 4000]) for w in words}
    index = dc.SeedIndex(list(enumerate(items)), {w: counts[w] for w in dict.fromkeys(w for ws in items for w in ws)}, sum(counts.values()), 90)
    got = {(k, j) for _, _, hits in index.tables.values() for k, j in hits.tolist()}
    assert got == plain_seeds(items, counts, sum(counts.values()), 90) and got


def test_five_million_item_words_are_one_block(spark):
    rng = np.random.default_rng(1)
    items = [(i, " ".join(f"w{x}" for x in rng.integers(0, 200_000, 500))) for i in range(10_000)]
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(8)
    docs = spark.createDataFrame([(7, "some words " + items[4321][1]), (8, "w1 w2 w3 none"), (9, items[5][1][:1800])], "doc_id long, text string")
    assert len(list(dc.item_blocks(bench))) == 1
    assert {(r.doc_id, r.item_id) for r in dc.contaminated_pairs(docs, bench).collect()} == {(7, 4321), (9, 5)}
