"""Importance resampling against DuckDB, the radix sort against Python's sort."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from ferrywright.llm import common, importance


def oracle(docs, target):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar)")
    con.execute("create table benchmark (item_id bigint, text varchar)")
    for name, rows in (("documents", docs), ("benchmark", target)):
        if rows:
            con.executemany(f"insert into {name} values (?, ?)", rows)
    return sorted(con.execute(importance.ORACLE_SQL).fetchall(), key=str)


def frames(spark, docs, target):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(target, "item_id long, text string")


def test_table(spark, data):
    docs, target = common.table(spark, data, "documents"), common.table(spark, data, "benchmark")
    got = sorted(map(tuple, importance.resample(docs, target).collect()), key=str)
    assert got == oracle([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in target.collect()])
    drawn = importance.draw_documents(docs, target)
    assert drawn.columns == docs.columns and {r.doc_id for r in drawn.collect()} == {r[0] for r in got if r[4]}


def test_edge_rows(spark):
    rnd = random.Random(5)
    words = ["Aé", "b1", "C", "日本", "x_y", "d-e", "ÀÉ"]
    docs = [(i - 50, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 40)))) for i in range(120)] + [(1000, None), (1001, ""), (1 << 62, "w " * 30000), (2000, "same word " * 15), (2001, "same word " * 15)]
    target = [(1, "日本 b1 b1"), (2, None), (None, "C d e")]
    a, b = frames(spark, docs, target)
    got = sorted(map(tuple, importance.resample(a.withColumns({"score": F.lit(1), "rank": F.lit("x")}), b).collect()), key=str)
    assert got == oracle(docs, target)
    assert importance.resample(a.limit(0), b).collect() == []
    assert sorted(map(tuple, importance.resample(a, b.limit(0)).collect()), key=str) == oracle(docs, [])


def test_repeated_rows_and_missing_ids(spark):
    a, b = frames(spark, [(None, "one two " * 12)] * 6 + [(-(1 << 63), "one two " * 12)] * 5 + [((1 << 63) - 1, "one " * 25)] * 3, [(1, "one")])
    got = importance.resample(a, b, percent=100).collect()
    assert sorted(r["rank"] for r in got) == list(range(1, 15))
    by_score = sorted(got, key=lambda r: (-r.score, r.doc_id is None, r.doc_id or 0))
    assert [r["rank"] for r in sorted(got, key=lambda r: r["rank"])] == list(range(1, 15))
    assert [(r.score, r.doc_id) for r in by_score] == [(r.score, r.doc_id) for r in sorted(got, key=lambda r: r["rank"])]
    assert importance.draw_documents(a, b, percent=50).count() == 7


@pytest.mark.parametrize("blocks", [1, 7, 64])
def test_radix_sort_is_stable_in_blocks(spark, blocks):
    rnd = random.Random(blocks)
    rows = [(rnd.choice([0, 3, 1 << 40, (1 << 63) - 1]) if i % 3 else 3, rnd.choice([-1, 0, 5, 5000]), i) for i in range(700)]
    df = spark.createDataFrame(rows, "a long, b long, i long").repartition(5)
    got = importance.radix_sort(df, ["a", "b"], "place", blocks).collect()
    assert sorted(r.place for r in got) == list(range(700))
    unsigned = lambda v: v % (1 << 64)
    keys = [(unsigned(r.a), unsigned(r.b)) for r in sorted(got, key=lambda r: r.place)]
    assert keys == sorted(keys)
