"""The mix against DuckDB's window functions, and its bounds."""

import re
from collections import defaultdict

import duckdb

from ferrywright.llm import common, mixing


def oracle(rows):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, source varchar)")
    if rows:
        con.executemany("insert into documents values (?, ?, ?)", rows)
    return sorted(con.execute(mixing.ORACLE_SQL).fetchall(), key=str)


def check_bounds(rows, got):
    words = {d: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t, _ in rows}
    source = {d: s for d, _, s in rows}
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for d, size, _, goal, took in got:
        assert size == words[d] and took <= 2 * size and (size == 0 or took % size == 0)
        taken[source[d]] += took
        target[source[d]] = goal
        largest[source[d]] = max(largest[source[d]], size)
    for s in taken:
        assert abs(taken[s] - target[s]) <= largest[s] + 1


def test_table(spark, data):
    docs = common.table(spark, data, "documents")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    got = sorted(map(tuple, mixing.mix_sizes(docs).collect()), key=str)
    assert got == oracle(rows)
    check_bounds(rows, got)
    assert got == sorted(map(tuple, mixing.mix_sizes(docs.repartition(7)).collect()), key=str)


def test_edge_rows(spark):
    rows = [(i, "w " * (i % 17), ["a", "b", None, "é", "z"][i % 5] if i % 3 else "a") for i in range(300)] + [(None, None, None), (1000, "", "empty"), (2000, "x " * 30000, "long"), (2001, "y", "Long")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, size int, target int")
    got = sorted(map(tuple, mixing.mix_sizes(docs).collect()), key=str)
    assert got == oracle(rows)
    check_bounds(rows, got)
    assert mixing.mix_sizes(docs.limit(0)).collect() == []
    words = sum(r[4] for r in got)
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    assert sum(len((r.text or "").split()) for r in out.collect()) == words


def test_repeated_rows_and_no_words(spark):
    docs = spark.createDataFrame([(1, "a b", "s")] * 10 + [(1, None, "t")] * 3, "doc_id long, text string, source string")
    got = mixing.mix_sizes(docs).collect()
    assert len(got) == 13 and sum(r.taken for r in got) == 30
    none = spark.createDataFrame([(1, None, None), (2, " ", "t")], "doc_id long, text string, source string")
    assert [(r.target, r.taken) for r in mixing.mix_sizes(none).collect()] == [(0.0, 0)] * 2
