"""The filter audit against DuckDB and against filters applied one after another."""

import random
from itertools import permutations

import duckdb
import numpy as np
from pyspark.sql import functions as F

from ferrywright.llm import audit, common

COLUMNS = [c.split()[0] for c in audit.AUDIT.split(", ")]


def oracle(docs, labels):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar)")
    con.execute("create table labels (doc_id bigint, quality int, toxic int)")
    for name, rows in (("documents", docs), ("labels", labels)):
        if rows:
            con.executemany(f"insert into {name} values (?, ?, ?)", rows)
    return sorted(con.execute(audit.ORACLE_SQL).fetchall())


def rows_of(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()))


def test_table(spark, data):
    docs, labels = common.table(spark, data, "documents"), common.table(spark, data, "labels")
    got = rows_of(audit.audit_filters(docs, labels))
    assert got == oracle([(r.doc_id, r.text, r.lang) for r in docs.collect()], [(r.doc_id, r.quality, r.toxic) for r in labels.collect()])


def test_edge_rows(spark):
    rnd = random.Random(3)
    texts = [None, "", "ABC def", "a " * 200, " ".join(map(str, range(150))), "é" * 50 + "ABCDE F", "x | y", "ÀÉ z " + " ".join(map(str, range(120))), "w%d " * 40000]
    docs = [(i, rnd.choice(texts), rnd.choice(["en", None, "", "fr"])) for i in range(150)] + [(7, "a " * 200, "en")] * 3 + [(None, "only here", "de"), (None, "a " * 200, "de")]
    labels = [(i % 60, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for i in range(90)] + [(None, 1, 1)]
    a = spark.createDataFrame(docs, "doc_id long, text string, lang string").withColumns({"n": F.lit(1), "part": F.lit("x")})
    b = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("first", F.lit(2))
    assert rows_of(audit.audit_filters(a, b)) == oracle(docs, labels)
    assert rows_of(audit.audit_filters(a, b.limit(0))) == oracle(docs, [])
    assert rows_of(audit.audit_filters(a.limit(0), b)) == []


def test_contractions_against_filters_in_turn():
    rnd = np.random.default_rng(1)
    counts = rnd.integers(0, 9, (3, 2, 2, 2, 2, 2))
    patterns = [(p, counts[(slice(None), *p)].tolist()) for p in np.ndindex(2, 2, 2, 2, 2)]
    got = {(o, s): rest for o, s, *rest in audit.contract_orders(counts)}
    assert len(got) == 600
    shares = dict.fromkeys("ABCDE", 0)
    for order in map("".join, permutations("ABCDE")):
        left = patterns
        for step, f in enumerate(order, 1):
            at = "ABCDE".index(f)
            gone = [x for x in left if x[0][at]]
            left = [x for x in left if not x[0][at]]
            total = lambda rows, i=0: sum(n[i] for _, n in rows)
            shares[f] += total(gone)
            alone = [x for x in patterns if x[0][at] and sum(x[0]) == 1]
            failing = [x for x in patterns if x[0][at]]
            assert got[order, step][:6] == [total(left), total(gone), total(failing) - total(gone), total(alone), total(gone, 1), total(gone, 2)]
    assert all(rest[6] == shares[o[s - 1]] for (o, s), rest in got.items())
