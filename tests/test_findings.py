"""Inputs on which queries once failed or differed from their SQL."""

import duckdb
from pyspark.sql import functions as F

from ferrywright.operators import geometry, textsearch
from ferrywright.plans import registry


def against_sql(spark, tmp_path, name, **tables):
    """The rows of a query over small tables, and those of its SQL."""
    con = duckdb.connect()
    for table, df in tables.items():
        df.coalesce(1).write.parquet(f"{tmp_path}/{table}.parquet")
        con.execute(f"create view {table} as select * from '{tmp_path}/{table}.parquet/*.parquet'")
    df = registry.queries()[name](spark, str(tmp_path))
    cursor = con.execute(registry.oracle_sql()[name])
    assert [d[0] for d in cursor.description] == df.columns
    return sorted(map(tuple, df.collect()), key=str), sorted(cursor.fetchall(), key=str)


def test_pieces_behind_the_end_of_short_texts(spark, tmp_path):
    texts = ["", "a", "ab", "abc", "a\n", "the thing is ringing", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got, want = against_sql(spark, tmp_path, "o_regexps", documents=docs)
    assert got == want and [r[-1] for r in got] == ["", "", "", "c", "", "e thi", None]


def test_recursion_is_bounded_by_levels_and_not_by_rows(spark, tmp_path):
    spark.conf.set("spark.sql.cteRecursionRowLimit", "500")
    try:
        got, want = against_sql(spark, tmp_path, "h9_recursive_tree", part=spark.range(3000).toDF("p_partkey"))
        assert spark.conf.get("spark.sql.cteRecursionRowLimit") == "500"
    finally:
        spark.conf.unset("spark.sql.cteRecursionRowLimit")
    assert got == want and len(got) == 3000


def test_ties_and_nulls_of_the_windowed_keep(spark, tmp_path):
    prices = [5.0, 3.0, 3.0, 9.0, 9.0, None, 3.0, 9.0]
    rows = [(k, k // 8, p) for k, p in enumerate(prices)] + [(8, 1, None), (9, 2, 1.0), (10, 2, None), (11, 3, float("nan")), (12, 3, 2.0)]
    schema = "o_orderkey long, o_custkey long, o_totalprice double"
    for some in (rows, rows[::-1]):
        got = registry.queries()["w2_keep_over"](spark, frame_at(spark, tmp_path, "orders", spark.createDataFrame(some, schema).coalesce(1)))
        assert {r.o_orderkey: (r.cheapest, r.dearest) for r in got.collect()} == dict.fromkeys(range(8), (1, 3)) | {8: (8, 8), 9: (9, 9), 10: (9, 9), 11: (12, 11), 12: (12, 11)}
    plain = spark.createDataFrame([r for r in rows if r[0] not in (2, 4, 6, 7)], schema)
    got, want = against_sql(spark, tmp_path / "plain", "w2_keep_over", orders=plain)
    assert got == want


def frame_at(spark, tmp_path, name, df):
    """A fresh folder with one table."""
    import uuid

    path = f"{tmp_path}/{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{name}.parquet")
    return path


def test_addresses_that_differ_in_a_number_are_parted_before_the_shuffle(spark, tmp_path):
    pages = spark.range(900).select(F.col("id").alias("page_id"), F.concat(F.lit("https://one.example.net/en/"), F.pmod(F.xxhash64("id"), F.lit(900000)) + 100000, F.lit("?utm_source=feed")).alias("url"))
    got, want = against_sql(spark, tmp_path, "t3_trigram_join", pages=pages)
    assert got == want and len(got) >= 900
    texts = pages.select(F.col("url").alias("text"), textsearch.trigrams(F.col("url")).alias("grams"))
    sides = [texts.select(F.col("text").alias(f"{k}_text"), F.size("grams").alias(f"{k}_n"), F.explode("grams").alias("g")) for k in "ab"]
    assert len(got) <= textsearch.trigram_candidates(*sides, 0.8).count() < 5.5 * len(got)


def test_boxes_in_many_copies_are_counted_without_pairs_of_rows(spark, tmp_path):
    customers, suppliers = spark.range(40000).select((F.col("id") % 10).alias("c_custkey")), spark.range(20000).select((F.col("id") % 4).alias("s_suppkey"))
    path = frame_at(spark, tmp_path, "customer", customers)
    suppliers.write.parquet(f"{path}/supplier.parquet")
    df = registry.queries()["g7_box_levels"](spark, path)
    want = duckdb.connect()
    for name in ("customer", "supplier"):
        want.execute(f"create view {name} as select * from '{path}/{name}.parquet/*.parquet'")
    assert sorted(map(tuple, df.collect())) == sorted(want.execute(registry.oracle_sql()["g7_box_levels"]).fetchall())
    # Of 40000 rows 10 boxes are left, and no join has more rows than these make with the others.
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "copies" in plan
    schema = "id long, x0 double, y0 double, x1 double, y1 double"
    a = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0), (2, 0.0, 0.0, 1.0, 1.0), (3, None, 0.0, 1.0, 1.0), (4, 2.0, 2.0, 3.0, 3.0)], schema)
    b = spark.createDataFrame([(7, 0.5, 0.5, 2.5, 2.5), (7, -0.0, 0.0, 1.0, 1.0), (8, 0.5, 0.5, 2.5, 2.5), (9, 8.0, 8.0, 9.0, 9.0), (None, 2.0, 2.0, 3.0, 3.0)], schema)
    for predicate in ("intersects", "equal", "contains", "within", "touches", "overlaps"):
        pairs = geometry.mbr_join(a, b, predicate, 1.0).groupBy("b_id").agg(F.count(F.lit(1)).alias("n"))
        assert sorted(map(tuple, geometry.mbr_counts(a, b, predicate, 1.0).collect()), key=str) == sorted(map(tuple, pairs.collect()), key=str)


def test_points_and_polygons_in_many_copies_meet_once(spark, monkeypatch):
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (-0.0, 4.0), (0.0, 0.0)]
    round_one = [(2 + 3 * ((i % 90) - 45) / 45, (1 if i < 90 else -1) * 5.0 + 2) for i in range(0, 90)] + [(5.0, -3.0), (-1.0, -3.0), (-1.0, 7.0)]
    rings = [(k, 1, i + 1, x, y) for k in range(20) for i, (x, y) in enumerate(square)]
    rings += [(k, 1, i + 1, x + 0.5, y) for k in (50, 51) for i, (x, y) in enumerate(square)] + [(k, 1, i + 1, x, y) for k in (60, 61) for i, (x, y) in enumerate(round_one)]
    # The same outline with a hole is another shape.
    rings += [(70, e, i + 1, x / e**2 + (e - 1), y / e**2 + (e - 1)) for e in (1, 2) for i, (x, y) in enumerate(square)]
    dots = [(i, 1.5, 1.5) for i in range(30)] + [(100, 0.25, 1.0), (101, -0.0, 9.0), (102, None, 1.0), (103, -0.5, 1.0), (104, 4.25, 2.0), (104, 4.25, 2.0)]
    met, pairs = [], geometry._box_pairs
    monkeypatch.setattr(geometry, "_box_pairs", lambda a, b, size: met.append((a.count(), b.count())) or pairs(a, b, size))
    got = geometry.points_in_polygons(spark.createDataFrame(dots, "id long, x double, y double"), spark.createDataFrame(rings, "id long, elem int, pos int, x double, y double"), 1.0)
    want = [(i, k) for i in range(30) for k in (*range(20), 50, 51, 60, 61)] + [(100, k) for k in (*range(20), 60, 61, 70)] + [(103, 60), (103, 61)] + [(104, k) for k in (50, 51, 60, 61)] * 2
    assert sorted(map(tuple, got.collect())) == sorted(want)
    # Places, and shapes: three and the two large ones.
    assert met == [(6, 5)]
