"""Operators with a mechanism of their own, against plain computations."""

import datetime as dt
import decimal
import math
import random
import statistics
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ferrywright.functions import mysql, tsql
from ferrywright.operators import geometry, graphs, percentiles, relational, selection, textsearch, validation
from ferrywright.sources import readers
from ferrywright.streaming import upserts

ROW = "k long, v string, t long, gone boolean"


def plain_upserts(batches):
    held = {}
    for rows in batches:
        for k, v, t, gone in rows:
            if k not in held or t >= held[k][1]:
                held[k] = (v, t, gone)
    return {(k, v) for k, (v, t, gone) in held.items() if not gone}


def live(spark, root, schema):
    return {(r.k, r.v) for r in upserts.live_rows(upserts.read_upserts(spark, root, schema), "gone").collect()}


def test_upserts_replay_and_killed_batch(spark, tmp_path):
    rnd, root = random.Random(1), str(tmp_path / "t")
    batches = [[(rnd.choice([*range(40), None]), f"{b}-{i}", 1000 * rnd.randint(0, 3) + 50 * b + i, rnd.random() < 0.2) for i in range(30)] for b in range(5)]
    frames = [spark.createDataFrame(rows, ROW) for rows in batches]
    schema = frames[0].schema
    assert live(spark, root, schema) == set()
    for number, df in enumerate(frames):
        if number == 2:
            # A batch that was killed after its files and before its manifest.
            df.withColumn("b", F.lit(0)).limit(3).write.partitionBy("b").parquet(f"{root}/data/v=2")
            (tmp_path / "t/manifest/v=2").mkdir()
            assert live(spark, root, schema) == plain_upserts(batches[:2])
        assert upserts.upsert_batch(df, root, number, ["k"], "t", 8) > 0
        assert upserts.upsert_batch(df, root, number, ["k"], "t", 8) == 0
        assert live(spark, root, schema) == plain_upserts(batches[: number + 1])
    assert upserts.committed(spark, root) == [3, 4]
    named = {x for b in (3, 4) for x in upserts.manifest(spark, root, b).items()}
    there = {(int(p.name[2:]), int(p.parent.name[2:])) for p in (tmp_path / "t/data").glob("v=*/b=*")}
    assert there == named


def test_a_small_batch_writes_few_buckets(spark, tmp_path):
    root = str(tmp_path / "t")
    rows = spark.range(10000).select(F.col("id").alias("k"), F.lit("a").alias("v"), F.lit(0).cast("long").alias("t"), F.lit(False).alias("gone"))
    assert upserts.upsert_batch(rows, root, 0, ["k"], "t", 100, "floor(k / 100)") == 100
    some = rows.where("k between 4200 and 4299").withColumns({"v": F.lit("b"), "t": F.lit(1).cast("long")})
    assert upserts.upsert_batch(some, root, 1, ["k"], "t", 100, "floor(k / 100)") == 1
    assert len(list((tmp_path / "t/data/v=1").glob("b=*"))) == 1
    found = upserts.read_upserts(spark, root, rows.schema)
    assert found.count() == 10000 and found.where("v = 'b'").count() == 100
    assert upserts.read_upserts(spark, root, rows.schema, 0).where("v = 'b'").count() == 0


def test_stream_upserts(spark, tmp_path):
    src, root = str(tmp_path / "in"), str(tmp_path / "out")
    run = lambda: upserts.stream_upserts(spark.readStream.schema(ROW).parquet(src), root, ["k"], "t", str(tmp_path / "cp"), buckets=4).awaitTermination()
    batches = [[(1, "a", 1, False), (2, "b", 5, False), (1, "c", 3, False)], [(2, "late", 4, False), (3, "d", 1, False), (1, None, 9, True)]]
    for rows in batches:
        spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").parquet(src)
        run()
    assert live(spark, root, spark.createDataFrame([], ROW).schema) == plain_upserts(batches) == {(2, "b"), (3, "d")}


def brute_components(edges):
    nodes = {x for e in edges for x in e if x is not None}
    near = {n: {b for a, b in edges if a == n and b is not None} for n in nodes}

    def reach(n):
        seen, todo = set(), [n]
        while todo:
            for m in near[todo.pop()]:
                if m not in seen:
                    seen.add(m)
                    todo.append(m)
        return seen

    reached = {n: reach(n) for n in nodes}
    own = {n: frozenset({n} | {m for m in reached[n] if n in reached[m]}) for n in nodes}
    levels = {}

    def level(c):
        if c not in levels:
            below = {own[m] for n in c for m in near[n]} - {c}
            levels[c] = 1 + max(map(level, below)) if below else 0
        return levels[c]

    return {n: (min(own[n]), len(own[n]), n in near[n], level(own[n])) for n in nodes}


@pytest.mark.parametrize("seed", range(3))
def test_load_order_with_cycles(spark, seed):
    rnd = random.Random(seed)
    edges = [(f"t{rnd.randint(0, 14)}", f"t{rnd.randint(0, 14)}") for _ in range(14 + 4 * seed)] + [("t1", "t1"), ("t20", "t21"), ("t21", "t20"), ("t20", None), (None, "t22")] * 2
    got = {r.name: (r.component, r.size, r.self_reference, r.level) for r in graphs.load_order(spark.createDataFrame(edges, "name string, referenced_name string")).collect()}
    assert got == brute_components([e for e in edges if e[0] is not None] + [("t22", None)])
    assert graphs.load_order(spark.createDataFrame([], "name string, referenced_name string")).collect() == []


def test_digest_tree(spark):
    rows = spark.range(20000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, F.col("id") % 50).alias("a"), F.when(F.col("id") % 3 == 1, F.col("id") % 50).alias("b"))
    moved = rows.withColumns({"a": F.when(F.col("k").isin(300, 603), F.col("b")).otherwise(F.col("a")), "b": F.when(F.col("k").isin(300, 603), F.col("a")).otherwise(F.col("b"))})
    new = moved.where("k <> 77").unionByName(rows.where("k = 5"))
    key = lambda df: sorted(map(str, df.collect()))
    assert key(validation.test_data_tree(rows, new, ["k"])) == key(validation.test_data(rows, new, ["k"], 0, 0))
    assert key(validation.test_data_unordered_tree(rows, new)) == key(validation.test_data_unordered(rows, new))
    left, right = validation.narrow_to_differences(rows, new, ["k"])
    assert left.count() < 50 and right.count() < 50
    same = validation.narrow_to_differences(rows, rows.repartition(7))
    assert same[0].count() == same[1].count() == 0
    assert validation.test_data_unordered_tree(rows, rows.withColumn("a", F.col("k"))).count() == 40000 - rows.where("a = k").count() * 2


def boxes(rnd, n):
    out = []
    for i in range(n):
        w = rnd.choice([0, 0.5, 1, 3, 40, 1000])
        x, y = rnd.randint(-20, 60) / 2, rnd.randint(-20, 60) / 2
        out.append((i, x, y, x + w, y + rnd.choice([0, w, 2])))
    return out


@pytest.mark.parametrize("predicate", ["contains", "within", "equal", "intersects", "overlaps", "touches"])
def test_boxes_of_all_sizes(spark, predicate):
    rnd = random.Random(predicate)
    a, b = boxes(rnd, 60), boxes(rnd, 50)
    fa, fb = (spark.createDataFrame([*x, (99, None, 1.0, 2.0, 3.0)], "id long, x0 double, y0 double, x1 double, y1 double") for x in (a, b))

    def test(p, q):
        meet = p[1] <= q[3] and q[1] <= p[3] and p[2] <= q[4] and q[2] <= p[4]
        inner = p[1] < q[3] and q[1] < p[3] and p[2] < q[4] and q[2] < p[4]
        has = p[1] <= q[1] and p[3] >= q[3] and p[2] <= q[2] and p[4] >= q[4]
        within = q[1] <= p[1] and q[3] >= p[3] and q[2] <= p[2] and q[4] >= p[4]
        return {"contains": has, "within": within, "equal": has and within, "intersects": meet, "disjoint": not meet, "overlaps": inner and not has and not within, "touches": meet and not inner}

    want = sorted((p[0], q[0]) for p in a for q in b if test(p, q)[predicate])
    assert sorted(map(tuple, geometry.mbr_join(fa, fb, predicate, 1.0).collect())) == want
    if predicate == "touches":
        apart = sorted((p[0], q[0]) for p in a[:9] for q in b if test(p, q)["disjoint"])
        assert sorted(map(tuple, geometry.mbr_disjoint(fa.where("id < 9"), fb, block=4).where("b_id < 99").collect())) == apart


def test_a_box_over_the_map_has_few_cells(spark):
    small = spark.range(100000).select("id", (F.col("id") % 1000).cast("double").alias("x0"), (F.col("id") % 997).cast("double").alias("y0")).withColumns({"x1": F.col("x0") + 0.5, "y1": F.col("y0") + 0.5})
    whole = spark.createDataFrame([(0, -1e9, -1e9, 1e9, 1e9)], "id long, x0 double, y0 double, x1 double, y1 double")
    assert geometry.mbr_join(whole, small, "contains", 1.0).count() == 100000
    assert geometry._cells(geometry._levels(whole, 1.0), 1.0, [0], "w").count() <= 4


def test_points_in_a_large_polygon(spark):
    rnd = random.Random(4)
    shape = [(1000 * math.cos(2 * math.pi * i / 300) * (1 + 0.3 * (i % 2)), 1000 * math.sin(2 * math.pi * i / 300) * (1 + 0.3 * (i % 2))) for i in range(300)]
    rings = [(1, 1, i + 1, x, y) for i, (x, y) in enumerate([*shape, shape[0]])] + [(2, 1, i + 1, x, y) for i, (x, y) in enumerate([(0.0, 0.0), (3.0, 0.0), (3.0, 2000.0), (0.0, 2000.0), (0.0, 0.0)])]
    dots = [(i, rnd.uniform(-1400, 1400), rnd.uniform(-1400, 1400)) for i in range(300)] + [(500 + i, 1.5, 10.0 * i) for i in range(220)]

    def inside(x, y, ring):
        hit = False
        for (_, _, _, ax, ay), (_, _, _, bx, by) in zip(ring, ring[1:], strict=False):
            if (ay > y) != (by > y) and x < (bx - ax) * (y - ay) / (by - ay) + ax:
                hit = not hit
        return hit

    want = sorted((i, p) for i, x, y in dots for p in (1, 2) if inside(x, y, [r for r in rings if r[0] == p]))
    got = geometry.points_in_polygons(spark.createDataFrame(dots, "id long, x double, y double"), spark.createDataFrame(rings, "id long, elem int, pos int, x double, y double"), 1.0)
    assert sorted(map(tuple, got.collect())) == want


def test_percentiles_of_hot_groups(spark):
    rnd = random.Random(3)
    groups = {"hot": [rnd.choice([0.0, -1.5, 7.25, 1e-300, 1e300, -1e308, rnd.gauss(0, 1)]) for _ in range(3001)], "even": [float(x % 17) for x in range(400)], "one": [2.5], None: [1.0, 2.0], "ties": [4.0] * 99}
    rows = [(k, v) for k, vs in groups.items() for v in vs] + [("hot", None), ("none", None), ("hot", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    got = {r.g: r.value for r in percentiles.group_median(df, ["g"], "v").collect()}
    assert got == {k: statistics.median(vs) for k, vs in groups.items()}
    ends = percentiles.group_percentiles(df, [], "v", (0.0, 1.0, 0.1)).collect()
    whole = sorted(v for vs in groups.values() for v in vs)
    at = 0.1 * (len(whole) - 1)
    low, high = whole[math.floor(at)], whole[math.ceil(at)]
    assert {r.fraction: r.value for r in ends} == {0.0: whole[0], 1.0: whole[-1], 0.1: pytest.approx(low + (high - low) * (at - math.floor(at)))}


def test_match_against(spark):
    docs = {1: "The red bridge over the river", 2: "red river, red bridge", 3: "Bridge of stone", 4: "été: summer's bridges", 5: "", 6: None}
    index = textsearch.position_index(spark.createDataFrame(list(docs.items()), "id long, t string"), "id", ["t"])
    held = {i: Counter(w for w in "".join(c if c.isalnum() else " " for c in (t or "").lower().replace("é", "e")).split()) for i, t in docs.items()}

    def weight(i, w):
        n = sum(1 for c in held.values() if c[w])
        return held[i][w] * math.log10(len(docs) / n) ** 2 if n else 0.0

    got = {r.id: r["rank"] for r in textsearch.match_natural(index, "Red, BRIDGE!", len(docs)).collect()}
    assert got == {i: pytest.approx(weight(i, "red") + weight(i, "bridge")) for i in (1, 2, 3)}
    ids = lambda q: {r.id for r in textsearch.match_boolean(index, q, len(docs)).collect()}
    assert ids("+bridge -river") == {3} and ids('"red bridge"') == {1, 2} and ids('+red +"river red"') == {2} and ids("bridge*") == {1, 2, 3, 4}
    assert ids("-red") == set() and ids("") == set() and ids("+ete") == {4} and ids("stone ete") == {3, 4} and ids("+summer's") == {4} and ids('-"red bridge" bridge*') == {3, 4}
    ranked = {r.id: r["rank"] for r in textsearch.match_boolean(index, "+red stone river", len(docs)).collect()}
    assert ranked == {i: pytest.approx(weight(i, "red") + weight(i, "river")) for i in (1, 2)}


def test_load_many_keeps_properties_and_pools(spark):
    context = spark.sparkContext
    context.setLocalProperty("spark.job.description", "outer")
    act = lambda n, df: (df.count(), context.getLocalProperty("spark.scheduler.pool"), context.getLocalProperty("spark.job.description"))
    got = readers.load_many({n: (lambda k=k: spark.range(k)) for n, k in (("a", 3), ("b", 5))}, act)
    context.setLocalProperty("spark.job.description", None)
    assert got == {"a": (3, "table-a", "outer"), "b": (5, "table-b", "outer")} and context.getLocalProperty("spark.scheduler.pool") is None
    with pytest.raises(ZeroDivisionError):
        readers.load_many({"a": lambda: spark.range(1)}, lambda n, df: 1 / 0)


def test_a_misspelt_filter_is_an_error(spark):
    tables = {"a": spark.range(10).toDF("n_key"), "b": spark.range(10).toDF("other")}
    assert {n: df.count() for n, df in selection.where_clauses(tables, everywhere="n_key > 4").items()} == {"a": 5, "b": 10}
    with pytest.raises(Exception, match="n_kye"):
        selection.where_clauses(tables, everywhere="n_kye > 4")
    with pytest.raises(ValueError, match="no table"):
        selection.where_clauses(tables, everywhere="n_key > 4 and other > 2")


def test_truncate_and_styles(spark):
    cents = spark.range(-2000, 2000).select((F.col("id") / 100).alias("x"), (F.col("id").cast("decimal(12,2)") / 100).cast("decimal(12,2)").alias("d"))
    rows = cents.select("x", mysql.truncate(F.col("x"), 2).alias("two"), mysql.truncate(F.col("d"), 1).alias("one"), mysql.truncate(F.col("x"), -1).alias("tens")).collect()
    assert all(r.two == r.x for r in rows) and all(isinstance(r.one, decimal.Decimal) for r in rows)
    assert all(float(r.one) == math.trunc(round(r.x * 100)) // 10 / 10 if r.x >= 0 else float(r.one) == -(round(-r.x * 100) // 10) / 10 for r in rows)
    assert all(r.tens == math.trunc(r.x / 10) * 10 for r in rows)
    odd = spark.createDataFrame([(1e25,), (float("nan"),), (1.5e-7,), (None,), (-0.29,)], "x double").select(mysql.truncate(F.col("x"), 2).alias("v")).collect()
    assert odd[0].v == 1e25 and math.isnan(odd[1].v) and odd[2].v == 0 and odd[3].v is None and odd[4].v == -0.29
    d = spark.createDataFrame([(dt.datetime(2024, 3, 5, 13, 4, 5),)], "d timestamp")
    styles = {1: "03/05/24", 2: "24.03.05", 6: "05 Mar 24", 12: "240305", 101: "03/05/2024", 20: "2024-03-05 13:04:05", 8: "13:04:05"}
    assert d.select(*[tsql.convert("varchar", F.col("d"), s).alias(str(s)) for s in styles]).first().asDict() == {str(k): v for k, v in styles.items()}


def test_named_binary_files_alone_are_read(spark, tmp_path):
    for n in range(6):
        (tmp_path / f"f{n}.bin").write_bytes(b"x" * n)
    names = spark.createDataFrame([(f"f{n}.bin",) for n in (1, 3, 3, 9)], "p string")
    got = readers.resolve_bfile(names, "p", "content", str(tmp_path))
    assert sorted(len(r.p) if r.p is not None else -1 for r in got.collect()) == [-1, 1, 3, 3]
    assert sum("f2.bin" in f for f in got.inputFiles()) == 0
    assert readers.resolve_bfile(names.where("p = 'f9.bin'"), "p", "content", str(tmp_path)).first().p is None


def test_rownum_of_an_order_of_few_values(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), "id")
    got = relational.with_rownum(df, [F.col("g")]).collect()
    assert sorted(r.rownum for r in got) == list(range(1, 5001)) and all(r.g == (r.rownum > 2500) for r in got)


def test_every_rule_has_an_example():
    from ferrywright.plans import assessment, queries_counters

    for dialect, (rules, functions) in assessment.DIALECTS.items():
        met = {k for _, counts in queries_counters.examples(dialect) for k in counts}
        assert met == {k for k, w, _ in rules if w} | {f for f, _, _ in functions}


@pytest.mark.parametrize("dialect", ["oracle", "mysql", "tsql"])
def test_a_package_of_a_megabyte(spark, dialect):
    import time

    from ferrywright.plans import assessment

    line = "SELECT a, b FROM t WHERE EXEC CONTAINS(x) SCORE(y) MATCH near fuzzy at_ TABLES from u, v into w, sp and exec\n"
    code = spark.createDataFrame([("d", "FUNCTION", "f", line * (1_000_000 // len(line)))], "db string, object_type string, name string, code string")
    spark.range(10).count()
    began = time.time()
    found = {r.keyword: r.n for r in assessment.score_details(code, dialect).collect()}
    assert time.time() - began < 30
    if dialect == "oracle":
        n = 1_000_000 // len(line)
        assert found["CONTAINS"] == n and found["SCORE"] == 1 and "FUZZY" not in found and "DBLINK" not in found and "TABLE" not in found


def test_something_ahead_is_counted_as_the_pattern_does(spark):
    import re

    from ferrywright.plans import assessment

    rnd = random.Random(7)
    words = ["FROM", " ", ";", "TABLE (", "xTABLE(", " WHERE ", "EXEC", "a@b", "@", "SCORE(", "CONTAINS(", "FUZZY(", "NEAR(", "\n", "MATCH", "AGAINST", ".SP_A", " SP_", "x"]
    texts = ["".join(rnd.choice(words) for _ in range(rnd.randint(0, 25))) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    counts = {p: assessment._count_ahead(F.col("t"), F.upper("t"), p) for p in assessment.AHEAD}
    rows = df.select("i", *[c.alias(str(k)) for k, c in enumerate(counts.values())]).collect()
    for r in rows:
        for k, pattern in enumerate(counts):
            assert r[str(k)] == len(re.findall(f"(?is){pattern}", texts[r.i])), (pattern, texts[r.i])


def test_large_objects_in_chunks(spark):
    import hashlib

    from ferrywright.sources import writers

    sizes = {1: 1, 2: 4095, 3: 4096, 4: 4097, 5: 5_000_000, 6: 200_000_000, 7: 0}
    rows = spark.createDataFrame([*sizes.items(), (8, None)], "id long, n int")
    value = F.encode(F.substring(F.repeat(F.lit("abcdefg"), F.ceil(F.col("n") / 7).cast("int")), 1, F.col("n")), "UTF-8")
    for size in (4096, 4 << 20):
        some = rows if size > 4096 else rows.where("n < 10000000 or n is null")
        chunks = writers.to_chunks(some.repartition(4).select("id", value.alias("v")), ["id"], "v", size)
        got = {r.id: (r.n_bytes, r.sha256) for r in writers.digest_chunks(chunks, ["id"]).collect()}
        assert got == {r.id: (r.n, hashlib.sha256((b"abcdefg" * (r.n // 7 + 1))[: r.n]).hexdigest()) if r.n is not None else (None, None) for r in some.collect()}
        assert chunks.agg(F.max("n_bytes")).first()[0] <= size
    wanted = spark.createDataFrame([(5, 4_999_990, 100), (4, 4090, 4), (3, 5000, 10), (9, 0, 5)], "id long, offset int, length int")
    parts = writers.read_ranges(writers.to_chunks(rows.where("n < 10000000").select("id", value.alias("v")), ["id"], "v", 4096), wanted, ["id"]).collect()
    whole = b"abcdefg" * 800_000
    assert {r.id: bytes(r.part) for r in parts} == {5: whole[4_999_990:5_000_000], 4: whole[4090:4094]}
