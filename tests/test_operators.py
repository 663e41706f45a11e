"""Operators beyond the registered queries, on small tables."""

import datetime as dt
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ferrywright.operators import diffing, geometry, hierarchy, partitioning, relational, selection, textsearch, validation
from ferrywright.plans import assessment
from ferrywright.sources import readers, writers
from ferrywright.streaming import cdc

EMPLOYEES = [(100, None, "King", 24000), (101, 100, "Kochhar", 17000), (102, 100, "De Haan", 17000), (108, 101, "Greenberg", 12000), (109, 108, "Faviet", 9000), (103, 102, "Hunold", 9000)]


def employees(spark):
    return spark.createDataFrame(EMPLOYEES, "employee_id int, manager_id int, last_name string, salary int")


def test_siblings_and_paths(spark):
    got = hierarchy.connect_by(employees(spark), "employee_id", "manager_id", F.col("manager_id").isNull(), path=("last_name", "/"), leading_sep=False, siblings=[F.col("last_name")]).collect()
    assert [r.last_name for r in got] == ["King", "De Haan", "Hunold", "Kochhar", "Greenberg", "Faviet"]
    assert got[5].path == "King/Kochhar/Greenberg/Faviet" and got[5].level == 4


def test_siblings_need_no_row_number_in_one_task(spark, monkeypatch):
    rng = random.Random(7)
    people = [(0, None, "top")] + [(i, 0 if i < 60 else rng.randrange(60), rng.choice("abc")) for i in range(1, 150)]
    plans, keep = [], hierarchy.checkpoint
    monkeypatch.setattr(hierarchy, "checkpoint", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or keep(df))
    frame = spark.createDataFrame(people, "id int, boss int, name string").repartition(5)

    def below(rows):
        for r in sorted(rows, key=lambda r: (-ord(r[2][0]), r[0])):
            yield r[0]
            yield from below([x for x in people if x[1] == r[0]])

    got = hierarchy.connect_by(frame, "id", "boss", frame["boss"].isNull(), siblings=[F.col("name").desc()]).collect()
    assert [r.id for r in got] == list(below(people[:1]))
    got = hierarchy.connect_by(frame, "id", "boss", siblings=[F.col("name").desc()]).collect()
    assert [r.id for r in got] == list(below(people))
    assert plans and not any("row_number" in p for p in plans)


def test_every_row_is_a_root_without_start(spark):
    assert hierarchy.connect_by(employees(spark), "employee_id", "manager_id").count() == 6 + 5 + 3 + 1


def test_cycles(spark):
    ring = spark.createDataFrame([(1, 3), (2, 1), (3, 2)], "id int, up int")
    got = hierarchy.connect_by(ring, "id", "up", F.col("id") == 1, nocycle=True).orderBy("level").collect()
    assert [(r.id, r.level, r.is_cycle) for r in got] == [(1, 1, 0), (2, 2, 0), (3, 3, 1)]
    with pytest.raises(ValueError):
        hierarchy.connect_by(ring, "id", "up", F.col("id") == 1, max_depth=5)
    with pytest.raises(ValueError):
        hierarchy.dependency_levels(ring.select(F.col("id").alias("name"), F.col("up").alias("referenced_name")), max_depth=5)


def test_fk_graph(spark):
    c = spark.createDataFrame([("lines", "R", "orders"), ("orders", "R", "customers"), ("orders", "P", None), ("orders", "R", "orders")], "table_name string, type string, r_table string")
    assert {(r.name, r.level) for r in hierarchy.dependency_levels(hierarchy.fk_edges(c)).collect()} == {("customers", 0), ("orders", 1), ("lines", 2)}


def test_recursive_cte(spark):
    assert hierarchy.recursive_cte(spark, "WITH RECURSIVE t(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM t WHERE n < 7) SELECT sum(n) AS s FROM t").first().s == 28


rows_of = st.lists(st.tuples(st.integers(0, 8), st.one_of(st.none(), st.integers(0, 3))), max_size=12)


@given(rows_of, rows_of)
@settings(max_examples=8, deadline=None)
def test_diff_then_apply_gives_the_new_table(spark, old, new):
    old, new = ({k: v for k, v in rows} for rows in (old, new))
    a, b = (spark.createDataFrame(list(d.items()), "k int, v int") for d in (old, new))
    diff = diffing.datadiff_by_key(a, b, ["k"])
    assert {(r.k, r.v) for r in diffing.apply_diff(a, diff, ["k"]).collect()} == set(new.items())
    gone, fresh = diffing.datadiff(a, b)
    assert gone.count() - fresh.count() == len(old) - len(new)


def test_diff_hooks(spark):
    a, b = spark.createDataFrame([(1, 1), (2, 2)], "k int, v int"), spark.createDataFrame([(2, 3), (4, 4)], "k int, v int")
    seen = []
    diffing.apply_diff(a, diffing.datadiff_by_key(a, b, ["k"]), ["k"], lambda t, d, u, i: seen.append((d.count(), u.count(), i.count())), lambda *x: seen.append("after"), lambda t: seen.append(t.count()))
    assert seen == [(1, 1, 1), "after", 2]


def test_split_predicates_are_a_partition(spark):
    df = spark.createDataFrame([(i,) for i in range(-20, 20)] + [(None,)], "k int")
    counts = [df.where(p).count() for p in readers.split_predicates("k", 4)]
    assert sum(counts) == 41
    whole = spark.createDataFrame([(i / 3,) for i in range(50)], "k double")
    assert sum(whole.where(p).count() for p in readers.split_predicates("k", 3, whole=False)) == 50


def test_routing_loses_no_row(spark):
    df = spark.createDataFrame([(None,), (1,), (10,), (99,), (100,), (1000,)], "v int")
    got = {r.v: r.partition_name for r in partitioning.range_partition(df, "t", ["v"], [[10], [100]]).collect()}
    assert got == {None: "t_part_default", 1: "t_part1", 10: "t_part2", 99: "t_part2", 100: "t_part_default", 1000: "t_part_default"}
    assert partitioning.range_partition(df, "t", ["v"], [[10], [None]]).where("partition_name = 't_part2'").count() == 5
    assert {r.v: r.partition_name for r in partitioning.list_partition(df, "t", "v", [[1, None], [10]]).collect()}[None] == "t_part1"
    assert partitioning.hash_partition(df, "t", ["v"], 3).where("partition_name rlike '^t_part[123]$'").count() == 6
    two = spark.createDataFrame([(1, 5), (2, 0), (2, 9)], "a int, b int")
    assert [r.partition_name for r in partitioning.range_partition(two, "t", ["a", "b"], [[1, 9], [2, 5]]).orderBy("a", "b").collect()] == ["t_part1", "t_part2", "t_part_default"]


def test_partition_folders(spark, tmp_path):
    df = partitioning.range_partition(spark.range(100).withColumnRenamed("id", "v"), "t", ["v"], [[10], [50]])
    partitioning.write_partitions(df, str(tmp_path / "p"))
    back = spark.read.parquet(str(tmp_path / "p"))
    assert readers.read_partitions(back, ["T_PART[12]"], ["t_part2"]).count() == 10 and partitioning.merge_partitions(back).count() == 100
    parts = spark.createDataFrame([("a", "RANGE", 1), ("a", "RANGE", 2), ("b", "HASH", 1)], "table_name string, method string, position int")
    assert {(r.method, r.table_name, r.n_parts) for r in partitioning.partition_counts(parts).where("table_name is not null").collect()} == {("RANGE", "a", 2), ("HASH", "b", 1)}


def test_rownum_over_many_partitions(spark):
    rows = list(range(500))
    random.Random(1).shuffle(rows)
    df = relational.with_rownum(spark.createDataFrame([(v,) for v in rows], "v int").repartition(7), [F.col("v").desc()])
    assert {(r.v, r.rownum) for r in df.collect()} == {(v, 500 - v) for v in range(500)}
    assert relational.assign_rownum(employees(spark), "employee_id", [F.col("last_name")], "n").where("n = 1").first().last_name == "De Haan"


def test_keep_and_theta_joins(spark):
    e = employees(spark)
    got = relational.keep_dense_rank(e.where("manager_id is not null"), ["manager_id"], [F.col("salary"), F.col("last_name")], [F.max("last_name").alias("who")], first=False)
    assert {(r.manager_id, r.who) for r in got.collect()} == {(100, "Kochhar"), (101, "Greenberg"), (108, "Faviet"), (102, "Hunold")}
    a, b = spark.createDataFrame([(1,), (5,)], "x int"), spark.createDataFrame([(3,), (4,)], "y int")
    assert relational.outer_plus(a, b, F.col("x") > F.col("y")).count() == 3
    assert relational.outer_plus(a, b, F.col("x") == F.col("y"), side="left").count() == 2


def test_pipe_rows(spark):
    df = spark.createDataFrame([(3,), (0,)], "n int")
    made = relational.pipe_rows(df, F.filter(F.sequence(F.lit(1), F.greatest("n", F.lit(1))), lambda i: i <= F.col("n")), "i")
    assert [(r.n, r.i) for r in made.collect()] == [(3, 1), (3, 2), (3, 3)]


def test_selection(spark):
    c = spark.createDataFrame([("TABLE", "EMP"), ("TABLE", "emp_old"), ("INDEX", "EMP"), ("VIEW", "V1")], "object_type string, object_name string")
    names = lambda df: sorted((r.object_type, r.object_name) for r in df.collect())
    assert names(selection.select_objects(c, ["emp.*", "!.*old"])) == [("INDEX", "EMP"), ("TABLE", "EMP")]
    assert names(selection.filter_typed(c, "TABLE[EMP]; INDEX[X.*]")) == [("TABLE", "EMP"), ("VIEW", "V1")]
    assert names(selection.filter_typed(c, "TABLE[EMP.*]", exclude=True)) == [("INDEX", "EMP"), ("VIEW", "V1")]
    assert selection.parse_object_filter("A, B.*") == {"": ["A", "B.*"]}
    o = spark.createDataFrame([("SYS", "valid"), ("HR", "INVALID"), ("HR", "VALID")], "owner string, status string")
    assert selection.exclude_schemas(o).count() == 2 and selection.by_status(o, "invalid").count() == 1 and selection.by_status(o, "all").count() == 3
    t = spark.createDataFrame([("b", 5), ("a", 9), ("c", 1)], "table_name string, bytes long")
    assert [[r.table_name for r in selection.order_tables(t, by).collect()] for by in ("name", "size", ["C", "b"])] == [["a", "b", "c"], ["a", "b", "c"], ["c", "b", "a"]]
    assert t.where(selection.mysql_regexp(F.col("table_name"), "^A$")).count() == 1 and t.where(selection.mysql_regexp(F.col("table_name"), "^A$", binary=True)).count() == 0


def test_rules(spark):
    df = spark.createDataFrame([(1, None), (1, 2), (1, 2), (None, 1)], "a int, b int")
    assert validation.check_unique(df, ["a", "b"]).count() == 1 and validation.check_unique(df, ["a", "b"], primary=True).count() == 3
    assert validation.check_fk(df, spark.createDataFrame([(2,)], "p int"), {"b": "p"}).count() == 1
    assert validation.check_condition(df, "b > 1").count() == 1
    assert {r.column_name: r.n_null for r in validation.check_not_null(df, ["a", "b"]).collect()} == {"a": 1, "b": 1}


def test_jdbc_round_trip_on_derby(spark, tmp_path):
    conn = readers.Connection(f"jdbc:derby:{tmp_path}/db;create=true", driver="org.apache.derby.jdbc.EmbeddedDriver")
    src = spark.range(1000).select(F.col("id").alias("K"), (F.col("id") * 2).alias("V"))
    try:
        writers.write_jdbc(src, conn, "T", jobs=2)
    except Exception as e:  # the embedded database is not part of every Spark
        if "ClassNotFound" in str(e) or "No suitable driver" in str(e):
            pytest.skip("no embedded database")
        raise
    back = readers.read_table(spark, conn, "T", "K", 4, rows=200_000)
    assert back.rdd.getNumPartitions() == 4 and back.count() == 1000 and back.agg(F.sum("V")).first()[0] == 999000
    assert readers.read_table(spark, conn, "T", "K", 4, rows=10).rdd.getNumPartitions() == 1
    assert readers.read_query(spark, conn, "SELECT K FROM T WHERE K < 5").count() == 5
    assert readers.register_remote(spark, conn, "T", "remote_t").where("K = 7").first().V == 14
    assert readers.load_many({"t": lambda: readers.read_table(spark, conn, "T")}, lambda n, df: df.count()) == {"t": 1000}
    assert readers.as_of_clause("oracle", scn=5) == "AS OF SCN 5" and readers.as_of_clause("oracle", timestamp="SYSDATE - 1") == "AS OF TIMESTAMP SYSDATE - 1"


def test_files(spark, tmp_path):
    df = spark.createDataFrame([(1, "é|x"), (2, "b")], "id int, t string")
    writers.write_bulk(df, str(tmp_path / "csv"), "csv", "gzip")
    assert readers.read_external(spark, str(tmp_path / "csv"), schema="id int, t string", header=True).count() == 2
    writers.write_tables({"a": df}, str(tmp_path / "out"))
    writers.write_tables({"a": df.limit(0), "b": df}, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/a")).count() == 2
    (tmp_path / "f").mkdir()
    (tmp_path / "f/x.bin").write_bytes(b"data")
    names = spark.createDataFrame([("x.bin",), ("none.bin",)], "p string")
    assert [r.p and bytes(r.p) for r in readers.resolve_bfile(names, "p", "content", str(tmp_path / "f")).orderBy(F.desc_nulls_last("p")).collect()] == [b"data", None]
    assert readers.resolve_bfile(spark.createDataFrame([("d/e/x.bin",)], "p string"), "p", "parts").first().p.directory == "d/e"
    (tmp_path / "list.csv").write_text('"type","schema","dsn","user","password","audit_user"\nmysql,HR,"dbi:mysql:host=h1;database=db1",u,p,\n,HR,"dbi:Oracle:host=h2;sid=x",u,p,\n')
    assert [(r.type, r.host, r.service) for r in readers.read_scan_list(spark, str(tmp_path / "list.csv")).collect()] == [("MYSQL", "h1", "db1"), ("ORACLE", "h2", "x")]
    (tmp_path / "code").mkdir()
    (tmp_path / "code/p1.sql").write_text("BEGIN\nEND;")
    assert readers.read_code(spark, str(tmp_path / "code")).first().name == "p1"
    good, bad = writers.split_bad_rows(spark.createDataFrame([("1", "2024-01-01"), ("x", "no"), (None, None)], "n string, d string"), {"n": "int", "d": "date"})
    assert good.count() == 2 and bad.first().bad_columns == "n,d"
    assert writers.throughput(df)["rows"] == 2
    writers.write_report(df, str(tmp_path / "r"), "json")
    assert len(list((tmp_path / "r").glob("part-*"))) == 1


def test_mview(spark):
    spark.sql("DROP TABLE IF EXISTS mv1")
    spark.sql("DROP TABLE IF EXISTS mv_registry")
    spark.range(5).createOrReplaceTempView("v1")
    assert writers.registered(spark, "mv_registry").count() == 0
    writers.refresh_mview(spark, "mv1", "v1", "mv_registry")
    spark.range(7).createOrReplaceTempView("v1")
    assert writers.refresh_mview(spark, "mv1", "v1", "mv_registry").count() == 7
    assert writers.registered(spark, "mv_registry").count() == 1
    spark.sql("DROP TABLE mv1")
    spark.sql("DROP TABLE mv_registry")


def test_stream_apply(spark, tmp_path):
    schema = "k int, v int, ts timestamp"
    src = str(tmp_path / "in")
    at = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(1, 1, at), (2, 2, at), (1, 5, at + dt.timedelta(minutes=1))], schema).coalesce(1).write.parquet(src)
    run = lambda: cdc.stream_apply(spark.readStream.schema(schema).parquet(src), str(tmp_path / "out"), ["k"], "ts", str(tmp_path / "cp")).awaitTermination()
    run()
    spark.createDataFrame([(2, 9, at + dt.timedelta(minutes=2)), (3, 3, at)], schema).coalesce(1).write.mode("append").parquet(src)
    run()
    assert {(r.k, r.v) for r in spark.read.parquet(str(tmp_path / "out/v=1")).collect()} == {(1, 5), (2, 9), (3, 3)}
    spark.createDataFrame([(4, 4, at)], schema).coalesce(1).write.mode("append").parquet(src)
    run()
    assert {(r.k, r.v) for r in spark.read.parquet(str(tmp_path / "out/v=2")).collect()} == {(1, 5), (2, 9), (3, 3), (4, 4)}
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.is_dir()) == ["v=1", "v=2"]


def test_windowed_counts_on_a_stream(spark, data):
    schema = spark.read.parquet(f"{data}/events.parquet").schema
    import os
    import shutil
    import tempfile

    folder = tempfile.mkdtemp(prefix="spark-stream-")
    shutil.copy(f"{data}/events.parquet", os.path.join(folder, "events.parquet"))
    stream = cdc.windowed_counts(spark.readStream.schema(schema).parquet(folder), "ts", "1 hour", "1 hour", ["event_type"])
    q = stream.writeStream.outputMode("complete").format("memory").queryName("windowed").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("windowed").agg(F.sum("n")).first()[0] == spark.read.schema(schema).parquet(folder).count()


def sdo(gtype, info, flat, point=None, srid=None):
    return (gtype, srid, point, info, flat)


SDO = "id int, geom struct<gtype:int,srid:int,point:struct<x:double,y:double,z:double>,elem_info:array<int>,ordinates:array<double>>"


def test_shapes(spark):
    rows = [
        (1, sdo(2001, None, None, (1.5, 2.0, None))), (2, sdo(2002, [1, 2, 1], [0.0, 0.0, 1.0, 1.0, 2.0, 0.0])), (3, sdo(2003, [1, 1003, 1, 11, 2003, 1], [0.0, 0.0, 4.0, 0.0, 4.0, 4.0, 0.0, 4.0, 0.0, 0.0, 1.0, 1.0, 2.0, 1.0, 2.0, 2.0, 1.0, 2.0, 1.0, 1.0])),
        (4, sdo(2003, [1, 1003, 3], [0.0, 0.0, 2.0, 3.0])), (5, sdo(2005, [1, 1, 2], [1.0, 1.0, 2.0, 2.0])), (6, sdo(2006, [1, 2, 1, 5, 2, 1], [0.0, 0.0, 1.0, 1.0, 2.0, 2.0, 3.0, 3.0])), (7, sdo(3001, [1, 1, 1], [1.0, 2.0, 3.0])), (8, sdo(1, None, None)),
    ]
    df = spark.createDataFrame(rows, SDO)
    v = geometry.vertices(df)
    got = {r.id: r.wkt for r in geometry.assemble_shapes(v).collect()}
    assert got == {
        1: "POINT(1.5 2)", 2: "LINESTRING(0 0,1 1,2 0)", 3: "POLYGON((0 0,4 0,4 4,0 4,0 0),(1 1,2 1,2 2,1 2,1 1))", 4: "POLYGON((0 0,2 0,2 3,0 3,0 0))", 5: "MULTIPOINT(1 1,2 2)", 6: "MULTILINESTRING((0 0,1 1),(2 2,3 3))", 7: "POINTZ(1 2 3)",
    }
    assert {r.id: r.area for r in geometry.measures(v).collect()}[3] == 15.0
    assert geometry.detect_spatial_type(df.where("id in (2)")).first().spatial_type == "LINESTRING" and geometry.detect_spatial_type(df).first().spatial_type == "GEOMETRY"
    assert geometry.fix_srid(df, mapping={4326: 3857}).first().geom.srid == 3857


def test_spatial_joins_against_all_pairs(spark):
    rng = random.Random(3)
    boxes = lambda n: [(i, x, y, x + rng.uniform(0.1, 4), y + rng.uniform(0.1, 4)) for i in range(n) for x, y in [(rng.uniform(-10, 10), rng.uniform(-10, 10))]]
    a, b = boxes(60), boxes(60)
    fa, fb = (spark.createDataFrame(x, "id int, x0 double, y0 double, x1 double, y1 double") for x in (a, b))
    for p in ("intersects", "contains", "within", "overlaps"):
        joined = fa.alias("a").join(fb.alias("b"), geometry.mbr_test(p)).select("a.id", "b.id").collect()
        got = geometry.mbr_join(fa, fb, p, 1.5).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, joined))
    points = [(i, rng.uniform(-10, 10), rng.uniform(-10, 10)) for i in range(200)]
    fp = spark.createDataFrame(points, "id int, x double, y double")
    near = {(x[0], y[0]) for x in points for y in points if (x[1] - y[1]) ** 2 + (x[2] - y[2]) ** 2 <= 1}
    assert {(r.a_id, r.b_id) for r in geometry.st_dwithin_join(fp, fp, 1.0).collect()} == near
    rings = [(i, sdo(2003, [1, 1003, 1], [x0, y0, x1, y0, x1, y1, x0, y1, x0, y0])) for i, x0, y0, x1, y1 in a]
    inside = geometry.points_in_polygons(fp, geometry.vertices(spark.createDataFrame(rings, SDO)), 2.0)
    assert {(r.point_id, r.polygon_id) for r in inside.collect()} == {(p[0], i) for p in points for i, x0, y0, x1, y1 in a if x0 < p[1] < x1 and y0 < p[2] < y1}


def test_text_search(spark):
    docs = spark.createDataFrame([(1, "Été à Paris", "river and bridge"), (2, "bridge", "ete summer"), (3, None, "nothing")], "id int, title string, body string")
    index = textsearch.fts_index(docs, "id", ["title", "body"])
    assert {r.id: r["rank"] for r in textsearch.fts_search(index, "ÉTÉ bridge").collect()} == {1: 1.5, 2: 1.5}
    assert textsearch.fts_search(index, "").count() == 0 and textsearch.fts_search(index, "river summer", all_words=False).count() == 2
    a = spark.createDataFrame([(1, "catalogue"), (2, "dog"), (3, None)], "id int, text string")
    b = spark.createDataFrame([(7, "catalog"), (8, "catalog"), (9, "bird")], "id int, text string")
    assert {(r.a_id, r.b_id) for r in textsearch.trigram_join(a, b, 0.4).collect()} == {(1, 7), (1, 8)}


def test_trigram_join_against_all_pairs(spark):
    rng = random.Random(6)
    texts = lambda n: [(i, "common " + "".join(rng.choice("abcé ") for _ in range(rng.randint(0, 9)))) for i in range(n)] + [(n, ""), (n + 1, None)]
    a, b = texts(120), texts(120)
    fa, fb = (spark.createDataFrame(x, "id int, text string") for x in (a, b))
    grams = lambda t: {p[i : i + 3] for p in [f"  {t.replace('é', 'e')} "] for i in range(len(p) - 2)}
    for threshold in (0.0, 0.05, 0.3, 0.5, 0.8, 1.0):
        want = {(i, j): len(x & y) / len(x | y) for i, s in a for j, t in b if s is not None and t is not None for x, y in [(grams(s), grams(t))] if x & y and len(x & y) / len(x | y) >= threshold}
        got = textsearch.trigram_join(fa, fb, threshold).collect()
        assert {(r.a_id, r.b_id): r.similarity for r in got} == want and len(got) == len(want)


def test_frequent_trigrams_make_no_pairs(spark):
    own = lambda base: spark.range(300).select((F.col("id") + base).alias("id"), F.concat(F.lit("all "), F.substring(F.md5((F.col("id") + base).cast("string")), 1, 16)).alias("text"))
    sides = [d.select(F.col("text").alias(f"{k}_text"), F.size("g").alias(f"{k}_n"), F.explode("g").alias("g")) for k, d in (("a", own(0).withColumn("g", textsearch.trigrams(F.col("text")))), ("b", own(200).withColumn("g", textsearch.trigrams(F.col("text")))))]
    assert 100 <= textsearch.trigram_candidates(*sides, 0.6).count() < 9000
    assert textsearch.trigram_join(own(0), own(200), 0.6).count() == 100


def test_assessment(spark):
    code = spark.createDataFrame([("d", "FUNCTION", "f", "BEGIN EXCEPTION WHEN OTHERS THEN NULL; x := EXTRACT(YEAR FROM d); END; " * 40), ("d", "VIEW", "v", None)], "db string, object_type string, name string, code string")
    got = {(r.name, r.keyword): (r.n, r.cost) for r in assessment.score_details(code).collect()}
    assert got[("f", "WHEN OTHER")] == (40, 400) and got[("f", "EXTRACT")] == (40, 120) and got[("f", "TEST")] == (1, 2) and got[("f", "SIZE")][1] == 2 and not [k for k in got if k[0] == "v"]
    counts = spark.createDataFrame([("TABLE", 100000, 0), ("VIEW", 3, 1)], "object_type string, n_objects long, n_invalid long")
    assert {r.object_type: r.object_cost for r in assessment.object_cost(counts).collect()} == {"TABLE": 672, "VIEW": 3}
    assert spark.range(1).select(assessment.to_days(F.lit(162.5))).first()[0] == pytest.approx(1.6927, abs=1e-3)
    assert spark.range(1).select(assessment.normalise_sql(F.lit("select /* x */ a\n from t where b = 'it''s' and c=12.5 -- end"))).first()[0] == "SELECT A FROM T WHERE B = ? AND C=?"
    c = spark.createDataFrame([("HR", "T", "ORDER", "NUMBER", 4, 0, 22), ("HR", "T", "A", "DATE", None, None, 7)], "owner string, table_name string, column_name string, data_type string, data_precision int, data_scale int, data_length int")
    assert [(r.spark_type, r.reserved_word) for r in assessment.show_columns(c).collect()] == [("smallint", True), ("timestamp_ntz", False)]
    assert assessment.schema_size(spark.createDataFrame([("HR", 1048576), ("HR", 1048576)], "owner string, bytes long")).first().size_mb == 2
    assert assessment.kind_counts(c.withColumn("object_type", F.lit("COLUMN")), "data_type").count() == 2


def test_incremental(spark):
    df = spark.createDataFrame([(1,), (5,), (9,)], "n int")
    marks = cdc.register_marks({"t": (df.where("n < 6"), "n")})
    assert [r.n for r in cdc.incremental(df, marks, "t", "n").collect()] == [9] and cdc.incremental(df, marks, "other", "n").count() == 3


def test_audited_statements_may_hold_long_literals(spark):
    from ferrywright.plans import assessment

    text = "select 'it''s " + "x" * 1_000_000 + "' from t where a = 12 -- end"
    got = spark.createDataFrame([(text,)], "s string").select(assessment.normalise_sql(F.col("s"))).first()[0]
    assert got == "SELECT ? FROM T WHERE A = ?"


def test_gates_of_rules_never_hide_a_match(spark):
    from ferrywright.plans import assessment

    assert assessment._literal(r"\bCONNECT\s+BY\b") == "CONNECT" and assessment._literal(r"\|\|") == "||" and assessment._literal(r"_(un)?lock\(") is None
    assert assessment._literal(r"\s+(UNPIVOT|PIVOT)\s*") is None and assessment._literal(r"ab?c") is None and assessment._literal(r"(?<!INSERT)\s+INTO") is None


def test_recursion_deeper_than_the_default(spark):
    from ferrywright.operators import hierarchy

    sql = "WITH RECURSIVE t(n) AS (SELECT 1 UNION ALL SELECT n + 1 FROM t WHERE n < 150) SELECT max(n) AS n FROM t"
    assert hierarchy.recursive_cte(spark, sql, 200).first().n == 150
    with pytest.raises(Exception):
        hierarchy.recursive_cte(spark, sql, 20).collect()


def test_renumbering_keeps_repeated_keys(spark):
    from ferrywright.operators import relational

    df = spark.createDataFrame([(1, 5, 0), (1, 4, 0), (2, 9, 0), (None, 1, 0)], "k long, v long, n long")
    got = relational.assign_rownum(df, "k", [F.col("v")], "n").orderBy("n").collect()
    assert [(r.k, r.v, r.n) for r in got] == [(None, 1, 1), (1, 4, 2), (1, 5, 3), (2, 9, 4)]
    assert [r.v for r in relational.rownum_limit(df, ">", 2, [F.col("v")]).orderBy("v").collect()] == [5, 9]


def test_numbers_with_more_decimals_stay(spark):
    from ferrywright.functions import types

    df = spark.createDataFrame([(1.0, 1.25)], "a double, b double")
    assert dict(types.narrow_numeric(df, {"a": (3, 0), "b": (3, 1)}).dtypes) == {"a": "smallint", "b": "double"}


def test_regexp_instr_finds_the_nth_match(spark):
    from ferrywright.functions import oracle

    df = spark.createDataFrame([("abcabcabc",), ("xyz",), (None,)], "s string")
    got = df.select(oracle.regexp_instr(F.col("s"), "b", 3, 2).alias("a"), oracle.regexp_instr(F.col("s"), "bc", end=True).alias("b"), oracle.regexp_instr(F.col("s"), "B", flags="i").alias("c")).collect()
    assert [tuple(r) for r in got] == [(8, 4, 2), (0, 0, 0), (None, None, None)]


def test_trigram_join_of_many_texts_with_a_frequent_trigram(spark):
    own = lambda salt: spark.range(20000).select(F.col("id"), F.concat(F.lit("www"), F.md5((F.col("id") + salt * F.expr("case when id % 1000 = 0 then 0 else 1 end")).cast("string"))).alias("text"))
    got = {(r.a_id, r.b_id) for r in textsearch.trigram_join(own(0), own(100000), 0.8).collect()}
    assert got == {(i, i) for i in range(0, 20000, 1000)}
    a = own(0).where("id < 300").unionAll(spark.createDataFrame([(900, "www x"), (901, "wwwx x"), (902, "www x"), (903, None)], "id long, text string"))
    both, mirrored = textsearch.trigram_join(a, a.select("*"), 0.4), textsearch.trigram_join(a, a, 0.4)
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, mirrored.collect())) and mirrored.count() >= 307
