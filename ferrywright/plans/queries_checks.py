"""Queries of diffs, validation, rules, change capture, assessment, geometry and text search."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrywright.operators import diffing, geometry, textsearch, validation
from ferrywright.plans import assessment
from ferrywright.plans.tables import NEW_ORDERS_SQL, boxes_of, new_orders, order_catalog, order_code, table
from ferrywright.streaming import cdc


def v8_datadiff_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: deletes, updates and inserts between two versions of orders, with counts and price sums."""
    diff = diffing.datadiff_by_key(table(spark, sf_dir, "orders"), new_orders(spark, sf_dir), ["o_orderkey"])
    price = F.coalesce("new.o_totalprice", "old.o_totalprice")
    return diff.groupBy("op").agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum(price), 2).alias("price"))


def v7_datadiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    gone, fresh = diffing.datadiff(table(spark, sf_dir, "orders"), new_orders(spark, sf_dir))
    tag = lambda df, op: df.agg(F.count(F.lit(1)).alias("n_rows"), F.min("o_orderkey").alias("low")).select(F.lit(op).alias("op"), "n_rows", "low")
    return tag(gone, "del").unionByName(tag(fresh, "ins"))


def v9_apply_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old version with the diff applied, which is the new one."""
    old = table(spark, sf_dir, "orders")
    diff = diffing.datadiff_by_key(old, new_orders(spark, sf_dir), ["o_orderkey"])
    return diffing.apply_diff(old, diff, ["o_orderkey"])


def v1_test_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = {n: table(spark, sf_dir, n) for n in ("orders", "customer", "nation")}
    return validation.test_count(source, {"orders": new_orders(spark, sf_dir), "customer": source["customer"], "part": table(spark, sf_dir, "part")})


def v2_test_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objects by kind and owner of a catalog and of its later version."""
    catalog = order_catalog(spark, sf_dir).select(F.col("object_type").alias("kind"), F.col("db").alias("table_name"), "status")
    return validation.test_structure(catalog, catalog.where("status = 'VALID' or kind <> 'VIEW'"))


def v4_test_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.test_data(table(spark, sf_dir, "orders"), new_orders(spark, sf_dir), ["o_orderkey"], 0, 0)


def v4_test_data_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 10 faults among the first 500 rows, as the check's own limits have it."""
    return validation.test_data(table(spark, sf_dir, "orders"), new_orders(spark, sf_dir), ["o_orderkey"], 500, 10)


def v5_test_unordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["l_returnflag", "l_linestatus", "l_quantity"]
    l = table(spark, sf_dir, "lineitem").select(*names, "l_orderkey")
    return validation.test_data_unordered(l.select(*names), l.where("l_orderkey % 5 <> 1").select(*names))


def v6_test_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"), F.col("s_suppkey").alias("last_number"))
    t = s.where("last_number % 9 <> 0").select(F.upper("name").alias("name"), F.when(F.col("last_number") % 4 == 0, F.col("last_number") + 1).otherwise(F.col("last_number")).alias("last_number"))
    return validation.test_sequences(s, t)


def v10_check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.check_unique(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_partkey"])


def v11_check_fk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.check_fk(table(spark, sf_dir, "lineitem"), new_orders(spark, sf_dir), {"l_orderkey": "o_orderkey"}).groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n_orphans"))


def v12_check_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.check_condition(table(spark, sf_dir, "customer"), "c_acctbal >= 0 and c_mktsegment <> 'MACHINERY'").select("c_custkey")


def v13_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    filled = validation.fill_default(o, {"o_orderstatus": "case when o_orderkey % 2 = 0 then 'N' end"})
    return validation.check_not_null(filled, ["o_orderkey", "o_orderstatus"])


def v14_check_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").withColumn("code", F.when(F.col("p_partkey") % 6 == 0, "x").otherwise(F.col("p_partkey").cast("string")))
    return validation.check_types(p, {"code": ("int", 3), "p_brand": ("string", 7)})


def v15_run_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {n: table(spark, sf_dir, n) for n in ("lineitem", "part", "nation")} | {"orders": new_orders(spark, sf_dir)}
    rules = [
        {"name": "orders_pk", "kind": "pkeys", "table": "orders", "columns": ["o_orderkey"]}, {"name": "nation_uk", "kind": "ukeys", "table": "nation", "columns": ["n_regionkey"]}, {"name": "line_fk", "kind": "fkeys", "table": "lineitem", "parent": "orders", "columns": {"l_orderkey": "o_orderkey"}},
        {"name": "size_ck", "kind": "checks", "table": "part", "condition": "p_size > 5"}, {"name": "skipped", "kind": "indexes", "table": "part", "condition": "false"},
    ]
    return validation.run_rules(tables, rules, ["indexes"])


def c1_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.register_marks({"orders": (table(spark, sf_dir, "orders"), "o_orderkey"), "events": (table(spark, sf_dir, "events"), "event_id")})


def c2_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    marks = cdc.register_marks({"orders": (o.where("o_orderkey % 3 = 0 and o_orderdate < timestamp '1997-01-01'"), "o_orderdate")})
    return cdc.incremental(o, marks, "orders", "o_orderdate").select("o_orderkey", "o_orderdate")


def c4_merge_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers after an extract with several changes of a key."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    changes = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal"), "o_orderkey")
    return cdc.merge_extract(c, cdc.latest_changes(changes, ["c_custkey"], "o_orderkey").select("c_custkey", "c_acctbal"), ["c_custkey"])


def c5_windowed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdc.windowed_counts(table(spark, sf_dir, "events"), "ts", "10 minutes", "1 hour", ["event_type"])


def e1_score_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Difficulties of the corpus, by type and keyword."""
    d = assessment.score_details(order_code(spark, sf_dir))
    return d.groupBy("object_type", "keyword").agg(F.sum("n").alias("n"), F.round(F.sum("cost"), 4).alias("cost"))


def e2_score_mysql(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = order_code(spark, sf_dir).withColumn("code", F.concat(F.lit("SELECT COUNT(DISTINCT a), GROUP_CONCAT(DISTINCT b), @v FROM t WHERE JSON_EXTRACT(c, '$') AND d = "), F.substring("name", 2, 20), F.lit("; SELECT FOUND_ROWS()")))
    return assessment.score(code, "mysql").groupBy("object_type").agg(F.count(F.lit(1)).alias("n_objects"), F.round(F.sum("cost"), 4).alias("cost"))


def e3_score_tsql(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = order_code(spark, sf_dir).withColumn("code", F.concat(F.lit("SELECT TOP 5 GETDATE(), @@ROWCOUNT, @@SERVERNAME FROM a FOR XML PATH; SELECT * FROM x PIVOT (y) WHERE k = "), F.substring("name", 2, 20)))
    return assessment.score_details(code, "tsql").groupBy("keyword").agg(F.sum("n").alias("n"), F.round(F.sum("cost"), 4).alias("cost"))


def e8_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assessment.assessment_report(order_catalog(spark, sf_dir), order_code(spark, sf_dir), by=("db",)).where("db is not null")


def e9_assess_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assessment.assess_many(order_catalog(spark, sf_dir), order_code(spark, sf_dir)).select("db", "n_objects", "n_invalid", "cost", "level")


def e10_audit_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    log = e.select(F.concat(F.lit("select *  from t where a = "), F.col("user_id").cast("string"), F.lit(" and b = '"), F.col("event_type"), F.lit("' -- "), F.col("event_id").cast("string"), F.lit("\n and kind = "), F.col("event_type")).alias("sql_text"), F.concat(F.lit("u"), (F.col("user_id") % 3).cast("string")).alias("username"), F.when(F.col("event_id") % 5 == 0, "LOGON").otherwise("SELECT").alias("action_name"))
    return assessment.audit_queries(log, ["U0", "u1"])


def a6_object_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assessment.object_cost(assessment.object_counts(order_catalog(spark, sf_dir)))


def g4_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Triangles from parts: vertices, length, area and centroid."""
    m = geometry.measures(geometry.vertices(_triangles(spark, sf_dir)))
    return m.withColumns({c: F.round(c, 6) for c in ("length", "cx", "cy")})


def _triangles(spark: SparkSession, sf_dir: str, scale: float = 1.0) -> DataFrame:
    x, y, s = (F.col("p_partkey") % 100).cast("double"), (F.col("p_partkey") % 37).cast("double"), (F.col("p_size") + 1).cast("double") / scale
    geom = F.struct(F.lit(2003).alias("gtype"), F.lit(None).cast("int").alias("srid"), F.lit(None).cast("struct<x:double,y:double,z:double>").alias("point"), F.array(F.lit(1), F.lit(1003), F.lit(1)).alias("elem_info"), F.array(x, y, x + s, y, x, y + s, x, y).alias("ordinates"))
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), geom.alias("geom"))


def g5_within_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers near suppliers on a made-up map."""
    at = lambda df, k: df.select(F.col(k).alias("id"), ((F.col(k) * 37) % 1000 / 10.0).alias("x"), ((F.col(k) * 91) % 1000 / 10.0).alias("y"))
    near = geometry.st_dwithin_join(at(table(spark, sf_dir, "customer"), "c_custkey"), at(table(spark, sf_dir, "supplier"), "s_suppkey"), 3.0)
    return near.select("a_id", "b_id", F.round("distance", 6).alias("distance"))


def g7_box_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.mbr_join(boxes_of(spark, sf_dir, "customer", "c_custkey", 1.5), boxes_of(spark, sf_dir, "supplier", "s_suppkey", 0.75), "contains", 2.0)


def g8_points_in_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), ((F.col("c_custkey") * 37) % 1000 / 10.0 + 0.05).alias("x"), ((F.col("c_custkey") * 91) % 400 / 10.0 + 0.05).alias("y"))
    return geometry.points_in_polygons(points, geometry.vertices(_triangles(spark, sf_dir, 25.0)), 2.0)


def g9_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return geometry.assemble_shapes(geometry.vertices(_triangles(spark, sf_dir)))


def t1_text_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = textsearch.fts_index(table(spark, sf_dir, "documents"), "doc_id", ["source", "text"])
    return textsearch.fts_search(index, "the and")


def t3_trigram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of like addresses, each page with itself and others."""
    a = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.col("url").alias("text"))
    return textsearch.trigram_join(a, a, 0.8).select("a_id", "b_id", F.round("similarity", 6).alias("similarity"))


_KIND = "CASE o_orderstatus WHEN 'F' THEN 'FUNCTION' WHEN 'O' THEN 'VIEW' ELSE 'TRIGGER' END"
_ORDER_COST = f"""c AS (SELECT o_orderpriority AS db, {_KIND} AS t, o_orderkey AS k, o_orderkey % 11 = 0 AS bad,
  CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 3 END + 3.1 + CASE WHEN o_orderkey % 3 = 0 THEN 3 ELSE 0 END + CASE WHEN o_orderkey % 4 = 0 THEN 1.1 ELSE 0 END + CASE WHEN o_orderkey % 5 = 0 THEN 3 ELSE 0 END AS cost,
  3.1 + CASE WHEN o_orderkey % 3 = 0 THEN 3 ELSE 0 END + CASE WHEN o_orderkey % 4 = 0 THEN 1.1 ELSE 0 END + CASE WHEN o_orderkey % 5 = 0 THEN 3 ELSE 0 END AS hard FROM orders)"""
QUERIES = {
    "v8_datadiff_updates": (
        v8_datadiff_updates,
        f"""WITH n AS ({NEW_ORDERS_SQL}), b AS (SELECT o.o_orderkey AS ok, n.o_orderkey AS nk, coalesce(n.o_totalprice, o.o_totalprice) AS p, n.o_totalprice IS DISTINCT FROM o.o_totalprice AS d FROM orders o FULL OUTER JOIN n ON o.o_orderkey = n.o_orderkey)
        SELECT CASE WHEN nk IS NULL THEN 'del' WHEN ok IS NULL THEN 'ins' ELSE 'upd' END AS op, count(*) AS n_rows, round(sum(p), 2) AS price FROM b WHERE nk IS NULL OR ok IS NULL OR d GROUP BY 1""",
    ),
    "v7_datadiff": (
        v7_datadiff,
        f"WITH n AS ({NEW_ORDERS_SQL}) SELECT 'del' AS op, count(*) AS n_rows, min(o_orderkey) AS low FROM (SELECT * FROM orders EXCEPT ALL SELECT * FROM n) UNION ALL SELECT 'ins', count(*), min(o_orderkey) FROM (SELECT * FROM n EXCEPT ALL SELECT * FROM orders)",
    ),
    "v9_apply_diff": (v9_apply_diff, NEW_ORDERS_SQL),
    "v1_test_count": (
        v1_test_count,
        f"""WITH n AS ({NEW_ORDERS_SQL}), s AS (SELECT 'orders' AS t, (SELECT count(*) FROM orders) AS s, (SELECT count(*) FROM n) AS g UNION ALL SELECT 'customer', (SELECT count(*) FROM customer), (SELECT count(*) FROM customer) UNION ALL SELECT 'nation', (SELECT count(*) FROM nation), NULL
        UNION ALL SELECT 'part', NULL, (SELECT count(*) FROM part)) SELECT t AS table_name, s AS source_rows, g AS target_rows, CASE WHEN s IS NULL THEN 'missing in source' WHEN g IS NULL THEN 'missing in target' WHEN s = g THEN 'ok' ELSE 'diff' END AS status FROM s""",
    ),
    "v2_test_structure": (
        v2_test_structure,
        f"""SELECT {_KIND} AS kind, o_orderpriority AS table_name, count(*) AS n_source, count(*) FILTER (WHERE o_orderkey % 11 <> 0 OR o_orderstatus <> 'O') AS n_target,
        CASE WHEN count(*) = count(*) FILTER (WHERE o_orderkey % 11 <> 0 OR o_orderstatus <> 'O') THEN 'ok' ELSE 'diff' END AS status FROM orders GROUP BY 1, 2""",
    ),
    "v4_test_data": (
        v4_test_data,
        f"""WITH n AS ({NEW_ORDERS_SQL}) SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, CASE WHEN o.o_orderkey IS NULL THEN 'only in target' WHEN n.o_orderkey IS NULL THEN 'only in source' ELSE 'differs' END AS status,
        CASE WHEN o.o_orderkey IS NOT NULL AND n.o_orderkey IS NOT NULL THEN 'o_totalprice' ELSE '' END AS columns FROM orders o FULL OUTER JOIN n ON o.o_orderkey = n.o_orderkey WHERE o.o_totalprice IS DISTINCT FROM n.o_totalprice OR o.o_orderkey IS NULL OR n.o_orderkey IS NULL""",
    ),
    "v4_test_data_first": (
        v4_test_data_first,
        f"""WITH n AS (SELECT * FROM ({NEW_ORDERS_SQL}) ORDER BY o_orderkey LIMIT 500), o AS (SELECT * FROM orders ORDER BY o_orderkey LIMIT 500) SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, CASE WHEN o.o_orderkey IS NULL THEN 'only in target'
        WHEN n.o_orderkey IS NULL THEN 'only in source' ELSE 'differs' END AS status, CASE WHEN o.o_orderkey IS NOT NULL AND n.o_orderkey IS NOT NULL THEN 'o_totalprice' ELSE '' END AS columns FROM o FULL OUTER JOIN n ON o.o_orderkey = n.o_orderkey
        WHERE o.o_totalprice IS DISTINCT FROM n.o_totalprice OR o.o_orderkey IS NULL OR n.o_orderkey IS NULL ORDER BY 1 LIMIT 10""",
    ),
    "v5_test_unordered": (
        v5_test_unordered,
        "SELECT l_returnflag, l_linestatus, l_quantity, count(*) AS n_source, count(*) FILTER (WHERE l_orderkey % 5 <> 1) AS n_target FROM lineitem GROUP BY 1, 2, 3 HAVING count(*) <> count(*) FILTER (WHERE l_orderkey % 5 <> 1)",
    ),
    "v6_test_sequences": (
        v6_test_sequences,
        "SELECT lower(s_name) AS name, s_suppkey AS source_value, CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE s_suppkey + 1 END AS target_value FROM supplier WHERE s_suppkey % 9 = 0 OR s_suppkey % 4 = 0",
    ),
    "v10_check_unique": (v10_check_unique, "SELECT l_orderkey, l_partkey, count(*) AS n_rows FROM lineitem WHERE l_orderkey IS NOT NULL AND l_partkey IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1"),
    "v11_check_fk": (v11_check_fk, f"WITH n AS ({NEW_ORDERS_SQL}) SELECT l_orderkey, count(*) AS n_orphans FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM n WHERE o_orderkey = l_orderkey) GROUP BY 1"),
    "v12_check_condition": (v12_check_condition, "SELECT c_custkey FROM customer WHERE NOT (c_acctbal >= 0 AND c_mktsegment <> 'MACHINERY')"),
    "v13_not_null": (
        v13_not_null,
        "SELECT 'o_orderkey' AS column_name, count(*) FILTER (WHERE o_orderkey IS NULL) AS n_null FROM orders UNION ALL SELECT 'o_orderstatus', count(*) FILTER (WHERE o_orderstatus = 'P' AND o_orderkey % 2 <> 0) FROM orders",
    ),
    "v14_check_types": (
        v14_check_types,
        "SELECT 'code' AS column_name, count(*) FILTER (WHERE p_partkey % 6 = 0 OR length(p_partkey::VARCHAR) > 3) AS n_bad FROM part UNION ALL SELECT 'p_brand', count(*) FILTER (WHERE length(p_brand) > 7) FROM part",
    ),
    "v15_run_rules": (
        v15_run_rules,
        f"""WITH n AS ({NEW_ORDERS_SQL}) SELECT 'orders_pk' AS rule, 'pkeys' AS kind, 'orders' AS table_name, (SELECT count(*) FROM (SELECT o_orderkey FROM n GROUP BY 1 HAVING count(*) > 1)) AS n_faults
        UNION ALL SELECT 'nation_uk', 'ukeys', 'nation', (SELECT count(*) FROM (SELECT n_regionkey FROM nation GROUP BY 1 HAVING count(*) > 1)) UNION ALL SELECT 'line_fk', 'fkeys', 'lineitem', (SELECT count(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM n WHERE o_orderkey = l_orderkey))
        UNION ALL SELECT 'size_ck', 'checks', 'part', (SELECT count(*) FROM part WHERE NOT p_size > 5)""",
    ),
    "c1_marks": (c1_marks, "SELECT 'orders' AS table_name, max(o_orderkey)::VARCHAR AS mark FROM orders UNION ALL SELECT 'events', max(event_id)::VARCHAR FROM events"),
    "c2_incremental": (c2_incremental, "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate > coalesce((SELECT max(o_orderdate) FROM orders WHERE o_orderkey % 3 = 0 AND o_orderdate < TIMESTAMP '1997-01-01'), TIMESTAMP '0001-01-01')"),
    "c4_merge_extract": (
        c4_merge_extract,
        """WITH l AS (SELECT o_custkey, arg_max(o_totalprice, o_orderkey) AS p FROM orders GROUP BY 1) SELECT c_custkey, coalesce(p, c_acctbal) AS c_acctbal FROM customer LEFT JOIN l ON c_custkey = o_custkey UNION ALL SELECT o_custkey, p FROM l WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""",
    ),
    "c5_windowed_counts": (c5_windowed_counts, "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2"),
    "e1_score_details": (
        e1_score_details,
        f"""WITH o AS (SELECT {_KIND} AS t, o_orderkey AS k, o_orderstatus <> 'O' AS code FROM orders), d AS (SELECT t, 'TEST' AS w, 1 AS n, 2.0 AS c FROM o WHERE code UNION ALL SELECT t, 'SIZE', 1, 1 FROM o WHERE code UNION ALL SELECT t, 'OUTER JOIN', 1, 2 FROM o UNION ALL SELECT t, 'ROWNUM', 1, 1 FROM o
        UNION ALL SELECT t, 'CONCAT', 1, 0.1 FROM o UNION ALL SELECT t, 'DBMS_', 0, 0 FROM o WHERE k % 3 = 0 UNION ALL SELECT t, 'MERGE INTO', 1, 3 FROM o WHERE k % 3 = 0 UNION ALL SELECT t, 'SAVEPOINT', 1, 1 FROM o WHERE k % 4 = 0 UNION ALL SELECT t, 'TRUNC', 1, 0.1 FROM o WHERE k % 4 = 0
        UNION ALL SELECT t, 'CONNECT BY', 1, 3 FROM o WHERE k % 5 = 0) SELECT t AS object_type, w AS keyword, sum(n)::BIGINT AS n, round(sum(c)::DOUBLE, 4) AS cost FROM d GROUP BY 1, 2""",
    ),
    "e2_score_mysql": (e2_score_mysql, f"SELECT {_KIND} AS object_type, count(*) AS n_objects, round(count(*) * (CASE WHEN {_KIND} = 'VIEW' THEN 0 ELSE 3 END + 1 + 2 + 2 + 0.1 + 2)::DOUBLE, 4) AS cost FROM orders GROUP BY 1, {_KIND}"),
    "e3_score_tsql": (
        e3_score_tsql,
        """WITH o AS (SELECT o_orderstatus <> 'O' AS code FROM orders), d AS (SELECT 'TEST' AS w, 1 AS n, 2.0 AS c FROM o WHERE code UNION ALL SELECT 'SIZE', 1, 1 FROM o WHERE code UNION ALL SELECT 'SELECT_TOP', 1, 0.2 FROM o UNION ALL SELECT 'GLOBAL_VARIABLE', 1, 1 FROM o
        UNION ALL SELECT 'FOR_XML', 1, 6 FROM o UNION ALL SELECT 'PIVOT', 1, 12 FROM o UNION ALL SELECT 'GETDATE', 1, 2 FROM o) SELECT w AS keyword, sum(n)::BIGINT AS n, round(sum(c)::DOUBLE, 4) AS cost FROM d GROUP BY 1""",
    ),
    "e8_report": (
        e8_report,
        f"""WITH {_ORDER_COST} SELECT db, t AS object_type, count(*) AS n_objects, count(*) FILTER (WHERE bad) AS n_invalid, round(sum(cost + 1)::DOUBLE, 6) AS cost, round(round(sum(cost + 1)::DOUBLE, 6) * 5 / 60 / 8, 4) AS days FROM c GROUP BY ROLLUP (db, t) HAVING db IS NOT NULL""",
    ),
    "e9_assess_many": (
        e9_assess_many,
        f"""WITH {_ORDER_COST}, g AS (SELECT db, count(*) AS n_objects, count(*) FILTER (WHERE bad) AS n_invalid, round(sum(cost + 1)::DOUBLE, 6) AS cost, sum(hard) AS hard, bool_or(t <> 'VIEW') AS code FROM c GROUP BY 1)
        SELECT db, n_objects, n_invalid, cost, CASE WHEN round(cost * 5 / 60 / 8, 4) > 5 THEN 'C' ELSE 'B' END || '-' || CASE WHEN NOT code THEN 1 WHEN hard <= 20 THEN 3 WHEN round(cost * 5 / 60 / 8, 4) <= 5 THEN 4 ELSE 5 END AS level FROM g""",
    ),
    "e10_audit_queries": (e10_audit_queries, "SELECT 'SELECT * FROM T WHERE A = ? AND B = ? AND KIND = ' || upper(event_type) AS statement, count(*) AS n FROM events WHERE event_id % 5 <> 0 AND user_id % 3 IN (0, 1) GROUP BY 1"),
    "a6_object_counts": (a6_object_counts, f"SELECT {_KIND} AS object_type, count(*) AS n_objects, count(*) FILTER (WHERE o_orderkey % 11 = 0) AS n_invalid, count(*)::DOUBLE AS object_cost FROM orders GROUP BY 1"),
    "g4_vertices": (
        g4_vertices,
        "SELECT p_partkey AS id, 4::BIGINT AS n_vertices, round((p_size + 1) * 2 + sqrt(2.0 * (p_size + 1) * (p_size + 1)), 6) AS length, (p_size + 1) * (p_size + 1) / 2.0::DOUBLE AS area, round(p_partkey % 100 + (p_size + 1) / 4.0, 6)::DOUBLE AS cx, round(p_partkey % 37 + (p_size + 1) / 4.0, 6)::DOUBLE AS cy FROM part",
    ),
    "g5_within_distance": (
        g5_within_distance,
        """WITH a AS (SELECT c_custkey AS id, (c_custkey * 37) % 1000 / 10.0::DOUBLE AS x, (c_custkey * 91) % 1000 / 10.0::DOUBLE AS y FROM customer), b AS (SELECT s_suppkey AS id, (s_suppkey * 37) % 1000 / 10.0::DOUBLE AS x, (s_suppkey * 91) % 1000 / 10.0::DOUBLE AS y FROM supplier)
        SELECT a.id AS a_id, b.id AS b_id, round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2), 6) AS distance FROM a, b WHERE sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= 3.0""",
    ),
    "g7_box_join": (
        g7_box_join,
        """WITH a AS (SELECT c_custkey AS id, (c_custkey * 7) % 1000 / 10.0::DOUBLE AS x0, (c_custkey * 13) % 1000 / 10.0::DOUBLE AS y0 FROM customer), b AS (SELECT s_suppkey AS id, (s_suppkey * 7) % 1000 / 10.0::DOUBLE AS x0, (s_suppkey * 13) % 1000 / 10.0::DOUBLE AS y0 FROM supplier)
        SELECT a.id AS a_id, b.id AS b_id FROM a, b WHERE a.x0 <= b.x0 AND a.x0 + 1.5 >= b.x0 + 0.75 AND a.y0 <= b.y0 AND a.y0 + 3.0 >= b.y0 + 1.5""",
    ),
    "g8_points_in_polygons": (
        g8_points_in_polygons,
        """WITH p AS (SELECT c_custkey AS id, (c_custkey * 37) % 1000 / 10.0::DOUBLE + 0.05 AS x, (c_custkey * 91) % 400 / 10.0::DOUBLE + 0.05 AS y FROM customer), t AS (SELECT p_partkey AS id, p_partkey % 100 AS x, p_partkey % 37 AS y, (p_size + 1) / 25.0::DOUBLE AS s FROM part)
        SELECT p.id AS point_id, t.id AS polygon_id FROM p, t WHERE p.x > t.x AND p.y > t.y AND (p.x - t.x) + (p.y - t.y) < t.s""",
    ),
    "g9_shapes": (
        g9_shapes,
        "SELECT p_partkey AS id, 'POLYGON((' || x || ' ' || y || ',' || (x + s) || ' ' || y || ',' || x || ' ' || (y + s) || ',' || x || ' ' || y || '))' AS wkt FROM (SELECT p_partkey, p_partkey % 100 AS x, p_partkey % 37 AS y, p_size + 1 AS s FROM part)",
    ),
    "t1_text_search": (
        t1_text_search,
        """WITH w AS (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS w FROM documents) SELECT doc_id AS id, count(*) / 2.0::DOUBLE AS rank FROM w WHERE w IN ('the', 'and') GROUP BY 1 HAVING count(DISTINCT w) = 2""",
    ),
    "t3_trigram_join": (
        t3_trigram_join,
        """WITH s AS (SELECT k, page_id AS id, '  ' || lower(url) || ' ' AS t FROM pages, (VALUES ('a'), ('b')) v(k)), g AS (SELECT DISTINCT k, id, substr(t, i, 3) AS g FROM s, range(1, 400) r(i) WHERE i <= length(t) - 2),
        n AS (SELECT k, id, count(*) AS n FROM g GROUP BY 1, 2), j AS (SELECT a.id AS a_id, b.id AS b_id, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.k = 'a' AND b.k = 'b' GROUP BY 1, 2)
        SELECT a_id, b_id, round(c / (x.n + y.n - c)::DOUBLE, 6) AS similarity FROM j JOIN n x ON x.k = 'a' AND x.id = a_id JOIN n y ON y.k = 'b' AND y.id = b_id WHERE c / (x.n + y.n - c)::DOUBLE >= 0.8""",
    ),
}
