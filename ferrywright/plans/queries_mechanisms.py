"""Queries of the operators that need a mechanism of their own: streams of upserts, database round trips, graphs with cycles, digest trees, grids of levels, percentiles, ranked search."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrywright.functions import mysql, oracle, tsql
from ferrywright.operators import geometry, graphs, percentiles, relational, textsearch, validation
from ferrywright.plans.tables import NEW_ORDERS_SQL, boxes_of, new_orders, table
from ferrywright.scratch import folder
from ferrywright.sources import readers, writers
from ferrywright.streaming import upserts

#: Set this to the address of a database to use one; without it local sessions make an embedded one in memory.
JDBC_URL = "spark.ferrywright.jdbc.url"


def database(spark: SparkSession) -> readers.Connection:
    """A database for round trips. An embedded one is seen by one process alone, so on a cluster an address is needed."""
    url = spark.conf.get(JDBC_URL, None)
    if url:
        return readers.Connection(url)
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"set {JDBC_URL} to a database that all executors reach")
    return readers.Connection(f"jdbc:derby:memory:{uuid.uuid4().hex};create=true", driver="org.apache.derby.jdbc.EmbeddedDriver")


def _orders_in_database(spark: SparkSession, sf_dir: str, conn: readers.Connection) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(F.when(F.col("o_orderkey") % 100 != 7, F.col("o_orderkey")).alias("K"), F.col("o_custkey").alias("C"), F.col("o_totalprice").alias("P"), F.col("o_orderpriority").alias("PRIORITY"))
    writers.write_jdbc(rows, conn, "ORDERS_T", jobs=4)
    return rows


def s2_jdbc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders into a database by four writers and back by four readers that part the key; rows without a key come back too."""
    conn = database(spark)
    _orders_in_database(spark, sf_dir, conn)
    return readers.read_table(spark, conn, "ORDERS_T", "K", 4, min_rows=0, rows=1).select(F.col("K").alias("o_orderkey"), F.col("C").alias("o_custkey"), F.col("P").alias("o_totalprice"))


def s5_jdbc_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table by partition, by query, as a remote view in a join, and with a first command in each session; several tables at once."""
    conn = database(spark)
    _orders_in_database(spark, sf_dir, conn)
    parts = [{"name": f"P_{p[0]}", "condition": f"PRIORITY LIKE '{p}%'"} for p in "12345"]
    options = conn.options()
    url = options.pop("url")
    kept = spark.read.jdbc(url, "ORDERS_T", predicates=readers.partition_predicates(parts, exclude=["p_[45]"]), properties=options)
    queried = readers.read_query(spark, conn, "SELECT C, COUNT(*) AS N FROM ORDERS_T WHERE P > 100000 GROUP BY C")
    remote = readers.register_remote(spark, conn, "ORDERS_T", "orders_remote")
    joined = remote.join(table(spark, sf_dir, "customer"), F.col("C") == F.col("c_custkey")).where("c_acctbal > 0")
    writers.write_jdbc(remote.where("C < 0").select("C"), conn, "SESSIONS_T", jobs=1)
    noting = readers.Connection(conn.url, driver=conn.driver, init="INSERT INTO SESSIONS_T VALUES (1)")
    tables = {"partitions": kept, "query": queried, "remote": joined, "init": readers.read_table(spark, noting, "SESSIONS_T")}
    found = readers.load_many({n: (lambda df=df: df) for n, df in tables.items()}, lambda n, df: df.count())
    return spark.createDataFrame(sorted(found.items()), "way string, n long")


def c4_stream_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last order of each customer, from a stream of extracts that come in no order, some twice; customers of every 40th key are taken out."""
    extracts, target = folder(spark, "extracts"), folder(spark, "upserts")
    orders = table(spark, sf_dir, "orders")
    rows = orders.select("o_custkey", "o_orderkey", "o_totalprice", F.lit(False).alias("gone"))
    rows = rows.unionByName(rows.where("o_orderkey % 5 = 0"))
    last = rows.groupBy("o_custkey").agg((F.max("o_orderkey") + 1).alias("o_orderkey")).where("o_custkey % 40 = 0").select("o_custkey", "o_orderkey", F.lit(None).cast("double").alias("o_totalprice"), F.lit(True).alias("gone"))
    both = rows.unionByName(last)
    both.repartition(3, F.pmod(F.xxhash64("o_orderkey"), F.lit(3))).write.parquet(extracts)
    stream = spark.readStream.schema(both.schema).option("maxFilesPerTrigger", 2).parquet(extracts)
    upserts.stream_upserts(stream, target, ["o_custkey"], "o_orderkey", folder(spark, "upserts-checkpoint"), buckets=8).awaitTermination()
    return upserts.live_rows(upserts.read_upserts(spark, target, both.schema), "gone")


def h11_load_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts that need the part of a tenth of their number; every 50 three of them need each other in a ring, and some themselves."""
    k = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"))
    up = k.where("k >= 10").select(F.col("k").alias("name"), F.floor(F.col("k") / 10).cast("long").alias("referenced_name"))
    ring = k.where("k % 50 in (31, 32, 33)").select(F.col("k").alias("name"), F.when(F.col("k") % 50 == 33, F.col("k") - 2).otherwise(F.col("k") + 1).alias("referenced_name"))
    own = k.where("k % 70 = 5").select(F.col("k").alias("name"), F.col("k").alias("referenced_name"))
    edges = up.unionByName(ring).unionByName(own)
    # A ring's last part may be missing from the table's end.
    known = edges.join(k.select(F.col("k").alias("referenced_name")), "referenced_name", "left_semi").select("name", "referenced_name")
    return graphs.load_order(known)


def v4_test_data_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of orders against a later version, joined only where digests of key buckets differ."""
    new = new_orders(spark, sf_dir).where("o_orderkey % 7 <> 0 or o_orderkey % 3000 = 0")
    old = table(spark, sf_dir, "orders").where("(o_orderkey % 10 <> 3 or o_orderkey % 500 = 3) and (o_orderkey % 7 <> 0 or o_orderkey % 3000 = 0)")
    return validation.test_data_tree(old, new.where("o_orderkey < 10000000"), ["o_orderkey"])


def v5_test_unordered_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines against a copy without a few of them: only buckets that differ are grouped."""
    l = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")  # noqa: E741
    return validation.test_data_unordered_tree(l, l.where("l_orderkey % 500 <> 1"))


def g7_box_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of very different sizes, one of them the whole map, that overlap or touch."""
    small = boxes_of(spark, sf_dir, "customer", "c_custkey", 0.5)
    large = boxes_of(spark, sf_dir, "supplier", "s_suppkey", 1.0)
    sized = large.withColumns({"x1": F.col("x0") + F.pow(F.lit(2.0), F.col("id") % 7), "y1": F.col("y0") + F.pow(F.lit(2.0), F.col("id") % 5)})
    whole = large.agg(F.lit(0).cast("long").alias("id"), (F.min("x0") - 1000).alias("x0"), (F.min("y0") - 1000).alias("y0"), (F.max("x0") + 1000).alias("x1"), (F.max("y0") + 1000).alias("y1"))
    return geometry.mbr_counts(small, sized.unionByName(whole.select(*sized.columns)), "intersects", 1.0)


def g7_disjoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' boxes that do not meet those of a stated set, the suppliers' of every 20th key."""
    queries = boxes_of(spark, sf_dir, "supplier", "s_suppkey", 40.0).where("id % 20 = 0")
    return geometry.mbr_disjoint(queries, boxes_of(spark, sf_dir, "customer", "c_custkey", 1.5)).groupBy("a_id").agg(F.count(F.lit(1)).alias("n"))


def a13_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quartiles of prices by flag and of all lines as one group, without gathering a group."""
    l = table(spark, sf_dir, "lineitem")  # noqa: E741
    parts = [percentiles.group_percentiles(df, ["flag"], "l_extendedprice", (0.25, 0.5, 0.75)) for df in (l.withColumn("flag", F.col("l_returnflag")), l.withColumn("flag", F.lit("all")))]
    return parts[0].unionByName(parts[1]).select("flag", "fraction", F.round("value", 4).alias("value"))


def m24_match_natural(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = textsearch.match_natural(textsearch.position_index(docs, "doc_id", ["text"]), "this ther Anea", docs.count())
    return found.select(F.col("id").alias("doc_id"), F.round("rank", 6).alias("rank"))


def m24_match_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = textsearch.match_boolean(textsearch.position_index(docs, "doc_id", ["source", "text"]), '+the -this "of the" tion* anea', docs.count())
    return found.select(F.col("id").alias("doc_id"), F.round("rank", 6).alias("rank"))


def s3_load_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several tables counted at the same time, each in a pool of its own."""
    names = ("orders", "lineitem", "customer", "events")
    found = readers.load_many({n: (lambda n=n: table(spark, sf_dir, n)) for n in names}, lambda n, df: (df.count(), spark.sparkContext.getLocalProperty("spark.scheduler.pool")))
    return spark.createDataFrame([(n, *x) for n, x in sorted(found.items())], "table_name string, n_rows long, pool string")


def m4_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of all cents, cut to two places, to one and to hundreds."""
    l, price = table(spark, sf_dir, "lineitem"), F.col("l_extendedprice")  # noqa: E741
    return l.select("l_orderkey", "l_linenumber", mysql.truncate(F.col("l_discount"), 2).alias("discount"), mysql.truncate(-price, 1).alias("one"), oracle.trunc_number(price, -2).alias("hundreds"), mysql.truncate(price.cast("decimal(12,2)"), 1).cast("string").alias("exact"))


def q10_styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CONVERT by style: years of two digits below 100, but for those that mean the same as the style 100 above."""
    o, d = table(spark, sf_dir, "orders"), F.col("o_orderdate")
    return o.select("o_orderkey", *[tsql.convert("varchar", d, s).alias(f"s{s}") for s in (1, 2, 3, 4, 5, 6, 7, 8, 10, 11, 12, 14, 20, 101, 106, 111, 112, 120)])


def l8_collations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the documents that a case- and accent-blind collation takes for one, in its order."""
    w = table(spark, sf_dir, "documents").select(F.explode(F.split("text", "[^\\p{L}]+")).alias("w")).where("w <> ''").groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    blind = w.withColumn("c", relational.nls_sort(F.col("w"), "UNICODE_CI_AI"))
    return blind.groupBy("c").agg(F.count(F.lit(1)).alias("n_forms"), F.sum("n").cast("long").alias("n_words"), F.min(F.lower(F.col("w"))).alias("form")).select("form", "n_forms", "n_words")


_STYLES = {1: "%m/%d/%y", 2: "%y.%m.%d", 3: "%d/%m/%y", 4: "%d.%m.%y", 5: "%d-%m-%y", 6: "%d %b %y", 7: "%b %d, %y", 8: "%H:%M:%S", 10: "%m-%d-%y", 11: "%y/%m/%d", 12: "%y%m%d", 14: "%H:%M:%S:%g", 20: "%Y-%m-%d %H:%M:%S", 101: "%m/%d/%Y", 106: "%d %b %Y", 111: "%Y/%m/%d", 112: "%Y%m%d", 120: "%Y-%m-%d %H:%M:%S"}
_BOX = "(({k} * 7) % 1000 / 10.0)::DOUBLE AS x0, (({k} * 13) % 1000 / 10.0)::DOUBLE AS y0"
_WORDS = "WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(strip_accents(lower({text})), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS w FROM documents), p AS (SELECT doc_id, unnest(w) AS w FROM d), h AS (SELECT w, doc_id, count(*) AS n FROM p GROUP BY 1, 2), c AS (SELECT w, count(*) AS df, (SELECT count(*) FROM documents) AS total FROM h GROUP BY 1), r AS (SELECT h.w, doc_id, n * CASE WHEN df = total THEN log10(1.0001) ELSE log10(total / df::DOUBLE) END ** 2 AS x FROM h JOIN c USING (w))"

QUERIES = {
    "s2_jdbc_round_trip": (s2_jdbc_round_trip, "SELECT CASE WHEN o_orderkey % 100 <> 7 THEN o_orderkey END AS o_orderkey, o_custkey, o_totalprice FROM orders"),
    "s5_jdbc_reads": (
        s5_jdbc_reads,
        "SELECT 'partitions' AS way, count(*) FILTER (WHERE left(o_orderpriority, 1) IN ('1', '2', '3')) AS n FROM orders UNION ALL SELECT 'query', count(DISTINCT o_custkey) FROM orders WHERE o_totalprice > 100000 UNION ALL SELECT 'remote', count(*) FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0 UNION ALL SELECT 'init', least(count(*), 1) FROM orders",
    ),
    "c4_stream_upserts": (c4_stream_upserts, "SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders WHERE o_custkey % 40 <> 0 GROUP BY 1"),
    "h11_load_order": (
        h11_load_order,
        """WITH RECURSIVE n AS (SELECT p_partkey AS k FROM part), e AS (SELECT k AS a, k // 10 AS b FROM n WHERE k >= 10 UNION SELECT k, CASE WHEN k % 50 = 33 THEN k - 2 ELSE k + 1 END FROM n WHERE k % 50 IN (31, 32, 33) UNION SELECT k, k FROM n WHERE k % 70 = 5),
        g AS (SELECT a, b FROM e WHERE b IN (SELECT k FROM n)), v AS (SELECT a AS k FROM g UNION SELECT b FROM g), reach AS (SELECT a, b FROM g WHERE a <> b UNION SELECT reach.a, g.b FROM reach JOIN g ON reach.b = g.a),
        c AS (SELECT v.k, least(v.k, coalesce(min(x.b), v.k)) AS c, greatest(1, count(x.b)) AS size FROM v LEFT JOIN (SELECT r.a, r.b FROM reach r JOIN reach s ON r.a = s.b AND r.b = s.a) x ON x.a = v.k GROUP BY 1),
        f AS (SELECT DISTINCT x.c AS a, y.c AS b FROM g JOIN c x ON x.k = g.a JOIN c y ON y.k = g.b WHERE x.c <> y.c), l AS (SELECT DISTINCT c, 0 AS level FROM c UNION SELECT f.a, l.level + 1 FROM l JOIN f ON f.b = l.c)
        SELECT c.k AS name, c.c AS component, c.size::BIGINT AS size, EXISTS (SELECT 1 FROM g WHERE g.a = c.k AND g.b = c.k) AS self_reference, (SELECT max(level) FROM l WHERE l.c = c.c)::BIGINT AS level FROM c""",
    ),
    "v4_test_data_tree": (
        v4_test_data_tree,
        f"""WITH n AS (SELECT * FROM ({NEW_ORDERS_SQL}) WHERE o_orderkey < 10000000 AND (o_orderkey % 7 <> 0 OR o_orderkey % 3000 = 0)), o AS (SELECT * FROM orders WHERE (o_orderkey % 10 <> 3 OR o_orderkey % 500 = 3) AND (o_orderkey % 7 <> 0 OR o_orderkey % 3000 = 0))
        SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey, CASE WHEN o.o_orderkey IS NULL THEN 'only in target' WHEN n.o_orderkey IS NULL THEN 'only in source' ELSE 'differs' END AS status,
        CASE WHEN o.o_orderkey IS NOT NULL AND n.o_orderkey IS NOT NULL THEN 'o_totalprice' ELSE '' END AS columns FROM o FULL OUTER JOIN n ON o.o_orderkey = n.o_orderkey WHERE o.o_totalprice IS DISTINCT FROM n.o_totalprice OR o.o_orderkey IS NULL OR n.o_orderkey IS NULL""",
    ),
    "v5_test_unordered_tree": (v5_test_unordered_tree, "SELECT l_orderkey, l_partkey, l_quantity, l_returnflag, count(*) AS n_source, 0::BIGINT AS n_target FROM lineitem WHERE l_orderkey % 500 = 1 GROUP BY 1, 2, 3, 4"),
    "g7_box_levels": (
        g7_box_levels,
        f"""WITH a AS (SELECT c_custkey AS id, {_BOX.format(k='c_custkey')} FROM customer), s AS (SELECT s_suppkey AS id, {_BOX.format(k='s_suppkey')} FROM supplier), b AS (SELECT id, x0, y0, x0 + 2.0 ** (id % 7) AS x1, y0 + 2.0 ** (id % 5) AS y1 FROM s UNION ALL SELECT 0, min(x0) - 1000, min(y0) - 1000, max(x0) + 1000, max(y0) + 1000 FROM s)
        SELECT b.id AS b_id, count(*) AS n FROM a, b WHERE a.x0 <= b.x1 AND b.x0 <= a.x0 + 0.5 AND a.y0 <= b.y1 AND b.y0 <= a.y0 + 1.0 GROUP BY 1""",
    ),
    "g7_disjoint": (
        g7_disjoint,
        f"""WITH b AS (SELECT c_custkey AS id, {_BOX.format(k='c_custkey')} FROM customer), a AS (SELECT s_suppkey AS id, {_BOX.format(k='s_suppkey')} FROM supplier WHERE s_suppkey % 20 = 0)
        SELECT a.id AS a_id, count(*) AS n FROM a, b WHERE NOT (a.x0 <= b.x0 + 1.5 AND b.x0 <= a.x0 + 40 AND a.y0 <= b.y0 + 3 AND b.y0 <= a.y0 + 80) GROUP BY 1""",
    ),
    "a13_percentiles": (
        a13_percentiles,
        "WITH l AS (SELECT l_returnflag AS flag, l_extendedprice AS p FROM lineitem UNION ALL SELECT 'all', l_extendedprice FROM lineitem) SELECT flag, f::DOUBLE AS fraction, round(CASE f WHEN 0.25 THEN quantile_cont(p, 0.25) WHEN 0.5 THEN quantile_cont(p, 0.5) ELSE quantile_cont(p, 0.75) END, 4) AS value FROM l, (VALUES (0.25), (0.5), (0.75)) v(f) GROUP BY flag, f",
    ),
    "m24_match_natural": (m24_match_natural, _WORDS.format(text="text") + " SELECT doc_id, round(sum(x), 6) AS rank FROM r WHERE w IN ('this', 'ther', 'anea') GROUP BY 1"),
    "m24_match_boolean": (
        m24_match_boolean,
        _WORDS.format(text="concat_ws(' ', source, text)")
        + """, q AS (SELECT d.doc_id, len(list_filter(range(1, len(w)), lambda i: w[i] = 'of' AND w[i + 1] = 'the')) > 0 AS phrase FROM d WHERE list_contains(w, 'the') AND NOT list_contains(w, 'this'))
        SELECT q.doc_id, round(coalesce(sum(x) FILTER (WHERE w = 'the'), 0) + coalesce(sum(x) FILTER (WHERE phrase AND w IN ('of', 'the')), 0) + coalesce(sum(x) FILTER (WHERE w LIKE 'tion%'), 0) + coalesce(sum(x) FILTER (WHERE w = 'anea'), 0), 6) AS rank FROM q JOIN r USING (doc_id) GROUP BY 1""",
    ),
    "s3_load_many": (
        s3_load_many,
        " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n_rows, 'table-{t}' AS pool FROM {t}" for t in ("orders", "lineitem", "customer", "events")),
    ),
    "m4_truncate": (
        m4_truncate,
        "SELECT l_orderkey, l_linenumber, trunc(round(l_discount * 100, 6)) / 100 AS discount, -trunc(round(l_extendedprice * 10, 6)) / 10 AS one, trunc(l_extendedprice / 100) * 100 AS hundreds, (trunc(round(l_extendedprice * 10, 6)) / 10)::DECIMAL(12,2)::VARCHAR AS exact FROM lineitem",
    ),
    "q10_styles": (q10_styles, "SELECT o_orderkey, " + ", ".join(f"strftime(o_orderdate, '{f}') AS s{s}" for s, f in _STYLES.items()) + " FROM orders"),
    "l8_collations": (
        l8_collations,
        "WITH w AS (SELECT unnest(regexp_split_to_array(text, '[^\\p{L}]+')) AS w FROM documents), g AS (SELECT w, count(*) AS n FROM w WHERE w <> '' GROUP BY 1) SELECT min(lower(w)) AS form, count(*) AS n_forms, sum(n)::BIGINT AS n_words FROM g GROUP BY replace(strip_accents(lower(w)), 'ß', 'ss')",
    ),
}
