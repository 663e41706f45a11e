"""Queries of operators that had none: current time, theta joins, roots without START WITH, hooks, type overrides, snapshots, table functions, chunks, remarks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrywright.functions import cleaning, mysql, oracle, tsql, types
from ferrywright.operators import diffing, hierarchy, relational, selection
from ferrywright.plans import assessment
from ferrywright.plans.tables import NEW_ORDERS_SQL, new_orders, order_catalog, order_code, table
from ferrywright.scratch import folder
from ferrywright.sources import readers, writers


def o7_current_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SYSDATE, NOW, GETDATE and their kin against the moment itself, within a minute; and their precisions."""
    near = lambda c: F.abs(F.unix_micros(c) - F.unix_micros(F.current_timestamp())) < 60_000_000
    now = {
        "sysdate": oracle.sysdate(), "systimestamp": oracle.systimestamp(), "now": mysql.now(), "utc_timestamp": mysql.utc_timestamp("UTC"), "getdate": tsql.getdate(), "getutcdate": tsql.getutcdate("UTC"), "sysdatetime": tsql.sysdatetime(),
        "yesterday": oracle.sysdate(-1) + F.expr("interval 1 day"), "half_day": oracle.sysdate(0.5) - F.expr("interval 12 hours"),
    }
    whole = {"sysdate_seconds": F.unix_micros(oracle.sysdate()) % 1_000_000 == 0, "now_seconds": F.unix_micros(mysql.now()) % 1_000_000 == 0, "getdate_millis": F.unix_micros(tsql.getdate()) % 1000 == 0}
    dates = {"curdate": mysql.curdate() == F.current_date(), "curtime": mysql.curtime().rlike("^[0-2][0-9]:[0-5][0-9]:[0-5][0-9]$")}
    return table(spark, sf_dir, "nation").select("n_nationkey", *[near(c).alias(n) for n, c in now.items()], *[c.alias(n) for n, c in {**whole, **dates}.items()])


def o13_trim_and_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TRIM, REPLACE with two arguments and three, over padded names."""
    c = table(spark, sf_dir, "customer").withColumn("t", F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))
    return c.select("c_custkey", oracle.trim(F.col("t")).alias("trimmed"), oracle.replace(F.col("c_name"), "0").alias("gone"), oracle.replace(F.col("c_name"), "#", "no. ").alias("other"))


def j3_theta_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marked joins by comparisons other than equality: each nation with the regions of smaller names, and with those that its name is not like."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    less = relational.outer_plus(n, r, (F.col("r_name") < F.col("n_name")) & (F.col("n_regionkey") != F.col("r_regionkey"))).groupBy("n_nationkey").agg(F.count("r_regionkey").alias("n"))
    unlike = relational.outer_plus(n, r, ~F.col("n_name").like("A%") & (F.col("n_nationkey") >= F.col("r_regionkey") * 5)).groupBy("n_nationkey").agg(F.count("r_regionkey").alias("n"))
    return less.withColumn("form", F.lit("less")).unionByName(unlike.withColumn("form", F.lit("unlike")))


def h6_every_row_a_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CONNECT BY without START WITH: the nodes below each part, by level."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") >= 10, F.floor(F.col("p_partkey") / 10).cast("long")).alias("up"))
    return hierarchy.connect_by(p, "p_partkey", "up").groupBy("level").agg(F.count(F.lit(1)).alias("n"), F.sum("p_partkey").alias("keys")).select(F.col("level").cast("long").alias("level"), "n", "keys")


def x3_diff_hooks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A diff applied with functions before, after, and after all, which report what they were given."""
    old, new = table(spark, sf_dir, "orders"), new_orders(spark, sf_dir)
    diff = diffing.datadiff_by_key(old, new, ["o_orderkey"])
    told: dict[str, DataFrame] = {}

    def note(name: str):
        return lambda target, gone, changed, fresh: told.update({f"{name}_{k}": df for k, df in (("target", target), ("del", gone), ("upd", changed), ("ins", fresh))})

    diffing.apply_diff(old, diff, ["o_orderkey"], before=note("before"), after=note("after"), after_all=lambda out: told.update(all=out))
    return relational.count_rows(told)


def x4_type_overrides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types of a catalog, a row per line, with two of them mapped otherwise."""
    l, names = table(spark, sf_dir, "lineitem"), ("VARCHAR2", "NUMBER", "DATE", "BINARY_DOUBLE")  # noqa: E741
    kind = F.element_at(F.array(*map(F.lit, names)), (F.col("l_linenumber") % 4 + 1).cast("int"))
    catalog = l.select(kind.alias("data_type"), F.lit(10).alias("data_length"), F.lit(8).alias("data_precision"), F.lit(2).alias("data_scale"))
    return types.map_types(catalog, "oracle", {"DATE": "date", "BINARY_DOUBLE": "decimal(20,5)"}).groupBy("data_type", "spark_type").agg(F.count(F.lit(1)).alias("n"))


def x5_running_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A function that returns a row per event of a user, with what came before it: its number and the running sum."""

    class Running:
        def __init__(self):
            self.n, self.total = 0, 0

        def eval(self, row):
            self.n += 1
            self.total += row["cents"]
            yield row["event_id"], row["user_id"], self.n, self.total

    e = table(spark, sf_dir, "events").select("event_id", "user_id", F.round(F.coalesce("value", F.lit(0.0)) * 100).cast("long").alias("cents"))
    return relational.pipe_partitions(e, Running, "event_id long, user_id long, n long, total long", ["user_id"], ["event_id"])


def a15_category_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An aggregate view exported as a table: number, least and greatest by category."""
    name = f"categories_{uuid.uuid4().hex}"
    relational.category_summary(table(spark, sf_dir, "part"), "p_type", "p_retailprice").createOrReplaceTempView(name)
    return spark.table(name)


def k8_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot refreshed, left as it is for a source of the same version, and refreshed again while a reader has the one before."""
    own = uuid.uuid4().hex[:12]
    name, view, registry = f"snapshot_{own}", f"source_{own}", f"registry_{own}"
    orders = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    orders.createOrReplaceTempView(view)
    first = writers.refresh_snapshot(spark, name, view, registry, "v1")
    before = spark.table(name)
    orders.where("o_orderpriority < '3'").createOrReplaceTempView(view)
    kept = writers.refresh_snapshot(spark, name, view, registry, "v1")
    second = writers.refresh_snapshot(spark, name, view, registry, "v2")
    parts = [before.select(F.lit("before").alias("reader"), "o_orderpriority", "n"), spark.table(name).select(F.lit("after").alias("reader"), "o_orderpriority", "n")]
    noted = writers.snapshot_registry(spark, registry).where(F.col("name") == name).select(F.lit("registry").alias("reader"), F.col("source_version").alias("o_orderpriority"), F.col("refresh").alias("n"))
    steps = spark.createDataFrame([("steps", f"{first}{kept}{second}", first + kept + second)], "reader string, o_orderpriority string, n long")
    return parts[0].unionByName(parts[1]).unionByName(noted).unionByName(steps)


def k9_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages cut into chunks of 1000 bytes, written, and put together again one chunk at a time."""
    path = folder(spark, "chunks")
    pages = table(spark, sf_dir, "pages").select("page_id", F.encode("html", "UTF-8").alias("html"))
    writers.to_chunks(pages, ["page_id"], "html", 1000).write.parquet(path)
    return writers.digest_chunks(spark.read.parquet(path), ["page_id"])


def k9_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes 990 to 2020 of every page, read from the two or three chunks that have them."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.encode("html", "UTF-8").alias("html"))
    wanted = pages.select("page_id", F.lit(990).alias("offset"), F.lit(1030).alias("length"))
    parts = writers.read_ranges(writers.to_chunks(pages, ["page_id"], "html", 1000), wanted, ["page_id"])
    return parts.groupBy("page_id").agg(F.sum(F.octet_length("part")).cast("long").alias("n_bytes"), F.hex(F.max_by("part", "start")).alias("tail"), F.count(F.lit(1)).alias("n_parts"))


def e8_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report with remarks on what costs most."""
    details = assessment.score_details(order_code(spark, sf_dir), "oracle", ("object_type", "name"))
    report = assessment.assessment_report(order_catalog(spark, sf_dir), None, "oracle", details=details)
    return assessment.with_comments(report, details).where("object_type is not null").select("object_type", "n_objects", "comment")


def s7_view_as_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view written as a table, sampled by the row cap of a trial load, and a catalog put in processing order."""
    own = uuid.uuid4().hex[:12]
    table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("n")).createOrReplaceTempView(f"flags_{own}")
    flags = readers.view_as_table(spark, f"flags_{own}", f"flags_table_{own}")
    return flags.unionByName(readers.sample_rows(table(spark, sf_dir, "orders"), 7).agg(F.lit("capped").alias("l_returnflag"), F.count(F.lit(1)).alias("n")))


def s12_scan_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of databases, one per supplier, as a file, with host and service read off their names."""
    path, s = folder(spark, "scan-list"), table(spark, sf_dir, "supplier")
    dsn = F.concat(F.lit("dbi:mysql:host=h"), F.col("s_nationkey").cast("string"), F.lit(";database=d"), F.col("s_suppkey").cast("string"))
    rows = s.select(F.when(F.col("s_suppkey") % 3 != 0, "mysql").alias("type"), F.col("s_name").alias("schema"), dsn.alias("dsn"), F.lit("u").alias("user"), F.lit("p").alias("password"), F.lit(None).cast("string").alias("audit_user"))
    writers.write_report(rows, path)
    return readers.read_scan_list(spark, path).select("type", "schema", "host", "service")


def k4_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads that truncate, that delete by a condition, which goes before truncation, and that append; and an ordered catalog."""
    old, new = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_nationkey").alias("c_nationkey"))
    forms = {"truncate": writers.load(new, old, truncate=True), "delete": writers.load(new, old, truncate=True, delete="c_nationkey < 10"), "append": writers.load(new, old), "first": writers.load(new)}
    return relational.count_rows(forms)


def m23_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CONVERT USING, BINARY, RAND, NEXT VALUE FOR, and a composite as an array."""
    d = table(spark, sf_dir, "documents").select("doc_id", F.substring("text", 1, 200).alias("t"))
    d = d.select("doc_id", mysql.convert_using(F.col("t"), "latin1").alias("latin"), mysql.convert_using(F.col("t"), "ascii").alias("plain"), (mysql.binary(F.lower("t")) == mysql.binary(F.upper("t"))).alias("same"), mysql.rand(7).between(0, 1).alias("rand"), F.struct(F.col("doc_id").alias("a"), (F.col("doc_id") * 2).alias("b")).alias("pair"))
    d = cleaning.modify_type(d, {"pair": "array<string>"}).withColumn("pair", F.array_join("pair", "/"))
    return tsql.next_value_for(d, "number", 100, [F.desc("doc_id")], 5)


def s4_table_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers' tables in processing order by size, with their places."""
    catalog = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("table_name"), F.floor(F.abs("s_acctbal")).cast("long").alias("bytes"))
    return relational.with_rownum(selection.order_tables(catalog, "size"), [F.desc("bytes"), F.col("table_name")], "place")


def k10_throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables read, and read and transformed, with nothing written: their rows, and that the rate is theirs over the time."""
    l, d = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "documents")  # noqa: E741
    found = {"read": writers.throughput(l), "transformed": writers.throughput(d.withColumn("text", F.upper("text")))}
    rows = [(n, x["rows"], abs(x["rows_per_second"] * x["seconds"] - x["rows"]) < 1) for n, x in found.items()]
    return spark.createDataFrame(rows, "form string, n long, rate_fits boolean")


def c3_flashback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A versioned table as of a moment given by an expression, SYSDATE less some days, and the clause that asks a source for it."""
    last = F.lit("1998-08-02 00:00:00").cast("timestamp")
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderdate") + F.expr("interval 400 days")).alias("valid_to"))
    kept = readers.versions_as_of(o, oracle.date_plus(last, -500.25), "o_orderdate", "valid_to")
    return kept.select("o_orderkey", F.lit(readers.as_of_clause("oracle", timestamp="SYSDATE - 500.25")).alias("clause"))


def m24_binary_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """COMPRESS and back, INET_ATON and INET6_ATON and back, over pages and events."""
    p = table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), F.encode("html", "UTF-8").alias("v")).withColumn("c", mysql.compress(F.col("v")))
    packed = p.select(F.lit("compress").alias("form"), "id", F.sha2(mysql.uncompress(F.col("c")), 256).alias("text"), mysql.uncompressed_length(F.col("c")).alias("n"))
    k = F.col("event_id")
    dotted = F.concat_ws(".", *[(F.floor(k / d) % 256).cast("string") for d in (77, 5, 3, 1)])
    e = table(spark, sf_dir, "events").select(k.alias("id"), dotted.alias("four"), F.concat(F.lit("2001:db8::"), F.lower(F.hex(k % 65535 + 1))).alias("six"))
    four = e.select(F.lit("inet").alias("form"), "id", mysql.inet_ntoa(mysql.inet_aton(F.col("four"))).alias("text"), mysql.inet_aton(F.col("four")).alias("n"))
    bits = mysql.inet6_aton(F.col("six"))
    six = e.select(F.lit("inet6").alias("form"), "id", F.concat(F.hex(bits), F.lit(" "), mysql.inet6_ntoa(bits)).alias("text"), F.octet_length(bits).cast("long").alias("n"))
    bad = e.select(F.lit("none").alias("form"), "id", F.coalesce(mysql.inet6_ntoa(mysql.inet6_aton(F.concat("four", F.lit(":")))), F.hex(mysql.uncompress(F.lit("12345678").cast("binary")))).alias("text"), mysql.inet_aton(F.concat("four", F.lit(".1"))).alias("n"))
    return packed.unionByName(four).unionByName(six).unionByName(bad)


_NOW = "sysdate systimestamp now utc_timestamp getdate getutcdate sysdatetime yesterday half_day sysdate_seconds now_seconds getdate_millis curdate curtime".split()
_KIND = "CASE o_orderstatus WHEN 'F' THEN 'FUNCTION' WHEN 'O' THEN 'VIEW' ELSE 'TRIGGER' END"
QUERIES = {
    "o7_current_times": (o7_current_times, "SELECT n_nationkey, " + ", ".join(f"true AS {n}" for n in _NOW) + " FROM nation"),
    "o13_trim_and_replace": (o13_trim_and_replace, "SELECT c_custkey, trim('  ' || c_name || ' ') AS trimmed, replace(c_name, '0', '') AS gone, replace(c_name, '#', 'no. ') AS other FROM customer"),
    "j3_theta_outer": (
        j3_theta_outer,
        "SELECT n_nationkey, count(r_regionkey) AS n, 'less' AS form FROM nation LEFT JOIN region ON r_name < n_name AND n_regionkey <> r_regionkey GROUP BY 1 UNION ALL SELECT n_nationkey, count(r_regionkey), 'unlike' FROM nation LEFT JOIN region ON n_name NOT LIKE 'A%' AND n_nationkey >= r_regionkey * 5 GROUP BY 1",
    ),
    "h6_every_row_a_root": (
        h6_every_row_a_root,
        "WITH RECURSIVE t AS (SELECT p_partkey AS k, CASE WHEN p_partkey >= 10 THEN p_partkey // 10 END AS up FROM part), r AS (SELECT k, 1 AS level FROM t UNION ALL SELECT t.k, level + 1 FROM r JOIN t ON t.up = r.k) SELECT level::BIGINT AS level, count(*) AS n, sum(k)::BIGINT AS keys FROM r GROUP BY 1",
    ),
    "x3_diff_hooks": (
        x3_diff_hooks,
        f"""WITH n AS ({NEW_ORDERS_SQL}), c AS (SELECT (SELECT count(*) FROM orders) AS o, (SELECT count(*) FROM n) AS n, (SELECT count(*) FROM orders WHERE o_orderkey % 10 = 3) AS d, (SELECT count(*) FROM orders WHERE o_orderkey % 10 <> 3 AND o_orderkey % 7 = 0) AS u, (SELECT count(*) FROM orders WHERE o_orderkey % 50 = 0) AS i)
        SELECT unnest(['before_target', 'before_del', 'before_upd', 'before_ins', 'after_target', 'after_del', 'after_upd', 'after_ins', 'all']) AS table_name, unnest([o, d, u, i, n, d, u, i, n]) AS n_rows FROM c""",
    ),
    "x4_type_overrides": (
        x4_type_overrides,
        "SELECT ['VARCHAR2', 'NUMBER', 'DATE', 'BINARY_DOUBLE'][l_linenumber % 4 + 1] AS data_type, ['string', 'double', 'date', 'decimal(20,5)'][l_linenumber % 4 + 1] AS spark_type, count(*) AS n FROM lineitem GROUP BY ALL",
    ),
    "x5_running_rows": (
        x5_running_rows,
        "SELECT event_id, user_id, row_number() OVER w AS n, (sum(round(coalesce(value, 0) * 100)) OVER w)::BIGINT AS total FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
    ),
    "a15_category_summary": (a15_category_summary, "SELECT p_type AS category, count(*) AS n, min(p_retailprice) AS least, max(p_retailprice) AS greatest FROM part GROUP BY 1"),
    "k8_snapshots": (
        k8_snapshots,
        "WITH p AS (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1) SELECT 'before' AS reader, o_orderpriority, n FROM p UNION ALL SELECT 'after', o_orderpriority, n FROM p WHERE o_orderpriority < '3' UNION ALL SELECT DISTINCT 'registry', 'v2', 2 FROM orders UNION ALL SELECT DISTINCT 'steps', '112', 4 FROM orders",
    ),
    "k9_chunks": (k9_chunks, "SELECT page_id, strlen(html) AS n_bytes, sha256(html) AS sha256 FROM pages"),
    "k9_ranges": (
        k9_ranges,
        "SELECT page_id, least(strlen(html) - 990, 1030) AS n_bytes, hex(encode(html))[2 * greatest(990, (least(strlen(html), 2020) - 1) // 1000 * 1000) + 1:2 * least(strlen(html), 2020)] AS tail, (least(strlen(html), 2020) - 1) // 1000 + 1 AS n_parts FROM pages WHERE strlen(html) > 990",
    ),
    "e8_comments": (
        e8_comments,
        f"""WITH o AS (SELECT {_KIND} AS t, o_orderkey AS k FROM orders), c AS (SELECT t, count(*) AS n, count(*) FILTER (WHERE k % 3 = 0) AS n3, count(*) FILTER (WHERE k % 4 = 0) AS n4, count(*) FILTER (WHERE k % 5 = 0) AS n5 FROM o GROUP BY 1),
        d AS (SELECT t, unnest(['OUTER JOIN', 'ROWNUM', 'CONCAT', 'MERGE INTO', 'SAVEPOINT', 'TRUNC', 'CONNECT BY']) AS w, unnest([n, n, n, n3, n4, n4, n5]) AS n, unnest([2.0, 1, 0.1, 3, 1, 0.1, 3]) AS x FROM c), r AS (SELECT *, row_number() OVER (PARTITION BY t ORDER BY n * x DESC, w) AS i FROM d WHERE n > 0)
        SELECT c.t AS object_type, c.n AS n_objects, string_agg(r.w || ': ' || r.n, ', ' ORDER BY i) AS comment FROM c JOIN r ON r.t = c.t AND i <= 5 GROUP BY 1, 2""",
    ),
    "s7_view_as_table": (s7_view_as_table, "SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1 UNION ALL SELECT 'capped', least(7, count(*)) FROM orders"),
    "s12_scan_list": (s12_scan_list, "SELECT CASE WHEN s_suppkey % 3 <> 0 THEN 'MYSQL' ELSE 'ORACLE' END AS type, s_name AS schema, 'h' || s_nationkey AS host, 'd' || s_suppkey AS service FROM supplier"),
    "k4_truncate": (
        k4_truncate,
        "WITH c AS (SELECT (SELECT count(*) FROM customer) AS c, (SELECT count(*) FROM customer WHERE c_nationkey < 10) AS g, (SELECT count(*) FROM supplier) AS s) SELECT unnest(['truncate', 'delete', 'append', 'first']) AS table_name, unnest([s, c - g + s, c + s, s]) AS n_rows FROM c",
    ),
    "m23_conversions": (
        m23_conversions,
        "WITH d AS (SELECT doc_id, substr(text, 1, 200) AS t FROM documents) SELECT doc_id, regexp_replace(t, '[^\\x{00}-\\x{FF}]', '?', 'g') AS latin, regexp_replace(t, '[^\\x{00}-\\x{7F}]', '?', 'g') AS plain, lower(t) = upper(t) AS same, true AS rand, doc_id || '/' || doc_id * 2 AS pair, 100 + 5 * row_number() OVER (ORDER BY doc_id DESC) AS number FROM d",
    ),
    "m24_binary_forms": (
        m24_binary_forms,
        """WITH e AS (SELECT event_id AS id, event_id // 77 % 256 AS a, event_id // 5 % 256 AS b, event_id // 3 % 256 AS c, event_id % 256 AS d, event_id % 65535 + 1 AS k FROM events)
        SELECT 'compress' AS form, page_id AS id, sha256(html) AS text, strlen(html) AS n FROM pages UNION ALL SELECT 'inet', id, a || '.' || b || '.' || c || '.' || d, a * 16777216 + b * 65536 + c * 256 + d FROM e
        UNION ALL SELECT 'inet6', id, '20010DB8' || repeat('0', 20) || lpad(printf('%X', k), 4, '0') || ' 2001:db8::' || printf('%x', k), 16 FROM e UNION ALL SELECT 'none', id, NULL, NULL FROM e""",
    ),
    "k10_throughput": (k10_throughput, "SELECT 'read' AS form, count(*) AS n, true AS rate_fits FROM lineitem UNION ALL SELECT 'transformed', count(*), true FROM documents"),
    "c3_flashback": (
        c3_flashback,
        "SELECT o_orderkey, 'AS OF TIMESTAMP SYSDATE - 500.25' AS clause FROM orders WHERE o_orderdate <= TIMESTAMP '1998-08-02' - INTERVAL 12006 HOUR AND (o_orderkey % 3 <> 0 OR o_orderdate + INTERVAL 400 DAY > TIMESTAMP '1998-08-02' - INTERVAL 12006 HOUR)",
    ),
    "s4_table_order": (s4_table_order, "SELECT s_name AS table_name, floor(abs(s_acctbal))::BIGINT AS bytes, row_number() OVER (ORDER BY floor(abs(s_acctbal)) DESC, s_name) AS place FROM supplier"),
}
