"""Queries of sources, cleaning, selection, partition routing and writing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrywright.functions import cleaning, types
from ferrywright.operators import partitioning, selection
from ferrywright.plans.tables import table
from ferrywright.sources import readers, writers


def s2_split_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each of eight readers' parts of orders."""
    o = table(spark, sf_dir, "orders")
    parts = [o.where(p).agg(F.count(F.lit(1)).alias("n_rows"), F.min("o_orderkey").alias("low")).select(F.lit(i).alias("part"), "n_rows", "low") for i, p in enumerate(readers.split_predicates("o_orderkey", 8))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def s8_versions_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as versions that last 90 days, as of one moment."""
    o = table(spark, sf_dir, "orders").withColumns({"valid_from": F.col("o_orderdate"), "valid_to": F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate") + F.expr("interval 90 days"))})
    return readers.versions_as_of(o, F.lit("1996-06-01").cast("timestamp")).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"))


def k3_insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    fresh = o.where("o_orderkey % 4 = 0").withColumns({"o_orderkey": F.when(F.col("o_orderkey") % 8 == 0, F.col("o_orderkey") + 20000000).otherwise(F.col("o_orderkey")), "o_orderstatus": F.lit("X")})
    return writers.load_ignoring(fresh.unionByName(fresh), o, ["o_orderkey"])


def k5_replace_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return writers.load(c.where("c_acctbal < 0").withColumn("c_mktsegment", F.lit("DEBT")), c, delete="c_acctbal < 0 or c_mktsegment = 'BUILDING'")


def k7_split_bad_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of events that do not cast, by the columns at fault."""
    e = table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 10 == 0, F.concat(F.col("user_id").cast("string"), F.lit("x"))).otherwise(F.col("user_id").cast("string")).alias("user_id"), F.when(F.col("event_id") % 15 == 0, "n/a").otherwise("1").alias("flag"))
    good, bad = writers.split_bad_rows(e, {"user_id": "bigint", "flag": "int"})
    return bad.groupBy("bad_columns").agg(F.count(F.lit(1)).alias("n_rows")).unionByName(good.agg(F.lit("").alias("bad_columns"), F.count(F.lit(1)).alias("n_rows")))


def k9_route_by_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    small, big = writers.route_by_size(table(spark, sf_dir, "pages"), "html", 8000)
    told = lambda df, name: df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(F.octet_length("html")), F.lit(0)).cast("long").alias("n_bytes")).select(F.lit(name).alias("route"), "n_rows", "n_bytes")
    return told(small, "first").unionByName(told(big, "second"))


def p_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep, drop and rename columns."""
    c = cleaning.drop_columns(cleaning.keep_columns(table(spark, sf_dir, "customer"), ["C_CUSTKEY", "c_name", "c_nationkey", "c_acctbal"]), ["C_ACCTBAL"])
    return cleaning.rename(c, {"c_custkey": "id", "c_name": "full_name"})


def p4_booleans(spark: SparkSession, sf_dir: str) -> DataFrame:
    word = F.element_at(F.array(*map(F.lit, ["Yes", "n", " 1 ", "FALSE", "enabled", "maybe", "Off"])), (F.col("event_id") % 7 + 1).cast("int"))
    e = table(spark, sf_dir, "events").select(cleaning.as_boolean(word, extra_false=["off"]).alias("flag"))
    return e.groupBy("flag").agg(F.count(F.lit(1)).alias("n_rows"))


def p5_dates_and_empties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zero dates, two-digit years and empty texts."""
    o = table(spark, sf_dir, "orders")
    text = F.when(F.col("o_orderkey") % 9 == 0, "0000-00-00 00:00:00").when(F.col("o_orderkey") % 9 == 1, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    d = o.select("o_orderkey", cleaning.fix_zero_date(text, "1970-01-01").alias("d"), cleaning.fix_century((F.col("o_orderkey") % 100).cast("int")).alias("y"), cleaning.is_null_or_empty(text).alias("empty"))
    return d.groupBy("y", "empty").agg(F.count("d").alias("n_dates"), F.min("d").alias("first_date"))


def p6_transform_and_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    p = cleaning.transform_values(p, {"p_size": "p_size * 2 + 1", "p_brand": cleaning.trim_char(F.concat(F.lit("##"), F.col("p_brand"), F.lit("#")), "both", "#")})
    return cleaning.add_generated(p, {"area": "p_size * p_size", "half": "area / 2"})


def p7_modify_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", F.regexp_replace("p_type", " ", ",").alias("p_type"), F.col("p_size").cast("string").alias("p_size"))
    return cleaning.modify_type(p, {"p_type": "array<string>", "p_size": "int"}).select("p_partkey", F.size("p_type").alias("n_words"), F.get("p_type", F.lit(0)).alias("first_word"), "p_size")


def p8_map_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog of number columns, one per part, mapped to Spark types."""
    c = table(spark, sf_dir, "part").select(
        F.element_at(F.array(*map(F.lit, ["NUMBER", "VARCHAR2(30)", "RAW", "DATE", "FLOAT"])), (F.col("p_partkey") % 5 + 1).cast("int")).alias("data_type"), F.when(F.col("p_partkey") % 3 != 0, F.col("p_size") % 40 + 1).cast("int").alias("data_precision"),
        F.when(F.col("p_partkey") % 2 == 0, 2).otherwise(0).alias("data_scale"), F.lit(16).alias("data_length"),
    )
    return types.map_types(c).groupBy("data_type", "spark_type", "needs_review").agg(F.count(F.lit(1)).alias("n_columns"))


def p15_uuid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select("c_custkey", cleaning.raw_to_uuid(F.unhex(F.md5(F.col("c_name").cast("binary")))).alias("uid"))


def p22_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.nullif("o_orderstatus", F.lit("P")).alias("old"), F.when(F.col("o_orderkey") % 3 == 0, F.lit("P")).otherwise(F.nullif("o_orderstatus", F.lit("O"))).alias("new"))
    return o.where(cleaning.changed(F.col("old"), F.nullif("new", F.lit("P")))).groupBy("old", "new").agg(F.count(F.lit(1)).alias("n_rows"))


def p20_unaccent(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Accents are taken off distinct words, each once, and not off whole texts.
    words = table(spark, sf_dir, "documents").select(F.explode(F.split("text", r"[^\p{L}\p{N}\p{M}]+")).alias("raw")).groupBy("raw").agg(F.count(F.lit(1)).alias("n"))
    plain = words.select(F.explode(F.split(cleaning.unaccent(F.col("raw")), r"[^a-z0-9]+")).alias("word"), "n").where("word <> ''")
    return plain.groupBy("word").agg(F.sum("n").alias("n"))


def f1_where_clauses(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = selection.where_clauses({n: table(spark, sf_dir, n) for n in ("orders", "lineitem")}, {"orders": "o_totalprice > 1000", "lineitem": "l_quantity < 25"})
    from ferrywright.operators.relational import count_rows

    return count_rows(kept)


def f2_select_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "part").select(F.upper(F.regexp_replace("p_name", " ", "_")).alias("object_name"), "p_partkey")
    return selection.select_objects(c, ["[a-m].*", "!.*E"], [".*[0-4]"]).select("p_partkey", "object_name")


def f7_regexp_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    flags = {"plain": None, "nocase": "i", "lines": "m", "dot": "n"}
    return d.select("doc_id", *[selection.regexp_like(F.col("text"), "^the.*and", f).alias(n) for n, f in flags.items()])


def r1_range_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = partitioning.range_partition(table(spark, sf_dir, "orders"), "orders", ["o_totalprice"], [[50000.0], [100000.0], [200000.0]])
    return o.groupBy("partition_name").agg(F.count(F.lit(1)).alias("n_rows"), F.min("o_totalprice").alias("low"))


def r2_list_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = partitioning.list_partition(table(spark, sf_dir, "customer"), "customer", "c_mktsegment", [["BUILDING", "MACHINERY"], ["HOUSEHOLD"]])
    return c.groupBy("partition_name").agg(F.count(F.lit(1)).alias("n_rows"))


def r3_hash_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partitioning.hash_partition(table(spark, sf_dir, "orders"), "orders", ["o_custkey"], 6, modulo=True).groupBy("partition_name").agg(F.count(F.lit(1)).alias("n_rows"))


def r4_reference_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    parent = partitioning.range_partition(table(spark, sf_dir, "orders"), "orders", ["o_totalprice"], [[50000.0], [100000.0], [200000.0]])
    child = partitioning.reference_partition(table(spark, sf_dir, "lineitem"), parent, "l_orderkey", "o_orderkey", "lineitem", "orders")
    return child.groupBy("partition_name").agg(F.count(F.lit(1)).alias("n_rows"))


def r5_sub_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    outer = partitioning.range_position([F.col("o_totalprice")], [[100000.0], [None]])
    inner = partitioning.list_position(F.col("o_orderstatus"), [["F"], ["O"]])
    return partitioning.sub_partition(table(spark, sf_dir, "orders"), "orders", outer, inner).groupBy("partition_name").agg(F.count(F.lit(1)).alias("n_rows"))


QUERIES = {
    "s2_split_predicates": (s2_split_predicates, "SELECT (o_orderkey % 8)::INT AS part, count(*) AS n_rows, min(o_orderkey) AS low FROM orders GROUP BY 1"),
    "s8_versions_as_of": (
        s8_versions_as_of,
        "SELECT o_orderstatus, count(*) AS n_rows FROM orders WHERE o_orderdate <= TIMESTAMP '1996-06-01' AND (o_orderkey % 5 = 0 OR o_orderdate + INTERVAL 90 DAY > TIMESTAMP '1996-06-01') GROUP BY 1",
    ),
    "k3_insert_ignore": (k3_insert_ignore, "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders UNION ALL SELECT o_orderkey + 20000000, o_custkey, 'X' FROM orders WHERE o_orderkey % 8 = 0"),
    "k5_replace_where": (
        k5_replace_where,
        "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer WHERE NOT (c_acctbal < 0 OR c_mktsegment = 'BUILDING') UNION ALL SELECT c_custkey, 'DEBT', c_acctbal FROM customer WHERE c_acctbal < 0",
    ),
    "k7_split_bad_rows": (
        k7_split_bad_rows,
        "SELECT CASE WHEN event_id % 30 = 0 THEN 'user_id,flag' WHEN event_id % 10 = 0 THEN 'user_id' WHEN event_id % 15 = 0 THEN 'flag' ELSE '' END AS bad_columns, count(*) AS n_rows FROM events GROUP BY 1",
    ),
    "k9_route_by_size": (
        k9_route_by_size,
        "SELECT r AS route, count(b) AS n_rows, coalesce(sum(b), 0)::BIGINT AS n_bytes FROM (VALUES ('first'), ('second')) v(r) LEFT JOIN (SELECT strlen(html) AS b FROM pages) p ON (b > 8000) = (r = 'second') GROUP BY 1",
    ),
    "p_projection": (p_projection, "SELECT c_custkey AS id, c_name AS full_name, c_nationkey FROM customer"),
    "p4_booleans": (
        p4_booleans,
        "SELECT CASE event_id % 7 WHEN 0 THEN true WHEN 2 THEN true WHEN 4 THEN true WHEN 5 THEN NULL ELSE false END AS flag, count(*) AS n_rows FROM events GROUP BY 1",
    ),
    "p5_dates_and_empties": (
        p5_dates_and_empties,
        """SELECT CASE WHEN o_orderkey % 100 < 49 THEN o_orderkey % 100 + 2000 ELSE o_orderkey % 100 + 1900 END::INT AS y, o_orderkey % 9 = 1 AS empty, count(d) AS n_dates, min(d) AS first_date
        FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN TIMESTAMP '1970-01-01' WHEN o_orderkey % 9 = 1 THEN NULL ELSE date_trunc('second', o_orderdate) END AS d FROM orders) GROUP BY 1, 2""",
    ),
    "p6_transform_and_trim": (p6_transform_and_trim, "SELECT p_partkey, p_name, p_brand, p_size * 2 + 1 AS p_size, (p_size * 2 + 1) * (p_size * 2 + 1) AS area, (p_size * 2 + 1) * (p_size * 2 + 1) / 2.0::DOUBLE AS half FROM part"),
    "p7_modify_type": (p7_modify_type, "SELECT p_partkey, len(string_split(p_type, ' '))::INT AS n_words, string_split(p_type, ' ')[1] AS first_word, p_size FROM part"),
    "p8_map_types": (
        p8_map_types,
        """WITH c AS (SELECT ['NUMBER', 'VARCHAR2(30)', 'RAW', 'DATE', 'FLOAT'][(p_partkey % 5 + 1)::INT] AS data_type, CASE WHEN p_partkey % 3 <> 0 THEN p_size % 40 + 1 END AS p, CASE WHEN p_partkey % 2 = 0 THEN 2 ELSE 0 END AS s FROM part)
        SELECT data_type, CASE data_type WHEN 'RAW' THEN 'string' WHEN 'DATE' THEN 'timestamp_ntz' WHEN 'FLOAT' THEN 'double' WHEN 'NUMBER' THEN
        CASE WHEN p IS NULL THEN 'bigint' WHEN s = 0 AND p < 5 THEN 'smallint' WHEN s = 0 AND p <= 9 THEN 'int' WHEN s = 0 AND p < 19 THEN 'bigint' WHEN s = 0 THEN 'decimal(' || least(p, 38) || ',0)' WHEN s > p THEN 'decimal(38,' || s || ')' WHEN p <= 6 THEN 'float'
        WHEN p <= 15 THEN 'double' ELSE 'decimal(' || least(p, 38) || ',' || s || ')' END ELSE 'string' END AS spark_type, data_type = 'NUMBER' AND p IS NULL AS needs_review, count(*) AS n_columns FROM c GROUP BY 1, 2, 3""",
    ),
    "p15_uuid": (
        p15_uuid,
        "SELECT c_custkey, substr(m, 1, 8) || '-' || substr(m, 9, 4) || '-' || substr(m, 13, 4) || '-' || substr(m, 17, 4) || '-' || substr(m, 21) AS uid FROM (SELECT c_custkey, md5(c_name) AS m FROM customer)",
    ),
    "p22_changed": (
        p22_changed,
        """SELECT old, new, count(*) AS n_rows FROM (SELECT nullif(o_orderstatus, 'P') AS old, CASE WHEN o_orderkey % 3 = 0 THEN 'P' ELSE nullif(o_orderstatus, 'O') END AS new FROM orders)
        WHERE old IS DISTINCT FROM nullif(new, 'P') GROUP BY 1, 2""",
    ),
    "p20_unaccent": (
        p20_unaccent,
        f"SELECT w AS word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(lower(translate(text, '{cleaning.ACCENTED}', '{cleaning.PLAIN}')), '[^a-z0-9]+')) AS w FROM documents) WHERE w <> '' GROUP BY 1",
    ),
    "f1_where_clauses": (
        f1_where_clauses,
        "SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders WHERE o_totalprice > 1000 UNION ALL SELECT 'lineitem', count(*) FROM lineitem WHERE l_quantity < 25",
    ),
    "f2_select_objects": (
        f2_select_objects,
        r"SELECT p_partkey, n AS object_name FROM (SELECT p_partkey, upper(replace(p_name, ' ', '_')) AS n FROM part) WHERE regexp_full_match(n, '[A-M].*') AND NOT n LIKE '%E' AND NOT regexp_full_match(n, '.*[0-4]')",
    ),
    "f7_regexp_flags": (
        f7_regexp_flags,
        "SELECT doc_id, regexp_matches(text, '^the.*and') AS plain, regexp_matches(text, '(?i)^the.*and') AS nocase, regexp_matches(text, '(?m)^the.*and') AS lines, regexp_matches(text, '(?s)^the.*and') AS dot FROM documents",
    ),
    "r1_range_partition": (
        r1_range_partition,
        "SELECT CASE WHEN o_totalprice < 50000 THEN 'orders_part1' WHEN o_totalprice < 100000 THEN 'orders_part2' WHEN o_totalprice < 200000 THEN 'orders_part3' ELSE 'orders_part_default' END AS partition_name, count(*) AS n_rows, min(o_totalprice) AS low FROM orders GROUP BY 1",
    ),
    "r2_list_partition": (
        r2_list_partition,
        "SELECT CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'customer_part1' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'customer_part2' ELSE 'customer_part_default' END AS partition_name, count(*) AS n_rows FROM customer GROUP BY 1",
    ),
    "r3_hash_partition": (r3_hash_partition, "SELECT 'orders_part' || (o_custkey % 6 + 1) AS partition_name, count(*) AS n_rows FROM orders GROUP BY 1"),
    "r4_reference_partition": (
        r4_reference_partition,
        """SELECT CASE WHEN o_totalprice < 50000 THEN 'lineitem_part1' WHEN o_totalprice < 100000 THEN 'lineitem_part2' WHEN o_totalprice < 200000 THEN 'lineitem_part3' ELSE 'lineitem_part_default' END AS partition_name, count(*) AS n_rows
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    ),
    "r5_sub_partition": (
        r5_sub_partition,
        "SELECT 'orders_part' || CASE WHEN o_totalprice < 100000 THEN 1 ELSE 2 END || CASE o_orderstatus WHEN 'F' THEN '_subpart1' WHEN 'O' THEN '_subpart2' ELSE '' END AS partition_name, count(*) AS n_rows FROM orders GROUP BY 1",
    ),
}
