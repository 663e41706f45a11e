"""Queries of the operators and dialect functions that the other modules' queries leave out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrywright.functions import cleaning, mysql, oracle, tsql, types
from ferrywright.operators import geometry, hierarchy, partitioning, relational, selection, validation
from ferrywright.plans import assessment
from ferrywright.plans.tables import new_orders, order_catalog, table
from ferrywright.scratch import folder
from ferrywright.sources import readers, writers


def _long(c):
    return c.cast("long")


def k1_bulk_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as gzipped delimited files and back."""
    path = folder(spark, "bulk")
    writers.write_bulk(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment"), path, compression="gzip")
    return readers.read_external(spark, path, schema="c_custkey long, c_name string, c_mktsegment string", header=True)


def k4_table_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables in folders: written, then skipped because they are there, then overwritten."""
    path = folder(spark, "tables")
    c, s = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), table(spark, sf_dir, "supplier").select("s_suppkey")
    writers.write_tables({"kept": c, "fresh": s}, path)
    writers.write_tables({"kept": c.where("c_nationkey < 5")}, path)
    writers.write_tables({"fresh": s.where("s_suppkey > 10")}, path, "overwrite")
    return relational.count_rows({n: spark.read.parquet(f"{path}/{n}") for n in ("kept", "fresh")})


def r8_partition_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written in partition folders; named partitions are read, by pruning."""
    path = folder(spark, "partitions")
    partitioning.write_partitions(partitioning.range_partition(table(spark, sf_dir, "orders"), "orders", ["o_totalprice"], [[50000.0], [100000.0], [200000.0]]), path)
    kept = readers.read_partitions(spark.read.parquet(path), ["orders_part.*"], [".*part2"])
    return partitioning.merge_partitions(kept).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"), F.min("o_totalprice").alias("low"))


def s10_binary_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of customers in files of their own, whose contents replace their names."""
    path = folder(spark, "bfiles")
    table(spark, sf_dir, "customer").select("c_mktsegment", F.col("c_mktsegment").alias("value")).distinct().repartition("c_mktsegment").write.partitionBy("c_mktsegment").text(path)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.regexp_extract("path", "(c_mktsegment=[^/]*/[^/]*)$", 1).alias("file"))
    named = files.withColumn("content", F.col("file"))
    parts = readers.resolve_bfile(named, "file", "parts").select(F.col("file.directory").alias("directory"), "content")
    return readers.resolve_bfile(parts, "content", "content", path).select("directory", F.trim(F.regexp_replace(F.decode("content", "UTF-8"), "\n", "")).alias("text"))


def s13_code_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts of items as files of code, read whole and scored."""
    path = folder(spark, "code")
    table(spark, sf_dir, "benchmark").select((F.col("item_id") % 4).cast("string").alias("part"), F.concat(F.lit("ROWNUM "), F.col("item_id").cast("string")).alias("value")).repartition("part").write.partitionBy("part").text(path)
    code = readers.read_code(spark, [f"{path}/part=*"]).withColumns({"db": F.lit("d"), "object_type": F.lit("FUNCTION")})
    return assessment.score_details(code, by=("db", "object_type")).where("keyword = 'ROWNUM'").select("keyword", "n", "cost")


def s7_views_and_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A view of spend in priorities as its rows, and counts of it with the table's (V3)."""
    spend = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n_orders"))
    return validation.test_view({"spend": spend, "orders": table(spark, sf_dir, "orders")}, {"spend": spend.where("n_orders > 0"), "orders": new_orders(spark, sf_dir)})


def a7_column_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns per table of a catalog that has a column per line of an order, and partitions by method (A8)."""
    c = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("t"), F.col("l_orderkey").cast("string")).alias("table_name"), "l_linenumber")
    return relational.column_counts(c).groupBy("n_columns").agg(F.count(F.lit(1)).alias("n_tables"))


def a8_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions of tables by method, with totals."""
    p = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("method"), F.concat(F.lit("t"), (F.col("l_partkey") % 50).cast("string")).alias("table_name"), (F.col("l_suppkey") % 7).alias("position"))
    return partitioning.partition_counts(p).where("table_name is null").select("method", "n_parts")


def a8_subpartition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sub-partitions by table and partition, rolled up."""
    p = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("table_name"), (F.col("l_partkey") % 5).alias("position"), (F.col("l_suppkey") % 9).alias("sub_position"))
    return partitioning.subpartition_counts(p)


def r4_reference_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in the partitions that their orders have by hash."""
    return partitioning.reference_by_hash(table(spark, sf_dir, "lineitem"), "lineitem", "l_orderkey", 6, modulo=True).groupBy("partition_name").agg(F.count(F.lit(1)).alias("n_rows"))


def a9_schema_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assessment.schema_size(table(spark, sf_dir, "pages").select(F.concat(F.lit("s"), (F.col("page_id") % 5).cast("string")).alias("owner"), (_long(F.octet_length("html")) * 1048576).alias("bytes")))


def a11_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UNIQUE pairs, with the distinct values of each as an array (A12)."""
    o = table(spark, sf_dir, "orders")
    pairs = relational.distinct(o, ["o_orderstatus", "o_orderpriority"])
    return pairs.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_pairs"), F.array_join(relational.array_agg_distinct("o_orderpriority"), ";").alias("priorities"))


def e13_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assessment.kind_counts(order_catalog(spark, sf_dir), "status")


def e11_show_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of a catalog, some of them reserved words, mapped in two dialects (P8)."""
    name = F.element_at(F.array(*map(F.lit, ["user", "ORDER", "amount", "label"])), (F.col("p_partkey") % 4 + 1).cast("int"))
    c = table(spark, sf_dir, "part").select(name.alias("column_name"), F.lit("DATE").alias("data_type"), F.lit(None).cast("int").alias("data_precision"), F.lit(None).cast("int").alias("data_scale"), F.lit(None).cast("int").alias("data_length"))
    return assessment.show_columns(c).groupBy("column_name", "reserved_word").agg(F.count(F.lit(1)).alias("n_columns"))


def f4_object_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed filters, schemas left out, and objects by status."""
    c = order_catalog(spark, sf_dir).withColumn("owner", F.when(F.col("db") == "5-LOW", "SYS").otherwise(F.col("db")))
    kept = selection.by_status(selection.exclude_schemas(selection.filter_typed(c, "FUNCTION[c.*1 c.*2]; VIEW[!c.*5]"), ["1-urgent"]), "valid")
    return kept.groupBy("owner", "object_type").agg(F.count(F.lit(1)).alias("n_objects"))


def f1_filter_everywhere(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One filter for the tables that have its column; the others stay whole."""
    names = ("orders", "lineitem", "nation")
    return relational.count_rows(selection.where_clauses({n: table(spark, sf_dir, n) for n in names}, {"nation": "n_nationkey > 4"}, "o_totalprice > 100000"))


def f8_mysql_regexp(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, t = table(spark, sf_dir, "customer"), F.col("c_mktsegment")
    return c.select("c_custkey", selection.mysql_regexp(t, "^build").alias("folded"), selection.mysql_regexp(t, "^build", binary=True).alias("exact"), selection.mysql_regexp(t, "y$", negate=True).alias("negated"))


def j2_marked_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark on the left side, and rows that a change list names (J7)."""
    n, s = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    joined = relational.outer_plus(s, n, (F.col("s_nationkey") == F.col("n_nationkey")) & (F.col("s_acctbal") > 5000), side="left")
    counted = joined.groupBy("n_name").agg(F.count("s_suppkey").alias("n"))
    changed = relational.changed_since(table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "c_custkey"), "c_custkey", F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp"))
    return counted.unionByName(changed.agg(F.lit("changed").alias("n_name"), F.count(F.lit(1)).alias("n")))


def w4_assign_rownum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts renumbered by price, in place of a column; a key that repeats keeps its rows."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", F.col("p_size").alias("place"))
    return relational.assign_rownum(p, "p_partkey", [F.col("p_retailprice").desc()], "place").select("p_partkey", "place")


def l7_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIMIT with an offset, TOP, and rows of an array (X5)."""
    o, by = table(spark, sf_dir, "orders").select("o_orderkey"), [F.col("o_orderkey")]
    limited = relational.mysql_limit(o, 7, 5, by).withColumn("form", F.lit("limit")).unionByName(relational.top(o, 4, by).withColumn("form", F.lit("top")))
    return limited.unionByName(relational.pipe_rows(table(spark, sf_dir, "region"), F.array(F.col("r_regionkey"), F.col("r_regionkey") + 10), "k").select(_long(F.col("k")).alias("o_orderkey"), F.lit("pipe").alias("form")))


def h4_cycles_and_siblings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree whose first part refers to its own child: NOCYCLE ends there, and marks the row."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") == 1, 10).when(F.col("p_partkey") >= 10, F.floor(F.col("p_partkey") / 10)).alias("up"))
    found = hierarchy.connect_by(p, "p_partkey", "up", F.col("p_partkey") == 1, nocycle=True)
    return found.select("p_partkey", _long(F.col("level")).alias("level"), _long(F.col("is_cycle")).alias("is_cycle"))


def h5_siblings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree in the order of siblings: the numbers of its rows."""
    p = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_partkey") >= 10, F.floor(F.col("p_partkey") / 10)).alias("up"))
    found = hierarchy.connect_by(p, "p_partkey", "up", F.col("up").isNull(), siblings=[F.col("p_partkey").cast("string")], path=("p_partkey", "/"))
    return relational.with_rownum(found.select("p_partkey", "path"), [F.split("path", "/")]).select("p_partkey", "rownum")


def h9_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recursive expression that is deeper than Spark's own limit of levels."""
    table(spark, sf_dir, "region").createOrReplaceTempView("ferrywright_region")
    return hierarchy.recursive_cte(spark, "WITH RECURSIVE t(k, n) AS (SELECT r_regionkey, 1 FROM ferrywright_region UNION ALL SELECT k, n + 1 FROM t WHERE n < 120 + k) SELECT CAST(k AS BIGINT) AS k, CAST(max(n) AS BIGINT) AS n FROM t GROUP BY k", 200)


def p_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fractions cut, floats by their spellings, bytes decoded, columns as one struct, nulls asked for."""
    word = F.element_at(F.array(*map(F.lit, ["1.5", " nan", "-Inf", "x", "Infinity"])), (F.col("event_id") % 5 + 1).cast("int"))
    e = table(spark, sf_dir, "events").withColumn("f", cleaning.normalise_float(word))
    e = cleaning.build_struct(e.withColumns({"a": F.col("event_id") % 3, "b": F.col("user_id")}), "both", ["a", "b"])
    return e.select(
        "event_id", cleaning.truncate_fraction(F.col("ts")).alias("ts"), F.coalesce(F.when(F.isnan("f"), "nan").when(F.abs("f") == float("inf"), F.when(F.col("f") > 0, "+").otherwise("-")).otherwise(F.col("f").cast("string")), F.lit("none")).alias("f"), cleaning.decode_text(F.encode("event_type", "UTF-16BE"), "UTF-16BE").alias("kind"),
        F.col("both.a").alias("a"), cleaning.eq_or_null(F.nullif("event_type", F.lit("click")), None).alias("asked"), (cleaning.case_insensitive(F.upper("event_type")) == F.col("event_type")).alias("same"),
    )


def p9_narrow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Declared numbers cast where they fit; the types that came out, and columns without large objects (P12)."""
    p = table(spark, sf_dir, "part").select(F.col("p_size").cast("decimal(38,4)").alias("fits"), (F.col("p_size") + 0.5).cast("decimal(38,4)").alias("rounded"), (F.col("p_partkey") + 100000).cast("decimal(38,4)").alias("large"), F.encode("p_name", "UTF-8").alias("raw"), "p_partkey")
    narrow = cleaning.drop_large_objects(types.narrow_numeric(p, {"fits": (4, 0), "rounded": (4, 0), "large": (5, 0)}))
    told = dict(narrow.dtypes)
    return narrow.groupBy((F.col("p_partkey") % 10).alias("k")).agg(_long(F.sum("fits")).alias("total"), *[F.lit(told.get(c, "gone")).alias(f"type_{c}") for c in ("fits", "rounded", "large", "raw")])


def o_more_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NEXT_DAY, MONTHS_BETWEEN, day arithmetic, NUMTODSINTERVAL, NUMTOYMINTERVAL, FROM_TZ, intervals."""
    o, d = table(spark, sf_dir, "orders"), F.date_trunc("day", "o_orderdate")
    k = F.col("o_orderkey")
    return o.select(
        "o_orderkey", oracle.next_day(d, "MON").alias("monday"), _long(oracle.months_between(F.trunc(d, "month"), F.lit("1990-01-01").cast("date"))).alias("months"), oracle.date_plus(d, 1.5).alias("later"), (d + oracle.numtodsinterval(k % 5, "HOUR")).alias("hours"),
        (d + oracle.interval("3", "DAY")).alias("days3"), (d + oracle.interval("1-2", "YEAR TO MONTH")).cast("date").alias("ym"), (F.trunc(d, "month") + oracle.numtoyminterval(k % 3, "MONTH")).cast("date").alias("plus_months"), oracle.from_tz(d, "+02:00").alias("utc"),
        oracle.to_timestamp(F.date_format(d, "yyyy-MM-dd 10:20:30.123456"), "YYYY-MM-DD HH24:MI:SS.FF6").alias("stamp"), oracle.new_time(d, "UTC", "Asia/Tokyo").cast("timestamp_ntz").alias("tokyo"), oracle.add_years(d, 2).alias("years2"),
    )


def o_more_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TO_NUMBER, INSTR, REGEXP_INSTR, LOB and raw functions, REMAINDER, BIN_TO_NUM, LNNVL, XML."""
    o, k, c, p = table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderpriority")
    joined = F.concat_ws("-", c.cast("string"), k.cast("string"), F.lit("x"))
    return o.select(
        "o_orderkey", _long(oracle.to_number(F.concat(F.lit(" "), c.cast("string"), F.lit(" ")))).alias("number"), _long(oracle.instr(joined, "-", 1, 2)).alias("second"), _long(oracle.instr(joined, "-", -1)).alias("last"), _long(oracle.regexp_instr(joined, "-[0-9x]", 2, 2)).alias("regex"),
        oracle.substrb(p, 3, 4).alias("bytes"), oracle.replace(p, "-", "+").alias("plus"), _long(oracle.lob_getlength(p)).alias("size"), oracle.lob_substr(p, 3, 2).alias("piece"), _long(oracle.edit_distance(F.col("o_orderstatus"), F.lit("F"))).alias("edits"), oracle.rawtohex(oracle.cast_to_raw(p)).alias("raw"),
        _long(F.length(oracle.sys_guid())).alias("guid"), oracle.remainder(c, 7).cast("double").alias("rest"), oracle.bin_to_num(k % 2, F.lit(1), c % 2).alias("bits"), oracle.lnnvl(F.nullif(F.col("o_orderstatus"), F.lit("P")) == "F").alias("unknown"), oracle.rawtohex(oracle.hextoraw(F.lit("0aff"))).alias("hex"),
        oracle.asciistr(F.concat(p, F.lit("é"))).alias("ascii"), oracle.tz_offset("+05:30").alias("offset"), _long(oracle.vsize(p)).alias("vsize"), oracle.xml_element("p", p).alias("xml"), oracle.xml_value(oracle.xml_element("p", p), "p").alias("back"), oracle.xml_cdata(p).alias("cdata"),
        oracle.round_half_up(F.col("o_totalprice"), 1).cast("double").alias("rounded"), oracle.is_json(F.concat(F.lit("{\"a\": "), c.cast("string"), F.when(k % 2 == 0, "}").otherwise(""))).alias("json"), oracle.to_char(c, "FM0000000").alias("padded"), oracle.least(k, c).alias("least"), oracle.nanvl(F.when(k % 2 == 0, float("nan")).otherwise(1.0), 9.0).alias("nanvl"),
    )


def o28_gapless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of a sequence without gaps, by price."""
    return oracle.gapless(table(spark, sf_dir, "part").select("p_partkey", "p_retailprice"), [F.col("p_retailprice"), F.col("p_partkey")], "id", 1000, 5).select("p_partkey", "id")


def m_more(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MySQL's conditional, numeric, text and conversion functions."""
    c, k, s, a = table(spark, sf_dir, "customer"), F.col("c_custkey"), F.col("c_mktsegment"), F.col("c_acctbal")
    return c.select(
        "c_custkey", mysql.if_(a > 0, "plus", "minus").alias("sign"), mysql.ifnull(F.nullif(s, F.lit("BUILDING")), "none").alias("filled"), _long(mysql.isnull(F.nullif(s, F.lit("BUILDING")))).alias("isnull"), mysql.xor(k % 2 == 0, k % 3 == 0).alias("xor"), mysql.pipes(s, F.lit("!"), as_concat=True).alias("pipes"), mysql.pipes(k % 2, k % 3).alias("either"),
        F.round(mysql.atan(a, F.lit(2.0)), 6).alias("atan"), F.round(mysql.log(2, k.cast("double")), 6).alias("log"), F.round(mysql.log10(k.cast("double")), 6).alias("log10"), mysql.pow(k.cast("double"), 2).alias("pow"), mysql.hex(k).alias("hex"), _long(F.length(mysql.uuid())).alias("uuid"), mysql.mod(k, 7).alias("mod"), mysql.bin(k).alias("bin"), mysql.bit_xor(k, F.lit(5)).alias("bit_xor"),
        mysql.mid(s, 2, 3).alias("mid"), mysql.quote(F.concat(s, F.lit("'s"))).alias("quote"), mysql.to_base64(F.encode(s, "UTF-8")).alias("base64"), F.decode(mysql.from_base64(mysql.to_base64(F.encode(s, "UTF-8"))), "UTF-8").alias("back"), mysql.ord(s).alias("ord"), mysql.char(k % 26 + 65, F.lit(66)).alias("char"), F.concat(mysql.space(F.lit(2)), s).alias("space"),
        mysql.is_ipv4(F.concat(F.lit("10.0.0."), (k % 300).cast("string"))).alias("ipv4"), mysql.is_ipv6(F.concat(F.lit("fe80::"), mysql.hex(k % 70000))).alias("ipv6"), mysql.json_extract(F.concat(F.lit("{\"a\": [1, "), k.cast("string"), F.lit("]}")), "$.a[1]").alias("json"), _long(mysql.cast(F.concat(k.cast("string"), F.when(k % 4 == 0, "x").otherwise("")), "SIGNED")).alias("signed"),
        mysql.period_diff(F.lit(200001), F.lit(199001) + k % 12).alias("periods"), mysql.sha(s, 256).alias("sha"), mysql.format(k * 1000, 1).alias("format"), mysql.sounds_like(F.lit("Robert"), F.lit("Rupert")).alias("sounds"),
    )


def m_more_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MySQL's compound units, moments, days and differences."""
    e, d, k = table(spark, sf_dir, "events"), F.date_trunc("second", "ts"), F.col("event_id")
    units = ("DAY_HOUR", "DAY_SECOND", "HOUR_MINUTE", "HOUR_SECOND", "MINUTE_SECOND")
    return e.select(
        "event_id", *[mysql.extract(u, d).alias(u.lower()) for u in units], _long(mysql.unix_timestamp(d)).alias("unix"), mysql.from_unixtime(_long(mysql.unix_timestamp(d))).alias("moment"), mysql.convert_tz(d, "+00:00", "+03:00").alias("zone"), _long(mysql.datediff(d, F.lit("2020-01-01").cast("date"))).alias("days"),
        _long(mysql.weekofyear(d)).alias("iso_week"), mysql.makedate(F.lit(2024), k % 366 + 1).alias("made"), mysql.from_days(mysql.to_days(d)).alias("from_days"), mysql.time(d).alias("clock"), mysql.timestampadd("HOUR", k % 50, d).alias("added"), mysql.timediff(d, F.date_trunc("day", d)).alias("since"), mysql.date_format(d, "%W %M %e %y %h %p %%").alias("shown"),
        mysql.date_format(d, "%a %b %d %c %k").alias("short"),
    )


def q_more(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-SQL's text, conversion and date functions."""
    o, k, p, d = table(spark, sf_dir, "orders"), F.col("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderdate")
    padded = F.concat(p, F.lit("  "))
    styles = {101: "s101", 102: "s102", 103: "s103", 104: "s104", 105: "s105", 110: "s110", 111: "s111", 108: "s108"}
    return o.select(
        "o_orderkey", _long(tsql.len_(padded)).alias("len"), _long(tsql.datalength(padded)).alias("size"), tsql.isnull(F.nullif(p, F.lit("5-LOW")), "none").alias("filled"), F.concat(tsql.space(F.lit(2)), tsql.replicate(F.lit("ab"), 3)).alias("texts"), tsql.convert("varchar", k, length=3).alias("cut"), _long(tsql.convert("bigint", F.concat(k.cast("string"), F.when(k % 3 == 0, "?").otherwise("")))).alias("number"),
        _long(F.length(tsql.newid())).alias("id"), _long(tsql.patindex("%[A-Z]%", p)).alias("letter"), tsql.str_(k.cast("double"), 12, 1).alias("str"), tsql.square(k.cast("double")).alias("square"), _long(tsql.unicode(F.substr(p, F.lit(3)))).alias("unicode"), tsql.nchar(k % 26 + 97).alias("nchar"), tsql.datefromparts(F.lit(2001), F.lit(2), (k % 28 + 1).cast("int")).alias("made"), F.round(tsql.atn2(k.cast("double"), F.lit(3.0)), 6).alias("angle"),
        _long(tsql.isnumeric(F.when(k % 2 == 0, "12.5").otherwise("x"))).alias("isnumeric"), _long(tsql.isdate(F.when(k % 2 == 0, "2001-02-03").otherwise("x"))).alias("isdate"), tsql.nullif(p, "5-LOW").alias("nulled"), tsql.soundex(F.lit("Robert")).alias("soundex"), *[tsql.convert("varchar", d, s).alias(n) for s, n in styles.items()],
        *[_long(tsql.datepart(u, d)).alias(u) for u in ("year", "month", "day", "hour", "minute", "second", "dayofyear", "weekday")], tsql.datename("weekday", d).alias("named"), _long(tsql.datediff("day", d, F.lit("1999-01-15").cast("timestamp"))).alias("days"), tsql.dateadd("month", 2, F.date_trunc("day", d)).alias("later"),
    )


def g2_geometry_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference systems filled, mapped and forced, and the kind of a column."""
    point = F.struct(F.lit(2001).alias("gtype"), F.when(F.col("s_suppkey") % 3 != 0, (F.col("s_suppkey") % 3 * 4000).cast("int")).alias("srid"), F.struct(F.col("s_acctbal").alias("x"), F.lit(1.0).alias("y"), F.lit(None).cast("double").alias("z")).alias("point"), F.array().cast("array<int>").alias("elem_info"), F.array().cast("array<double>").alias("ordinates"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), point.alias("geom"))
    kind = geometry.detect_spatial_type(s)
    counted = geometry.fix_srid(s, mapping={4000: 3857}).groupBy(F.col("geom.srid").cast("string").alias("what")).agg(F.count(F.lit(1)).alias("n"))
    forced = geometry.fix_srid(s, force=2154).groupBy(F.concat(F.lit("forced "), F.col("geom.srid").cast("string")).alias("what")).agg(F.count(F.lit(1)).alias("n"))
    return counted.unionByName(forced).unionByName(kind.select(F.col("spatial_type").alias("what"), _long(F.col("dim")).alias("n")))


ALL_RULES = {
    "oracle": "x IS TABLE OF y; a = b(+) CONNECT BY c BULK COLLECT FORALL GOTO l; PIPE ROW UTL_FILE CTX_DDL; EXTRACT (y) TO_NUMBER('1') LAST_DAY(x) REGEXP_SUBSTR ORA_ROWSCN SAVEPOINT a %ISOPEN %ROWCOUNT SDO_GEOM PRAGMA x MERGE INTO t TO_CHAR(d) a || b WHEN OTHERS THEN",
    "mysql": "SELECT GROUP_CONCAT(DISTINCT a), b SOUNDS LIKE c, COUNT(DISTINCT d), MATCH(t) AGAINST('x'), JSON_EXTRACT(j), get_lock(1), @v CHARACTER SET x",
    "tsql": "SELECT TOP 5 a COLLATE x FROM db.dbo.t, master.x RETURNS TABLE AS OBJECT_ID (a) ##tmp INTO #t @@SPID PIVOT (x) BEGIN TRY EXEC dbo.SP_X doc.value('x') FOR XML PATH",
}


def e_all_dialects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many rules of each dialect, with and without the reference's way of counting."""
    out = None
    for dialect, text in ALL_RULES.items():
        code = table(spark, sf_dir, "part").select(F.lit(dialect).alias("dialect"), F.concat(F.lit("c"), F.col("p_partkey").cast("string")).alias("name"), F.lit("FUNCTION").alias("object_type"), F.lit(text).alias("code"))
        for compat in (False, True):
            found = assessment.score_details(code, dialect, ("dialect", "object_type"), compat).select("dialect", F.lit(compat).alias("compat"), "keyword", "n", F.round("cost", 4).alias("cost"))
            out = found if out is None else out.unionByName(found)
    return out


def _all_rules_sql() -> str:
    """What the texts hold of each difficulty, counted by hand."""
    oracle_rules = [("TEST", 1, 2), ("SIZE", 1, 1), ("IS TABLE OF", 1, 4), ("OUTER JOIN", 1, 2), ("CONNECT BY", 1, 3), ("BULK COLLECT", 1, 5), ("FORALL", 1, 1), ("GOTO", 1, 2), ("PIPE ROW", 1, 1), ("UTL_", 1, 3), ("CTX_", 1, 3), ("EXTRACT", 1, 3), ("TO_NUMBER", 1, 0.1), ("LAST_DAY", 1, 1),
                    ("REGEXP_SUBSTR", 1, 1), ("ORA_ROWSCN", 1, 3), ("SAVEPOINT", 1, 1), ("ISOPEN", 1, 1), ("ROWCOUNT", 1, 1), ("SDO_", 1, 3), ("PRAGMA", 1, 3), ("MERGE INTO", 1, 3), ("TO_CHAR", 1, 0.1), ("CONCAT", 1, 0.1), ("WHEN OTHER", 1, 10)]
    mysql_rules = [("TEST", 1, 2), ("SIZE", 1, 1), ("ARRAY_AGG_DISTINCT", 1, 1), ("SOUNDS LIKE", 1, 1), ("COUNT(DISTINCT)", 1, 2), ("MATCH", 2, 4), ("JSON", 1, 2), ("LOCK", 1, 2), ("@VAR", 1, 0.1), ("CHARACTER SET", 1, 1)]
    tsql_rules = [("TEST", 1, 2), ("SIZE", 1, 1), ("SELECT_TOP", 1, 0.2), ("COLLATE", 1, 0.2), ("FOREIGN_OBJECT", 1, 6), ("SYS_OBJECT", 1, 6), ("RETURNS_TABLE", 1, 1), ("OBJECT_ID", 1, 2), ("GLOBAL_TEMP_TABLE", 1, 2), ("INTO_TEMP_TABLE", 1, 1), ("GLOBAL_VARIABLE", 1, 1), ("PIVOT", 1, 12), ("TRY_CATCH", 1, 3), ("SP_FCT", 1, 3), ("XML_FCT", 1, 3), ("FOR_XML", 1, 6)]
    less = {("oracle", "MERGE INTO"), ("oracle", "WHEN OTHER"), ("mysql", "JSON")}
    rows = [f"('{d}', {str(compat).lower()}, '{k}', {n}, {c})" for d, rules in (("oracle", oracle_rules), ("mysql", mysql_rules), ("tsql", tsql_rules)) for compat in (False, True) for k, n, c in rules if not (compat and (d, k) in less)]
    return f"SELECT dialect, compat, keyword, n * m AS n, round(c * m, 4)::DOUBLE AS cost FROM (VALUES {', '.join(rows)}) r(dialect, compat, keyword, n, c), (SELECT count(*) AS m FROM part)"


TREE = "t AS (SELECT p_partkey, CASE WHEN p_partkey >= 10 THEN p_partkey // 10 END AS up FROM part)"
QUERIES = {
    "k1_bulk_files": (k1_bulk_files, "SELECT c_custkey, c_name, c_mktsegment FROM customer"),
    "k4_table_folders": (k4_table_folders, "SELECT 'kept' AS table_name, count(*) AS n_rows FROM customer UNION ALL SELECT 'fresh', count(*) FROM supplier WHERE s_suppkey > 10"),
    "r8_partition_files": (r8_partition_files, "SELECT o_orderstatus, count(*) AS n_rows, min(o_totalprice) AS low FROM orders WHERE NOT (o_totalprice >= 50000 AND o_totalprice < 100000) GROUP BY 1"),
    "s10_binary_files": (s10_binary_files, "SELECT DISTINCT 'c_mktsegment=' || c_mktsegment AS directory, c_mktsegment AS text FROM customer"),
    "s13_code_files": (s13_code_files, "SELECT 'ROWNUM' AS keyword, count(*) AS n, count(*)::DOUBLE AS cost FROM benchmark"),
    "s7_views_and_snapshots": (
        s7_views_and_snapshots,
        "WITH n AS (SELECT count(*) FILTER (WHERE o_orderkey % 10 <> 3) + count(*) FILTER (WHERE o_orderkey % 50 = 0) AS g, count(*) AS s, count(DISTINCT o_orderpriority) AS p FROM orders) SELECT 'spend' AS table_name, p AS source_rows, p AS target_rows, 'ok' AS status FROM n UNION ALL SELECT 'orders', s, g, CASE WHEN s = g THEN 'ok' ELSE 'diff' END FROM n",
    ),
    "a7_column_counts": (a7_column_counts, "SELECT n AS n_columns, count(*) AS n_tables FROM (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) GROUP BY 1"),
    "a8_partition_counts": (a8_partition_counts, "SELECT l_returnflag AS method, count(DISTINCT l_suppkey % 7) AS n_parts FROM lineitem GROUP BY ROLLUP (l_returnflag)"),
    "a8_subpartition_counts": (
        a8_subpartition_counts,
        "SELECT l_returnflag AS table_name, l_partkey % 5 AS position, count(DISTINCT l_suppkey % 9) AS n_subparts, count(*) AS n_rows FROM lineitem GROUP BY ROLLUP (l_returnflag, l_partkey % 5)",
    ),
    "r4_reference_hash": (r4_reference_hash, "SELECT 'lineitem_part' || (l_orderkey % 6 + 1) AS partition_name, count(*) AS n_rows FROM lineitem GROUP BY 1"),
    "a9_schema_size": (a9_schema_size, "SELECT 's' || (page_id % 5) AS owner, sum(strlen(html))::DOUBLE AS size_mb FROM pages GROUP BY 1"),
    "a11_distinct": (a11_distinct, "SELECT o_orderstatus, count(*) AS n_pairs, string_agg(o_orderpriority, ';' ORDER BY o_orderpriority) AS priorities FROM (SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders) GROUP BY 1"),
    "e13_kinds": (e13_kinds, "SELECT CASE o_orderstatus WHEN 'F' THEN 'FUNCTION' WHEN 'O' THEN 'VIEW' ELSE 'TRIGGER' END AS object_type, CASE WHEN o_orderkey % 11 = 0 THEN 'INVALID' ELSE 'VALID' END AS status, count(*) AS n FROM orders GROUP BY 1, 2"),
    "e11_show_columns": (e11_show_columns, "SELECT ['user', 'ORDER', 'amount', 'label'][(p_partkey % 4 + 1)::INT] AS column_name, p_partkey % 4 < 2 AS reserved_word, count(*) AS n_columns FROM part GROUP BY 1, 2"),
    "f4_object_filters": (
        f4_object_filters,
        """SELECT o_orderpriority AS owner, CASE o_orderstatus WHEN 'F' THEN 'FUNCTION' WHEN 'O' THEN 'VIEW' ELSE 'TRIGGER' END AS object_type, count(*) AS n_objects FROM orders WHERE o_orderpriority NOT IN ('5-LOW', '1-URGENT') AND o_orderkey % 11 <> 0
        AND (o_orderstatus <> 'F' OR o_orderkey % 10 IN (1, 2)) AND (o_orderstatus <> 'O' OR o_orderkey % 10 <> 5) GROUP BY 1, 2""",
    ),
    "f1_filter_everywhere": (f1_filter_everywhere, "SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders WHERE o_totalprice > 100000 UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'nation', count(*) FROM nation WHERE n_nationkey > 4"),
    "f8_mysql_regexp": (f8_mysql_regexp, "SELECT c_custkey, c_mktsegment ILIKE 'build%' AS folded, c_mktsegment LIKE 'build%' AS exact, NOT c_mktsegment ILIKE '%y' AS negated FROM customer"),
    "j2_marked_left": (j2_marked_left, "SELECT n_name, count(s_suppkey) AS n FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey AND s_acctbal > 5000 GROUP BY 1 UNION ALL SELECT 'changed', count(*) FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')"),
    "w4_assign_rownum": (w4_assign_rownum, "SELECT p_partkey, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS place FROM part"),
    "l7_limits": (l7_limits, "SELECT * FROM (SELECT o_orderkey, 'limit' AS form FROM orders ORDER BY 1 LIMIT 5 OFFSET 7) UNION ALL SELECT * FROM (SELECT o_orderkey, 'top' FROM orders ORDER BY 1 LIMIT 4) UNION ALL SELECT r_regionkey + d, 'pipe' FROM region, (VALUES (0), (10)) v(d)"),
    "h4_cycles_and_siblings": (
        h4_cycles_and_siblings,
        "WITH RECURSIVE t AS (SELECT p_partkey AS k, CASE WHEN p_partkey = 1 THEN 10 WHEN p_partkey >= 10 THEN p_partkey // 10 END AS up FROM part), r AS (SELECT k, 1 AS level, [k] AS seen FROM t WHERE k = 1 UNION ALL SELECT t.k, level + 1, list_append(seen, t.k) FROM r JOIN t ON t.up = r.k WHERE NOT list_contains(seen, t.k)) SELECT k AS p_partkey, level::BIGINT AS level, CASE WHEN k = 10 THEN 1 ELSE 0 END::BIGINT AS is_cycle FROM r",
    ),
    "h5_siblings": (
        h5_siblings,
        f"WITH RECURSIVE {TREE}, r AS (SELECT p_partkey, ['', p_partkey::VARCHAR] AS path FROM t WHERE up IS NULL UNION ALL SELECT t.p_partkey, list_append(path, t.p_partkey::VARCHAR) FROM r JOIN t ON t.up = r.p_partkey) SELECT p_partkey, row_number() OVER (ORDER BY path) AS rownum FROM r",
    ),
    "h9_recursive": (h9_recursive, "SELECT r_regionkey::BIGINT AS k, 120 + r_regionkey::BIGINT AS n FROM region"),
    "p_values": (
        p_values,
        "SELECT event_id, date_trunc('second', ts) AS ts, CASE event_id % 5 WHEN 0 THEN '1.5' WHEN 1 THEN 'nan' WHEN 2 THEN '-' WHEN 3 THEN 'none' ELSE '+' END AS f, event_type AS kind, event_id % 3 AS a, event_type = 'click' AS asked, true AS same FROM events",
    ),
    "p9_narrow": (
        p9_narrow,
        "SELECT p_partkey % 10 AS k, sum(p_size)::BIGINT AS total, 'smallint' AS type_fits, 'decimal(38,4)' AS type_rounded, 'decimal(38,4)' AS type_large, 'gone' AS type_raw FROM part GROUP BY 1",
    ),
    "o_more_dates": (
        o_more_dates,
        """WITH o AS (SELECT o_orderkey AS k, date_trunc('day', o_orderdate)::TIMESTAMP AS d FROM orders) SELECT k AS o_orderkey, (d::DATE + (8 - isodow(d))::INT)::DATE AS monday, date_diff('month', DATE '1990-01-01', d::DATE) AS months, d + INTERVAL 36 HOUR AS later, d + to_hours(k % 5) AS hours, d + INTERVAL 3 DAY AS days3,
        (d + INTERVAL 14 MONTH)::DATE AS ym, (date_trunc('month', d) + to_months((k % 3)::INT))::DATE AS plus_months, d - INTERVAL 2 HOUR AS utc, d + INTERVAL '10:20:30.123456' AS stamp, d + INTERVAL 9 HOUR AS tokyo, (d + INTERVAL 2 YEAR)::DATE AS years2 FROM o""",
    ),
    "o_more_values": (
        o_more_values,
        """WITH o AS (SELECT *, o_orderkey AS k, o_custkey AS c, o_orderpriority AS p, o_custkey || '-' || o_orderkey || '-x' AS j FROM orders) SELECT k AS o_orderkey, c AS number, length(c::VARCHAR) + length(k::VARCHAR) + 2 AS second, length(c::VARCHAR) + length(k::VARCHAR) + 2 AS last, length(c::VARCHAR) + length(k::VARCHAR) + 2 AS regex,
        substr(p, 3, 4) AS bytes, replace(p, '-', '+') AS plus, strlen(p) AS size, substr(p, 2, 3) AS piece, CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END::BIGINT AS edits, hex(p) AS raw, 32::BIGINT AS guid, (c - 7 * round_even(c / 7.0, 0))::DOUBLE AS rest, (k % 2) * 4 + 2 + c % 2 AS bits, o_orderstatus <> 'F' AS unknown, '0AFF' AS hex,
        p || '\\00E9' AS ascii, '+05:30' AS "offset", strlen(p) AS vsize, '<p>' || p || '</p>' AS xml, p AS back, '<![CDATA[' || p || ']]>' AS cdata, round(o_totalprice::DECIMAL(38,10), 1)::DOUBLE AS rounded, k % 2 = 0 AS json, printf('%07d', c) AS padded, least(k, c) AS least, CASE WHEN k % 2 = 0 THEN 9.0 ELSE 1.0 END::DOUBLE AS nanvl FROM o""",
    ),
    "o28_gapless": (o28_gapless, "SELECT p_partkey, 1000 + 5 * row_number() OVER (ORDER BY p_retailprice, p_partkey) AS id FROM part"),
    "m_more": (
        m_more,
        """WITH c AS (SELECT *, c_custkey AS k, c_mktsegment AS s FROM customer) SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'plus' ELSE 'minus' END AS sign, CASE WHEN s = 'BUILDING' THEN 'none' ELSE s END AS filled, (s = 'BUILDING')::BIGINT AS isnull, (k % 2 = 0) <> (k % 3 = 0) AS xor, s || '!' AS pipes, k % 2 <> 0 OR k % 3 <> 0 AS either,
        round(atan2(c_acctbal, 2.0), 6) AS atan, round(CASE WHEN k > 0 THEN ln(k) / ln(2) END, 6) AS log, round(CASE WHEN k > 0 THEN log10(k) END, 6) AS log10, (k * k)::DOUBLE AS pow, upper(to_hex(k)) AS hex, 36::BIGINT AS uuid, k % 7 AS mod, bin(k) AS bin, xor(k, 5) AS bit_xor, substr(s, 2, 3) AS mid, '''' || s || '\\''s''' AS quote, to_base64(encode(s)) AS base64, s AS back, ascii(s)::BIGINT AS ord,
        chr((k % 26 + 65)::INT) || 'B' AS char, '  ' || s AS space, k % 300 <= 255 AS ipv4, k % 70000 <= 65535 AS ipv6, k::VARCHAR AS json, CASE WHEN k % 4 <> 0 THEN k END AS signed, 120 - k % 12 AS periods, sha256(s) AS sha, format('{:,}', k * 1000) || '.0' AS format, true AS sounds FROM c""",
    ),
    "m_more_dates": (
        m_more_dates,
        """WITH e AS (SELECT event_id, date_trunc('second', ts)::TIMESTAMP AS d FROM events) SELECT event_id, strftime(d, '%d%H')::BIGINT AS day_hour, strftime(d, '%d%H%M%S')::BIGINT AS day_second, strftime(d, '%H%M')::BIGINT AS hour_minute, strftime(d, '%H%M%S')::BIGINT AS hour_second, strftime(d, '%M%S')::BIGINT AS minute_second,
        epoch(d)::BIGINT AS unix, d AS moment, d + INTERVAL 3 HOUR AS zone, date_diff('day', DATE '2020-01-01', d::DATE) AS days, weekofyear(d)::BIGINT AS iso_week, DATE '2024-01-01' + (event_id % 366)::INT AS made, d::DATE AS from_days, strftime(d, '%H:%M:%S') AS clock, d + to_hours(event_id % 50) AS added, strftime(d, '%H:%M:%S') AS since,
        strftime(d, '%A %B %-d %y %I %p %%') AS shown, strftime(d, '%a %b %d %-m %-H') AS short FROM e""",
    ),
    "q_more": (
        q_more,
        """WITH o AS (SELECT *, o_orderkey AS k, o_orderpriority AS p, o_orderdate AS d FROM orders) SELECT o_orderkey, length(p) AS len, strlen(p) + 2 AS size, CASE WHEN p = '5-LOW' THEN 'none' ELSE p END AS filled, '  ababab' AS texts, substr(k::VARCHAR, 1, 3) AS cut, CASE WHEN k % 3 <> 0 THEN k END AS number, 36::BIGINT AS id, 3::BIGINT AS letter,
        lpad(k || '.0', 12, ' ') AS str, (k * k)::DOUBLE AS square, ascii(substr(p, 3))::BIGINT AS unicode, chr((k % 26 + 97)::INT) AS nchar, make_date(2001, 2, k % 28 + 1) AS made, round(atan2(k, 3.0), 6) AS angle, CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END::BIGINT AS isnumeric, CASE WHEN k % 2 = 0 THEN 1 ELSE 0 END::BIGINT AS isdate,
        nullif(p, '5-LOW') AS nulled, 'R163' AS soundex, strftime(d, '%m/%d/%Y') AS s101, strftime(d, '%Y.%m.%d') AS s102, strftime(d, '%d/%m/%Y') AS s103, strftime(d, '%d.%m.%Y') AS s104, strftime(d, '%d-%m-%Y') AS s105, strftime(d, '%m-%d-%Y') AS s110, strftime(d, '%Y/%m/%d') AS s111, strftime(d, '%H:%M:%S') AS s108,
        year(d)::BIGINT AS year, month(d)::BIGINT AS month, day(d)::BIGINT AS day, hour(d)::BIGINT AS hour, minute(d)::BIGINT AS minute, second(d)::BIGINT AS second, dayofyear(d)::BIGINT AS dayofyear, dayofweek(d)::BIGINT + 1 AS weekday, dayname(d) AS named, date_diff('day', d::DATE, DATE '1999-01-15') AS days, date_trunc('day', d)::TIMESTAMP + INTERVAL 2 MONTH AS later FROM o""",
    ),
    "g2_geometry_kinds": (
        g2_geometry_kinds,
        "SELECT CASE s_suppkey % 3 WHEN 0 THEN '4326' WHEN 1 THEN '3857' ELSE '8000' END AS what, count(*) AS n FROM supplier GROUP BY 1 UNION ALL SELECT 'forced 2154', count(*) FROM supplier UNION ALL SELECT 'POINT', 2",
    ),
    "e_all_dialects": (e_all_dialects, _all_rules_sql()),
}
