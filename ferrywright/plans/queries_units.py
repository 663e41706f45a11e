"""Every unit and mask of the dialects' date functions over the events, to the microsecond."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferrywright.functions import mysql, oracle, tsql
from ferrywright.plans.tables import table


def _moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events at moments of all years, hours and fractions: ``(event_id, a, b)``."""
    e = table(spark, sf_dir, "events")
    a = F.timestamp_add("MICROSECOND", (F.col("event_id") * 98_765 % 1_000_000).cast("int"), F.date_trunc("second", "ts")) - F.make_dt_interval(days=(F.col("event_id") * 7 % 5000).cast("int"))
    e = e.select("event_id", a.alias("a"))
    return e.withColumn("b", F.col("a") + F.make_dt_interval(days=(F.col("event_id") * 13 % 1500).cast("int"), hours=(F.col("event_id") % 24).cast("int"), mins=F.lit(7)))


_FROM = """(SELECT event_id, a, a + to_days((event_id * 13 % 1500)::INT) + to_hours(event_id % 24) + INTERVAL 7 MINUTE AS b FROM (SELECT event_id, date_trunc('second', ts) + to_microseconds(event_id * 98765 % 1000000) - to_days((event_id * 7 % 5000)::INT) AS a FROM events))"""
#: Compound units, with the same parts for DuckDB.
COMPOUND = {
    "YEAR_MONTH": "%Y%m", "DAY_HOUR": "%d%H", "DAY_MINUTE": "%d%H%M", "DAY_SECOND": "%d%H%M%S", "DAY_MICROSECOND": "%d%H%M%S%f", "HOUR_MINUTE": "%H%M", "HOUR_SECOND": "%H%M%S", "HOUR_MICROSECOND": "%H%M%S%f", "MINUTE_SECOND": "%M%S",
    "MINUTE_MICROSECOND": "%M%S%f", "SECOND_MICROSECOND": "%S%f",
}
ADDED = {
    ("5", "MICROSECOND"): "INTERVAL 5 MICROSECOND", ("5", "SECOND"): "INTERVAL 5 SECOND", ("5", "MINUTE"): "INTERVAL 5 MINUTE", ("5", "HOUR"): "INTERVAL 5 HOUR", ("5", "DAY"): "INTERVAL 5 DAY", ("5", "WEEK"): "INTERVAL 35 DAY", ("5", "MONTH"): "INTERVAL 5 MONTH",
    ("5", "QUARTER"): "INTERVAL 15 MONTH", ("5", "YEAR"): "INTERVAL 5 YEAR", ("1 2", "DAY_HOUR"): "INTERVAL 26 HOUR", ("3:4", "MINUTE_SECOND"): "INTERVAL 184 SECOND", ("-2:30", "HOUR_MINUTE"): "INTERVAL (-150) MINUTE", ("1-2", "YEAR_MONTH"): "INTERVAL 14 MONTH",
    ("1 2:3:4", "DAY_SECOND"): "INTERVAL 93784 SECOND", ("7.250000", "SECOND_MICROSECOND"): "INTERVAL 7250000 MICROSECOND",
}
PARTS = ("YEAR", "QUARTER", "MONTH", "DAY", "HOUR", "MINUTE", "SECOND")
WHOLE = ("YEAR", "MONTH", "WEEK", "DAY", "HOUR", "MINUTE", "SECOND")


def m_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MySQL: EXTRACT of all compound units as digits and as numbers, DATE_ADD of all kinds of unit, the parts of a date, whole units between dates."""
    d, a, b = _moments(spark, sf_dir), F.col("a"), F.col("b")
    texts = [mysql.extract(u, a, as_text=True).alias(f"t_{u.lower()}") for u in COMPOUND]
    numbers = [mysql.extract(u, a).alias(f"n_{u.lower()}") for u in COMPOUND]
    added = [mysql.date_add(a, int(n) if n.isdigit() else n, u).alias(f"add_{u.lower()}") for n, u in ADDED]
    parts = {
        "day": F.day(a), "dayofweek": mysql.dayofweek(a), "dayofyear": F.dayofyear(a), "hour": F.hour(a), "minute": F.minute(a), "second": F.second(a), "microsecond": mysql.microsecond(a), "month": F.month(a), "quarter": F.quarter(a), "year": F.year(a),
        "weekday": mysql.weekday(a), "weekofyear": mysql.weekofyear(a),
    }
    return d.select("event_id", *texts, *numbers, *added, *[c.cast("long").alias(n) for n, c in parts.items()], mysql.dayname(a).alias("dayname"), mysql.monthname(a).alias("monthname"), *[mysql.timestampdiff(u, a, b).cast("long").alias(f"diff_{u.lower()}") for u in WHOLE])


#: Elements of DATE_FORMAT, by what DuckDB makes of them.
MASKS = {
    "a": "strftime(a, '%a')", "b": "strftime(a, '%b')", "c": "strftime(a, '%-m')", "d": "strftime(a, '%d')", "e": "strftime(a, '%-d')", "f": "strftime(a, '%f')", "H": "strftime(a, '%H')", "h": "strftime(a, '%I')", "I": "strftime(a, '%I')", "i": "strftime(a, '%M')", "j": "strftime(a, '%j')",
    "k": "strftime(a, '%-H')", "l": "strftime(a, '%-I')", "M": "strftime(a, '%B')", "m": "strftime(a, '%m')", "p": "strftime(a, '%p')", "r": "strftime(a, '%I:%M:%S %p')", "S": "strftime(a, '%S')", "s": "strftime(a, '%S')", "T": "strftime(a, '%H:%M:%S')", "U": "strftime(a, '%U')",
    "u": "CASE WHEN isoyear(a) < year(a) THEN '00' WHEN isoyear(a) > year(a) THEN '53' ELSE lpad(week(a)::VARCHAR, 2, '0') END", "V": "CASE WHEN strftime(a, '%U') = '00' THEN strftime(make_date(year(a) - 1, 12, 31), '%U') ELSE strftime(a, '%U') END", "v": "lpad(week(a)::VARCHAR, 2, '0')",
    "W": "strftime(a, '%A')", "w": "strftime(a, '%w')", "X": "CASE WHEN strftime(a, '%U') = '00' THEN year(a) - 1 ELSE year(a) END::VARCHAR", "x": "isoyear(a)::VARCHAR", "Y": "strftime(a, '%Y')", "y": "strftime(a, '%y')",
    "D": "day(a) || CASE WHEN day(a) BETWEEN 11 AND 13 THEN 'th' WHEN day(a) % 10 = 1 THEN 'st' WHEN day(a) % 10 = 2 THEN 'nd' WHEN day(a) % 10 = 3 THEN 'rd' ELSE 'th' END",
}


def m_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MySQL: every element of DATE_FORMAT by itself, named by its letter's number, and several in one mask."""
    a = F.col("a")
    return _moments(spark, sf_dir).select("event_id", *[mysql.date_format(a, f"%{c}").alias(f"f_{ord(c)}") for c in MASKS], mysql.date_format(a, "on %W, %D of %M %Y at %k:%i").alias("whole"), mysql.time_format(a, "%H.%i").alias("time"))


def o_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Oracle: TRUNC to every unit by every one of its formats, weeks from Monday and from Sunday."""
    a = F.col("a")
    formats = [f for names in oracle.TRUNC_UNITS.values() for f in names]
    return _moments(spark, sf_dir).select("event_id", *[oracle.trunc(a, f).alias(f"t_{f.lower()}") for f in formats], oracle.trunc(a, "DAY", 7).alias("sunday"))


def q_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T-SQL: DATEPART, DATENAME, DATEADD and DATEDIFF of every unit, by name and abbreviations."""
    a, b = F.col("a"), F.col("b")
    names = {u: n for u, n in tsql.UNITS.items()}
    parts = [tsql.datepart(short, a).cast("long").alias(f"part_{u.lower()}") for u, n in names.items() for short in n[-1:]]
    named = [tsql.datename(n[0], a).alias(f"name_{u.lower()}") for u, n in names.items()]
    added = [tsql.dateadd(n[1], -3, a).alias(f"add_{u.lower()}") for u, n in names.items()]
    apart = [tsql.datediff(names[u][0], a, b).cast("long").alias(f"diff_{u.lower()}") for u in (*PARTS, "WEEK")]
    return _moments(spark, sf_dir).select("event_id", *parts, *named, *added, *apart)


def h9_recursive_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A recursive table expression over all parts: each part with its depth and its topmost part."""
    from ferrywright.operators import hierarchy

    table(spark, sf_dir, "part").select("p_partkey").createOrReplaceTempView("parts_of_tree")
    sql = """WITH RECURSIVE r(k, top, depth) AS (SELECT p_partkey, p_partkey, 0 FROM parts_of_tree WHERE p_partkey < 10
        UNION ALL SELECT p.p_partkey, r.top, r.depth + 1 FROM r JOIN parts_of_tree p ON p.p_partkey div 10 = r.k AND p.p_partkey >= 10) SELECT k, top, CAST(depth AS BIGINT) AS depth FROM r"""
    return hierarchy.recursive_cte(spark, sql, 20)


_PART_SQL = {
    "YEAR": "year(a)", "QUARTER": "quarter(a)", "MONTH": "month(a)", "DOY": "dayofyear(a)", "DAY": "day(a)", "WEEK": "week(a) + 1", "DOW": "dayofweek(a) + 1", "HOUR": "hour(a)", "MINUTE": "minute(a)", "SECOND": "second(a)", "MILLISECOND": "strftime(a, '%g')::INT", "MICROSECOND": "strftime(a, '%f')::INT",
    "ISOWEEK": "week(a)",
}
_ADD_SQL = {u: f"a - INTERVAL 3 {u}" for u in ("YEAR", "MONTH", "DAY", "HOUR", "MINUTE", "SECOND", "MILLISECOND", "MICROSECOND")} | {"QUARTER": "a - INTERVAL 9 MONTH", "DOY": "a - INTERVAL 3 DAY", "DOW": "a - INTERVAL 3 DAY", "WEEK": "a - INTERVAL 21 DAY", "ISOWEEK": "a - INTERVAL 21 DAY"}
_NAME_SQL = {u: f"({c})::VARCHAR" for u, c in _PART_SQL.items()} | {"MONTH": "strftime(a, '%B')", "DOW": "strftime(a, '%A')"}
_TRUNC_SQL = {u: f"date_trunc('{u}', a)::TIMESTAMP" for u in ("year", "quarter", "month", "week", "day", "hour", "minute")}

QUERIES = {
    "m_units": (
        m_units,
        "SELECT event_id, " + ", ".join(
            [f"strftime(a, '{f}') AS t_{u.lower()}" for u, f in COMPOUND.items()] + [f"strftime(a, '{f}')::BIGINT AS n_{u.lower()}" for u, f in COMPOUND.items()] + [f"a + {i} AS add_{u.lower()}" for (_, u), i in ADDED.items()]
            + [f"({c})::BIGINT AS {n}" for n, c in {"day": "day(a)", "dayofweek": "dayofweek(a) + 1", "dayofyear": "dayofyear(a)", "hour": "hour(a)", "minute": "minute(a)", "second": "second(a)", "microsecond": "strftime(a, '%f')::INT", "month": "month(a)", "quarter": "quarter(a)", "year": "year(a)", "weekday": "isodow(a) - 1", "weekofyear": "week(a)"}.items()]
            + ["strftime(a, '%A') AS dayname", "strftime(a, '%B') AS monthname"] + [f"date_sub('{u.lower()}', a, b) AS diff_{u.lower()}" for u in WHOLE if u != "MONTH"] + ["date_diff('month', a, b) - (strftime(b, '%d%H%M%S%f') < strftime(a, '%d%H%M%S%f'))::INT AS diff_month"]
        ) + f" FROM {_FROM}",
    ),
    "m_masks": (m_masks, "SELECT event_id, " + ", ".join(f"{c} AS f_{ord(k)}" for k, c in MASKS.items()) + f", 'on ' || strftime(a, '%A') || ', ' || {MASKS['D']} || strftime(a, ' of %B %Y at %-H:%M') AS whole, strftime(a, '%H.%M') AS time FROM {_FROM}"),
    "o_units": (o_units, "SELECT event_id, " + ", ".join(f"{_TRUNC_SQL[u]} AS t_{f.lower()}" for u, names in oracle.TRUNC_UNITS.items() for f in names) + f", date_trunc('week', a + INTERVAL 1 DAY)::TIMESTAMP - INTERVAL 1 DAY AS sunday FROM {_FROM}"),
    "q_units": (
        q_units,
        "SELECT event_id, " + ", ".join(
            [f"({c})::BIGINT AS part_{u.lower()}" for u, c in _PART_SQL.items()] + [f"{c} AS name_{u.lower()}" for u, c in _NAME_SQL.items()] + [f"{c} AS add_{u.lower()}" for u, c in _ADD_SQL.items()] + [f"date_diff('{u.lower()}', a, b) AS diff_{u.lower()}" for u in PARTS]
            + ["(date_trunc('week', b + INTERVAL 1 DAY)::DATE - date_trunc('week', a + INTERVAL 1 DAY)::DATE) // 7 AS diff_week"]
        ) + f" FROM {_FROM}",
    ),
    "h9_recursive_tree": (
        h9_recursive_tree,
        "WITH RECURSIVE r(k, top, depth) AS (SELECT p_partkey, p_partkey, 0 FROM part WHERE p_partkey < 10 UNION ALL SELECT p.p_partkey, r.top, r.depth + 1 FROM r JOIN part p ON p.p_partkey // 10 = r.k AND p.p_partkey >= 10) SELECT k, top, depth::BIGINT AS depth FROM r",
    ),
}
