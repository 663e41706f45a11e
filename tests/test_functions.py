"""Dialect functions on small rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ferrywright.functions import cleaning, masks, mysql, oracle, tsql, types


def one(spark, column, **values):
    frame = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()]) if values else spark.range(1)
    return frame.select(column.alias("r")).first().r


TS = dt.datetime(2024, 2, 29, 13, 5, 9, 123456)


@pytest.mark.parametrize(
    "mask, pattern",
    [("YYYY-MM-DD HH24:MI:SS", "yyyy-MM-dd HH:mm:ss"), ("DD/MON/RR", "dd/MMM/yy"), ('"Week" Q', "'Week' Q"), ("HH12:MI AM", "hh:mm a"), ("YYYY-MM-DD\"T\"HH24:MI:SS.FF3", "yyyy-MM-dd'T'HH:mm:ss.SSS"), ("SS.FF", "ss.SSSSSS")],
)
def test_oracle_masks(mask, pattern):
    assert masks.oracle(mask) == pattern


@pytest.mark.parametrize("mask, shown", [("%Y-%m-%d", "2024-02-29"), ("%W %e %M %y", "Thursday 29 February 24"), ("%D", "29th"), ("%T.%f", "13:05:09.123456"), ("%U %u %V %v", "08 09 08 09"), ("%X %x %w %j", "2024 2024 4 060"), ("100%%", "100%"), ("%l:%i %p", "1:05 PM")])
def test_mysql_masks(spark, mask, shown):
    assert one(spark, mysql.date_format(F.col("d"), mask), d=TS) == shown


def test_mysql_weeks_at_the_turn_of_the_year(spark):
    rows = spark.createDataFrame([(dt.date(2023, 1, 1),), (dt.date(2021, 1, 3),), (dt.date(2018, 12, 31),), (dt.date(2022, 1, 1),)], "d date")
    got = [r.r for r in rows.select(mysql.date_format(F.col("d"), "%U %u %V %v").alias("r")).collect()]
    assert got == ["01 00 01 52", "01 00 01 53", "52 53 52 01", "00 00 52 52"]


def test_oracle_functions(spark):
    assert one(spark, oracle.decode(F.lit(None), 1, "a", None, "b", "c")) == "b"
    assert one(spark, oracle.greatest(F.lit(1), F.lit(None))) is None
    assert one(spark, oracle.concat(F.lit("a"), F.lit(None), F.lit(1))) == "a1" and one(spark, oracle.concat(F.lit(None))) is None
    assert one(spark, oracle.trunc(F.col("d"), "IW"), d=TS) == dt.datetime(2024, 2, 26)
    assert one(spark, oracle.trunc(F.col("d"), "DAY", week_start=7), d=TS) == dt.datetime(2024, 2, 25)
    assert one(spark, oracle.trunc(F.col("d"), "MI"), d=TS) == dt.datetime(2024, 2, 29, 13, 5)
    assert one(spark, oracle.add_months(F.col("d"), 1, eom=True), d=TS.date()) == dt.date(2024, 3, 31)
    assert one(spark, oracle.add_months(F.col("d"), 1), d=TS.date()) == dt.date(2024, 3, 29)
    assert one(spark, oracle.to_date(F.lit("29.02.2024"), "DD.MM.YYYY")) == dt.datetime(2024, 2, 29) and one(spark, oracle.to_date(F.lit("31.02.2024"), "DD.MM.YYYY")) is None
    assert one(spark, oracle.to_timestamp(F.lit("2024-02-29 13:05:09.123456789"))) == TS
    assert [one(spark, oracle.instr(F.lit("banana"), "an", *a)) for a in ((1, 1), (1, 2), (3, 1), (-1, 1), (-1, 2), (1, 3))] == [2, 4, 4, 4, 2, 0]
    assert one(spark, oracle.substr(F.lit("hello"), -3, 2)) == "ll" and one(spark, oracle.substr(F.lit("hello"), 0, 2)) == "he" and one(spark, oracle.substr(F.lit("x"), 1, 0)) is None
    assert one(spark, oracle.regexp_replace(F.lit("aXbX"), "(x)", "<\\1>", 3, "i")) == "aXb<X>"
    assert one(spark, oracle.regexp_substr(F.lit("k=1;m=22"), "(\\w)=(\\d+)", nth=2, group=2)) == "22"
    assert one(spark, oracle.regexp_like(F.lit("a\nb"), "a.b")) is False and one(spark, oracle.regexp_like(F.lit("a\nb"), "A.b", "in")) is True
    assert one(spark, oracle.remainder(F.lit(11), 4)) == -1 and one(spark, oracle.mod(F.lit(-7), 3)) == -1 and one(spark, oracle.mod(F.lit(5), 0)) == 5
    assert one(spark, oracle.lnnvl(F.lit(None).cast("boolean"))) is True
    assert one(spark, oracle.asciistr(F.lit("aé😀"))) == "a\\00E9\\D83D\\DE00"
    assert one(spark, oracle.to_char(F.lit(1234.5), "FM9,999.00")) == "1,234.50"
    assert one(spark, oracle.is_json(F.lit('{"a":1}'))) is True and one(spark, oracle.is_json(F.lit("{a"))) is False
    assert one(spark, oracle.xml_element("a", F.lit("x<y"))) == "<a>x&lt;y</a>" and one(spark, oracle.xml_value(F.lit("<a><b>7</b></a>"), "a/b")) == "7"
    assert one(spark, oracle.tz_offset("Asia/Kolkata")) == "+05:30"
    assert one(spark, oracle.substrb(F.lit("éa"), 1, 2)) == "é"
    assert one(spark, oracle.bin_to_num(F.lit(1), F.lit(0), F.lit(1))) == 5
    assert one(spark, oracle.date_plus(F.col("d"), 0.5), d=TS) == TS + dt.timedelta(hours=12)
    assert one(spark, oracle.numtodsinterval(F.lit(1.5), "HOUR")) == dt.timedelta(minutes=90)
    assert one(spark, oracle.from_tz(F.col("d"), "+02:00"), d=TS) == TS - dt.timedelta(hours=2)


def test_mysql_functions(spark):
    assert one(spark, mysql.field(F.lit("b"), "a", "b")) == 2 and one(spark, mysql.field(F.lit("z"), "a", "b")) == 0
    assert one(spark, mysql.makedate(F.lit(2024), F.lit(60))) == dt.date(2024, 2, 29) and one(spark, mysql.makedate(F.lit(2024), F.lit(0))) is None
    assert one(spark, mysql.to_days(F.lit("2007-10-07").cast("date"))) == 733321 and one(spark, mysql.from_days(F.lit(733321))) == dt.date(2007, 10, 7)
    assert one(spark, mysql.addtime(F.col("d"), F.lit("-1:00:00.5")), d=TS) == TS - dt.timedelta(hours=1, milliseconds=500)
    assert one(spark, mysql.date_add(F.col("d"), "1:30", "HOUR_MINUTE"), d=TS) == TS + dt.timedelta(minutes=90)
    assert one(spark, mysql.date_sub(F.col("d"), "1:30", "HOUR_MINUTE"), d=TS) == TS - dt.timedelta(minutes=90)
    assert one(spark, mysql.sec_to_time(F.lit(-363661))) == "-101:01:01" and one(spark, mysql.time_to_sec(F.lit("22:23:00"))) == 80580
    assert one(spark, mysql.period_add(F.lit(202412), 2)) == 202502 and one(spark, mysql.period_diff(F.lit(200802), F.lit(200703))) == 11
    assert [one(spark, mysql.is_ipv4(F.lit(s))) for s in ("10.0.0.255", "1.2.3", "256.1.1.1", "1.2.3.4.")] == [True, False, False, False]
    assert [one(spark, mysql.is_ipv6(F.lit(s))) for s in ("::1", "2001:db8::ff00:42:8329", "1:2:3", "1::2::3", "1:2:3:4:5:6:7:8")] == [True, True, False, False, True]
    assert one(spark, mysql.strcmp(F.lit("a"), F.lit("b"))) == -1 and one(spark, mysql.elt(F.lit(2), "x", "y")) == "y" and one(spark, mysql.elt(F.lit(9), "x")) is None
    assert one(spark, mysql.ord(F.lit("é"))) == 0xC3A9 and one(spark, mysql.quote(F.lit("a'b\\"))) == "'a\\'b\\\\'"
    assert one(spark, mysql.truncate(F.lit(-1.999), 1)) == -1.9 and one(spark, mysql.log(F.lit(0.0))) is None and math.isclose(one(spark, mysql.log(2, F.lit(8.0))), 3)
    assert one(spark, mysql.str_to_date(F.lit("01,5,2013"), "%d,%c,%Y")) == dt.datetime(2013, 5, 1)
    assert one(spark, mysql.timestampdiff("MONTH", F.lit(dt.datetime(2024, 1, 31)), F.lit(dt.datetime(2024, 2, 29)))) == 0
    assert one(spark, mysql.json_extract(F.lit('{"a":{"b":3}}'), "$.a.b")) == "3" and mysql.get_format("DATE", "EUR") == "%d.%m.%Y"
    assert one(spark, mysql.xor(F.lit(True), F.lit(False))) is True and one(spark, mysql.cast(F.lit("12x"), "SIGNED")) is None


def test_tsql_functions(spark):
    assert one(spark, tsql.len_(F.lit("ab  "))) == 2 and one(spark, tsql.datalength(F.lit("ab  "))) == 4
    assert one(spark, tsql.datediff("year", F.lit(dt.datetime(2023, 12, 31)), F.lit(dt.datetime(2024, 1, 1)))) == 1
    assert one(spark, tsql.datediff("week", F.lit(dt.datetime(2024, 3, 2)), F.lit(dt.datetime(2024, 3, 3)))) == 1
    assert [one(spark, tsql.datename(u, F.col("d")), d=TS) for u in ("month", "dw", "dy", "qq", "hh", "ms")] == ["February", "Thursday", "60", "1", "13", "123"]
    assert one(spark, tsql.convert("varchar", F.col("d"), 101), d=TS) == "02/29/2024" and one(spark, tsql.convert("datetime", F.lit("20240229"), 112, to_text=False)) == dt.datetime(2024, 2, 29)
    assert one(spark, tsql.convert("varchar", F.lit("abcdef"), length=3)) == "abc" and one(spark, tsql.convert("int", F.lit("x"))) is None
    assert [one(spark, tsql.patindex(p, F.lit("interesting data"))) for p in ("%ter%", "%en_ure%", "int%", "%[xyd]ata")] == [3, 0, 1, 13]
    assert one(spark, tsql.stuff(F.lit("abcdef"), 2, 3, "ijklmn")) == "aijklmnef" and one(spark, tsql.stuff(F.lit("abc"), 9, 1, "x")) is None
    assert one(spark, tsql.str_(F.lit(123.45), 6, 1)) in (" 123.5", " 123.4") and one(spark, tsql.str_(F.lit(123456.0), 3)) == "***"
    assert [one(spark, tsql.isnumeric(F.lit(s))) for s in ("12.5", "x", "1e5")] == [1, 0, 1] and [one(spark, tsql.isdate(F.lit(s))) for s in ("2024-02-29", "2023-02-29")] == [1, 0]
    assert one(spark, tsql.quotename(F.lit("a]b"))) == "[a]]b]" and one(spark, tsql.nchar(F.lit(233))) == "é" and one(spark, tsql.charindex("a", F.lit("banana"), 3)) == 4


def test_cleaning(spark):
    assert [one(spark, cleaning.as_boolean(F.lit(s))) for s in (" YES", "0", "disabled", "maybe")] == [True, False, False, None]
    assert [one(spark, cleaning.fix_century(F.lit(y))) for y in (48, 49, 99, 1987, 0)] == [2048, 1949, 1999, 1987, 2000]
    assert one(spark, cleaning.fix_zero_date(F.lit("0000-00-00 00:00:00"))) is None
    assert math.isnan(one(spark, cleaning.normalise_float(F.lit("NaN")))) and one(spark, cleaning.normalise_float(F.lit("-Inf"))) == -math.inf and one(spark, cleaning.normalise_float(F.lit("x"))) is None
    assert one(spark, cleaning.raw_to_uuid(F.unhex(F.lit("00112233445566778899AABBCCDDEEFF")))) == "00112233-4455-6677-8899-aabbccddeeff"
    assert one(spark, cleaning.unaccent(F.lit("Éàñ"))) == "ean" and one(spark, cleaning.trim_char(F.lit("xxaxx"), "trailing", "x")) == "xxa"
    df = spark.createDataFrame([("a,b", b"x", 1), ("", None, 2)], "T string, `b.in` binary, n int")
    assert cleaning.rename(df, {"t": "Text"}).columns == ["Text", "b_in", "n"]
    assert [r.T for r in cleaning.modify_type(df, {"T": "array<string>"}).collect()] == [["a", "b"], []]
    assert cleaning.drop_large_objects(df).columns == ["T", "n"]
    assert cleaning.build_struct(df, "s", ["T", "n"]).columns == ["b.in", "s"]
    assert df.where(cleaning.case_insensitive(F.col("T")) == "A,B").count() == 1
    assert df.where(cleaning.eq_or_null(F.col("`b.in`"), None)).count() == 1 and one(spark, cleaning.changed(F.lit(None), F.lit(1))) is True
    assert one(spark, cleaning.decode_text(F.lit(b"\xe9"), "ISO-8859-1")) == "é"


def test_types(spark):
    rows = [("NUMBER", 4, 0), ("NUMBER", 9, 0), ("NUMBER", 18, 0), ("NUMBER", 19, 0), ("NUMBER", None, None), ("NUMBER", 10, 2), ("NUMBER", 20, 5), ("NUMBER", 2, 5), ("VARCHAR2(10)", None, None), ("WEIRD", None, None)]
    catalog = spark.createDataFrame([(*r, 22) for r in rows], "data_type string, data_precision int, data_scale int, data_length int")
    got = [(r.spark_type, r.needs_review) for r in types.map_types(catalog).collect()]
    assert [g[0] for g in got] == ["smallint", "int", "bigint", "decimal(19,0)", "bigint", "double", "decimal(20,5)", "decimal(38,5)", "string", "string"]
    assert [i for i, g in enumerate(got) if g[1]] == [4, 9]
    assert types.map_types(catalog, overrides={"NUMBER": "decimal(38,10)"}).first().spark_type == "decimal(38,10)"
    assert types.map_types(spark.createDataFrame([("BIGINT UNSIGNED", None, None, 8), ("SET", None, None, 1)], catalog.schema), "mysql").select("spark_type").collect()[0][0] == "decimal(20,0)"
    df = spark.createDataFrame([(5, 123456)], "a long, b long")
    assert dict(types.narrow_numeric(df, {"a": (4, 0), "b": (4, 0)}).dtypes) == {"a": "smallint", "b": "bigint"}
