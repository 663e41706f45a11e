"""T-SQL's scalar functions as Columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrywright.functions import masks


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def getdate() -> Column:
    return F.date_trunc("millisecond", F.current_timestamp())


def getutcdate(session_zone: str = "UTC") -> Column:
    return F.to_utc_timestamp(getdate(), session_zone)


def sysdatetime() -> Column:
    return F.current_timestamp()


def len_(s: Column) -> Column:
    """Trailing spaces do not count."""
    return F.length(F.rtrim(s))


def datalength(s: Column) -> Column:
    return F.octet_length(s)


def isnull(a: Column, b) -> Column:
    return F.coalesce(a, _lit(b))


def space(n: Column) -> Column:
    return F.repeat(F.lit(" "), n)


def replicate(s: Column, n: int) -> Column:
    return F.repeat(s, n)


def charindex(p: str, s: Column, position: int = 1) -> Column:
    """An absolute place, 0 if not found."""
    return F.locate(p, s, max(1, position))


# Names and abbreviations of date parts.
UNITS = {
    "YEAR": ("year", "yy", "yyyy"), "QUARTER": ("quarter", "qq", "q"), "MONTH": ("month", "mm", "m"), "DOY": ("dayofyear", "dy", "y"), "DAY": ("day", "dd", "d"), "WEEK": ("week", "wk", "ww"), "DOW": ("weekday", "dw", "w"),
    "HOUR": ("hour", "hh"), "MINUTE": ("minute", "mi", "n"), "SECOND": ("second", "ss", "s"), "MILLISECOND": ("millisecond", "ms"), "MICROSECOND": ("microsecond", "mcs"), "ISOWEEK": ("iso_week", "isowk", "isoww"),
}


def unit_of(name: str) -> str:
    return next(u for u, names in UNITS.items() if name.lower() in names)


def datepart(name: str, d: Column) -> Column:
    """A date part as a whole number; weekday counts from Sunday, 1; week is the ISO week plus one as in datename."""
    unit = unit_of(name)
    if unit == "DOY":
        return F.dayofyear(d)
    if unit == "DOW":
        return F.dayofweek(d)
    if unit == "WEEK":
        return F.weekofyear(d) + 1
    if unit == "ISOWEEK":
        return F.weekofyear(d)
    if unit in ("MILLISECOND", "MICROSECOND"):
        return F.date_format(d, "SSS" if unit == "MILLISECOND" else "SSSSSS").cast("int")
    return F.date_part(F.lit(unit), d).cast("int")


def datename(name: str, d: Column) -> Column:
    unit = unit_of(name)
    if unit == "MONTH":
        return F.date_format(d, "MMMM")
    if unit == "DOW":
        return F.date_format(d, "EEEE")
    return datepart(name, d).cast("string")


def dateadd(name: str, n, d: Column) -> Column:
    unit = {"DOY": "DAY", "DOW": "DAY", "ISOWEEK": "WEEK"}.get(unit_of(name), unit_of(name))
    return F.timestamp_add(unit, _lit(n).cast("int"), d)


def datediff(name: str, a: Column, b: Column) -> Column:
    """Boundaries of the unit that lie between a and b; weeks begin on Sunday."""
    unit = {"DOY": "DAY", "DOW": "DAY", "ISOWEEK": "WEEK"}.get(unit_of(name), unit_of(name))
    if unit == "WEEK":
        return F.timestamp_diff("WEEK", F.date_trunc("week", a + F.expr("interval 1 day")), F.date_trunc("week", b + F.expr("interval 1 day")))
    return F.timestamp_diff(unit, F.date_trunc(unit, a), F.date_trunc(unit, b))


def convert(kind: str, x: Column, style: int | None = None, length: int | None = None, to_text: bool = True) -> Column:
    """CONVERT: with a style a date to text, or text to a date with ``to_text`` false; else a cast, null if it does not fit, cut to a length."""
    if style is not None:
        pattern = masks.tsql_style(style)
        return F.date_format(x, pattern) if to_text else F.try_to_timestamp(x, F.lit(pattern))
    names = {"varchar": "string", "nvarchar": "string", "char": "string", "nchar": "string", "datetime": "timestamp", "datetime2": "timestamp", "bit": "boolean", "money": "decimal(19,4)", "uniqueidentifier": "string"}
    out = x.try_cast(names.get(kind.lower(), kind))
    return F.substr(out, F.lit(1), F.lit(length)) if length else out


def newid() -> Column:
    return F.upper(F.uuid())


def iif(condition: Column, a, b) -> Column:
    return F.when(condition, _lit(a)).otherwise(_lit(b))


def nullif(a: Column, b) -> Column:
    return F.nullif(a, _lit(b))


def isnumeric(s: Column) -> Column:
    return F.when(s.try_cast("double").isNotNull() & ~F.lower(s).rlike("nan|inf"), 1).otherwise(0)


def isdate(s: Column) -> Column:
    return F.when(F.try_to_timestamp(s).isNotNull(), 1).otherwise(0)


def patindex(pattern: str, s: Column) -> Column:
    """PATINDEX of a LIKE pattern with %, _ and [sets]."""
    inner = pattern.removeprefix("%").removesuffix("%")
    regex, at = "", 0
    while at < len(inner):
        c = inner[at]
        if c == "[" and (end := inner.find("]", at)) > 0:
            regex += "[" + inner[at + 1 : end].replace("\\", "\\\\") + "]"
            at = end
        else:
            regex += ".*" if c == "%" else "." if c == "_" else "\\" + c if not c.isalnum() and not c.isspace() else c
        at += 1
    regex = ("" if pattern.startswith("%") else "^") + regex + ("" if pattern.endswith("%") else "$")
    return F.regexp_instr(s, F.lit(f"(?is){regex}"))


def stuff(s: Column, start: int, n: int, r: str) -> Column:
    return F.when((F.lit(start) >= 1) & (F.lit(start) <= F.length(s)), F.overlay(s, F.lit(r), F.lit(start), F.lit(n)))


def str_(x: Column, length: int = 10, decimals: int = 0) -> Column:
    """A number as text of a fixed length; stars if it does not fit."""
    text = F.replace(F.format_number(x, decimals), F.lit(","), F.lit(""))
    return F.when(F.length(text) > length, F.lit("*" * length)).otherwise(F.lpad(text, length, " "))


def square(x: Column) -> Column:
    return x * x


def unicode(s: Column) -> Column:
    return F.ascii(s)


def nchar(n: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(n.cast("long")), 8, "0")), "UTF-32")


def quotename(s: Column) -> Column:
    return F.concat(F.lit("["), F.replace(s, F.lit("]"), F.lit("]]")), F.lit("]"))


def soundex(s: Column) -> Column:
    return F.soundex(s)


def rand(seed: int | None = None) -> Column:
    return F.rand(seed)


def datefromparts(y: Column, m: Column, d: Column) -> Column:
    return F.make_date(y, m, d)


def atn2(y: Column, x: Column) -> Column:
    return F.atan2(y, x)


def pivot(df: DataFrame, keys: list[str], column: str, values: list, aggregate: Column) -> DataFrame:
    """PIVOT with listed values: one pass, no look for distinct ones."""
    return df.groupBy(*keys).pivot(column, values).agg(aggregate)


def unpivot(df: DataFrame, keys: list[str], columns: list[str], name: str, value: str) -> DataFrame:
    """UNPIVOT: nulls are left out."""
    return df.unpivot(keys, columns, name, value).where(F.col(value).isNotNull())


def next_value_for(df: DataFrame, name: str, last: int, order: list[Column], increment: int = 1) -> DataFrame:
    """``NEXT VALUE FOR`` a sequence over (order): a number a row, going on from the last one used, without gaps."""
    from ferrywright.functions.oracle import gapless

    return gapless(df, order, name, last, increment)
