"""Oracle's scalar functions as Columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrywright.functions import masks, numbers
from ferrywright.operators.selection import regexp_flags


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def nvl(a: Column, b) -> Column:
    return F.coalesce(a, _lit(b))


def nvl2(a: Column, b, c) -> Column:
    return F.when(a.isNotNull(), _lit(b)).otherwise(_lit(c))


def decode(x: Column, *pairs) -> Column:
    """DECODE(x, s1, r1, .., default); a null matches a null."""
    out = _lit(pairs[-1]) if len(pairs) % 2 else F.lit(None)
    for i in range(len(pairs) // 2 * 2 - 2, -1, -2):
        out = F.when(x.eqNullSafe(_lit(pairs[i])), _lit(pairs[i + 1])).otherwise(out)
    return out


# Formats of TRUNC and the unit that each one keeps.
TRUNC_UNITS = {
    "year": ("SYYYY", "YYYY", "YEAR", "SYEAR", "YYY", "YY", "Y"), "quarter": ("Q",), "month": ("MONTH", "MON", "MM", "RM"), "week": ("IW", "DAY", "DY", "D"), "day": ("DDD", "DD", "J"), "hour": ("HH", "HH12", "HH24"), "minute": ("MI",),
}


def trunc(d: Column, fmt: str = "DD", week_start: int = 1) -> Column:
    """TRUNC of a date; weeks begin on Monday, or with ``week_start`` 7 on Sunday for DAY, DY and D."""
    unit = next((u for u, names in TRUNC_UNITS.items() if fmt.upper() in names), None)
    if unit is None:
        raise ValueError(f"unknown format {fmt}")
    if unit == "week" and week_start == 7 and fmt.upper() != "IW":
        return F.date_trunc("week", d + F.expr("interval 1 day")) - F.expr("interval 1 day")
    return F.date_trunc(unit, d)


def trunc_number(x: Column, n: int = 0) -> Column:
    """TRUNC of a number: towards zero."""
    return numbers.cut(x, n)


def add_months(d: Column, n, eom: bool = False) -> Column:
    """ADD_MONTHS; with ``eom`` the last day of a month stays the last day."""
    moved = F.add_months(d, _lit(n))
    return F.when(F.to_date(d) == F.last_day(d), F.last_day(moved)).otherwise(moved) if eom else moved


def add_years(d: Column, n: int) -> Column:
    return F.add_months(d, 12 * n)


def last_day(d: Column) -> Column:
    return F.last_day(d)


def next_day(d: Column, day: str) -> Column:
    return F.next_day(d, day)


def months_between(a: Column, b: Column) -> Column:
    return F.months_between(a, b)


def sysdate(days: float = 0.0) -> Column:
    """SYSDATE plus days and fractions of a day."""
    return F.date_trunc("second", F.current_timestamp()) + F.make_dt_interval(secs=F.lit(int(days * 86400)).cast("decimal(18,6)"))


def systimestamp() -> Column:
    return F.current_timestamp()


def date_plus(d: Column, days) -> Column:
    """Date plus a number of days; fractions count as seconds."""
    return d + F.make_dt_interval(secs=F.round(_lit(days) * 86400, 0).cast("decimal(18,6)"))


def numtodsinterval(n: Column, unit: str) -> Column:
    seconds = {"DAY": 86400, "HOUR": 3600, "MINUTE": 60, "SECOND": 1}[unit.upper()]
    return F.make_dt_interval(secs=(n * seconds).cast("decimal(18,6)"))


def numtoyminterval(n: Column, unit: str) -> Column:
    months = F.round(n * (12 if unit.upper() == "YEAR" else 1)).cast("int")
    return F.make_ym_interval(F.lit(0), months)


def to_date(s: Column, mask: str = "YYYY-MM-DD") -> Column:
    """TO_DATE: a timestamp without fraction; texts that do not fit are null."""
    return F.date_trunc("second", F.try_to_timestamp(s, F.lit(masks.oracle(mask))))


def to_timestamp(s: Column, mask: str = "YYYY-MM-DD HH24:MI:SS.FF") -> Column:
    """TO_TIMESTAMP; nine digits of a fraction are cut to six."""
    return F.try_to_timestamp(F.regexp_replace(s, r"(\.\d{6})\d+", "$1"), F.lit(masks.oracle(mask)))


def to_char(x: Column, mask: str | None = None, time_zones: bool = True) -> Column:
    """TO_CHAR: plain, a number by a mask of 9, 0, comma, point, $ and D or G, or a date by its mask."""
    if mask is None:
        return x.cast("string")
    if set(mask.upper().removeprefix("FM")) <= set("90,.$DGSL"):
        plain = mask.upper().removeprefix("FM").replace("D", ".").replace("G", ",").replace("L", "$")
        shown = F.to_char(x, F.lit(plain))
        return F.ltrim(shown) if mask.upper().startswith("FM") else shown
    return F.date_format(x, masks.oracle(mask, time_zones))


def to_number(s: Column, mask: str | None = None) -> Column:
    """TO_NUMBER: an empty text and a text that is no number are null."""
    return F.try_to_number(s, F.lit(mask)) if mask else F.nullif(F.trim(s), F.lit("")).try_cast("decimal(38,10)")


def from_tz(ts: Column, zone: str) -> Column:
    """A timestamp without zone, meant in a zone or offset, as a moment."""
    return F.to_utc_timestamp(ts, zone)


def sys_extract_utc(ts: Column, session_zone: str = "UTC") -> Column:
    return F.to_utc_timestamp(ts, session_zone)


def trim(x: Column) -> Column:
    return F.trim(x)


def instr(s: Column, p: str, position: int = 1, nth: int = 1) -> Column:
    """INSTR with start and occurrence, overlapping ones too; a negative start searches backwards from there; 0 if not found."""
    if position >= 1 and nth == 1:
        return F.locate(p, s, position)
    n = len(p)
    starts = F.filter(F.sequence(F.lit(1), F.greatest(F.length(s), F.lit(1))), lambda i: F.substr(s, i, F.lit(n)) == p)
    if position > 0:
        found = F.filter(starts, lambda i: i >= position)
        return F.when(s.isNotNull(), F.coalesce(F.get(found, F.lit(nth - 1)), F.lit(0)))
    found = F.reverse(F.filter(starts, lambda i: i <= F.length(s) + position + 1))
    return F.when(s.isNotNull(), F.coalesce(F.get(found, F.lit(nth - 1)), F.lit(0)))


def substr(s: Column, start: int, length: int | None = None) -> Column:
    return F.substr(s, F.lit(start)) if length is None else F.when(F.lit(length > 0), F.nullif(F.substr(s, F.lit(start), F.lit(max(0, length))), F.lit("")))


def substrb(s: Column, start: int, length: int) -> Column:
    """Bytes of the text; a cut character is replaced."""
    return F.decode(F.substring(F.encode(s, "UTF-8"), start, length), "UTF-8")


def replace(s: Column, p: str, r: str = "") -> Column:
    return F.replace(s, F.lit(p), F.lit(r))


def regexp_like(s: Column, pattern: str, flags: str | None = None) -> Column:
    return s.rlike(regexp_flags(flags) + pattern)


def regexp_count(s: Column, pattern: str, position: int = 1, flags: str | None = None) -> Column:
    return F.regexp_count(F.substr(s, F.lit(position)), F.lit(regexp_flags(flags) + pattern))


def regexp_substr(s: Column, pattern: str, position: int = 1, nth: int = 1, flags: str | None = None, group: int = 0) -> Column:
    """The nth match from a position, or one of its groups; null if there is none."""
    return F.get(F.regexp_extract_all(F.substr(s, F.lit(position)), F.lit(regexp_flags(flags) + pattern), F.lit(group)), F.lit(nth - 1))


def regexp_replace(s: Column, pattern: str, replacement: str = "", position: int = 1, flags: str | None = None) -> Column:
    """All matches from a position; back-references are written \\1."""
    java = replacement.replace("$", r"\$")
    for i in range(1, 10):
        java = java.replace(f"\\{i}", f"${i}")
    if position == 1:
        return F.regexp_replace(s, regexp_flags(flags) + pattern, java)
    return F.concat(F.substr(s, F.lit(1), F.lit(position - 1)), F.regexp_replace(F.substr(s, F.lit(position)), regexp_flags(flags) + pattern, java))


def regexp_instr(s: Column, pattern: str, position: int = 1, nth: int = 1, end: bool = False, flags: str | None = None) -> Column:
    """Where the nth match from a position begins, or what follows it with ``end``; 0 if there is none."""
    regex = regexp_flags(flags) + pattern
    rest = F.substr(s, F.lit(position))
    found = F.regexp_extract_all(rest, F.lit(regex), F.lit(0))
    # Gaps and matches take turns: the place is the length of all before it.
    before = F.slice(F.split(rest, regex, -1), 1, nth)
    length = lambda parts: F.aggregate(parts, F.lit(0), lambda n, x: n + F.length(x))
    at = F.lit(position) + length(before) + length(F.slice(found, 1, nth if end else nth - 1))
    return F.when(F.size(found) >= nth, at).when(s.isNotNull(), 0)


def bitand(a: Column, b) -> Column:
    return a.bitwiseAND(_lit(b))


def mod(a: Column, b) -> Column:
    """The remainder with the dividend's sign; by zero it is the dividend."""
    return F.when(_lit(b) == 0, a).otherwise(F.try_mod(a, _lit(b)))


def round_half_up(x: Column, n: int = 0) -> Column:
    return F.round(x.cast("decimal(38,10)"), n)


def greatest(*columns: Column) -> Column:
    """Null if any is null."""
    return _none_if_any_null(F.greatest(*columns), columns)


def least(*columns: Column) -> Column:
    return _none_if_any_null(F.least(*columns), columns)


def _none_if_any_null(value: Column, columns) -> Column:
    some = columns[0].isNull()
    for c in columns[1:]:
        some = some | c.isNull()
    return F.when(~some, value)


def concat(*columns: Column) -> Column:
    """``||``: a null is an empty text, and an empty result a null."""
    return F.nullif(F.concat(*[F.coalesce(c.cast("string"), F.lit("")) for c in columns]), F.lit(""))


def lob_getlength(x: Column) -> Column:
    return F.octet_length(x)


def lob_substr(x: Column, n: int, position: int = 1) -> Column:
    return F.substr(x, F.lit(position), F.lit(n))


def edit_distance(a: Column, b: Column) -> Column:
    return F.levenshtein(a, b)


def cast_to_raw(x: Column) -> Column:
    return F.encode(x, "UTF-8")


def sys_guid() -> Column:
    return F.upper(F.replace(F.uuid(), F.lit("-"), F.lit("")))


def is_json(x: Column) -> Column:
    return F.try_parse_json(x).isNotNull()


def nextval(start: int = 1, increment: int = 1) -> Column:
    """Numbers for a load: unique and rising, with gaps between partitions."""
    return F.monotonically_increasing_id() * increment + start


def gapless(df: DataFrame, order: Sequence[Column], name: str = "id", last: int = 0, increment: int = 1) -> DataFrame:
    """Numbers of a sequence without gaps: row numbers over ranges, going on from the last one used."""
    from ferrywright.operators.relational import with_rownum

    return with_rownum(df, order, name).withColumn(name, F.col(name) * increment + last)


def interval(text: str, unit: str) -> Column:
    """INTERVAL 'text' unit, as ``'3' DAY``, ``'1-6' YEAR TO MONTH`` or ``'2 10:30:00' DAY TO SECOND``."""
    return F.expr(f"interval '{text}' {unit.lower()}".replace(";", ""))


def nanvl(a: Column, b) -> Column:
    return F.nanvl(a, _lit(b))


def lnnvl(condition: Column) -> Column:
    """True if the condition is false or unknown."""
    return ~F.coalesce(condition, F.lit(False))


def remainder(x: Column, y) -> Column:
    return x - _lit(y) * F.bround(x / _lit(y))


def hextoraw(x: Column) -> Column:
    return F.unhex(x)


def rawtohex(x: Column) -> Column:
    return F.hex(x)


def bin_to_num(*bits: Column) -> Column:
    out = F.lit(0).cast("long")
    for b in bits:
        out = out * 2 + b.cast("long")
    return out


def asciistr(x: Column) -> Column:
    """Characters beyond ASCII as \\XXXX, in code units of UTF-16."""
    units = F.transform(F.split(x, ""), lambda c: F.when(F.ascii(c) < 128, c).otherwise(F.regexp_replace(F.hex(F.encode(c, "UTF-16BE")), "(.{4})", r"\\$1")))
    return F.array_join(units, "")


def new_time(d: Column, from_zone: str, to_zone: str) -> Column:
    return F.convert_timezone(F.lit(from_zone), F.lit(to_zone), d.cast("timestamp_ntz"))


def tz_offset(zone: str, at: Column | None = None) -> Column:
    at = F.current_timestamp() if at is None else at
    minutes = F.timestamp_diff("MINUTE", F.to_utc_timestamp(at, zone), at)
    return F.concat(F.when(minutes < 0, "-").otherwise("+"), F.lpad((F.abs(minutes) / 60).cast("int").cast("string"), 2, "0"), F.lit(":"), F.lpad((F.abs(minutes) % 60).cast("string"), 2, "0"))


def vsize(x: Column) -> Column:
    return F.octet_length(x.cast("string"))


def xml_element(name: str, *content: Column) -> Column:
    """XMLELEMENT: texts are escaped."""
    body = F.concat(*[F.coalesce(_escape(c.cast("string")), F.lit("")) for c in content]) if content else F.lit("")
    return F.concat(F.lit(f"<{name}>"), body, F.lit(f"</{name}>"))


def _escape(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


def from_xml(x: Column, schema: str) -> Column:
    """An XML document as a struct of the given schema."""
    return F.from_xml(x, schema)


def xml_cdata(x: Column) -> Column:
    return F.concat(F.lit("<![CDATA["), x, F.lit("]]>"))


def xml_value(x: Column, path: str) -> Column:
    return F.xpath_string(x, F.lit(path))
