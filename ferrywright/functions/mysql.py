"""MySQL's scalar functions as Columns."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ferrywright.functions import masks, numbers


def _lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def if_(condition: Column, a, b) -> Column:
    return F.when(condition, _lit(a)).otherwise(_lit(b))


def ifnull(a: Column, b) -> Column:
    return F.coalesce(a, _lit(b))


def isnull(a: Column) -> Column:
    return a.isNull().cast("int")


# Compound units of EXTRACT and their digits.
EXTRACT_PATTERNS = {
    "YEAR_MONTH": "yyyyMM", "DAY_HOUR": "ddHH", "DAY_MINUTE": "ddHHmm", "DAY_SECOND": "ddHHmmss", "DAY_MICROSECOND": "ddHHmmssSSSSSS", "HOUR_MINUTE": "HHmm", "HOUR_SECOND": "HHmmss",
    "HOUR_MICROSECOND": "HHmmssSSSSSS", "MINUTE_SECOND": "mmss", "MINUTE_MICROSECOND": "mmssSSSSSS", "SECOND_MICROSECOND": "ssSSSSSS",
}


def extract(unit: str, d: Column, as_text: bool = False) -> Column:
    """EXTRACT of a compound unit as a number or its digits, or of a plain one."""
    if unit.upper() not in EXTRACT_PATTERNS:
        return F.date_part(F.lit(unit), d)
    text = F.date_format(d, EXTRACT_PATTERNS[unit.upper()])
    return text if as_text else text.cast("long")


def pipes(a: Column, b: Column, as_concat: bool = False) -> Column:
    """``a || b``: OR, or with PIPES_AS_CONCAT the texts one after the other."""
    return F.concat(a, b) if as_concat else a.cast("boolean") | b.cast("boolean")


def uuid() -> Column:
    return F.uuid()


def log10(x: Column) -> Column:
    return F.when(x > 0, F.log10(x))


def log2(x: Column) -> Column:
    return F.when(x > 0, F.log2(x))


def pow(x: Column, y) -> Column:
    return F.pow(x, _lit(y))


def hex(x: Column) -> Column:
    return F.hex(x)


def unhex(x: Column) -> Column:
    return F.unhex(x)


def xor(a: Column, b: Column) -> Column:
    return a != b


def atan(y: Column, x: Column | None = None) -> Column:
    return F.atan(y) if x is None else F.atan2(y, x)


def log(a, b: Column | None = None) -> Column:
    """LOG(x) is natural, LOG(base, x) is not; nothing for arguments that have no logarithm."""
    if b is None:
        return F.when(a > 0, F.ln(a))
    return F.when((_lit(a) > 1) & (b > 0), F.ln(b) / F.ln(_lit(a)))


def truncate(x: Column, n: int) -> Column:
    """TRUNCATE(x, n): towards zero, by the digits that the number shows, so that 0.29 to two places is 0.29. A double comes back as one."""
    return numbers.cut(x, n)


def mod(a: Column, b) -> Column:
    return F.try_mod(a, _lit(b))


def now() -> Column:
    return F.date_trunc("second", F.current_timestamp())


def curdate() -> Column:
    return F.current_date()


def curtime() -> Column:
    return F.date_format(now(), "HH:mm:ss")


def utc_timestamp(session_zone: str = "UTC") -> Column:
    return F.to_utc_timestamp(now(), session_zone)


def unix_timestamp(d: Column | None = None) -> Column:
    return F.unix_timestamp() if d is None else F.unix_timestamp(d.cast("timestamp"))


def from_unixtime(n: Column, mask: str | None = None) -> Column:
    moment = F.timestamp_seconds(n)
    return moment if mask is None else date_format(moment, mask)


def convert_tz(d: Column, from_zone: str, to_zone: str) -> Column:
    return F.convert_timezone(F.lit(from_zone), F.lit(to_zone), d.cast("timestamp_ntz"))


def datediff(a: Column, b: Column) -> Column:
    return F.datediff(a, b)


def _week(d: Column, mode: int) -> Column:
    """Week numbers of modes 0 to 3: weeks from Sunday (0, 2) or Monday (1, 3), those of 2 and 3 from 1 to 53."""
    if mode == 3:
        return F.weekofyear(d)
    day = F.dayofyear(d)
    if mode == 0:
        return F.floor((day + 6 - (F.dayofweek(d) - 1)) / 7).cast("int")
    if mode == 1:
        first = F.weekday(F.date_trunc("year", d))
        return (F.floor((day - 1 + first) / 7) + F.when(first <= 3, 1).otherwise(0)).cast("int")
    own = _week(d, 0)
    before = F.last_day(F.add_months(F.trunc(d, "year"), -1))
    return F.when(own > 0, own).otherwise(_week(before, 0))


def date_format(d: Column, mask: str) -> Column:
    """DATE_FORMAT: elements without a pattern letter (%D %U %u %V %v %X %x %w %j) by expression."""
    parts: list[Column] = []
    plain = ""
    for part in re.findall("%.|[^%]+|%$", mask, re.S):
        special = _special(d, part[1:]) if part[0] == "%" and len(part) == 2 else None
        if special is None:
            plain += part
            continue
        if plain:
            parts.append(F.date_format(d, masks.mysql(plain)))
            plain = ""
        parts.append(special)
    if plain:
        parts.append(F.date_format(d, masks.mysql(plain)))
    return F.concat(*parts) if parts else F.lit("")


def _special(d: Column, letter: str) -> Column | None:
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    if letter == "D":
        day = F.dayofmonth(d)
        end = F.when(day.between(11, 13), "th").when(day % 10 == 1, "st").when(day % 10 == 2, "nd").when(day % 10 == 3, "rd").otherwise("th")
        return F.concat(day.cast("string"), end)
    if letter in "Uu":
        return two(_week(d, 0 if letter == "U" else 1))
    if letter in "Vv":
        return two(_week(d, 2 if letter == "V" else 3))
    if letter in "Xx":
        week = _week(d, 2 if letter == "X" else 3)
        year = F.year(d) - F.when((week >= 52) & (F.month(d) == 1), 1).otherwise(0) + F.when((week == 1) & (F.month(d) == 12), 1).otherwise(0)
        return F.lpad(year.cast("string"), 4, "0")
    if letter == "w":
        return (F.dayofweek(d) - 1).cast("string")
    if letter == "j":
        return F.lpad(F.dayofyear(d).cast("string"), 3, "0")
    return None


def time_format(d: Column, mask: str) -> Column:
    return date_format(d, mask)


def str_to_date(s: Column, mask: str) -> Column:
    return F.try_to_timestamp(s, F.lit(masks.mysql(mask)))


# GET_FORMAT masks by kind and standard.
FORMATS = {
    ("DATE", "USA"): "%m.%d.%Y", ("DATE", "JIS"): "%Y-%m-%d", ("DATE", "ISO"): "%Y-%m-%d", ("DATE", "EUR"): "%d.%m.%Y", ("DATE", "INTERNAL"): "%Y%m%d",
    ("DATETIME", "USA"): "%Y-%m-%d %H.%i.%s", ("DATETIME", "JIS"): "%Y-%m-%d %H:%i:%s", ("DATETIME", "ISO"): "%Y-%m-%d %H:%i:%s", ("DATETIME", "EUR"): "%Y-%m-%d %H.%i.%s", ("DATETIME", "INTERNAL"): "%Y%m%d%H%i%s",
    ("TIME", "USA"): "%h:%i:%s %p", ("TIME", "JIS"): "%H:%i:%s", ("TIME", "ISO"): "%H:%i:%s", ("TIME", "EUR"): "%H.%i.%s", ("TIME", "INTERNAL"): "%H%i%s",
}


def get_format(kind: str, standard: str) -> str:
    return FORMATS[kind.upper(), standard.upper()]


def date_add(d: Column, n, unit: str = "DAY") -> Column:
    """DATE_ADD with an interval; compound units take a text such as '1:30'."""
    unit = unit.upper()
    if "_" not in unit:
        return F.timestamp_add(unit, _lit(n).cast("int"), d)
    parts = unit.split("_")
    order = ["YEAR", "MONTH"] if parts[0] == "YEAR" else ["DAY", "HOUR", "MINUTE", "SECOND", "MICROSECOND"]
    units = order[order.index(parts[0]) : order.index(parts[1]) + 1]
    sign = -1 if isinstance(n, str) and n.lstrip().startswith("-") else 1
    values = [int(v) * sign for v in re.findall(r"\d+", str(n))]
    if units == ["YEAR", "MONTH"]:
        # One step of months, as the end of a shorter month counts once.
        return F.timestamp_add("MONTH", F.lit(sum(v * m for v, m in zip(values[::-1], (1, 12), strict=False))), d)
    for u, v in zip(units[-len(values) :], values, strict=True):
        d = F.timestamp_add(u, F.lit(v), d)
    return d


def date_sub(d: Column, n, unit: str = "DAY") -> Column:
    return date_add(d, f"-{n}" if isinstance(n, str) else -_lit(n) if isinstance(n, Column) else -n, unit)


def _seconds(t: Column) -> Column:
    """A time text [-]h:m[:s[.f]] as seconds."""
    parts = F.split(F.regexp_replace(t, "^-", ""), ":")
    part = lambda i: F.coalesce(F.get(parts, F.lit(i)).try_cast("decimal(18,6)"), F.lit(0).cast("decimal(18,6)"))
    total = part(0) * 3600 + part(1) * 60 + part(2)
    return F.when(t.startswith("-"), -total).otherwise(total).cast("decimal(18,6)")


def addtime(d: Column, t: Column) -> Column:
    return d + F.make_dt_interval(secs=_seconds(t))


def subtime(d: Column, t: Column) -> Column:
    return d - F.make_dt_interval(secs=_seconds(t))


def dayname(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def monthname(d: Column) -> Column:
    return F.date_format(d, "MMMM")


def dayofweek(d: Column) -> Column:
    """Sunday is 1."""
    return F.dayofweek(d)


def weekday(d: Column) -> Column:
    """Monday is 0."""
    return F.weekday(d)


def microsecond(d: Column) -> Column:
    return F.date_format(d, "SSSSSS").cast("int")


def week(d: Column) -> Column:
    """The ISO week less one."""
    return F.weekofyear(d) - 1


def weekofyear(d: Column) -> Column:
    return F.weekofyear(d)


def makedate(year: Column, day: Column) -> Column:
    return F.when(day > 0, F.date_add(F.make_date(year, F.lit(1), F.lit(1)), day.cast("int") - 1))


def maketime(h: Column, m: Column, s: Column) -> Column:
    return F.make_dt_interval(hours=h, mins=m, secs=s.cast("decimal(18,6)"))


#: Days from year 0 to 1970-01-01.
EPOCH_DAYS = 719528


def to_days(d: Column) -> Column:
    return F.datediff(d, F.lit("1970-01-01")) + EPOCH_DAYS


def from_days(n: Column) -> Column:
    return F.date_add(F.lit("1970-01-01").cast("date"), (n - EPOCH_DAYS).cast("int"))


def sec_to_time(n: Column) -> Column:
    a = F.abs(n).cast("long")
    two = lambda c: F.when(c < 10, F.concat(F.lit("0"), c.cast("string"))).otherwise(c.cast("string"))
    return F.concat(F.when(n < 0, "-").otherwise(""), two(F.floor(a / 3600)), F.lit(":"), two(F.floor(a / 60) % 60), F.lit(":"), two(a % 60))


def time_to_sec(t: Column) -> Column:
    return _seconds(t).cast("long")


def time(d: Column) -> Column:
    return F.date_format(d, "HH:mm:ss")


def timediff(a: Column, b: Column) -> Column:
    return sec_to_time(F.unix_timestamp(a) - F.unix_timestamp(b))


def timestamp(d: Column, t: Column) -> Column:
    return addtime(d.cast("timestamp"), t)


def timestampadd(unit: str, n, d: Column) -> Column:
    return F.timestamp_add(unit, _lit(n).cast("int"), d)


def timestampdiff(unit: str, a: Column, b: Column) -> Column:
    """Whole elapsed units from a to b; months by calendar fields, less one if the day and time of the month are not reached yet, and quarters and years of these."""
    size = {"MONTH": 1, "QUARTER": 3, "YEAR": 12}.get(unit.upper())
    if size is None:
        return F.timestamp_diff(unit, a, b)
    number = lambda x: F.year(x) * 12 + F.month(x)
    within = lambda x: F.date_format(x, "ddHHmmssSSSSSS")
    short = F.when((b >= a) & (within(b) < within(a)), -1).when((b < a) & (within(b) > within(a)), 1).otherwise(0)
    months = number(b) - number(a) + short
    return (F.signum(months) * F.floor(F.abs(months) / size)).cast("long")


def format(n: Column, d: int) -> Column:
    return F.format_number(n, d)


def bin(x: Column) -> Column:
    return F.bin(x)


def bit_count(x: Column) -> Column:
    return F.bit_count(x)


def bit_xor(a: Column, b: Column) -> Column:
    return a.bitwiseXOR(b)


def char(*codes: Column) -> Column:
    return F.concat(*[F.char(c) for c in codes])


def ord(x: Column) -> Column:
    """The number that the first character's bytes make."""
    return F.conv(F.hex(F.encode(F.substring(x, 1, 1), "UTF-8")), 16, 10).cast("long")


def elt(n: Column, *texts) -> Column:
    return F.get(F.array(*map(_lit, texts)), n - 1)


def field(x: Column, *texts) -> Column:
    """The place of x in the list, 0 without one."""
    return F.coalesce(F.array_position(F.array(*map(_lit, texts)), x), F.lit(0)).cast("int")


def find_in_set(x: Column, csv: Column) -> Column:
    return F.find_in_set(x, csv)


def locate(p: str, s: Column, position: int = 1) -> Column:
    return F.locate(p, s, position)


def mid(s: Column, position: int, n: int) -> Column:
    return F.substr(s, F.lit(position), F.lit(n))


def space(n: Column) -> Column:
    return F.repeat(F.lit(" "), n)


def strcmp(a: Column, b: Column) -> Column:
    return F.when(a == b, 0).when(a < b, -1).when(a > b, 1)


def quote(s: Column) -> Column:
    inner = F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
    return F.coalesce(F.concat(F.lit("'"), inner, F.lit("'")), F.lit("NULL"))


def from_base64(s: Column) -> Column:
    return F.unbase64(s)


def to_base64(s: Column) -> Column:
    return F.base64(s)


def is_ipv4(s: Column) -> Column:
    return F.coalesce(s.rlike(r"^(?:(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)(?:\.(?!$)|$)){4}$"), F.lit(False))


def is_ipv6(s: Column) -> Column:
    groups = F.size(F.filter(F.split(s, ":"), lambda g: g != ""))
    plain = s.rlike("^(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$")
    short = s.rlike("^(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})*)?::(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4})*)?$") & (groups <= 7)
    return F.coalesce(plain | short, F.lit(False))


def json_extract(doc: Column, path: str) -> Column:
    return F.get_json_object(doc, path)


def cast(x: Column, kind: str) -> Column:
    """CAST: SIGNED, UNSIGNED and the usual types; null if it does not fit."""
    return x.try_cast({"SIGNED": "bigint", "UNSIGNED": "decimal(20,0)", "CHAR": "string", "DATETIME": "timestamp"}.get(kind.upper(), kind))


def sounds_like(a: Column, b: Column) -> Column:
    return F.soundex(a) == F.soundex(b)


def period_add(p: Column, n) -> Column:
    """Months added to a period yyyymm."""
    months = F.floor(p / 100) * 12 + p % 100 - 1 + _lit(n)
    return (F.floor(months / 12) * 100 + months % 12 + 1).cast("long")


def period_diff(a: Column, b: Column) -> Column:
    return (F.floor(a / 100) * 12 + a % 100 - F.floor(b / 100) * 12 - b % 100).cast("long")


def sha(x: Column, bits: int = 160) -> Column:
    return F.sha1(x.cast("binary")) if bits == 160 else F.sha2(x.cast("binary"), bits)


def convert_using(x: Column, charset: str) -> Column:
    """``CONVERT(x USING cs)``: a text with what the character set cannot hold as a question mark."""
    names = {"utf8": "UTF-8", "utf8mb4": "UTF-8", "utf8mb3": "UTF-8", "latin1": "ISO-8859-1", "ascii": "US-ASCII", "ucs2": "UTF-16BE", "utf16": "UTF-16"}
    name = names.get(charset.lower(), charset)
    if name == "UTF-8":
        return x.cast("string")
    # Spark's own encoder takes a sign beyond the set for an error.
    beyond = {"US-ASCII": r"[^\x00-\x7F]", "ISO-8859-1": r"[^\x00-\xFF]"}.get(name)
    text = F.regexp_replace(x.cast("string"), beyond, "?") if beyond else x.cast("string")
    return F.decode(F.encode(text, name), name)


def binary(x: Column) -> Column:
    """``BINARY x``: the bytes, by which texts compare with case and accents."""
    return x.cast("string").cast("binary")


def rand(seed: int | None = None) -> Column:
    """RAND: in [0, 1); with a seed the same numbers for the same rows and partitions."""
    return F.rand(seed)


def _by_batch(returns: str):
    """A function of one value over Arrow batches; nulls stay null, and so does what the value does not allow."""

    def make(work):
        import pandas as pd

        def run(values):
            return values.map(lambda v: None if v is None else work(v))

        run.__annotations__ = {"values": pd.Series, "return": pd.Series}
        return F.pandas_udf(run, returns)

    return make


def compress(x: Column) -> Column:
    """COMPRESS: four bytes of the length, the lowest first, and a zlib stream; of an empty value an empty one."""

    @_by_batch("binary")
    def run(v: bytes) -> bytes:
        import zlib

        return len(v).to_bytes(4, "little") + zlib.compress(v) if v else b""

    return run(x.cast("binary"))


def uncompress(x: Column) -> Column:
    """UNCOMPRESS: null for what is no such value."""

    @_by_batch("binary")
    def run(v: bytes) -> bytes | None:
        import zlib

        if not v:
            return b""
        try:
            return zlib.decompress(v[4:])
        except zlib.error:
            return None

    return run(x.cast("binary"))


def uncompressed_length(x: Column) -> Column:
    """UNCOMPRESSED_LENGTH: what the first four bytes say."""
    digits = F.hex(x)
    swapped = F.concat(*[F.substring(digits, i, 2) for i in (7, 5, 3, 1)])
    return F.when(F.octet_length(x) == 0, 0).when(F.octet_length(x) > 4, F.conv(swapped, 16, 10).cast("long"))


def inet_aton(x: Column) -> Column:
    """INET_ATON: a dotted address of four parts as a number; null if it is none."""
    parts = F.split(x, r"\.")
    good = x.rlike(r"^(?:(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.|$)){4}$") & ~x.endswith(".")
    return F.when(good, sum((F.get(parts, F.lit(i)).cast("long") * (1 << 8 * (3 - i)) for i in range(4)), F.lit(0).cast("long")))


def inet_ntoa(n: Column) -> Column:
    """INET_NTOA: null outside of 32 bits."""
    return F.when(n.between(0, (1 << 32) - 1), F.concat_ws(".", *[F.shiftright(n.cast("long"), 8 * (3 - i)).bitwiseAND(F.lit(255).cast("long")).cast("string") for i in range(4)]))


def inet6_aton(x: Column) -> Column:
    """INET6_ATON: the 16 bytes of an address, 4 of a dotted one; null if it is neither."""

    @_by_batch("binary")
    def run(v: str) -> bytes | None:
        import ipaddress

        try:
            return ipaddress.ip_address(v).packed
        except ValueError:
            return None

    return run(x)


def inet6_ntoa(x: Column) -> Column:
    """INET6_NTOA: the shortest text of 16 bytes, or of 4; the last 32 bits of a mapped address are dotted."""

    @_by_batch("string")
    def run(v: bytes) -> str | None:
        import ipaddress

        if len(v) not in (4, 16):
            return None
        found = ipaddress.ip_address(v)
        mapped = getattr(found, "ipv4_mapped", None)
        return f"::ffff:{mapped}" if mapped else str(found)

    return run(x)
