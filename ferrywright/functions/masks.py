"""Date masks of three dialects as Spark datetime patterns."""

from __future__ import annotations

import re

# Mask elements and Spark pattern letters; longer elements stand first.
ORACLE_ELEMENTS = [
    ("YYYY", "yyyy"), ("RRRR", "yyyy"), ("YYY", "yyy"), ("YY", "yy"), ("RR", "yy"), ("MONTH", "MMMM"), ("MON", "MMM"), ("MM", "MM"), ("DDD", "DDD"), ("DD", "dd"), ("DAY", "EEEE"), ("DY", "EEE"),
    ("HH24", "HH"), ("HH12", "hh"), ("HH", "hh"), ("MI", "mm"), ("SS", "ss"), ("FF1", "S"), ("FF2", "SS"), ("FF3", "SSS"), ("FF6", "SSSSSS"), ("FF9", "SSSSSS"), ("FF", "SSSSSS"), ("A.M.", "a"), ("P.M.", "a"), ("AM", "a"), ("PM", "a"),
    ("Q", "Q"), ("TZH:TZM", "xxx"), ("TZR", "VV"),
]
MYSQL_ELEMENTS = {
    "a": "EEE", "b": "MMM", "c": "M", "d": "dd", "e": "d", "f": "SSSSSS", "H": "HH", "h": "hh", "I": "hh", "i": "mm", "j": "DDD", "k": "H", "l": "h", "M": "MMMM", "m": "MM", "p": "a", "r": "hh:mm:ss a", "S": "ss", "s": "ss",
    "T": "HH:mm:ss", "W": "EEEE", "Y": "yyyy", "y": "yy",
}
#: CONVERT styles of T-SQL.
TSQL_STYLES = {
    100: "MMM dd yyyy hh:mma", 101: "MM/dd/yyyy", 102: "yyyy.MM.dd", 103: "dd/MM/yyyy", 104: "dd.MM.yyyy", 105: "dd-MM-yyyy", 106: "dd MMM yyyy", 107: "MMM dd, yyyy", 108: "HH:mm:ss", 109: "MMM dd yyyy hh:mm:ss:SSSa",
    110: "MM-dd-yyyy", 111: "yyyy/MM/dd", 112: "yyyyMMdd", 113: "dd MMM yyyy HH:mm:ss:SSS", 114: "HH:mm:ss:SSS", 120: "yyyy-MM-dd HH:mm:ss", 121: "yyyy-MM-dd HH:mm:ss.SSS", 126: "yyyy-MM-dd'T'HH:mm:ss.SSS",
    127: "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", 130: "dd MMM yyyy hh:mm:ss:SSSa", 131: "dd/MM/yy hh:mm:ss:SSSa",
}

#: Styles below 100 that mean the same as the one 100 above; the others have a year of two digits.
SAME_AS_LONG = (0, 9, 13, 14, 20, 21)


def tsql_style(style: int) -> str:
    """The pattern of a CONVERT style."""
    if style >= 100:
        return TSQL_STYLES[style]
    long = TSQL_STYLES[style + 100]
    return long if style in SAME_AS_LONG else long.replace("yyyy", "yy")


def quoted(text: str) -> str:
    """Letters of a literal, for a Spark pattern."""
    return "'" + text.replace("'", "''") + "'" if re.search("[A-Za-z']", text) else text


def oracle(mask: str, time_zones: bool = True) -> str:
    """An Oracle mask as a Spark pattern; text in double quotes is literal. Without ``time_zones`` their elements are left out."""
    out, at, upper = [], 0, mask.upper()
    while at < len(mask):
        if mask[at] == '"':
            end = mask.find('"', at + 1)
            end = len(mask) if end < 0 else end
            out.append(quoted(mask[at + 1 : end]))
            at = end + 1
            continue
        for element, pattern in ORACLE_ELEMENTS:
            if upper.startswith(element, at):
                if time_zones or not element.startswith("TZ"):
                    out.append(pattern)
                at += len(element)
                break
        else:
            if upper.startswith("FM", at):
                at += 2
                continue
            out.append(quoted(mask[at]))
            at += 1
    return "".join(out).strip() if not time_zones else "".join(out)


def mysql(mask: str) -> str:
    """A MySQL mask as a Spark pattern, for the elements that have a letter there."""
    out = []
    for part in re.findall("%.|[^%]+|%$", mask, re.S):
        if part[0] != "%" or len(part) == 1:
            out.append(quoted(part))
        elif part[1] == "%":
            out.append("%")
        elif part[1] in MYSQL_ELEMENTS:
            out.append(MYSQL_ELEMENTS[part[1]])
        else:
            raise ValueError(f"{part} has no pattern letter; see date_format in the functions of this dialect")
    return "".join(out)
