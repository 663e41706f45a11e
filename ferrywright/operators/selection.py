"""Which objects and rows take part."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def where_clauses(tables: Mapping[str, DataFrame], per_table: Mapping[str, str] | None = None, everywhere: str | None = None) -> dict[str, DataFrame]:
    """Filters by table, and one for all tables that have its columns; sources get them pushed down.

    The common filter is an error if no table has its columns, or if one of them is in no table at all: a misspelt
    name would else filter nothing, in silence.
    """
    known = {c.lower() for df in tables.values() for c in df.columns}
    out, met = {}, False
    for name, df in tables.items():
        if clause := (per_table or {}).get(name):
            df = df.where(clause)
        if everywhere:
            try:
                df = df.where(everywhere)
                met = True
            except AnalysisException as error:
                # The table lacks a column; any other fault of the clause is the caller's.
                if not (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
                    raise
                missing = error.getMessageParameters().get("objectName", "").replace("`", "").split(".")[-1]
                if missing.lower() not in known:
                    raise
        out[name] = df
    if everywhere and tables and not met:
        raise ValueError(f"no table has all columns of {everywhere!r}")
    return out


def matches(column: Column, patterns: Sequence[str]) -> Column:
    """Whether a name matches one of the patterns in whole and without case; ``!pattern`` takes it out again."""
    plus = [p for p in patterns if not p.startswith("!")]
    hit = F.lit(not plus)
    for p in plus:
        hit = hit | column.rlike(f"(?i)^(?:{p})$")
    for p in patterns:
        if p.startswith("!"):
            hit = hit & ~column.rlike(f"(?i)^(?:{p[1:]})$")
    return hit


def select_objects(catalog: DataFrame, allow: Sequence[str] = (), exclude: Sequence[str] = (), column: str = "object_name") -> DataFrame:
    kept = catalog.where(matches(F.col(column), allow)) if allow else catalog
    return kept.where(~matches(F.col(column), exclude)) if exclude else kept


def parse_object_filter(text: str) -> dict[str, list[str]]:
    """``TABLE[A B.*]; INDEX[!X]`` or a plain list (for every type, key ``""``) as patterns by type."""
    typed = re.findall(r"(\w[\w ]*?)\s*\[([^\]]*)\]", text)
    if not typed:
        return {"": [p for p in re.split(r"[\s,]+", text.strip()) if p]}
    return {kind.strip().upper(): [p for p in re.split(r"[\s,]+", inner.strip()) if p] for kind, inner in typed}


def filter_typed(catalog: DataFrame, text: str, exclude: bool = False, kind: str = "object_type", name: str = "object_name") -> DataFrame:
    """Apply a typed filter; types it does not name stay as they are."""
    hit = F.lit(True)
    for object_type, patterns in parse_object_filter(text).items():
        own = matches(F.col(name), patterns)
        own = ~own if exclude else own
        hit = hit & (own if not object_type else F.when(F.upper(kind) == object_type, own).otherwise(True))
    return catalog.where(hit)


# Schemas that belong to the source system.
SYSTEM_SCHEMAS = (
    "SYS", "SYSTEM", "OUTLN", "DBSNMP", "XDB", "CTXSYS", "MDSYS", "MDDATA", "ORDSYS", "ORDDATA", "ORDPLUGINS", "OLAPSYS", "WMSYS", "EXFSYS", "DVSYS", "LBACSYS", "APPQOSSYS", "GSMADMIN_INTERNAL", "AUDSYS", "SYSMAN", "DIP", "ANONYMOUS",
    "INFORMATION_SCHEMA", "MYSQL", "PERFORMANCE_SCHEMA",
)


def exclude_schemas(catalog: DataFrame, extra: Sequence[str] = (), column: str = "owner") -> DataFrame:
    return catalog.where(~F.upper(column).isin(*SYSTEM_SCHEMAS, *map(str.upper, extra)))


def by_status(catalog: DataFrame, mode: str = "valid", column: str = "status") -> DataFrame:
    """``valid``, ``invalid`` or ``all`` objects."""
    return catalog if mode == "all" else catalog.where(F.upper(column) == mode.upper())


def regexp_flags(flags: str | None) -> str:
    """Flags i, c, n, m, x as an inline group for Java; the last of i and c counts; the dot matches no line break without n."""
    out = ""
    case = [f for f in (flags or "") if f in "ic"]
    if case and case[-1] == "i":
        out += "i"
    out += "s" * ("n" in (flags or "")) + "m" * ("m" in (flags or "")) + "x" * ("x" in (flags or ""))
    return f"(?{out})" if out else ""


def regexp_like(column: Column, pattern: str, flags: str | None = None) -> Column:
    return column.rlike(regexp_flags(flags) + pattern)


def mysql_regexp(column: Column, pattern: str, binary: bool = False, negate: bool = False) -> Column:
    hit = column.rlike(pattern if binary else "(?i)" + pattern)
    return ~hit if negate else hit


def order_tables(catalog: DataFrame, by: str | Sequence[str] = "name") -> DataFrame:
    """The catalog in processing order: by name, by size (largest first), or in a given list's order, others after it."""
    if by == "name":
        return catalog.orderBy("table_name")
    if by == "size":
        return catalog.orderBy(F.desc("bytes"), "table_name")
    place = F.lit(len(by))
    for i, name in reversed(list(enumerate(by))):
        place = F.when(F.lower("table_name") == name.lower(), i).otherwise(place)
    return catalog.orderBy(place, "table_name")
