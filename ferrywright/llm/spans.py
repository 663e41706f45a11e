"""Spans of regex matches as DataFrame expressions.

Spark's functions give the texts of all matches and of the gaps between them, not
their places; the places are running sums of both lengths, in code points. Sums go
block by block, so that a text with very many matches costs little more than its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 256
SPAN = "array<struct<start:int,kind:int,end:int>>"


def add_matches(df: DataFrame, text: str, patterns: dict[str, tuple[str, Column]], group: int = 0) -> DataFrame:
    """For each name add ``m_<name>``, the matches, and ``s_<name>``, their starts (0-based code points).

    ``patterns`` has a Java regex and a cheap gate per name; where the gate is not true
    there are no matches. A pattern must not match the empty string.
    """
    none = F.array().cast("array<string>")
    df = df.withColumns({f"m_{n}": F.when(gate, F.regexp_extract_all(text, F.lit(p), F.lit(group))).otherwise(none) for n, (p, gate) in patterns.items()})
    return add_starts(df, text, {n: p for n, (p, _) in patterns.items()}, {n: f"m_{n}" for n in patterns})


def add_starts(df: DataFrame, text: str, patterns: dict[str, str], matches: dict[str, str]) -> DataFrame:
    """Add ``s_<name>``, the starts of the matches in the column ``matches[name]``."""
    df = df.withColumns({f"g_{n}": F.when(F.size(matches[n]) > 0, F.slice(F.split(text, p, -1), 1, F.size(matches[n]))).otherwise(F.array().cast("array<string>")) for n, p in patterns.items()})
    df = df.withColumns({f"l_{n}": F.zip_with(f"g_{n}", matches[n], lambda g, m: F.length(g) + F.length(m)) for n in patterns})

    def block_sums(steps: Column) -> Column:
        n = F.ceil(F.size(steps) / BLOCK).cast("int")
        blocks = F.when(n > 1, F.sequence(F.lit(0), n - 2)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(
            blocks,
            F.array(F.lit(0)),
            lambda acc, b: F.concat(acc, F.array(F.element_at(acc, -1) + F.aggregate(F.slice(steps, b * BLOCK + 1, F.lit(BLOCK)), F.lit(0), lambda a, x: a + x))),
        )

    df = df.withColumns({f"b_{n}": block_sums(F.col(f"l_{n}")) for n in patterns})

    def starts(n: str) -> Column:
        return F.transform(
            f"g_{n}",
            lambda g, i: F.get(f"b_{n}", F.floor(i / BLOCK).cast("int")) + F.aggregate(F.slice(f"l_{n}", F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK), F.lit(0), lambda a, x: a + x) + F.length(g),
        )

    df = df.withColumns({f"s_{n}": starts(n) for n in patterns})
    return df.drop(*[f"{c}_{n}" for n in patterns for c in "glb"])


def kept_spans(name: str, kind: int, keep) -> Column:
    """``array<struct<start, kind, end>>`` of the matches for which ``keep(match)`` is true."""
    pairs = F.zip_with(f"s_{name}", f"m_{name}", lambda s, m: F.struct(s.alias("start"), F.lit(kind).alias("kind"), (s + F.length(m)).alias("end"), m.alias("m")))
    good = F.filter(pairs, lambda p: keep(p["m"]))
    return F.transform(good, lambda p: F.struct(p["start"].alias("start"), p["kind"].alias("kind"), p["end"].alias("end"))).cast(SPAN)


def joined(spans: Column, kinds: list[str]) -> Column:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    names = F.array(*map(F.lit, kinds))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat(F.get(names, s["kind"]), F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


def count_of(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
