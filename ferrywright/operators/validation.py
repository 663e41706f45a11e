"""Comparing a source with a target, and declared rules as data-quality jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrywright.operators.relational import count_rows
from ferrywright.scratch import checkpoint


def test_count(source: Mapping[str, DataFrame], target: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, source_rows, target_rows, status)`` of all tables on either side."""
    s = count_rows(source).withColumnRenamed("n_rows", "source_rows")
    t = count_rows(target).withColumnRenamed("n_rows", "target_rows")
    both = s.join(t, "table_name", "full_outer")
    status = F.when(F.col("source_rows").isNull(), "missing in source").when(F.col("target_rows").isNull(), "missing in target").when(F.col("source_rows") == F.col("target_rows"), "ok").otherwise("diff")
    return both.withColumn("status", status)


def test_view(source: Mapping[str, DataFrame], target: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts of views on both sides, as of tables: the views are run."""
    return test_count(source, target)


def test_structure(source: DataFrame, target: DataFrame, by: Sequence[str] = ("kind", "table_name")) -> DataFrame:
    """Counts of catalog objects by kind and table on both sides."""
    s = source.groupBy(*by).agg(F.count(F.lit(1)).alias("n_source"))
    t = target.groupBy(*by).agg(F.count(F.lit(1)).alias("n_target"))
    both = s.join(t, list(by), "full_outer").fillna(0, ["n_source", "n_target"])
    return both.withColumn("status", F.when(F.col("n_source") == F.col("n_target"), "ok").otherwise("diff"))


def test_data(source: DataFrame, target: DataFrame, keys: Sequence[str], n_rows: int = 10000, max_errors: int = 10) -> DataFrame:
    """Rows of a table that differ: keys, status, names of differing columns.

    The first ``n_rows`` by key of the source are held against the target's rows of these
    keys (0: all rows of both); at most ``max_errors`` (0: all) are reported, in key order.
    """
    columns = [c for c in source.columns if c not in keys]
    s, t = source, target.select(*source.columns)
    if n_rows:
        s = s.orderBy(*keys).limit(n_rows)
        t = t.orderBy(*keys).limit(n_rows)
    s = s.select(*keys, F.struct(F.lit(1).alias("_in"), *columns).alias("_s"))
    t = t.select(*keys, F.struct(F.lit(1).alias("_in"), *columns).alias("_t"))
    both = s.join(t, list(keys), "full_outer")
    names = F.array_compact(F.array(*[F.when(~F.col(f"_s.{c}").eqNullSafe(F.col(f"_t.{c}")), F.lit(c)) for c in columns])) if columns else F.array().cast("array<string>")
    status = F.when(F.col("_s").isNull(), "only in target").when(F.col("_t").isNull(), "only in source").when(F.size(names) > 0, "differs")
    out = both.withColumn("status", status).where("status is not null").select(*keys, "status", F.when(F.col("status") == "differs", F.array_join(names, ",")).otherwise("").alias("columns"))
    return out.orderBy(*keys).limit(max_errors) if max_errors else out


def test_data_unordered(source: DataFrame, target: DataFrame) -> DataFrame:
    """Whole rows that one side has more often, with the counts of both: one shuffle of row hashes and rows."""
    columns = source.columns
    tagged = source.select(*columns, F.lit(1).alias("_s"), F.lit(0).alias("_t")).unionByName(target.select(*columns, F.lit(0).alias("_s"), F.lit(1).alias("_t")))
    return tagged.groupBy(*columns).agg(F.sum("_s").alias("n_source"), F.sum("_t").alias("n_target")).where("n_source <> n_target")


def _digit(keys: Sequence[str], level: int, bits: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*keys), level * bits).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def _differing(source: DataFrame, target: DataFrame, buckets: Mapping[str, Column]) -> DataFrame:
    """The buckets whose multisets of rows differ, by counts and sums of row hashes: one aggregate over both sides, combined before it is shuffled."""
    columns = source.columns
    # A hash passes over nulls, so where they stand is hashed too.
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    h = F.xxhash64(*columns, nulls)
    parts = [df.select(*[b.alias(n) for n, b in buckets.items()], F.lit(sign).cast("long").alias("_n"), (h.bitwiseAND(F.lit((1 << 32) - 1)) * sign).alias("_low"), (F.shiftrightunsigned(h, 32) * sign).alias("_high")) for df, sign in ((source, 1), (target, -1))]
    sums = parts[0].unionByName(parts[1]).groupBy(*buckets).agg(F.sum("_n").alias("_n"), F.sum("_low").alias("_low"), F.sum("_high").alias("_high"))
    return sums.where("_n <> 0 or _low <> 0 or _high <> 0").select(*buckets)


def narrow_to_differences(source: DataFrame, target: DataFrame, keys: Sequence[str] = (), levels: int = 2, bits: int = 12, broadcast_rows: int = 1 << 20) -> tuple[DataFrame, DataFrame]:
    """Both sides without the buckets in which they are equal: a tree of digests, descended only where it differs.

    Rows are dealt into ``2 ** bits`` buckets by a hash of their keys (all columns without keys), and the buckets'
    digests are compared; rows of those that differ are dealt again, by further bits of the hash. Equal tables cost one aggregate. What
    is left is shuffled or compared by the caller. A list of differing buckets is broadcast if it has at most ``broadcast_rows``
    rows, else joined; where half of the first buckets differ the tables are given back whole.
    """
    target = target.select(*source.columns)
    by = list(keys or source.columns)
    sides = [source, target]
    for level in range(levels):
        buckets = {f"_b{i}": _digit(by, i, bits) for i in range(level + 1)}
        found = checkpoint(_differing(*sides, buckets))
        n = found.count()
        if not level and 2 * n > 1 << bits:
            return source, target
        named = found.select(*[F.col(c).alias(f"{c}_") for c in buckets])
        if n <= broadcast_rows:
            named = F.broadcast(named)
        match = [digit == F.col(f"{c}_") for c, digit in buckets.items()]
        sides = [df.join(named, match, "left_semi") for df in (source, target)]
    return sides[0], sides[1]


def test_data_tree(source: DataFrame, target: DataFrame, keys: Sequence[str], max_errors: int = 0) -> DataFrame:
    """:func:`test_data` of all rows, of which only those in differing buckets of keys are joined."""
    return test_data(*narrow_to_differences(source, target, keys), keys, 0, max_errors)


def test_data_unordered_tree(source: DataFrame, target: DataFrame) -> DataFrame:
    """:func:`test_data_unordered`, of which only rows in differing buckets are shuffled."""
    return test_data_unordered(*narrow_to_differences(source, target))


def test_sequences(source: DataFrame, target: DataFrame) -> DataFrame:
    """Sequences by lower-case name whose last numbers differ."""
    s = source.select(F.lower("name").alias("name"), F.col("last_number").alias("source_value"))
    t = target.select(F.lower("name").alias("name"), F.col("last_number").alias("target_value"))
    return s.join(t, "name", "full_outer").where(~F.col("source_value").eqNullSafe(F.col("target_value")))


def check_unique(df: DataFrame, columns: Sequence[str], primary: bool = False) -> DataFrame:
    """Keys that occur more than once; rows with a null in a unique key never clash, in a primary key each is a fault."""
    has_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
    return groups.where((F.col("n_rows") > 1) & ~has_null | has_null) if primary else groups.where((F.col("n_rows") > 1) & ~has_null)


def check_fk(child: DataFrame, parent: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Child rows without a parent; rows with a null in the key pass."""
    present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    keys = parent.select(*[F.col(p).alias(f"_p{i}") for i, p in enumerate(columns.values())])
    return child.where(present).join(keys, [F.col(c) == F.col(f"_p{i}") for i, c in enumerate(columns)], "left_anti")


def check_condition(df: DataFrame, condition: str) -> DataFrame:
    """Rows for which the condition is false; unknown passes."""
    return df.where(~F.coalesce(F.expr(condition), F.lit(True)))


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, n_null)``, all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], list(columns), "column_name", "n_null")


def fill_default(df: DataFrame, defaults: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.expr(e)) for c, e in defaults.items()})


def check_types(df: DataFrame, declared: Mapping[str, tuple[str, int | None]]) -> DataFrame:
    """``(column_name, n_bad)``: values that do not cast to the declared type, or texts longer than declared."""
    bad: dict[str, Column] = {}
    for c, (kind, length) in declared.items():
        fault = F.col(c).try_cast(kind).isNull() & F.col(c).isNotNull()
        bad[c] = fault | (F.length(c) > length) if length else fault
    counts = df.agg(*[F.count_if(F.coalesce(b, F.lit(False))).alias(c) for c, b in bad.items()])
    return counts.unpivot([], list(bad), "column_name", "n_bad")


def run_rules(tables: Mapping[str, DataFrame], rules: Sequence[Mapping], skip: Sequence[str] = ()) -> DataFrame:
    """``(rule, kind, table_name, n_faults)`` of pkeys, ukeys, fkeys and checks, but for the classes in ``skip``.

    A rule has name, kind, table, columns (fkeys: a mapping to the parent's), parent, condition. One job for all.
    """
    parts = []
    for r in rules:
        if r["kind"] in skip:
            continue
        df = tables[r["table"]]
        if r["kind"] in ("pkeys", "ukeys"):
            faults = check_unique(df, r["columns"], r["kind"] == "pkeys")
        elif r["kind"] == "fkeys":
            faults = check_fk(df, tables[r["parent"]], r["columns"])
        else:
            faults = check_condition(df, r["condition"])
        parts.append(faults.agg(F.count(F.lit(1)).alias("n_faults")).select(F.lit(r["name"]).alias("rule"), F.lit(r["kind"]).alias("kind"), F.lit(r["table"]).alias("table_name"), "n_faults"))
    return reduce(DataFrame.unionByName, parts)
