"""Hierarchical queries, dependency levels and foreign-key graphs."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ferrywright.operators.relational import with_rownum
from ferrywright.scratch import checkpoint

#: Rows at which Spark stops a recursion, a million where it is unset.
ROW_LIMIT = "spark.sql.cteRecursionRowLimit"


def connect_by(
    df: DataFrame,
    id: str,
    parent: str,
    start_with: Column | None = None,
    where: Column | None = None,
    edge_filter: Column | None = None,
    path: tuple[str, str] | None = None,
    leading_sep: bool = True,
    nocycle: bool = False,
    siblings: Sequence[Column] = (),
    max_depth: int = 100,
) -> DataFrame:
    """START WITH .. CONNECT BY PRIOR id = parent.

    One equi-join of the last level with the table per level; each level is
    checkpointed, so plans stay short. Columns added: ``level``; ``path`` if asked for,
    with a separator in front unless ``leading_sep`` is false; ``is_cycle`` with
    ``nocycle``, by which a branch ends at a node that it has already. Without
    ``start_with`` every row is a root. ``edge_filter`` prunes branches, ``where``
    filters the result. With ``siblings`` the result is ordered, children by these
    within each parent. A cycle without ``nocycle`` ends as an error at ``max_depth``.
    """
    columns = df.columns
    base = df
    if siblings:
        # Numbers over all rows order the children of each parent too, and a hot parent's rows are in many ranges.
        tests = {"_is_root": start_with, "_is_child": edge_filter}
        base = with_rownum(base.withColumns({c: F.lit(True) if test is None else test for c, test in tests.items()}), [*siblings, F.col(id)], "_sibling")
        start_with, edge_filter = F.col("_is_root"), F.col("_is_child")
    level = base.where(start_with) if start_with is not None else base
    level = level.withColumn("level", F.lit(1))
    if path:
        level = level.withColumn("path", F.concat(F.lit(path[1] if leading_sep else ""), F.coalesce(F.col(path[0]).cast("string"), F.lit(""))))
    if nocycle:
        level = level.withColumns({"_seen": F.array(id), "is_cycle": F.lit(0)})
    if siblings:
        level = level.withColumn("_order", F.array("_sibling"))
    level = checkpoint(level)
    levels, depth = [level], 1
    children = base.where(edge_filter) if edge_filter is not None else base
    while not levels[-1].isEmpty():
        if depth >= max_depth:
            raise ValueError(f"the hierarchy is deeper than {max_depth} levels; a cycle needs nocycle=True")
        depth += 1
        up = levels[-1].select(F.col(id).alias("_up"), *[F.col(c).alias(f"_up_{c}") for c in ("path", "_seen", "_order") if c in levels[-1].columns])
        step = children.join(up, F.col(parent) == F.col("_up")).withColumn("level", F.lit(depth))
        if path:
            step = step.withColumn("path", F.concat(F.col("_up_path"), F.lit(path[1]), F.coalesce(F.col(path[0]).cast("string"), F.lit(""))))
        if nocycle:
            step = step.where(~F.array_contains("_up__seen", F.col(id))).withColumns({"_seen": F.concat("_up__seen", F.array(id)), "is_cycle": F.lit(0)})
        if siblings:
            step = step.withColumn("_order", F.concat("_up__order", F.array("_sibling")))
        levels.append(checkpoint(step.drop(*[c for c in step.columns if c.startswith("_up")])))
    out = levels[0]
    for more in levels[1:-1]:
        out = out.unionByName(more)
    if nocycle:
        # A node is marked if one of its children is in the branch above it.
        loops = children.select(F.col(id).alias("_child"), F.col(parent).alias("_of"))
        marked = out.join(loops, F.col(id) == F.col("_of"), "left").withColumn("is_cycle", F.coalesce(F.array_contains("_seen", F.col("_child")).cast("int"), F.lit(0)))
        kept = [c for c in out.columns if c != "is_cycle"]
        out = marked.groupBy(*kept).agg(F.max("is_cycle").alias("is_cycle"))
    if where is not None:
        out = out.where(where)
    if siblings:
        out = out.orderBy("_order")
    return out.select(*columns, "level", *(["path"] if path else []), *(["is_cycle"] if nocycle else []))


def recursive_cte(spark, sql: str, max_levels: int = 100) -> DataFrame:
    """A recursive common table expression as Spark has it, with a limit of levels that is part of the statement (of its first expression).

    It is computed here, once: levels alone bound it, and Spark's limit of rows, which holds for a session, is off meanwhile.
    """
    limited = re.sub(r"(?is)\b(with\s+recursive\s+\w+\s*(?:\([^)]*\))?)\s*\bas\b", lambda m: f"{m[1]} MAX RECURSION LEVEL {int(max_levels)} AS", sql, count=1)
    before = spark.conf.get(ROW_LIMIT, None)
    try:
        spark.conf.set(ROW_LIMIT, "-1")
        return checkpoint(spark.sql(limited))
    finally:
        if before is None:
            spark.conf.unset(ROW_LIMIT)
        else:
            spark.conf.set(ROW_LIMIT, before)


def dependency_levels(edges: DataFrame, node: str = "name", needs: str = "referenced_name", max_depth: int = 100) -> DataFrame:
    """``(name, level)``: 0 for what needs nothing, else one more than the highest level it needs.

    Levels grow by one join and one aggregate a round until nothing changes; a cycle is an error at ``max_depth``.
    """
    links = checkpoint(edges.select(F.col(node).alias("a"), F.col(needs).alias("b")).where("a is not null and b is not null and a <> b").distinct())
    names = links.select(F.col("a").alias("name")).union(links.select("b")).distinct()
    current, depth = checkpoint(names.withColumn("level", F.lit(0))), 0
    while True:
        above = links.join(current.withColumnRenamed("name", "b"), "b").groupBy(F.col("a").alias("name")).agg((F.max("level") + 1).alias("next"))
        level = F.coalesce("next", F.lit(0))
        following = checkpoint(current.join(above, "name", "left").select("name", level.alias("level"), (level != F.col("level")).alias("_changed")))
        current, depth = following.drop("_changed"), depth + 1
        if following.where("_changed").isEmpty():
            return current
        if depth > max_depth:
            raise ValueError(f"dependencies are deeper than {max_depth} levels or hold a cycle")


def fk_edges(constraints: DataFrame) -> DataFrame:
    """``(name, referenced_name)`` of the foreign keys of a constraints table, for the load order."""
    return constraints.where("type = 'R'").select(F.col("table_name").alias("name"), F.col("r_table").alias("referenced_name")).distinct()
