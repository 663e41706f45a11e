"""Graphs of foreign keys that may hold cycles: strongly connected components, and a load order over them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrywright.operators.hierarchy import dependency_levels
from ferrywright.scratch import checkpoint


def _trim(links: DataFrame, max_rounds: int) -> DataFrame:
    """The edges that are left when nodes without an edge in or without one out go, again and again: on cycles or between them."""
    for _ in range(max_rounds):
        into, out = links.select(F.col("b").alias("a")).distinct(), links.select(F.col("a").alias("b")).distinct()
        kept = checkpoint(links.join(into, "a", "left_semi").join(out, "b", "left_semi").select("a", "b"))
        if kept.count() == links.count():
            return kept
        links = kept
    return links


def _spread(nodes: DataFrame, links: DataFrame, max_rounds: int) -> DataFrame:
    """``(name, color)``: the greatest name from which each node can be reached, its own included.

    Only nodes whose color changed in a round give it on in the next one.
    """
    current = checkpoint(nodes.withColumns({"color": F.col("name"), "changed": F.lit(True)}))
    for _ in range(max_rounds):
        given = current.where("changed").select(F.col("name").alias("a"), "color").join(links, "a").groupBy(F.col("b").alias("name")).agg(F.max("color").alias("given"))
        more = F.coalesce(F.col("given") > F.col("color"), F.lit(False))
        current = checkpoint(current.join(given, "name", "left").select("name", F.when(more, F.col("given")).otherwise(F.col("color")).alias("color"), more.alias("changed")))
        if current.where("changed").isEmpty():
            return current.drop("changed")
    raise ValueError(f"paths are longer than {max_rounds} edges")


def _reach_back(colors: DataFrame, links: DataFrame, max_rounds: int) -> DataFrame:
    """``(name, component)`` of the nodes that reach, within their color, the node that the color is named by."""
    inside = links.join(colors.toDF("a", "ca"), "a").join(colors.toDF("b", "cb"), "b").where("ca = cb").select("a", "b")
    inside = checkpoint(inside)
    found = checkpoint(colors.where("name = color").select("name", F.col("color").alias("component"), F.lit(True).alias("fresh")))
    for _ in range(max_rounds):
        step = inside.join(found.where("fresh").select(F.col("name").alias("b"), "component"), "b").select(F.col("a").alias("name"), "component").distinct()
        step = step.join(found, "name", "left_anti").withColumn("fresh", F.lit(True))
        following = checkpoint(found.withColumn("fresh", F.lit(False)).unionByName(step))
        if following.where("fresh").isEmpty():
            return following.drop("fresh")
        found = following
    raise ValueError(f"paths are longer than {max_rounds} edges")


def strong_components(edges: DataFrame, node: str = "name", needs: str = "referenced_name", max_rounds: int = 200) -> DataFrame:
    """``(name, component, size)``: nodes that reach each other are one component, named by its least node.

    Nodes that are on no cycle are trimmed first. Of the rest each color (the greatest node that reaches it) holds one whole
    component, that of the nodes which reach back to it; it goes, and what is left has a round of its own. Rounds are joins and aggregates over
    edges; nothing is gathered. Null nodes are left out, repeated edges count once, a node that needs itself alone is a component of one.
    """
    whole = checkpoint(edges.select(F.col(node).alias("a"), F.col(needs).alias("b")))
    names = whole.select(F.col("a").alias("name")).union(whole.select("b")).where("name is not null").distinct()
    links = _trim(checkpoint(whole.where("a is not null and b is not null and a <> b").distinct()), max_rounds)
    found = None
    for _ in range(max_rounds):
        if links.isEmpty():
            break
        nodes = links.select(F.col("a").alias("name")).union(links.select("b")).distinct()
        own = checkpoint(_reach_back(_spread(nodes, links, max_rounds), links, max_rounds))
        found = own if found is None else found.unionByName(own)
        gone = own.select(F.col("name").alias("x"))
        left = links.join(gone, F.col("a") == F.col("x"), "left_anti").join(gone, F.col("b") == F.col("x"), "left_anti")
        links = _trim(checkpoint(left), max_rounds)
    else:
        raise ValueError(f"more than {max_rounds} rounds of components")
    if found is None:
        return names.select("name", F.col("name").alias("component"), F.lit(1).cast("long").alias("size"))
    named = found.groupBy("component").agg(F.min("name").alias("least"), F.count(F.lit(1)).alias("size"))
    told = found.join(named, "component").select("name", "least", "size")
    return names.join(told, "name", "left").select("name", F.coalesce("least", "name").alias("component"), F.coalesce("size", F.lit(1)).cast("long").alias("size"))


def load_order(edges: DataFrame, node: str = "name", needs: str = "referenced_name", max_depth: int = 100) -> DataFrame:
    """``(name, component, size, self_reference, level)``: tables of a level need tables of lower ones only, or of their own component.

    A component of more than one table, or a table that needs itself, is to be loaded without its keys, which are checked afterwards.
    """
    parts = checkpoint(strong_components(edges, node, needs))
    a, b = parts.select(F.col("name").alias("_a"), F.col("component").alias("name")), parts.select(F.col("name").alias("_b"), F.col("component").alias("referenced_name"))
    plain = edges.select(F.col(node).alias("_a"), F.col(needs).alias("_b")).where("_a is not null and _b is not null")
    between = plain.join(a, "_a").join(b, "_b").select("name", "referenced_name").where("name <> referenced_name").distinct()
    levels = dependency_levels(between, max_depth=max_depth).withColumnRenamed("name", "component")
    own = plain.where("_a = _b").select(F.col("_a").alias("name"), F.lit(True).alias("_self")).distinct()
    out = parts.join(levels, "component", "left").join(own, "name", "left")
    return out.select("name", "component", "size", F.coalesce("_self", F.lit(False)).alias("self_reference"), F.coalesce("level", F.lit(0)).cast("long").alias("level"))
