"""Tables of geometries: parts, measures and spatial joins.

A geometry is a struct ``(gtype, srid, point(x, y, z), elem_info[], ordinates[])``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ferrywright.operators.relational import with_rownum
from ferrywright.scratch import checkpoint

#: Vertices of a polygon that is told apart from others by all of them.
SMALL_SHAPE = 64

# Names of the types in the last two digits of a gtype.
TYPE_NAMES = {1: "POINT", 2: "LINESTRING", 3: "POLYGON", 4: "GEOMETRYCOLLECTION", 5: "MULTIPOINT", 6: "MULTILINESTRING", 7: "MULTIPOLYGON"}


def gtype_parts(df: DataFrame, geom: str = "geom") -> DataFrame:
    """Add ``dim``, ``lrs``, ``type`` of a gtype DLTT; those of fewer than two dimensions are left out."""
    g = F.col(f"{geom}.gtype")
    return df.withColumns({"dim": F.floor(g / 1000).cast("int"), "lrs": F.floor(g / 100 % 10).cast("int"), "type": (g % 100).cast("int")}).where("dim >= 2")


def detect_spatial_type(df: DataFrame, geom: str = "geom", n: int = 50_000) -> DataFrame:
    """``(spatial_type, dim)`` of a column by its first ``n`` rows, the sample that this feature has: one type, or GEOMETRY for several."""
    kinds = gtype_parts(df.select(geom).limit(n), geom).agg(F.collect_set("type").alias("types"), F.max("dim").alias("dim"))
    names = F.create_map(*[x for k, v in TYPE_NAMES.items() for x in (F.lit(k), F.lit(v))])
    return kinds.select(F.when(F.size("types") == 1, F.coalesce(F.try_element_at(names, F.get("types", F.lit(0))), F.lit("GEOMETRY"))).otherwise("GEOMETRY").alias("spatial_type"), "dim")


def fix_srid(df: DataFrame, geom: str = "geom", default: int = 4326, mapping: Mapping[int, int] | None = None, force: int | None = None) -> DataFrame:
    """Fill a null reference system, map others by a given list, or force one."""
    srid = F.coalesce(f"{geom}.srid", F.lit(default))
    if mapping:
        srid = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv]), srid), srid)
    return df.withColumn(geom, F.col(geom).withField("srid", (F.lit(force) if force is not None else srid).cast("int")))


def vertices(df: DataFrame, id: str = "id", geom: str = "geom") -> DataFrame:
    """``(id, type, dim, elem, etype, interpretation, pos, x, y, z)``: one row per vertex; a bare point is one element."""
    parts = gtype_parts(df, geom)
    info, flat = F.col(f"{geom}.elem_info"), F.col(f"{geom}.ordinates")
    n = (F.size(info) / 3).cast("int")
    elements = F.transform(
        F.sequence(F.lit(0), n - 1),
        lambda i: F.struct(
            (i + 1).alias("elem"), F.get(info, i * 3 + 1).alias("etype"), F.get(info, i * 3 + 2).alias("interpretation"),
            F.slice(flat, F.get(info, i * 3), F.coalesce(F.get(info, i * 3 + 3), F.size(flat) + 1) - F.get(info, i * 3)).alias("o"),
        ),
    )
    point = F.col(f"{geom}.point")
    single = F.array(F.struct(F.lit(1).alias("elem"), F.lit(1).alias("etype"), F.lit(1).alias("interpretation"), F.when(F.col("dim") == 2, F.array(point["x"], point["y"])).otherwise(F.array(point["x"], point["y"], point["z"])).alias("o")))
    rows = parts.select(id, "type", "dim", F.explode(F.when(F.size(info) > 0, elements).otherwise(single)).alias("e"))
    places = F.sequence(F.lit(0), (F.size("e.o") / F.col("dim")).cast("int") - 1)
    rows = rows.where(F.size("e.o") >= F.col("dim")).select(id, "type", "dim", "e.elem", "e.etype", "e.interpretation", F.col("e.o").alias("o"), F.explode(places).alias("pos"))
    at = F.col("pos") * F.col("dim")
    return rows.select(id, "type", "dim", "elem", "etype", "interpretation", (F.col("pos") + 1).alias("pos"), F.get("o", at).alias("x"), F.get("o", at + 1).alias("y"), F.when(F.col("dim") > 2, F.get("o", at + 2)).alias("z"))


def measures(points: DataFrame, id: str = "id") -> DataFrame:
    """``(id, n_vertices, length, area, cx, cy)`` from vertices: path length, shoelace area over rings (holes taken off), mean of vertices."""
    along = Window.partitionBy(id, "elem").orderBy("pos")
    step = points.withColumns({"nx": F.lead("x").over(along), "ny": F.lead("y").over(along)})
    length = F.sum(F.sqrt((F.col("nx") - F.col("x")) ** 2 + (F.col("ny") - F.col("y")) ** 2))
    ring = step.groupBy(id, "elem", "etype").agg(F.count(F.lit(1)).alias("n"), F.coalesce(length, F.lit(0.0)).alias("length"), F.coalesce(F.sum(F.col("x") * F.col("ny") - F.col("nx") * F.col("y")), F.lit(0.0)).alias("cross"), F.sum("x").alias("sx"), F.sum("y").alias("sy"))
    area = F.when(F.col("etype") == 2003, -F.abs("cross")).when(F.col("etype") == 1003, F.abs("cross")).otherwise(0.0) / 2
    return ring.groupBy(id).agg(F.sum("n").alias("n_vertices"), F.sum("length").alias("length"), F.sum(area).alias("area"), (F.sum("sx") / F.sum("n")).alias("cx"), (F.sum("sy") / F.sum("n")).alias("cy"))


def st_dwithin_join(a: DataFrame, b: DataFrame, d: float) -> DataFrame:
    """``(a_id, b_id, distance)`` of points ``(id, x, y)`` at most ``d`` apart: an equi-join on grid cells of size d, b in its own cell and its neighbours, then the exact test."""
    cell = lambda c: F.floor(F.col(c) / d)
    left = a.select(F.col("id").alias("a_id"), F.col("x").alias("ax"), F.col("y").alias("ay"), cell("x").alias("gx"), cell("y").alias("gy"))
    steps = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    right = b.select(F.col("id").alias("b_id"), F.col("x").alias("bx"), F.col("y").alias("by"), F.explode(steps).alias("s")).select("b_id", "bx", "by", (cell("bx") + F.col("s.i")).alias("gx"), (cell("by") + F.col("s.j")).alias("gy"))
    distance = F.sqrt((F.col("ax") - F.col("bx")) ** 2 + (F.col("ay") - F.col("by")) ** 2)
    return left.join(right, ["gx", "gy"]).withColumn("distance", distance).where(F.col("distance") <= d).select("a_id", "b_id", "distance")


def bounding_boxes(points: DataFrame, id: str = "id") -> DataFrame:
    return points.groupBy(id).agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"))


def mbr_test(predicate: str, a: str = "a", b: str = "b") -> Column:
    """A bounding-box predicate between the boxes ``a`` and ``b``."""
    c = lambda side, k: F.col(f"{side}.{k}")
    meet = (c(a, "x0") <= c(b, "x1")) & (c(b, "x0") <= c(a, "x1")) & (c(a, "y0") <= c(b, "y1")) & (c(b, "y0") <= c(a, "y1"))
    inner = (c(a, "x0") < c(b, "x1")) & (c(b, "x0") < c(a, "x1")) & (c(a, "y0") < c(b, "y1")) & (c(b, "y0") < c(a, "y1"))
    has = (c(a, "x0") <= c(b, "x0")) & (c(a, "x1") >= c(b, "x1")) & (c(a, "y0") <= c(b, "y0")) & (c(a, "y1") >= c(b, "y1"))
    within = (c(b, "x0") <= c(a, "x0")) & (c(b, "x1") >= c(a, "x1")) & (c(b, "y0") <= c(a, "y0")) & (c(b, "y1") >= c(a, "y1"))
    return {"contains": has, "within": within, "equal": has & within, "intersects": meet, "disjoint": ~meet, "overlaps": inner & ~has & ~within, "touches": meet & ~inner}[predicate]


def _levels(df: DataFrame, size: float) -> DataFrame:
    """Boxes with ``level``: the least power of two times ``size`` that is as large as the box, so that it covers four cells of that size at most."""
    extent = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    return df.withColumn("level", F.greatest(F.lit(0), F.coalesce(F.ceil(F.log2(extent / size)), F.lit(0))).cast("int"))


def _cells(df: DataFrame, size: float, others: list[int], name: str) -> DataFrame:
    """Boxes in the cells of their own level, and of each coarser level that boxes of the other side have."""
    coarser = F.filter(F.array(*[F.lit(v) for v in others]).cast("array<int>"), lambda v: v > F.col("level"))
    out = df.withColumn("at", F.explode(F.concat(F.array("level"), coarser))).withColumn("cell", F.lit(size) * F.pow(F.lit(2.0), F.col("at")))
    spread = lambda lo, hi: F.sequence(F.floor(F.col(lo) / F.col("cell")), F.floor(F.col(hi) / F.col("cell")))
    return out.withColumn("gx", F.explode(spread("x0", "x1"))).withColumn("gy", F.explode(spread("y0", "y1"))).alias(name)


def _box_pairs(a: DataFrame, b: DataFrame, size: float) -> DataFrame:
    """Pairs ``a.*, b.*`` of boxes that share a cell, each pair once: at the level of the larger box, in the first cell that both have.

    A box of any size is in few cells, and a small one in four more for each coarser level that the other side has; levels are
    powers of two, so there are few. Null corners meet nothing.
    """
    whole = lambda df: _levels(df.where("x0 is not null and y0 is not null and x1 is not null and y1 is not null"), size)
    left, right = whole(a), whole(b)
    # Distinct powers of two: bounded by the exponents that a double can have.
    found = [sorted(r.level for r in df.select("level").distinct().collect()) for df in (left, right)]
    both = _cells(left, size, found[1], "a").join(_cells(right, size, found[0], "b"), [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("at", "gx", "gy")])
    first = [F.col(f"a.{g}") == F.greatest(F.floor(F.col(f"a.{lo}") / F.col("a.cell")), F.floor(F.col(f"b.{lo}") / F.col("b.cell"))) for g, lo in (("gx", "x0"), ("gy", "y0"))]
    return both.where((F.col("a.at") == F.greatest("a.level", "b.level")) & first[0] & first[1])


def mbr_join(a: DataFrame, b: DataFrame, predicate: str, size: float) -> DataFrame:
    """``(a_id, b_id)`` of boxes ``(id, x0, y0, x1, y1)`` by a predicate other than disjoint: an equi-join on the cells of a grid of several levels, whose finest cells have ``size``.

    For disjoint boxes see :func:`mbr_disjoint`, which wants a stated query set.
    """
    if predicate == "disjoint":
        raise ValueError("pairs of disjoint boxes are nearly all pairs: ask for those of a stated set with mbr_disjoint")
    return _box_pairs(a, b, size).where(mbr_test(predicate)).select(F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"))


def mbr_counts(a: DataFrame, b: DataFrame, predicate: str, size: float) -> DataFrame:
    """``(b_id, n)``: how many boxes of a meet the predicate with those of each id of b; ids that have none are left out.

    Boxes of the same corners are compared once and counted as often as they are there, and no pair of rows is made:
    the work goes with the distinct boxes of both sides and the pairs that these make.
    """
    corners = ["x0", "y0", "x1", "y1"]
    if predicate == "disjoint":
        raise ValueError("for disjoint boxes take those that intersect from the number of all")
    left = a.where(" and ".join(f"{c} is not null" for c in corners)).groupBy(*corners).agg(F.count(F.lit(1)).alias("copies"))
    right = b.select(*corners).distinct()
    found = _box_pairs(left, right, size).where(mbr_test(predicate)).groupBy(*[F.col(f"b.{c}").alias(c) for c in corners]).agg(F.sum("a.copies").alias("n"))
    return b.select(F.col("id").alias("b_id"), *corners).join(found, corners).groupBy("b_id").agg(F.sum("n").alias("n"))


def mbr_disjoint(queries: DataFrame, b: DataFrame, block: int = 10_000) -> DataFrame:
    """``(a_id, b_id)`` of the boxes that do not meet those of a stated query set: blocks of at most ``block`` queries, each broadcast to all rows."""
    names = ["id", "x0", "y0", "x1", "y1"]
    numbered = with_rownum(queries.select(*names).where("x0 is not null"), [F.col("id")], "_nth")
    out = None
    for at in range(0, numbered.count(), block):
        some = F.broadcast(numbered.where(F.col("_nth").between(at + 1, at + block)).drop("_nth")).alias("a")
        found = b.select(*names).alias("b").join(some, mbr_test("disjoint")).select(F.col("a.id").alias("a_id"), F.col("b.id").alias("b_id"))
        out = found if out is None else out.unionByName(found)
    return out if out is not None else queries.select(F.col("id").alias("a_id"), F.col("id").alias("b_id")).limit(0)


def _same_shapes(rings: DataFrame) -> DataFrame:
    """``(id, shape)``: the least id of the polygons that have the same vertices. Polygons of more than SMALL_SHAPE vertices stand for themselves, so that no large one is gathered."""
    nth = F.row_number().over(Window.partitionBy("id").orderBy("elem", "pos"))
    held = F.when(F.col("_nth") <= SMALL_SHAPE, F.struct("elem", "pos", "x", "y"))
    forms = rings.where("id is not null").withColumn("_nth", nth).groupBy("id").agg(F.max("_nth").alias("n"), F.sort_array(F.collect_list(held)).alias("form"))
    forms = forms.select("id", F.when(F.col("n") <= SMALL_SHAPE, F.col("form")).alias("form"))
    first = forms.where("form is not null").groupBy("form").agg(F.min("id").alias("shape"))
    small = forms.join(first, "form").select("id", "shape")
    return checkpoint(small.unionAll(forms.where("form is null").select("id", F.col("id").alias("shape"))))


def points_in_polygons(points: DataFrame, rings: DataFrame, size: float) -> DataFrame:
    """``(point_id, polygon_id)``: points ``(id, x, y)`` inside polygons given as vertices.

    Points and bounding boxes meet in a grid of several levels. An edge is kept under its polygon in the two rows at most that it
    covers at the level of its height, and a point looks one row up for each such level: it meets only
    edges at its own height, however large the polygon is. Crossings of a ray to the right are counted.

    Points of one place and polygons of the same vertices are held against each other once; ids are joined back at the end, so that
    what is shuffled before goes with the distinct places and shapes that meet, and the result alone with its rows.
    """
    shapes = _same_shapes(rings)
    rings = rings.join(shapes.where("id = shape"), "id", "left_semi")
    along = Window.partitionBy("id", "elem").orderBy("pos")
    edges = rings.withColumns({"nx": F.lead("x").over(along), "ny": F.lead("y").over(along)}).where("nx is not null and y <> ny").select("id", "x", "y", "nx", "ny")
    edges = edges.withColumn("level", F.greatest(F.lit(0), F.coalesce(F.ceil(F.log2(F.abs(F.col("ny") - F.col("y")) / size)), F.lit(0))).cast("int"))
    row = lambda y: F.floor(y / (F.lit(size) * F.pow(F.lit(2.0), F.col("level"))))
    dealt = edges.withColumn("row", F.explode(F.sequence(row(F.least("y", "ny")), row(F.greatest("y", "ny")))))
    levels = edges.groupBy("id").agg(F.collect_set("level").alias("levels"))
    boxes = bounding_boxes(rings)
    dots = points.select("x", "y").distinct().select(F.col("x").alias("x0"), F.col("y").alias("y0"), F.col("x").alias("x1"), F.col("y").alias("y1"))
    near = _box_pairs(dots, boxes, size).where(mbr_test("within")).select(F.col("a.x0").alias("px"), F.col("a.y0").alias("py"), F.col("b.id").alias("id"))
    asked = near.join(levels, "id").withColumn("level", F.explode("levels")).withColumn("row", row(F.col("py"))).drop("levels")
    crosses = ((F.col("y") > F.col("py")) != (F.col("ny") > F.col("py"))) & (F.col("px") < (F.col("nx") - F.col("x")) * (F.col("py") - F.col("y")) / (F.col("ny") - F.col("y")) + F.col("x"))
    hits = asked.join(dealt, ["id", "level", "row"]).where(crosses).groupBy("px", "py", F.col("id").alias("shape")).agg(F.count(F.lit(1)).alias("n"))
    inside = hits.where("n % 2 = 1").join(shapes, "shape").select("px", "py", F.col("id").alias("polygon_id"))
    # A place's polygons are held, its points pass by.
    return points.join(inside, (F.col("x") == F.col("px")) & (F.col("y") == F.col("py"))).select(F.col("id").alias("point_id"), "polygon_id")


def assemble_shapes(points: DataFrame, id: str = "id") -> DataFrame:
    """``(id, wkt)`` from vertices of straight shapes: rings, then parts, then one text.

    A polygon of two corners (interpretation 3) becomes its rectangle.
    """
    number = lambda c: F.regexp_replace(F.format_string("%s", F.col(c)), r"\.0$", "")
    z = F.when(F.col("z").isNotNull(), F.concat(F.lit(" "), number("z"))).otherwise("")
    rows = points.withColumn("xy", F.concat(number("x"), F.lit(" "), number("y"), z))
    ring = rows.groupBy(id, "type", "dim", "elem", "etype", "interpretation").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "xy", "x", "y"))), lambda v: v["xy"]).alias("v"), F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"))
    corner = lambda a, b: F.concat(number(a), F.lit(" "), number(b))
    box = F.array(corner("x0", "y0"), corner("x1", "y0"), corner("x1", "y1"), corner("x0", "y1"), corner("x0", "y0"))
    ring = ring.withColumn("text", F.concat(F.lit("("), F.array_join(F.when((F.col("etype") % 1000 == 3) & (F.col("interpretation") == 3), box).otherwise(F.col("v")), ","), F.lit(")")))
    # An outer ring begins a new polygon; its holes follow it.
    part = F.sum(F.when(F.col("etype") != 2003, 1).otherwise(0)).over(Window.partitionBy(id).orderBy("elem"))
    ring = ring.withColumn("part", part)
    parts = ring.groupBy(id, "type", "dim", "part").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("elem", "text"))), lambda r: r["text"]), ",").alias("rings"))
    whole = parts.groupBy(id, "type", "dim").agg(F.transform(F.sort_array(F.collect_list(F.struct("part", "rings"))), lambda p: p["rings"]).alias("parts"))
    suffix = F.when(F.col("dim") == 3, "Z").when(F.col("dim") == 4, "ZM").otherwise("")
    names = F.create_map(*[x for k, v in TYPE_NAMES.items() for x in (F.lit(k), F.lit(v))])
    flat, nested = F.array_join("parts", ","), F.array_join(F.transform("parts", lambda p: F.concat(F.lit("("), p, F.lit(")"))), ",")
    # Multi-points are one element of several vertices, or several elements of one.
    loose = F.concat(F.lit("("), F.regexp_replace(flat, r"[()]", ""), F.lit(")"))
    body = F.when(F.col("type").isin(1, 2), flat).when(F.col("type") == 5, loose).when(F.col("type") == 3, nested).when(F.col("type") == 6, F.concat(F.lit("("), flat, F.lit(")"))).otherwise(F.concat(F.lit("("), nested, F.lit(")")))
    return whole.select(id, F.concat(F.try_element_at(names, F.col("type")), suffix, body).alias("wkt"))
