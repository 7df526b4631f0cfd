"""Planar geometry as joins: point in polygon, nearest polygon, zonal means.

Polygons are edge tables ``(map_id, poly_id, ring, seq, x1, y1, x2, y2)``;
holes and multi-part polygons are just more rings, handled by the even-odd
rule.  Everything is built from equi joins on grid cells of several levels
(a cell of one level has STEP x STEP children on the level below):

* ``edge_cells``    - the leaf cells that each edge runs through
* ``edge_rows``     - each edge once per grid row (y band) it spans
* ``polygon_cover`` - a polygon as cells wholly inside, as large as they get,
  and the leaf cells of its border
* point in polygon: the point's cells of all levels meet the cover; a cell
  inside needs no edge, in a border cell the edges of the point's row band
  decide by the parity of ray crossings.
* nearest polygon: branch and bound down the levels.  Every listed cell holds
  a piece of an edge, so its far corner bounds the best distance from above
  and its near side from below; cells that cannot win are dropped on each
  level, and only edges in the leaf cells left are measured.

No UDFs: crossings and distances are Column arithmetic inside codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polidata.session import stored


def polygon_edges(vertices: DataFrame, keys: list[str]) -> DataFrame:
    """Vertex rows (keys..., ring, seq, x, y) -> closed-ring edge rows."""
    w = Window.partitionBy(*keys, "ring").orderBy("seq")
    v = vertices.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys, "ring")))
    v = v.withColumn("x2", F.lead("x").over(w)).withColumn("y2", F.lead("y").over(w))
    first = F.first("x").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    firsty = F.first("y").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    v = v.withColumn("x2", F.coalesce("x2", first)).withColumn("y2", F.coalesce("y2", firsty))
    return v.select(*keys, "ring", "seq", F.col("x").alias("x1"), F.col("y").alias("y1"), "x2", "y2")


def bboxes(edges: DataFrame, keys: list[str]) -> DataFrame:
    return edges.groupBy(*keys).agg(
        F.least(F.min("x1"), F.min("x2")).alias("xmin"), F.greatest(F.max("x1"), F.max("x2")).alias("xmax"),
        F.least(F.min("y1"), F.min("y2")).alias("ymin"), F.greatest(F.max("y1"), F.max("y2")).alias("ymax"))


#: A cell has 2**SHIFT x 2**SHIFT children; LEVELS levels, the leaves included.
SHIFT = 2
STEP = 2 ** SHIFT
LEVELS = 4
#: Edges are held by cells up to this part of a cell away, so that rounding cannot lose one.
PAD = 1e-9


def _cell(c: Column, g: float) -> Column:
    return F.floor(c / g).cast("long")


def _up(c: str, level: int) -> Column:
    """The cell of a higher level that holds a leaf cell (an arithmetic shift rounds down)."""
    return F.shiftright(F.col(c), SHIFT * level)


def edge_rows(edges: DataFrame, g: float) -> DataFrame:
    """Each edge once per grid row (y band) it spans."""
    lo, hi = F.least("y1", "y2"), F.greatest("y1", "y2")
    return edges.withColumn("cy", F.explode(F.sequence(_cell(lo, g), _cell(hi, g))))


def crosses(px: Column, py: Column) -> Column:
    """Even-odd rule: does the ray from (px, py) towards +x cross the edge?"""
    x1, y1, x2, y2 = F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")
    straddles = (y1 > py) != (y2 > py)
    xint = (x2 - x1) * (py - y1) / (y2 - y1) + x1
    return straddles & (px < xint)


def edge_cells(edges: DataFrame, g: float) -> DataFrame:
    """Each edge once per leaf cell it runs through (or passes within PAD of)."""
    x1, y1, x2, y2 = F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")
    lo, hi, pad = F.least(y1, y2), F.greatest(y1, y2), PAD * g
    rows = edges.withColumn("cy", F.explode(F.sequence(_cell(lo - pad, g), _cell(hi + pad, g))))

    def x_at(y: Column) -> Column:
        return x1 + (x2 - x1) * F.least(F.lit(1.0), F.greatest(F.lit(0.0), (y - y1) / (y2 - y1)))

    # the part of the edge inside the row
    enter = F.when(y1 == y2, x1).otherwise(x_at(F.greatest(lo, F.col("cy") * g - pad)))
    leave = F.when(y1 == y2, x2).otherwise(x_at(F.least(hi, (F.col("cy") + 1) * g + pad)))
    return rows.withColumn("cx", F.explode(F.sequence(_cell(F.least(enter, leave) - pad, g),
                                                      _cell(F.greatest(enter, leave) + pad, g))))


def polygon_cover(edges: DataFrame, keys: list[str], g: float, levels: int = LEVELS) -> DataFrame:
    """Polygons as cells: (keys, lvl, cx, cy, inside).

    ``inside`` cells of any level lie wholly in the polygon and have no edge; those that are not are leaf cells
    (level 0, side ``g``) on the border.  A child of a border cell without an edge of its own is either wholly inside
    or wholly outside, which the parity of its centre tells.
    """
    border = edge_cells(edges, g).select(*keys, F.explode(F.array(*[
        F.struct(F.lit(k).alias("lvl"), _up("cx", k).alias("cx"), _up("cy", k).alias("cy")) for k in range(levels)])).alias("c")) \
        .select(*keys, "c.*").distinct()
    leaf = border.filter(F.col("lvl") == 0).select(*keys, "cx", "cy")
    top = border.filter(F.col("lvl") == levels - 1).groupBy(*keys, "lvl").agg(
        F.min("cx").alias("x0"), F.max("cx").alias("x1"), F.min("cy").alias("y0"), F.max("cy").alias("y1"))
    top = top.withColumn("cx", F.explode(F.sequence("x0", "x1"))).withColumn("cy", F.explode(F.sequence("y0", "y1")))
    below = border.filter(F.col("lvl") > 0).withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(STEP * STEP - 1))))
    below = below.select(*keys, (F.col("lvl") - 1).alias("lvl"), (F.col("cx") * STEP + F.col("i") % STEP).alias("cx"),
                         (F.col("cy") * STEP + F.floor(F.col("i") / STEP)).alias("cy"))
    quiet = top.select(*below.columns).unionByName(below).join(border, [*keys, "lvl", "cx", "cy"], "left_anti")
    side = F.pow(F.lit(float(STEP)), F.col("lvl")) * g
    centre = quiet.select(*keys, "lvl", "cx", F.col("cy").alias("cy_"), ((F.col("cx") + 0.5) * side).alias("px"),
                          ((F.col("cy") + 0.5) * side).alias("py")).withColumn("cy", _cell(F.col("py"), g))
    odd = centre.join(edge_rows(edges, g).select(*keys, "cy", "x1", "y1", "x2", "y2"), [*keys, "cy"]) \
        .groupBy(*keys, "lvl", "cx", "cy_").agg(F.sum(crosses(F.col("px"), F.col("py")).cast("int")).alias("_k")) \
        .filter(F.col("_k") % 2 == 1)
    return odd.select(*keys, "lvl", "cx", F.col("cy_").alias("cy"), F.lit(True).alias("inside")).unionByName(
        leaf.select(*keys, F.lit(0).alias("lvl"), "cx", "cy", F.lit(False).alias("inside")))


def stored_map(edges: DataFrame, keys: list[str], g: float) -> tuple[DataFrame, DataFrame]:
    """(edges, cover) written once: a map is loaded by one step and then serves any number of searches."""
    edges = stored(edges, "map-edges")
    return edges, stored(polygon_cover(edges, keys, g), "map-cover")


def point_in_polygon(points: DataFrame, edges: DataFrame, poly_keys: list[str], g: float,
                     pid: str = "pid", x: str = "x", y: str = "y",
                     shared_keys: list[str] | None = None, cover: DataFrame | None = None,
                     levels: int = LEVELS) -> DataFrame:
    """(point id, polygon keys) for every polygon containing a point.

    ``shared_keys`` (e.g. a map version carried by both sides) become extra
    equi-join keys; without them every map version is tested (G2).
    ``cover`` is a stored ``polygon_cover`` of the same edges, cell size and levels.
    """
    shared = shared_keys or []
    cells = polygon_cover(edges, poly_keys, g, levels) if cover is None else cover
    pts = points.select(pid, x, y, *shared).withColumns({"_fx": _cell(F.col(x), g), "_fy": _cell(F.col(y), g)})
    at = pts.withColumn("_c", F.explode(F.array(*[
        F.struct(F.lit(k).alias("lvl"), _up("_fx", k).alias("cx"), _up("_fy", k).alias("cy")) for k in range(levels)])))
    met = at.select(pid, x, y, "_fy", *shared, "_c.*").join(cells, [*shared, "lvl", "cx", "cy"]) \
        .select(pid, x, y, F.col("_fy").alias("cy"), "inside", *poly_keys)
    # only points in border cells meet edges
    held = edge_rows(edges, g).select(*poly_keys, "cy", F.lit(False).alias("inside"), "x1", "y1", "x2", "y2")
    par = met.join(held, [*poly_keys, "cy", "inside"], "left").groupBy(pid, *poly_keys).agg(
        F.max("inside").alias("_in"), F.sum(crosses(F.col(x), F.col(y)).cast("int")).alias("_k"))
    return par.filter(F.col("_in") | (F.col("_k") % 2 == 1)).drop("_in", "_k")


def seg_distance(px: Column, py: Column) -> Column:
    """Euclidean distance from (px, py) to the segment (x1, y1)-(x2, y2)."""
    x1, y1, x2, y2 = F.col("x1"), F.col("y1"), F.col("x2"), F.col("y2")
    dx, dy = x2 - x1, y2 - y1
    len2 = dx * dx + dy * dy
    t = F.when(len2 == 0, F.lit(0.0)).otherwise(
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), ((px - x1) * dx + (py - y1) * dy) / len2)))
    cx, cy = x1 + t * dx, y1 + t * dy
    return F.sqrt((px - cx) * (px - cx) + (py - cy) * (py - cy))


def nearest_polygon(points: DataFrame, edges: DataFrame, group: list[str], poly_key: str, g: float,
                    pid: str = "pid", x: str = "x", y: str = "y", levels: int = LEVELS) -> DataFrame:
    """Nearest polygon (by edge distance) within the point's group, exact.

    Returns (pid, poly_key, dist); ties on distance go to the smaller
    polygon key.  Points whose group has no polygon get no row.  One plan
    without rounds: per level an equi join on the parent cell, then the bounds
    of a point's own cells decide which of them stay.
    """
    held = edge_cells(edges, g).select(*group, poly_key, "cx", "cy", "x1", "y1", "x2", "y2")
    leaf = held.select(*group, "cx", "cy").distinct()
    own = Window.partitionBy(pid)
    near = points.select(pid, x, y, *group)
    for k in reversed(range(levels)):
        tree = leaf.select(*group, _up("cx", k).alias("cx"), _up("cy", k).alias("cy")).distinct()
        if k == levels - 1:
            near = near.join(tree, group)
        else:
            tree = tree.withColumns({"_px": F.shiftright("cx", SHIFT), "_py": F.shiftright("cy", SHIFT)})
            near = near.withColumnsRenamed({"cx": "_px", "cy": "_py"}).join(tree, [*group, "_px", "_py"]).drop("_px", "_py")
        side = g * STEP ** k
        left, low = F.col(x) - F.col("cx") * side, F.col(y) - F.col("cy") * side
        far = F.hypot(F.greatest(F.abs(left), F.abs(left - side)), F.greatest(F.abs(low), F.abs(low - side)))
        close = F.hypot(F.greatest(F.lit(0.0), -left, left - side), F.greatest(F.lit(0.0), -low, low - side))
        near = near.withColumn("_far", F.min(far).over(own)) \
            .filter(close <= F.col("_far") * (1 + 1e-9) + 10 * PAD * g).drop("_far")
    # points times edges: a minimum of numbers is kept in a hash table as they are made, one of structs would sort them all
    best = near.join(held, [*group, "cx", "cy"]).withColumn("dist", seg_distance(F.col(x), F.col(y))) \
        .groupBy(pid, poly_key).agg(F.min("dist").alias("dist"), F.max(F.isnull("dist")).alias("_open")) \
        .withColumn("dist", F.when(~F.col("_open"), F.col("dist"))).groupBy(pid).agg(F.min(F.struct("dist", poly_key)).alias("b"))
    return best.select(pid, F.col(f"b.{poly_key}").alias(poly_key), F.col("b.dist").alias("dist"))


def zonal_mean(cells: DataFrame, values: DataFrame, edges: DataFrame, poly_keys: list[str], g: float,
               cell_id: str, time_col: str, value_col: str) -> DataFrame:
    """Mean of cell values per polygon and time step.

    Membership is computed once per *distinct* cell centre, then joined to
    the (much larger) cell x time values and averaged."""
    member = point_in_polygon(cells, edges, poly_keys, g, pid=cell_id)
    j = values.join(member, cell_id)
    return j.groupBy(*poly_keys, time_col).agg(F.avg(value_col).alias("mean_value"), F.count(F.lit(1)).alias("n"))
