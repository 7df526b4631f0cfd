"""Catalogue: point in polygon, zonal mean, nearest polygon.

Points come from the ``embeddings`` table (first two components x 10 as a
plane position), so the work grows with the data; the district maps are two
small fixed map versions with a convex, a concave, a holed and a two-part
polygon, and in ``q_map_from_table`` a map whose vertices are a table's rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polidata.operators import geo as G
from polidata.plans.tables import table

CELL = 0.5

# Test district maps as (map, polygon, state, ring, [(x, y), ...]).
MAPS = [
    (1, "A", "S1", 0, [(-1, -1), (0, -1), (0, 0), (-1, 0)]),
    (1, "B", "S1", 0, [(0, 0), (2, 0), (2, 2), (1.5, 2), (1.5, 0.5), (0.5, 0.5), (0.5, 2), (0, 2)]),
    (1, "C", "S2", 0, [(-2, 0), (0, 0), (0, 2), (-2, 2)]),
    (1, "C", "S2", 1, [(-1.5, 0.5), (-0.5, 0.5), (-0.5, 1.5), (-1.5, 1.5)]),
    (1, "D", "S2", 0, [(0.5, -2), (1.5, -2), (1.5, -1), (0.5, -1)]),
    (1, "D", "S2", 1, [(1.6, -0.9), (2.2, -0.9), (2.2, -0.2), (1.6, -0.2)]),
    (2, "E", "S1", 0, [(-2, -2), (2, -2), (0, 2)]),
    (2, "F", "S2", 0, [(0, 0), (1, 0), (1, 1), (0, 1)]),
]


def map_edges(spark: SparkSession) -> DataFrame:
    """Vertex rows -> closed-ring edge table (the map-load step, D21)."""
    verts = [(m, p, st, ring, i, float(x), float(y))
             for m, p, st, ring, pts in MAPS for i, (x, y) in enumerate(pts)]
    v = spark.createDataFrame(verts, "map_id int, poly_id string, state string, ring int, seq int, x double, y double")
    return F.broadcast(G.polygon_edges(v, ["map_id", "poly_id", "state"]))


def _edges_sql() -> str:
    rows = []
    for m, p, st, ring, pts in MAPS:
        n = len(pts)
        for i, (x1, y1) in enumerate(pts):
            x2, y2 = pts[(i + 1) % n]
            rows.append(f"({m}, '{p}', '{st}', {ring}, {i}, {float(x1)}, {float(y1)}, {float(x2)}, {float(y2)})")
    return ("edges(map_id, poly_id, state, ring, seq, x1, y1, x2, y2) AS (SELECT col0, col1, col2, col3, col4, "
            "CAST(col5 AS DOUBLE), CAST(col6 AS DOUBLE), CAST(col7 AS DOUBLE), CAST(col8 AS DOUBLE) FROM (VALUES "
            + ", ".join(rows) + "))")


def points(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", (F.element_at("embedding", 1).cast("double") * 10).alias("x"),
                    (F.element_at("embedding", 2).cast("double") * 10).alias("y"),
                    (F.element_at("embedding", 3).cast("double") * 100).alias("value"),
                    F.col("label").alias("day"),
                    F.when(F.col("label") % 2 == 0, "S1").otherwise("S2").alias("state"))


_PTS_SQL = """pts AS (SELECT vec_id, CAST(embedding[1] AS DOUBLE) * 10 AS x, CAST(embedding[2] AS DOUBLE) * 10 AS y,
  CAST(embedding[3] AS DOUBLE) * 100 AS value, label AS day, CASE WHEN label % 2 = 0 THEN 'S1' ELSE 'S2' END AS state
  FROM embeddings)"""

_INSIDE_SQL = """inside AS (SELECT p.vec_id, e.map_id, e.poly_id FROM pts p CROSS JOIN edges e
  GROUP BY p.vec_id, e.map_id, e.poly_id
  HAVING SUM(CASE WHEN ((e.y1 > p.y) <> (e.y2 > p.y)) AND p.x < (e.x2 - e.x1) * (p.y - e.y1) / (e.y2 - e.y1) + e.x1
                  THEN 1 ELSE 0 END) % 2 = 1)"""


# -- J14 G1 G2: every map version, every containing polygon ------------------
def q_point_in_polygon(spark: SparkSession, sf: str) -> DataFrame:
    pts = points(spark, sf)
    return G.point_in_polygon(pts, map_edges(spark), ["map_id", "poly_id"], CELL, pid="vec_id")


SQL_POINT_IN_POLYGON = f"WITH {_edges_sql()}, {_PTS_SQL}, {_INSIDE_SQL} SELECT vec_id, map_id, poly_id FROM inside"


# -- G5 A17: polygon mean of cell values per time step -----------------------
def q_zonal_mean(spark: SparkSession, sf: str) -> DataFrame:
    pts = points(spark, sf)
    cells = pts.select("vec_id", "x", "y")
    values = pts.select("vec_id", "day", "value")
    z = G.zonal_mean(cells, values, map_edges(spark), ["map_id", "poly_id"], CELL, "vec_id", "day", "value")
    return z.withColumn("mean_value", F.round("mean_value", 6))


SQL_ZONAL_MEAN = f"""WITH {_edges_sql()}, {_PTS_SQL}, {_INSIDE_SQL}
SELECT i.map_id, i.poly_id, p.day, round(AVG(p.value), 6) AS mean_value, COUNT(*) AS n
FROM inside i JOIN pts p USING (vec_id) GROUP BY ALL"""


# -- G3 G4 A14: inside, else nearest polygon of the same state, in every map version
def _inside_or_nearest(pts: DataFrame, edges: DataFrame, maps: list[str], cell: float) -> DataFrame:
    """(maps..., vec_id, poly_id, dist, match_method) for points(vec_id, x, y, state) and every map of their state."""
    edges, cover = G.stored_map(edges, [*maps, "poly_id"], cell)
    pm = pts.select("vec_id", "x", "y", "state").join(edges.select(*maps, "state").distinct(), "state") \
        .withColumn("pid", F.struct("vec_id", *maps))
    inside = G.point_in_polygon(pm, edges, [*maps, "poly_id"], cell, shared_keys=maps, cover=cover)
    inside = inside.groupBy("pid").agg(F.min("poly_id").alias("poly_id")) \
        .withColumns({"dist": F.lit(0.0), "match_method": F.lit("inside")})
    rest = pm.join(inside.select("pid"), "pid", "left_anti")
    near = G.nearest_polygon(rest, edges, [*maps, "state"], "poly_id", cell).withColumn("match_method", F.lit("nearest"))
    out = inside.unionByName(near)
    return out.select("pid.*", "poly_id", F.round("dist", 9).alias("dist"), "match_method")


def q_nearest_polygon(spark: SparkSession, sf: str) -> DataFrame:
    return _inside_or_nearest(points(spark, sf), map_edges(spark), ["map_id"], CELL)


_NEAREST_SQL = """pm AS (SELECT p.vec_id, p.x, p.y, p.state, m.map_id
  FROM pts p JOIN (SELECT DISTINCT map_id, state FROM edges) m USING (state)),
inside AS (SELECT p.vec_id, p.map_id, e.poly_id FROM pm p JOIN edges e USING (map_id) GROUP BY ALL
  HAVING SUM(CASE WHEN ((e.y1 > p.y) <> (e.y2 > p.y)) AND p.x < (e.x2 - e.x1) * (p.y - e.y1) / (e.y2 - e.y1) + e.x1
                  THEN 1 ELSE 0 END) % 2 = 1),
ins AS (SELECT vec_id, map_id, MIN(poly_id) AS poly_id, 0.0 AS dist, 'inside' AS match_method FROM inside GROUP BY ALL),
rest AS (SELECT * FROM pm ANTI JOIN ins USING (vec_id, map_id)),
d AS (SELECT r.vec_id, r.map_id, e.poly_id, e.x1, e.y1, e.x2 - e.x1 AS dx, e.y2 - e.y1 AS dy, r.x AS px, r.y AS py
      FROM rest r JOIN edges e USING (map_id, state)),
t AS (SELECT *, dx * dx + dy * dy AS len2 FROM d),
u AS (SELECT *, CASE WHEN len2 = 0 THEN 0.0 ELSE least(1.0, greatest(0.0, ((px - x1) * dx + (py - y1) * dy) / len2)) END AS tt
      FROM t),
v AS (SELECT vec_id, map_id, poly_id,
        sqrt((px - (x1 + tt * dx)) * (px - (x1 + tt * dx)) + (py - (y1 + tt * dy)) * (py - (y1 + tt * dy))) AS dist FROM u),
near AS (SELECT vec_id, map_id, (min((dist, poly_id)))[2] AS poly_id, min(dist) AS dist, 'nearest' AS match_method FROM v GROUP BY ALL)
SELECT vec_id, map_id, poly_id, round(dist, 9) AS dist, match_method FROM ins
UNION ALL SELECT vec_id, map_id, poly_id, round(dist, 9), match_method FROM near"""

SQL_NEAREST_POLYGON = f"WITH {_edges_sql()}, {_PTS_SQL}, {_NEAREST_SQL}"


# -- D21 S20 G3: a map of many edges read from a table -------------------------------------------------------
# Every customer is a vertex of its nation's skyline; nations lie side by side in five states of five
# districts, and odd and even keys make two map versions.
def skyline_vertices(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    n = (c.agg(F.max("c_custkey")).first()[0] or 0) + 1
    x0 = (F.col("c_nationkey") % 5).cast("double") - 2.5
    y0 = F.floor(F.col("c_nationkey") / 5).cast("double") - 2.5
    tips = c.select(
        (F.col("c_custkey") % 2).cast("int").alias("map_id"), F.col("c_nationkey").cast("int").alias("poly_id"),
        F.col("c_custkey").cast("long").alias("seq"), (x0 + F.col("c_custkey") / F.lit(n) * 0.8).alias("x"),
        (y0 + 0.1 + (F.col("c_acctbal").cast("double") + 1000.0) / 11000.0 * 0.8).alias("y"))
    feet = tips.select("map_id", "poly_id").distinct().select("map_id", "poly_id", F.explode(F.array(
        F.struct(F.lit(-1).cast("long").alias("seq"), F.lit(0.0).alias("dx")),
        F.struct(F.lit(2 ** 62).alias("seq"), F.lit(0.8).alias("dx")))).alias("f"))
    feet = feet.select("map_id", "poly_id", "f.seq", (F.col("poly_id") % 5 - 2.5 + F.col("f.dx")).alias("x"),
                       (F.floor(F.col("poly_id") / 5) - 2.5).cast("double").alias("y"))
    return tips.unionByName(feet).withColumns({"ring": F.lit(0), "state": F.concat(F.lit("S"), (F.col("poly_id") % 2 + 1).cast("string"))})


def q_map_from_table(spark: SparkSession, sf: str) -> DataFrame:
    edges = G.polygon_edges(skyline_vertices(spark, sf), ["map_id", "poly_id", "state"])
    return _inside_or_nearest(points(spark, sf), edges, ["map_id"], CELL / 8)


SQL_MAP_FROM_TABLE = f"""WITH {_PTS_SQL}, top AS (SELECT max(c_custkey) + 1 AS n FROM customer),
tips AS (SELECT CAST(c_custkey % 2 AS INT) AS map_id, CAST(c_nationkey AS INT) AS poly_id, CAST(c_custkey AS BIGINT) AS seq,
    (c_nationkey % 5) - CAST(2.5 AS DOUBLE) + CAST(c_custkey AS DOUBLE) / n * CAST(0.8 AS DOUBLE) AS x,
    c_nationkey // 5 - CAST(2.5 AS DOUBLE) + CAST(0.1 AS DOUBLE)
      + (CAST(c_acctbal AS DOUBLE) + 1000) / CAST(11000 AS DOUBLE) * CAST(0.8 AS DOUBLE) AS y FROM customer, top),
verts AS (SELECT * FROM tips UNION ALL
  SELECT DISTINCT map_id, poly_id, -1, (poly_id % 5) - CAST(2.5 AS DOUBLE), poly_id // 5 - CAST(2.5 AS DOUBLE) FROM tips UNION ALL
  SELECT DISTINCT map_id, poly_id, 4611686018427387904, (poly_id % 5) - CAST(2.5 AS DOUBLE) + CAST(0.8 AS DOUBLE),
    poly_id // 5 - CAST(2.5 AS DOUBLE) FROM tips),
edges AS (SELECT map_id, poly_id, concat('S', poly_id % 2 + 1) AS state, x AS x1, y AS y1,
    coalesce(lead(x) OVER w, first_value(x) OVER w) AS x2, coalesce(lead(y) OVER w, first_value(y) OVER w) AS y2
  FROM verts WINDOW w AS (PARTITION BY map_id, poly_id ORDER BY seq)), {_NEAREST_SQL}"""


QUERIES = {"q_point_in_polygon": q_point_in_polygon, "q_zonal_mean": q_zonal_mean,
           "q_nearest_polygon": q_nearest_polygon, "q_map_from_table": q_map_from_table}
ORACLE = {"q_point_in_polygon": SQL_POINT_IN_POLYGON, "q_zonal_mean": SQL_ZONAL_MEAN,
          "q_nearest_polygon": SQL_NEAREST_POLYGON, "q_map_from_table": SQL_MAP_FROM_TABLE}
