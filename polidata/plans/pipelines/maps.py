"""D21 district map load, D18 plant -> district for every map version."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polidata.operators.geo import bboxes, nearest_polygon, point_in_polygon, polygon_cover, polygon_edges, stored_map
from polidata.operators.windows import keep_group_max

POLY = ["assembly", "state_name", "district"]


def load_maps(vertices: DataFrame, cell_size: float) -> dict[str, DataFrame]:
    """Vertex rows (assembly, state_name, district, ring, seq, x, y) ->
    edge table, bounding boxes and cell cover (write partitioned by assembly).  A stored cover serves
    ``point_in_polygon`` as its ``cover``."""
    edges = polygon_edges(vertices, POLY)
    return {"district_edges": edges, "district_bbox": bboxes(edges, POLY),
            "district_cells": polygon_cover(edges, POLY, cell_size)}


def plant_set(f860: DataFrame, all_years: bool = False) -> DataFrame:
    """Plants to place: the reference set (2015 minus 2014) + 2013 + 2012, or
    every plant with ``all_years``; latest year per plant; DC and missing
    longitude out."""
    d = f860.select("plant_code", "street_address", "city", "zip", "state", "latitude", "longitude", "year") \
        .filter((F.col("state") != "DC") & F.col("longitude").isNotNull()).distinct()
    if not all_years:
        def yr(y):
            return d.filter(F.col("year") == y).select("plant_code")
        keys = yr(2015).subtract(yr(2014)).union(yr(2013)).union(yr(2012)).distinct()
        d = d.join(keys, "plant_code", "left_semi")
    return keep_group_max(d, ["plant_code"], "year").drop("year")


def plants_to_districts(plants: DataFrame, states: DataFrame, edges: DataFrame, cell_size: float) -> DataFrame:
    """Every plant x every map version: containing district, else the nearest
    district of the plant's own state (distance in a plane whose x axis is
    scaled by the cosine of the state's mean latitude)."""
    edges, cover = stored_map(edges, POLY, cell_size)
    st = states.select(F.col("state_code").alias("state"), "state_name", "fips")
    p = plants.join(st, "state", "left").withColumn("x", F.col("longitude")).withColumn("y", F.col("latitude"))
    # per map version and state: the x-axis scale of the distance plane.  Joining it on the plant's state pairs each plant with every map
    # version through an equi join (no cross product).
    scale = edges.groupBy("assembly", "state_name").agg(
        F.cos(F.radians((F.min(F.least("y1", "y2")) + F.max(F.greatest("y1", "y2"))) / 2)).alias("_k"))
    pm = p.join(scale, "state_name")
    pm = pm.withColumn("pid", F.concat_ws("|", F.col("plant_code").cast("string"), F.col("assembly").cast("string")))
    inside = point_in_polygon(pm.select("pid", "x", "y", "assembly"), edges, POLY, cell_size, pid="pid",
                              shared_keys=["assembly"], cover=cover)
    inside = inside.groupBy("pid").agg(F.min(F.struct("state_name", "district")).alias("_m")) \
        .select("pid", F.col("_m.district").alias("district"), F.lit("inside").alias("match_method"))
    rest = pm.join(inside.select("pid"), "pid", "left_anti")
    e2 = edges.join(scale, ["assembly", "state_name"]).withColumns(
        {"x1": F.col("x1") * F.col("_k"), "x2": F.col("x2") * F.col("_k")})
    r2 = rest.withColumn("x", F.col("x") * F.col("_k"))
    near = nearest_polygon(r2.select("pid", "x", "y", "assembly", "state_name"), e2,
                           ["assembly", "state_name"], "district", cell_size, pid="pid")
    near = near.select("pid", "district", F.lit("nearest").alias("match_method"))
    placed = inside.unionByName(near)
    out = pm.join(placed, "pid", "left").drop("pid", "x", "y", "_k")
    return out.withColumnRenamed("district", "district_code")
