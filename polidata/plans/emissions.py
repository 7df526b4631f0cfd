"""Flagship: modelled emissions per region-year against a published total.

Shape of the reference analysis (fuel use per plant and source -> emission
factors -> location -> region-year sum -> ratio to a published series), run
on the warehouse tables:

* fuel use      = lineitem quantities; the two reporting forms are the two
                  ``l_linestatus`` values (F reports in mmbtu, O in units)
* plant         = supplier, energy source = ``l_returnflag``
* factors       = a three-row factor table; code R has no factor, so its
                  emissions count as 0 (``sum(na.rm = TRUE)``)
* location      = supplier -> nation -> region
* published     = region-year sum of ``o_totalprice`` (in millions)

Plan: one scan of lineitem with the form as a tag (instead of one scan per
form), one partial+final aggregate, a broadcast join to the bounded factor
table, a pre-aggregation to (year, plant) *before* the plant-location join,
then a tiny (year, region) join to the published totals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polidata.functions.civics import assembly_of_year
from polidata.operators.joins import inline_table
from polidata.plans.tables import table

# Kg CO2 per mmbtu and per unit for each energy-source code.
FACTORS = [("A", 95.52, 2000.0), ("N", 53.06, 1500.0), ("X", 73.96, 1800.0)]
FACTOR_SCHEMA = "esource string, kg_co2_per_mmbtu double, kg_co2_per_unit double"


def fuel_use(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return (li.select(F.year("l_shipdate").alias("year"), F.col("l_suppkey").alias("plant_id"),
                      F.col("l_returnflag").alias("esource"), F.col("l_linestatus").alias("form"),
                      "l_quantity")
              .groupBy("year", "plant_id", "esource", "form")
              .agg(F.sum("l_quantity").alias("con")))


def plant_emissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    fac = inline_table(spark, FACTORS, FACTOR_SCHEMA)
    e = fuel_use(spark, sf_dir).join(fac, "esource", "left")
    factor = F.when(F.col("form") == "F", F.col("kg_co2_per_mmbtu")).otherwise(F.col("kg_co2_per_unit"))
    e = e.withColumn("co2", F.coalesce(F.col("con") * factor, F.lit(0.0)))
    return e.groupBy("year", "plant_id").agg(F.sum("co2").alias("co2"))


def region_of(spark, sf_dir, entity: str) -> DataFrame:
    """(key, region) for suppliers or customers; nation/region are fixed-size."""
    nation = F.broadcast(table(spark, sf_dir, "nation"))
    region = F.broadcast(table(spark, sf_dir, "region"))
    if entity == "supplier":
        base = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"),
                                                       F.col("s_nationkey").alias("nk"))
    else:
        base = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"),
                                                       F.col("c_nationkey").alias("nk"))
    return (base.join(nation, base.nk == nation.n_nationkey)
                .join(region, nation.n_regionkey == region.r_regionkey)
                .select("key", F.col("r_name").alias("region")))


def q_state_emissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    plants = plant_emissions(spark, sf_dir)
    loc = region_of(spark, sf_dir, "supplier").withColumnRenamed("key", "plant_id")
    x1 = (plants.join(loc, "plant_id")
                .groupBy("year", "region").agg((F.sum("co2") / 1e6).alias("co2")))
    o = table(spark, sf_dir, "orders")
    cust = region_of(spark, sf_dir, "customer")
    y1 = (o.join(cust, o.o_custkey == cust.key)
           .groupBy(F.year("o_orderdate").alias("year"), "region")
           .agg((F.sum("o_totalprice") / 1e6).alias("value")))
    z = x1.join(y1, ["year", "region"], "left")
    return (z.select("year", "region", assembly_of_year(F.col("year")).alias("assembly"),
                     F.round("co2", 9).alias("co2"), F.round("value", 9).alias("value"),
                     F.round(F.try_divide(F.col("co2"), F.col("value")), 9).alias("r"))
             .orderBy(F.desc_nulls_last("r"), "year"))


SQL_STATE_EMISSIONS = """
WITH con AS (
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, l_suppkey AS plant_id,
         l_returnflag AS esource, l_linestatus AS form, SUM(l_quantity) AS con
  FROM lineitem GROUP BY ALL),
factors(esource, kg_co2_per_mmbtu, kg_co2_per_unit) AS (
  VALUES ('A', 95.52, 2000.0), ('N', 53.06, 1500.0), ('X', 73.96, 1800.0)),
plants AS (
  SELECT year, plant_id,
         SUM(COALESCE(con * CASE WHEN form = 'F' THEN kg_co2_per_mmbtu ELSE kg_co2_per_unit END, 0)) AS co2
  FROM con LEFT JOIN factors USING (esource) GROUP BY ALL),
x1 AS (
  SELECT p.year, r.r_name AS region, SUM(p.co2) / 1e6 AS co2
  FROM plants p JOIN supplier s ON p.plant_id = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY ALL),
y1 AS (
  SELECT CAST(year(o.o_orderdate) AS INTEGER) AS year, r.r_name AS region, SUM(o.o_totalprice) / 1e6 AS value
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  GROUP BY ALL)
SELECT x1.year, x1.region, CAST(floor((x1.year - 1787) / 2) AS INTEGER) AS assembly,
       round(x1.co2, 9) AS co2, round(y1.value, 9) AS value,
       round(x1.co2 / NULLIF(y1.value, 0), 9) AS r
FROM x1 LEFT JOIN y1 USING (year, region)
ORDER BY r DESC NULLS LAST, year
"""


QUERIES = {"q_state_emissions": q_state_emissions}
ORACLE = {"q_state_emissions": SQL_STATE_EMISSIONS}
