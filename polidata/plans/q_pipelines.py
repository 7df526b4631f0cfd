"""Catalogue: composed pipelines run over inputs Spark derives from the
warehouse tables, so their work grows with the data.

* D1 regional accounts: sales by supplier nation x part type x ship year are
  published as two wide text vintages (1995-1997 and 1997-2001, overlap year
  1997, '(NA)' cells, a national-total row and a note row), plus an income /
  population sheet by customer nation; ``regional_accounts`` turns them back
  into long tables.
* D2 unemployment: events become monthly statewide series (measure code 3 for
  error events), values as text, NULLs and a fips-72 series included;
  ``unemployment`` filters, decodes and takes the strict yearly mean.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polidata.plans.pipelines.economy import regional_accounts, unemployment
from polidata.plans.tables import table, years_of
from polidata.session import cut_lineage
from polidata.sources import readers as R

def _text(c):
    return F.coalesce(c.cast("string"), F.lit("(NA)"))


def _gsp_vintages(spark: SparkSession, sf: str):
    years = years_of(table(spark, sf, "lineitem"), "l_shipdate")
    li = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_extendedprice",
                                             F.year("l_shipdate").alias("y"))
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_type")
    sup = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    base = li.join(part, "l_partkey").join(sup, "l_suppkey")
    wide = base.groupBy("s_nationkey", "p_type").pivot("y", years).agg(F.sum("l_extendedprice"))
    wide = wide.select(F.concat(F.lpad((F.col("s_nationkey") + 1).cast("string"), 2, "0"), F.lit("000")).alias("GeoFIPS"),
                       F.concat(F.lit("State "), (F.col("s_nationkey") + 1).cast("string")).alias("GeoName"),
                       F.col("p_type").alias("IndustryId"), F.lit("All industry").alias("Description"),
                       *[_text(F.col(str(y))).alias(str(y)) for y in years])
    total = base.groupBy("p_type").pivot("y", years).agg(F.sum("l_extendedprice"))
    total = total.select(F.lit("00000").alias("GeoFIPS"), F.lit("United States").alias("GeoName"),
                         F.col("p_type").alias("IndustryId"), F.lit("All industry").alias("Description"),
                         *[_text(F.col(str(y))).alias(str(y)) for y in years])
    note = spark.range(1).select(F.lit("Note: derived from sales").alias("GeoFIPS"), *[F.lit(None).cast("string").alias(c)
                                 for c in ("GeoName", "IndustryId", "Description")], *[F.lit(None).cast("string").alias(str(y))
                                                                                      for y in years])
    allw = wide.unionByName(total).unionByName(note)
    ids = ["GeoFIPS", "GeoName", "IndustryId", "Description"]
    sic = allw.select(*ids, *[str(y) for y in years if y <= 1997])
    naics = allw.select(*ids, *[str(y) for y in years if y >= 1997])
    return naics, sic


def _income_sheet(spark: SparkSession, sf: str):
    years = years_of(table(spark, sf, "orders"), "o_orderdate")
    o = table(spark, sf, "orders").select("o_custkey", "o_totalprice", F.year("o_orderdate").alias("y"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    j = o.join(c, "o_custkey")
    inc = j.groupBy("c_nationkey").pivot("y", years).agg(F.sum("o_totalprice"))
    pop = j.groupBy("c_nationkey").pivot("y", years).agg(F.count_distinct("o_custkey"))

    def sheet(df, line, descr):
        return df.select(F.concat(F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0"), F.lit("000")).alias("GeoFIPS"),
                         F.lit("SA1").alias("Table"), F.lit(line).alias("LineCode"), F.lit(descr).alias("Description"),
                         *[_text(F.col(str(y))).alias(str(y)) for y in years])
    return sheet(inc, 1, "Personal income (millions of dollars)").unionByName(sheet(pop, 2, "Population (persons)"))


def q_bea_gsp(spark: SparkSession, sf: str) -> DataFrame:
    naics, sic = _gsp_vintages(spark, sf)
    out = regional_accounts(naics, sic, _income_sheet(spark, sf))["bea_gsp"]
    return out.select("fips", F.col("industryid").alias("industry"), "year",
                      F.round("value", 2).alias("value"), "units")


SQL_BEA_GSP = """
WITH base AS (SELECT s.s_nationkey + 1 AS fips, p.p_type AS industry, CAST(year(l.l_shipdate) AS INTEGER) AS year,
                     l.l_extendedprice AS v
              FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey),
keys AS (SELECT DISTINCT fips, industry FROM base),
yrs AS (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem WHERE l_shipdate IS NOT NULL),
sums AS (SELECT fips, industry, year, SUM(v) AS v FROM base GROUP BY ALL)
SELECT CAST(k.fips AS INTEGER) AS fips, k.industry, CAST(y.year AS INTEGER) AS year, round(s.v, 2) AS value,
       'millions of current dollars' AS units
FROM keys k, yrs y LEFT JOIN sums s ON s.fips = k.fips AND s.industry = k.industry AND s.year = y.year
"""


def q_bea_income(spark: SparkSession, sf: str) -> DataFrame:
    naics, sic = _gsp_vintages(spark, sf)
    out = regional_accounts(naics, sic, _income_sheet(spark, sf))
    cols = ["fips", "year", "linecode", "description", "units"]
    gsi = out["bea_gsi"].select(*cols, F.round("value", 2).alias("value"))
    pop = out["bea_pop"].select(*cols, F.round("value", 2).alias("value"))
    return gsi.unionByName(pop)


SQL_BEA_INCOME = """
WITH j AS (SELECT c.c_nationkey + 1 AS fips, CAST(year(o.o_orderdate) AS INTEGER) AS year, o.o_totalprice, o.o_custkey
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
keys AS (SELECT DISTINCT fips FROM j),
yrs AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders WHERE o_orderdate IS NOT NULL),
agg AS (SELECT fips, year, SUM(o_totalprice) AS inc, CAST(COUNT(DISTINCT o_custkey) AS DOUBLE) AS pop FROM j GROUP BY ALL)
SELECT CAST(k.fips AS INTEGER) AS fips, CAST(y.year AS INTEGER) AS year, 1 AS linecode,
       'Personal income' AS description, 'millions of dollars' AS units, round(a.inc, 2) AS value
FROM keys k, yrs y LEFT JOIN agg a ON a.fips = k.fips AND a.year = y.year
UNION ALL
SELECT CAST(k.fips AS INTEGER), CAST(y.year AS INTEGER), 2, 'Population', 'persons', round(a.pop, 2)
FROM keys k, yrs y LEFT JOIN agg a ON a.fips = k.fips AND a.year = y.year
"""


def q_bls_unemployment(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    fips = F.col("user_id") % 80
    series = F.concat(F.lit("LASST"), F.lpad(fips.cast("string"), 2, "0"), F.lit("000000000000"),
                      F.when(F.col("event_type") == "error", F.lit("3")).otherwise(F.lit("4")))
    value = F.when(F.col("event_id") % 97 == 0, F.lit(None)).otherwise(F.col("value").cast("string"))
    s = e.select(series.alias("series_id"), F.year("ts").alias("year"),
                 F.concat(F.lit("M"), F.lpad(F.month("ts").cast("string"), 2, "0")).alias("period"), value.alias("value"))
    out = unemployment(s)
    return out.withColumn("avg_unempl", F.round("avg_unempl", 9))


SQL_BLS_UNEMPLOYMENT = """
WITH s AS (SELECT user_id % 80 AS fips, CAST(year(ts) AS INTEGER) AS year,
                  CASE WHEN event_id % 97 = 0 THEN NULL ELSE value END AS v
           FROM events WHERE event_type = 'error')
SELECT CAST(fips AS INTEGER) AS fips, year,
       round(CASE WHEN COUNT(*) = COUNT(v) THEN AVG(v) END, 9) AS avg_unempl
FROM s WHERE fips <> 72 GROUP BY fips, year
"""

QUERIES = {"q_bea_gsp": q_bea_gsp, "q_bea_income": q_bea_income, "q_bls_unemployment": q_bls_unemployment}
ORACLE = {"q_bea_gsp": SQL_BEA_GSP, "q_bea_income": SQL_BEA_INCOME, "q_bls_unemployment": SQL_BLS_UNEMPLOYMENT}


# -- D16: degree days by district from grid cells ------------------------------
def q_dd_district(spark: SparkSession, sf: str) -> DataFrame:
    from polidata.plans.pipelines.weather import degree_days_by_district
    from polidata.plans.q_geo import CELL, map_edges
    e = table(spark, sf, "embeddings")
    cells = e.select((F.element_at("embedding", 1).cast("double") * 10).alias("x"),
                     (F.element_at("embedding", 2).cast("double") * 10).alias("y"),
                     F.date_add(F.lit("1994-12-27").cast("date"), F.col("label")).alias("date"),
                     (F.element_at("embedding", 3).cast("double") * 100).alias("tmean"))
    # map version 1 serves the 103rd assembly (1993-94), version 2 the 104th (1995-96)
    edges = map_edges(spark).select((F.col("map_id") + 102).alias("assembly"), F.col("state").alias("fips"),
                                    F.col("poly_id").alias("district"), "ring", "seq", "x1", "y1", "x2", "y2")
    out = degree_days_by_district(cells, edges, CELL)
    return out.select("fips", "district", F.col("date").cast("string").alias("date"),
                      F.round("tmean", 6).alias("tmean"), "cdd", "hdd")


def _sql_dd_district():
    from polidata.plans.q_geo import _edges_sql
    return f"""WITH {_edges_sql()},
cells AS (SELECT CAST(embedding[1] AS DOUBLE) * 10 AS x, CAST(embedding[2] AS DOUBLE) * 10 AS y,
                 CAST(DATE '1994-12-27' + label AS DATE) AS date, CAST(embedding[3] AS DOUBLE) * 100 AS tmean
          FROM embeddings),
pts AS (SELECT DISTINCT x, y FROM cells),
inside AS (SELECT p.x, p.y, e.map_id + 102 AS assembly, e.state AS fips, e.poly_id AS district
  FROM pts p CROSS JOIN edges e GROUP BY p.x, p.y, e.map_id, e.state, e.poly_id
  HAVING SUM(CASE WHEN ((e.y1 > p.y) <> (e.y2 > p.y)) AND p.x < (e.x2 - e.x1) * (p.y - e.y1) / (e.y2 - e.y1) + e.x1
                  THEN 1 ELSE 0 END) % 2 = 1),
v AS (SELECT c.*, CAST(floor((year(c.date) - 1787) / 2) AS INTEGER) AS assembly FROM cells c),
m AS (SELECT i.fips, i.district, v.date, AVG(v.tmean) AS tmean FROM v JOIN inside i
      ON v.x = i.x AND v.y = i.y AND v.assembly = i.assembly GROUP BY ALL),
d AS (SELECT *, tmean * 9 / 5 + 32 - 65 AS dd FROM m)
SELECT fips, district, CAST(date AS VARCHAR) AS date, round(tmean, 6) AS tmean,
  CASE WHEN dd IS NULL THEN NULL WHEN dd >= 0 THEN round_even(abs(dd), 0) ELSE 0.0 END AS cdd,
  CASE WHEN dd IS NULL THEN NULL WHEN dd <= 0 THEN round_even(abs(dd), 0) ELSE 0.0 END AS hdd
FROM d"""


QUERIES["q_dd_district"] = q_dd_district
ORACLE["q_dd_district"] = _sql_dd_district()


# -- D20: the 410-character monthly fuel master, built from lineitem -----------
def master_410(spark: SparkSession, sf: str) -> DataFrame:
    """One record per (supplier, fuel code, year) in the documented layout:
    codes and names in positions 1-82, 12 monthly groups of generation (10),
    consumption (8) and stocks (8) in 83-394, plant/NERC/company codes and
    descriptions in 395-410."""
    li = table(spark, sf, "lineitem")
    fuel = F.when(F.col("l_returnflag") == "A", "4").when(F.col("l_returnflag") == "N", "9").otherwise(F.lit(None))
    m = li.groupBy("l_suppkey", fuel.alias("fuel"), (F.year("l_shipdate") - 1910).alias("yy"),
                   F.month("l_shipdate").alias("month")).agg(
        (F.sum("l_quantity") * 1000 - 25000).cast("long").alias("gen"),
        F.sum(F.col("l_quantity") * F.col("l_linenumber")).cast("long").alias("con"),
        F.count(F.lit(1)).alias("stk"))
    months = list(range(1, 13))
    w = m.groupBy("l_suppkey", "fuel", "yy").pivot("month", months).agg(
        F.first("gen").alias("g"), F.first("con").alias("c"), F.first("stk").alias("s"))

    def num(c, width):
        return F.coalesce(R.fitting(F.col(c), width, " "), F.lit(" " * width))

    k = F.col("l_suppkey")
    parts = [F.lpad((k % 90 + 10).cast("string"), 2, "0"), F.lpad((k % 50 + 1).cast("string"), 2, "0"),
             F.when(k % 6 == 0, F.lit(" ")).otherwise((k % 9 + 1).cast("string")), (k % 8 + 1).cast("string"),
             F.coalesce(F.col("fuel"), F.lit(" ")), F.lpad((k % 1000).cast("string"), 3, "0"),
             F.lpad((k % 997).cast("string"), 3, "0"),
             F.rpad(F.concat(F.lit("Company "), k.cast("string")), 25, " "),
             F.rpad(F.concat(F.lit("P"), (k % 10 ** 10).cast("string")), 11, " "), F.lit(" " * 7), F.rpad(F.lit("FUEL"), 9, " "),
             F.lpad((k % 100_000).cast("string"), 5, "0"), F.lit(" "), F.lit("M"), F.lit("0188"), F.lit(" "), F.lit("   "),
             F.lpad(F.col("yy").cast("string"), 2, "0")]
    for mo in months:
        parts += [num(f"{mo}_g", 10), num(f"{mo}_c", 8), num(f"{mo}_s", 8)]
    parts += [F.lpad((k % 10000).cast("string"), 4, "0"), F.lpad((k % 11 + 1).cast("string"), 2, "0"),
              F.lpad((k % 100_000).cast("string"), 5, "0"), F.lit("BIT"), F.lit("ST")]
    return w.select(R.fixed_record(parts, 410).alias("value"))


def q_fuel_master(spark: SparkSession, sf: str) -> DataFrame:
    from polidata.plans.pipelines.energy import fuel_master_monthly
    out = fuel_master_monthly(spark, master_410(spark, sf))
    return out.select("plant_code", "company_code", "fuel", "fuel_label", "ownership_label", "prime_mover_label",
                      "nerc_label", "year", "month", "generation", F.round("generation_mwh", 6).alias("generation_mwh"),
                      "consumption", "stocks")


def _sql_fuel_master():
    from polidata.plans.pipelines.energy import FUEL, NERC, OWNERSHIP, PRIME_MOVER

    def values(rows):
        return ", ".join(f"('{a}', '{b}')" for a, b in rows)
    return f"""
WITH m AS (SELECT l_suppkey AS k, CASE l_returnflag WHEN 'A' THEN '4' WHEN 'N' THEN '9' END AS fuel,
                  CAST(year(l_shipdate) AS INTEGER) - 10 AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
                  CAST(SUM(l_quantity) * 1000 - 25000 AS DOUBLE) AS generation,
                  CAST(SUM(l_quantity * l_linenumber) AS DOUBLE) AS consumption, CAST(COUNT(*) AS DOUBLE) AS stocks
           FROM lineitem GROUP BY ALL),
g AS (SELECT DISTINCT k, fuel, year FROM m),
grid AS (SELECT g.*, CAST(mm AS INTEGER) AS month FROM g, range(1, 13) t(mm)),
own(code, label) AS (VALUES {values(OWNERSHIP)}),
pm(code, label) AS (VALUES {values(PRIME_MOVER)}),
fu(code, label) AS (VALUES {values(FUEL)}),
ne(code, label) AS (VALUES {values(NERC)})
SELECT CAST(grid.k % 997 AS INTEGER) AS plant_code, CAST(grid.k % 1000 AS INTEGER) AS company_code, grid.fuel,
  CASE WHEN grid.fuel IS NULL THEN 'Water' ELSE fu.label END AS fuel_label,
  CASE WHEN grid.k % 6 = 0 THEN 'Industrial' ELSE own.label END AS ownership_label,
  pm.label AS prime_mover_label, ne.label AS nerc_label, grid.year, grid.month, m.generation,
  round(CASE WHEN grid.year < 1990 THEN m.generation / 1000 ELSE m.generation END, 6) AS generation_mwh,
  m.consumption, m.stocks
FROM grid LEFT JOIN m ON m.k = grid.k AND m.fuel IS NOT DISTINCT FROM grid.fuel AND m.year = grid.year
  AND m.month = grid.month
LEFT JOIN own ON own.code = CAST(grid.k % 9 + 1 AS VARCHAR) AND grid.k % 6 <> 0
LEFT JOIN pm ON pm.code = CAST(grid.k % 8 + 1 AS VARCHAR)
LEFT JOIN fu ON fu.code = grid.fuel
LEFT JOIN ne ON ne.code = lpad(CAST(grid.k % 11 + 1 AS VARCHAR), 2, '0')
"""


QUERIES["q_fuel_master"] = q_fuel_master
ORACLE["q_fuel_master"] = _sql_fuel_master()


# -- D8: race results from order-derived race rows ----------------------------
def race_rows(spark: SparkSession, sf: str) -> DataFrame:
    """One House race per order: the customer, the priority and a third
    candidate compete; vote counts arrive as text with thousands separators
    ('N/A' for every 11th third-party line), percentages as text."""
    from polidata.plans.q_text import _votes_text
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    o = o.join(c, "o_custkey")
    dv = F.floor(F.col("o_totalprice"))
    rv = F.floor(F.col("o_totalprice") * 0.8 + (F.col("o_orderkey") % 7) * 1000)
    tv = F.floor(F.col("o_totalprice") / 9)
    third_na = F.col("o_orderkey") % 11 == 0
    pct = {"DemVotesMajorPercent": dv * 100 / (dv + rv), "RepVotesMajorPercent": rv * 100 / (dv + rv),
           "ThirdVotesTotalPercent": F.when(third_na, F.lit(None)).otherwise(tv * 100 / (dv + rv + tv))}
    return o.select(
        F.lit("House").alias("Office"), F.concat(F.lit("State "), F.col("c_nationkey").cast("string")).alias("State"),
        F.concat(F.lit("District "), F.col("o_orderkey").cast("string")).alias("Area"),
        F.year("o_orderdate").cast("string").alias("raceYear"),
        F.concat(F.lit("Cust, "), F.col("o_custkey").cast("string")).alias("DemCandidate"),
        F.when(F.col("o_orderstatus") == "F", "Incumbent").otherwise("Challenger").alias("DemStatus"),
        _votes_text(dv).alias("DemVotes"),
        F.col("o_orderpriority").alias("RepCandidate"),
        F.when(F.col("o_orderstatus") == "O", "Incumbent").otherwise("Challenger").alias("RepStatus"),
        _votes_text(rv).alias("RepVotes"),
        F.lit("Other, Party").alias("ThirdCandidate"), F.lit("Challenger").alias("ThirdStatus"),
        F.when(third_na, F.lit("N/A")).otherwise(_votes_text(tv)).alias("ThirdVotes"),
        *[v.cast("string").alias(k) for k, v in pct.items()])


def q_races(spark: SparkSession, sf: str) -> DataFrame:
    from polidata.plans.pipelines.elections import races
    r = races(race_rows(spark, sf), "House")["races"]
    return r.select("raceYear", "State", "Area", "AllVotes", "Candidate_1", "Candidate_2", "Status_1", "Status_2",
                    F.round("VotesMajorPercent_1", 6).alias("pct_1"), F.round("VotesMajorPercent_2", 6).alias("pct_2"),
                    F.round("margin", 6).alias("margin"))


SQL_RACES = """
WITH o AS (SELECT o.*, c.c_nationkey, floor(o_totalprice) AS dv,
                  floor(o_totalprice * 0.8 + (o_orderkey % 7) * 1000) AS rv, floor(o_totalprice / 9) AS tv
           FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
cand AS (
  SELECT o_orderkey, c_nationkey, o_orderdate, dv + rv + CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE tv END AS all_votes,
         'Cust, ' || CAST(o_custkey AS VARCHAR) AS name,
         CASE WHEN o_orderstatus = 'F' THEN 'Incumbent' ELSE 'Challenger' END AS status,
         dv * 100 / (dv + rv) AS pct, 1 AS party_order FROM o
  UNION ALL
  SELECT o_orderkey, c_nationkey, o_orderdate, dv + rv + CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE tv END,
         o_orderpriority, CASE WHEN o_orderstatus = 'O' THEN 'Incumbent' ELSE 'Challenger' END,
         rv * 100 / (dv + rv), 2 FROM o
  UNION ALL
  SELECT o_orderkey, c_nationkey, o_orderdate, dv + rv + CASE WHEN o_orderkey % 11 = 0 THEN 0 ELSE tv END,
         'Other, Party', 'Challenger', CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE tv * 100 / (dv + rv + tv) END, 3 FROM o),
r AS (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY pct DESC NULLS LAST, party_order) AS rk FROM cand)
SELECT CAST(year(r1.o_orderdate) AS INTEGER) AS "raceYear", 'State ' || CAST(r1.c_nationkey AS VARCHAR) AS "State",
       'District ' || CAST(r1.o_orderkey AS VARCHAR) AS "Area", CAST(r1.all_votes AS DOUBLE) AS "AllVotes",
       r1.name AS "Candidate_1", r2.name AS "Candidate_2", r1.status AS "Status_1", r2.status AS "Status_2",
       round(r1.pct, 6) AS pct_1, round(r2.pct, 6) AS pct_2, round(COALESCE((r1.pct - r2.pct) / 100, 1.0), 6) AS margin
FROM r r1 LEFT JOIN r r2 ON r1.o_orderkey = r2.o_orderkey AND r2.rk = 2 WHERE r1.rk = 1
"""

QUERIES["q_races"] = q_races
ORACLE["q_races"] = SQL_RACES


# -- D17: yearly spending files whose columns differ, read back by header -------
def q_spending(spark: SparkSession, sf: str) -> DataFrame:
    """Orders are published as one spending CSV folder per year ('95CFFIND',
    ...), several files per folder; odd years omit the POP column.  The files are
    read back with each file's own header (never by position) and summed."""
    import os
    from polidata.plans.pipelines.spending import read_spending
    from polidata.sources.writers import scratch_dir
    base = scratch_dir(spark, "cffr")
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    rows = o.join(c, "o_custkey").select(
        F.concat(F.lpad((F.year("o_orderdate") % 100).cast("string"), 2, "0"), F.lit("CFFIND")).alias("folder"),
        F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0").alias("FIPSST"),
        F.lpad((F.col("o_custkey") % 1000).cast("string"), 3, "0").alias("FIPSCO"),
        F.concat(F.lit("ST"), F.col("c_nationkey").cast("string")).alias("STATE"),
        (F.col("o_custkey") % 5000).alias("POP"),
        F.substring("o_orderpriority", 1, 1).alias("PROG_ID"), F.col("o_orderstatus").alias("AGENCY"),
        F.col("o_totalprice").alias("AMOUNT"), (F.year("o_orderdate") % 2).alias("_odd"))
    even = rows.filter(F.col("_odd") == 0).drop("_odd")
    odd = rows.filter(F.col("_odd") == 1).drop("_odd", "POP").select("folder", "STATE", "FIPSST", "AMOUNT", "AGENCY",
                                                                     "PROG_ID", "FIPSCO")   # other column order too
    for part in (even, odd):
        # one folder per year; every writing task emits its own file (with header)
        part.write.mode("append").option("header", True).partitionBy("folder").csv(base)
    df = read_spending(spark, os.path.join(base, "*", "*.csv"))
    return df.groupBy("YEAR", "FIPSST", "AGENCY").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("AMOUNT"), 2).alias("amount"), F.sum("POP").alias("pop"))


SQL_SPENDING = """
WITH j AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') AS st,
                  o_orderstatus AS ag, o_totalprice, o_custkey % 5000 AS pop
           FROM orders JOIN customer ON o_custkey = c_custkey)
SELECT y AS "YEAR", st AS "FIPSST", ag AS "AGENCY", COUNT(*) AS n, round(SUM(o_totalprice), 2) AS amount,
       CASE WHEN y % 2 = 0 THEN CAST(SUM(pop) AS BIGINT) END AS pop
FROM j GROUP BY y, st, ag
"""

QUERIES["q_spending"] = q_spending
ORACLE["q_spending"] = SQL_SPENDING


# -- D15: degree-day report files (one column per date), read back -------------
N_BUCKETS = 16


def q_dd_state(spark: SparkSession, sf: str) -> DataFrame:
    """Daily click / view counts per user are published like the degree-day
    reports: pipe-delimited, three preamble lines, a 'Region|yyyymmdd|...'
    header, one row per region (user).  Files are bucketed by user so each
    stays small; every file carries its own preamble and header.  The
    pipeline reads them back and full-outer-joins the two kinds."""
    import os
    from polidata.plans.pipelines.weather import degree_days_by_state
    from polidata.sources.readers import numbered_lines
    from polidata.sources.writers import scratch_dir
    base = scratch_dir(spark, "degree-days")
    e = table(spark, sf, "events").select("user_id", F.date_format("ts", "yyyyMMdd").alias("d"), "event_type")
    for kind, etype in (("Cooling", "click"), ("Heating", "view")):
        counts = e.filter(F.col("event_type") == etype).groupBy("user_id").pivot("d").agg(F.count(F.lit(1)))
        dates = [c for c in counts.columns if c != "user_id"]
        region = F.concat(F.lit("U"), F.col("user_id").cast("string"))
        body = counts.select((F.col("user_id") % N_BUCKETS).alias("bucket"), F.lit(3).alias("line_no"),
                             F.concat_ws("|", region, *[F.coalesce(F.col(d).cast("string"), F.lit("")) for d in dates])
                             .alias("value"))
        head_lines = ["Degree days by region", f"{kind} degree days (derived)", "", "Region|" + "|".join(dates)]
        heads = spark.range(N_BUCKETS).select(F.col("id").cast("int").alias("b")).select(
            F.col("b").alias("bucket"),
            F.explode(F.array(*[F.struct(F.lit(i - 4).alias("n"), F.lit(t).alias("t"))
                                for i, t in enumerate(head_lines)])).alias("h")) \
            .select("bucket", F.col("h.n").alias("line_no"), F.col("h.t").alias("value"))
        # sorted by (bucket, line) so the partitioned writer keeps the line order
        lines = body.unionByName(heads).repartition("bucket").sortWithinPartitions("bucket", "line_no")
        lines.select("bucket", "value").write.mode("overwrite").partitionBy("bucket") \
            .text(os.path.join(base, f"States.{kind}"))
    out = degree_days_by_state(numbered_lines(spark, os.path.join(base, "*", "*", "*.txt")), preamble=3)
    return out.select("statecode", F.col("date").cast("string").alias("date"), "cdd", "hdd")


SQL_DD_STATE = """
WITH e AS (SELECT user_id, CAST(ts AS DATE) AS d, event_type FROM events),
c_users AS (SELECT DISTINCT user_id FROM e WHERE event_type = 'click'),
c_days AS (SELECT DISTINCT d FROM e WHERE event_type = 'click'),
c_cnt AS (SELECT user_id, d, COUNT(*) AS n FROM e WHERE event_type = 'click' GROUP BY ALL),
c AS (SELECT u.user_id, y.d, CAST(n.n AS DOUBLE) AS cdd FROM c_users u, c_days y
      LEFT JOIN c_cnt n ON n.user_id = u.user_id AND n.d = y.d),
h_users AS (SELECT DISTINCT user_id FROM e WHERE event_type = 'view'),
h_days AS (SELECT DISTINCT d FROM e WHERE event_type = 'view'),
h_cnt AS (SELECT user_id, d, COUNT(*) AS n FROM e WHERE event_type = 'view' GROUP BY ALL),
h AS (SELECT u.user_id, y.d, CAST(n.n AS DOUBLE) AS hdd FROM h_users u, h_days y
      LEFT JOIN h_cnt n ON n.user_id = u.user_id AND n.d = y.d)
SELECT 'U' || CAST(COALESCE(c.user_id, h.user_id) AS VARCHAR) AS statecode,
       CAST(COALESCE(c.d, h.d) AS VARCHAR) AS date, c.cdd, h.hdd
FROM c FULL OUTER JOIN h ON c.user_id = h.user_id AND c.d = h.d
"""

QUERIES["q_dd_state"] = q_dd_state
ORACLE["q_dd_state"] = SQL_DD_STATE


# -- D5: legislator documents (nested name / ids / bio / terms) ----------------
def _person_docs(spark: SparkSession, sf: str):
    """Nested person documents from orders: repeated fec ids (all equal or
    not), a birthday, two terms; even order keys are 'current', odd ones
    'historical'."""
    o = table(spark, sf, "orders")
    d0 = F.to_date("o_orderdate")
    k = F.col("o_orderkey")
    fec = F.when(k % 3 == 0, F.array(F.concat(F.lit("F"), F.col("o_custkey").cast("string")),
                                     F.concat(F.lit("G"), k.cast("string")))) \
        .otherwise(F.array(F.concat(F.lit("F"), F.col("o_custkey").cast("string")),
                           F.concat(F.lit("F"), F.col("o_custkey").cast("string"))))
    term = F.struct(F.lit("rep").alias("type"), d0.cast("string").alias("start"),
                    F.add_months(d0, 24).cast("string").alias("end"), F.lit("x").alias("party_affiliations"))
    term2 = F.struct(F.when(F.col("o_orderstatus") == "F", "sen").otherwise("rep").alias("type"),
                     F.add_months(d0, 24).cast("string").alias("start"),
                     F.add_months(d0, 96).cast("string").alias("end"), F.lit(None).cast("string").alias("party_affiliations"))
    docs = o.select(F.struct(F.concat(F.lit("Cust#"), F.col("o_custkey").cast("string")).alias("first"),
                             F.col("o_orderpriority").alias("last")).alias("name"),
                    F.struct(k.alias("govtrack"), fec.alias("fec")).alias("id"),
                    F.struct(F.date_sub(d0, 20000).cast("string").alias("birthday")).alias("bio"),
                    F.array(term, term2).alias("terms"), (k % 2).alias("_odd"))
    return docs.filter(F.col("_odd") == 0).drop("_odd"), docs.filter(F.col("_odd") == 1).drop("_odd")


def q_legislator_info(spark: SparkSession, sf: str) -> DataFrame:
    from polidata.plans.pipelines.legislature import legislators
    cur, hist = _person_docs(spark, sf)
    return legislators(cur, hist)["govtrack_info"]


SQL_LEGISLATOR_INFO = """
SELECT 'Cust#' || CAST(o_custkey AS VARCHAR) AS name_first, o_orderpriority AS name_last, o_orderkey AS id_govtrack,
       CASE WHEN o_orderkey % 3 = 0 THEN 'F' || CAST(o_custkey AS VARCHAR) || ',G' || CAST(o_orderkey AS VARCHAR)
            ELSE 'F' || CAST(o_custkey AS VARCHAR) END AS id_fec,
       CAST(CAST(o_orderdate AS DATE) - 20000 AS VARCHAR) AS bio_birthday
FROM orders
"""


def q_legislator_terms(spark: SparkSession, sf: str) -> DataFrame:
    from polidata.plans.pipelines.legislature import legislators
    cur, hist = _person_docs(spark, sf)
    return legislators(cur, hist)["govtrack_term"]


SQL_LEGISLATOR_TERMS = """
WITH o AS (SELECT o_orderkey, o_orderstatus, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT o_orderkey AS id_govtrack, 'rep' AS type, CAST(d AS VARCHAR) AS start,
       CAST(CAST(d + INTERVAL 24 MONTH AS DATE) AS VARCHAR) AS "end", 'House' AS chamber FROM o
UNION
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'sen' ELSE 'rep' END,
       CAST(CAST(d + INTERVAL 24 MONTH AS DATE) AS VARCHAR), CAST(CAST(d + INTERVAL 96 MONTH AS DATE) AS VARCHAR),
       CASE WHEN o_orderstatus = 'F' THEN 'Senate' ELSE 'House' END FROM o
"""

QUERIES["q_legislator_info"] = q_legislator_info
QUERIES["q_legislator_terms"] = q_legislator_terms
ORACLE["q_legislator_info"] = SQL_LEGISLATOR_INFO
ORACLE["q_legislator_terms"] = SQL_LEGISLATOR_TERMS


# -- D10: statewide results with state codes (inner join drops non-states) -----
def q_statewide(spark: SparkSession, sf: str) -> DataFrame:
    from polidata.plans.pipelines.elections import statewide_races
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    n = table(spark, sf, "nation")
    raw = o.join(c, "o_custkey").join(F.broadcast(n), F.col("c_nationkey") == n.n_nationkey).select(
        F.when(F.col("o_orderpriority") == "1-URGENT", "Governor").otherwise("President").alias("Office"),
        # every 10th nation key reports under a territory name that is not a state
        F.when(F.col("c_nationkey") % 10 == 9, F.lit("Territory")).otherwise(F.col("n_name")).alias("Area"),
        F.year("o_orderdate").alias("raceYear"), "o_orderkey", "o_totalprice")
    states = n.select(F.col("n_name").alias("state_name"),
                      F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("state_code"),
                      (F.col("n_nationkey") + 1).alias("fips"))
    return statewide_races(raw, "President", states).select("o_orderkey", "Area", "raceYear", "statecode", "fips")


SQL_STATEWIDE = """
SELECT o.o_orderkey, n.n_name AS "Area", CAST(year(o.o_orderdate) AS INTEGER) AS "raceYear",
       'S' || CAST(n.n_nationkey AS VARCHAR) AS statecode, n.n_nationkey + 1 AS fips
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE o.o_orderpriority <> '1-URGENT' AND c.c_nationkey % 10 <> 9
"""


# -- D12: plant registry across yearly vintages ---------------------------------
def plant_files(spark: SparkSession, sf: str) -> DataFrame:
    """All yearly plant files: a supplier is in the file of every year it shipped in; a column was added in 1998."""
    li = table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("s_suppkey"), F.year("l_shipdate").alias("year")).distinct()
    k, late = F.col("s_suppkey"), F.col("year") >= 1998
    base = F.array(*[F.lit(c) for c in ("plant_code", "plant_name", "state", "city")])
    return table(spark, sf, "supplier").join(li, "s_suppkey").select(
        k.alias("plant_code"), "year", F.col("s_name").alias("plant_name"), F.col("s_nationkey").alias("state"),
        F.when((k % 13 == 0) & (F.col("year") >= 1999), F.lit("Moved"))
         .otherwise(F.concat(F.lit("C"), (k % 50).cast("string"))).alias("city"),
        F.when(late, F.lit("electric")).alias("sector"), F.when(late, F.concat(base, F.array(F.lit("sector")))).otherwise(base).alias("present"))


def q_plant_registry(spark: SparkSession, sf: str) -> DataFrame:
    """Registry rows, columns that come and go, and plants whose attributes change, below one another."""
    from polidata.plans.pipelines.energy import plant_registry_long
    out = plant_registry_long(cut_lineage(plant_files(spark, sf)))
    none = F.lit(None)
    reg = out["eia_f860"].select(F.lit("registry").alias("part"), "plant_code", "year", F.concat_ws("|", "plant_name", "state", "city", "sector").alias("detail"),
                                 none.cast("int").alias("last_year"), none.cast("long").alias("n"))
    cols = out["schema_drift"].select(F.lit("schema").alias("part"), none.cast("long").alias("plant_code"), F.col("first_year").alias("year"),
                                      F.col("column").alias("detail"), "last_year", F.col("n_years").alias("n"))
    moved = out["unstable_plants"].select(F.lit("drift").alias("part"), "plant_code", none.cast("int").alias("year"), none.cast("string").alias("detail"),
                                          none.cast("int").alias("last_year"), F.col("n_versions").alias("n"))
    return reg.unionByName(cols).unionByName(moved)


SQL_PLANT_REGISTRY = """
WITH a AS (SELECT DISTINCT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS y FROM lineitem),
v AS (SELECT s.s_suppkey AS plant_code, a.y, s.s_name, s.s_nationkey,
        CASE WHEN s.s_suppkey % 13 = 0 AND a.y >= 1999 THEN 'Moved' ELSE 'C' || CAST(s.s_suppkey % 50 AS VARCHAR) END AS city,
        CASE WHEN a.y >= 1998 THEN 'electric' END AS sector
      FROM supplier s JOIN a ON a.l_suppkey = s.s_suppkey),
cols AS (SELECT DISTINCT y, unnest(CASE WHEN y >= 1998 THEN ['plant_code', 'plant_name', 'state', 'city', 'sector']
                                   ELSE ['plant_code', 'plant_name', 'state', 'city'] END) AS col FROM v)
SELECT 'registry' AS part, plant_code, y AS year, concat_ws('|', s_name, s_nationkey, city, sector) AS detail,
       CAST(NULL AS INTEGER) AS last_year, CAST(NULL AS BIGINT) AS n FROM v
UNION ALL SELECT 'schema', NULL, min(y), col, max(y), count(*) FROM cols GROUP BY col
UNION ALL SELECT 'drift', plant_code, NULL, NULL, NULL, count(DISTINCT (s_name, s_nationkey, city)) FROM v GROUP BY plant_code
  HAVING count(DISTINCT (s_name, s_nationkey, city)) > 1
"""

QUERIES["q_statewide"] = q_statewide
QUERIES["q_plant_registry"] = q_plant_registry
ORACLE["q_statewide"] = SQL_STATEWIDE
ORACLE["q_plant_registry"] = SQL_PLANT_REGISTRY


# -- D11: utility forms with monthly columns, two-digit years ------------------
def utility_forms(spark: SparkSession, sf: str) -> DataFrame:
    """Per supplier and ship year: con01..con12 / gen01..gen12 / stk01..stk12
    columns; even suppliers report a two-digit year (through 2000); generation in month 12
    is missing for every 7th supplier."""
    li = table(spark, sf, "lineitem").select("l_suppkey", F.year("l_shipdate").alias("y"),
                                             F.month("l_shipdate").alias("m"), "l_quantity", "l_linenumber")
    months = list(range(1, 13))
    w = li.groupBy("l_suppkey", "y").pivot("m", months).agg(
        F.sum("l_quantity").alias("con"), F.sum("l_linenumber").cast("double").alias("gen"),
        F.count(F.lit(1)).cast("double").alias("stk"))
    # two-digit years only where the form used them (through 2000, which reads 0)
    cols = [F.when((F.col("l_suppkey") % 2 == 0) & (F.col("y") <= 2000), F.col("y") % 100)
             .otherwise(F.col("y")).alias("year"),
            (F.col("l_suppkey") % 50 + 1).alias("fipst"), (F.col("l_suppkey") * 7).alias("utilcode"),
            F.col("l_suppkey").alias("pcode")]
    for kind in ("con", "gen", "stk"):
        for mo in months:
            c = F.col(f"{mo}_{kind}")
            if kind == "gen" and mo == 12:
                c = F.when(F.col("l_suppkey") % 7 == 0, F.lit(None)).otherwise(c)
            cols.append(c.alias(f"{kind}{mo:02d}"))
    return w.select(*cols)


def q_utility_forms(spark: SparkSession, sf: str) -> DataFrame:
    from polidata.plans.pipelines.energy import patch_utility_form
    out = patch_utility_form(utility_forms(spark, sf))
    return out.select("year", "pcode", "fipst", "utilcode", "ucode",
                      F.round("consumptio", 4).alias("consumptio"), F.round("netgenerat", 4).alias("netgenerat"),
                      F.round("stocks", 4).alias("stocks"))


def _sql_utility_forms():
    mo = range(1, 13)

    sums = ",\n  ".join(
        f"SUM(CASE WHEN m = {m} THEN l_quantity END) AS con{m:02d}, "
        f"CAST(SUM(CASE WHEN m = {m} THEN l_linenumber END) AS DOUBLE) AS gen{m:02d}, "
        f"CAST(COUNT(CASE WHEN m = {m} THEN 1 END) AS DOUBLE) AS stk{m:02d}" for m in mo)
    gen12 = "CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE gen12 END"
    con_t = " + ".join(f"con{m:02d}" for m in mo)
    gen_t = " + ".join([f"gen{m:02d}" for m in range(1, 12)] + [gen12])
    stk_t = " + ".join(f"stk{m:02d}" for m in mo)
    return f"""
WITH li AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS y, CAST(month(l_shipdate) AS INTEGER) AS m,
                   l_quantity, l_linenumber FROM lineitem),
w AS (SELECT l_suppkey, y,
  {sums}
  FROM li GROUP BY l_suppkey, y)
SELECT CAST(y AS INTEGER) AS year, l_suppkey AS pcode, CAST(l_suppkey % 50 + 1 AS DOUBLE) AS fipst,
  CASE WHEN y BETWEEN 1970 AND 1984 OR y BETWEEN 1991 AND 1995 THEN NULL ELSE CAST(l_suppkey * 7 AS DOUBLE) END AS utilcode,
  CASE WHEN y BETWEEN 1970 AND 1984 OR y BETWEEN 1991 AND 1995 THEN CAST(l_suppkey * 7 AS DOUBLE) END AS ucode,
  CASE WHEN y <= 1995 THEN round({con_t}, 4) END AS consumptio,
  CASE WHEN y <= 1995 THEN round({gen_t}, 4) END AS netgenerat,
  CASE WHEN y <= 1995 THEN round({stk_t}, 4) END AS stocks
FROM w"""


QUERIES["q_utility_forms"] = q_utility_forms
ORACLE["q_utility_forms"] = _sql_utility_forms()


# -- D14: district emissions from detail pages (table 2 per district) ----------
CARMA_PREFIX = "http://districts.example/detail/"


def carma_inputs(spark: SparkSession, sf: str):
    """members / states / detail pages derived from the warehouse: districts
    are (customer nation, custkey % 7 + 1), every 5th nation is at large;
    each district page holds a year x 7-measure table (comma thousands,
    'yyyy:' labels, a 'Future' row) after an unrelated first table."""
    from polidata.plans.q_text import _votes_text
    c = table(spark, sf, "customer").select(
        "c_custkey", "c_nationkey",
        F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("state_code"),
        (F.col("c_custkey") % 7 + 1).alias("district_code"))
    members = c.select("state_code", "district_code")
    n = table(spark, sf, "nation")
    states = n.select(F.concat(F.lit("S"), F.col("n_nationkey").cast("string")).alias("state_code"),
                      (F.col("n_nationkey") + 1).alias("fips"), (F.col("n_nationkey") % 5 == 0).alias("at_large"))
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.year("l_shipdate").alias("y"))
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
    j = li.join(o, "l_orderkey").join(c, "c_custkey")
    dcode = F.when(F.col("c_nationkey") % 5 == 0, F.lit("00")).otherwise(F.lpad(F.col("district_code").cast("string"), 2, "0"))
    j = j.select(F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0").alias("fips"), dcode.alias("dc"), "y",
                 F.least(F.col("l_linenumber"), F.lit(7)).alias("m"), "l_quantity")
    cells = j.groupBy("fips", "dc", "y").pivot("m", list(range(1, 8))).agg(F.sum("l_quantity").cast("long"))
    row = F.concat(F.lit("<tr><td>"), F.col("y").cast("string"), F.lit(":</td>"),
                   *[F.concat(F.lit("<td>"), F.coalesce(_votes_text(F.col(str(i))), F.lit("0")), F.lit("</td>"))
                     for i in range(1, 8)], F.lit("</tr>"))
    rows = cells.select("fips", "dc", "y", row.alias("tr"))
    # a page holds one row per year: a bounded collect per district
    pages = rows.groupBy("fips", "dc").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("y", "tr"))), lambda s: s["tr"]), "").alias("body"))
    head = "<tr><th>Year</th>" + "<th>m</th>" * 7 + "</tr>"
    future = "<tr><td>Future:</td>" + "<td>9,999</td>" * 7 + "</tr>"
    pages = pages.select(F.concat(F.lit(CARMA_PREFIX), "fips", "dc").alias("url"),
                         F.concat(F.lit("<table><tr><td>menu</td></tr></table><table>" + head), "body",
                                  F.lit(future + "</table>")).alias("html"))
    return members, states, pages


def q_carma(spark: SparkSession, sf: str) -> DataFrame:
    from polidata.plans.pipelines.energy import district_emissions, district_list
    members, states, pages = carma_inputs(spark, sf)
    return district_emissions(district_list(members, states), pages, CARMA_PREFIX)


SQL_CARMA = """
SELECT CAST(year(l.l_shipdate) AS INTEGER) AS year, lpad(CAST(c.c_nationkey + 1 AS VARCHAR), 2, '0') AS fips,
       CASE WHEN c.c_nationkey % 5 = 0 THEN '00' ELSE lpad(CAST(c.c_custkey % 7 + 1 AS VARCHAR), 2, '0') END AS district_code,
       CAST(SUM(l.l_quantity) AS BIGINT) AS value, 'carbon dioxide' AS variable, 'tons' AS units
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey
GROUP BY ALL
"""

QUERIES["q_carma"] = q_carma
ORACLE["q_carma"] = SQL_CARMA


# -- D18: plants -> districts for every map version -------------------------------
def q_plant_districts(spark: SparkSession, sf: str) -> DataFrame:
    """Plant registry rows derived from the embeddings (position = first two
    components x 10; 'DC' plants, missing longitudes and a 2014-only set
    included), placed in each map version: containing district, else the
    nearest district of the plant's own state."""
    from polidata.plans.pipelines.maps import plant_set, plants_to_districts
    from polidata.plans.q_geo import CELL, map_edges
    e = table(spark, sf, "embeddings")
    k = F.col("vec_id")
    f860 = e.select(k.alias("plant_code"), F.concat(F.lit("A"), k.cast("string")).alias("street_address"),
                    F.lit("C").alias("city"), F.lit("Z").alias("zip"),
                    F.when(F.col("label") == 9, "DC").when(F.col("label") % 2 == 0, "S1").otherwise("S2").alias("state"),
                    (F.element_at("embedding", 2).cast("double") * 10).alias("latitude"),
                    F.when(k % 50 == 0, F.lit(None)).otherwise(F.element_at("embedding", 1).cast("double") * 10)
                    .alias("longitude"), (k % 4 + 2012).cast("int").alias("year"))
    states = spark.createDataFrame([("S1", "S1", 1), ("S2", "S2", 2), ("DC", "DC", 11)],
                                   "state_code string, state_name string, fips int")
    edges = map_edges(spark).select((F.col("map_id") + 102).alias("assembly"), F.col("state").alias("state_name"),
                                    F.col("poly_id").alias("district"), "ring", "seq", "x1", "y1", "x2", "y2")
    out = plants_to_districts(plant_set(f860), states, edges, CELL)
    return out.select("plant_code", "assembly", "district_code", "match_method")


def _sql_plant_districts():
    from polidata.plans.q_geo import _edges_sql
    return f"""WITH {_edges_sql()},
e AS (SELECT map_id + 102 AS assembly, state AS state_name, poly_id AS district, x1, y1, x2, y2 FROM edges),
p AS (SELECT vec_id AS plant_code, CASE WHEN label = 9 THEN 'DC' WHEN label % 2 = 0 THEN 'S1' ELSE 'S2' END AS state,
             CAST(embedding[2] AS DOUBLE) * 10 AS y,
             CASE WHEN vec_id % 50 = 0 THEN NULL ELSE CAST(embedding[1] AS DOUBLE) * 10 END AS x,
             vec_id % 4 + 2012 AS year FROM embeddings),
plants AS (SELECT * FROM p WHERE state <> 'DC' AND x IS NOT NULL AND year <> 2014),
sc AS (SELECT assembly, state_name,
              cos(radians((min(least(y1, y2)) + max(greatest(y1, y2))) / 2)) AS k FROM e GROUP BY ALL),
pm AS (SELECT pl.*, sc.assembly, sc.k FROM plants pl JOIN sc ON sc.state_name = pl.state),
ins AS (SELECT pm.plant_code, pm.assembly, e.state_name, e.district FROM pm JOIN e ON e.assembly = pm.assembly
        GROUP BY pm.plant_code, pm.assembly, e.state_name, e.district
        HAVING SUM(CASE WHEN ((e.y1 > pm.y) <> (e.y2 > pm.y)) AND pm.x < (e.x2 - e.x1) * (pm.y - e.y1) / (e.y2 - e.y1) + e.x1
                        THEN 1 ELSE 0 END) % 2 = 1),
ins1 AS (SELECT plant_code, assembly, arg_min(district, (state_name, district)) AS district FROM ins GROUP BY ALL),
rest AS (SELECT pm.* FROM pm WHERE NOT EXISTS (SELECT 1 FROM ins1 i WHERE i.plant_code = pm.plant_code
                                                 AND i.assembly = pm.assembly)),
d AS (SELECT r.plant_code, r.assembly, e.district, r.x * r.k AS px, r.y AS py, e.x1 * r.k AS x1, e.y1,
             (e.x2 - e.x1) * r.k AS dx, e.y2 - e.y1 AS dy
      FROM rest r JOIN e ON e.assembly = r.assembly AND e.state_name = r.state),
t AS (SELECT *, dx * dx + dy * dy AS len2 FROM d),
u AS (SELECT *, CASE WHEN len2 = 0 THEN 0.0 ELSE least(1.0, greatest(0.0, ((px - x1) * dx + (py - y1) * dy) / len2)) END AS tt
      FROM t),
v AS (SELECT plant_code, assembly, district,
             sqrt((px - (x1 + tt * dx)) * (px - (x1 + tt * dx)) + (py - (y1 + tt * dy)) * (py - (y1 + tt * dy))) AS dist FROM u),
near AS (SELECT plant_code, assembly, district FROM (
  SELECT *, row_number() OVER (PARTITION BY plant_code, assembly ORDER BY dist, district) AS rk FROM v) WHERE rk = 1)
SELECT plant_code, CAST(assembly AS INTEGER) AS assembly, district AS district_code, 'inside' AS match_method FROM ins1
UNION ALL SELECT plant_code, CAST(assembly AS INTEGER), district, 'nearest' FROM near"""


QUERIES["q_plant_districts"] = q_plant_districts
ORACLE["q_plant_districts"] = _sql_plant_districts()


# -- D13: state disposition sheets (marker rows, blocks of varying size) --------
# Row labels of the derived sheet, in sheet order (index 4 is not part of any block).
SHEET_ROWS = ["Net generation", "..Electric utilities", "..Independent producers", "..Combined heat and power",
              "Unrelated row", "Combined heat and power, commercial", "..Commercial heat",
              "Total net generation", "Total international imports", "Total international exports",
              "Net interstate trade"]


def disposition_sheet(spark: SparkSession, sf: str) -> DataFrame:
    """One sheet per supplier nation: row i holds the quantities shipped on
    line number (i mod 7) + 1, per year, as text; empty cells are NULL."""
    years = years_of(table(spark, sf, "lineitem"), "l_shipdate")
    li = table(spark, sf, "lineitem").select("l_suppkey", "l_linenumber", "l_quantity", F.year("l_shipdate").alias("y"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    j = li.join(s, "l_suppkey")
    sums = j.groupBy("s_nationkey", "l_linenumber").pivot("y", years).agg(F.sum("l_quantity").cast("long"))
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(SHEET_ROWS)], "idx int, category string")
    rows = rows.withColumn("l_linenumber", F.col("idx") % 7 + 1)
    sheet = F.broadcast(rows).join(sums, "l_linenumber")
    return sheet.select(F.concat(F.lit("State "), F.col("s_nationkey").cast("string")).alias("state_name"), "idx",
                        "category", *[F.col(str(y)).cast("string").alias(f"Year {y}") for y in years])


def q_disposition(spark: SparkSession, sf: str) -> DataFrame:
    from polidata.plans.pipelines.energy import state_disposition
    return state_disposition(disposition_sheet(spark, sf))


def _sql_disposition():
    labels = ", ".join(f"({i}, '{t}')" for i, t in enumerate(SHEET_ROWS))
    return f"""
WITH rows(idx, category) AS (VALUES {labels}),
keep AS (SELECT * FROM rows WHERE idx IN (1, 2, 3, 5, 6, 7, 8, 9, 10)),
li AS (SELECT s.s_nationkey, l.l_linenumber, CAST(year(l.l_shipdate) AS INTEGER) AS year, l.l_quantity
       FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey),
nat AS (SELECT DISTINCT s_nationkey, l_linenumber FROM li),
yrs AS (SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS year FROM lineitem WHERE l_shipdate IS NOT NULL),
sums AS (SELECT s_nationkey, l_linenumber, year, CAST(SUM(l_quantity) AS BIGINT) AS v FROM li GROUP BY ALL)
SELECT 'State ' || CAST(n.s_nationkey AS VARCHAR) AS state_name,
       trim(lower(replace(k.category, '..', ''))) AS category, CAST(y.year AS INTEGER) AS year,
       CAST(COALESCE(s.v, 0) AS DOUBLE) AS value, 'megawatthours' AS units
FROM keep k JOIN nat n ON n.l_linenumber = k.idx % 7 + 1 CROSS JOIN yrs y
LEFT JOIN sums s ON s.s_nationkey = n.s_nationkey AND s.l_linenumber = n.l_linenumber AND s.year = y.year
"""


QUERIES["q_disposition"] = q_disposition
ORACLE["q_disposition"] = _sql_disposition()


# -- D4: session calendars (fill-down assembly, increment session, text dates) --
def session_tables(spark: SparkSession, sf: str):
    """House and Senate session tables, one document per customer nation and
    one row per order year: session start / end are the first / last order
    date; the assembly label appears only on the first session, the House
    session number only on first sessions; the Senate marks 1998 as special
    session 'S', has a blank row and footnote digits after the end year."""
    o = table(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("d"))
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    per = o.join(c, "o_custkey").groupBy("c_nationkey", F.year("d").alias("y")).agg(
        F.min("d").alias("d0"), F.max("d").alias("d1"))
    first = F.col("y") % 2 == 1
    cong = F.floor((F.col("y") - 1787) / 2).cast("int")
    idx = (F.col("y") - 1995).cast("int")
    house = per.select(
        F.col("c_nationkey").alias("doc"), idx.alias("idx"),
        F.when(first, F.concat(cong.cast("string"), F.lit("th ("), F.col("y").cast("string"), F.lit("-"),
                               (F.col("y") + 1).cast("string"), F.lit(")"))).alias("assembly"),
        F.when(first, F.lit("1")).alias("session"),
        F.when(F.col("c_nationkey") % 2 == 0, F.date_format("d0", "MMMM d, yyyy"))
         .otherwise(F.date_format("d0", "MMM. d, yyyy")).alias("session_start"),
        F.date_format("d1", "MMM. d, yyyy").alias("session_end"))
    senate = per.select(
        (F.col("c_nationkey") + 100).alias("doc"), (idx * 2).alias("idx"),
        F.when(first, cong.cast("string")).alias("assembly"),
        F.when(F.col("y") == 1998, F.lit("S")).when(first, F.lit("1")).otherwise(F.lit("2")).alias("session"),
        F.date_format("d0", "MMM d, yyyy").alias("session_start"),
        F.concat(F.date_format("d1", "MMM d, yyyy"), F.when(F.col("y") == 1999, F.lit("2")).otherwise(F.lit("")))
         .alias("session_end"))
    blank = per.select((F.col("c_nationkey") + 100).alias("doc"), (idx * 2 + 1).alias("idx"),
                       F.lit(None).cast("string").alias("assembly"), F.lit("").alias("session"),
                       F.lit("").alias("session_start"), F.lit("").alias("session_end"))
    return house, senate.unionByName(blank)


def q_sessions(spark: SparkSession, sf: str) -> DataFrame:
    from polidata.plans.pipelines.legislature import session_calendar
    house, senate = session_tables(spark, sf)
    out = session_calendar(house, senate)
    return out.select("chamber", "assembly", "session", *[F.col(c).cast("string").alias(c) for c in
                                                         ("session_start", "session_end", "start_date", "end_date")])


SQL_SESSIONS = """
WITH per AS (SELECT c.c_nationkey, CAST(year(o.o_orderdate) AS INTEGER) AS y, MIN(CAST(o.o_orderdate AS DATE)) AS d0,
                    MAX(CAST(o.o_orderdate AS DATE)) AS d1
             FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY ALL),
h AS (SELECT 'House' AS chamber, CAST(floor((y - 1787) / 2) AS INTEGER) AS assembly,
             CASE WHEN y % 2 = 1 THEN 1 ELSE 2 END AS session, d0, d1 FROM per),
s AS (SELECT 'Senate' AS chamber, CAST(floor((y - 1787) / 2) AS INTEGER) AS assembly,
             CASE WHEN y = 1998 THEN 9 WHEN y % 2 = 1 THEN 1 ELSE 2 END AS session, d0, d1 FROM per),
a AS (SELECT * FROM h UNION ALL SELECT * FROM s)
SELECT chamber, assembly, session, CAST(d0 AS VARCHAR) AS session_start, CAST(d1 AS VARCHAR) AS session_end,
       CAST(MIN(d0) OVER (PARTITION BY chamber, assembly) AS VARCHAR) AS start_date,
       CAST(MAX(d1) OVER (PARTITION BY chamber, assembly) AS VARCHAR) AS end_date
FROM a
"""

QUERIES["q_sessions"] = q_sessions
ORACLE["q_sessions"] = SQL_SESSIONS


# -- D6: departure lists (reason headers with counts + list items) -------------
# Departure reason used for each market segment in the derived pages.
SEGMENT_REASONS = [("AUTOMOBILE", "Retired"), ("BUILDING", "Resigned"), ("FURNITURE", "Defeated in primary"),
                   ("HOUSEHOLD", "Running for Senate"), ("MACHINERY", "Died")]
PAGE_SIZE = 50


def departure_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Pages of at most 50 customers of one nation: per reason (segment) an
    h3 header 'Reason (n House; m Senate)' and, in the same order, list items
    'First Last (P-Nation k), age, n terms' - House members first."""
    from polidata.plans.q_match import people
    p = people(spark, sf)
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    lk = spark.createDataFrame(SEGMENT_REASONS, "c_mktsegment string, reason string")
    d = p.join(c, "c_custkey").join(F.broadcast(lk), "c_mktsegment")
    d = d.withColumns({"page": F.col("c_nationkey") * 1000 + F.floor(F.col("c_custkey") / PAGE_SIZE),
                       "senate": (F.col("c_custkey") % 3 == 0).cast("int")})
    item = F.concat(F.lit("<li>"), F.col("first"), F.lit(" "), F.col("last"), F.lit(" ("),
                    F.substring("c_mktsegment", 1, 1), F.lit("-Nation "), F.col("c_nationkey").cast("string"),
                    F.lit("), 50, 3 terms</li>"))
    items = d.groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct("reason", "senate", "c_custkey", item.alias("li")))), lambda s: s["li"]), "").alias("lis"))
    counts = d.groupBy("page", "reason").agg(F.sum(1 - F.col("senate")).alias("h"), F.sum("senate").alias("s"))
    hdr = F.concat(F.lit("<h3>"), F.col("reason"), F.lit(" ("), F.col("h").cast("string"), F.lit(" House; "),
                   F.col("s").cast("string"), F.lit(" Senate)</h3>"))
    heads = counts.groupBy("page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.struct("reason", hdr.alias("x")))), lambda s: s["x"]), "").alias("hs"))
    return heads.join(items, "page").select(F.col("page").alias("assembly"),
                                            F.concat("hs", F.lit("<ul><li>n/a</li>"), "lis", F.lit("</ul>")).alias("html"))


def q_departures(spark: SparkSession, sf: str) -> DataFrame:
    from polidata.plans.pipelines.legislature import departures_from_lists
    return departures_from_lists(departure_pages(spark, sf))


def _sql_departures():
    from polidata.plans.q_match import _names_sql
    head = _names_sql().split(",\ncands AS")[0]
    reasons = ", ".join(f"('{a}', '{b}')" for a, b in SEGMENT_REASONS)
    return f"""WITH {head},
lk(c_mktsegment, reason) AS (VALUES {reasons})
SELECT p.c_nationkey * 1000 + p.c_custkey // {PAGE_SIZE} AS assembly, p.first || ' ' || p.last AS name,
       substr(c.c_mktsegment, 1, 1) AS party, 'Nation ' || CAST(p.c_nationkey AS VARCHAR) AS state,
       lk.reason, CASE WHEN p.c_custkey % 3 = 0 THEN 'Senate' ELSE 'House' END AS chamber
FROM people p JOIN customer c ON c.c_custkey = p.c_custkey JOIN lk ON lk.c_mktsegment = c.c_mktsegment"""


QUERIES["q_departures"] = q_departures
ORACLE["q_departures"] = _sql_departures()


# -- D3: member table of the roll-call family (duplicates, 'USA' codes) --------
def q_voteview_members(spark: SparkSession, sf: str) -> DataFrame:
    from polidata.plans.pipelines.legislature import voteview
    c = table(spark, sf, "customer")
    k = F.col("c_custkey")
    m = c.select((F.col("c_nationkey") % 12 + 103).alias("assembly"),
                 F.when(k % 2 == 0, "House").otherwise("Senate").alias("chamber"), k.alias("icpsr"),
                 F.col("c_nationkey").alias("state_icpsr"),
                 F.when(k % 17 == 0, F.lit("USA")).otherwise(F.concat(F.lit("N"), F.col("c_nationkey").cast("string")))
                 .alias("state_abbrev"), (k % 9).alias("district_code"))
    # the yearly files repeat members: every 5th member appears twice
    m = m.unionByName(m.filter(k % 5 == 0))
    return voteview(m, m, m)["voteview_memb"]


SQL_VOTEVIEW_MEMBERS = """
SELECT DISTINCT c_nationkey % 12 + 103 AS assembly, CASE WHEN c_custkey % 2 = 0 THEN 'House' ELSE 'Senate' END AS chamber,
       c_custkey AS icpsr, c_nationkey AS icpsr_code,
       CASE WHEN c_custkey % 17 = 0 THEN 'US' ELSE 'N' || CAST(c_nationkey AS VARCHAR) END AS state_code,
       c_custkey % 9 AS district_code
FROM customer
"""

QUERIES["q_voteview_members"] = q_voteview_members
ORACLE["q_voteview_members"] = SQL_VOTEVIEW_MEMBERS


# -- D19: modelled CO2 per state and year against the published total ---------------------------
def _co2(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Line items as fuel use of five sources (some without a fuel code), suppliers as plants that may move between
    assemblies or have no place, nations as states and fuels, orders as the published totals."""
    from polidata.plans.pipelines.energy import co2_state_year
    li, s, n = table(spark, sf, "lineitem"), table(spark, sf, "supplier"), table(spark, sf, "nation")
    fuel = li.select((F.col("l_linenumber") % 5 + 1).cast("int").alias("src"), F.year("l_shipdate").alias("year"),
                     F.col("l_suppkey").alias("plant_id"),
                     F.when(F.col("l_partkey") % 11 > 0, F.concat(F.lit("F"), (F.col("l_partkey") % 7).cast("string"))).alias("esource"),
                     (F.col("l_quantity").cast("double") * 1e6).alias("con"))
    factors = n.filter(F.col("n_nationkey") < 6).select(
        F.concat(F.lit("F"), F.col("n_nationkey").cast("string")).alias("esource"),
        (F.col("n_nationkey") * 1.5 + 50).alias("kg_co2_per_mmbtu"), (F.col("n_nationkey") * 10 + 3).alias("kg_co2_per_unit"))
    moved = ((F.col("assembly") >= 104) & (F.col("s_suppkey") % 10 == 0)).cast("int")
    places = s.filter(F.col("s_suppkey") % 17 != 0).withColumn("assembly", F.explode(F.sequence(F.lit(102), F.lit(105)))).select(
        F.col("s_suppkey").alias("plant_id"), "assembly", ((F.col("s_nationkey") + moved) % 25).cast("int").alias("fips"))
    states = n.select(F.col("n_nationkey").cast("int").alias("fips"), F.when(F.col("n_nationkey") == 3, "ME").otherwise(
        F.concat(F.lit("S"), F.col("n_nationkey").cast("string"))).alias("state_code"), F.col("n_name").alias("state_name"))
    paid = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")) \
        .filter(F.col("c_nationkey") != 8).groupBy(F.year("o_orderdate").alias("year"), F.col("c_nationkey").alias("fips")).agg(
        (F.sum(F.col("o_totalprice").cast("double")) / 1e4).alias("value"))
    paid = paid.withColumn("value", F.when(F.col("fips") == 7, 0.0).otherwise(F.col("value"))).join(states.select("fips", "state_name"), "fips")
    sectors = paid.withColumn("k", F.explode(F.array(F.lit("electric power"), F.lit("industrial")))).select(
        "state_name", F.col("k").alias("sector"), F.lit("Total").alias("variable"), "year", "value")
    return co2_state_year(fuel, factors, places, states, sectors)


def q_co2_state_year(spark: SparkSession, sf: str) -> DataFrame:
    z = _co2(spark, sf)["co2_state_year"]
    return z.select("year", "state_code", F.round("co2", 6).alias("co2"), F.round("value", 6).alias("value"), F.round("r", 6).alias("r"))


def q_co2_ratios(spark: SparkSession, sf: str) -> DataFrame:
    box = _co2(spark, sf)["ratio_distribution"]
    figures = ["q1", "median", "q3", "whisker_lo", "whisker_hi"]
    return box.select("year", *[F.round(c, 6).alias(c) for c in figures], "n_outliers", "n")


_CO2_SQL = """WITH fuel AS (SELECT l_linenumber % 5 + 1 AS src, year(l_shipdate) AS year, l_suppkey AS plant_id,
    CASE WHEN l_partkey % 11 > 0 THEN concat('F', l_partkey % 7) END AS esource, CAST(l_quantity AS DOUBLE) * 1e6 AS con FROM lineitem),
e AS (SELECT year, plant_id, sum(coalesce(con * CASE WHEN src IN (2, 3) THEN n_nationkey * 10 + 3 ELSE n_nationkey * 1.5 + 50 END, 0)) AS co2
  FROM fuel LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 6) ON esource = concat('F', n_nationkey)
  WHERE src = 1 OR esource IS NOT NULL GROUP BY ALL),
x AS (SELECT year, (s_nationkey + CASE WHEN (year - 1787) // 2 >= 104 AND s_suppkey % 10 = 0 THEN 1 ELSE 0 END) % 25 AS fips, sum(co2) / 1e9 AS co2
  FROM e JOIN supplier ON s_suppkey = plant_id WHERE s_suppkey % 17 <> 0 AND (year - 1787) // 2 BETWEEN 102 AND 105 GROUP BY ALL),
paid AS (SELECT year(o_orderdate) AS year, c_nationkey AS fips,
    CASE WHEN c_nationkey = 7 THEN 0.0 ELSE sum(CAST(o_totalprice AS DOUBLE)) / 1e4 END AS value
  FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_nationkey <> 8 GROUP BY year(o_orderdate), c_nationkey),
z AS (SELECT x.year, CASE WHEN n_nationkey = 3 THEN 'ME' ELSE concat('S', n_nationkey) END AS state_code, co2, value, co2 / nullif(value, 0) AS r
  FROM x JOIN nation ON n_nationkey = x.fips LEFT JOIN paid ON paid.year = x.year AND paid.fips = x.fips)"""

SQL_CO2_STATE_YEAR = _CO2_SQL + " SELECT CAST(year AS INT) AS year, state_code, round(co2, 6) AS co2, round(value, 6) AS value, round(r, 6) AS r FROM z"

SQL_CO2_RATIOS = _CO2_SQL + """, q AS (SELECT year, quantile_cont(r, 0.25) AS q1, quantile_cont(r, 0.5) AS median, quantile_cont(r, 0.75) AS q3
  FROM z WHERE state_code <> 'ME' AND r IS NOT NULL GROUP BY year)
SELECT CAST(year AS INT) AS year, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(min(r) FILTER (r BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_lo,
  round(max(r) FILTER (r BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_hi,
  count(*) FILTER (NOT r BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS n_outliers, count(*) AS n
FROM z JOIN q USING (year) WHERE state_code <> 'ME' AND r IS NOT NULL GROUP BY year, q1, median, q3"""

QUERIES |= {"q_co2_state_year": q_co2_state_year, "q_co2_ratios": q_co2_ratios}
ORACLE |= {"q_co2_state_year": SQL_CO2_STATE_YEAR, "q_co2_ratios": SQL_CO2_RATIOS}


# -- D7 S13 S14 S15 P16 Q12: scorecard list and detail pages, recent votes, flagged twins --------
SCORES_URL = "http://scores.example/"


def q_scorecard(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer's orders as one list page: even keys first, then odd ones, each part from the latest year down; every
    fifth entry has no kind.  Orders of 1998 are also on a page of recent votes; status F and O have a detail page."""
    from polidata.plans.pipelines.legislature import scorecard, scorecard_votes
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_custkey").alias("page_id"),
                                          F.year("o_orderdate").alias("y"), "o_orderstatus", "o_orderpriority")
    href = F.concat(F.lit("roll-call-vote/"), F.col("y").cast("string"), F.lit("-"), F.col("k").cast("string"), F.lit("-vote"))

    def page(rows: DataFrame, order: list, kind_class: str, end: str, twice: int) -> DataFrame:
        entry = F.concat(
            F.lit('<li><a class="vote" href="'), href, F.lit('">Vote <b>'), F.col("k").cast("string"), F.lit("</b>"),
            F.when(F.col("k") % twice == 0, " 2x Score").otherwise(""), F.lit("</a>"),
            F.when(F.col("k") % 5 == 0, "").otherwise(F.concat(
                F.lit(f"<span class='{kind_class}'>"), F.col("o_orderpriority"), F.lit(f"{end}</span>"))), F.lit("</li>"))
        sorted_entries = F.array_sort(F.collect_list(F.struct(*order, entry.alias("e"))))
        return rows.groupBy("page_id").agg(F.concat(F.lit("<ul>"), F.array_join(F.transform(
            sorted_entries, lambda x: x["e"]), "\n"), F.lit("</ul>")).alias("html"))

    detail = o.filter(F.col("o_orderstatus") != "P").select(F.concat(F.lit(SCORES_URL), href).alias("url"), F.concat(
        F.lit("<div id='roll-call-vote-pro-env-choice'>\n\t"), F.when(F.col("o_orderstatus") == "F", "No").otherwise("Yes"),
        F.lit("</div>")).alias("html"))
    full = page(o, [(F.col("k") % 2).alias("part"), (-F.col("y")).alias("y"), "k"], "voteIssuesFULL", ",", 14)
    new = page(o.filter(F.col("y") == 1998), ["k"], "voteIssues", "", 7)
    scored = scorecard_votes(full, detail, SCORES_URL, drop_year=1992)
    recent = scorecard_votes(new, detail, SCORES_URL, kind_class="voteIssues", n_senate=2, drop_year=None)
    return scorecard(recent, scored).select("href", "rollnumber", "year", "lcv_type", "lcv_dscr", "lcv_vote", "lcv_note",
                                            "not_in_lcv", "double_count", "chamber", "assembly")


SQL_SCORECARD = f"""WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, year(o_orderdate) AS y, o_orderstatus AS st, o_orderpriority AS p FROM orders),
s AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY k % 2, y DESC, k) AS idx FROM o) WHERE y <> 1992),
top AS (SELECT c, idx, lag(idx) OVER (PARTITION BY c ORDER BY idx) AS pv FROM (SELECT *, max(y) OVER (PARTITION BY c) AS ly FROM s) WHERE y = ly),
cut AS (SELECT c, min(idx) AS cut FROM top WHERE idx > pv + 1 GROUP BY c),
r AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY k) AS idx FROM o WHERE y = 1998),
u AS (SELECT k, y, st, p, k % 14 = 0 AS twice, CASE WHEN cut IS NULL OR idx < cut THEN 'Senate' ELSE 'House' END AS chamber FROM s LEFT JOIN cut USING (c)
  UNION ALL SELECT k, y, st, p, k % 7 = 0, CASE WHEN idx <= 2 THEN 'Senate' ELSE 'House' END FROM r),
v AS (SELECT *, bool_or(twice) OVER (PARTITION BY y, k, chamber) AS any_twice FROM u)
SELECT concat('{SCORES_URL}roll-call-vote/', y, '-', k, '-vote') AS href, CAST(k AS DOUBLE) AS rollnumber, CAST(y AS DOUBLE) AS year,
  CASE WHEN k % 5 <> 0 THEN p END AS lcv_type, concat('Vote ', k, CASE WHEN twice THEN ' 2x Score' ELSE '' END) AS lcv_dscr,
  CASE WHEN st = 'F' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS lcv_vote, 'scorecard' AS lcv_note, 0.0::DOUBLE AS not_in_lcv,
  CASE WHEN twice THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS double_count, chamber, CAST((y - 1787) // 2 AS DOUBLE) AS assembly
FROM v WHERE twice OR NOT any_twice"""

QUERIES |= {"q_scorecard": q_scorecard}
ORACLE |= {"q_scorecard": SQL_SCORECARD}
