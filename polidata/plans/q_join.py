"""Catalogue: joins and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polidata.functions.columns import ensure_columns
from polidata.operators import joins as J
from polidata.operators import shape as S
from polidata.plans.tables import table


# -- J8 P4: full outer join of two hourly count series -----------------------
def q_full_outer(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_type", F.to_date("ts").alias("day"), F.hour("ts").alias("hour"))

    def counts(t):
        return e.filter(F.col("event_type") == t).groupBy("day", "hour").agg(F.count(F.lit(1)).alias(f"n_{t}"))

    both = counts("purchase").join(counts("signup"), ["day", "hour"], "full")
    return both.select(F.col("day").cast("string").alias("day"), "hour", "n_purchase", "n_signup")


SQL_FULL_OUTER = """
WITH e AS (SELECT event_type, CAST(ts AS DATE) AS day, CAST(hour(ts) AS INTEGER) AS hour FROM events),
p AS (SELECT day, hour, COUNT(*) AS n_purchase FROM e WHERE event_type = 'purchase' GROUP BY ALL),
s AS (SELECT day, hour, COUNT(*) AS n_signup FROM e WHERE event_type = 'signup' GROUP BY ALL)
SELECT CAST(COALESCE(p.day, s.day) AS VARCHAR) AS day, COALESCE(p.hour, s.hour) AS hour, n_purchase, n_signup
FROM p FULL OUTER JOIN s ON p.day = s.day AND p.hour = s.hour
"""


# -- J9 J10 Q2 Q6 F7: customers with / without orders in a year --------------
SEGMENTS = ["AUTOMOBILE", "BUILDING", "MACHINERY"]


def q_semi_anti(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").filter(F.col("c_mktsegment").isin(*SEGMENTS)) \
        .select("c_custkey", "c_mktsegment")
    o98 = table(spark, sf, "orders").filter(F.year("o_orderdate") == 1998).select(F.col("o_custkey").alias("c_custkey"))
    with_ = c.join(o98, "c_custkey", "left_semi").withColumn("has_orders", F.lit(True))
    without = c.join(o98, "c_custkey", "left_anti").withColumn("has_orders", F.lit(False))
    return with_.unionByName(without)


SQL_SEMI_ANTI = """
SELECT c_custkey, c_mktsegment,
  EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND year(o.o_orderdate) = 1998) AS has_orders
FROM customer c WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY')
"""


# -- J11: equi + band join (same nation, order year within +-2 of ship year) --
def q_band_join(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    c = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    left = o.join(c, o.o_custkey == c.c_custkey).select(
        "c_custkey", "c_nationkey", F.year("o_orderdate").alias("y")).distinct()
    li = table(spark, sf, "lineitem")
    s = table(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("c_nationkey"))
    right = li.join(s, li.l_suppkey == s.s_suppkey).groupBy("c_nationkey", F.year("l_shipdate").alias("ship_year")) \
        .agg(F.count(F.lit(1)).alias("n_ship"))
    j = J.band_join(left, right, ["c_nationkey"], "y", "ship_year", 2)
    return j.groupBy("c_custkey", "y").agg(F.count(F.lit(1)).alias("n_years"), F.sum("n_ship").alias("n_ship"))


SQL_BAND_JOIN = """
WITH l AS (SELECT DISTINCT c_custkey, c_nationkey, CAST(year(o_orderdate) AS INTEGER) AS y
           FROM orders JOIN customer ON o_custkey = c_custkey),
r AS (SELECT s_nationkey AS c_nationkey, CAST(year(l_shipdate) AS INTEGER) AS ship_year, COUNT(*) AS n_ship
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL)
SELECT c_custkey, y, COUNT(*) AS n_years, CAST(SUM(n_ship) AS BIGINT) AS n_ship
FROM l JOIN r ON l.c_nationkey = r.c_nationkey AND r.ship_year BETWEEN l.y - 2 AND l.y + 2
GROUP BY ALL
"""


# -- J3 / NULL keys: data-frame join semantics (NULL matches NULL) ------------
def q_nullsafe_join(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select(
        "c_custkey", "c_acctbal",
        F.when(F.col("c_custkey") % 5 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("seg"))
    stats = c.groupBy("seg").agg(F.count(F.lit(1)).alias("seg_n"), F.round(F.avg("c_acctbal"), 6).alias("seg_avgbal"))
    return J.null_safe_join(c.select("c_custkey", "seg"), stats, ["seg"], "left")


SQL_NULLSAFE_JOIN = """
WITH c AS (SELECT c_custkey, c_acctbal, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_mktsegment END AS seg FROM customer),
s AS (SELECT seg, COUNT(*) AS seg_n, round(AVG(c_acctbal), 6) AS seg_avgbal FROM c GROUP BY seg)
SELECT c.c_custkey, c.seg, s.seg_n, s.seg_avgbal FROM c LEFT JOIN s ON c.seg IS NOT DISTINCT FROM s.seg
"""


# -- J2 J5 J7 P3: inner merges on differently named keys ---------------------
def q_inner_merge(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    # nation (25 rows) and region (5 rows) have a fixed size at every scale
    n = F.broadcast(table(spark, sf, "nation"))
    r = F.broadcast(table(spark, sf, "region"))
    nr = n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner").join(nr, F.col("c_nationkey") == nr.n_nationkey, "inner")
    return j.select("o_orderkey", "c_name", "n_name", "r_name").withColumnsRenamed({"c_name": "customer_name"})


SQL_INNER_MERGE = """
SELECT o_orderkey, c_name AS customer_name, n_name, r_name FROM orders
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
"""


# -- J13 A16: exact lookup recode; the sorted set of unmatched values --------
PRIORITY_CODES = [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("5-LOW", 5)]


def q_lookup_recode(spark: SparkSession, sf: str) -> DataFrame:
    lk = J.inline_table(spark, PRIORITY_CODES, "o_orderpriority string, prio_code int")
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return J.lookup(o, lk, "o_orderpriority")


SQL_LOOKUP_RECODE = """
SELECT o_orderkey, o_orderpriority, prio_code FROM orders LEFT JOIN
(VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3), ('5-LOW', 5)) AS lk(o_orderpriority, prio_code)
USING (o_orderpriority)
"""


def q_unmatched_values(spark: SparkSession, sf: str) -> DataFrame:
    lk = J.inline_table(spark, PRIORITY_CODES, "o_orderpriority string, prio_code int")
    o = table(spark, sf, "orders").select("o_orderpriority")
    return o.join(lk, "o_orderpriority", "left_anti").distinct().orderBy("o_orderpriority")


SQL_UNMATCHED_VALUES = """
SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority NOT IN
 ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') ORDER BY 1
"""


# -- J15 F8 E6: corrections as data, exclusion pairs ------------------------
CORRECTIONS = [(3, "X", None, False), (10, None, 1.0, False), (42, "X", 99.5, False), (77, None, None, True)]


def q_corrections(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    rules = spark.createDataFrame(CORRECTIONS, "o_orderkey long, status string, price double, null_price boolean")
    st = rules.filter(F.col("status").isNotNull()).select("o_orderkey", F.col("status").alias("new_value"))
    pr = rules.filter(F.col("price").isNotNull() | F.col("null_price")).select(
        "o_orderkey", F.col("price").alias("new_value"), F.col("null_price").alias("set_null"))
    o = J.apply_corrections(o, st, ["o_orderkey"], "o_orderstatus")
    o = J.apply_corrections(o, pr, ["o_orderkey"], "o_totalprice")
    # disjunctive exclusion: drop 'P' orders of priority 5-LOW (id != X | votes != Y)
    o = o.filter((F.col("o_orderstatus") != "P") | (F.col("o_orderpriority") != "5-LOW"))
    return o.select("o_orderkey", "o_orderstatus", "o_totalprice")


SQL_CORRECTIONS = """
WITH r(o_orderkey, status, price, null_price) AS (VALUES
  (3, 'X', NULL, false), (10, NULL, 1.0, false), (42, 'X', 99.5, false), (77, NULL, NULL, true)),
o AS (SELECT o.o_orderkey, COALESCE(r.status, o.o_orderstatus) AS o_orderstatus, o.o_orderpriority,
        CASE WHEN r.null_price THEN NULL ELSE COALESCE(r.price, o.o_totalprice) END AS o_totalprice
      FROM orders o LEFT JOIN r ON o.o_orderkey = r.o_orderkey)
SELECT o_orderkey, o_orderstatus, o_totalprice FROM o WHERE o_orderstatus <> 'P' OR o_orderpriority <> '5-LOW'
"""


# -- U1 U2 U3 U7 P12: unions with differing columns --------------------------
CANON = T.StructType([T.StructField("key", T.LongType()), T.StructField("name", T.StringType()),
                      T.StructField("nation", T.IntegerType()), T.StructField("acctbal", T.DoubleType()),
                      T.StructField("segment", T.StringType()), T.StructField("source", T.StringType())])


def q_union_fill(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").toDF("key", "name", "nation", "acctbal").withColumn("source", F.lit("supplier"))
    c = table(spark, sf, "customer").toDF("key", "name", "nation", "acctbal", "segment") \
        .withColumn("source", F.lit("customer"))
    return ensure_columns(S.union_fill([s, c]), CANON)


SQL_UNION_FILL = """
SELECT s_suppkey AS key, s_name AS name, s_nationkey AS nation, s_acctbal AS acctbal,
       CAST(NULL AS VARCHAR) AS segment, 'supplier' AS source FROM supplier
UNION ALL
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, 'customer' FROM customer
"""


def q_union_pos(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier")
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    return S.union_by_position([s, c])


SQL_UNION_POS = """
SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
UNION ALL SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer
"""


# -- U4 U5 U6: (a minus b) union c --------------------------------------------
def q_setops(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("y"))

    def keys(y):
        return o.filter(F.col("y") == y).select("o_custkey")

    return keys(1996).subtract(keys(1997)).union(keys(2000)).distinct()


SQL_SETOPS = """
(SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1996
 EXCEPT SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1997)
UNION SELECT o_custkey FROM orders WHERE year(o_orderdate) = 2000
"""


QUERIES = {"q_full_outer": q_full_outer, "q_semi_anti": q_semi_anti, "q_band_join": q_band_join,
           "q_nullsafe_join": q_nullsafe_join, "q_inner_merge": q_inner_merge,
           "q_lookup_recode": q_lookup_recode, "q_unmatched_values": q_unmatched_values,
           "q_corrections": q_corrections, "q_union_fill": q_union_fill, "q_union_pos": q_union_pos,
           "q_setops": q_setops}
ORACLE = {"q_full_outer": SQL_FULL_OUTER, "q_semi_anti": SQL_SEMI_ANTI, "q_band_join": SQL_BAND_JOIN,
          "q_nullsafe_join": SQL_NULLSAFE_JOIN, "q_inner_merge": SQL_INNER_MERGE,
          "q_lookup_recode": SQL_LOOKUP_RECODE, "q_unmatched_values": SQL_UNMATCHED_VALUES,
          "q_corrections": SQL_CORRECTIONS, "q_union_fill": SQL_UNION_FILL, "q_union_pos": SQL_UNION_POS,
          "q_setops": SQL_SETOPS}


# -- S19 F7 A7: SQL text over temporary views ---------------------------------
def q_sql_text(spark: SparkSession, sf: str) -> DataFrame:
    """The SQL-text style of the reference (``dbGetQuery``): register views,
    run DISTINCT / NOT IN / LEFT JOIN in Spark SQL - same Catalyst plan as the
    DataFrame API."""
    table(spark, sf, "customer").createOrReplaceTempView("pd_customer")
    table(spark, sf, "nation").createOrReplaceTempView("pd_nation")
    return spark.sql("""
        SELECT DISTINCT c.c_nationkey, n.n_name, c.c_mktsegment
        FROM pd_customer c LEFT JOIN pd_nation n ON c.c_nationkey = n.n_nationkey
        WHERE c.c_mktsegment NOT IN ('AUTOMOBILE', 'HOUSEHOLD') AND c.c_acctbal IS NOT NULL""")


SQL_SQL_TEXT = """
SELECT DISTINCT c.c_nationkey, n.n_name, c.c_mktsegment
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE c.c_mktsegment NOT IN ('AUTOMOBILE', 'HOUSEHOLD') AND c.c_acctbal IS NOT NULL"""

QUERIES["q_sql_text"] = q_sql_text
ORACLE["q_sql_text"] = SQL_SQL_TEXT


# -- U6: set equality as a difference report --------------------------------
def q_set_equality(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("y"))
    a = o.filter(F.col("y") == 1996).select("o_custkey").distinct()
    b = o.filter(F.col("y") == 1997).select("o_custkey").distinct()
    return S.set_differences(a, b)


SQL_SET_EQUALITY = """
WITH a AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 1996),
b AS (SELECT DISTINCT o_custkey FROM orders WHERE year(o_orderdate) = 1997)
SELECT o_custkey, 'left_only' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL SELECT o_custkey, 'right_only' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)"""

QUERIES["q_set_equality"] = q_set_equality
ORACLE["q_set_equality"] = SQL_SET_EQUALITY
