"""Catalogue: reshaping and aggregation queries over the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polidata.functions.nullsafe import row_sum, strict_avg, strict_sum, sum_na_zero
from polidata.operators import aggregates as A
from polidata.operators import shape as S
from polidata.operators import windows as W
from polidata.plans.tables import table, years_of

# -- R1 R2 R3 A5 A12: wide by ship year, back to long -------------------------
def q_unpivot_years(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    years = years_of(li, "l_shipdate")
    wide = li.select("l_returnflag", F.year("l_shipdate").alias("y"), "l_quantity") \
        .groupBy("l_returnflag").pivot("y", years).agg(F.sum("l_quantity"))
    ycols = [f"y{y}" for y in years]
    wide = wide.toDF("l_returnflag", *ycols).withColumn("total_qty", row_sum(*ycols, na_rm=True))
    long = S.unpivot(wide, ["l_returnflag", "total_qty"], ycols, "header", "qty")
    return long.select("l_returnflag", F.regexp_substr("header", F.lit(r"\d{4}")).cast("int").alias("year"),
                       "qty", "total_qty")


SQL_UNPIVOT_YEARS = """
WITH li AS (SELECT l_returnflag, CAST(year(l_shipdate) AS INTEGER) AS year, l_quantity FROM lineitem WHERE l_shipdate IS NOT NULL),
yrs AS (SELECT DISTINCT year FROM li), flags AS (SELECT DISTINCT l_returnflag FROM lineitem),
sums AS (SELECT l_returnflag, year, SUM(l_quantity) AS qty FROM li GROUP BY ALL),
total AS (SELECT l_returnflag, SUM(l_quantity) AS total_qty FROM li GROUP BY ALL)
SELECT f.l_returnflag, y.year, s.qty, COALESCE(t.total_qty, 0) AS total_qty
FROM flags f CROSS JOIN yrs y LEFT JOIN sums s ON s.l_returnflag IS NOT DISTINCT FROM f.l_returnflag AND s.year = y.year
LEFT JOIN total t ON t.l_returnflag IS NOT DISTINCT FROM f.l_returnflag
"""


# -- R4 P4: three repeated column groups -> one row per group -----------------
def _party_wide(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(
        "o_orderkey",
        F.concat(F.lit("Cust#"), F.col("o_custkey").cast("string")).alias("DemCandidate"),
        F.col("o_orderstatus").alias("DemStatus"), F.col("o_totalprice").alias("DemVotes"),
        F.col("o_orderpriority").alias("RepCandidate"),
        F.when(F.col("o_orderstatus") == "F", "Incumbent").otherwise("Challenger").alias("RepStatus"),
        (F.col("o_totalprice") - 1000).alias("RepVotes"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(None)).otherwise(F.lit("Other")).alias("ThirdCandidate"),
        F.lit(None).cast("string").alias("ThirdStatus"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit(None)).otherwise(F.col("o_totalprice") / 4).alias("ThirdVotes"))


def q_stack_parties(spark: SparkSession, sf: str) -> DataFrame:
    wide = _party_wide(spark, sf)
    groups = {p: {"name": f"{p}Candidate", "status": f"{p}Status", "votes": f"{p}Votes"}
              for p in ("Dem", "Rep", "Third")}
    long = S.stack_groups(wide, ["o_orderkey"], groups, label="party")
    long = long.toDF("o_orderkey", "party", "party_order", "name", "status", "votes")
    return long.withColumn("votes", F.round("votes", 4))


SQL_STACK = """
WITH w AS (SELECT o_orderkey, 'Cust#' || CAST(o_custkey AS VARCHAR) AS dn, o_orderstatus AS ds, o_totalprice AS dv,
  o_orderpriority AS rn, CASE WHEN o_orderstatus = 'F' THEN 'Incumbent' ELSE 'Challenger' END AS rs,
  o_totalprice - 1000 AS rv,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'Other' END AS tn, CAST(NULL AS VARCHAR) AS ts,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice / 4 END AS tv FROM orders)
SELECT o_orderkey, 'Dem' AS party, 1 AS party_order, dn AS name, ds AS status, round(dv, 4) AS votes FROM w
UNION ALL SELECT o_orderkey, 'Rep', 2, rn, rs, round(rv, 4) FROM w
UNION ALL SELECT o_orderkey, 'Third', 3, tn, ts, round(tv, 4) FROM w
"""


# -- W2 W3 J4 J6 X14 R7: top two per customer and the margin ------------------
def q_rank_top2_margin(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    tot = o.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("_tot"), F.count(F.lit(1)).alias("n_orders"))
    top = A.top2(o, ["o_custkey"], "o_totalprice", "o_orderkey", ["o_orderkey", "o_totalprice"])
    out = top.join(tot, "o_custkey").withColumns({
        f"pct_{k}": 100 * F.col(f"o_totalprice_{k}") / F.col("_tot") for k in (1, 2)})
    return out.select("o_custkey", "n_orders", F.col("o_orderkey_1").alias("key_1"),
                      F.col("o_orderkey_2").alias("key_2"),
                      F.round("pct_1", 9).alias("pct_1"), F.round("pct_2", 9).alias("pct_2"),
                      F.round(F.coalesce((F.col("pct_1") - F.col("pct_2")) / 100, F.lit(1.0)), 9).alias("margin"))


SQL_TOP2 = """
WITH o AS (SELECT *, 100 * o_totalprice / SUM(o_totalprice) OVER (PARTITION BY o_custkey) AS pct,
                  COUNT(*) OVER (PARTITION BY o_custkey) AS n_orders,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) AS rk
           FROM orders),
r1 AS (SELECT * FROM o WHERE rk = 1), r2 AS (SELECT * FROM o WHERE rk = 2)
SELECT r1.o_custkey, r1.n_orders, r1.o_orderkey AS key_1, r2.o_orderkey AS key_2,
       round(r1.pct, 9) AS pct_1, round(r2.pct, 9) AS pct_2,
       round(COALESCE((r1.pct - r2.pct) / 100, 1.0), 9) AS margin
FROM r1 LEFT JOIN r2 ON r1.o_custkey = r2.o_custkey
"""


# -- A1 S3 F3: strict mean (NULL if any NULL) ---------------------------------
def _events_with_nulls(spark, sf):
    e = table(spark, sf, "events")
    v = F.when((F.col("user_id") % 7 == 0) & (F.col("event_id") % 50 == 0), F.lit(None)) \
         .otherwise(F.col("value"))
    return e.withColumn("value", v)


def q_strict_mean(spark: SparkSession, sf: str) -> DataFrame:
    e = _events_with_nulls(spark, sf)
    # value arrives as text with a unit; strip non-numeric characters (S3)
    e = e.withColumn("value_txt", F.concat(F.lit("USD "), F.format_number("value", 2)))
    e = e.withColumn("v", F.regexp_replace("value_txt", r"[^0-9.\-]", "").try_cast("double"))
    e = e.filter(F.substring("event_type", 1, 4) != "sign")                      # F3
    return e.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(strict_avg("v"), 9).alias("mean_strict"),
        F.round(F.avg("v"), 9).alias("mean_skip"))


SQL_STRICT_MEAN = """
WITH e AS (SELECT user_id, event_type,
  CASE WHEN user_id % 7 = 0 AND event_id % 50 = 0 THEN NULL ELSE round(value, 2) END AS v FROM events)
SELECT user_id, COUNT(*) AS n,
  round(CASE WHEN COUNT(*) = COUNT(v) THEN AVG(v) END, 9) AS mean_strict,
  round(AVG(v), 9) AS mean_skip
FROM e WHERE substr(event_type, 1, 4) <> 'sign' GROUP BY user_id
"""


# -- A3: sum with NA as zero; strict sum for contrast ---------------------------
def q_sum_null_zero(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    e = e.withColumn("value", F.when((F.col("event_type") == "error") & (F.col("user_id") % 7 == 0), F.lit(None))
                     .otherwise(F.col("value")))
    return e.groupBy("user_id", "event_type").agg(
        F.round(sum_na_zero("value"), 4).alias("total"),
        F.round(strict_sum("value"), 4).alias("total_strict"))


SQL_SUM_NULL_ZERO = """
WITH e AS (SELECT user_id, event_type,
  CASE WHEN event_type = 'error' AND user_id % 7 = 0 THEN NULL ELSE value END AS value FROM events)
SELECT user_id, event_type, round(COALESCE(SUM(value), 0), 4) AS total,
  round(CASE WHEN COUNT(*) = COUNT(value) THEN SUM(value) END, 4) AS total_strict
FROM e GROUP BY ALL
"""


# -- W1 F9: group extremes on every row; rows of the latest day ---------------
def q_group_extremes(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", F.to_date("ts").alias("day"))
    e = W.group_extremes(e, ["user_id"], "ts", "first_ts", "last_ts")
    e = W.keep_group_max(e, ["user_id"], "day")
    return e.select("event_id", "user_id", F.col("day").cast("string").alias("day"),
                    F.col("first_ts").cast("string").alias("first_ts"),
                    F.col("last_ts").cast("string").alias("last_ts"))


SQL_GROUP_EXTREMES = """
WITH e AS (SELECT event_id, user_id, ts, CAST(ts AS DATE) AS day,
  MIN(ts) OVER (PARTITION BY user_id) AS first_ts, MAX(ts) OVER (PARTITION BY user_id) AS last_ts,
  MAX(CAST(ts AS DATE)) OVER (PARTITION BY user_id) AS max_day FROM events)
SELECT event_id, user_id, CAST(day AS VARCHAR) AS day, CAST(first_ts AS VARCHAR) AS first_ts,
       CAST(last_ts AS VARCHAR) AS last_ts
FROM e WHERE day = max_day
"""


# -- A9 Q3: contingency table ------------------------------------------------
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def q_crosstab(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    ct = A.crosstab(o, "o_orderstatus", "o_orderpriority", PRIORITIES)
    ct = ct.toDF("o_orderstatus", *[f"p{p[0]}" for p in PRIORITIES])
    totals = o.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_total"))   # unlisted priorities count too
    return ct.join(totals, "o_orderstatus")


SQL_CROSSTAB = "SELECT o_orderstatus, " + ", ".join(
    f"COUNT(*) FILTER (WHERE o_orderpriority = '{p}') AS p{p[0]}" for p in PRIORITIES) + \
    ", COUNT(*) AS n_total FROM orders GROUP BY o_orderstatus"


# -- A10 A13: ordered collapse of values; one value when all equal ------------
def q_listagg(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").alias("y"), "o_orderstatus")
    years = A.collapse(o.select("o_custkey", "y").distinct(), ["o_custkey"], "y", out="years")
    st = o.select("o_custkey", "o_orderstatus").distinct().groupBy("o_custkey").agg(
        A.collapse_repeated(F.array_sort(F.collect_list("o_orderstatus"))).alias("statuses"))
    return years.join(st, "o_custkey")


SQL_LISTAGG = """
WITH y AS (SELECT DISTINCT o_custkey, year(o_orderdate) AS y FROM orders),
s AS (SELECT DISTINCT o_custkey, o_orderstatus FROM orders)
SELECT ya.o_custkey, ya.years, sa.statuses FROM
 (SELECT o_custkey, string_agg(CAST(y AS VARCHAR), ',' ORDER BY y) AS years FROM y GROUP BY o_custkey) ya
 JOIN (SELECT o_custkey, string_agg(o_orderstatus, ',' ORDER BY o_orderstatus) AS statuses FROM s GROUP BY o_custkey) sa
 USING (o_custkey)
"""


# -- A6 A7 A8 E5: names with several ids (a NULL id counts as a value) --------
def q_distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select(
        "p_name", F.when(F.col("p_partkey") % 10 == 0, F.lit(None)).otherwise(F.col("p_partkey")).alias("pid"))
    ids = p.select("p_name", "pid").distinct().groupBy("p_name").agg(F.count(F.lit(1)).alias("n_ids"))
    rows = p.groupBy("p_name").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("pid").alias("n_ids_nonnull"))
    return ids.join(rows, "p_name").filter(F.col("n_ids") > 1)


SQL_DISTINCT_COUNTS = """
WITH p AS (SELECT p_name, CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_partkey END AS pid FROM part)
SELECT i.p_name, i.n_ids, r.n_rows, r.n_ids_nonnull FROM
 (SELECT p_name, COUNT(*) AS n_ids FROM (SELECT DISTINCT p_name, pid FROM p) GROUP BY p_name) i
 JOIN (SELECT p_name, COUNT(*) AS n_rows, COUNT(DISTINCT pid) AS n_ids_nonnull FROM p GROUP BY p_name) r
 USING (p_name) WHERE i.n_ids > 1
"""


# -- A11: means of several columns over a wide key ---------------------------
def q_wide_means(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    return p.groupBy("p_brand", "p_type", "p_size").agg(
        F.round(F.avg("p_retailprice"), 9).alias("avg_price"), F.round(F.avg("p_partkey"), 9).alias("avg_key"),
        F.count(F.lit(1)).alias("n"))


SQL_WIDE_MEANS = """
SELECT p_brand, p_type, p_size, round(AVG(p_retailprice), 9) AS avg_price, round(AVG(p_partkey), 9) AS avg_key,
       COUNT(*) AS n FROM part GROUP BY ALL
"""


# -- A15: box-plot statistics per year (exact quantiles, distributed) --------
def q_boxplot(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year"), "o_totalprice")
    b = A.box_stats(o, ["year"], "o_totalprice")
    return b.select("year", *[F.round(c, 6).alias(c) for c in
                              ("q1", "median", "q3", "whisker_lo", "whisker_hi")], "n_outliers", "n")


SQL_BOXPLOT = """
WITH o AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_totalprice AS x FROM orders),
q AS (SELECT year, quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.5) AS median, quantile_cont(x, 0.75) AS q3
      FROM o GROUP BY year)
SELECT q.year, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(MIN(x) FILTER (WHERE x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_lo,
  round(MAX(x) FILTER (WHERE x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_hi,
  COUNT(*) FILTER (WHERE NOT (x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1))) AS n_outliers,
  COUNT(*) AS n
FROM o JOIN q USING (year) GROUP BY q.year, q1, median, q3
"""


# -- A14 O3: arg-min and largest with explicit tie keys ----------------------
def q_argmin(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    return A.arg_min(li, ["l_orderkey"], "l_linenumber", "l_extendedprice", ["l_linenumber"],
                     out="cheapest_line").withColumnRenamed("min_l_extendedprice", "min_price")


SQL_ARGMIN = """
SELECT l_orderkey, l_linenumber AS cheapest_line, l_extendedprice AS min_price FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice, l_linenumber) AS rk FROM lineitem)
WHERE rk = 1
"""


def q_largest(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").withColumns({"neg_line": -F.col("l_linenumber"),
                                                   "neg_part": -F.col("l_partkey")})
    out = A.largest(li, ["l_orderkey"], "l_partkey", "l_quantity", ["neg_line", "neg_part"])
    return out.withColumnRenamed("l_partkey", "largest_part").withColumnRenamed("max_l_quantity", "max_qty")


SQL_LARGEST = """
SELECT l_orderkey, l_partkey AS largest_part, l_quantity AS max_qty FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_linenumber, l_partkey) AS rk FROM lineitem)
WHERE rk = 1
"""


QUERIES = {
    "q_unpivot_years": q_unpivot_years, "q_stack_parties": q_stack_parties,
    "q_rank_top2_margin": q_rank_top2_margin, "q_strict_mean": q_strict_mean,
    "q_sum_null_zero": q_sum_null_zero, "q_group_extremes": q_group_extremes,
    "q_crosstab": q_crosstab, "q_listagg": q_listagg, "q_distinct_counts": q_distinct_counts,
    "q_wide_means": q_wide_means, "q_boxplot": q_boxplot, "q_argmin": q_argmin, "q_largest": q_largest,
}
ORACLE = {
    "q_unpivot_years": SQL_UNPIVOT_YEARS, "q_stack_parties": SQL_STACK, "q_rank_top2_margin": SQL_TOP2,
    "q_strict_mean": SQL_STRICT_MEAN, "q_sum_null_zero": SQL_SUM_NULL_ZERO,
    "q_group_extremes": SQL_GROUP_EXTREMES, "q_crosstab": SQL_CROSSTAB, "q_listagg": SQL_LISTAGG,
    "q_distinct_counts": SQL_DISTINCT_COUNTS, "q_wide_means": SQL_WIDE_MEANS, "q_boxplot": SQL_BOXPLOT,
    "q_argmin": SQL_ARGMIN, "q_largest": SQL_LARGEST,
}
