"""Catalogue: data-quality reports (each returns the violating rows)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polidata.operators import quality as Q
from polidata.plans.q_match import people
from polidata.plans.tables import table


# -- Q1: primary-key violations -------------------------------------------
def q_key_violations(spark: SparkSession, sf: str) -> DataFrame:
    return Q.key_violations(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


SQL_KEY_VIOLATIONS = """SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1"""


# -- Q2 Q6: references without a parent -----------------------------------
def q_orphans(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    parts = table(spark, sf, "part").filter(F.col("p_size") > 5).select(F.col("p_partkey").alias("l_partkey"))
    return Q.orphans(li, parts, ["l_partkey"])


SQL_ORPHANS = """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_size > 5 AND p_partkey = l_partkey)"""


# -- Q4: rule assertions as violation counts --------------------------------
def q_rule_violations(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    return Q.rule_violations(o, {
        "price_positive": F.col("o_totalprice") > 0,
        "price_below_400k": F.col("o_totalprice") < 400000,
        "status_known": F.col("o_orderstatus").isin("F", "O"),
        "priority_present": F.col("o_orderpriority").isNotNull()})


SQL_RULE_VIOLATIONS = """
SELECT 'price_positive' AS rule, COUNT(*) FILTER (WHERE NOT COALESCE(o_totalprice > 0, false)) AS n_failed FROM orders
UNION ALL SELECT 'price_below_400k', COUNT(*) FILTER (WHERE NOT COALESCE(o_totalprice < 400000, false)) FROM orders
UNION ALL SELECT 'status_known', COUNT(*) FILTER (WHERE NOT COALESCE(o_orderstatus IN ('F', 'O'), false)) FROM orders
UNION ALL SELECT 'priority_present', COUNT(*) FILTER (WHERE o_orderpriority IS NULL) FROM orders"""


# -- Q5: keep going - rows that fail to parse go to a quarantine frame -----
def q_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", F.get_json_object("props", "$.k").alias("k_txt"))
    e = e.withColumn("k_txt", F.when(F.col("event_id") % 41 == 0, F.concat(F.col("k_txt"), F.lit("x")))
                     .otherwise(F.col("k_txt")))
    _, bad = Q.split_castable(e, "k_txt", "int")
    return bad


SQL_QUARANTINE = """
WITH e AS (SELECT event_id, CASE WHEN event_id % 41 = 0 THEN json_extract_string(props, '$.k') || 'x'
  ELSE json_extract_string(props, '$.k') END AS k_txt FROM events)
SELECT event_id, k_txt FROM e WHERE k_txt IS NOT NULL AND TRY_CAST(k_txt AS INTEGER) IS NULL"""


# -- Q7: contradictions (two incumbents in one race) ------------------------
def q_two_incumbents(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").withColumn("year", F.year("o_orderdate"))
    inc = (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    return Q.contradictions(o, ["o_custkey", "year"], inc)


SQL_TWO_INCUMBENTS = """
SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year,
  COUNT(*) FILTER (WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT') AS n
FROM orders GROUP BY ALL HAVING n > 1"""


# -- Q9 A12: percentages of a race that do not add up to 100 ---------------
def q_low_percent(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    w = li.groupBy("l_orderkey").pivot("l_returnflag", ["A", "N", "R"]).agg(F.sum("l_quantity").cast("long"))
    w = w.fillna(0, ["A", "N", "R"]).withColumn("tot", F.col("A") + F.col("N") + F.col("R"))
    pct = {f"p{f}": F.floor(F.col(f) * 100 / F.col("tot")).cast("long") for f in "ANR"}
    w = w.withColumns(pct).withColumn("total_pct", F.col("pA") + F.col("pN") + F.col("pR"))
    return w.filter(F.col("total_pct") < 100).select("l_orderkey", "pA", "pN", "pR", "total_pct")


SQL_LOW_PERCENT = """
WITH w AS (SELECT l_orderkey,
  CAST(COALESCE(SUM(l_quantity) FILTER (WHERE l_returnflag = 'A'), 0) AS BIGINT) AS a,
  CAST(COALESCE(SUM(l_quantity) FILTER (WHERE l_returnflag = 'N'), 0) AS BIGINT) AS n,
  CAST(COALESCE(SUM(l_quantity) FILTER (WHERE l_returnflag = 'R'), 0) AS BIGINT) AS r FROM lineitem GROUP BY l_orderkey),
p AS (SELECT l_orderkey, (a * 100) // (a + n + r) AS "pA", (n * 100) // (a + n + r) AS "pN",
             (r * 100) // (a + n + r) AS "pR" FROM w)
SELECT l_orderkey, "pA", "pN", "pR", "pA" + "pN" + "pR" AS total_pct FROM p WHERE "pA" + "pN" + "pR" < 100"""


# -- Q10: attributes that drift across years for one key --------------------
def q_attr_drift(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_suppkey", F.year("l_shipdate").alias("year"),
                                             F.col("l_linestatus").alias("status"))
    return Q.attribute_drift(li, ["l_suppkey"], ["status"])


SQL_ATTR_DRIFT = """
SELECT l_suppkey, COUNT(*) AS n_versions FROM (SELECT DISTINCT l_suppkey, l_linestatus FROM lineitem)
GROUP BY l_suppkey HAVING COUNT(*) > 1"""


# -- Q11 F4: labels that are not people ---------------------------------------
def _labels(spark, sf):
    p = people(spark, sf)
    k = F.col("c_custkey") % 11
    name = (F.when(k == 0, F.lit("All Others")).when(k == 1, F.lit("Scattering"))
             .when(k == 2, F.lit("Write-In")).when(k == 3, F.concat(F.lit("Fred "), F.col("last")))
             .when(k == 4, F.lit("N/A")).otherwise(F.concat_ws(" ", "first", "last")))
    return p.select("c_custkey", name.alias("name"))


def q_junk(spark: SparkSession, sf: str) -> DataFrame:
    n = _labels(spark, sf)
    return n.select("c_custkey", "name", Q.is_junk_label(F.col("name")).alias("is_junk"))


# -- Q13 F5: identifier format ------------------------------------------------
def q_id_format(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", "c_name")
    osid = F.when(F.col("c_custkey") % 97 == 0, F.concat(F.lit("N"), F.col("c_custkey").cast("string"))) \
        .otherwise(F.concat(F.lit("N"), F.lpad(F.col("c_custkey").cast("string"), 8, "0")))
    c = c.withColumn("osid", osid)
    return c.select("c_custkey", "osid", Q.id_format_ok(F.col("osid")).alias("ok"),
                    F.lower("c_name").contains("customer#00000001").alias("name_hit"))


SQL_ID_FORMAT = r"""
WITH c AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 97 = 0 THEN 'N' || CAST(c_custkey AS VARCHAR)
  ELSE 'N' || lpad(CAST(c_custkey AS VARCHAR), 8, '0') END AS osid FROM customer)
SELECT c_custkey, osid, regexp_matches(osid, '^N\d{8}$') AS ok, contains(lower(c_name), 'customer#00000001') AS name_hit
FROM c"""


QUERIES = {"q_key_violations": q_key_violations, "q_orphans": q_orphans, "q_rule_violations": q_rule_violations,
           "q_quarantine": q_quarantine, "q_two_incumbents": q_two_incumbents, "q_low_percent": q_low_percent,
           "q_attr_drift": q_attr_drift, "q_junk": q_junk, "q_id_format": q_id_format}


def _junk_sql():
    from polidata.plans.q_match import _names_sql
    head = _names_sql().split(",\ncands AS")[0]
    return f"""WITH {head},
l AS (SELECT c_custkey, CASE c_custkey % 11 WHEN 0 THEN 'All Others' WHEN 1 THEN 'Scattering' WHEN 2 THEN 'Write-In'
  WHEN 3 THEN 'Fred ' || last WHEN 4 THEN 'N/A' ELSE first || ' ' || last END AS name FROM people)
SELECT c_custkey, name, regexp_matches(name, '{Q.JUNK_LABELS}') AS is_junk FROM l"""


ORACLE = {"q_key_violations": SQL_KEY_VIOLATIONS, "q_orphans": SQL_ORPHANS, "q_rule_violations": SQL_RULE_VIOLATIONS,
          "q_quarantine": SQL_QUARANTINE, "q_two_incumbents": SQL_TWO_INCUMBENTS, "q_low_percent": SQL_LOW_PERCENT,
          "q_attr_drift": SQL_ATTR_DRIFT, "q_junk": _junk_sql(), "q_id_format": SQL_ID_FORMAT}


# -- Q1 on every table: declared grains of the warehouse ---------------------
GRAINS = {"lineitem": ["l_orderkey", "l_linenumber"], "orders": ["o_orderkey"], "customer": ["c_custkey"],
          "part": ["p_partkey"], "supplier": ["s_suppkey"], "events": ["event_id"]}


def q_grain_report(spark: SparkSession, sf: str) -> DataFrame:
    outs = {t: table(spark, sf, t).select(*keys) for t, keys in GRAINS.items()}
    return Q.grain_report(outs, GRAINS)


SQL_GRAIN_REPORT = "\nUNION ALL\n".join(
    f"""SELECT '{t}' AS "table", CAST(COALESCE(SUM(c), 0) AS BIGINT) AS n_rows,
  COUNT(*) FILTER (WHERE c > 1) AS n_dup_keys,
  CAST(COALESCE(SUM(c) FILTER (WHERE {' OR '.join(f'{k} IS NULL' for k in keys)}), 0) AS BIGINT) AS n_null_keys
FROM (SELECT {', '.join(keys)}, COUNT(*) AS c FROM {t} GROUP BY {', '.join(keys)})"""
    for t, keys in GRAINS.items())

QUERIES["q_grain_report"] = q_grain_report
ORACLE["q_grain_report"] = SQL_GRAIN_REPORT
