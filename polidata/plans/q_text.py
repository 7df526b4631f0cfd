"""Catalogue: scalar text, number and date functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polidata.functions import civics as C
from polidata.functions import dates as D
from polidata.functions import text as X
from polidata.functions.columns import mutate_at
from polidata.functions.nullsafe import if_else, split_part
from polidata.operators import shape as S
from polidata.plans.tables import table


# -- X2 X3 X4 X5 X9: text in parentheses, first match, first replacement ----
def q_paren_text(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    label = F.when(F.col("c_custkey") % 4 == 0, F.col("c_name")).otherwise(F.concat(
        F.col("c_name"), F.lit(" ("), F.substring("c_mktsegment", 1, 1), F.lit("-"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), F.lit(")")))
    c = c.select("c_custkey", label.alias("label"))
    paren = X.paren_text("label")
    return c.select(
        "c_custkey", paren.alias("paren"), X.remove_paren("label").alias("name"),
        split_part(paren, "-", 1).alias("party"), split_part(paren, "-", 2).alias("state"),
        X.first_match("label", r"\d+").alias("num"),
        X.replace_first("label", "0", "o").alias("first_o"))


SQL_PAREN_TEXT = r"""
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_name ELSE
  c_name || ' (' || substr(c_mktsegment, 1, 1) || '-' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || ')' END AS label
  FROM customer),
p AS (SELECT *, NULLIF(regexp_extract(label, '\(([^()]*)\)', 1), '') AS paren FROM c)
SELECT c_custkey, paren, trim(regexp_replace(label, '\s*\([^()]*\)', '')) AS name,
  split_part(paren, '-', 1) AS party, split_part(paren, '-', 2) AS state,
  NULLIF(regexp_extract(label, '\d+'), '') AS num, regexp_replace(label, '0', 'o') AS first_o
FROM p
"""


# -- X6 X7 X25 X26 X30: "Last, First M." cleanup and tokens -----------------
def _raw_names(spark, sf):
    p = table(spark, sf, "part").select("p_partkey", "p_name")
    w1, w2 = F.get(F.split("p_name", " "), 0), F.get(F.split("p_name", " "), 1)

    def cap(w):
        return F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, F.lit(2), F.length(w)))

    raw = F.concat(cap(w2), F.lit(", "), cap(w1), F.lit(" "),
                   F.chr(F.lit(65) + F.col("p_partkey") % 26), F.lit("."))
    raw = F.when(F.col("p_partkey") % 7 == 0, F.regexp_replace(raw, "a", "á")).otherwise(raw)
    raw = F.when(F.col("p_partkey") % 11 == 0, F.concat(raw, F.lit("\t\n"))).otherwise(raw)
    raw = F.when(F.col("p_partkey") % 13 == 0, F.concat(raw, F.lit(" Jr"))).otherwise(raw)
    return p.select("p_partkey", raw.alias("raw"))


def q_names_norm(spark: SparkSession, sf: str) -> DataFrame:
    n = _raw_names(spark, sf)
    n = n.withColumn("clean", X.fold_accents(X.strip_controls("raw")))
    n = n.withColumn("flipped", X.flip_name("clean"))
    return n.select("p_partkey", "clean", "flipped",
                    F.array_join(X.name_tokens("flipped"), " ").alias("tokens"),
                    X.last_name("flipped").alias("last"))


SQL_NAMES_NORM = r"""
WITH p AS (SELECT p_partkey, string_split(p_name, ' ')[1] AS w1, string_split(p_name, ' ')[2] AS w2 FROM part),
r0 AS (SELECT p_partkey, upper(substr(w2, 1, 1)) || substr(w2, 2, 100) || ', ' || upper(substr(w1, 1, 1)) || substr(w1, 2, 100)
  || ' ' || chr(CAST(65 + p_partkey % 26 AS INTEGER)) || '.' AS raw FROM p),
r1 AS (SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN regexp_replace(raw, 'a', 'á', 'g') ELSE raw END AS raw FROM r0),
r2 AS (SELECT p_partkey, CASE WHEN p_partkey % 11 = 0 THEN raw || chr(9) || chr(10) ELSE raw END AS raw FROM r1),
r3 AS (SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN raw || ' Jr' ELSE raw END AS raw FROM r2),
c AS (SELECT p_partkey, translate(regexp_replace(raw, '[\n\t\r]', '', 'g'),
        'áàâäãéèêëíìîïóòôöõúùûüñç', 'aaaaaeeeeiiiiooooouuuunc') AS clean FROM r3),
f AS (SELECT p_partkey, clean, CASE WHEN strpos(clean, ',') = 0 THEN trim(clean)
        ELSE trim(substr(clean, strpos(clean, ',') + 1)) || ' ' || trim(substr(clean, 1, strpos(clean, ',') - 1)) END AS flipped
      FROM c),
t AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(flipped, '[,\-.]', ' ', 'g'),
        '^[A-Z]\s+', ' ', 'g'), '\s+[A-Z]\s+', ' ', 'g')) AS s FROM f)
SELECT p_partkey, clean, flipped,
  array_to_string(list_filter(regexp_split_to_array(s, '\s+'), lambda x: x <> ''), ' ') AS tokens,
  list_filter(string_split(flipped, ' '), lambda x: x NOT IN ('Jr', 'II', 'III', ''))[-1] AS last
FROM t
"""


# -- X13 X15 Q8: vote text with thousands commas, 'Unopposed', 'N/A' --------
def _votes_text(n):
    """Integer -> text with thousands separators (n < 1e9)."""
    n = F.floor(n).cast("long")
    mil, tho, one = F.floor(n / 1000000), F.floor(n / 1000) % 1000, n % 1000
    return (F.when(n >= 1000000, F.concat(mil.cast("string"), F.lit(","), F.lpad(tho.cast("string"), 3, "0"),
                                          F.lit(","), F.lpad(one.cast("string"), 3, "0")))
             .when(n >= 1000, F.concat(tho.cast("string"), F.lit(","), F.lpad(one.cast("string"), 3, "0")))
             .otherwise(one.cast("string")))


def q_votes_parse(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    n = F.when(F.col("o_orderkey") % 13 == 0, F.col("o_totalprice") * 10).otherwise(F.col("o_totalprice"))
    txt = (F.when(F.col("o_orderkey") % 10 == 0, F.lit("Unopposed"))
            .when(F.col("o_orderkey") % 10 == 1, F.lit("N/A")).otherwise(_votes_text(n)))
    o = o.withColumn("votes_txt", txt).withColumn("v", C.parse_votes("votes_txt"))
    unopposed = F.col("v") == float("inf")
    return o.select("o_orderkey", "votes_txt", F.when(~unopposed, F.col("v")).alias("votes"),
                    F.coalesce(unopposed, F.lit(False)).alias("unopposed"))


SQL_VOTES_PARSE = """
WITH o AS (SELECT o_orderkey, CAST(floor(CASE WHEN o_orderkey % 13 = 0 THEN o_totalprice * 10 ELSE o_totalprice END) AS BIGINT) AS n
           FROM orders),
t AS (SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN 'Unopposed' WHEN o_orderkey % 10 = 1 THEN 'N/A'
  WHEN n >= 1000000 THEN CAST(n // 1000000 AS VARCHAR) || ',' || lpad(CAST((n // 1000) % 1000 AS VARCHAR), 3, '0')
       || ',' || lpad(CAST(n % 1000 AS VARCHAR), 3, '0')
  WHEN n >= 1000 THEN CAST((n // 1000) % 1000 AS VARCHAR) || ',' || lpad(CAST(n % 1000 AS VARCHAR), 3, '0')
  ELSE CAST(n % 1000 AS VARCHAR) END AS votes_txt FROM o),
v AS (SELECT *, TRY_CAST(CASE WHEN replace(trim(votes_txt), ',', '') = 'Unopposed' THEN 'Infinity'
  ELSE replace(trim(votes_txt), ',', '') END AS DOUBLE) AS v FROM t)
SELECT o_orderkey, votes_txt, CASE WHEN NOT isinf(v) THEN v END AS votes, COALESCE(isinf(v), false) AS unopposed FROM v
"""


# -- X16 X17 P8: dates in three text formats, invalid 29 Feb, 2-digit years --
def q_dates(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    k = F.col("o_orderkey") % 3
    txt = (F.when(F.col("o_orderkey") % 17 == 0, F.lit("19970229"))
            .when(k == 0, F.date_format("d", "MMM. d, yyyy"))
            .when(k == 1, F.date_format("d", "MMMM d, yyyy"))
            .otherwise(F.date_format("d", "yyyyMMdd")))
    o = o.withColumn("txt", txt)
    o = o.withColumn("parsed", F.coalesce(D.month_day_year("txt"), D.compact_date("txt")))
    o = o.withColumn("y2", F.when(F.col("o_orderkey") % 5 == 0, F.year("d") % 100).otherwise(F.year("d")))
    o = mutate_at(o, ["y2"], C.repair_year)
    return o.select("o_orderkey", "txt", F.col("parsed").cast("string").alias("parsed"), "y2")


SQL_DATES = """
WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders),
t AS (SELECT o_orderkey, d, CASE WHEN o_orderkey % 17 = 0 THEN '19970229'
  WHEN o_orderkey % 3 = 0 THEN strftime(d, '%b. %-d, %Y')
  WHEN o_orderkey % 3 = 1 THEN strftime(d, '%B %-d, %Y') ELSE strftime(d, '%Y%m%d') END AS txt FROM o),
p AS (SELECT *, COALESCE(
  try_strptime(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(
    trim(regexp_replace(txt, '^([^.]*)\\.', '\\1')),
    'January', 'Jan'), 'February', 'Feb'), 'March', 'Mar'), 'April', 'Apr'), 'May', 'May'), 'June', 'Jun'),
    'July', 'Jul'), 'August', 'Aug'), 'September', 'Sep'), 'October', 'Oct'), 'November', 'Nov'), 'December', 'Dec'),
    '%b %d, %Y'),
  try_strptime(txt, '%Y%m%d')) AS parsed,
  CASE WHEN o_orderkey % 5 = 0 THEN year(d) % 100 ELSE year(d) END AS y2 FROM t)
SELECT o_orderkey, txt, CAST(CAST(parsed AS DATE) AS VARCHAR) AS parsed,
  CAST(CASE WHEN y2 = 0 THEN 2000 WHEN y2 < 100 THEN y2 + 1900 ELSE y2 END AS INTEGER) AS y2
FROM p
"""


# -- X18 X19 X24: assembly number, election cycles, ordinal suffixes --------
def q_assembly_cycle(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    o = o.union(table(spark, sf, "lineitem").select(F.year("l_shipdate").alias("year"))).distinct()
    cg = C.assembly_of_year(F.col("year"))
    return o.select("year", cg.alias("assembly"),
                    C.cycle_of_assembly(cg, "closing").alias("cycle_closing"),
                    C.cycle_of_assembly(cg, "electing").alias("cycle_electing"),
                    F.concat(cg.cast("string"), X.ordinal_suffix(cg)).alias("label_source"),
                    F.concat((cg - 5).cast("string"), X.ordinal_suffix(cg - 5, upto=None)).alias("label_english"))


SQL_ASSEMBLY_CYCLE = """
WITH y AS (SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
           UNION SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) FROM lineitem),
c AS (SELECT year, CAST(floor((year - 1787) / 2) AS INTEGER) AS assembly FROM y)
SELECT year, assembly, assembly * 2 + 1788 AS cycle_closing, assembly * 2 + 1786 AS cycle_electing,
  CAST(assembly AS VARCHAR) || CASE WHEN assembly < 110 AND assembly % 10 = 1 THEN 'st'
    WHEN assembly < 110 AND assembly % 10 = 2 THEN 'nd' WHEN assembly < 110 AND assembly % 10 = 3 THEN 'rd'
    ELSE 'th' END AS label_source,
  CAST(assembly - 5 AS VARCHAR) || CASE WHEN (assembly - 5) % 100 BETWEEN 11 AND 13 THEN 'th'
    WHEN (assembly - 5) % 10 = 1 THEN 'st' WHEN (assembly - 5) % 10 = 2 THEN 'nd'
    WHEN (assembly - 5) % 10 = 3 THEN 'rd' ELSE 'th' END AS label_english
FROM c
"""


# -- X20 X31 X21: degree days from Celsius, half-even rounding, NULL-safe if --
def q_degree_days(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select(
        "event_id", F.when(F.col("event_id") % 9 == 0, F.lit(None)).otherwise(F.col("value") - 20).alias("t"))
    return e.select("event_id", C.cooling_degree_days("t").alias("cdd"), C.heating_degree_days("t").alias("hdd"),
                    if_else(F.col("t") > 10, "warm", "cold").alias("feel"))


SQL_DEGREE_DAYS = """
WITH e AS (SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE value - 20 END AS t FROM events),
d AS (SELECT event_id, t, t * 9 / 5 + 32 - 65 AS d FROM e)
SELECT event_id,
  CASE WHEN d IS NULL THEN NULL WHEN d >= 0 THEN round_even(abs(d), 0) ELSE 0.0 END AS cdd,
  CASE WHEN d IS NULL THEN NULL WHEN d <= 0 THEN round_even(abs(d), 0) ELSE 0.0 END AS hdd,
  CASE WHEN t IS NULL THEN NULL WHEN t > 10 THEN 'warm' ELSE 'cold' END AS feel
FROM d
"""


# -- X8 X29 X1 X10: district text -> number -> padded code ------------------
def q_district_code(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    txt = F.when(F.col("c_custkey") % 5 == 0, F.lit("At Large")) \
           .otherwise(F.concat(F.lit("District "), (F.col("c_custkey") % 53).cast("string")))
    c = c.withColumn("dist_txt", txt).withColumn("dist_num", C.district_number("dist_txt"))
    code = C.district_code(F.col("c_nationkey"), F.col("dist_num"))
    return c.select("c_custkey", "dist_txt", "dist_num", code.alias("dist_code"),
                    F.substring("c_name", -4, 4).alias("tail4"),
                    F.concat_ws("-", F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), code).alias("geo_id"))


SQL_DISTRICT_CODE = """
WITH c AS (SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 5 = 0 THEN 'At Large'
  ELSE 'District ' || CAST(c_custkey % 53 AS VARCHAR) END AS dist_txt FROM customer),
n AS (SELECT *, TRY_CAST(CASE WHEN trim(replace(dist_txt, 'District ', '')) = 'At Large' THEN '1'
  ELSE trim(replace(dist_txt, 'District ', '')) END AS INTEGER) AS dist_num FROM c),
k AS (SELECT *, CASE WHEN dist_num IS NULL OR dist_num = 0 THEN '00' ELSE lpad(CAST(dist_num AS VARCHAR), 2, '0') END AS code
  FROM n)
SELECT c_custkey, dist_txt, dist_num, code AS dist_code, substr(c_name, -4, 4) AS tail4,
  lpad(CAST(c_nationkey AS VARCHAR), 2, '0') || '-' || code AS geo_id FROM k
"""


# -- R6: replicate rows by a count (0 -> no row) ----------------------------
def q_replicate(spark: SparkSession, sf: str) -> DataFrame:
    s = table(spark, sf, "supplier").select("s_suppkey", (F.col("s_suppkey") % 4).alias("n"))
    return S.replicate(s, "n", index="rep").select("s_suppkey", "rep")


SQL_REPLICATE = """
SELECT s_suppkey, CAST(rep AS INTEGER) AS rep FROM supplier,
  LATERAL (SELECT unnest(generate_series(1, s_suppkey % 4)) AS rep) WHERE s_suppkey % 4 > 0
"""


# -- R5: split a delimited cell into rows (with position) --------------------
def q_split_rows(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select(
        "p_partkey", F.concat_ws(";", F.regexp_replace("p_name", " ", "; "), F.lit(""), "p_brand").alias("cell"))
    return S.split_to_rows(p, "cell", ";", out="word", keep_pos=True)


SQL_SPLIT_ROWS = """
WITH p AS (SELECT p_partkey, replace(p_name, ' ', '; ') || ';;' || p_brand AS cell FROM part),
l AS (SELECT p_partkey, list_filter(list_transform(string_split(cell, ';'), lambda x: trim(x)), lambda x: x <> '') AS w FROM p)
SELECT p_partkey, CAST(i - 1 AS INTEGER) AS word_pos, w[i] AS word FROM l, LATERAL (SELECT unnest(range(1, len(w) + 1)) AS i)
"""


QUERIES = {"q_paren_text": q_paren_text, "q_names_norm": q_names_norm, "q_votes_parse": q_votes_parse,
           "q_dates": q_dates, "q_assembly_cycle": q_assembly_cycle, "q_degree_days": q_degree_days,
           "q_district_code": q_district_code, "q_replicate": q_replicate, "q_split_rows": q_split_rows}
ORACLE = {"q_paren_text": SQL_PAREN_TEXT, "q_names_norm": SQL_NAMES_NORM, "q_votes_parse": SQL_VOTES_PARSE,
          "q_dates": SQL_DATES, "q_assembly_cycle": SQL_ASSEMBLY_CYCLE, "q_degree_days": SQL_DEGREE_DAYS,
          "q_district_code": SQL_DISTRICT_CODE, "q_replicate": SQL_REPLICATE, "q_split_rows": SQL_SPLIT_ROWS}
