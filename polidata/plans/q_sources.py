"""Catalogue: sources and sinks - HTML pages, cell grids, fixed-width records,
nested JSON, file-name tags, encodings, write/read round trips."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polidata.functions.civics import generation_mwh
from polidata.functions.text import drop_last_char
from polidata.operators.joins import inline_table
from polidata.sources import readers as R
from polidata.sources import writers as Wr
from polidata.plans.tables import table



# -- S14 P16: links with an href prefix, href and text aligned by position ---
def q_html_links(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "pages").select("page_id", R.html_links(F.col("html"), "/").alias("links"))
    out = p.select("page_id", F.posexplode("links").alias("pos", "l"))
    return out.select("page_id", "pos", F.col("l.href").alias("href"), R.strip_tags(F.col("l.text")).alias("text"))


SQL_HTML_LINKS = r"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '<a\s+href="([^"]*)"[^>]*>(.*?)</a>', 1) AS h,
                  regexp_extract_all(html, '<a\s+href="([^"]*)"[^>]*>(.*?)</a>', 2) AS t FROM pages),
u AS (SELECT page_id, unnest(range(1, len(h) + 1)) AS i, h, t FROM l),
f AS (SELECT page_id, i, h[i] AS href, t[i] AS txt FROM u WHERE starts_with(h[i], '/'))
SELECT page_id, CAST(row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS INTEGER) AS pos, href,
       trim(regexp_replace(txt, '<[^>]+>', '', 'g')) AS text FROM f
"""


# -- S13 X12: list items in page order -------------------------------------
def q_html_items(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "pages").select("page_id", R.html_elements(F.col("html"), "li").alias("items"))
    out = p.select("page_id", F.posexplode("items").alias("pos", "raw"))
    out = out.withColumn("item", R.strip_tags(F.col("raw")))
    return out.select("page_id", "pos", "item", drop_last_char(F.col("item")).alias("item_cut"))


SQL_HTML_ITEMS = r"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '(?s)<li(?:\s[^>]*)?>(.*?)</li>', 1) AS it FROM pages),
u AS (SELECT page_id, unnest(range(1, len(it) + 1)) AS i, it FROM l),
s AS (SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, trim(regexp_replace(it[i], '<[^>]+>', '', 'g')) AS item FROM u)
SELECT page_id, pos, item, substr(item, 1, greatest(length(item) - 1, 0)) AS item_cut FROM s
"""


# -- S15: detail page for every row of a driving table ----------------------
def q_detail_pages(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    drive = pages.select("page_id", F.regexp_replace("url", r"[?#].*$", "").alias("canonical"))
    detail = pages.select(F.col("page_id").alias("detail_page_id"), F.col("url").alias("canonical"),
                          F.size(F.regexp_extract_all("html", F.lit(r"<a\s+href="), 0)).alias("n_links"))
    return drive.join(detail, "canonical", "left")


SQL_DETAIL_PAGES = r"""
WITH d AS (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS canonical FROM pages),
p AS (SELECT page_id AS detail_page_id, url AS canonical,
             CAST(len(regexp_extract_all(html, '<a\s+href=', 0)) AS INTEGER) AS n_links FROM pages)
SELECT d.canonical, d.page_id, p.detail_page_id, p.n_links FROM d LEFT JOIN p USING (canonical)
"""


# -- S16 S2 O4: header row located by content within the first rows ---------
def q_header_detect(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("idx", "line"))
    cells = d.withColumn("cells", F.split("line", " "))
    body = R.detect_header(cells, ["doc_id"], "idx", "cells", "the", within=10)
    return body.groupBy("doc_id", "hdr_idx", "hdr_col").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.size("cells")).alias("n_cells"))


SQL_HEADER_DETECT = """
WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
u AS (SELECT doc_id, unnest(range(1, len(lines) + 1)) AS i, lines FROM l),
c AS (SELECT doc_id, CAST(i - 1 AS INTEGER) AS idx, string_split(lines[i], ' ') AS cells FROM u),
p AS (SELECT *, list_position(list_transform(cells, lambda x: lower(x)), 'the') AS pos FROM c),
h AS (SELECT doc_id, min(idx) AS hdr_idx, arg_min(pos, idx) AS hdr_col FROM p WHERE idx < 10 AND pos > 0 GROUP BY doc_id)
SELECT c.doc_id, h.hdr_idx, CAST(h.hdr_col AS INTEGER) AS hdr_col, COUNT(*) AS n_rows,
       CAST(SUM(len(c.cells)) AS BIGINT) AS n_cells
FROM c JOIN h USING (doc_id) WHERE c.idx > h.hdr_idx GROUP BY ALL
"""


# -- S9 S10 S11 X27 X28: fixed-width monthly master records -----------------
# Fuel code labels used in this catalogue (test-table codes).
FUEL_LABELS = [("A", "Anthracite, coal"), ("N", "Natural gas"), ("R", "Residual, fuel oil")]
GROUP_FIELDS = [("generation", 0, 10, "double"), ("consumption", 10, 8, "long"), ("stocks", 18, 8, "long")]


def master_records(spark: SparkSession, sf: str) -> DataFrame:
    """One 350-character record per (plant, fuel, year): code fields, a
    sanitised description, and 12 monthly groups of 26 characters."""
    li = table(spark, sf, "lineitem")
    m = li.groupBy("l_suppkey", "l_returnflag", (F.year("l_shipdate") - 10).alias("year"),
                   F.month("l_shipdate").alias("month")).agg(
        (F.sum("l_quantity") - 60).cast("long").alias("gen"),
        F.sum(F.col("l_quantity") * F.col("l_linenumber")).cast("long").alias("con"),
        F.count(F.lit(1)).alias("stk"))
    months = list(range(1, 13))
    wide = m.groupBy("l_suppkey", "l_returnflag", "year").pivot("month", months).agg(
        F.first("gen").alias("g"), F.first("con").alias("c"), F.first("stk").alias("s"))
    lab = inline_table(spark, FUEL_LABELS, "l_returnflag string, descr string")
    wide = wide.join(lab, "l_returnflag", "left")

    def fld(c, w):
        return F.coalesce(R.fitting(F.col(c), w, " "), F.lit(" " * w))

    parts = [R.fitting(F.col("l_suppkey"), 12, "0"), F.rpad("l_returnflag", 2, " "),
             F.col("year").cast("string"), F.rpad(R.sanitize_delimiter(F.col("descr")), 20, " ")]
    for mo in months:
        parts += [fld(f"{mo}_g", 10), fld(f"{mo}_c", 8), fld(f"{mo}_s", 8)]
    return wide.select(R.fixed_record(parts, 38 + 12 * 26).alias("record"))


def q_fixed_width(spark: SparkSession, sf: str) -> DataFrame:
    rec = master_records(spark, sf)
    head = R.fixed_width(F.col("record"), [("plant", 1, 12, "long"), ("fuel", 13, 2, "string"),
                                          ("year", 15, 4, "int"), ("descr", 19, 20, "string")])
    d = rec.select(*head, F.explode(R.repeating_group(F.col("record"), 39, 12, GROUP_FIELDS)).alias("m"))
    d = d.select("plant", "fuel", "descr", "year", "m.*")
    lab = inline_table(spark, FUEL_LABELS, "fuel string, fuel_label string")
    d = d.join(lab, "fuel", "left")
    return d.withColumn("generation", F.round(generation_mwh(F.col("generation"), F.col("year")), 6))


SQL_FIXED_WIDTH = """
WITH m AS (SELECT l_suppkey, l_returnflag, CAST(year(l_shipdate) AS INTEGER) - 10 AS year,
                  CAST(month(l_shipdate) AS INTEGER) AS month,
                  CAST(SUM(l_quantity) - 60 AS BIGINT) AS gen, CAST(SUM(l_quantity * l_linenumber) AS BIGINT) AS con,
                  COUNT(*) AS stk FROM lineitem GROUP BY ALL),
g AS (SELECT DISTINCT l_suppkey, l_returnflag, year FROM m),
grid AS (SELECT g.*, CAST(mm AS INTEGER) AS month FROM g, range(1, 13) t(mm)),
lab(fuel, fuel_label) AS (VALUES ('A', 'Anthracite, coal'), ('N', 'Natural gas'), ('R', 'Residual, fuel oil'))
SELECT grid.l_returnflag AS fuel, grid.l_suppkey AS plant, replace(lab.fuel_label, ',', ';') AS descr,
  grid.year, grid.month,
  round(CASE WHEN grid.year < 1990 THEN m.gen / 1000 ELSE CAST(m.gen AS DOUBLE) END, 6) AS generation,
  m.con AS consumption, m.stk AS stocks, lab.fuel_label
FROM grid LEFT JOIN m USING (l_suppkey, l_returnflag, year, month) LEFT JOIN lab ON lab.fuel = grid.l_returnflag
"""


# -- S12: nested documents -> flat info + exploded terms ---------------------
TERM = T.StructType([T.StructField("type", T.StringType()), T.StructField("start", T.StringType()),
                     T.StructField("end", T.StringType())])
DOC = T.StructType([
    T.StructField("name", T.StructType([T.StructField("first", T.StringType()), T.StructField("last", T.StringType())])),
    T.StructField("id", T.StructType([T.StructField("order", T.LongType()), T.StructField("cust", T.LongType())])),
    T.StructField("terms", T.ArrayType(TERM))])


def q_nested_terms(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    d0 = F.to_date("o_orderdate")
    doc = F.to_json(F.struct(
        F.struct(F.concat(F.lit("Cust#"), F.col("o_custkey").cast("string")).alias("first"),
                 F.col("o_orderpriority").alias("last")).alias("name"),
        F.struct(F.col("o_orderkey").alias("order"), F.col("o_custkey").alias("cust")).alias("id"),
        F.array(F.struct(F.lit("rep").alias("type"), d0.cast("string").alias("start"),
                         F.add_months(d0, 24).cast("string").alias("end")),
                F.struct(F.when(F.col("o_orderstatus") == "F", "sen").otherwise("rep").alias("type"),
                         F.add_months(d0, 24).cast("string").alias("start"),
                         F.add_months(d0, 96).cast("string").alias("end"))).alias("terms")))
    docs = o.select(doc.alias("json"))
    parsed = docs.select(F.from_json("json", DOC).alias("d"))
    flat = parsed.select("d.name.*", "d.id.*", F.posexplode("d.terms").alias("term_no", "t"))
    return flat.select("order", "cust", "first", "last", "term_no", "t.type",
                       F.when(F.col("t.type") == "rep", "House").otherwise("Senate").alias("chamber"),
                       "t.start", "t.end")


SQL_NESTED_TERMS = """
WITH o AS (SELECT o_orderkey AS "order", o_custkey AS cust, 'Cust#' || CAST(o_custkey AS VARCHAR) AS first,
                  o_orderpriority AS last, o_orderstatus, CAST(o_orderdate AS DATE) AS d FROM orders)
SELECT "order", cust, first, last, 0 AS term_no, 'rep' AS type, 'House' AS chamber,
       CAST(d AS VARCHAR) AS start, CAST(CAST(d + INTERVAL 24 MONTH AS DATE) AS VARCHAR) AS "end" FROM o
UNION ALL
SELECT "order", cust, first, last, 1, CASE WHEN o_orderstatus = 'F' THEN 'sen' ELSE 'rep' END,
       CASE WHEN o_orderstatus = 'F' THEN 'Senate' ELSE 'House' END,
       CAST(CAST(d + INTERVAL 24 MONTH AS DATE) AS VARCHAR), CAST(CAST(d + INTERVAL 96 MONTH AS DATE) AS VARCHAR) FROM o
"""


# -- S7 S8: JSON field and per-file tags --------------------------------------
def q_series_json(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "props", "_metadata")
    e = e.withColumn("src", F.regexp_extract(F.col("_metadata.file_path"), r"([a-z]+)\.parquet$", 1))
    return e.select("event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k"), "src",
                    F.lit("v1").alias("release"))


SQL_SERIES_JSON = """
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, 'events' AS src, 'v1' AS release
FROM events
"""


# -- S22: text encoding repair (UTF-8 bytes read as Latin-1, then repaired) ---
def q_encoding(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "text")
    moji = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    d = d.withColumn("moji", moji)
    repaired = F.decode(F.encode("moji", "ISO-8859-1"), "UTF-8")
    return d.select("doc_id", F.length("text").alias("n_chars"), F.length("moji").alias("n_bytes"),
                    (repaired == F.col("text")).alias("repaired_ok"))


SQL_ENCODING = """
SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars, CAST(strlen(text) AS INTEGER) AS n_bytes,
       CASE WHEN text IS NULL THEN NULL ELSE true END AS repaired_ok FROM documents
"""


# -- K1-K5 S1 S3 S4 S5 S6 S17: write / overwrite / read back -----------------
ORDER_COLS = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
                           T.StructField("o_totalprice", T.DoubleType()),
                           T.StructField("o_orderpriority", T.StringType())])


def q_sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    base = Wr.scratch_dir(spark, "sink")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority",
                                          F.year("o_orderdate").alias("year"))
    seps = {"csv": ",", "tsv": "\t", "psv": "|"}
    for fmt, sep in seps.items():
        Wr.write_append(o, os.path.join(base, fmt), ["year"], fmt="csv", header="true", sep=sep)
    Wr.write_partitions(o, os.path.join(base, "parquet"), ["year"])
    # re-run one year: only that partition is replaced, nothing is duplicated
    Wr.write_partitions(o.filter(F.col("year") == 1998), os.path.join(base, "parquet"), ["year"])
    # report files with a free-text preamble recognised by content
    lines = o.select("year", F.concat_ws(",", *[F.col(c).cast("string") for c in ORDER_COLS.names]).alias("value"))
    pre = o.select("year").distinct().select("year", F.lit("# orders report, draft").alias("value"))
    lines.unionByName(pre).write.mode("overwrite").partitionBy("year").text(os.path.join(base, "report"))
    frames = []
    for fmt, sep in seps.items():
        d = R.read_csv(spark, os.path.join(base, fmt), ORDER_COLS, sep=sep, glob="*.csv")
        frames.append(d.withColumn("fmt", F.lit(fmt)))
    frames.append(spark.read.parquet(os.path.join(base, "parquet")).withColumn("fmt", F.lit("parquet")))
    rep = R.read_csv_dropping(spark, os.path.join(base, "report"), ORDER_COLS, drop_regex="^#")
    rep = rep.withColumn("year", F.regexp_extract("file_path", r"year=(\d{4})", 1).cast("int"))
    frames.append(rep.drop("file_path").withColumn("fmt", F.lit("report")))
    cols = ["fmt", "year", "o_orderkey", "o_totalprice"]
    allf = frames[0].select(*cols)
    for f in frames[1:]:
        allf = allf.unionByName(f.select(*cols))
    return allf.groupBy("fmt", "year").agg(F.count(F.lit(1)).alias("n"),
                                          F.round(F.sum("o_totalprice"), 2).alias("total"))


SQL_SINK_ROUNDTRIP = """
WITH o AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, COUNT(*) AS n, round(SUM(o_totalprice), 2) AS total
           FROM orders GROUP BY ALL)
SELECT f.fmt, o.year, o.n, o.total FROM o,
  (VALUES ('csv'), ('tsv'), ('psv'), ('parquet'), ('report')) AS f(fmt)
"""


QUERIES = {"q_html_links": q_html_links, "q_html_items": q_html_items, "q_detail_pages": q_detail_pages,
           "q_header_detect": q_header_detect, "q_fixed_width": q_fixed_width,
           "q_nested_terms": q_nested_terms, "q_series_json": q_series_json, "q_encoding": q_encoding,
           "q_sink_roundtrip": q_sink_roundtrip}
ORACLE = {"q_html_links": SQL_HTML_LINKS, "q_html_items": SQL_HTML_ITEMS, "q_detail_pages": SQL_DETAIL_PAGES,
          "q_header_detect": SQL_HEADER_DETECT, "q_fixed_width": SQL_FIXED_WIDTH,
          "q_nested_terms": SQL_NESTED_TERMS, "q_series_json": SQL_SERIES_JSON, "q_encoding": SQL_ENCODING,
          "q_sink_roundtrip": SQL_SINK_ROUNDTRIP}
