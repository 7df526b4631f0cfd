"""Catalogue: ordered-window queries (fill-down, islands, blocks, duplicates).

Events are scanned per user in (ts, event_id) order; the running operators
split every user into hour chunks so a very active user is never processed by
a single task (two-level scan, see ``operators.windows``); the per-chunk
summary has at most users x hours rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polidata.operators import windows as W
from polidata.plans.tables import table

ORDER = ["ts", "event_id"]
def day_chunk():
    """Chunk column for the two-level scans: the hour of the event."""
    return F.date_trunc("hour", "ts")


# -- W4 W5: fill down, fill with increment -----------------------------------
def q_fill_down(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select(
        "event_id", "user_id", "ts",
        F.when(F.col("event_id") % 3 == 0, F.col("event_type")).alias("etype"),
        F.when(F.col("event_id") % 3 == 0, F.col("event_id")).alias("seq"))
    e = W.fill_down(e, "etype", ["user_id"], ORDER, chunk=day_chunk(), out="etype_filled")
    e = W.fill_increment(e, "seq", ["user_id"], ORDER, chunk=day_chunk(), out="seq_filled")
    return e.select("event_id", "user_id", "etype_filled", "seq_filled")


SQL_FILL_DOWN = """
WITH e AS (SELECT event_id, user_id, ts,
  CASE WHEN event_id % 3 = 0 THEN event_type END AS etype,
  CASE WHEN event_id % 3 = 0 THEN event_id END AS seq FROM events),
r AS (SELECT *, row_number() OVER w AS idx,
  last_value(etype IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS etype_filled,
  last_value(seq IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lv
  FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
r2 AS (SELECT *, last_value(CASE WHEN seq IS NOT NULL THEN idx END IGNORE NULLS)
  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS li FROM r)
SELECT event_id, user_id, etype_filled, lv + (idx - li) AS seq_filled FROM r2
"""


# -- W6 W7 W8 W10: islands of consecutive active days, 4-day blocks ----------
def q_islands(spark: SparkSession, sf: str) -> DataFrame:
    days = table(spark, sf, "events").select(
        "user_id", F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")).alias("day_num")).distinct()
    d = W.islands(days, ["user_id"], "day_num", gap=1, out="island")
    d = W.row_index(d, ["user_id"], ["day_num"], out="idx")           # bounded: one row per day
    d = W.block_label(d, ["user_id"], ["day_num"], 4, out="block4")
    d = d.withColumn("label", F.when(F.col("island") == 0, "first").otherwise("later"))
    return d.select("user_id", "day_num", "idx", "island", "label", "block4")


SQL_ISLANDS = """
WITH d AS (SELECT DISTINCT user_id, CAST(datediff('day', DATE '2024-01-01', CAST(ts AS DATE)) AS INTEGER) AS day_num
           FROM events),
b AS (SELECT *, CASE WHEN day_num > lag(day_num) OVER (PARTITION BY user_id ORDER BY day_num) + 1 THEN 1 ELSE 0 END AS brk,
             row_number() OVER (PARTITION BY user_id ORDER BY day_num) AS idx FROM d)
SELECT user_id, day_num, CAST(idx AS INTEGER) AS idx,
  CAST(SUM(brk) OVER (PARTITION BY user_id ORDER BY day_num ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS island,
  CASE WHEN SUM(brk) OVER (PARTITION BY user_id ORDER BY day_num ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) = 0
       THEN 'first' ELSE 'later' END AS label,
  CAST(floor((idx - 1) / 4) AS INTEGER) AS block4
FROM b
"""


# -- F10: the marker row and the three rows after it ------------------------
def q_block_slice(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "user_id", "ts", "event_type", "value")
    out = W.block_after_marker(e, ["user_id"], ORDER, F.col("event_type") == "error", 3,
                               out="offset", chunk=day_chunk())
    return out.select("event_id", "user_id", "event_type", "offset")


SQL_BLOCK_SLICE = """
WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS idx FROM events),
m AS (SELECT *, last_value(CASE WHEN event_type = 'error' THEN idx END IGNORE NULLS)
      OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mi FROM r)
SELECT event_id, user_id, event_type, idx - mi AS offset FROM m WHERE idx - mi BETWEEN 0 AND 3
"""


# -- W9 Q1: duplicate keys; Q12: keep the flagged twin ----------------------
def q_dups(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return W.duplicate_rows(li, ["l_orderkey", "l_linenumber"])


SQL_DUPS = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, n_dup FROM lineitem
JOIN (SELECT l_orderkey, l_linenumber, COUNT(*) AS n_dup FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1)
USING (l_orderkey, l_linenumber)
"""


def q_keep_flagged(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_returnflag") == "R").alias("flagged"))
    return W.keep_flagged_twins(li, ["l_orderkey", "l_linenumber"], "flagged")


SQL_KEEP_FLAGGED = """
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag = 'R' AS flagged FROM lineitem),
m AS (SELECT l_orderkey, l_linenumber, MAX(CAST(flagged AS INTEGER)) AS mx FROM l GROUP BY ALL)
SELECT l_orderkey, l_linenumber, l_partkey, flagged FROM l JOIN m USING (l_orderkey, l_linenumber)
WHERE flagged OR mx = 0
"""


QUERIES = {"q_fill_down": q_fill_down, "q_islands": q_islands, "q_block_slice": q_block_slice,
           "q_dups": q_dups, "q_keep_flagged": q_keep_flagged}
ORACLE = {"q_fill_down": SQL_FILL_DOWN, "q_islands": SQL_ISLANDS, "q_block_slice": SQL_BLOCK_SLICE,
          "q_dups": SQL_DUPS, "q_keep_flagged": SQL_KEEP_FLAGGED}
