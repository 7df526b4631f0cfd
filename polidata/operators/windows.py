"""Ordered-window operators: fill-down, islands, blocks, ranks, duplicates.

Every ordered window is partitioned (by document, user, race ...): a global
window would funnel all rows into one task.  Because one partition key may
still hold a large share of all rows, the running operators (``fill_down``,
``fill_increment``, ``islands``) accept an optional ``chunk`` column that
splits each key into ordered chunks.  They then run as a two-level prefix
scan: a window inside each (key, chunk), a tiny per-chunk summary scanned
across chunks, and a join of the carried value back on (key, chunk).  The
result is identical to the single window; no task sees a whole hot key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_UNB = Window.unboundedPreceding


def _cols(xs):
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _w(partition, order):
    return Window.partitionBy(*_cols(partition)).orderBy(*_cols(order))


def _scan_last(df: DataFrame, col: Column, partition: list, order: list,
               chunk: Column | None) -> DataFrame:
    """Add ``_gidx`` (1-based row number in the partition), ``_lv`` (last
    non-NULL ``col`` up to the row) and ``_li`` (the ``_gidx`` of that value).

    With ``chunk`` (non-decreasing along ``order``) the scan is two-level:
    windows inside (partition, chunk) plus a per-chunk summary scanned over
    the chunks of a key, joined back.  ``order`` must be a total order.
    """
    keys = list(partition)
    d = df.withColumn("_val", col)
    if chunk is None:
        w = _w(keys, order)
        wr = w.rowsBetween(_UNB, 0)
        d = d.withColumn("_gidx", F.row_number().over(w))
        return (d.withColumn("_lv", F.last("_val", ignorenulls=True).over(wr))
                 .withColumn("_li", F.last(F.when(F.col("_val").isNotNull(), F.col("_gidx")),
                                           ignorenulls=True).over(wr))
                 .drop("_val"))
    d = d.withColumn("_chunk", chunk)
    w = _w(keys + ["_chunk"], order)
    wr = w.rowsBetween(_UNB, 0)
    d = d.withColumn("_lidx", F.row_number().over(w))
    d = d.withColumn("_llv", F.last("_val", ignorenulls=True).over(wr)) \
         .withColumn("_lli", F.last(F.when(F.col("_val").isNotNull(), F.col("_lidx")), ignorenulls=True).over(wr))
    summ = d.groupBy(*keys, "_chunk").agg(
        F.count(F.lit(1)).alias("_n"),
        F.max_by(F.struct(F.col("_val").alias("v"), F.col("_lidx").alias("i")),
                 F.when(F.col("_val").isNotNull(), F.col("_lidx"))).alias("_last"))
    wc = _w(keys, ["_chunk"])
    prev = wc.rowsBetween(_UNB, -1)
    summ = summ.withColumn("_off", F.coalesce(F.sum("_n").over(prev), F.lit(0)))
    summ = summ.withColumn("_glast", F.when(F.col("_last").isNotNull(), F.struct(
        F.col("_last.v").alias("v"), (F.col("_last.i") + F.col("_off")).alias("i"))))
    summ = summ.withColumn("_carry", F.last("_glast", ignorenulls=True).over(prev))
    d = d.join(summ.select(*keys, "_chunk", "_off", "_carry"), [*keys, "_chunk"], "left")
    d = d.withColumn("_gidx", F.col("_lidx") + F.col("_off"))
    has_local = F.col("_lli").isNotNull()
    d = d.withColumn("_lv", F.when(has_local, F.col("_llv")).otherwise(F.col("_carry.v"))) \
         .withColumn("_li", F.when(has_local, F.col("_lli") + F.col("_off")).otherwise(F.col("_carry.i")))
    return d.drop("_val", "_chunk", "_lidx", "_llv", "_lli", "_off", "_carry")


def fill_down(df: DataFrame, col: str, partition: list, order: list,
              chunk: Column | None = None, out: str | None = None) -> DataFrame:
    """Replace NULL by the last non-NULL value above it (within ``partition``)."""
    out = out or col
    d = _scan_last(df, F.col(col), partition, order, chunk)
    return d.withColumn(out, F.col("_lv")).drop("_gidx", "_lv", "_li")


def fill_increment(df: DataFrame, col: str, partition: list, order: list,
                   chunk: Column | None = None, out: str | None = None) -> DataFrame:
    """NULL -> previous value + 1, chaining (session numbers within a assembly)."""
    out = out or col
    d = _scan_last(df, F.col(col), partition, order, chunk)
    return d.withColumn(out, F.col("_lv") + (F.col("_gidx") - F.col("_li"))).drop("_gidx", "_lv", "_li")


def block_after_marker(df: DataFrame, partition: list, order: list, marker: Column,
                       k: int, out: str = "offset", chunk: Column | None = None) -> DataFrame:
    """Rows 0..k after the latest marker row (the marker row has offset 0)."""
    d = _scan_last(df, F.when(marker, F.lit(1)), partition, order, chunk)
    d = d.withColumn(out, F.col("_gidx") - F.col("_li"))
    return d.filter(F.col(out).between(0, k)).drop("_gidx", "_lv", "_li")


def islands(df: DataFrame, partition: list, order_col: str, gap: int = 1,
            out: str = "island", chunk: Column | None = None) -> DataFrame:
    """Number runs of ``order_col`` without a jump larger than ``gap``.

    ``break`` marks a row whose value exceeds the previous one by more than
    ``gap`` (``which(pos > lag(pos) + 1)``); the island id is the running
    count of breaks, starting at 0.
    """
    oc = F.col(order_col)
    if chunk is None:
        w = _w(partition, [order_col])
        d = df.withColumn("_prev", F.lag(oc).over(w))
        d = d.withColumn("is_break", F.coalesce(oc > F.col("_prev") + gap, F.lit(False)))
        return d.withColumn(out, F.sum(F.col("is_break").cast("int")).over(w.rowsBetween(_UNB, 0))) \
                .drop("_prev")
    keys = list(partition)
    d = df.withColumn("_chunk", chunk)
    w = _w(keys + ["_chunk"], [order_col])
    d = d.withColumn("_prev", F.lag(oc).over(w))
    summ = d.groupBy(*keys, "_chunk").agg(F.max(oc).alias("_cmax"), F.min(oc).alias("_cmin"))
    wc = _w(keys, ["_chunk"])
    summ = summ.withColumn("_pmax", F.lag("_cmax").over(wc))
    # break at the first row of a chunk depends on the previous chunk's maximum
    summ = summ.withColumn("_first_break", F.coalesce(F.col("_cmin") > F.col("_pmax") + gap, F.lit(False)))
    d = d.join(summ.select(*keys, "_chunk", "_pmax"), [*keys, "_chunk"], "left")
    d = d.withColumn("_prev", F.coalesce("_prev", "_pmax"))
    d = d.withColumn("is_break", F.coalesce(oc > F.col("_prev") + gap, F.lit(False)))
    d = d.withColumn("_lrun", F.sum(F.col("is_break").cast("int")).over(w.rowsBetween(_UNB, 0)))
    cnt = d.groupBy(*keys, "_chunk").agg(F.sum(F.col("is_break").cast("int")).alias("_cb"))
    cnt = cnt.withColumn("_carry", F.coalesce(F.sum("_cb").over(wc.rowsBetween(_UNB, -1)), F.lit(0)))
    d = d.join(cnt.select(*keys, "_chunk", "_carry"), [*keys, "_chunk"], "left")
    return d.withColumn(out, (F.col("_lrun") + F.col("_carry")).cast("long")) \
            .drop("_prev", "_pmax", "_lrun", "_carry", "_chunk")


def row_index(df: DataFrame, partition: list, order: list, out: str = "idx") -> DataFrame:
    """1-based row number inside each partition (``seq_along``)."""
    return df.withColumn(out, F.row_number().over(_w(partition, order)))


def block_label(df: DataFrame, partition: list, order: list, size: int,
                out: str = "block") -> DataFrame:
    """0-based label of consecutive blocks of ``size`` rows."""
    rn = F.row_number().over(_w(partition, order))
    return df.withColumn(out, F.floor((rn - 1) / size).cast("int"))


def rank_first(df: DataFrame, partition: list, order: list, out: str = "rank") -> DataFrame:
    """``rank(ties.method = 'first')``: ties resolved by the given tie keys."""
    return df.withColumn(out, F.row_number().over(_w(partition, order)))


def keep_group_max(df: DataFrame, partition: list, col: str) -> DataFrame:
    """Rows equal to the group maximum of ``col`` (ties all kept).

    Computed as a partial aggregate joined back instead of a window, so a hot
    group is reduced map-side and the join back can be split by AQE.
    """
    m = df.groupBy(*partition).agg(F.max(col).alias("_m"))
    return df.join(m, list(partition)).filter(F.col(col) == F.col("_m")).drop("_m")


def group_extremes(df: DataFrame, partition: list, col: str, lo: str = "lo",
                   hi: str = "hi") -> DataFrame:
    """Group min / max attached to every row (aggregate + join back)."""
    m = df.groupBy(*partition).agg(F.min(col).alias(lo), F.max(col).alias(hi))
    return df.join(m, list(partition))


def duplicate_rows(df: DataFrame, keys: list[str], out: str = "n_dup") -> DataFrame:
    """Rows whose key occurs more than once, with the key's count
    (partial aggregate + join back, skew-safe)."""
    dup = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).filter(F.col(out) > 1)
    return df.join(dup, keys)


def keep_flagged_twins(df: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """Where a key has a flagged row, keep only flagged rows; else keep all."""
    m = df.groupBy(*keys).agg(F.max(F.col(flag).cast("int")).alias("_m"))
    return df.join(m, keys).filter((F.col(flag).cast("int") == 1) | (F.col("_m") == 0)).drop("_m")


def rows_between(df: DataFrame, pos: str, first: int, last: int) -> DataFrame:
    """Row-range slice by a position column (inclusive, fixed positions)."""
    return df.filter(F.col(pos).between(first, last))
