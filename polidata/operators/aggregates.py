"""Aggregations beyond plain groupBy: collapses, arg-min, exact box statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def collapse(df: DataFrame, keys: list[str], col: str, order: list[str] | None = None,
             sep: str = ",", out: str | None = None) -> DataFrame:
    """Group values joined into one string in ``order`` (``str_c(collapse=)``).

    The values of one group are held by one task, so apply it to bounded
    groups (e.g. after a ``distinct`` on (key, value))."""
    out = out or col
    order = order or [col]
    pairs = F.collect_list(F.struct(*[F.col(o) for o in order], F.col(col).cast("string").alias("_v")))
    return df.groupBy(*keys).agg(
        F.array_join(F.transform(F.array_sort(pairs), lambda s: s["_v"]), sep).alias(out))


def collapse_repeated(values: Column, sep: str = ",") -> Column:
    """Array -> its single value if all elements are equal, else all joined."""
    return F.when(F.size(F.array_distinct(values)) == 1, F.get(values, 0)) \
            .otherwise(F.array_join(values, sep))


def arg_min(df: DataFrame, keys: list[str], value: str, by: str, tiebreak: list[str],
            out: str | None = None) -> DataFrame:
    """``value`` of the row with the smallest ``by`` (first on ties by ``tiebreak``)."""
    out = out or value
    ordk = F.struct(F.col(by), *[F.col(t) for t in tiebreak])
    return df.groupBy(*keys).agg(F.min_by(F.col(value), ordk).alias(out), F.min(by).alias(f"min_{by}"))


def largest(df: DataFrame, keys: list[str], value: str, by: str, tiebreak: list[str]) -> DataFrame:
    ordk = F.struct(F.col(by), *[F.col(t) for t in tiebreak])
    return df.groupBy(*keys).agg(F.max_by(F.col(value), ordk).alias(value), F.max(by).alias(f"max_{by}"))


def top2_wide(df: DataFrame, keys: list[str], rank: str, fields: list[str]) -> DataFrame:
    """Long ranked rows -> one row per key with ``<field>_1`` and ``<field>_2``
    (conditional aggregation; replaces a self join of rank 1 with rank 2)."""
    aggs = []
    for f in fields:
        for r in (1, 2):
            aggs.append(F.max(F.when(F.col(rank) == r, F.col(f))).alias(f"{f}_{r}"))
    return df.groupBy(*keys).agg(*aggs)


def top2(df: DataFrame, keys: list[str], value: str, tiebreak: str, fields: list[str]) -> DataFrame:
    """First and second row per group by ``value`` desc, ties by ``tiebreak`` asc.

    One scan: a rank of at most two is a group limit, so every task sends two rows of a group and a hot group is
    never sorted in one task.  Output: keys + ``<f>_1``/``<f>_2`` for f in ``fields`` (NULL when there is no 2nd);
    rows with a NULL key are a group of their own, NULL values come last, a winner that occurs twice is its own runner-up.
    """
    rec = F.struct(F.col(value).alias("_v"), (-F.col(tiebreak)).alias("_t"),
                   *[F.col(f).alias(f) for f in fields])
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("_r").desc()))
    best = df.select(*keys, rec.alias("_r")).withColumn("_k", place).filter(F.col("_k") <= 2)
    out = best.groupBy(*keys).agg(*[F.max(F.when(F.col("_k") == k, F.col("_r"))).alias(f"_r{k}") for k in (1, 2)])
    return out.select(*keys, *[F.col(f"_r1.{f}").alias(f"{f}_1") for f in fields],
                      *[F.col(f"_r2.{f}").alias(f"{f}_2") for f in fields])


def crosstab(df: DataFrame, row: str, col: str, values: list) -> DataFrame:
    """Contingency counts; ``values`` fixes the pivot columns (no extra job)."""
    out = df.groupBy(row).pivot(col, values).count()
    return out.na.fill(0, [str(v) for v in values])


def exact_quantiles(df: DataFrame, keys: list[str], col: str, probs: list[float]) -> DataFrame:
    """Exact linear-interpolated quantiles (``quantile_cont``), NULLs left out.

    Equal values are counted first, so a group enters Spark's exact ``percentile`` as distinct values with
    frequencies: repeated rows of a hot group are merged on the map side.
    Returns keys + ``q_<i>`` columns (i = position in ``probs``).
    """
    counts = df.filter(F.col(col).isNotNull()).groupBy(*keys, F.col(col).alias("_x")).agg(F.count(F.lit(1)).alias("_n"))
    q = counts.groupBy(*keys).agg(F.percentile("_x", F.array(*[F.lit(p) for p in probs]), F.col("_n")).alias("_q"))
    return q.select(*keys, *[F.get("_q", i).alias(f"q_{i}") for i in range(len(probs))])


def box_stats(df: DataFrame, keys: list[str], col: str, coef: float = 1.5) -> DataFrame:
    """Data behind a box plot: quartiles, whisker ends (furthest values within
    ``coef`` IQR of the box) and the number of outliers, per group."""
    q = exact_quantiles(df, keys, col, [0.25, 0.5, 0.75]).toDF(*keys, "q1", "median", "q3")
    q = q.withColumns({"lo_fence": F.col("q1") - coef * (F.col("q3") - F.col("q1")),
                       "hi_fence": F.col("q3") + coef * (F.col("q3") - F.col("q1"))})
    x = F.col(col)
    j = df.filter(x.isNotNull()).select(*keys, x.alias("_x")).join(q, keys)
    inside = F.col("_x").between(F.col("lo_fence"), F.col("hi_fence"))
    agg = j.groupBy(*keys).agg(
        F.min(F.when(inside, F.col("_x"))).alias("whisker_lo"),
        F.max(F.when(inside, F.col("_x"))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"),
        F.count(F.lit(1)).alias("n"))
    return q.join(agg, keys).drop("lo_fence", "hi_fence")
