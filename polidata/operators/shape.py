"""Reshape and set operators: wide <-> long, column-group stacking, unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot(df: DataFrame, ids: list[str], values: list[str], var: str = "variable",
            value: str = "value", drop_nulls: bool = False) -> DataFrame:
    """Wide -> long (``gather``).  NULL cells are kept unless ``drop_nulls``.

    The value columns are cast to one common type first, so mixed numeric
    columns unpivot without an analysis error.
    """
    if not values:
        raise ValueError("no value columns")
    out = df.unpivot(ids, values, var, value)
    return out.filter(F.col(value).isNotNull()) if drop_nulls else out


def unpivot_all_but(df: DataFrame, ids: list[str], var: str = "variable",
                    value: str = "value") -> DataFrame:
    return unpivot(df, ids, [c for c in df.columns if c not in ids], var, value)


def stack_groups(df: DataFrame, ids: list[str], groups: dict[str, dict[str, Column | str]],
                 label: str = "group") -> DataFrame:
    """Stack repeated column groups into rows (one row per group per input row).

    ``groups = {"D": {"name": "DemCandidate", "votes": "DemVotes"}, ...}``.
    The group order is kept in ``<label>_order`` (1-based, the bind order).
    """
    fields = list(next(iter(groups.values())).keys())
    structs = []
    for i, (g, cols) in enumerate(groups.items(), start=1):
        parts = [F.lit(g).alias(label), F.lit(i).alias(f"{label}_order")]
        for f in fields:
            c = cols[f]
            parts.append((F.col(c) if isinstance(c, str) else c).alias(f))
        structs.append(F.struct(*parts))
    return (df.select(*ids, F.explode(F.array(*structs)).alias("_g"))
              .select(*ids, "_g.*"))


def union_fill(dfs: list[DataFrame]) -> DataFrame:
    """``bind_rows``: union by name, missing columns as NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_by_position(dfs: list[DataFrame], names: list[str] | None = None) -> DataFrame:
    """Force the first frame's (or the given) names on every frame, then union."""
    names = names or dfs[0].columns
    return reduce(lambda a, b: a.union(b), [d.toDF(*names) for d in dfs])


def replicate(df: DataFrame, n: str | Column, index: str = "rep") -> DataFrame:
    """``rep(x, n)``: each row ``n`` times (0 or NULL -> no row), 1-based index."""
    n = F.col(n) if isinstance(n, str) else n
    return (df.withColumn("_n", n.cast("int")).filter(F.col("_n") > 0)
              .withColumn(index, F.explode(F.sequence(F.lit(1), F.col("_n")))).drop("_n"))


def split_to_rows(df: DataFrame, col: str, sep_regex: str, out: str | None = None,
                  keep_pos: bool = False) -> DataFrame:
    """Delimited cell -> one row per trimmed non-empty piece."""
    out = out or col
    pieces = F.filter(F.transform(F.split(F.col(col), sep_regex), lambda x: F.trim(x)),
                      lambda x: x != "")
    if keep_pos:
        rest = [c for c in df.columns if c != col]
        return df.select(*rest, F.posexplode(pieces).alias(f"{out}_pos", out))
    return df.withColumn(out, F.explode(pieces)) if out == col else \
        df.select("*", F.explode(pieces).alias(out))


def zip_positional(df: DataFrame, left: str, right: str, pos: str = "pos") -> DataFrame:
    """Pair element i of array ``left`` with element i of array ``right``."""
    rest = [c for c in df.columns if c not in (left, right)]
    z = F.arrays_zip(F.col(left).alias(left), F.col(right).alias(right))
    return df.select(*rest, F.posexplode(z).alias(pos, "_z")).select(*rest, pos, f"_z.{left}", f"_z.{right}")


def set_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of ``a`` missing from ``b`` and vice versa (multiset, both ways),
    tagged by side; an empty result means the two tables are equal."""
    return (a.exceptAll(b).withColumn("side", F.lit("left_only"))
             .unionByName(b.exceptAll(a).withColumn("side", F.lit("right_only"))))
