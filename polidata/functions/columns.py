"""Column-set plumbing: name normalisation, ranges, patterns, type-driven maps."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def norm_name(name: str) -> str:
    """Lower case, runs of blanks/dots/dashes -> '_', other punctuation kept."""
    s = name.strip().lower()
    s = re.sub(r"[\s.\-/]+", "_", s)
    return s.strip("_")


def normalise_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[norm_name(c) for c in df.columns])


def rename_by_position(df: DataFrame, names: dict[int, str] | list[str]) -> DataFrame:
    cols = list(df.columns)
    if isinstance(names, list):
        if len(names) != len(cols):
            raise ValueError(f"{len(names)} names for {len(cols)} columns")
        return df.toDF(*names)
    for i, n in names.items():
        cols[i] = n
    return df.toDF(*cols)


def columns_between(df: DataFrame, first: str, last: str) -> list[str]:
    """``first:last`` column range by name (inclusive)."""
    cols = df.columns
    i, j = cols.index(first), cols.index(last)
    return cols[i:j + 1]


def columns_matching(df: DataFrame, pattern: str, exclude: bool = False) -> list[str]:
    rx = re.compile(pattern)
    return [c for c in df.columns if bool(rx.search(c)) != exclude]


def ensure_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add missing columns as typed NULL and order to the canonical schema."""
    have = set(df.columns)
    out = df
    for f in schema.fields:
        if f.name not in have:
            out = out.withColumn(f.name, F.lit(None).cast(f.dataType))
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def mutate_at(df: DataFrame, cols: Iterable[str], fn: Callable[[Column], Column]) -> DataFrame:
    return df.withColumns({c: fn(F.col(c)) for c in cols})


def mutate_if(df: DataFrame, dtype: type, fn: Callable[[Column], Column]) -> DataFrame:
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, dtype)]
    return mutate_at(df, cols, fn)


def unite(df: DataFrame, new: str, cols: list[str], sep: str = "_", drop: bool = True) -> DataFrame:
    out = df.withColumn(new, F.concat_ws(sep, *[F.col(c).cast("string") for c in cols]))
    return out.drop(*cols) if drop else out


def separate(df: DataFrame, col: str, into: list[str], sep: str = "_", drop: bool = True) -> DataFrame:
    parts = F.split(F.col(col), re.escape(sep), len(into))
    out = df.withColumns({n: F.get(parts, i) for i, n in enumerate(into)})
    return out.drop(col) if drop and col not in into else out


def schema_drift(a: DataFrame, b: DataFrame) -> DataFrame:
    """Columns present in one frame but not the other (U7), as a tiny frame."""
    sa, sb = set(a.columns), set(b.columns)
    rows = [(c, "left_only") for c in sorted(sa - sb)] + [(c, "right_only") for c in sorted(sb - sa)]
    return a.sparkSession.createDataFrame(rows, "column string, side string")
