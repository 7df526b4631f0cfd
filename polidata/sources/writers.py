"""Sinks: append, re-run-safe partition overwrite, insert by name, bundles."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polidata.session import checkpoint_dir


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint directory (never node-local)."""
    return os.path.join(checkpoint_dir(spark), f"polidata-{label}-{uuid.uuid4().hex[:12]}")


def write_append(df: DataFrame, path: str, partition_by: list[str] | None = None, fmt: str = "parquet",
                 **options) -> None:
    """K1.  Plain append (the reference's behaviour)."""
    w = df.write.mode("append").format(fmt).options(**options)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_partitions(df: DataFrame, path: str, partition_by: list[str], fmt: str = "parquet",
                     **options) -> None:
    """K1 re-run safe: replace only the partitions present in ``df``."""
    df.write.mode("overwrite").format(fmt).option("partitionOverwriteMode", "dynamic") \
        .options(**options).partitionBy(*partition_by).save(path)


def write_overwrite(df: DataFrame, path: str, fmt: str = "parquet", **options) -> None:
    """K2 / K4: drop and recreate."""
    df.write.mode("overwrite").format(fmt).options(**options).save(path)


def insert_by_name(df: DataFrame, target: DataFrame) -> DataFrame:
    """K3: align ``df`` to the target's columns by name (never by position)."""
    missing = [c for c in target.columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing for insert: {missing}")
    return df.select(*[F.col(c).cast(t) for c, t in target.dtypes])


def save_bundle(frames: dict[str, DataFrame], directory: str) -> None:
    """K5: one Parquet folder per named result."""
    for name, d in frames.items():
        d.write.mode("overwrite").parquet(os.path.join(directory, name))
