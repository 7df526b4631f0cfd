"""Access to the warehouse tables of one scale-factor directory."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(name)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def years_of(df: DataFrame, column: str) -> list[int]:
    """The calendar years of a date column, ascending: the columns of a yearly sheet (a few numbers, from one scan)."""
    years = df.select(F.year(column).alias("y")).filter(F.col("y").isNotNull()).distinct()
    return sorted(r.y for r in years.collect())
