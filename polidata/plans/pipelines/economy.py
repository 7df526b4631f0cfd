"""D1 regional accounts, D2 unemployment and price index."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polidata.functions.columns import normalise_names
from polidata.functions.nullsafe import strict_avg
from polidata.operators.shape import unpivot, union_fill
from polidata.sources.readers import strip_to_number


def _year_cols(df: DataFrame, first: int, last: int) -> list[str]:
    return [c for c in df.columns if re.fullmatch(r"\d{4}", c) and first <= int(c) <= last]


def _long(df: DataFrame, first: int, last: int) -> DataFrame:
    d = df.withColumn("fips", F.substring("GeoFIPS", 1, 2).try_cast("int")).filter(F.col("fips").isNotNull())
    years = _year_cols(d, first, last)
    ids = [c for c in d.columns if not re.fullmatch(r"\d{4}", c)]
    d = d.select(*ids, *[F.col(f"`{y}`").cast("string").alias(y) for y in years])
    long = unpivot(d, ids, years, "year", "value")
    return long.withColumns({"year": F.col("year").cast("int"), "value": F.col("value").try_cast("double")})


def regional_accounts(gsp_naics: DataFrame, gsp_sic: DataFrame, sa1: DataFrame) -> dict[str, DataFrame]:
    """Wide vintages -> bea_gsp (SIC 1963-1996 + NAICS 1997+), bea_gsi, bea_pop."""
    keep = (F.col("fips") != 0) & (F.col("fips") <= 56)
    naics = _long(gsp_naics, 1997, 2100)
    sic = _long(gsp_sic.drop("1997"), 1900, 1996)
    gsp = normalise_names(union_fill([sic, naics])).filter(keep) \
        .withColumn("units", F.lit("millions of current dollars"))
    inc = normalise_names(_long(sa1, 1900, 2100)).withColumnRenamed("table", "series").filter(keep)
    units = F.regexp_replace(F.regexp_substr("description", F.lit(r"\([^()]+\)")), r"[()]", "")
    gsi = inc.filter(F.col("linecode") == 1).withColumns({"units": units, "description": F.lit("Personal income")})
    pop = inc.filter(F.col("linecode") == 2).withColumns({"units": units, "description": F.lit("Population")})
    return {"bea_gsp": gsp, "bea_gsi": gsi, "bea_pop": pop}


def unemployment(series: DataFrame, drop_annual: bool = False) -> DataFrame:
    """bls_unempl: statewide (LASST) unemployment-rate series (measure 03),
    strict yearly mean per state; Puerto Rico (72) out."""
    d = series.filter((F.substring("series_id", 1, 5) == "LASST") & (F.substring("series_id", 20, 1) == "3"))
    if drop_annual:
        d = d.filter(F.col("period") != "M13")
    d = d.withColumns({"fips": F.substring("series_id", 6, 2).cast("int"),
                       "v": strip_to_number(F.col("value").cast("string"))})
    out = d.groupBy("fips", F.col("year").cast("int").alias("year")).agg(strict_avg("v").alias("avg_unempl"))
    return out.filter(F.col("fips") != 72)


def price_index(series: DataFrame, series_id: str | None = None) -> DataFrame:
    """bls_cpi: strict yearly mean over all series (reference), or one series."""
    d = series if series_id is None else series.filter(F.trim("series_id") == series_id)
    d = d.withColumn("v", strip_to_number(F.col("value").cast("string")))
    return d.groupBy(F.col("year").cast("int").alias("year")).agg(strict_avg("v").alias("avg_cpi"))

