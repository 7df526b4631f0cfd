"""D15 degree days by state, D16 degree days by district from grid cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polidata.functions.civics import assembly_of_year, cooling_degree_days, heating_degree_days
from polidata.functions.dates import compact_date
from polidata.operators.geo import point_in_polygon
from polidata.sources.readers import wide_text_to_long


def degree_days_by_state(lines: DataFrame, preamble: int = 3) -> DataFrame:
    """Pipe-delimited daily files (one column per yyyymmdd, 'Region' rows)
    -> dd_st(statecode, date, cdd, hdd); cooling/heating from the file name;
    full outer join so a date present in one file only keeps a NULL side."""
    long = wide_text_to_long(lines, preamble, "|", key="statecode")
    long = long.withColumns({"date": compact_date(F.col("name")), "deg_days": F.col("value").try_cast("double"),
                             "kind": F.when(F.lower("file_path").contains("cooling"), "cdd")
                             .when(F.lower("file_path").contains("heating"), "hdd")})
    long = long.filter(F.col("date").isNotNull())
    cdd = long.filter(F.col("kind") == "cdd").select("statecode", "date", F.col("deg_days").alias("cdd"))
    hdd = long.filter(F.col("kind") == "hdd").select("statecode", "date", F.col("deg_days").alias("hdd"))
    return cdd.join(hdd, ["statecode", "date"], "full")


def degree_days_by_district(cells: DataFrame, edges: DataFrame, cell_size: float) -> DataFrame:
    """Daily grid cells (x, y, date, tmean in Celsius) + district edge tables
    for every assembly -> dd_cd(fips, district, date, tmean, cdd, hdd).

    The map of a date is the assembly in session in its year; membership is
    computed once per distinct cell centre and map, then joined to the daily
    values.  Invalid dates (29 Feb outside leap years) arrive as NULL and go."""
    pts = cells.select("x", "y").distinct().withColumn("pid", F.concat_ws(",", F.col("x").cast("string"),
                                                                            F.col("y").cast("string")))
    member = point_in_polygon(pts, edges, ["assembly", "fips", "district"], cell_size, pid="pid")
    member = member.join(pts, "pid").drop("pid")
    v = cells.filter(F.col("date").isNotNull()).withColumn("assembly", assembly_of_year(F.year("date")))
    j = v.join(member, ["x", "y", "assembly"])
    out = j.groupBy("fips", "district", "date").agg(F.avg("tmean").alias("tmean"))
    return out.withColumns({"cdd": cooling_degree_days(F.col("tmean")), "hdd": heating_degree_days(F.col("tmean"))})
