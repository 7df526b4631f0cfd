"""D17 federal spending records with agency and program dictionaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polidata.functions.columns import ensure_columns
from polidata.sources.readers import read_csv_by_header, sanitize_delimiter

# Declared schema of the spending table (column order is canonical).
CFFR = T.StructType([T.StructField(n, t) for n, t in [
    ("FIPSST", T.StringType()), ("FIPSCO", T.StringType()), ("FIPSPLAC", T.StringType()), ("STATE", T.StringType()),
    ("COUNTY", T.StringType()), ("PLACE", T.StringType()), ("POP", T.LongType()), ("CONGDIST", T.StringType()),
    ("PROG_ID", T.StringType()), ("OBJ_TYPE", T.StringType()), ("AGENCY", T.StringType()),
    ("AMOUNT", T.DoubleType()), ("YEAR", T.IntegerType())]])


def read_spending(spark: SparkSession, paths) -> DataFrame:
    """State CSV files of every year (header on every file, some without POP);
    YEAR from the two-digit folder prefix (93CFFIND -> 1993)."""
    cols = [f.name for f in CFFR.fields if f.name != "YEAR"]
    # a header line is the one naming the FIPSST field, wherever it sits
    raw = read_csv_by_header(spark, paths, r"(^|,)\s*FIPSST\s*(,|$)", cols)
    yy = F.regexp_extract("file_path", r"(\d{2})CFFIND/", 1).cast("int")
    raw = raw.withColumn("YEAR", F.when(yy >= 50, yy + 1900).otherwise(yy + 2000)).drop("file_path")
    return spending_table(raw)


def spending_table(raw: DataFrame) -> DataFrame:
    """Add missing columns as NULL, cast by name to the declared schema."""
    for f in CFFR.fields:
        if f.name in raw.columns and f.dataType != T.StringType():
            raw = raw.withColumn(f.name, F.col(f.name).try_cast(f.dataType))
    return ensure_columns(raw, CFFR)


def dictionary(lines: DataFrame, code_width: int, code: str, descr: str) -> DataFrame:
    """Fixed-width dictionary lines (value, YEAR) -> (code, description, YEAR);
    commas in descriptions become ';' as in the delimited load."""
    v = sanitize_delimiter(F.col("value"))
    return lines.select(F.substring(v, 1, code_width).alias(code),
                        F.trim(F.substring(v, F.lit(code_width + 1), F.length(v))).alias(descr),
                        F.col("YEAR").cast("int").alias("YEAR")).filter(F.length(F.col(code)) > 0)


def agencies(lines: DataFrame) -> DataFrame:
    return dictionary(lines, 4, "AGENCY", "AGENCY_DSCR")


def programs(lines: DataFrame) -> DataFrame:
    return dictionary(lines, 7, "PROG_ID", "PROG_DSCR")
