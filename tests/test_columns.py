from pyspark.sql import functions as F
from pyspark.sql import types as T

from polidata.functions import columns as C


def test_names_ranges_patterns(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "`Plant ID` int, `1997` int, `1998` int, `Net Gen.` int")
    assert C.normalise_names(df).columns == ["plant_id", "1997", "1998", "net_gen"]
    assert C.columns_between(df, "1997", "1998") == ["1997", "1998"]
    assert C.columns_matching(df, r"^\d{4}$") == ["1997", "1998"]
    assert C.columns_matching(df, r"^\d{4}$", exclude=True) == ["Plant ID", "Net Gen."]
    assert C.rename_by_position(df, {0: "pid"}).columns[0] == "pid"
    assert C.rename_by_position(df, ["a", "b", "c", "d"]).columns == ["a", "b", "c", "d"]


def test_mutate_and_unite_separate(spark):
    df = spark.createDataFrame([(" a ", " b ", 1)], "x string, y string, n int")
    out = C.mutate_if(df, T.StringType, F.trim).first()
    assert (out.x, out.y, out.n) == ("a", "b", 1)
    u = C.unite(df.select(F.lit("TX").alias("st"), F.lit(4).alias("d"), F.lit(2012).alias("y")), "id", ["st", "d", "y"])
    assert u.first().id == "TX_4_2012"
    s = C.separate(u, "id", ["st", "d", "y"]).first()
    assert (s.st, s.d, s.y) == ("TX", "4", "2012")


def test_ensure_columns_and_drift(spark):
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("pop", T.LongType()),
                           T.StructField("b", T.StringType())])
    df = spark.createDataFrame([("x", 1)], "b string, a int")
    out = C.ensure_columns(df, schema)
    assert out.columns == ["a", "pop", "b"] and out.first().pop is None
    d = C.schema_drift(df, spark.createDataFrame([(1,)], "c int"))
    assert sorted(map(tuple, d.collect())) == [("a", "left_only"), ("b", "left_only"), ("c", "right_only")]
