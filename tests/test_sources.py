import os
import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

from polidata.sources import readers as R
from polidata.sources import writers as Wr

SCHEMA = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.DoubleType())])


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_csv_after_preamble_and_tags(spark, tmp_path):
    _write(tmp_path / "races_2012.csv", "Report\nGenerated x\na,b\nx,1.5\ny,N/A\n")
    _write(tmp_path / "races_2014.csv", "Report\nGenerated y\na,b\nz,2\n")
    df = R.read_csv_after_preamble(spark, str(tmp_path), SCHEMA, preamble=2)
    df = df.withColumn("year", F.regexp_substr("file_path", F.lit(r"\d{4}")).cast("int"))
    got = sorted((r.a, r.b, r.year) for r in df.collect())
    assert got == [("x", 1.5, 2012), ("y", None, 2012), ("z", 2.0, 2014)]


def test_csv_dropping_and_strip_number(spark, tmp_path):
    _write(tmp_path / "s.tsv", "# comment\na\tb\nu\t12.5 %\n")
    sch = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])
    df = R.read_csv_dropping(spark, str(tmp_path / "s.tsv"), sch, drop_regex="^#", header_regex=r"^a\tb$", sep="\t")
    assert [(r.a, r.b) for r in df.select("a", R.strip_to_number(F.col("b")).alias("b")).collect()] == [("u", 12.5)]


def test_fixed_width_and_repeating_group(spark):
    rec = "00042AB1989" + "".join(f"{g:>5}{c:>3}" for g, c in [(10, 1), (-5, 2), ("", "")])
    df = spark.createDataFrame([(rec,)], "line string")
    head = R.fixed_width(F.col("line"), [("plant", 1, 5, "int"), ("fuel", 6, 2, "string"), ("year", 8, 4, "int")])
    grp = R.repeating_group(F.col("line"), 12, 3, [("gen", 0, 5, "double"), ("con", 5, 3, "int")])
    rows = df.select(*head, F.explode(grp).alias("m")).select("plant", "fuel", "year", "m.*").collect()
    assert [(r.plant, r.fuel, r.year, r.month, r.gen, r.con) for r in rows] == [
        (42, "AB", 1989, 1, 10.0, 1), (42, "AB", 1989, 2, -5.0, 2), (42, "AB", 1989, 3, None, None)]


def test_html_extraction(spark):
    html = ('<ul><li><a href="/roll-call-vote-1">Vote 1</a></li><li>Plain <b>item</b></li></ul>'
            '<a href="http://x">ext</a><h3>Retired (3 House; 1 Senate)</h3>')
    df = spark.createDataFrame([(1, html)], "id int, html string")
    links = df.select(F.explode(R.html_links(F.col("html"), "/roll")).alias("l")).collect()
    assert [(r.l.href, r.l.text) for r in links] == [("/roll-call-vote-1", "Vote 1")]
    items = df.select(F.transform(R.html_elements(F.col("html"), "li"), R.strip_tags).alias("i")).first().i
    assert items == ["Vote 1", "Plain item"]


def test_detect_header(spark):
    rows = [(1, 0, ["Form", ""]), (1, 1, ["note"]), (1, 2, ["State", "Plant ID", "MW"]), (1, 3, ["TX", "7", "5"]),
            (2, 0, ["plant id"]), (2, 1, ["9"]), (3, 0, ["nothing"])]
    df = spark.createDataFrame(rows, "doc int, idx int, cells array<string>")
    out = R.detect_header(df, ["doc"], "idx", "cells", "plant id")
    assert sorted((r.doc, r.idx, r.hdr_idx, r.hdr_col) for r in out.collect()) == [(1, 3, 2, 2), (2, 1, 0, 1)]


def test_nested_json(spark, tmp_path):
    _write(tmp_path / "leg.json", '[{"name": {"first": "A"}, "id": {"govtrack": 1}, '
                                  '"terms": [{"type": "rep", "start": "2001-01-03"}, {"type": "sen"}]}]')
    sch = T.StructType([
        T.StructField("name", T.StructType([T.StructField("first", T.StringType())])),
        T.StructField("id", T.StructType([T.StructField("govtrack", T.LongType())])),
        T.StructField("terms", T.ArrayType(T.StructType([T.StructField("type", T.StringType()),
                                                         T.StructField("start", T.StringType())])))])
    df = R.read_json_nested(spark, str(tmp_path / "leg.json"), sch)
    rows = df.select("id.govtrack", F.explode("terms").alias("t")).select("govtrack", "t.*").collect()
    assert [(r.govtrack, r.type, r.start) for r in rows] == [(1, "rep", "2001-01-03"), (1, "sen", None)]


def test_writers_roundtrip_and_pick(spark, tmp_path):
    df = spark.createDataFrame([(1, 2000, 1.0), (2, 2001, 2.0), (3, 2001, 3.0)], "k int, year int, v double")
    base = str(tmp_path / "t")
    Wr.write_partitions(df, base, ["year"])
    Wr.write_partitions(df.filter("year = 2001"), base, ["year"])
    assert spark.read.parquet(base).count() == 3
    Wr.write_append(df.filter("year = 2000"), base, ["year"])
    assert spark.read.parquet(base).count() == 4
    tgt = spark.createDataFrame([], "v double, k long")
    assert Wr.insert_by_name(df, tgt).columns == ["v", "k"]
    listing = R.list_files(spark, base, "*.parquet")
    assert listing.count() >= 3
    assert R.pick_file(listing).first().path.endswith(".parquet")
    assert Wr.scratch_dir(spark, "x").startswith(spark.sparkContext.getCheckpointDir())


def test_save_bundle(spark, tmp_path):
    a = spark.createDataFrame([(1,)], "x int")
    Wr.save_bundle({"house_races": a, "senate_races": a.withColumn("y", F.lit(2))}, str(tmp_path / "b"))
    assert spark.read.parquet(str(tmp_path / "b" / "senate_races")).columns == ["x", "y"]
    assert os.path.isdir(tmp_path / "b" / "house_races")


def test_tag_from_path(spark, tmp_path):
    _write(tmp_path / "hou_2014.csv", "a,b\nx,1\n")
    df = R.read_csv(spark, str(tmp_path), SCHEMA, glob="*.csv")
    assert R.tag_from_path(df, r"\d{4}", "raceYear", "int").first().raceYear == 2014


def test_lines_of_split_files_are_numbered(spark, tmp_path):
    """Files cut into many splits: the same numbers as reading each file from its start, whatever the line ends."""
    rnd = random.Random(9)
    want = {}
    for name, end, n in (("a", "\n", 400), ("b", "\r\n", 250), ("c", "\n", 1), ("d", "\n", 0)):
        lines = ["x" * rnd.randint(0, 30) + str(i) * rnd.randint(0, 2) for i in range(n)]
        (tmp_path / f"{name}.txt").write_text(end.join(lines) + (end if n and name != "a" else ""), newline="")
        want |= {(name, i): x for i, x in enumerate(lines)}
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size, cost in (("100", "0"), ("700", "10"), ("128m", "4m")):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", cost)
            df = R.numbered_lines(spark, str(tmp_path))
            rows = [((r.file_path.rsplit("/", 1)[1][0], r.line_no), r.line) for r in df.collect()]
            assert len(rows) == len(want) and dict(rows) == want
            if size == "100":
                assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_preamble_and_header_of_each_split_file(spark, tmp_path):
    for name, n in (("a", 300), ("b", 80)):
        (tmp_path / f"{name}.csv").write_text("about, this\n\nid,v\n" + "".join(f"{i},{name}{i}\n" for i in range(n)))
    held = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        got = R.read_csv_after_preamble(spark, str(tmp_path), "id int, v string", preamble=2).collect()
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert sorted((r.v, r.id, r.line_no) for r in got) == sorted((f"{f}{i}", i, i + 3) for f, n in (("a", 300), ("b", 80)) for i in range(n))
