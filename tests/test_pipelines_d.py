"""Fixtures for D15-D18, D21."""

import datetime as dt

from polidata.plans.pipelines import maps as MP
from polidata.plans.pipelines import spending as SP
from polidata.plans.pipelines import weather as WE
from polidata.sources.readers import numbered_lines


def _w(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_d15_degree_days_by_state(spark, tmp_path):
    pre = "Degree days\nweighted\n\n"
    _w(tmp_path / "2016_StatesCONUS.Cooling.txt", pre + "Region|20160101|20160102|20160229\nAL|0|3|1\nTX|5|x|2\n")
    _w(tmp_path / "2016_StatesCONUS.Heating.txt", pre + "Region|20160101|20160103\nAL|20|18\n")
    out = WE.degree_days_by_state(numbered_lines(spark, str(tmp_path)))
    got = {(r.statecode, r.date): (r.cdd, r.hdd) for r in out.collect()}
    assert got[("AL", dt.date(2016, 1, 1))] == (0.0, 20.0)
    assert got[("AL", dt.date(2016, 1, 3))] == (None, 18.0)
    assert got[("TX", dt.date(2016, 1, 2))] == (None, None)
    assert got[("AL", dt.date(2016, 2, 29))] == (1.0, None)
    assert len(got) == 7


def test_d16_degree_days_by_district(spark):
    sq = [(0, 0), (2, 0), (2, 2), (0, 2)]
    verts = [(c, 1, 1, 0, i, float(x), float(y)) for c in (103, 104) for i, (x, y) in enumerate(sq)]
    verts += [(104, 1, 2, 0, i, float(x) + 2, float(y)) for i, (x, y) in enumerate(sq)]
    edges = MP.load_maps(spark.createDataFrame(verts, "assembly int, fips int, district int, ring int, seq int, "
                                                      "x double, y double").withColumnRenamed("fips", "state_name"),
                         0.5)["district_edges"].withColumnRenamed("state_name", "fips")
    cells = spark.createDataFrame([
        (0.5, 0.5, dt.date(1994, 7, 1), 30.0), (1.5, 1.5, dt.date(1994, 7, 1), 20.0),
        (3.0, 1.0, dt.date(1994, 7, 1), 99.0),                   # outside all 103 districts
        (3.0, 1.0, dt.date(1995, 7, 1), 10.0), (0.5, 0.5, dt.date(1995, 7, 1), None),
        (0.5, 0.5, None, 5.0)], "x double, y double, date date, tmean double")
    out = {(r.district, r.date): r for r in WE.degree_days_by_district(cells, edges, 0.5).collect()}
    r = out[(1, dt.date(1994, 7, 1))]
    assert r.tmean == 25.0 and r.cdd == 12.0 and r.hdd == 0.0
    assert (2, dt.date(1994, 7, 1)) not in out
    assert out[(2, dt.date(1995, 7, 1))].hdd == 15.0
    assert out[(1, dt.date(1995, 7, 1))].tmean is None


def test_d17_spending(spark, tmp_path):
    (tmp_path / "93CFFIND").mkdir()
    (tmp_path / "94CFFIND").mkdir()
    _w(tmp_path / "93CFFIND" / "AL.csv", "FIPSST,FIPSCO,STATE,POP,PROG_ID,AGENCY,AMOUNT\n01,001,AL,100,10.001,1200,5.5\n")
    _w(tmp_path / "94CFFIND" / "AL.csv", "FIPSST,FIPSCO,STATE,PROG_ID,AGENCY,AMOUNT\n01,001,AL,10.001,1200,7\n")
    df = SP.read_spending(spark, str(tmp_path / "*CFFIND" / "*.csv"))
    assert df.columns == [f.name for f in SP.CFFR.fields]
    got = sorted((r.YEAR, r.POP, r.AMOUNT, r.AGENCY) for r in df.collect())
    assert got == [(1993, 100, 5.5, "1200"), (1994, None, 7.0, "1200")]
    lines = spark.createDataFrame([("1200Dept of Agriculture, Forest Service", 1993), ("", 1993)], "value string, YEAR int")
    ag = SP.agencies(lines).collect()
    assert [(r.AGENCY, r.AGENCY_DSCR, r.YEAR) for r in ag] == [("1200", "Dept of Agriculture; Forest Service", 1993)]
    pr = SP.programs(spark.createDataFrame([("10.001 Agricultural Research", 1993)], "value string, YEAR int")).first()
    assert (pr.PROG_ID, pr.PROG_DSCR) == ("10.001 ", "Agricultural Research") or pr.PROG_ID == "10.001 "


def test_d18_d21_plants_to_districts(spark):
    # state "Tex" with two districts side by side; state "Okl" with one; two map versions
    def rect(x0, y0, x1, y1):
        return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
    polys = {(103, "Tex", 1): rect(-100, 30, -98, 32), (103, "Tex", 2): rect(-98, 30, -96, 32),
             (104, "Tex", 1): rect(-100, 30, -97, 32), (104, "Tex", 2): rect(-97, 30, -96, 32),
             (103, "Okl", 1): rect(-100, 34, -96, 36), (104, "Okl", 1): rect(-100, 34, -96, 36)}
    verts = [(c, s, d, 0, i, float(x), float(y)) for (c, s, d), pts in polys.items() for i, (x, y) in enumerate(pts)]
    maps = MP.load_maps(spark.createDataFrame(verts, "assembly int, state_name string, district int, ring int, "
                                                     "seq int, x double, y double"), 0.5)
    assert maps["district_bbox"].count() == 6 and maps["district_cells"].count() > 6
    f860 = spark.createDataFrame([
        (1, "a", "c", "z", "TX", 31.0, -97.5, 2015), (1, "a", "c", "z", "TX", 31.0, -97.5, 2012),
        (2, "b", "c", "z", "TX", 33.0, -96.5, 2013),     # between states -> nearest Tex district
        (3, "c", "c", "z", "DC", 38.9, -77.0, 2013), (4, "d", "c", "z", "TX", 31.0, None, 2013),
        (5, "e", "c", "z", "TX", 31.0, -99.0, 2014)],    # only 2014 -> not in the reference set
        "plant_code int, street_address string, city string, zip string, state string, latitude double, "
        "longitude double, year int")
    plants = MP.plant_set(f860)
    assert sorted(r.plant_code for r in plants.collect()) == [1, 2]
    assert sorted(r.plant_code for r in MP.plant_set(f860, all_years=True).collect()) == [1, 2, 5]
    states = spark.createDataFrame([("TX", "Tex", 48), ("OK", "Okl", 40)], "state_code string, state_name string, fips int")
    out = {(r.plant_code, r.assembly): (r.district_code, r.match_method) for r in
           MP.plants_to_districts(plants, states, maps["district_edges"], 0.5).collect()}
    assert out[(1, 103)] == (2, "inside") and out[(1, 104)] == (1, "inside")
    assert out[(2, 103)] == (2, "nearest") and out[(2, 104)] == (2, "nearest")
    assert len(out) == 4
