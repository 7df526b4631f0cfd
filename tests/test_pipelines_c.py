"""Fixtures for D11-D14, D19, D20."""

from pyspark.sql import functions as F

from polidata.plans.pipelines import energy as EN


def test_d11_utility_patch(spark):
    df = spark.createDataFrame([(95, 6.0, 12.0, 1.0, 2.0, 3.0, None, 5.0, 5.0),
                                (0, 6.0, 13.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0),
                                (1988, 6.0, 14.0, 1.0, 1.0, 1.0, 1.0, None, 1.0)],
                               "year int, fipst double, utilcode double, con01 double, con02 double, gen01 double, "
                               "gen02 double, stk01 double, stk02 double")
    out = {r.year: r for r in EN.patch_utility_form(df).collect()}
    assert out[1995].consumptio == 3.0 and out[1995].netgenerat is None and out[1995].ucode == 12.0
    assert out[1995].utilcode is None
    assert out[2000].consumptio is None and out[2000].utilcode == 13.0   # after 1995: no totals
    assert out[1988].stocks is None and out[1988].utilcode == 14.0 and out[1988].ucode is None
    assert not [c for c in EN.patch_utility_form(df).columns if c[:3] in ("con", "gen", "stk") and c[3:].isdigit()]


def test_d11_nonutility_patch(spark):
    df = spark.createDataFrame([(1990, 1.0, 2.0, 3.0, 4.0, None, None), (1989, None, None, None, None, 7.0, 8.0)],
                               "YEAR int, COAL_CONSUMP double, GAS_CONSUMP double, COAL_GENERAT double, "
                               "GAS_GENERAT double, con double, gen double")
    out = {r.YEAR: (r.consumptio, r.netgenerat) for r in EN.patch_nonutility_form(df).collect()}
    assert out == {1990: (3.0, 7.0), 1989: (7.0, 8.0)}


def test_d11_header_detect_and_vintages(spark):
    cells = spark.createDataFrame([
        (1, 0, ["Form EIA-923", "", ""]), (1, 1, ["", "Plant Id", "Reported Fuel Type Code"]),
        (1, 2, ["", "3", "BIT"]), (1, 3, ["", "7", None]),
        (2, 0, ["Plant ID", "Fuel"]), (2, 1, ["9", "NG"])], "doc int, idx int, cells array<string>")
    long = EN.sheet_from_cells(cells)
    wide = EN.wide_from_long(long, ["plant_id", "reported_fuel_type_code", "fuel"])
    got = sorted((r.doc, r.plant_id, r.reported_fuel_type_code, r.fuel) for r in wide.collect())
    assert got == [(1, "3", "BIT", None), (1, "7", None, None), (2, "9", None, "NG")]
    a = spark.createDataFrame([(1, 2.0)], "`Plant Id` int, `Quantity Jan` double")
    b = spark.createDataFrame([(3, 4.0)], "`Plant ID` int, `Qty Jan` double")
    assert EN.stack_vintages([a, b], by_position=True).columns == ["plant_id", "quantity_jan"]
    assert EN.stack_vintages([a, b]).count() == 2


def test_d12_registry(spark):
    v12 = spark.createDataFrame([(1, "A St", "TX"), (2, "B St", "OH")], "`Plant Code` int, Street string, State string")
    v13 = spark.createDataFrame([(1, "A St", "TX", "x"), (2, "C St", "OH", "y")],
                                "`Plant Code` int, Street string, State string, Sector string")
    out = EN.plant_registry({2012: v12, 2013: v13})
    assert out["eia_f860"].count() == 4 and "sector" in out["eia_f860"].columns
    assert [r.column for r in out["schema_drift"].collect()] == ["sector"]
    assert [r.plant_code for r in out["unstable_plants"].collect()] == [2]


def test_d13_state_tables(spark):
    rows = [("Texas", 0, "Net generation", None, None), ("Texas", 1, "..Electric utilities", "10", "11"),
            ("Texas", 2, "..IPP", "1", None), ("Texas", 3, "..CHP", "2", "2"), ("Texas", 4, "x", "99", "99"),
            ("Texas", 5, "Combined heat and power, commercial", "3", "3"), ("Texas", 6, "..a", "4", "4"),
            ("Texas", 7, "Total net generation", "5", "5"), ("Texas", 8, "Total international imports", "6", "6"),
            ("Texas", 9, "Total international exports", None, "7"), ("Texas", 10, "Net interstate trade", "8", "8")]
    sheet = spark.createDataFrame(rows, "state_name string, idx int, category string, `2014` string, `Year 2015` string")
    disp = EN.state_disposition(sheet)
    assert disp.count() == 9 * 2
    got = {(r.category, r.year): r.value for r in disp.collect()}
    assert got[("electric utilities", 2014)] == 10.0 and got[("ipp", 2015)] == 0.0
    assert ("x", 2014) not in got and got[("total international exports", 2014)] == 0.0
    srows = [("Texas", 0, "header", "0")] + [("Texas", 1 + i, ["Coal", "Petroleum", "Natural gas", "Total"][i % 4],
                                             str(i)) for i in range(20)]
    sect = EN.state_sectors(spark.createDataFrame(srows, "state_name string, idx int, variable string, `2014` string"))
    s = {(r.sector, r.variable): r.value for r in sect.collect()}
    assert len(s) == 20 and s[("electric power", "Total")] == 19.0 and s[("residential", "Coal")] == 0.0
    em = spark.createDataFrame([(2015, "TX", "Total Electric Power Industry", "All Sources", 1.5, 2.5)],
                               "Year int, State string, `Producer Type` string, `Energy Source` string, "
                               "`CO2 (Metric Tons)` double, `SO2 (Metric Tons)` double")
    e = {r.type: (r.units, r.value) for r in EN.state_emissions(em).collect()}
    assert e == {"CO2": ("Metric Tons", 1.5), "SO2": ("Metric Tons", 2.5)}


def test_d14_district_emissions(spark):
    members = spark.createDataFrame([("TX", 4), ("TX", 4), ("AK", 1), ("ZZ", 3)], "state_code string, district_code int")
    states = spark.createDataFrame([("TX", 48, False), ("AK", 2, True)], "state_code string, fips int, at_large boolean")
    dis = EN.district_list(members, states)
    assert sorted(map(tuple, dis.collect())) == [("02", "00"), ("48", "04")]
    table2 = ("<table><tr><th>Year</th>" + "<th>m</th>" * 7 + "</tr>"
              "<tr><td>2004:</td>" + "<td>1,000</td>" * 7 + "</tr>"
              "<tr><td>Future:</td>" + "<td>9</td>" * 7 + "</tr></table>")
    pages = spark.createDataFrame([("http://c/4804", "<table><tr><td>x</td></tr></table>" + table2)], "url string, html string")
    out = EN.district_emissions(dis, pages, "http://c/").filter(F.col("year").isNotNull()).collect()
    assert [(r.fips, r.district_code, r.year, r.value, r.units) for r in out] == [("48", "04", 2004, 7000, "tons")]


def test_d19_co2_state_year(spark):
    f1 = spark.createDataFrame([(1995, 1, "BIT", 10.0), (1995, 1, None, 5.0), (1995, 2, "NG", 2.0)],
                               "year int, plant_id int, esource string, con double")
    f3 = spark.createDataFrame([(1995, 1, "BIT", 1.0), (1995, 1, None, 99.0)], "year int, plant_id int, esource string, con double")
    factors = spark.createDataFrame([("BIT", 100.0, 1000.0), ("NG", 50.0, 500.0)],
                                    "esource string, kg_co2_per_mmbtu double, kg_co2_per_unit double")
    loc = spark.createDataFrame([(1, 104, 48), (2, 104, 2)], "plant_id int, assembly int, fips int")
    states = spark.createDataFrame([(48, "TX", "Texas"), (2, "AK", "Alaska")], "fips int, state_code string, state_name string")
    sect = spark.createDataFrame([("Texas", "electric power", "Total", 1995, 2e-6), ("Alaska", "residential", "Total", 1995, 1.0)],
                                 "state_name string, sector string, variable string, year int, value double")
    out = EN.co2_state_year({1: f1, 3: f3}, factors, loc, states, sect)
    z = {r.state_code: r for r in out["co2_state_year"].collect()}
    assert abs(z["TX"].co2 - 2000 / 1e9) < 1e-15 and abs(z["TX"].r - 1.0) < 1e-9
    assert z["AK"].value is None and z["AK"].r is None
    assert out["ratio_distribution"].count() == 1


def test_d20_fuel_master(spark):
    head = "63" "01" "1" "2" "6" "123" "456" + "ALABAMA POWER".ljust(25) + "GORGAS".ljust(11) + "0".rjust(7) \
        + "BIT".ljust(9) + "00195" + " " + "M" + "0188" + " " + "   " + "89"
    months = "".join(f"{g:>10}{c:>8}{s:>8}" for g, c, s in [(1000, 5, 7), (-250, 0, 7)] + [("", "", "")] * 10)
    tail = "0008" "07" "00195" "BIT" "ST"
    rec = head + months + tail
    assert len(rec) == 410
    rec2 = rec[:4] + " " + rec[5:6] + " " + rec[7:80] + "91" + rec[82:]
    lines = spark.createDataFrame([(rec,), (rec2,)], "value string")
    out = EN.fuel_master_monthly(spark, lines)
    rows = {(r.year, r.month): r for r in out.collect()}
    assert len(rows) == 24
    r = rows[(1989, 1)]
    assert (r.plant_code, r.company_name, r.fuel_label, r.prime_mover_label, r.nerc_label) == \
        (456, "ALABAMA POWER", "Bituminous", "Steam", "SERC")
    assert r.generation_mwh == 1.0 and rows[(1989, 2)].generation == -250.0
    assert rows[(1989, 3)].generation is None
    assert rows[(1991, 1)].ownership_label == "Industrial" and rows[(1991, 1)].fuel_label == "Water"
    assert rows[(1991, 1)].generation_mwh == 1000.0
