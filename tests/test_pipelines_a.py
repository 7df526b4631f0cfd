"""Reference-shaped fixtures for D1-D7 (5-20 inline rows, NULLs, ties, junk)."""

import datetime as dt

from polidata.plans.pipelines import economy as EC
from polidata.plans.pipelines import legislature as LG


def test_d1_regional_accounts(spark):
    naics = spark.createDataFrame([
        ("01000", "Alabama", "5", 1, "All industry total", 2000.0, "10", "(NA)"),
        ("00000", "United States", None, 1, "All industry total", 90.0, "1", "2"),
        ("57000", "Region", None, 1, "x", 1.0, "1", "1"),
        ("Note: x", None, None, None, None, None, None, None)],
        "GeoFIPS string, GeoName string, Region string, IndustryId int, Description string, "
        "ComponentId double, `1997` string, `1998` string")
    sic = spark.createDataFrame([("02000", "Alaska", "8", 1, "All", 2000.0, "5", "6", "7")],
                                "GeoFIPS string, GeoName string, Region string, IndustryId int, Description string, "
                                "ComponentId double, `1995` string, `1996` string, `1997` string")
    sa1 = spark.createDataFrame([
        ("01000", "Alabama", "5", "SA1", 1, "Personal income (thousands of dollars)", "100", "110"),
        ("01000", "Alabama", "5", "SA1", 2, "Population (persons)", "4", "5"),
        ("01000", "Alabama", "5", "SA1", 3, "Per capita", "25", "22")],
        "GeoFIPS string, GeoName string, Region string, Table string, LineCode int, Description string, "
        "`2015` string, `2016` string")
    out = EC.regional_accounts(naics, sic, sa1)
    gsp = {(r.fips, r.year): r.value for r in out["bea_gsp"].collect()}
    assert gsp == {(1, 1997): 10.0, (1, 1998): None, (2, 1995): 5.0, (2, 1996): 6.0}
    assert out["bea_gsp"].select("units").distinct().first()[0] == "millions of current dollars"
    gsi = out["bea_gsi"].collect()
    assert {r.units for r in gsi} == {"thousands of dollars"} and {r.description for r in gsi} == {"Personal income"}
    assert "series" in out["bea_pop"].columns and out["bea_pop"].count() == 2


def test_d2_bls(spark):
    rows = [("LASST010000000000003", 2000, "M01", "4.0"), ("LASST010000000000003", 2000, "M02", "6.0"),
            ("LASST020000000000003", 2000, "M01", "5.0"), ("LASST020000000000003", 2000, "M02", None),
            ("LASST720000000000003", 2000, "M01", "9.0"), ("LASST010000000000004", 2000, "M01", "99"),
            ("LAUCN010000000000003", 2000, "M01", "1.0")]
    df = spark.createDataFrame(rows, "series_id string, year int, period string, value string")
    got = {(r.fips, r.year): r.avg_unempl for r in EC.unemployment(df).collect()}
    assert got == {(1, 2000): 5.0, (2, 2000): None}
    cpi = spark.createDataFrame([("CUUR0000SA0", 2000, "M01", "170.0"), ("CUUR0000SA0", 2000, "M02", "172"),
                                 ("CUSR0000SA0", 2000, "M01", "171.0")], "series_id string, year int, period string, value string")
    assert EC.price_index(cpi).first().avg_cpi == 171.0
    assert EC.price_index(cpi, "CUUR0000SA0").first().avg_cpi == 171.0


def test_d3_voteview(spark):
    memb = spark.createDataFrame([(113, "House", 1, 41, "AL"), (113, "House", 1, 41, "AL"), (113, "President", 9, 99, "USA"),
                                  (113, "Senate", 3, None, None)],
                                 "assembly int, chamber string, icpsr int, state_icpsr int, state_abbrev string")
    out = LG.voteview(memb, memb, memb)["voteview_memb"]
    got = sorted((r.icpsr, r.state_code) for r in out.collect())
    assert got == [(1, "AL"), (3, None), (9, "US")] and "icpsr_code" in out.columns
    assert LG.voteview_paths("/d", [103], "votes") == ["/d/votes/H103_votes.csv", "/d/votes/S103_votes.csv"]


def test_d4_session_calendar(spark):
    house = spark.createDataFrame([
        (1, 0, "103rd (1993-1995)", "1", "Jan. 5, 1993", "Nov. 26, 1993", "326", "123", ""),
        (1, 1, None, None, "January 25, 1994", "Dec. 1, 1994", "311", "142", ""),
        (1, 2, "104th", "1", "Jan. 4, 1995", "Jan. 3, 1996", "365", "168", "")],
        "doc int, idx int, assembly string, session string, session_start string, session_end string, "
        "calendar_days string, legislative_days string, recesses string")
    senate = spark.createDataFrame([
        (2, 0, "103", "1", "Jan 5, 1993", "Nov 26, 19931"), (2, 1, None, "2", "Jan 25, 1994", "Dec 1, 1994"),
        (2, 2, None, "", "", ""), (2, 3, None, "S", "Mar 4, 1994", "Mar 5, 1994")],
        "doc int, idx int, assembly string, session string, session_start string, session_end string")
    out = LG.session_calendar(house, senate).collect()
    h = [(r.assembly, r.session, r.session_start) for r in out if r.chamber == "House"]
    assert h == [(103, 1, dt.date(1993, 1, 5)), (103, 2, dt.date(1994, 1, 25)), (104, 1, dt.date(1995, 1, 4))]
    s = [(r.assembly, r.session, r.session_end, r.end_date) for r in out if r.chamber == "Senate"]
    assert s[0] == (103, 1, dt.date(1993, 11, 26), dt.date(1994, 12, 1))
    assert s[-1][1] == 9 and len(s) == 3


def test_d5_legislators(spark):
    schema = ("name struct<first:string,last:string>, id struct<govtrack:bigint,fec:array<string>>, "
              "bio struct<birthday:string>, terms array<struct<type:string,start:string,end:string,"
              "party_affiliations:string>>")
    cur = spark.createDataFrame([(("A", "B"), (1, ["X1", "X1"]), ("1950-01-01",),
                                  [("rep", "2001-01-03", "2003-01-03", None), ("sen", "2003-01-03", "2009-01-03", "D")])],
                                schema)
    hist = spark.createDataFrame([(("C", "D"), (2, ["Y1", "Y2"]), (None,), [("rep", "1991-01-03", "1993-01-03", None)]),
                                  (("A", "B"), (1, ["X1", "X1"]), ("1950-01-01",), [])], schema)
    out = LG.legislators(cur, hist)
    info = {r.id_govtrack: r.id_fec for r in out["govtrack_info"].collect()}
    assert info == {1: "X1", 2: "Y1,Y2"}
    terms = sorted((r.id_govtrack, r.type, r.chamber) for r in out["govtrack_term"].collect())
    assert terms == [(1, "rep", "House"), (1, "sen", "Senate"), (2, "rep", "House")]
    assert out["dup_info"].count() == 0


def test_d6_departures(spark):
    html = ("<h3>Retired (2 House; 1 Senate)</h3><h3>Defeated (1 House)</h3><h3>Other news</h3>"
            "<ul><li>n/a</li><li>Ann Lee (D-Texas), 60, 3 terms</li><li>Bob Roe* (R-Ohio), 50, 2 terms</li>"
            "<li>Cy Peña (R-Mo), 70, 2 terms</li><li>Di Fox (D-Texas), 44, 1 term</li><li>menu</li></ul>")
    pages = spark.createDataFrame([(110, html)], "assembly int, html string")
    dat = LG.departures_from_lists(pages)
    got = sorted((r.name, r.party, r.state, r.chamber, r.reason) for r in dat.collect())
    assert got == [("Ann Lee", "D", "Texas", "House", "Retired"), ("Bob Roe*", "R", "Ohio", "House", "Retired"),
                   ("Cy Peña", "R", "Mo", "Senate", "Retired"), ("Di Fox", "D", "Texas", "House", "Defeated")]
    lookup = spark.createDataFrame([("Texas", "TX"), ("Ohio", "OH")], "spelling string, state_code string")
    cands = spark.createDataFrame([(2008, "N00000001", "Ann Lee (D)", "TX07"), (2006, "N00000002", "Annie Leeds", "TX01"),
                                   (2008, "N00000003", "Di Fox", "TX02"), (2014, "N00000004", "Di Foxx", "TX02")],
                                  "cycle int, osid string, firstlast string, distid_run string")
    out = LG.tidy_departures(dat, lookup, cands=cands)
    rows = {r.name: (r.state_code, r.osid, r.matches) for r in out["casualty"].collect()}
    assert rows["Bob Roe"] == ("OH", None, 0)
    assert rows["Ann Lee"] == ("TX", "N00000001", 2)
    assert rows["Di Fox"] == ("TX", "N00000003", 1)
    assert rows["Cy Pena"][0] is None
    assert [r.state for r in out["unmatched_states"].collect()] == ["Mo"]


def test_d7_scorecard(spark):
    html = "".join(
        f'<a href="roll-call-vote/{y}-{n}-x">Vote {n}{" 2x Score" if n == 7 else ""}</a>'
        f'<span class="voteIssuesFULL">Lands,</span>' for y, n in
        [(2016, 1), (2016, 2), (2015, 3), (2016, 4), (2016, 7), (2015, 6), (1970, 9)])
    pages = spark.createDataFrame([(1, html)], "page_id int, html string")
    detail = spark.createDataFrame([("http://scores.example/roll-call-vote/2016-1-x",
                                     "<div id='roll-call-vote-pro-env-choice'>\n\tNo</div>")], "url string, html string")
    sc = LG.scorecard_votes(pages, detail, "http://scores.example/")
    got = sorted((r.year, r.rollnumber, r.chamber, r.lcv_vote, r.lcv_type) for r in sc.collect())
    assert (2016.0, 1.0, "Senate", 0.0, "Lands") in got and (2016.0, 4.0, "House", 1.0, "Lands") in got
    assert all(g[0] != 1970 for g in got)
    twin = spark.createDataFrame([(2016.0, 7.0, "House", 0.0)], "year double, rollnumber double, chamber string, "
                                                                "double_count double")
    lcv = LG.scorecard(twin, sc.drop("page_id", "idx"))
    rows7 = [r for r in lcv.collect() if r.rollnumber == 7.0]
    assert len(rows7) == 1 and rows7[0].double_count == 1.0 and rows7[0].assembly == 114.0


def test_d7_fields_of_an_entry_stay_together(spark):
    """An entry without a kind, or with two, shifts nothing of the entries after it."""
    html = ("<h1>Votes</h1><a href='/about'>About</a>"
            "<a href='roll-call-vote/2016-1-x'>One</a><span class='voteIssuesFULL'>Air,</span>\n"
            "<a href='roll-call-vote/2016-2-x'>Two</a><a href='/more'>more</a>\n"
            "<a class='v' href='roll-call-vote/2015-3-x'>Three</a><span class='voteIssuesFULL'>Seas,</span><span class='voteIssuesFULL'>Land,</span>"
            "<a href='roll-call-vote/2015-4-x'>Four</a><span class='voteIssuesFULL'>Toxics,</span>")
    pages = spark.createDataFrame([(1, html), (2, ""), (3, None)], "page_id int, html string")
    detail = spark.createDataFrame([], "url string, html string")
    got = sorted((r.rollnumber, r.lcv_type, r.lcv_dscr) for r in LG.scorecard_votes(pages, detail, "http://scores.example/").collect())
    assert got == [(1.0, "Air", "One"), (2.0, None, "Two"), (3.0, "Seas", "Three"), (4.0, "Toxics", "Four")]
