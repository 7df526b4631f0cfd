"""Plans whose shuffles, sorts and scans must not grow faster than the input."""

from polidata.operators import geo as G
from polidata.plans.pipelines import energy as EN
from polidata.plans.pipelines import legislature as LG


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_fuel_is_not_shuffled_by_source(spark):
    fuel = spark.range(1000).selectExpr("cast(id % 2 + 1 as int) AS src", "2000 AS year", "id AS plant_id", "'F1' AS esource", "1.0D AS con")
    one = spark.range(1).selectExpr("id AS plant_id", "106 AS assembly", "1 AS fips", "'F1' AS esource", "2.0D AS kg_co2_per_mmbtu", "3.0D AS kg_co2_per_unit",
                                    "'AX' AS state_code", "'Land' AS state_name", "'electric power' AS sector", "'Total' AS variable", "2000 AS year", "4.0D AS value")
    out = EN.co2_state_year(fuel, one, one, one, one)["co2_state_year"]
    assert "hashpartitioning(src" not in plan(out)
    assert [(r.year, r.state_code, r.co2) for r in out.collect()] == [(2000, "AX", 2e-9)]


def test_nearest_polygon_sorts_no_pairs(spark):
    corners = [(p, 0, i, x0 + x, y) for p, x0 in (("a", 0.0), ("b", 3.0)) for i, (x, y) in enumerate([(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)])]
    edges = G.polygon_edges(spark.createDataFrame(corners, "poly string, ring int, seq int, x double, y double").selectExpr("1 AS g", "*"), ["g", "poly"])
    points = spark.createDataFrame([(1, 1, 2.0, 0.5), (2, 1, 2.5, 0.5), (3, 1, 1.25, 0.5)], "pid int, g int, x double, y double")
    near = G.nearest_polygon(points, edges, ["g"], "poly", 0.5)
    assert "partial_min(dist" in plan(near)
    assert sorted((r.pid, r.poly, r.dist) for r in near.collect()) == [(1, "a", 1.0), (2, "b", 0.5), (3, "a", 0.25)]
    # an edge of unknown place leaves the distance open, as before
    torn = edges.selectExpr("g", "poly", "ring", "seq", "x1", "y1", "if(poly = 'b' and seq = 0, null, x2) AS x2", "y2")
    assert [(r.pid, r.poly, r.dist) for r in G.nearest_polygon(points.filter("pid = 2"), torn, ["g"], "poly", 0.5).collect()] == [(2, "b", None)]


def test_list_pages_are_cut_up_once(spark):
    entry = "<li><a href=\"roll-call-vote/{}-{}-x\">Vote {}</a><span class='voteIssuesFULL'>Air,</span></li>"
    html = "<ul>" + "\n".join(entry.format(y, n, n) for y, n in ((2001, 1), (2001, 2), (2000, 3), (2001, 4), (1999, 5))) + "</ul>"
    pages = spark.createDataFrame([(1, html), (None, html), (2, "")], "page_id int, html string")
    detail = spark.createDataFrame([("http://s/roll-call-vote/2001-2-x", "<div id='roll-call-vote-pro-env-choice'>No</div>")], "url string, html string")
    votes = LG.scorecard_votes(pages, detail, "http://s/")
    assert plan(votes).count("Generate ") == 1
    got = sorted((r.rollnumber, r.chamber, r.lcv_vote) for r in votes.filter("page_id = 1").collect())
    assert got == [(1.0, "Senate", 1.0), (2.0, "Senate", 0.0), (3.0, "Senate", 1.0), (4.0, "House", 1.0), (5.0, "House", 1.0)]
    assert {r.chamber for r in votes.filter("page_id IS NULL").collect()} == {"Senate"}
