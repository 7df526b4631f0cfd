"""D3 roll calls, D4 session calendar, D5 legislators, D6 departures, D7 scorecards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from polidata.functions import dates as D
from polidata.functions.civics import assembly_of_year, cycle_of_assembly
from polidata.functions.nullsafe import if_else, split_part
from polidata.functions.text import drop_last_char, fold_accents, paren_text, remove_paren, strip_controls
from polidata.operators import windows as W
from polidata.operators.aggregates import collapse_repeated
from polidata.operators.joins import apply_corrections
from polidata.operators.match import band_last_name_match
from polidata.operators.quality import key_violations
from polidata.operators.shape import union_fill
from polidata.sources import readers as R


# -- D3 ---------------------------------------------------------------------
def voteview_paths(base: str, assemblies, kind: str) -> list[str]:
    """File family: {base}/{kind}/{H|S}{assembly}_{kind}.csv."""
    if kind not in ("rollcalls", "votes", "members"):
        raise ValueError(kind)
    return [f"{base}/{kind}/{ch}{c}_{kind}.csv" for c in assemblies for ch in ("H", "S")]


def read_voteview(spark: SparkSession, base: str, assemblies, kind: str, schema) -> DataFrame:
    """One multi-path read of the whole family (no per-file loop)."""
    return spark.read.schema(schema).option("header", True).csv(voteview_paths(base, assemblies, kind))


def voteview(rollcalls: DataFrame, votes: DataFrame, members: DataFrame) -> dict[str, DataFrame]:
    memb = members.distinct().withColumnsRenamed({"state_icpsr": "icpsr_code", "state_abbrev": "state_code"})
    memb = memb.withColumn("state_code", if_else(F.col("state_code") == "USA", F.lit("US"), F.col("state_code")))
    return {"voteview_info": rollcalls, "voteview_cast": votes, "voteview_memb": memb}


# -- D4 ---------------------------------------------------------------------
def session_calendar(house: DataFrame, senate: DataFrame) -> DataFrame:
    """House and Senate session tables (rows with ``doc``/``idx`` page order)
    -> assembly, session, chamber, session_start/end, start/end of assembly."""
    h = house.withColumn("assembly", F.regexp_substr(F.regexp_replace("assembly", r"\([^()]+\)", ""), F.lit(r"\d+")))
    h = h.withColumns({"assembly": F.col("assembly").cast("int"), "session": F.col("session").try_cast("int")})
    h = W.fill_down(h, "assembly", ["doc"], ["idx"])
    h = W.fill_increment(h, "session", ["doc"], ["idx"])
    h = h.withColumns({"chamber": F.lit("House"), "session_start": D.month_day_year("session_start"),
                       "session_end": D.month_day_year("session_end")})
    s = senate.filter(F.trim("session") != "")
    s = s.withColumn("assembly", F.col("assembly").try_cast("int"))
    s = W.fill_down(s, "assembly", ["doc"], ["idx"])
    s = s.withColumns({
        "session": if_else(F.col("session") == "S", F.lit("9"), F.col("session")).try_cast("int"),
        "chamber": F.lit("Senate"), "session_start": D.month_day_year("session_start"),
        "session_end": D.month_day_year(D.cut_year_footnote(F.col("session_end")))})
    both = union_fill([h.drop("doc", "idx"), s.drop("doc", "idx")])
    ext = both.groupBy("chamber", "assembly").agg(F.min("session_start").alias("start_date"),
                                                  F.max("session_end").alias("end_date"))
    out = both.join(ext, ["chamber", "assembly"])
    for c in ("calendar_days", "legislative_days"):
        if c in out.columns:
            out = out.withColumn(c, F.col(c).try_cast("double"))
    return out.orderBy(F.asc_nulls_last("chamber"), F.asc_nulls_last("assembly"), F.asc_nulls_last("session"))


# -- D5 ---------------------------------------------------------------------
def legislators(current: DataFrame, historical: DataFrame) -> dict[str, DataFrame]:
    """Nested person documents -> govtrack_info (flat, repeated ids collapsed)
    and govtrack_term (one row per term, chamber), current + historical."""

    def flat(doc: DataFrame) -> DataFrame:
        cols = []
        for grp in ("name", "id", "bio"):
            if grp not in doc.columns:
                continue
            for f in doc.schema[grp].dataType.fields:
                c = F.col(f"{grp}.{f.name}")
                if f.dataType.typeName() == "array":
                    c = collapse_repeated(F.transform(c, lambda x: x.cast("string")))
                cols.append(c.alias(f"{grp}_{f.name}"))
        return doc.select(*cols)

    def terms(doc: DataFrame) -> DataFrame:
        t = doc.select(F.col("id.govtrack").alias("id_govtrack"), F.explode("terms").alias("t")).select("id_govtrack", "t.*")
        return t.drop("party_affiliations") if "party_affiliations" in t.columns else t

    info = union_fill([flat(current), flat(historical)]).distinct()
    term = union_fill([terms(current), terms(historical)]).distinct()
    term = term.withColumn("chamber", if_else(F.col("type") == "rep", F.lit("House"), F.lit("Senate")))
    return {"govtrack_info": info, "govtrack_term": term,
            "dup_info": key_violations(info, ["id_govtrack"]),
            "dup_term": key_violations(term, ["id_govtrack", "start", "end"])}


# -- D6 ---------------------------------------------------------------------
# Words that mark a departure-reason header.
REASON_PATTERN = "Appointed|Elected|Defeated|Expel|Vacat|Running|Retir|Resign|Died"


def departures_from_lists(pages: DataFrame) -> DataFrame:
    """Casualty-list pages (assembly, html) -> name, party, state, assembly,
    chamber, reason.  Each h3 header 'Reason (n House; m Senate)' claims the
    next n + m list items: House rows first, then Senate."""
    items = pages.select("assembly", F.filter(F.transform(R.html_elements(F.col("html"), "li"), R.strip_tags),
                                              lambda x: x.contains("term") & (x != "n/a")).alias("li"))
    items = items.select("assembly", F.posexplode("li").alias("pos", "txt"))
    first = F.trim(F.get(F.split("txt", ","), 0))
    items = items.select("assembly", "pos", F.trim(remove_paren(first)).alias("name"),
                         F.trim(split_part(paren_text(first), "-", 1)).alias("party"),
                         F.trim(split_part(paren_text(first), "-", 2)).alias("state"))
    hdr = pages.select("assembly", F.filter(F.transform(R.html_elements(F.col("html"), "h3"), R.strip_tags),
                                            lambda x: x.rlike(REASON_PATTERN)).alias("h"))
    hdr = hdr.select("assembly", F.posexplode("h").alias("hpos", "h"))
    counts = F.split(F.coalesce(paren_text("h"), F.lit("")), ";")

    def n_at(i):
        return F.coalesce(F.regexp_substr(F.trim(F.get(counts, i)), F.lit(r"^\d+")).try_cast("int"), F.lit(0))

    hdr = hdr.select("assembly", "hpos",
                     F.trim(F.regexp_replace(remove_paren("h"), "[-—\u0097]", "")).alias("reason"),
                     n_at(0).alias("n_house"), n_at(1).alias("n_senate"))
    w = Window.partitionBy("assembly").orderBy("hpos")     # bounded: headers of one page
    hdr = hdr.withColumn("offset", F.coalesce(F.sum(F.col("n_house") + F.col("n_senate")).over(
        w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    slots = hdr.select("assembly", "reason", "offset", "n_house",
                       F.explode(F.sequence(F.lit(0), F.col("n_house") + F.col("n_senate") - 1)).alias("k")) \
        .filter(F.col("k") >= 0)
    slots = slots.select("assembly", "reason", (F.col("offset") + F.col("k")).alias("pos"),
                         F.when(F.col("k") < F.col("n_house"), "House").otherwise("Senate").alias("chamber"))
    return items.join(slots, ["assembly", "pos"], "left").drop("pos")


def tidy_departures(dat: DataFrame, state_lookup: DataFrame, corrections: DataFrame | None = None,
                    cands: DataFrame | None = None) -> dict[str, DataFrame]:
    """Clean names, apply corrections, code states by exact lookup, and fill
    missing ids (assembly >= 101) with the band last-name match."""
    d = dat.withColumn("name", fold_accents(F.regexp_replace("name", r"[.*]", "")))
    if corrections is not None:
        for col in ("name", "party", "state"):
            r = corrections.filter(F.col("column") == col).select("name_key", "assembly", "new_value")
            d = d.withColumn("name_key", F.col("name"))
            d = apply_corrections(d, r, ["name_key", "assembly"], col).drop("name_key")
    lk = state_lookup.select(F.col("spelling").alias("state"), "state_code")
    d = d.join(lk, "state", "left")
    unmatched = d.filter(F.col("state_code").isNull()).select("state").distinct()
    if "osid" not in d.columns:
        d = d.withColumn("osid", F.lit(None).cast("string"))
    # deterministic row key (stable under recomputation after executor loss)
    d = d.withColumn("rid", F.concat_ws("|", "name", F.col("assembly").cast("string"), "chamber", "reason"))
    if cands is not None:
        c = cands.select(F.col("cycle").cast("int").alias("cycle"), "osid",
                         F.trim(F.regexp_replace(F.trim("firstlast"), r"\([^()]*\)$", "")).alias("cname"),
                         F.substring("distid_run", 1, 2).alias("state_code")).distinct()
        need = d.filter(F.col("osid").isNull() & (F.col("assembly") >= 101)).select(
            "rid", "name", "state_code", cycle_of_assembly(F.col("assembly"), "closing").alias("cycle"))
        m = band_last_name_match(need, "rid", "name", "cycle", c.withColumn("cid", F.col("osid")), "cid", "cname",
                                 "cycle", ["state_code"], width=2)
        d = d.join(m.select("rid", F.col("cid").alias("_m"), "matches"), "rid", "left") \
             .withColumn("osid", F.coalesce("osid", "_m")).drop("_m")
    out = d.drop("rid", "state")
    return {"casualty": out, "unmatched_states": unmatched,
            "missing_ids": out.filter(F.col("osid").isNull() & F.col("assembly").between(101, 113))}


# -- D7 ---------------------------------------------------------------------
def scorecard_votes(pages: DataFrame, detail: DataFrame, base_url: str, kind_class: str = "voteIssuesFULL",
                    n_senate: int | None = None, drop_year: int | None = 1970) -> DataFrame:
    """Scorecard list page(s) (page_id, html) + detail pages (url, html) ->
    one row per scored roll call with the pro-environment position.
    ``base_url`` is prefixed to the relative vote links (detail page urls)."""
    # an entry reaches from its vote link to the next one, so its fields stay together; one without a kind has NULL
    link = r"""<a\b[^>]*?\bhref\s*=\s*["']roll-call-vote"""
    entries = F.regexp_extract_all("html", F.lit(rf"(?is)({link}.*?)(?={link}|\z)"), 1)
    z = pages.select("page_id", F.posexplode(entries).alias("idx", "e")).select("page_id", "idx", F.struct(
        F.get(R.html_links(F.col("e"), "roll-call-vote"), 0).alias("l"),
        F.get(F.regexp_extract_all("e", F.lit(f"<span class=['\"]{kind_class}['\"]>(.*?)</span>"), 1), 0).alias("k")).alias("z"))
    href = F.col("z.l.href")
    full = F.concat(F.lit(base_url), href)
    d = z.select("page_id", "idx", full.alias("href"),
                 F.get(F.split(href, "-"), 3).try_cast("double").alias("rollnumber"),
                 F.get(F.split(F.get(F.split(full, "-"), 2), "/"), 1).try_cast("double").alias("year"),
                 F.trim(drop_last_char(F.col("z.k"))).alias("lcv_type") if kind_class.endswith("FULL")
                 else F.trim(F.col("z.k")).alias("lcv_type"),
                 R.strip_tags(F.col("z.l.text")).alias("lcv_dscr"))
    if drop_year is not None:
        d = d.filter(F.col("year") != drop_year)
    if n_senate is not None:
        chamber = F.when(F.col("idx") < n_senate, "Senate").otherwise("House")
    else:
        # the list restarts at the latest year when the House block begins; found page by page, so that pages are cut up once
        page = Window.partitionBy("page_id")
        top = F.coalesce(F.col("page_id").isNotNull() & (F.col("year") == F.max("year").over(page)), F.lit(False))
        d = d.withColumn("_top", F.when(top, F.col("idx")))
        before = F.last("_top", ignorenulls=True).over(page.orderBy("idx").rowsBetween(Window.unboundedPreceding, -1))
        d = d.withColumn("_jump", F.when(F.col("_top") > before + 1, F.col("idx")))
        d = d.withColumn("_cut", F.min("_jump").over(page))
        chamber = F.when(F.col("_cut").isNull() | (F.col("idx") < F.col("_cut")), "Senate").otherwise("House")
    d = d.withColumn("chamber", chamber).drop("_top", "_jump", "_cut")
    pos = detail.select(F.col("url").alias("href"), strip_controls(R.strip_tags(F.regexp_extract(
        "html", r"(?s)<div id=['\"]roll-call-vote-pro-env-choice['\"]>(.*?)</div>", 1))).alias("_pro"))
    d = d.join(pos, "href", "left").withColumns({
        "lcv_vote": F.when(F.col("_pro") == "No", 0.0).otherwise(1.0), "lcv_note": F.lit("scorecard"), "not_in_lcv": F.lit(0.0),
        "double_count": F.when(F.col("lcv_dscr").contains("2x Score"), 1.0).otherwise(0.0)})
    columns = ["href", "page_id", "idx", "rollnumber", "year", "lcv_type", "lcv_dscr", "lcv_vote", "lcv_note", "not_in_lcv", "double_count", "chamber"]
    return d.select(*(columns if n_senate is not None else ["page_id", "href", *columns[2:]]))


def scorecard(recent: DataFrame, scored: DataFrame) -> DataFrame:
    """Recent + scorecard votes; where a flagged '2x Score' twin exists only
    the flagged row is kept; assembly added."""
    lcv = union_fill([recent, scored])
    lcv = W.keep_flagged_twins(lcv, ["year", "rollnumber", "chamber"], "double_count")
    return lcv.withColumn("assembly", assembly_of_year(F.col("year")).cast("double")).drop("page_id", "idx")

