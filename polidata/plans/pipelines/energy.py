"""Energy: D11 generation forms, D12 plant registry, D13 state tables,
D14 district emissions, D19 CO2 by state-year, D20 fixed-width fuel master."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polidata.functions.civics import assembly_of_year, generation_mwh, repair_year
from polidata.functions.columns import columns_matching, normalise_names, schema_drift
from polidata.functions.nullsafe import row_sum
from polidata.operators.aggregates import box_stats
from polidata.operators.quality import attribute_drift
from polidata.operators.shape import union_by_position, union_fill, unpivot
from polidata.operators.windows import block_label
from polidata.sources import readers as R


# -- D11 --------------------------------------------------------------------
def patch_utility_form(df: DataFrame) -> DataFrame:
    """Utility form rows: year repair; through 1995 monthly con/gen/stk
    columns become totals (NULL if a month is NULL) and are dropped; in
    1970-84 and 1991-95 the utility code moves to ``ucode``."""
    d = df.withColumn("year", repair_year(F.col("year").cast("int")))
    for c in ("fipst", "utilcode"):
        if c in d.columns:
            d = d.withColumn(c, F.col(c).try_cast("double"))
    monthly = columns_matching(d, r"^[a-z]{3}\d{2}$")
    early = F.col("year") <= 1995
    tot = {}
    for prefix, out in (("con", "consumptio"), ("gen", "netgenerat"), ("stk", "stocks")):
        cols = [c for c in monthly if c.startswith(prefix)]
        if cols:
            tot[out] = F.when(early, row_sum(*cols, na_rm=False)).otherwise(
                F.col(out) if out in d.columns else F.lit(None).cast("double"))
    d = d.withColumns(tot).drop(*monthly)
    moved = F.col("year").between(1970, 1984) | F.col("year").between(1991, 1995)
    if "utilcode" in d.columns:
        d = d.withColumn("ucode", F.when(moved, F.col("utilcode"))) \
             .withColumn("utilcode", F.when(~moved, F.col("utilcode")))
    return d


def patch_nonutility_form(df: DataFrame) -> DataFrame:
    """Non-utility rows: outside 1989 totals come from the *CONSUMP /
    *GENERAT columns (then dropped); 1989 already carries con / gen."""
    d = df
    cons, gens = columns_matching(d, "CONSUMP$"), columns_matching(d, "GENERAT$")
    y89 = F.col("YEAR") == 1989
    d = d.withColumns({
        "consumptio": F.when(y89, F.col("con") if "con" in d.columns else F.lit(None))
        .otherwise(row_sum(*cons, na_rm=False) if cons else F.lit(None)),
        "netgenerat": F.when(y89, F.col("gen") if "gen" in d.columns else F.lit(None))
        .otherwise(row_sum(*gens, na_rm=False) if gens else F.lit(None))})
    return d.drop(*cons, *gens, *[c for c in ("con", "gen") if c in d.columns])


def sheet_from_cells(cells: DataFrame, label: str = "plant id", within: int = 10) -> DataFrame:
    """Spreadsheet rows (doc, idx, cells) whose header sits at a varying row
    and column -> long (doc, idx, column, value) under the detected header."""
    body = R.detect_header(cells, ["doc"], "idx", "cells", label, within)
    hdr = cells.join(body.select("doc", "hdr_idx", "hdr_col").distinct(), "doc") \
        .filter(F.col("idx") == F.col("hdr_idx")) \
        .select("doc", F.transform(F.slice("cells", F.col("hdr_col"), F.size("cells")), lambda c: F.lower(F.trim(c))).alias("names"))
    b = body.join(hdr, "doc").withColumn("vals", F.slice("cells", F.col("hdr_col"), F.size("cells")))
    z = b.select("doc", "idx", F.explode(F.arrays_zip(F.col("names").alias("column"), F.col("vals").alias("value"))).alias("z"))
    return z.select("doc", "idx", F.regexp_replace("z.column", r"\s+", "_").alias("column"), "z.value")


def wide_from_long(long: DataFrame, columns: list[str]) -> DataFrame:
    """Long cells -> one row per (doc, idx) with the given columns (bounded pivot)."""
    return long.groupBy("doc", "idx").pivot("column", columns).agg(F.first("value"))


def stack_vintages(frames: list[DataFrame], by_position: bool = False) -> DataFrame:
    """Yearly files with drifting schemas: by name (missing -> NULL), or by
    the first vintage's names when later vintages renamed columns."""
    frames = [normalise_names(f) for f in frames]
    return union_by_position(frames) if by_position else union_fill(frames)


# -- D12 --------------------------------------------------------------------
def plant_registry(vintages: dict[int, DataFrame], base_year: int = 2012) -> dict[str, DataFrame]:
    """Per-year plant files -> eia_f860 (+ drift report, unstable plants)."""
    frames = [normalise_names(f).withColumn("year", F.lit(y)) for y, f in sorted(vintages.items())]
    reg = union_fill(frames)
    later = [normalise_names(f) for y, f in sorted(vintages.items()) if y > base_year]
    base = normalise_names(vintages[base_year])
    drift = schema_drift(base, later[0]) if later else None
    added = [c for c in (later[0].columns if later else []) if c not in base.columns]
    attrs = [c for c in reg.columns if c not in ("year", "plant_code", *added)]
    unstable = attribute_drift(reg, ["plant_code"], attrs)
    return {"eia_f860": reg, "schema_drift": drift, "unstable_plants": unstable}


def plant_registry_long(rows: DataFrame, key: str = "plant_code") -> dict[str, DataFrame]:
    """All vintages in one frame -> registry, schema drift and attribute drift, without a frame per year.

    ``rows`` holds key, year, ``present`` (the normalised names of the columns that the row's file has) and the
    attributes, NULL where a file lacks them.  schema_drift: per column its first and last year and in how many years
    it occurs; attribute_drift: keys with several versions of the attributes that every year has, with their number,
    from one aggregate of attribute digests.
    """
    attrs = [c for c in rows.columns if c not in (key, "year", "present")]
    years = rows.select("year", F.explode("present").alias("column")).distinct()
    schema = years.groupBy("column").agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count(F.lit(1)).alias("n_years"))
    n_all = rows.agg(F.count_distinct("year")).first()[0]
    everywhere = {r.column for r in schema.filter(F.col("n_years") == n_all).collect()}      # column names of the files
    steady = [c for c in attrs if c in everywhere]
    digest = F.sha2(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in steady]), {"ignoreNullFields": "false"}), 256)
    drift = rows.groupBy(key).agg(F.count_distinct(digest).alias("n_versions")).filter(F.col("n_versions") > 1)
    return {"eia_f860": rows.drop("present"), "schema_drift": schema, "unstable_plants": drift}


# -- D13 --------------------------------------------------------------------
# Disposition row markers and how many rows each block spans.
DISPOSITION_BLOCKS = [("Electric utilities", 3), ("Combined heat and power, commercial", 2),
                      ("Total net generation", 1), ("Total international imports", 1),
                      ("Total international exports", 1), ("Net interstate trade", 1)]
# Sector order of the 4-row blocks (lower case).
SECTORS = ["residential", "commercial", "industrial", "transportation", "electric power"]


def _year_value(df: DataFrame, ids: list[str]) -> DataFrame:
    years = [c for c in df.columns if re.search(r"\d{4}", c)]
    long = unpivot(df.select(*ids, *[F.col(f"`{y}`").cast("string").alias(y) for y in years]), ids, years, "year", "value")
    return long.withColumn("year", F.regexp_substr("year", F.lit(r"\d{4}")).cast("int"))


def state_disposition(sheet: DataFrame) -> DataFrame:
    """Rows (state_name, idx, category, <year columns>) -> eia_disp."""
    marks = None
    for text, size in DISPOSITION_BLOCKS:
        m = sheet.filter(F.col("category").contains(text)).groupBy("state_name").agg(F.min("idx").alias("_m")) \
            .withColumn("_size", F.lit(size))
        marks = m if marks is None else marks.unionByName(m)
    keep = marks.select("state_name", F.explode(F.sequence(F.col("_m"), F.col("_m") + F.col("_size") - 1)).alias("idx"))
    d = sheet.join(keep, ["state_name", "idx"], "left_semi")
    d = d.withColumn("category", F.trim(F.lower(F.regexp_replace("category", r"\.\.", ""))))
    long = _year_value(d, ["state_name", "category"])
    return long.withColumns({"value": F.coalesce(F.col("value").try_cast("double"), F.lit(0.0)),
                             "units": F.lit("megawatthours")})


def state_sectors(sheet: DataFrame) -> DataFrame:
    """Rows (state_name, idx, variable, <years>) with 5 blocks of 4 rows each
    starting at a 'Coal' row -> eia_sect with the sector of each block."""
    starts = sheet.filter(F.col("variable").contains("Coal")).select("state_name", F.col("idx").alias("_s"))
    rows = starts.select("state_name", F.explode(F.sequence(F.col("_s"), F.col("_s") + 3)).alias("idx"))
    d = sheet.join(rows, ["state_name", "idx"], "left_semi")
    d = block_label(d, ["state_name"], ["idx"], 4, out="_b")
    d = d.withColumn("sector", F.element_at(F.array(*[F.lit(s) for s in SECTORS]), F.col("_b") + 1)).drop("_b", "idx")
    long = _year_value(d, ["state_name", "variable", "sector"])
    return long.withColumns({"value": F.col("value").try_cast("double"),
                             "units": F.lit("million metric tons of carbon dioxide")})


def state_emissions(sheet: DataFrame, n_ids: int = 4) -> DataFrame:
    """Four id columns then measures named 'X (units)' -> long with units and
    type = first three characters of the header."""
    ids = sheet.columns[:n_ids]
    long = unpivot(sheet.select(*ids, *[F.col(f"`{c}`").cast("double").alias(c) for c in sheet.columns[n_ids:]]),
                   ids, sheet.columns[n_ids:], "type", "value")
    long = normalise_names(long)
    return long.withColumns({"units": F.regexp_replace(F.regexp_substr("type", F.lit(r"\([^()]+\)")), r"[()]", ""),
                             "type": F.substring("type", 1, 3)})


# -- D14 --------------------------------------------------------------------
def district_list(members: DataFrame, states: DataFrame) -> DataFrame:
    """(fips, district_code) with at-large districts coded '00'."""
    s = states.select("state_code", "fips", "at_large")
    d = members.select("state_code", "district_code").distinct().join(s, "state_code")
    code = F.when(F.col("at_large").isNull(), F.lit(None)).when(
        F.col("at_large"), F.lit("00")).otherwise(F.lpad(F.col("district_code").cast("string"), 2, "0"))
    # distinct after the at-large recode: several member districts collapse to '00'
    return d.select(F.lpad(F.col("fips").cast("string"), 2, "0").alias("fips"), code.alias("district_code")).distinct()


def district_emissions(districts: DataFrame, pages: DataFrame, url_prefix: str) -> DataFrame:
    """Detail page per district (table 2: year + 7 measures) -> carma:
    'Future' rows out, commas removed, all measures summed per district-year."""
    drive = districts.withColumn("url", F.concat(F.lit(url_prefix), "fips", "district_code"))
    d = drive.join(pages.select("url", "html"), "url", "left")
    rows = d.select("fips", "district_code", F.posexplode(R.html_table_rows(F.col("html"), 1)).alias("r", "cells"))
    rows = rows.filter(F.col("r") > 0)                                     # header row
    year = F.regexp_replace(F.get("cells", 0), ":", "")
    rows = rows.withColumn("year", year).filter(F.col("year") != "Future")
    meas = F.slice("cells", 2, 7)
    rows = rows.select("fips", "district_code", F.col("year").try_cast("int").alias("year"),
                       F.explode(meas).alias("v"))
    rows = rows.withColumn("value", F.regexp_replace("v", ",", "").try_cast("long"))
    out = rows.groupBy("year", "fips", "district_code").agg(F.sum("value").alias("value"))
    return out.withColumns({"variable": F.lit("carbon dioxide"), "units": F.lit("tons")})


# -- D19 --------------------------------------------------------------------
# Source number, factor column that applies to its amounts, whether rows without a fuel code stay.
SOURCE_RULES = [(1, "kg_co2_per_mmbtu", True), (2, "kg_co2_per_unit", False), (3, "kg_co2_per_unit", False),
                (4, "kg_co2_per_mmbtu", False), (5, "kg_co2_per_mmbtu", False)]


def fuel_fact(fuel: dict[int, DataFrame]) -> DataFrame:
    """Fuel tables by source number -> one long fact (src, year, plant_id, esource, con)."""
    return union_fill([df.select(F.lit(src).alias("src"), F.col("year").cast("int").alias("year"), "plant_id", "esource",
                                 F.col("con").cast("double").alias("con")) for src, df in sorted(fuel.items())])


def co2_state_year(fuel: dict[int, DataFrame] | DataFrame, factors: DataFrame, locations: DataFrame, states: DataFrame,
                   sectors: DataFrame, exclude_states=("ME", "ID", "VT"), rules: DataFrame | None = None) -> dict[str, DataFrame]:
    """Modelled CO2 per state-year against the published electric-power total.

    ``fuel``: the long fact of ``fuel_fact``, or its tables by source number.  ``rules`` (src, factor, keep_null) says
    for each source which factor column applies and whether a NULL fuel code stays (it then finds no factor, so its CO2
    is 0); by default SOURCE_RULES.  A source without a rule is left out.
    ``locations``: (plant_id, assembly, fips), the place of a plant in each assembly; ``states``: (fips, state_code,
    state_name); ``sectors``: eia_sect (state_name, sector, variable, year, value).
    """
    fact = fuel_fact(fuel) if isinstance(fuel, dict) else fuel
    if rules is None:
        rules = fact.sparkSession.createDataFrame(SOURCE_RULES, "src int, factor string, keep_null boolean")
    # a rule per source is a handful of rows: a shuffle by source would put a source's whole fact into one task
    tagged = fact.join(F.broadcast(rules), "src").filter(F.col("esource").isNotNull() | F.col("keep_null"))
    con = tagged.groupBy("factor", "year", "plant_id", "esource").agg(F.sum(F.col("con").cast("double")).alias("con"))
    # one row per fuel and kind of factor, so that the rule is part of the join
    kinds = ["kg_co2_per_mmbtu", "kg_co2_per_unit"]
    fac = factors.select("esource", F.explode(F.array(*[
        F.struct(F.lit(k).alias("factor"), F.col(k).cast("double").alias("kg")) for k in kinds])).alias("f")).select("esource", "f.*")
    e = con.join(fac, ["esource", "factor"], "left")
    e = e.withColumn("co2", F.coalesce(F.col("con") * F.col("kg"), F.lit(0.0)))
    plants = e.groupBy("year", "plant_id").agg(F.sum("co2").alias("co2")) \
        .withColumn("assembly", assembly_of_year(F.col("year")))
    # a plant belongs to the place it had in the assembly of the year
    loc = locations.select("plant_id", "assembly", "fips")
    x1 = plants.join(loc, ["plant_id", "assembly"], "left").filter(F.col("fips").isNotNull()) \
        .groupBy("year", "fips").agg((F.sum("co2") / 1e9).alias("co2"))
    x1 = x1.join(states.select("fips", "state_code", "state_name"), "fips", "left")
    y1 = sectors.filter((F.col("variable") == "Total") & (F.col("sector") == "electric power")) \
        .select("year", "state_name", "value")
    z = x1.join(y1, ["year", "state_name"], "left").select(
        "year", "state_code", "co2", "value", F.try_divide(F.col("co2"), F.col("value")).alias("r"))
    z = z.orderBy(F.desc_nulls_last("r"), "year")
    dist = box_stats(z.filter(~F.col("state_code").isin(*exclude_states)), ["year"], "r")
    return {"co2_state_year": z, "ratio_distribution": dist}


# -- D20 --------------------------------------------------------------------
# Field layout of the 410-character monthly fuel master record
# (name, first position, width, type).
MASTER_FIELDS = [("census_region", 1, 2, "int"), ("fips_state", 3, 2, "int"), ("ownership", 5, 1, "string"),
                 ("prime_mover", 6, 1, "string"), ("fuel", 7, 1, "string"), ("company_code", 8, 3, "int"),
                 ("plant_code", 11, 3, "int"), ("company_name", 14, 25, "string"), ("plant_name", 39, 11, "string"),
                 ("capacity_kw", 50, 7, "long"), ("fuel_name", 57, 9, "string"), ("nad_utility_id", 66, 5, "string"),
                 ("frequency", 72, 1, "string"), ("effective_date", 73, 4, "string"), ("status", 77, 1, "string"),
                 ("multistate_code", 78, 3, "string"), ("year2", 81, 2, "int"), ("electric_plant_code", 395, 4, "int"),
                 ("nerc", 399, 2, "string"), ("company_number", 401, 5, "int"), ("fuel_description", 406, 3, "string"),
                 ("prime_mover_description", 409, 2, "string")]
MONTHLY_GROUP = [("generation", 0, 10, "double"), ("consumption", 10, 8, "double"), ("stocks", 18, 8, "double")]
# Code lists of the layout.
OWNERSHIP = [("1", "Privately Owned"), ("5", "Municipal"), ("7", "Federal"), ("8", "Cooperative"),
             ("9", "Power Districts, State Projects")]
PRIME_MOVER = [("1", "Hydro"), ("2", "Steam"), ("3", "Internal Combustion"), ("4", "Gas Turbine"),
               ("5", "Combined Cycle (Steam)"), ("6", "Combined Cycle (Gas Turbine)"), ("7", "Wood Turbine"),
               ("8", "Solar")]
FUEL = [("1", "Nuclear"), ("2", "Light Oil"), ("3", "Heavy Oil"), ("4", "Anthracite"), ("5", "Coke"),
        ("6", "Bituminous"), ("7", "Lignite"), ("8", "Fuel Oil"), ("9", "Natural Gas"), ("A", "Geothermal"),
        ("B", "Wood"), ("C", "Waste"), ("D", "Wind"), ("E", "Solar - Photovoltaic"), ("F", "Solar - Thermal")]
NERC = [("01", "ECAR"), ("02", "ERCOT"), ("03", "MAAC"), ("04", "MAIN"), ("05", "MAPP"), ("06", "NPCC"),
        ("07", "SERC"), ("08", "SPP"), ("09", "WSCC"), ("10", "ASCC"), ("11", "HICC")]


def fuel_master_monthly(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """Fixed-width master records (column ``value``) -> one row per plant,
    fuel and month with generation in MWh (kWh before 1990) and decoded codes.
    A blank ownership / fuel code means industrial / water."""
    d = lines.select(*R.fixed_width(F.col("value"), MASTER_FIELDS),
                     F.explode(R.repeating_group(F.col("value"), 83, 12, MONTHLY_GROUP)).alias("m"))
    d = d.withColumn("year", F.when(F.col("year2").isNull(), None).otherwise(F.col("year2") + 1900)).drop("year2")
    d = d.select("*", "m.*").drop("m")
    d = d.withColumn("generation_mwh", generation_mwh(F.col("generation"), F.col("year")))

    def decode(df, col, table, out, blank=None):
        lk = spark.createDataFrame(table, f"{col} string, {out} string")
        df = df.join(F.broadcast(lk), col, "left")
        return df.withColumn(out, F.when(F.col(col).isNull() & F.lit(blank is not None), F.lit(blank))
                             .otherwise(F.col(out)))

    d = decode(d, "ownership", OWNERSHIP, "ownership_label", "Industrial")
    d = decode(d, "prime_mover", PRIME_MOVER, "prime_mover_label")
    d = decode(d, "fuel", FUEL, "fuel_label", "Water")
    return decode(d, "nerc", NERC, "nerc_label")

