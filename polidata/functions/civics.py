"""Domain arithmetic: assembly numbers, election cycles, vote text, degree days."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from polidata.functions.nullsafe import _c

# The 1st assembly convened in 1789; each assembly lasts two years.
FIRST_ASSEMBLY_YEAR = 1789


def assembly_of_year(year) -> Column:
    """Assembly in session during ``year`` (1970 -> 91, 1971 -> 92, 2016 -> 114).

    Closed form of the year/assembly tables: a assembly starts in each odd year.
    """
    return F.floor((_c(year) - F.lit(FIRST_ASSEMBLY_YEAR - 2)) / 2).cast("int")


def cycle_of_assembly(assembly, convention: str = "closing") -> Column:
    """Election cycle for a assembly.

    ``closing``: the election held at the end of the assembly (101 -> 1990).
    ``electing``: the election that chose the assembly (103 -> 1992).
    """
    c = _c(assembly)
    if convention == "closing":
        return (c * 2 + 1788).cast("int")
    if convention == "electing":
        return (c * 2 + 1786).cast("int")
    raise ValueError(f"unknown convention {convention!r}")


def assembly_of_cycle(cycle, convention: str = "closing") -> Column:
    c = _c(cycle)
    off = 1788 if convention == "closing" else 1786
    if convention not in ("closing", "electing"):
        raise ValueError(f"unknown convention {convention!r}")
    return F.floor((c - off) / 2).cast("int")


def parse_votes(c) -> Column:
    """Vote text -> double: all thousands commas removed, 'Unopposed' -> +inf,
    anything else that is not a number -> NULL."""
    s = F.regexp_replace(F.trim(_c(c)), ",", "")
    s = F.when(s == "Unopposed", F.lit("Infinity")).otherwise(s)
    return s.try_cast("double")


def repair_year(y) -> Column:
    """Two-digit and zero years: 0 -> 2000, 1..99 -> 19xx, else unchanged."""
    y = _c(y)
    return F.when(y == 0, F.lit(2000)).when(y < 100, y + 1900).otherwise(y)


def district_number(c) -> Column:
    """'District 4' -> 4, 'At Large' -> 1, other text -> NULL."""
    s = F.trim(F.regexp_replace(_c(c), "District ", ""))
    s = F.when(s == "At Large", F.lit("1")).otherwise(s)
    return s.try_cast("int")


def district_code(fips, district) -> Column:
    """Two-character district code; at-large (0 / NULL district) -> '00'."""
    d = _c(district)
    return F.when(d.isNull() | (d == 0), F.lit("00")).otherwise(F.lpad(d.cast("string"), 2, "0"))


def fahrenheit_excess(temp_c) -> Column:
    """Degrees Fahrenheit above the 65 F base."""
    return _c(temp_c) * 9 / 5 + 32 - 65


def cooling_degree_days(temp_c) -> Column:
    """Round-half-even |d| when d >= 0, else 0; NULL stays NULL."""
    d = fahrenheit_excess(temp_c)
    return F.when(d.isNull(), None).when(d >= 0, F.bround(F.abs(d), 0)).otherwise(F.lit(0.0))


def heating_degree_days(temp_c) -> Column:
    d = fahrenheit_excess(temp_c)
    return F.when(d.isNull(), None).when(d <= 0, F.bround(F.abs(d), 0)).otherwise(F.lit(0.0))


def generation_mwh(gen, year) -> Column:
    """Generation reported in kWh before 1990 and MWh from 1990 on."""
    return F.when(_c(year) < 1990, _c(gen) / 1000).otherwise(_c(gen))
