"""Readers for the file families of the warehouse.  Schemas are always
declared; nothing is inferred on production paths."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _ddl(schema: T.StructType | str) -> str:
    return schema if isinstance(schema, str) else schema.simpleString()[len("struct<"):-1].replace(":", " ")


def read_csv(spark: SparkSession, paths, schema, sep: str = ",", header: bool = True,
             encoding: str = "UTF-8", glob: str | None = None) -> DataFrame:
    """Delimited files with a header row."""
    r = spark.read.schema(schema).option("header", header).option("sep", sep).option("encoding", encoding) \
        .option("mode", "PERMISSIVE")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.csv(paths)


def read_csv_after_preamble(spark: SparkSession, paths, schema, preamble: int, sep: str = ",",
                            header: bool = True) -> DataFrame:
    """CSV whose first ``preamble`` lines are free text.

    Every file keeps its own preamble and header; large files are read in splits (``numbered_lines``)."""
    lines = numbered_lines(spark, paths)
    first = preamble + (1 if header else 0)
    lines = lines.filter((F.col("line_no") >= first) & (F.length("line") > 0))
    parsed = F.from_csv("line", _ddl(schema), {"sep": sep, "mode": "PERMISSIVE"})
    return lines.select("file_path", "line_no", parsed.alias("r")).select("file_path", "line_no", "r.*")


def numbered_lines(spark: SparkSession, paths) -> DataFrame:
    """(file_path, line_no, line) of text files, line_no from 0, with files read in splits.

    A split is read in order by one task, so its lines are numbered by the row counter of the task; a first pass
    counts the lines and the first row of each split, and the counts summed up over the splits before it in its file
    turn that into a line number.  Lines end in LF or CRLF.  Should the two passes ever be cut differently, the
    query fails instead of numbering wrongly.  No line is held together with its file, so a file has no size limit.
    """
    raw = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("_start"),
        F.spark_partition_id().alias("_task"), F.monotonically_increasing_id().alias("_row"), "value")
    splits = raw.groupBy("file_path", "_start", "_task").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy("file_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1))
    splits = splits.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_n")
    j = raw.join(splits, ["file_path", "_start", "_task"], "left")
    number = F.when(F.col("_row") >= F.col("_first"), F.col("_before") + F.col("_row") - F.col("_first")) \
        .otherwise(F.raise_error(F.lit("the splits of a file changed between two passes")).cast("long"))
    return j.select("file_path", number.alias("line_no"), F.regexp_replace("value", "\r$", "").alias("line"))


def read_csv_dropping(spark: SparkSession, paths, schema, drop_regex: str, header_regex: str | None = None,
                      sep: str = ",") -> DataFrame:
    """CSV where preamble/header lines are recognised by content (scalable S2)."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("line"))
    lines = lines.filter(~F.col("line").rlike(drop_regex) & (F.length("line") > 0))
    if header_regex:
        lines = lines.filter(~F.col("line").rlike(header_regex))
    parsed = F.from_csv("line", _ddl(schema), {"sep": sep, "mode": "PERMISSIVE"})
    return lines.select("file_path", parsed.alias("r")).select("file_path", "r.*")


def strip_to_number(c: Column) -> Column:
    """Numeric text with stray characters ('12.5 %', '$1,200') -> double (S3)."""
    return F.nullif(F.regexp_replace(c, r"[^0-9.\-]", ""), F.lit("")).try_cast("double")


def tag_from_path(df: DataFrame, pattern: str, name: str, cast: str | None = None) -> DataFrame:
    """Column from the source file name, e.g. the year."""
    c = F.regexp_substr(F.col("_metadata.file_path"), F.lit(pattern))
    return df.withColumn(name, c.cast(cast) if cast else c)


def fixed_width(line: Column, spec: list[tuple[str, int, int, str]]) -> list[Column]:
    """Columns cut from a fixed-width record: (name, 1-based start, width, type)."""
    out = []
    for name, start, width, typ in spec:
        c = F.trim(F.substring(line, start, width))
        c = F.nullif(c, F.lit(""))
        out.append((c if typ == "string" else c.try_cast(typ)).alias(name))
    return out


def repeating_group(line: Column, start: int, count: int, fields: list[tuple[str, int, int, str]]) -> Column:
    """Array of ``count`` structs cut from a repeating group.

    ``fields`` = (name, offset inside the group (0-based), width, type); the
    group width is the sum of the widths."""
    gw = sum(w for _, _, w, _ in fields)

    def one(i):
        parts = []
        for name, off, w, typ in fields:
            c = F.nullif(F.trim(F.substring(line, F.lit(start) + i * gw + off, F.lit(w))), F.lit(""))
            parts.append((c if typ == "string" else c.try_cast(typ)).alias(name))
        return F.struct((i + 1).alias("month"), *parts)

    return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), one)


def sanitize_delimiter(c: Column, delim: str = ",", repl: str = ";") -> Column:
    """Replace a delimiter inside free text before a delimited load."""
    return F.translate(c, delim, repl)


def read_json_nested(spark: SparkSession, paths, schema, multiline: bool = True) -> DataFrame:
    """Nested documents (person -> repeated terms) with a declared schema."""
    return spark.read.schema(schema).option("multiLine", multiline).option("mode", "PERMISSIVE").json(paths)


def fitting(c, width: int, pad: str) -> Column:
    """Text padded on the left to a record field; a longer value stays whole, which `fixed_record` finds."""
    c = c.cast("string")
    return F.lpad(c, F.greatest(F.length(c), F.lit(width)), pad)


def fixed_record(parts: list[Column], width: int) -> Column:
    """A fixed-width record from its fields; one field too long, and it raises instead of being cut."""
    record = F.concat(*parts)
    return F.when(record.isNull() | (F.length(record) == width), record).otherwise(
        F.raise_error(F.concat(F.lit("a field does not fit the record: "), record)))


# -- HTML pattern extraction over stored pages (S13, S14) --------------------
def strip_tags(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"<[^>]+>", ""))


def html_links(html: Column, href_prefix: str = "") -> Column:
    """Array of struct(href, text) for ``<a href=...>text</a>`` in page order."""
    pat = r"""(?is)<a\b[^>]*?\bhref\s*=\s*(["'])(.*?)\1[^>]*>(.*?)</a>"""
    hrefs = F.regexp_extract_all(html, F.lit(pat), 2)
    texts = F.regexp_extract_all(html, F.lit(pat), 3)
    z = F.arrays_zip(hrefs.alias("href"), texts.alias("text"))
    if href_prefix:
        z = F.filter(z, lambda s: s["href"].startswith(href_prefix))
    return z


def html_elements(html: Column, tag: str) -> Column:
    """Inner HTML of every ``<tag ...>...</tag>`` element, in page order."""
    return F.regexp_extract_all(html, F.lit(rf"(?s)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"), 1)


# -- header detection inside a cell grid (S16) -------------------------------
def detect_header(cells: DataFrame, doc: list[str], idx: str, arr: str, label: str,
                  within: int = 10) -> DataFrame:
    """Locate the header row (first row among the first ``within`` rows whose
    cells contain ``label``, case-insensitive) and keep the rows after it.

    Adds ``hdr_idx`` and ``hdr_col`` (1-based cell position of the label)."""
    pos = F.array_position(F.transform(F.col(arr), lambda x: F.lower(x)), label.lower())
    hits = cells.filter((F.col(idx) < within) & (pos > 0)) \
        .groupBy(*doc).agg(F.min_by(F.struct(F.col(idx).alias("i"), pos.alias("c")), F.col(idx)).alias("_h"))
    out = cells.join(hits, doc).filter(F.col(idx) > F.col("_h.i"))
    return out.withColumns({"hdr_idx": F.col("_h.i"), "hdr_col": F.col("_h.c").cast("int")}).drop("_h")


def list_files(spark: SparkSession, directory: str, glob: str = "*") -> DataFrame:
    """File listing (path, length, modificationTime) without reading content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob) \
        .option("recursiveFileLookup", True).load(directory).select("path", "length", "modificationTime")


def pick_file(listing: DataFrame, name_regex: str | None = None) -> DataFrame:
    """The largest file, or the largest one whose name matches ``name_regex``."""
    lst = listing.filter(F.col("path").rlike(name_regex)) if name_regex else listing
    return lst.agg(F.max_by("path", F.struct("length", "path")).alias("path"), F.max("length").alias("length"))


def html_table_rows(html: Column, k: int = 0) -> Column:
    """Rows of the k-th ``<table>`` as an array of cell-text arrays."""
    tables = F.regexp_extract_all(html, F.lit(r"(?s)<table[^>]*>(.*?)</table>"), 1)
    rows = F.regexp_extract_all(F.coalesce(F.get(tables, k), F.lit("")), F.lit(r"(?s)<tr[^>]*>(.*?)</tr>"), 1)
    return F.transform(rows, lambda r: F.transform(
        F.regexp_extract_all(r, F.lit(r"(?s)<t[dh][^>]*>(.*?)</t[dh]>"), 1), strip_tags))


def wide_text_to_long(lines: DataFrame, header_line: int, sep: str = "|", key: str = "key") -> DataFrame:
    """Delimited text whose header names vary by file (dates as columns) ->
    (file_path, key, name, value) without a fixed schema."""
    s = re.escape(sep)
    hdr = lines.filter(F.col("line_no") == header_line).select("file_path", F.split("line", s).alias("names"))
    body = lines.filter((F.col("line_no") > header_line) & (F.length(F.trim("line")) > 0)) \
        .select("file_path", F.split("line", s).alias("vals"))
    j = body.join(hdr, "file_path")
    z = j.select("file_path", F.trim(F.get("vals", 0)).alias(key),
                 F.explode(F.slice(F.arrays_zip(F.col("names").alias("n"), F.col("vals").alias("v")), F.lit(2),
                                   F.greatest(F.size("names"), F.size("vals")) - 1)).alias("z"))
    return z.select("file_path", key, F.trim("z.n").alias("name"), F.trim("z.v").alias("value"))


def csv_fields(line: Column, sep: str = ",") -> Column:
    """All fields of a delimited line, however many; quoted fields may hold the
    separator and doubled quotes.  Empty fields are NULL."""
    s = re.escape(sep)
    raw = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(rf'{s}("(?:[^"]++|"")*+"|[^{s}]*+)'), 1)
    return F.transform(raw, lambda f: F.nullif(F.when(
        f.startswith('"'), F.replace(F.regexp_replace(f, r'^"|"$', ""), F.lit('""'), F.lit('"'))).otherwise(f), F.lit("")))


def read_csv_by_header(spark: SparkSession, paths, header_regex: str, columns: list[str], sep: str = ",") -> DataFrame:
    """CSV files whose column sets differ: every file's values are mapped by
    *its own* header line (found by content, so files stay line-parallel),
    never by position.  Missing columns are NULL strings."""
    lines = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("line"))
    is_hdr = F.col("line").rlike(header_regex)
    hdr = lines.filter(is_hdr).groupBy("file_path").agg(
        F.first(F.transform(F.split("line", sep), lambda x: F.trim(x))).alias("names"))
    body = lines.filter(~is_hdr & (F.length(F.trim("line")) > 0)) \
        .select("file_path", csv_fields(F.col("line"), sep).alias("vals"))
    j = body.join(hdr, "file_path")
    pick = {c: F.when(F.array_position("names", c) > 0, F.get("vals", (F.array_position("names", c) - 1).cast("int")))
            for c in columns}
    return j.select("file_path", *[v.alias(c) for c, v in pick.items()])
