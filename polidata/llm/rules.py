"""Quality rules whose cutoffs carry a guarantee: exact binomial tests on labelled documents.

Each rule is a ratio that is high for junk.  In each stratum (a band of text lengths) one sequence of joint cutoffs, fixed
beforehand, goes from lax to strict: at step c a text is rejected when any of its ratios is over c.  The labelled good
texts of the stratum that pass the base rule are the holdout, exact copies counted once; those over c are false
rejections of the union of all rules.  The steps are tested in order, "the false rejection rate is over ALPHA" being
refuted by the exact binomial test at level DELTA / number of strata (the same as a Clopper-Pearson upper bound below
ALPHA), until the first step that is not refuted; the last one before it is used.  A test that is only made after all
laxer ones have passed needs no correction for the steps or the rules, only for the strata.  So with probability
1 - DELTA, in every stratum at once, at most ALPHA of the good texts are lost to these rules, all rules together.

A stratum needs 217 good texts without one false rejection (at 2 % and 5 %, four strata); with fewer nothing is certified
and only the base rule rejects there.  Texts that differ in a few words count as independent.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from polidata.llm.common import BLANKS, written

SYMBOLS = "#*$%&|<>"
ALPHA = 0.02
DELTA = 0.05
#: Lower ends of the strata, in words.
BANDS = (0, 100, 300, 1000)
GRID = tuple(i / 64 for i in range(1, 129))

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_exclaim")


def repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice (all their places count)."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    pairs = np.unique(ids[:-2] * n + ids[1:-1], return_inverse=True)[1]
    _, window, times = np.unique(pairs * n + ids[2:], return_inverse=True, return_counts=True)
    twice = times[window] > 1
    inside = np.zeros(n, bool)
    for k in range(3):
        inside[k: n - 2 + k] |= twice
    return int(inside.sum())


def dup_lines(lines: list[str]) -> int:
    seen: set[str] = set()
    repeated = 0
    for line in lines:
        if line.strip(BLANKS):
            repeated += line in seen
            seen.add(line)
    return repeated


def text_counts(text: str | None) -> tuple[int, ...]:
    """COUNTS of one whole text; all 0 for NULL, and n_lines counts lines with a word."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    lines = text.split("\n")
    capitals = sum(map(str.isupper, text)) if not text.islower() else 0
    return (len(words), len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), dup_lines(lines),
            repeat_words(words), sum(1 for x in lines if x.strip(BLANKS)), capitals, text.count("!"))


def add_counts(docs: DataFrame) -> DataFrame:
    """doc_id, COUNTS (long) and text_key (16 bytes of BLAKE2b; NULL as empty) for every row of docs(doc_id, text)."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1)]
            rows = np.array([text_counts(t) for t in texts], np.int64).reshape(-1, len(COUNTS))
            keys = [hashlib.blake2b((t or "").encode("utf-8", "surrogatepass"), digest_size=16).digest() for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, np.ascontiguousarray(rows.T)), pa.array(keys, pa.binary())],
                                             ["doc_id", *COUNTS, "text_key"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        count, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in COUNTS) + ", text_key binary")


def ratio(over: str, under: str) -> Column:
    return F.col(over) / F.greatest(F.col(under), F.lit(1))


def rule_columns() -> dict[str, Column]:
    return {"symbols": ratio("n_symbols", "n_words"), "dup_lines": ratio("n_dup_lines", "n_lines"),
            "repeats": ratio("n_repeat_words", "n_words"), "capitals": ratio("n_upper", "word_chars"),
            "exclaims": ratio("n_exclaim", "n_words")}


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def stratum() -> Column:
    return sum((F.col("n_words") >= low).cast("int") for low in BANDS[1:])


# ---- exact binomial test ----------------------------------------------------------------------------------

def beta_cdf(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function, by its continued fraction (modified Lentz)."""
    if x <= 0 or x >= 1:
        return float(x >= 1)
    if x > (a + 1) / (a + b + 2):
        return 1 - beta_cdf(1 - x, b, a)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny, c, d = 1e-300, 1.0, 0.0
    d = 1 / (1 - (a + b) * x / (a + 1) or tiny)
    f = d
    for m in range(1, 10_000):
        for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / ((1 + term * d) or tiny)
            c = (1 + term / c) or tiny
            f *= c * d
        if abs(c * d - 1) < 1e-14:
            break
    return front * f


def p_at_most(k: int, n: int, rate: float) -> float:
    """P(X <= k) for X ~ Binomial(n, rate)."""
    return 1.0 if k >= n else beta_cdf(1 - rate, n - k, k + 1)


def certified_cutoffs(counts: dict[int, list[int]], alpha: float = ALPHA, delta: float = DELTA,
                      grid: tuple[float, ...] = GRID) -> dict[int, float]:
    """Cutoff by stratum, from counts[stratum][i]: good texts whose largest ratio is over exactly i cutoffs of the grid.

    The steps go down the grid and end at the first that is not certified; strata without a certified step are left out.
    """
    level = delta / len(BANDS)
    found = {}
    for s, by_bin in counts.items():
        n, over = sum(by_bin), 0
        for i in reversed(range(len(grid))):
            over += by_bin[i + 1]
            if not n or p_at_most(over, n, alpha) > level:
                break
            found[s] = grid[i]
    return found


def good_counts(counted: DataFrame, labels: DataFrame, grid: tuple[float, ...] = GRID) -> dict[int, list[int]]:
    """Counts for certified_cutoffs over all labelled good texts that pass the base rule, each text once.

    At most strata x bins rows reach the driver.
    """
    good = (labels.where(F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
            .where("quality = 1").select(F.col("doc_id").alias("good_id")))
    largest = F.greatest(*rule_columns().values())
    step = F.lit(len(grid) / grid[-1])
    over = F.least(F.lit(len(grid)), F.greatest(F.lit(0), F.ceil(largest * step) - 1)).cast("int")
    rows = (counted.where(~base_failed()).join(good, F.col("doc_id") == F.col("good_id"))
            .select(stratum().alias("stratum"), over.alias("bin"), "text_key").distinct()
            .groupBy("stratum", "bin").count().collect())
    found = {s: [0] * (len(grid) + 1) for s in range(len(BANDS))}
    for row in rows:
        found[row["stratum"]][row["bin"]] += row["count"]
    return found


def quality_verdicts(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """One row per row of docs(doc_id, text): doc_id, COUNTS, base_failed, failed_rules, kept.

    labels(doc_id, quality) may repeat an id (the lowest label counts) or hold NULLs (not used); without
    labels no cutoff is certified and only the base rule rejects.  NULL and empty texts have no words
    and fail the base rule.  Repeated rows are judged alike, one by one; other columns are not read.
    """
    counted = written(add_counts(docs), "rule-counts")
    cutoffs = certified_cutoffs(good_counts(counted, labels), alpha, delta)
    values = rule_columns()
    hits = [F.when((stratum() == s) & (values[rule] > cut), F.lit(rule)) for s, cut in sorted(cutoffs.items()) for rule in sorted(values)]
    failed = F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")
    return (counted.withColumns({"base_failed": base_failed(), "failed_rules": failed})
            .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("text_key"))
