"""Secret scans by a trigram inverted index, with DataFrame functions only.

Each rule's regex is turned into a Boolean query over trigrams that every match must hold: an OR of
ANDs.  The index has one posting (trigram, document) for the trigrams that some rule asks for.
Intersecting the postings of a conjunction gives the candidates of its rule, and only they are searched
with the regex.  A rule whose regex has no mandatory trigram is searched in every document.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass
from re import _constants as rc
from re import _parser as rp

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """kind and regex; a match counts when `counted` (a group, 0: all) has at least `least` characters."""
    kind: str
    pattern: str
    counted: int = 0
    least: int = 1


# The base rules as given, then further kinds of public key formats.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
)
# A key block runs to its END line, with no five dashes between; without that line, over its headers and the base64
# that follows: long pieces, padded ones and lines of nothing else, also with written-out or quoted line ends.
# Possessive throughout: no regex engine goes back over or recurses into a long body.
PEM_TO_END = r"""[^-]*+(?:-{1,4}+[^-]++)*+-----END [A-Z ]*PRIVATE KEY-----"""
PEM_HEADERS = r"""(?:(?:\s|\\[nr])*+(?:Proc-Type|DEK-Info):[^\r\n\\]*+)*+"""
PEM_PIECE = r"""(?:[\s>"'|,]|\\[nrt])*+[A-Za-z0-9+/]++(?:(?<=[A-Za-z0-9+/]{16})={0,2}+|={1,2}+(?![A-Za-z0-9"']))"""
PEM_LINE = r"""(?:[ \t]*+\r?+\n[ \t>]*+|(?:\\[nr])++)[A-Za-z0-9+/]++={0,2}+[ \t]*+(?![^\r\n\\"'])"""
PEM = rf"""-----BEGIN [A-Z ]*PRIVATE KEY-----(?:{PEM_TO_END}|{PEM_HEADERS}(?:{PEM_PIECE}|{PEM_LINE})*+)"""

MORE_RULES = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", r"AIza[A-Za-z0-9_-]+", 0, 39),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]+", 0, 24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
    Rule("pem", PEM),
)
RULES = BASE_RULES + MORE_RULES

#: Sets of literal strings larger than this are not multiplied further; the query then only gets weaker.
MOST_STRINGS = 64

Query = frozenset[frozenset[str]]  # OR of ANDs of lower-case trigrams
ALL: Query = frozenset([frozenset()])


# ---- Boolean trigram queries ----------------------------------------------------------------------------

def trigrams(text: str) -> frozenset[str]:
    low = text.lower()
    return frozenset(low[i: i + 3] for i in range(len(low) - 2))


def both(a: Query, b: Query) -> Query:
    """A AND B, without clauses that another one implies."""
    return least(frozenset(x | y for x in a for y in b))


def least(q: Query) -> Query:
    return frozenset(x for x in q if not any(y < x for y in q))


def either(strings: set[str]) -> Query:
    return least(frozenset(trigrams(s) for s in strings))


def trigram_query(pattern: str) -> Query:
    """The query that every text with a match of the pattern fulfils; ALL if no trigram is mandatory.

    Runs of literals and alternatives are kept as sets of whole strings, so that trigrams across their
    borders count; anything else ends a run.  All strings are lower-cased, like the index.
    """
    def walk(tree) -> tuple[Query, set[str] | None]:
        """Query of what is settled, and the strings of the run that ends here (None: no run)."""
        query, run = ALL, {""}
        for op, arg in tree:
            strings, inner = None, ALL
            if op is rc.LITERAL:
                strings = {chr(arg).lower()}
            elif op is rc.IN and all(o is rc.LITERAL for o, _ in arg) and len(arg) <= 8:
                strings = {chr(c).lower() for _, c in arg}
            elif op is rc.SUBPATTERN:
                inner, strings = walk(arg[-1])
            elif op is rc.BRANCH:
                parts = [walk(t) for t in arg[1]]
                if all(s is not None and q == ALL for q, s in parts):
                    strings = set().union(*(s for _, s in parts))
                else:
                    inner = least(frozenset().union(*(both(q, either(s or {""})) for q, s in parts)))
            elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT, rc.POSSESSIVE_REPEAT):
                low, high, body = arg
                part, strings = walk(body)
                if (low, high) == (0, 1) and strings is not None and part == ALL:
                    strings = strings | {""}
                elif low >= 1:
                    inner, strings = both(part, either(strings or {""})), None
                else:
                    strings = None
            elif op is rc.AT:
                strings = {""}
            query = both(query, inner)
            if strings is None or len(run) * len(strings) > MOST_STRINGS:
                query, run = both(query, either(run)), strings if strings is not None else {""}
            else:
                run = {a + b for a, b in itertools.product(run, strings)}
        whole = query == ALL and all(op in (rc.LITERAL, rc.IN, rc.SUBPATTERN, rc.BRANCH, rc.AT, rc.MAX_REPEAT) for op, _ in tree) and settled(tree)
        return (ALL, run) if whole else (both(query, either(run)), None)

    query, run = walk(rp.parse(pattern))
    return both(query, either(run)) if run is not None else query


def settled(tree) -> bool:
    """Whether the tree matches only strings that a run lists: no open repeats and no large classes."""
    for op, arg in tree:
        if op is rc.IN and not (all(o is rc.LITERAL for o, _ in arg) and len(arg) <= 8):
            return False
        if op is rc.SUBPATTERN and not settled(arg[-1]):
            return False
        if op is rc.BRANCH and not all(settled(t) for t in arg[1]):
            return False
        if op is rc.MAX_REPEAT and not (tuple(arg[:2]) == (0, 1) and settled(arg[2])):
            return False
    return True


# ---- index and candidates ----------------------------------------------------------------------------------

def text_key(text: str) -> list[Column]:
    """Equal texts have equal keys, and get equal spans; so rows may repeat and ids may be NULL."""
    return [F.xxhash64(text), F.length(text)]


def postings(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(trigram, k1, k2): one posting per different text and trigram of the rules' queries."""
    wanted = sorted({t for r in rules for clause in trigram_query(r.pattern) for t in clause})
    low = docs.select(*(c.alias(n) for c, n in zip(text_key("text"), ("k1", "k2"))), F.lower("text").alias("low"))
    held = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in wanted)))
    return low.select("k1", "k2", F.explode(held).alias("trigram")).distinct()


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(k1, k2, kinds): the texts whose postings fulfil some rule's query, and which rules'.

    A conjunction of n trigrams is fulfilled by the texts that have n postings among its trigrams; the
    sums start before the shuffle, so a frequent trigram is no hot key.
    """
    clauses = [(r.kind, i, sorted(c)) for r in rules for i, c in enumerate(sorted(trigram_query(r.pattern), key=sorted)) if c]
    uses = {}
    for kind, i, clause in clauses:
        for t in clause:
            uses.setdefault(t, []).append(f"{kind}:{i}:{len(clause)}")
    clause_of = F.create_map(*itertools.chain.from_iterable((F.lit(t), F.array(*map(F.lit, u))) for t, u in sorted(uses.items()))) if uses else None
    posted = postings(docs, rules)
    if clause_of is None:
        return posted.select("k1", "k2", F.array(F.lit("")).alias("kinds")).limit(0)
    parts = F.split("clause", ":")
    return (posted.select("k1", "k2", F.explode(clause_of[F.col("trigram")]).alias("clause"))
            .groupBy("k1", "k2", "clause").count()
            .where(F.col("count") == parts[2].cast("int"))
            .groupBy("k1", "k2").agg(F.collect_set(parts[0]).alias("kinds")))


# ---- verification ---------------------------------------------------------------------------------------------

def spans(text: Column, rule: Rule) -> Column:
    """array<struct<start, stop>> (code points) of the rule's counted matches, leftmost and non-overlapping.

    What lies between matches and the matches themselves have their lengths added up in turn.
    """
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    counted = F.regexp_extract_all(text, pattern, F.lit(rule.counted))
    gaps = F.split(text, rule.pattern, -1)
    rows = F.arrays_zip(gaps.alias("gap"), found.alias("hit"), counted.alias("part"))
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("out"))

    def step(acc: Column, row: Column) -> Column:
        start = acc["at"] + F.length(row["gap"])
        stop = start + F.length(F.coalesce(row["hit"], F.lit("")))
        keep = F.length(row["part"]) >= rule.least
        return F.struct(stop.alias("at"), F.when(keep, F.concat(acc["out"], F.array(F.struct(start.alias("start"), stop.alias("stop"))))).otherwise(acc["out"]).alias("out"))

    return F.when(F.size(found) > 0, F.aggregate(rows, state, step)["out"])


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, text and found: array<struct<start, rank, kind, stop>> by start, then the rules' order.

    One row per row of docs(doc_id, text).  A NULL text is an empty one; texts are searched whole; a rule
    with no match in a row adds nothing.  Repeated rows, NULL ids and empty tables need no care: candidates
    are looked up by text.  Other columns are not read.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    indexed = {r.kind for r in rules if trigram_query(r.pattern) != ALL}
    if indexed:
        keyed = rows.withColumns(dict(zip(("k1", "k2"), text_key("text"))))
        rows = keyed.join(candidates(rows, rules), ["k1", "k2"], "left")
    empty = F.array().cast("array<struct<start:int,stop:int>>")
    marked = []
    for rank, r in enumerate(rules):
        of_rule = spans(F.col("text"), r)
        if r.kind in indexed:
            of_rule = F.when(F.array_contains("kinds", r.kind), of_rule)
        marked.append(F.transform(F.coalesce(of_rule, empty), as_found(rank, r.kind)))
    return rows.select("doc_id", "text", F.sort_array(F.concat(*marked)).alias("found"))


def as_found(rank: int, kind: str):
    return lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"), s["stop"].alias("stop"))


def span_text(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def secret_spans(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, digest of the base spans and all spans as text."""
    base = [r.kind for r in BASE_RULES]
    n = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return find_secrets(docs).select(
        "doc_id", *map(n, base),
        F.sha2(span_text(F.filter("found", lambda s: s["kind"].isin(base))), 256).alias("base_sha256"),
        span_text(F.col("found")).alias("spans"))


def redact(docs: DataFrame) -> DataFrame:
    """docs with each found span of `text` replaced by its kind in brackets; every other column stays.

    Overlapping spans are replaced as one, under the first one's kind.
    """
    names = docs.columns
    packed = docs.select(F.struct(*names).alias("doc_id"), F.col("text"))
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        clean = F.substring("text", acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(F.greatest(acc["at"], s["stop"]).alias("at"),
                        F.when(s["start"] >= acc["at"], F.concat(acc["out"], clean, F.lit("["), F.upper(s["kind"]), F.lit("]"))).otherwise(acc["out"]).alias("out"))

    done = F.aggregate("found", state, step, lambda acc: F.concat(acc["out"], F.substring("text", acc["at"] + 1, F.length("text"))))
    text = F.when(F.size("found") > 0, done).otherwise(F.col("doc_id.text"))
    return find_secrets(packed).select(*(text.alias(c) if c == "text" else F.col(f"doc_id.{c}").alias(c) for c in names))
