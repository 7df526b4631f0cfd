import collections
import math
import random
import re

from polidata.llm import queries, rules


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i: i + 3]) for i in range(len(words) - 2)]
    times = collections.Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


def test_base_counts(shipped, sf, texts):
    got = {r["doc_id"]: r for r in queries.QUERIES["op10_rules"](shipped, sf).collect()}
    for i, t in texts:
        n, chars, symbols, dup, repeats = brute(t)
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (n, chars, symbols, dup, repeats)
        assert r["base_failed"] == (n < 50 or 100 * repeats > 50 * n) and not (r["kept"] and r["base_failed"])


def test_counts_of_random_texts():
    r = random.Random(5)
    for _ in range(300):
        text = "".join(r.choice("ab \n\t é#|") for _ in range(r.randint(0, 60)))
        assert rules.text_counts(text)[:5] == brute(text)


def test_binomial_tail():
    for n, k, p in ((10, 3, 0.2), (50, 0, 0.1), (200, 30, 0.1), (7, 7, 0.5), (1000, 2, 0.01)):
        exact = sum(math.comb(n, i) * p ** i * (1 - p) ** (n - i) for i in range(k + 1))
        assert abs(rules.p_at_most(k, n, p) - exact) < 1e-9


def test_certified_cutoffs_hold_their_rate():
    """Over repeated samples of all strata, a cutoff that rejects too many good texts is hardly ever certified in any."""
    r = random.Random(8)
    bad = 0
    for _ in range(200):
        counts = {}
        for s in range(len(rules.BANDS)):
            bins = [0] * (len(rules.GRID) + 1)
            for _ in range(600):
                bins[min(len(rules.GRID), int(r.expovariate(0.2)))] += 1
            counts[s] = bins
        cuts = rules.certified_cutoffs(counts, alpha=0.02)
        assert cuts
        bad += any(math.exp(-0.2 * (rules.GRID.index(c) + 1)) > 0.02 for c in cuts.values())
    assert bad <= 18


def test_a_stratum_needs_217_good_texts():
    none = [0] * len(rules.GRID)
    assert rules.certified_cutoffs({0: [216, *none], 1: [217, *none], 2: [0, *none]}) == {1: rules.GRID[0]}
    # one text far out: the sequence ends before it is reached, although stricter steps are never looked at
    assert rules.certified_cutoffs({0: [250, *none[:-1], 1]}) == {}


def brute_verdicts(rows, labels):
    """kept by id: the steps of each stratum one by one, on sets of texts, with exact binomial sums."""
    def judge(text):
        n, chars, symbols, dup, repeats = brute(text)
        text = text or ""
        filled = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in text.split("\n"))
        ratios = (symbols / max(1, n), dup / max(1, filled), repeats / max(1, n), sum(c.isupper() for c in text) / max(1, chars),
                  text.count("!") / max(1, n))
        return sum(n >= b for b in (100, 300, 1000)), n < 50 or 100 * repeats > 50 * n, max(ratios)

    facts = {i: judge(t) for i, t in rows}
    cuts = {}
    for s in range(4):
        good = {t: facts[i][2] for i, t in rows if labels.get(i) == 1 and facts[i][0] == s and not facts[i][1]}
        n = len(good)
        for step in range(128, 0, -1):
            k = sum(m > step / 64 for m in good.values())
            if not n or sum(math.comb(n, j) * 0.02 ** j * 0.98 ** (n - j) for j in range(k + 1)) > 0.05 / 4:
                break
            cuts[s] = step / 64
    return {i: not failed and not (s in cuts and m > cuts[s]) for i, (s, failed, m) in facts.items()}, cuts


def test_verdicts_against_brute_force(shipped):
    r = random.Random(3)

    def text(n, share, sign):
        words = ["".join(r.choice("abcdefgh") for _ in range(5)) + (sign if r.random() < share else "") for _ in range(n)]
        return "\n".join(" ".join(words[i: i + 12]) for i in range(0, n, 12))

    rows, labels = [], {}
    for i in range(1500):
        good = r.random() < 0.8
        n = r.choice((60, 70, 150, 400, 1100 if i % 8 == 0 else 120))
        rows.append((i, text(n, abs(r.gauss(0, 0.08)) if good else r.random(), r.choice("%!#"))))
        labels[i] = int(good)
    rows += [(5000 + i, rows[0][1]) for i in range(300)] + [(6000, None), (6001, "")]     # copies of a text count once
    labels |= {5000 + i: 1 for i in range(300)}
    want, cuts = brute_verdicts(rows, labels)
    assert len(cuts) == 3 and 3 not in cuts                                           # too few long texts
    docs = shipped.createDataFrame(rows, "doc_id long, text string")
    marks = shipped.createDataFrame(list(labels.items()), "doc_id long, quality int")
    got = {x["doc_id"]: x["kept"] for x in rules.quality_verdicts(docs, marks).collect()}
    assert got == want
    assert sum(not got[i] for i in range(1500) if labels[i] == 0) > 50


def test_rules_reject_junk_and_keep_good(shipped):
    r = random.Random(1)
    good = [(i, " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(120)), 1) for i in range(3000)]
    junk = [(10_000 + i, " ".join("".join(r.choice("abcdefgh") for _ in range(5)) + "%%%" for _ in range(120)), 0) for i in range(50)]
    docs = shipped.createDataFrame(good + junk, "doc_id long, text string, quality int")
    got = rules.quality_verdicts(docs, docs.select("doc_id", "quality"), alpha=0.05).collect()
    assert all(x["kept"] == (x["doc_id"] < 10_000) for x in got)


def test_odd_rows(odd, no_docs, odd_labels, no_labels):
    assert rules.quality_verdicts(odd, odd_labels).count() == odd.count() == rules.quality_verdicts(odd, no_labels).count()
    assert not any(r["kept"] for r in rules.quality_verdicts(odd, odd_labels).collect()) and rules.quality_verdicts(no_docs, odd_labels).count() == 0
