import collections
import random

import numpy as np
import pytest

from polidata.llm import jaccard as J
from polidata.llm.common import WordHashes


def brute(rows, width, num):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[j: j + width]) for j in range(max(1, len(w) - width + 1))) if w else frozenset())
    where = collections.defaultdict(list)
    up = list(range(len(rows)))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a

    for k, s in enumerate(sets):
        for o, n in collections.Counter(o for e in s for o in where[e]).items():
            if 100 * n >= num * (len(s) + len(sets[o]) - n):
                up[find(k)] = find(o)
        for e in s:
            where[e].append(k)
    groups = collections.defaultdict(list)
    for k, (i, _) in enumerate(rows):
        groups[find(k)].append(i)
    least = {g: min((i for i in ids if i is not None), default=None) for g, ids in groups.items()}
    return sorted(((i, len(sets[k]), least[find(k)]) for k, (i, _) in enumerate(rows)), key=str)


def near_copies(seed=3, group=120):
    """Copies of one text with one to six words changed: many near misses in the same buckets."""
    r = random.Random(seed)
    base = [f"w{r.randint(0, 400)}" for _ in range(90)]
    rows = []
    for i in range(group):
        words = base[:]
        for _ in range(r.randint(0, 6)):
            words[r.randrange(len(words))] = f"x{r.randint(0, 30)}"
        rows.append((1000 + i, " ".join(words)))
    return rows


@pytest.mark.parametrize("width,num", [(3, 90), (5, 80)])
def test_against_all_pairs(shipped, texts, width, num):
    rows = texts + near_copies() + [(None, None), (-2, ""), (-2, " "), (-5, "a b"), (5000, "A  B"), (5001, "a b c"), (None, "a b c"), (5002, "a b c d"), (None, "q q q q")]
    docs = shipped.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in J.jaccard_components(docs, width, num, 100).collect()), key=str)
    assert got == brute(rows, width, num)


def test_similar_sets_share_a_signature():
    r = np.random.default_rng(1)
    for num in (80, 90):
        bands = J.Bands(num, 100)
        for _ in range(400):
            n = int(r.integers(10, 400))
            a = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64))
            b = a.copy()
            while True:
                c = np.unique(np.append(b[r.random(len(b)) > 0.5 / len(b)], r.integers(0, 1 << 63, 1).astype(np.uint64)))
                shared = len(np.intersect1d(a, c))
                if 100 * shared < num * (len(a) + len(c) - shared):
                    break
                b = c
            same = set(J.signatures(a, bands).tolist()) & set(J.signatures(b, bands).tolist())
            assert same or np.array_equal(a, b) or bands.differences(bands.of(len(a))[-1]) == 0
            x, y = J.sketch(a), J.sketch(b)
            size = min(len(x), len(y))
            x, y = (np.bitwise_xor.reduce(z.reshape(-1, size), axis=0) for z in (x, y))
            assert sum(int(bits).bit_count() for bits in (x ^ y).view(np.uint64)) <= len(np.setxor1d(a, b))


def test_sketches_keep_linked_sets_and_tell_long_ones_apart(shipped):
    r = np.random.default_rng(2)
    rows, truth = [], []
    for n in (3, 100, 126, 130, 1000, 6000):
        a = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64))
        for drop, add in ((0, 0), (1, 1), (n // 9, 0), (0, n // 5), (n // 20, n // 9), (n // 2, n // 2), (n - 1, n)):
            b = np.unique(np.append(a[drop:], r.integers(0, 1 << 63, add).astype(np.uint64)))
            shared = len(np.intersect1d(a, b))
            truth.append((100 * shared >= 80 * (len(a) + len(b) - shared), shared / (len(a) + len(b) - shared)))
            rows.append((len(truth) - 1, len(a), J.sketch(a).tolist(), len(b), J.sketch(b).tolist()))
    df = shipped.createDataFrame(rows, "i int, n_a long, s_a array<long>, n_b long, s_b array<long>")
    for ends in (("n_a", "s_a", "n_b", "s_b"), ("n_b", "s_b", "n_a", "s_a")):
        reach = dict(df.select("i", J.within_reach(*ends, 80, 100)).collect())
        for i, (linked, similarity) in enumerate(truth):
            assert reach[i] or not linked
            assert not reach[i] or similarity > 0.5  # also of thousands of elements


def test_a_hub_of_many_parts_and_repeated_rows(shipped, monkeypatch):
    monkeypatch.setattr(J, "PARTNERS", 7)
    rows = near_copies(seed=5, group=60)
    rows += [rows[0]] * 30 + [(9, rows[1][1])] * 5
    docs = shipped.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sorted((tuple(r) for r in J.jaccard_components(docs, 3, 90, 100).collect()), key=str)
    assert got == brute(rows, 3, 90)


def test_sets_of_texts():
    h = WordHashes()
    assert len(J.shingle_hashes(None, 3, h)) == 0 and len(J.shingle_hashes("a b", 3, h)) == 1 and len(J.shingle_hashes("a b a b a", 3, h)) == 2
    assert np.array_equal(J.shingle_hashes("A b\x0bC", 3, h), J.shingle_hashes("a B c", 3, h))


def test_one_per_group(shipped, odd, no_docs):
    kept = sorted(J.one_per_group(odd).collect(), key=str)
    assert len(kept) == odd.distinct().count() and kept[0].asDict().keys() == odd.first().asDict().keys()
    assert J.one_per_group(no_docs).count() == 0 and J.jaccard_components(no_docs).count() == 0
    rows = near_copies()
    docs = shipped.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r["doc_id"] for r in J.one_per_group(docs).collect()) == sorted({c for _, _, c in brute(rows, 5, 80)})


def test_bound_in_compiled_steps_is_the_whole_bound(shipped):
    """within_reach by the leading longs says what all bits of the folded sketches say, for sketches of all sizes."""
    r, rows = np.random.default_rng(6), []
    for n in (3, 40, 120, 130, 250, 260, 500, 700, 1100, 2100):
        base = r.integers(0, 2 ** 63, n).astype(np.uint64)
        for changed in (0, 1, n // 12, n // 9, n // 4, n):
            rows.append(np.unique(np.concatenate([base[changed:], r.integers(0, 2 ** 63, changed + n % 5).astype(np.uint64)])))
    table = shipped.createDataFrame([(i, len(e), J.sketch(e).tolist()) for i, e in enumerate(rows)], "i int, n long, s array<long>")
    a, b = (table.toDF(f"i_{x}", f"n_{x}", f"s_{x}") for x in "ab")
    found = a.crossJoin(b).where(J.within_reach("n_a", "s_a", "n_b", "s_b", 80, 100)).select("i_a", "i_b").collect()

    def bits(e, size):
        return np.unpackbits(J.sketch(e).view(np.uint8)).reshape(-1, size).sum(0) & 1

    want = set()
    for i, x in enumerate(rows):
        for j, y in enumerate(rows):
            size_x, size_y = len(J.sketch(x)) * 64, len(J.sketch(y)) * 64
            size = min(size_x, size_y)
            apart = int((bits(x, size) != bits(y, size)).sum()) if max(size_x, size_y) <= 2 * size else 0
            if 100 * min(len(x), len(y)) >= 80 * max(len(x), len(y)) and 180 * apart <= 20 * (len(x) + len(y)):
                want.add((i, j))
    assert len(want) > len(rows) and {tuple(p) for p in found} == want
    assert all("lambda" not in str(J.leading_bits("a", "b", n)) for n in J.LEADING_LONGS)


def test_buckets_are_compared_in_blocks(shipped, monkeypatch):
    """near_pairs gives the pairs that within_reach holds for, over batches and blocks of few rows."""
    r, rows = np.random.default_rng(8), []
    for signature, n in ((5, 100), (6, 125), (7, 700)):
        base = np.unique(r.integers(0, 2 ** 63, n).astype(np.uint64))
        for i in range(40):
            keep = base[r.random(n) > r.choice([0.01, 0.1, 0.5])]
            e = np.unique(np.concatenate([keep, r.integers(0, 2 ** 63, int(r.integers(1, n // 5))).astype(np.uint64)]))
            rows.append((signature, 100 * signature + i, int(r.integers(0, 4)), int(r.integers(0, 5)), len(e), J.sketch(e).tolist()))
    monkeypatch.setattr(J, "BLOCK_CELLS", 64)
    shipped.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        table = shipped.createDataFrame(rows, "signature long, node long, weight long, label long, n long, sketch array<long>")
        got = {k: sorted(tuple(p) for p in J.near_pairs(table, k, 80, 100).collect()) for k in (1, 10, 1000)}
    finally:
        shipped.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    a, b = (table.toDF("signature", *(f"{c}_{x}" for c in ("node", "weight", "label", "n", "s"))) for x in "ab")
    reach = {tuple(p) for p in a.join(b, "signature").where(J.within_reach("n_a", "s_a", "n_b", "s_b", 80, 100)).select("node_a", "node_b").collect()}
    for hubs_each, found in got.items():
        want = []
        for signature in (5, 6, 7):
            order = sorted((x for x in rows if x[0] == signature), key=lambda x: (-x[2], x[1]))
            want += [(x[1], h[1]) for k, h in enumerate(order[:hubs_each]) for x in order[k + 1:] if h[3] != x[3] and (x[1], h[1]) in reach]
        assert found == sorted(want) and found


def test_later_rounds_join_no_bucket_with_itself(shipped, monkeypatch):
    """Unlike members of one bucket are held against each other in blocks: no join makes a row of each pair."""
    plans = []
    write = J.Tables.write
    monkeypatch.setattr(J.Tables, "write", lambda self, df, name: (plans.append((name, df._jdf.queryExecution().optimizedPlan().toString())), write(self, df, name))[1])
    docs = shipped.createDataFrame(near_copies(), "doc_id long, text string")
    J.jaccard_components(docs, 3, 90, 100).collect()
    rounds = [p for name, p in plans if name == "pairs"]
    assert len(rounds) > 1 and all("MapInArrow" in p and "node" in p for p in rounds[1:])
    assert all("sketch" not in line for p in rounds[1:] for line in p.splitlines() if "Join" in line)
