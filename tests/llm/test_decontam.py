import random

from polidata.llm import decontam as D
from polidata.llm import queries


def test_finds_every_verbatim_item(shipped, sf, con, texts):
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()
    planted = {(d, i) for d, t in texts for i, b in items if b in t}
    got = {(r["doc_id"], r["item_id"]) for r in queries.QUERIES["op2_decontamination"](shipped, sf).collect()}
    assert planted and got == planted


def test_paraphrases_and_near_topics(shipped):
    r = random.Random(4)
    words = ["".join(r.choice("abcdefghijklmnop") for _ in range(6)) for _ in range(600)]
    item = r.sample(words, 30)
    benchmark = shipped.createDataFrame([(1, " ".join(item[:22]) + ". " + " ".join(item[22:])), (2, "tiny item."), (3, None), (4, " ")], "item_id long, text string")
    changed = [w if i % 6 else r.choice(words) for i, w in enumerate(item[:22])] + item[22:]
    no_answer = [w if i % 4 else r.choice(words) for i, w in enumerate(item[:22])] + r.sample(words, 8)
    filler = [" ".join(r.choice(words) for _ in range(80)) for _ in range(40)]
    docs = [(100 + i, f) for i, f in enumerate(filler)]
    docs += [(1, filler[0] + " " + " ".join(changed) + " " + filler[1]), (2, filler[2] + " " + " ".join(no_answer)), (3, " ".join(sorted(item))),
             (4, "a tiny item, here"), (5, None), (6, "")]
    docs = shipped.createDataFrame(docs, "doc_id long, text string")
    got = {(x["doc_id"], x["item_id"]) for x in D.find_leaks(docs, benchmark).collect()}
    assert got == {(1, 1), (4, 2)}
    kept = {x["doc_id"] for x in D.clean_documents(docs, benchmark).collect()}
    assert kept == {x["doc_id"] for x in docs.collect()} - {1, 4}
    assert D.find_leaks(docs, benchmark.limit(0)).count() == 0 and D.find_leaks(docs.limit(0), benchmark).count() == 0


def test_candidate_recall_against_brute_force(shipped):
    """Windows whose exact TF-IDF cosine with an item is high are found in the latent space."""
    docs, bench = (shipped.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    s = D.searchers(docs, bench)[0].value
    cache = D.FeatureIds(s.features)
    exact = found = 0
    import numpy as np
    weight = np.sqrt(s.square)
    queries_ = [np.bincount(D.feature_ids(i.words, cache), minlength=len(weight)) * weight for i in s.items]
    for _, text in texts:
        words = D.lower_words(text)
        hits = {(n, at) for n, at in s.candidates(words, cache)}
        ids = D.feature_ids(words, cache)
        for at in range(0, max(1, len(ids) - D.STRIDE), D.STRIDE):
            x = np.bincount(ids[at: at + D.WINDOW], minlength=len(weight)) * weight
            for n, q in enumerate(queries_):
                if (x[1:] @ q[1:]) / max(1e-9, np.linalg.norm(x) * np.linalg.norm(q)) >= 0.5:
                    exact += 1
                    found += (n, at) in hits
    assert exact > 10 and found >= 0.9 * exact


def test_common_subsequence_against_dynamic_programming():
    r = random.Random(2)
    for _ in range(200):
        a, b = ([r.choice([b"x", b"y", b"z"]) for _ in range(r.randint(0, 12))] for _ in range(2))
        row = [0] * (len(b) + 1)
        for x in a:
            last = 0
            for j, y in enumerate(b):
                last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
        assert D.common_subsequence(a, b) == row[-1]


def test_odd_rows(odd, shipped):
    benchmark = shipped.createDataFrame([(9, "other text under one id"), (9, "other text under one id")], "item_id long, text string")
    got = [(r["doc_id"], r["item_id"]) for r in D.find_leaks(odd, benchmark).collect()]
    assert got == [(-5, 9), (-5, 9)]


def test_short_items_in_a_third_and_in_most_documents(shipped):
    """A verbatim item is found in every document that holds it, however many do."""
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(6))
    third, most, tiny = [word() for _ in range(16)], [word() for _ in range(15)], [word(), word()]
    items = [third, most, tiny, *([word() for _ in range(45)] for _ in range(6))]
    benchmark = shipped.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    rows, planted = [], set()
    for d in range(300):
        held = [0] * (d % 3 == 0) + [1] * (d % 10 > 0) + [2] * (d % 10 > 0)
        text = [word() for _ in range(r.randint(20, 90))]
        for i in held:
            text += items[i] + [word() for _ in range(r.randint(20, 90))]
        rows.append((d, " ".join(text)))
        planted.update((d, i) for i in held)
    docs = shipped.createDataFrame(rows, "doc_id long, text string")
    assert {(x["doc_id"], x["item_id"]) for x in D.find_leaks(docs, benchmark).collect()} == planted
    assert {x["doc_id"] for x in D.clean_documents(docs, benchmark).collect()} == set(range(300)) - {d for d, _ in planted}


def test_copies_leave_the_weights_of_an_item_alone(shipped):
    item = "alpha beta gamma delta epsilon zeta eta theta".split()
    features = {w.encode(): i + 1 for i, w in enumerate(sorted(item))}
    benchmark = shipped.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    docs = shipped.createDataFrame([(i, "some words " + " ".join(item) * (i > 0) + " and more") for i in range(10)] + [(10, "zeta alone")], "doc_id long, text string")
    df, n = D.document_frequencies(docs, features, D.benchmark_grams(benchmark, features))
    assert n == 11 and df[1:].sum() == df[features[b"zeta"]] == 1


def test_the_normal_matrix_sums_up_all_documents(shipped, monkeypatch):
    """transpose(A) A by definition over every passage of more documents than weigh in full, in one band of rows and in several."""
    import numpy as np
    r = random.Random(3)
    words = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(r.choice(words + ["other", "more"]) for _ in range(r.randint(0, 90)))) for i in range(D.DOCUMENTS_WEIGHT + 60)] + [(None, None)]
    features = {w.encode(): i + 1 for i, w in enumerate(words)}
    idf = np.random.default_rng(0).uniform(0.5, 3, len(words) + 1)
    want = np.zeros((len(idf), len(idf)))
    for _, text in rows:
        own = (text or "").split()
        for at in range(0, len(own), D.WINDOW):
            x = np.bincount([features.get(w.encode(), 0) for w in own[at: at + D.WINDOW]], minlength=len(idf)) * idf
            x[0] = x[0] / max(1, (x[0] / idf[0]) ** 0.5)
            x /= np.linalg.norm(x)
            x[0] = 0
            want += np.outer(x, x)
    stored = D.stored_ids(shipped.createDataFrame(rows, "doc_id long, text string"), features)
    basis = np.random.default_rng(1).normal(size=(len(idf), 5))
    for cells in (D.CELLS, 70 * len(idf)):
        monkeypatch.setattr(D, "CELLS", cells)
        assert np.allclose(D.normal_product([(D.normal_matrix(stored, idf, 10), 0.5)], basis), 0.5 * want @ basis, atol=1e-3)


def test_no_task_holds_much_of_the_normal_matrix(shipped):
    """Parts of the matrix are small and dealt over files of bounded size, and hold all of it."""
    import numpy as np
    from pyspark.sql import functions as F
    r = random.Random(6)
    words = [f"w{i}" for i in range(1_999)]
    rows = [(i, " ".join(r.sample(words, 64))) for i in range(200)]
    stored = D.stored_ids(shipped.createDataFrame(rows, "doc_id long, text string"), {w.encode(): i + 1 for i, w in enumerate(words)})
    size = len(words) + 1
    found = D.normal_matrix(stored, np.ones(size), 200 * 64)
    files = found.groupBy(F.input_file_name()).agg(F.sum(F.octet_length("sums")).alias("n"), F.max(F.octet_length("sums")).alias("part")).collect()
    assert max(f["part"] for f in files) <= 1 << 18 and max(f["n"] for f in files) <= 16 << 20
    # each word of a passage of 32 different ones weighs 1 / 32 with itself
    trace = np.einsum("ij,ij->", np.eye(size), D.normal_product([(found, 1.0)], np.eye(size)))
    assert abs(trace - 400) < 1e-3
