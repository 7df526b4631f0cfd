import zlib

import numpy as np
import pytest

from polidata.llm import quality, queries, toxicity

LARGER = "/root/testdata/sf0.01"


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 5 == 0


@pytest.mark.parametrize("name,least", [("op7_quality", 0.9), ("op8_toxicity", 0.85)])
def test_held_out_accuracy(shipped, name, least):
    column = name.split("_")[1].replace("toxicity", "toxic")
    labels = {r["doc_id"]: r[column] for r in shipped.read.parquet(f"{LARGER}/labels.parquet").collect()}
    rows = queries.QUERIES[name](shipped, LARGER).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["held_out"] == held_out(r["doc_id"]) for r in rows)
    judged = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert np.mean([p == y for p, y in judged]) >= least


def test_network_gradient():
    net = quality.Network(1)
    r = np.random.default_rng(0)
    net.p["out"] = r.normal(size=net.p["out"].shape).astype(np.float32)
    docs = [quality.chunks_of("some text " * 40), quality.chunks_of("OTHER!! " * 10)]
    lags, y, w = [quality.lag_features(c) for c in docs], np.array([1, 0], np.float32), np.ones(2)
    grads = net.gradients(docs, lags, y, w)

    def loss():
        chunks, starts = np.concatenate(docs), np.cumsum([0] + [len(c) for c in docs[:-1]])
        p = net.probability(net.document_features(np.concatenate([net.pooled(chunks), np.concatenate(lags)], 1), starts))
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()

    for name, at in (("out", 3), ("kernel", (5, 2)), ("bias", 4)):
        old = net.p[name][at]
        net.p[name][at] = old + 1e-2
        high = loss()
        net.p[name][at] = old - 1e-2
        low = loss()
        net.p[name][at] = old
        assert abs((high - low) / 2e-2 - grads[name][at]) < 0.05 * max(0.02, abs(grads[name][at]))


def test_chunks_cover_the_text():
    for n in (0, 1, 255, 256, 257, 5000):
        text = "x" * (n - 1) + "y" * (n > 0)
        chunks = quality.chunks_of(text)
        assert (ord("y") in chunks[-1]) == (n > 0)
    net = quality.Network(2)
    long = "ab c" * 300_000
    assert abs(net.score(long) - net.scores(["q", long, None])[1]) < 1e-6


def test_pairs_of_terms():
    """An interaction that no sum of term weights can give: toxic if exactly both of two terms occur."""
    r = np.random.default_rng(3)
    docs, labels = [], []
    for _ in range(1500):
        a, b = r.random(2) < 0.5
        docs.append(np.array(sorted({int(x) for x in r.integers(10, 30, 2)} | {t for t, on in ((1, a), (2, b)) if on}), np.int32))
        labels.append(int(a and b))
    m = toxicity.FactorizationMachine().fit(docs, labels, epochs=40)
    got = [m.margin(d) > 0 for d in docs]
    assert np.mean([g == y for g, y in zip(got, labels)]) > 0.97


def test_odd_rows(odd, no_docs, odd_labels, no_labels):
    for scores in (quality.quality_scores, toxicity.toxicity_scores):
        rows = scores(odd, odd_labels).collect()
        assert len(rows) == odd.count() and rows[1]["score"] == rows[2]["score"] and rows[4]["score"] == rows[5]["score"]
        assert scores(odd, no_labels).count() == odd.count() and scores(no_docs, odd_labels).count() == 0
    assert {r["predicted"] for r in toxicity.toxicity_scores(odd, no_labels).collect()} == {0}
    model = quality.train_quality(odd, odd_labels)
    assert quality.accepted(odd, model, 0.0).collect() == odd.collect() and quality.accepted(odd, model, 1.1).count() == 0


def test_fit_reads_every_chunk_of_long_texts(monkeypatch):
    """What tells good from bad lies between twelve evenly spread places of texts of 60 chunks."""
    r = np.random.default_rng(4)
    step = quality.CHUNK - quality.WIDTH + quality.STRIDE
    spread = set(np.linspace(0, 59, 12).astype(int))
    between = [i for i in range(60) if not spread & {i - 1, i, i + 1}]
    texts, labels = [], []
    for n in range(60):
        text = np.array(list("abcdefgh "))[r.integers(0, 9, 59 * step + 200)]
        if n % 2:
            for i in between:
                text[i * step + 40: i * step + 200] = np.array(list("#@%"))[r.integers(0, 3, 160)]
        texts.append("".join(text))
        labels.append(1 - n % 2)
    net = quality.Network().fit(texts[:40], labels[:40], epochs=40)
    assert [int(s > 0.5) for s in net.scores(texts[40:])] == labels[40:]


def test_gradient_in_turns(monkeypatch):
    net, r = quality.Network(1), np.random.default_rng(0)
    net.p["out"] = r.normal(size=net.p["out"].shape).astype(np.float32)
    docs = [quality.chunks_of("some text " * 400), quality.chunks_of("OTHER!! " * 300)]
    args = docs, [quality.lag_features(c) for c in docs], np.array([1, 0], np.float32), np.ones(2)
    whole = net.gradients(*args)
    monkeypatch.setattr(quality, "AT_ONCE", 5)
    assert all(np.allclose(g, whole[k], atol=1e-4) for k, g in net.gradients(*args).items())


def test_an_id_of_many_rows_is_one_row_of_the_sample(shipped):
    from polidata.llm.training import labelled_sample
    docs = shipped.createDataFrame([(1, f"text {i % 7}") for i in range(500)] + [(2, "other"), (3, None), (4, "no label")], "doc_id long, text string")
    labels = shipped.createDataFrame([(1, 1), (2, 0), (3, 0)], "doc_id long, quality int")
    kept = [i for i in (1, 2, 3) if not held_out(i)]
    rows = labelled_sample(docs, labels, "quality", 10).collect()
    assert len(kept) > 1 and 1 in kept and sorted(r["doc_id"] for r in rows) == kept


def test_quality_learns_from_every_labelled_row(shipped):
    """With far more rows than a shard's, a change in any labelled row changes the model; one in the held-out fold does not."""
    r = np.random.default_rng(5)
    rows = [(i, " ".join("".join(r.choice(list("abcdef"), 5)) for _ in range(12)), int(i % 3 > 0)) for i in range(260)]
    labels = shipped.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, quality int")
    train = lambda changed: quality.train_quality(shipped.createDataFrame([(i, "X#" * 30 if i == changed else t) for i, t, _ in rows], "doc_id long, text string"), labels, 40).p
    plain, inside = train(None), [i for i, *_ in rows if not held_out(i)]
    assert all(np.array_equal(x, plain[k]) for k, x in train(next(i for i, *_ in rows if held_out(i))).items())
    for i in (inside[0], inside[len(inside) // 2], inside[-1]):
        assert any(not np.array_equal(x, plain[k]) for k, x in train(i).items())


def test_more_rows_are_gone_through_as_often(shipped, monkeypatch):
    """All EPOCHS whatever the number of shards, over rows that are dealt out once."""
    rows = [(i, f"w{i % 3} " * 20) for i in range(60)]
    docs, labels = shipped.createDataFrame(rows, "doc_id long, text string"), shipped.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    seen, epoch = [], quality.mixed_epoch
    monkeypatch.setattr(quality, "mixed_epoch", lambda *a: (seen.append((a[0], a[-2], a[-1])), epoch(*a))[1])
    quality.train_quality(docs, labels, 6)
    assert [(e, of) for _, e, of in seen] == [(e, quality.EPOCHS) for e in range(quality.EPOCHS)]
    dealt = seen[0][0]
    assert all(d is dealt for d, _, _ in seen) and dealt.getNumPartitions() > 1


def test_features_in_blocks_are_those_of_single_chunks(monkeypatch):
    texts = ["abab" * 300, "x", None, "word and word " * 90, "a\0b" * 200]
    chunks = np.concatenate([quality.chunks_of(t) for t in texts])
    plain = [[((c[k:] == c[:-k]) & (c[k:] > 0)).sum() / max((c > 0).sum() - k, 8) for k in quality.LAGS] for c in chunks]
    want = np.array([[*np.sort(m[1:])[-2:], m[0], (c > 0).mean()] for m, c in zip(plain, chunks)], np.float32)
    monkeypatch.setattr(quality, "LAGS_IN_CACHE", 3)
    monkeypatch.setattr(quality, "IN_CACHE", 2)
    assert np.array_equal(quality.lag_features(chunks), want) and np.array_equal(quality.stored_chunks(iter(texts))[1], want)
    net = quality.Network(3)
    _, act, n = net.activations(chunks)
    assert np.array_equal(net.pooled(chunks), np.concatenate([act.max(1), act.sum(1) / n], 1))
