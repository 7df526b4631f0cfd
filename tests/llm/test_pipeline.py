import hashlib
import re

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as P
from polidata.llm import quality, secrets
from tests.llm.test_jaccard import brute


def test_stages_against_a_plain_version(shipped, sf, con, texts):
    model = quality.train_quality(*(shipped.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels")))
    rows = [r for r, s in zip(texts, model.scores([t for _, t in texts])) if s >= P.QUALITY_THRESHOLD]
    kept = {i for i, _, c in brute(rows, 5, 80) if i == c}
    items = [b for (b,) in con.execute("SELECT text FROM benchmark").fetchall()]
    rows = [(i, t) for i, t in rows if i in kept and not any(b in t for b in items)]
    library = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    want = []
    for i, t in rows:
        at, out = 0, ""
        for start, _, kind, stop in sorted((m.start(), k, r.kind, m.end()) for k, r in enumerate(secrets.RULES) for m in re.finditer(r.pattern, t, re.ASCII) if len(m.group(r.counted)) >= r.least):
            if start >= at:
                out += t[at:start] + f"[{kind.upper()}]"
            at = max(at, stop)
        ids = library.encode(out + t[at:], add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()))
    got = sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in P.run(shipped, sf).collect())
    assert got == sorted(want)


def test_stages_return_the_columns_of_documents(shipped, sf):
    docs = shipped.read.parquet(f"{sf}/documents.parquet")
    for _, stage in P.STAGES[:-1]:
        assert stage(shipped, docs.limit(0), sf).columns == docs.columns


def test_registered(sf):
    import __spark_entry__ as E
    assert "pipeline" in E.queries() and {f"op{n}" for n in range(1, 11)} == {q.split("_")[0] for q in E.queries() if q.startswith("op")}
