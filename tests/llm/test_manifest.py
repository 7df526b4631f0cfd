import hashlib
import zlib

import numpy as np
import pytest

from polidata.llm import manifest as M
from polidata.llm import sha_states as S
from polidata.llm.oracle import MANIFEST

COLUMNS = "doc_id long, source string, lang string, n_chars long, text string"


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest(out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def brute(rows):
    """The contract, row by row with hashlib."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in groups.values():
        g.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {s: levels([leaf(r) for r in groups[s]]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources]) if sources else []
    out = []
    for at, s in enumerate(sources):
        for i, r in enumerate(groups[s]):
            t = list(r)
            if zlib.crc32(b"" if r[0] is None else str(r[0]).encode()) % 2 == 0 and t[4] is not None:
                t[4] = t[4].replace("\n", "")
            cur, siblings = leaf(t), []
            for tree, p in ((trees[s], i), (top, at)):
                for level in tree[:-1]:
                    first = p // 3 * 3
                    run = level[first:first + 3]
                    run[p - first] = cur
                    siblings += run[:p - first] + run[p - first + 1:]
                    cur, p = digest(run), p // 3
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], digest(siblings), cur, cur == top[-1][0]))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("blocks", [0, 1, 3])
def test_states_are_those_of_sha256(blocks):
    data = np.frombuffer(np.random.default_rng(blocks).bytes(32 * 5 * max(blocks, 1)), np.uint8).reshape(5, max(blocks, 1), 32)
    state = S.fresh(5)
    for k in range(blocks):
        state = S.compress(state, S.hex_blocks(np.ascontiguousarray(data[:, k])))
    got = S.finish(state, np.full(5, blocks))
    for i in range(5):
        text = "".join(data[i, k].tobytes().hex() for k in range(blocks))
        assert got[i].tobytes() == hashlib.sha256(text.encode()).digest()


@pytest.mark.parametrize("block_levels", [1, 2, 7])
def test_whole_table_against_hashlib(shipped, sf, con, block_levels):
    docs = shipped.read.parquet(f"{sf}/documents.parquet")
    want = brute(con.execute("SELECT doc_id, source, lang, n_chars, text FROM documents").fetchall())
    assert found(M.verify_tampering(docs, block_levels)) == want


def test_sql_against_hashlib(con):
    want = brute(con.execute("SELECT doc_id, source, lang, n_chars, text FROM documents").fetchall())
    assert sorted(con.execute(MANIFEST).fetchall(), key=repr) == want


def test_odd_rows(shipped):
    rows = [(None, None, None, None, None), (1, None, "en", 3, "a\nb"), (1, "", "en", 3, "a\nb"), (1, "", "en", 3, "a\nb"),
            (2, "s", None, -1, ""), (2, "s", "x", 0, "é\n中\U0001F600"), (3, "é", "l", 1, "\n" * 100_000)]
    rows += [(i, "big", "l", i, f"{i}\n") for i in range(-5, 100)]
    docs = shipped.createDataFrame([(*r, i, "z") for i, r in enumerate(rows)], COLUMNS + ", idx long, tree string")
    assert found(M.verify_tampering(docs, 2)) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4])
def test_small_tables(shipped, n):
    rows = [(i, "s", "l", 1, "x\n") for i in range(n)]
    assert found(M.verify_tampering(shipped.createDataFrame(rows, COLUMNS))) == brute(rows)


def test_one_row_repeated(shipped):
    rows = [(7, "s", "l", 1, "x\n")] * 300 + [(8, "t", "l", 1, "y")]
    assert found(M.verify_tampering(shipped.createDataFrame(rows, COLUMNS), 2)) == brute(rows)


def test_parents_keep_the_state_before_each_slot(shipped):
    docs = shipped.createDataFrame([(i, "s", "l", 1, str(i)) for i in range(3)], COLUMNS)
    manifest, _ = M.dataset_manifest(docs)
    row = manifest.blocks.first()
    children = [bytes(row.digests[32 * k:32 * k + 32]).hex() for k in range(3)]
    for slot in range(3):
        state = S.fresh(1)
        for c in children[:slot]:
            state = S.compress(state, np.frombuffer(c.encode(), np.uint8).reshape(1, 64))
        assert bytes(row.states[32 * slot:32 * slot + 32]) == state.tobytes()
    assert bytes(row.digest).hex() == digest(children) == manifest.root


def test_fold_of_some_leaves_only(shipped):
    """A fold takes any replacements, and a right replacement gives the root back."""
    docs = shipped.createDataFrame([(i, f"s{i % 4}", "l", 1, str(i)) for i in range(200)], COLUMNS)
    manifest, _ = M.dataset_manifest(docs, 2)
    some = manifest.leaves.filter("doc_id % 50 = 7").select("tree", "idx", "doc_id", "digest")
    folded = M.fold(manifest, some).collect()
    assert len(folded) == 4 and {bytes(r.folded_root).hex() for r in folded} == {manifest.root}
