"""Merkle manifest of a dataset: a tree of SHA-256 digests whose parents keep the hash states before each child.

Every row is a leaf.  The leaves of a source ascend by doc_id; every three consecutive nodes of a level (the last
run may be shorter) become one node until one is left, the source's subroot, and the subroots, ordered by source
(NULL first, bytewise), become the root in the same way.  A parent keeps a copy of its hash state before each
child slot.  To fold a changed leaf into the root, the state before its slot is taken up again and only the
replacement and the siblings to the right are hashed; nothing to the left is.

Trees are cut into blocks of 3 ** LEVELS consecutive nodes, so a step of LEVELS levels is one shuffle of small rows
and no task holds more than a few blocks, however many rows a source has.  `build` writes one row per block with
all digests and states of it; `fold` brings replacements and their block's row together in one task.  Positions
come from a range partitioning of (source, doc_id, leaf) and counts per partition, never from one window over a source.

Defined results: NULL fields are `-` in a leaf; a NULL doc_id counts as the smallest and as the empty text for
crc32; rows with the same source and doc_id are ordered by leaf, and wholly equal rows are leaves of their own in
any order; an empty table gives no rows.  A single leaf is its own subroot, a single subroot is the root, and
then there are no siblings and the proof is the digest of the empty text.  Only the five columns of a leaf are
read, so others may have any name.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from polidata.llm import sha_states as sha
from polidata.llm.common import positions, written

ARITY = 3
#: Levels of a block: it has at most 3 ** 7 = 2,187 nodes.
LEVELS = 7
#: Nodes that a task hashes at once (whole blocks, so at most this many and one block).
AT_ONCE = 8192
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The tree over the subroots; trees of sources have the keys "" (NULL) and "s" + source.
TOP = "top"
#: One level of a path: run length, slot, state before the slot, the two other nodes of the run (or zeros).
STEP = np.dtype([("m", np.uint8), ("slot", np.uint8), ("state", np.uint8, 32), ("others", np.uint8, (2, 32))])

BLOCK_ROW = T.StructType([
    T.StructField("tree", T.StringType()), T.StructField("block", T.LongType()), T.StructField("n", T.LongType()),
    T.StructField("counts", T.BinaryType()), T.StructField("digests", T.BinaryType()), T.StructField("states", T.BinaryType()),
    T.StructField("digest", T.BinaryType())])


def leaf_digest(values: list[Column]) -> Column:
    """Lowercase hex SHA-256 of the values, each as length in UTF-8, colon and text, or `-` if NULL."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-"))
             for v in values]
    return F.sha2(F.concat(*parts), 256)


# -- building ------------------------------------------------------------------------------------------------
def tree_levels(n: int) -> int:
    """Levels above the leaves: 0 for one leaf."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Consecutive rows as tables that hold whole blocks only: AT_ONCE rows or one block more."""
    kept: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append(batch)
        held += batch.num_rows
        if held < AT_ONCE:
            continue
        table = pa.Table.from_batches(kept).combine_chunks()
        starts = block_starts(table)
        if len(starts) > 1:
            yield table.slice(0, starts[-1])
            table = table.slice(starts[-1])
        kept, held = table.to_batches(), table.num_rows
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks()


def block_starts(table: pa.Table) -> np.ndarray:
    """Where in the sorted rows a block begins."""
    codes = table["tree"].combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
    block = table["block"].to_numpy()
    return np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]) | (block[1:] != block[:-1])])


def bytes_matrix(column: pa.ChunkedArray) -> np.ndarray:
    """A column of 32-byte values as (n, 32)."""
    joined = b"".join(column.to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(-1, 32)


def hash_blocks(table: pa.Table, most: int) -> Iterator[tuple]:
    """The block rows of the nodes of a table: all levels of all blocks hashed level by level."""
    starts = block_starts(table)
    sizes = np.diff(np.r_[starts, table.num_rows])
    n_tree = table["n"].to_numpy()[starts]
    levels = np.array([min(most, tree_levels(int(x))) for x in n_tree])
    digests, counts = [bytes_matrix(table["digest"])], [sizes]
    states: list[np.ndarray] = []
    live = np.arange(len(starts))
    places = [live]                      # blocks that have the level
    for level in range(int(levels.max(initial=0))):
        on = levels[live] > level
        size, offset = counts[-1], np.cumsum(counts[-1]) - counts[-1]
        up = -(-size[on] // ARITY)
        within = np.arange(up.sum()) - np.repeat(np.cumsum(up) - up, up)
        first = np.repeat(offset[on], up) + ARITY * within
        m = np.minimum(ARITY, np.repeat(size[on], up) - ARITY * within)
        kept = np.zeros((len(digests[-1]), 32), np.uint8)
        state = sha.fresh(len(first))
        for slot in range(ARITY):
            has = np.flatnonzero(m > slot)
            kept[first[has] + slot] = state[has]
            if len(has):
                state[has] = sha.compress(state[has], sha.hex_blocks(digests[-1][first[has] + slot]))
        states.append(kept)
        digests.append(sha.finish(state, m))
        counts.append(up)
        live = live[on]
        places.append(live)
    at = [dict(zip(p.tolist(), zip((np.cumsum(c) - c).tolist(), c.tolist()))) for p, c in zip(places, counts)]
    trees, blocks = table["tree"], table["block"]
    for g, start in enumerate(starts):
        spans = [at[t][g] for t in range(levels[g] + 1)]
        all_digests = b"".join(digests[t][o:o + c].tobytes() for t, (o, c) in enumerate(spans))
        all_states = b"".join(states[t][o:o + c].tobytes() for t, (o, c) in enumerate(spans[:-1]))
        yield (trees[int(start)].as_py(), blocks[int(start)].as_py(), int(n_tree[g]), struct.pack(f"<{len(spans)}H", *(c for _, c in spans)),
               all_digests, all_states, all_digests[-32:])


def hashed(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    types = [pa.string(), pa.int64(), pa.int64(), *[pa.binary()] * 4]
    for table in whole_blocks(batches):
        rows = list(zip(*hash_blocks(table, most)))
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, types)], names=BLOCK_ROW.names)


def grow(nodes: DataFrame, name: str, levels: int) -> list[DataFrame]:
    """Block rows of every step, the leaves' first.  nodes: tree, idx, n, digest (32 bytes)."""
    size = ARITY ** levels
    longest = nodes.agg(F.max("n")).first()[0] or 0
    steps: list[DataFrame] = []
    while longest:
        blocks = nodes.select("tree", F.floor(F.col("idx") / size).cast("long").alias("block"), "idx", "n", "digest") \
            .repartition("tree", "block").sortWithinPartitions("tree", "block", "idx")
        step = written(blocks.mapInArrow(partial(hashed, most=levels), BLOCK_ROW), name)
        steps.append(step)
        if longest <= size:
            break
        nodes = step.filter(F.col("n") > size).select("tree", F.col("block").alias("idx"), F.ceil(F.col("n") / size).cast("long").alias("n"), "digest")
        longest = -(-longest // size)
    return steps


def roots(steps: list[DataFrame], levels: int) -> DataFrame:
    """(tree, digest): the last node of every tree."""
    ends = [s.filter(F.col("n") <= ARITY ** levels).select("tree", "digest") for s in steps]
    return reduce(DataFrame.unionByName, ends)


# -- paths and folding -----------------------------------------------------------------------------------------
def path_steps(counts: np.ndarray, digests: np.ndarray, states: np.ndarray, pos: np.ndarray, base: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The STEP of nodes at ``pos`` of a level, given per node the level's count and its places in states and digests."""
    slot = pos % ARITY
    m = np.minimum(ARITY, counts - (pos - slot))
    out = np.zeros(len(pos), STEP)
    out["m"], out["slot"], out["state"] = m, slot, states[base[0] + pos]
    for o in range(ARITY - 1):
        at = np.flatnonzero(m - 1 > o)
        other = np.where(o < slot[at], o, o + 1) - slot[at]
        out["others"][at, o] = digests[base[1][at] + pos[at] + other]
    return out


class Blocks:
    """Some block rows, laid out so that paths of many nodes are taken at once."""

    def __init__(self, counts: list[bytes], digests: list[bytes], states: list[bytes]):
        per_block = [np.frombuffer(c, "<u2").astype(np.int64) for c in counts]
        self.levels = np.array([len(c) - 1 for c in per_block], np.int64)
        self.counts = np.zeros((len(counts), int(self.levels.max(initial=0)) + 1), np.int64)
        for g, c in enumerate(per_block):
            self.counts[g, :len(c)] = c
        self.digests = np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32)
        self.states = np.frombuffer(b"".join(states), np.uint8).reshape(-1, 32)
        sums = np.cumsum(self.counts, axis=1) - self.counts
        n_digests = np.array([len(d) // 32 for d in digests])
        n_states = np.array([len(s) // 32 for s in states])
        self.at_digest = (np.cumsum(n_digests) - n_digests)[:, None] + sums
        self.at_state = (np.cumsum(n_states) - n_states)[:, None] + sums

    def step(self, g: np.ndarray, pos: np.ndarray, level: int) -> np.ndarray:
        """STEPs of the ancestors, at this level, of the nodes at ``pos`` of blocks ``g`` (which have the level)."""
        at = pos // ARITY ** level
        return path_steps(self.counts[g, level], self.digests, self.states, at, (self.at_state[g, level], self.at_digest[g, level]))


def node_paths(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(tree, idx, path) of every node of the blocks: the steps inside the block, then the block's own."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = {k: batch.column(k)[i].as_py() for k in ("tree", "block", "counts", "digests", "states", "path")}
            blocks = Blocks([row["counts"]], [row["digests"]], [row["states"]])
            n = int(blocks.counts[0, 0])
            pos, g = np.arange(n), np.zeros(n, np.int64)
            steps = np.stack([blocks.step(g, pos, t) for t in range(int(blocks.levels[0]))], axis=1) if blocks.levels[0] else np.zeros((n, 0), STEP)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["tree"]] * n, pa.string()), pa.array(row["block"] * size + pos), pa.array([s.tobytes() + row["path"] for s in steps], pa.binary())],
                names=["tree", "idx", "path"])


def paths_of(blocks: DataFrame, levels: int) -> DataFrame:
    return blocks.mapInArrow(partial(node_paths, size=ARITY ** levels), "tree string, idx long, path binary")


def descend(steps: list[DataFrame], seeds: DataFrame | None, name: str, levels: int) -> DataFrame:
    """The first step's blocks with ``path``, from the block's last node up to the root; seeds: (tree, path) of each
    tree's end, or None where that is the root."""
    below: DataFrame | None = None
    for step in reversed(steps):
        ends = step.filter(F.col("n") <= ARITY ** levels)
        ends = ends.withColumn("path", F.unhex(F.lit(""))) if seeds is None else ends.join(seeds, "tree")
        rows = ends
        if below is not None:
            up = paths_of(below, levels).withColumnRenamed("idx", "block")
            rows = ends.unionByName(step.filter(F.col("n") > ARITY ** levels).join(up, ["tree", "block"]).select(*ends.columns))
        below = written(rows, name)
    return below


def take_steps(cur: np.ndarray, proof: np.ndarray, hashed_blocks: np.ndarray, rows: np.ndarray, steps: np.ndarray) -> None:
    """One level up for some rows: resumes the state before the slot with the replacement and the right siblings."""
    m, slot = steps["m"].astype(np.int64), steps["slot"].astype(np.int64)
    state = sha.compress(np.ascontiguousarray(steps["state"]), sha.hex_blocks(cur[rows]))
    for o in range(ARITY - 1):
        has = np.flatnonzero(m - 1 > o)
        if not len(has):
            continue
        sibling = sha.hex_blocks(np.ascontiguousarray(steps["others"][has, o]))
        proof[rows[has]] = sha.compress(proof[rows[has]], sibling)
        hashed_blocks[rows[has]] += 1
        right = np.flatnonzero(o >= slot[has])
        if len(right):
            state[has[right]] = sha.compress(state[has[right]], sibling[right])
    cur[rows] = sha.finish(state, m)


def fold_table(table: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the replacement rows, their folded roots, their proofs); a block's row comes before its replacements."""
    is_row = table["kind"].to_numpy() == 1
    heads, rows = np.flatnonzero(~is_row), np.flatnonzero(is_row)
    head = table.select(["counts", "digests", "states", "path"]).take(pa.array(heads))
    blocks = Blocks(*(head[c].to_pylist() for c in ("counts", "digests", "states")))
    above = [np.frombuffer(p, STEP) for p in head["path"].to_pylist()]
    g = (np.cumsum(~is_row) - 1)[rows]
    pos = table["idx"].to_numpy()[rows] % size
    cur = bytes_matrix(table["digest"].take(pa.array(rows))).copy()
    proof, count = sha.fresh(len(rows)), np.zeros(len(rows), np.int64)
    for level in range(int(blocks.levels.max(initial=0))):
        on = np.flatnonzero(blocks.levels[g] > level)
        if len(on):
            take_steps(cur, proof, count, on, blocks.step(g[on], pos[on], level))
    more = np.array([len(a) for a in above], np.int64)
    for k in range(int(more.max(initial=0))):
        on = np.flatnonzero(more[g] > k)
        step_of = np.zeros(len(above), STEP)
        for j in np.flatnonzero(more > k):
            step_of[j] = above[j][k]
        take_steps(cur, proof, count, on, step_of[g[on]])
    return rows, cur, sha.finish(proof, count)


@dataclass
class Manifest:
    """Positions of the leaves, block rows of every step of the trees of the sources, and the root."""

    leaves: DataFrame       # tree, idx, n, digest and what the leaves carry
    blocks: DataFrame       # block rows of the leaves' step, with path to the root and subroot
    root: str | None        # lowercase hex; None if there are no leaves
    levels: int             # of a block


def build(leaves: DataFrame, tree: str, order: list[str], levels: int = LEVELS) -> Manifest:
    """The manifest of leaves that have a tree key, ``order`` columns, and ``digest`` (32 bytes)."""
    placed = positions(leaves, tree, order, "manifest-leaves").withColumnRenamed(tree, "tree")
    steps = grow(placed, "manifest-nodes", levels)
    if not steps:
        return Manifest(placed, None, None, levels)
    subroots = written(roots(steps, levels), "manifest-subroots")
    top_leaves = positions(subroots.select(F.lit(TOP).alias("t"), F.col("tree").alias("of"), "digest"), "t", ["of"], "manifest-top") \
        .withColumnRenamed("t", "tree")
    top = grow(top_leaves, "manifest-top", levels)
    root = roots(top, levels).first()["digest"]
    seeds = paths_of(descend(top, None, "manifest-top", levels), levels) \
        .join(top_leaves.select("idx", F.col("of"), "digest"), "idx").select(F.col("of").alias("tree"), "path", F.col("digest").alias("subroot"))
    seeds = written(seeds, "manifest-seeds")
    blocks = descend(steps, seeds.drop("subroot"), "manifest-paths", levels).join(seeds.drop("path"), "tree")
    return Manifest(placed, blocks, bytes(root).hex(), levels)


def fold(manifest: Manifest, replacements: DataFrame) -> DataFrame:
    """Replacements (tree, idx, digest and any columns) with subroot (as built), folded_root and proof, all 32 bytes."""
    size = ARITY ** manifest.levels
    rows = replacements.withColumns({"block": F.floor(F.col("idx") / size).cast("long"), "kind": F.lit(1)})
    heads = manifest.blocks.select("tree", "block", F.lit(0).alias("kind"), F.lit(-1).cast("long").alias("idx"), "counts", "digests", "states", "path", "subroot")
    joined = heads.unionByName(rows, allowMissingColumns=True).repartition("tree", "block").sortWithinPartitions("tree", "block", "kind", "idx")
    names = [c for c in replacements.columns if c not in ("tree", "idx", "digest")]
    fields = [f for f in replacements.schema.fields if f.name in names]
    schema = T.StructType([*fields, *(T.StructField(c, T.BinaryType()) for c in ("subroot", "folded_root", "proof"))])

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_blocks(batches):
            at, cur, proof = fold_table(table, size)
            if not len(at):
                continue
            heads_of = np.flatnonzero(table["kind"].to_numpy() == 0)
            of = np.searchsorted(heads_of, at, side="right") - 1
            kept = table.select(names).take(pa.array(at)).combine_chunks()
            subroot = table["subroot"].take(pa.array(heads_of[of]))
            columns = [*kept.columns, subroot, *(pa.array([r.tobytes() for r in x], pa.binary()) for x in (cur, proof))]
            yield from pa.table(columns, names=schema.names).to_batches()

    return joined.mapInArrow(folded, schema)


def tampered_text(doc_id: Column, text: Column) -> Column:
    """The text, without its line feeds where 2 divides the unsigned crc32 of the id as text."""
    even = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 2 == 0
    return F.when(even, F.replace(text.cast("string"), F.lit("\n"), F.lit(""))).otherwise(text.cast("string"))


def dataset_manifest(docs: DataFrame, levels: int = LEVELS) -> tuple[Manifest, DataFrame]:
    """The manifest of documents, and per row: doc_id, tree, idx, digest of the tampered leaf, leaf."""
    parts = [F.col(c) for c in FIELDS]
    leaves = docs.select(
        F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("s"), F.col("source").cast("string"))).alias("tree"),
        "doc_id", F.unhex(leaf_digest(parts)).alias("digest"),
        F.unhex(leaf_digest([*parts[:-1], tampered_text(F.col("doc_id"), F.col("text"))])).alias("tampered"))
    manifest = build(leaves, "tree", ["doc_id", "digest"], levels)
    replacements = manifest.leaves.select("tree", "idx", "doc_id", F.lower(F.hex("digest")).alias("leaf"), F.col("tampered").alias("digest"))
    return manifest, replacements


def verify_tampering(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """Per document its leaf, subroot, root and proof, and whether the tampered leaf still folds to the root."""
    manifest, replacements = dataset_manifest(docs, levels)
    if manifest.blocks is None:
        found = replacements.select("doc_id", "leaf").withColumns({c: F.lit(None).cast("binary") for c in ("subroot", "folded_root", "proof")})
    else:
        found = fold(manifest, replacements)
    low = lambda c: F.lower(F.hex(c))
    return found.select("doc_id", "leaf", low("subroot").alias("subroot"), F.lit(manifest.root).cast("string").alias("root"),
                        low("proof").alias("proof_sha256"), low("folded_root").alias("folded_root"),
                        (low("folded_root") == F.lit(manifest.root)).alias("verified"))
