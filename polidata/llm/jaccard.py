"""N-gram Jaccard join by PartEnum signatures, and the classes of documents it links.

Sets that reach the similarity differ in at most k elements, k following from their sizes.  Per band of
sizes, the element domain is dealt to k // 2 + 2 partitions, so in at least two of them the sets differ
in at most one element; each partition is dealt to two parts, of which one then agrees.  A set's
signatures are its contents of every part of every partition, so similar sets share one.

Signatures propose candidates, the texts decide.  Exact copies are one node.  Inside a bucket of equal
signatures, members are first compared with its best connected member only, and buckets whose members
are in one class by then are done; the others go on with more hubs each round until none is left.  A sketch of
each set bounds the difference of two from below, so that texts are only compared where they may be linked; the
sketches of a bucket's members are held against those of its hubs many at once in numpy.
So no link between different classes is lost, and no bucket is expanded into all its pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from polidata.llm.common import Tables, WordHashes, lower_words

#: A partition's parts, one of which agrees if the sets differ in at most one element of the partition.
PARTS = 2
#: Agreeing partitions beyond the one that must exist, and one more per so many differences: as many signatures
#: of empty parts can be left out, which sets of all kinds would share.
SPARE, DIFFERENCES_PER_SPARE = 1, 16
#: Upper end of a band of sizes over its lower end, at least.
BAND_RATIO = 1.5
#: Hubs of a bucket in the first round, and how many times more in each further one.
FIRST_HUBS, MORE_HUBS = 1, 64
#: Up to so many rows (four longs and a flag each at most) a table of keys to look up is broadcast; a larger one is shuffled.
BROADCAST_ROWS = 400_000
#: Cells of the smallest sketch that bounds the difference of two sets from below.
LEAST_CELLS = 256
#: So many longs of a sketch, and then so many, are compared by plain expressions, which Spark compiles; the rest in a loop.
LEADING_LONGS = 6, 16
#: Longs of two sketches that are compared for all pairs of a block, and cells of such a block; the rest only where these allow it.
BLOCK_LONGS, BLOCK_CELLS = 6, 1 << 16
#: Texts that are sent to a copy of their hub's text.
PARTNERS = 256

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


def shingle_hashes(text: str | None, width: int, hashes: WordHashes) -> np.ndarray:
    """The set of a whole text: distinct hashes of its shingles, ascending; a shorter text is one shingle."""
    words = lower_words(text)
    if not words:
        return np.empty(0, U)
    h = np.fromiter(map(hashes.__getitem__, words), U, len(words))
    n, with_length = len(h), U(min(len(h), width))
    span = min(n, width)
    total = np.full(n - span + 1, with_length, U)
    with np.errstate(over="ignore"):
        for j in range(span):
            total = mix(total * U(0x9E3779B97F4A7C15) + h[j: n - span + 1 + j])
    return np.unique(total)


def set_key(elements: np.ndarray) -> int:
    """A 64-bit digest of a set, as a signed number."""
    with np.errstate(over="ignore"):
        total = mix(elements).sum(dtype=U) + U(len(elements)) * U(0x9E3779B97F4A7C15)
    return int(mix(np.array([total]))[0].astype(np.int64))


class Bands:
    """Bands of set sizes for a similarity of num / den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        self.ratio = max(BAND_RATIO, den / num)

    @lru_cache(maxsize=None)
    def limits(self, i: int) -> tuple[int, int]:
        low = 1 if i == 0 else self.limits(i - 1)[1] + 1
        return low, max(low, int(low * self.ratio))

    def of(self, n: int) -> list[int]:
        """The bands in which a set of n elements has signatures: its own, and the next if it reaches there."""
        i = next(i for i in range(10_000) if n <= self.limits(i)[1])
        return [i, i + 1] if n * self.den // self.num >= self.limits(i + 1)[0] else [i]

    def differences(self, i: int) -> int:
        """The most elements in which two similar sets of band i (or one of the band below) differ."""
        return 2 * self.limits(i)[1] * (self.den - self.num) // (self.den + self.num)


def signatures(elements: np.ndarray, bands: Bands) -> np.ndarray:
    """PartEnum signatures (int64) of a set; none where only equal sets are similar."""
    found = []
    for band in bands.of(len(elements)) if len(elements) else []:
        k = bands.differences(band)
        if k == 0:
            continue
        spare = SPARE + k // DIFFERENCES_PER_SPARE
        partitions = k // 2 + 1 + spare
        cell = (mix(elements ^ mix(np.array([band + 1], U))) % U(partitions * PARTS)).astype(np.int64)
        size = np.bincount(cell, minlength=partitions * PARTS).reshape(-1, PARTS)
        content = cell_sums(mix(elements + U(0x632BE59BD9B4E019)), cell, partitions * PARTS).reshape(-1, PARTS)
        # an empty part makes an empty signature.  The last `spare` partitions that have one leave it out: of the
        # 1 + spare partitions that agree, the first is then among the left-out ones of neither set
        empty = np.flatnonzero((size == 0).any(1))
        left_out = np.zeros(partitions, bool)
        left_out[empty[-spare:]] = True
        place = U(band << 40) + np.arange(partitions, dtype=U) * U(PARTS)
        for s in range(PARTS):
            with np.errstate(over="ignore"):
                value = mix(mix(content[:, s] + U(1)) * U(3) + mix(place + U(s)))
            found.append(value[(size[:, s] > 0) | ~left_out])
    return np.concatenate(found).astype(np.int64) if found else np.empty(0, np.int64)


def cell_sums(values: np.ndarray, cell: np.ndarray, cells: int) -> np.ndarray:
    """Sums of 64-bit values by cell, modulo 2^64."""
    if len(values) >= 1 << 20:
        total = np.zeros(cells, U)
        np.add.at(total, cell, values)
        return total
    low = np.bincount(cell, (values & U(0xFFFFFFFF)).astype(np.float64), cells).astype(U)  # exact below 2^52
    high = np.bincount(cell, (values >> U(32)).astype(np.float64), cells).astype(U)
    return low + (high << U(32))


def sketch(elements: np.ndarray) -> np.ndarray:
    """One bit per cell: whether an odd number of the elements fall there.  A differing bit shows a differing element.

    There are two cells an element or more, as a power of two, so long sets are told apart as well as short ones.
    """
    cells = max(LEAST_CELLS, 1 << (2 * len(elements) - 1).bit_length())
    cell = (mix(elements + U(0xD1B54A32D192ED03)) % U(cells)).astype(np.int64)
    return np.packbits((np.bincount(cell, minlength=cells) & 1).astype(np.uint8)).view(np.int64)


def folded(a: str, b: str) -> Column:
    """Sketch a at the size of b if it is twice as long: its halves, one over the other."""
    size = F.size(b)
    halves = F.zip_with(F.slice(a, F.lit(1), size), F.slice(a, size + 1, size), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(a) == 2 * size, halves).otherwise(F.col(a))


def differing_bits(a: str, b: str) -> Column:
    """How many bits of two sketch columns differ: no more than the sets' differing elements.

    Sketches are of one length or one is twice the other; of others nothing is known, which counts as 0.
    """
    bits = F.zip_with(folded(a, b), folded(b, a), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.coalesce(F.aggregate(bits, F.lit(0), lambda total, x: total + x), F.lit(0))


def leading_bits(a: str, b: str, longs: int) -> Column:
    """How many bits differ in the first longs of two sketch columns of one size; 0 for those of two sizes."""
    each = [F.coalesce(F.bit_count(F.get(F.col(a), F.lit(i)).bitwiseXOR(F.get(F.col(b), F.lit(i)))), F.lit(0)) for i in range(longs)]
    return F.when(F.size(a) == F.size(b), sum(each[1:], each[0])).otherwise(F.lit(0))


def within_reach(n_a: str, sketch_a: str, n_b: str, sketch_b: str, num: int, den: int) -> Column:
    """Whether sets of these sizes and sketches may reach num / den: their sketches show few enough differences.

    The first longs already show too many of most pairs; of short sketches of one size they are all.
    """
    least, most = F.least(n_a, n_b), F.greatest(n_a, n_b)
    few = lambda bits: (den + num) * bits <= (den - num) * (least + most)
    whole = (F.size(sketch_a) == F.size(sketch_b)) & (F.size(sketch_a) <= LEADING_LONGS[-1])
    early = [few(leading_bits(sketch_a, sketch_b, n)) for n in LEADING_LONGS]
    return (den * least >= num * most) & early[0] & early[1] & (whole | few(differing_bits(sketch_a, sketch_b)))


class Members:
    """Members of a bucket whose sketches have one length: node, label, n, place in the bucket, and a row of longs for each place of the sketch."""

    def __init__(self, node: np.ndarray, label: np.ndarray, n: np.ndarray, place: np.ndarray, longs: np.ndarray):
        self.node, self.label, self.n, self.place, self.longs = node, label, n, place, longs

    def first(self, places: int) -> Members:
        """Those before a place; members are in the order of their places."""
        k = int(np.searchsorted(self.place, places))
        return Members(self.node[:k], self.label[:k], self.n[:k], self.place[:k], self.longs[:, :k])

    def and_later(self, other: Members) -> Members:
        return Members(*(np.concatenate([getattr(self, c), getattr(other, c)], -1) for c in ("node", "label", "n", "place", "longs")))

    def folded_to(self, size: int) -> np.ndarray:
        """The sketches at a size that is theirs divided by a power of two: halves, one over the other."""
        longs = self.longs
        while len(longs) > size:
            longs = longs[: len(longs) // 2] ^ longs[len(longs) // 2:]
        return longs


def block_within_reach(hubs: Members, others: Members, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in hubs and others of the pairs that `within_reach` holds for, of unlike labels, the hub before the other in its bucket."""
    size = min(len(hubs.longs), len(others.longs))
    a, b = hubs.folded_to(size), others.folded_to(size)
    least, most, room = den * others.n, num * others.n, (den - num) * others.n
    found = []
    at, later = 0, 0
    while at < len(hubs.n) and (later := int(np.searchsorted(others.place, hubs.place[at], "right"))) < len(others.n):
        h, o = slice(at, at + max(1, BLOCK_CELLS // (len(others.n) - later))), slice(later, None)
        n = hubs.n[h, None]
        near = (den * n >= most[o]) & (least[o] >= num * n) & (hubs.label[h, None] != others.label[o]) & (hubs.place[h, None] < others.place[o])
        bits = np.zeros(near.shape, np.uint16)
        for x, y in zip(a[:BLOCK_LONGS], b):
            bits += np.bitwise_count(x[h, None] ^ y[o])
        i, j = np.nonzero(near & (bits * np.int64(den + num) <= (den - num) * n + room[o]))
        i, j, seen = at + i, later + j, bits[i, j].astype(np.int64)
        if len(i) and size > BLOCK_LONGS:
            seen += np.bitwise_count(a[BLOCK_LONGS:, i] ^ b[BLOCK_LONGS:, j]).sum(0, dtype=np.int64)
            few = (den + num) * seen <= (den - num) * hubs.n[i] + room[j]
            i, j = i[few], j[few]
        found.append((i, j))
        at = h.stop
    return tuple(np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64) for k in (0, 1))


# ---- Spark jobs -------------------------------------------------------------------------------------------------

def signed_sets(docs: DataFrame, width: int, bands: Bands) -> DataFrame:
    """Per row: doc_id, row_key, node (digest of its set, NULL if empty), n_shingles and signatures.

    A task gives the signatures of a set only once, however many of its rows have it.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, seen = WordHashes(), set()
        for batch in batches:
            nodes, sizes, signed, sketches = [], [], [], []
            for text in batch.column("text"):
                elements = shingle_hashes(text.as_py(), width, hashes)
                node = set_key(elements) if len(elements) else None
                signed.append(signatures(elements, bands) if node not in seen else np.empty(0, np.int64))
                sketches.append(sketch(elements) if len(signed[-1]) else np.empty(0, np.int64))
                seen.add(node)
                nodes.append(node)
                sizes.append(len(elements))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_key"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                                              lists(signed), lists(sketches)], ["doc_id", "row_key", "node", "n_shingles", "signatures", "sketch"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_key"))
    return rows.mapInArrow(run, f"doc_id {kind}, row_key long, node long, n_shingles long, signatures array<long>, sketch array<long>")


def lists(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = pa.array(np.cumsum([0] + [len(r) for r in rows]), pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(rows) if rows else np.empty(0, np.int64)))


def bucket_members(signed: DataFrame, tables: Tables) -> DataFrame:
    """(signature, node, weight) of signatures that at least two nodes have; weight: a node's number of such meetings.

    One row of a set gives its signatures, whatever task signed it.  They are shuffled once, for the count and the
    join alike.
    """
    rows = signed.where(F.size("signatures") > 0)
    first = rows.groupBy("node").agg(F.min("row_key").alias("row_key"), F.count(F.lit(1)).alias("rows")).where("rows > 1")
    repeats = rows.select("node", "row_key").join(first.withColumnRenamed("row_key", "first_key"), "node").where("row_key <> first_key").select("row_key")
    once = rows.select("row_key", "node", "signatures").join(small_side(tables.write(repeats, "repeats")), "row_key", "left_anti")
    dealt = once.select("node", F.explode("signatures").alias("signature")).where("signature IS NOT NULL").repartition("signature")
    bits = [F.bit_xor(F.xxhash64("node", F.lit(i))).alias(f"bits_{i}") for i in range(2)]
    shared = dealt.groupBy("signature").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("a"), F.max("node").alias("b"), *bits).where("a <> b")
    # signatures with the same members (their number, least, largest and 128 bits of digest) are one bucket
    kept = shared.groupBy("size", "a", "b", "bits_0", "bits_1").agg(F.min("signature").alias("signature"), F.sum("size").alias("members"))
    met = dealt.join(kept.select("signature", "members"), "signature").groupBy("signature", "node").agg(F.max("members").alias("members"))
    members = tables.write(met, "buckets")
    weights = members.groupBy("node").agg(F.sum("members").alias("weight"))
    return members.select("signature", "node").join(weights, "node")


def small_side(keys: DataFrame) -> DataFrame:
    """keys, marked for broadcast only if they were counted to be few."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_ROWS else keys


def linked_pairs(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, tables: Tables, width: int, num: int, den: int) -> DataFrame:
    """Those of pairs(hub, node), as (a, b), whose sets reach num / den, computed from the texts.

    A hub's text is sent once for PARTNERS others or so, each of which is sent to it.
    """
    key_of = nodes.select("node", "row_key")
    parts = pairs.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).alias("parts"))
    partners = pairs.join(parts, "hub").select("hub", F.pmod(F.xxhash64("node"), "parts").alias("part"), "node", F.lit(False).alias("is_hub"))
    hubs = partners.select("hub", "part", F.col("hub").alias("node"), F.lit(True).alias("is_hub")).distinct()
    wanted = tables.write(partners.union(hubs).join(key_of, "node"), "wanted")
    keyed = docs.select("text", F.xxhash64("doc_id", "text").alias("row_key"))
    texts = keyed.join(small_side(wanted), "row_key").select("hub", "part", "is_hub", "node", "text")

    def once(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:  # wholly repeated rows: one a task
        seen = set()
        for batch in batches:
            new = []
            for key in zip(*(batch.column(c).to_pylist() for c in ("hub", "part", "is_hub", "node"))):
                new.append(key not in seen)
                seen.add(key)
            yield batch.filter(pa.array(new, pa.bool_()))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, at, hub, last = WordHashes(), None, None, None
        for batch in batches:
            linked = []
            for h, part, is_hub, node, text in zip(*(batch.column(c) for c in ("hub", "part", "is_hub", "node", "text"))):
                h, part, node = h.as_py(), part.as_py(), node.as_py()
                if is_hub.as_py():
                    if at != (h, part):
                        at, hub, last = (h, part), shingle_hashes(text.as_py(), width, hashes), None
                elif node != last:
                    last, other = node, shingle_hashes(text.as_py(), width, hashes)
                    shared = len(np.intersect1d(hub, other, assume_unique=True))
                    if den * shared >= num * (len(hub) + len(other) - shared):
                        linked.append((h, node))
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in linked], pa.int64()) for i in (0, 1)], ["a", "b"])

    sent = texts.mapInArrow(once, texts.schema).repartition("hub", "part").sortWithinPartitions("hub", "part", F.desc("is_hub"), "node")
    return sent.mapInArrow(run, "a long, b long")


def merge_classes(classes: DataFrame, links: DataFrame, tables: Tables) -> DataFrame:
    """classes(node, label) after joining the classes that links(a, b) connect.

    Labels are contracted: each hooks onto its least neighbour, hooks are followed, and the links between
    the labels that are left go round again; every round at least halves the labels that still have links.
    """
    label_of = lambda c, name: classes.select(F.col("node").alias(c), F.col("label").alias(name))
    edges = tables.write(links.join(label_of("a", "x"), "a").join(label_of("b", "y"), "b").where("x <> y").select("x", "y").distinct(), "edges")
    while not edges.isEmpty():
        ways = edges.union(edges.select("y", "x"))
        hook = ways.groupBy("x").agg(F.min("y").alias("y")).where("y < x")
        twice = hook.alias("h").join(hook.alias("g"), F.col("h.y") == F.col("g.x"), "left").select(F.col("h.x").alias("x"), F.coalesce("g.y", "h.y").alias("y"))
        jump = tables.write(twice, "hooks")
        to = lambda c: jump.select(F.col("x").alias(c), F.col("y").alias(f"{c}_to"))
        classes = tables.write(classes.join(to("label"), "label", "left").select("node", F.coalesce("label_to", "label").alias("label")), "classes")
        edges = tables.write(edges.join(to("x"), "x", "left").join(to("y"), "y", "left")
                             .select(F.coalesce("x_to", "x").alias("x"), F.coalesce("y_to", "y").alias("y")).where("x <> y").distinct(), "edges")
    return classes


def near_pairs(rows: DataFrame, hubs_each: int, num: int, den: int) -> DataFrame:
    """(node, hub) of rows(signature, node, weight, label, n, sketch): members of one bucket, the hub one of its
    hubs_each best connected and better connected than the node, that have unlike labels and whose sketches may reach num / den.

    A task goes through its buckets in the order of their members and holds no more of one than its hubs.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, place, hubs = None, 0, {}
        for batch in batches:
            signature, node, label, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("signature", "node", "label", "n"))
            sketches = batch.column("sketch")
            begin, values = sketches.offsets.to_numpy(), sketches.values.to_numpy(zero_copy_only=False).view(U)
            sizes, found = np.diff(begin), []
            starts = np.flatnonzero(np.r_[True, signature[1:] != signature[:-1]]) if len(signature) else []
            for s, e in zip(starts, [*starts[1:], len(signature)]):
                if signature[s] != at:
                    at, place, hubs = signature[s], 0, {}
                here = {}
                for size in set(sizes[s:e].tolist()):
                    own = s + np.flatnonzero(sizes[s:e] == size)
                    here[size] = Members(node[own], label[own], n[own], place + own - s, values[begin[own] + np.arange(size)[:, None]])
                for size, members in here.items():
                    if place < hubs_each:
                        more = members.first(hubs_each)
                        hubs[size] = hubs[size].and_later(more) if size in hubs else more
                place += int(e - s)
                for hub in hubs.values():
                    for members in here.values():
                        i, j = block_within_reach(hub, members, num, den)
                        if len(i):
                            found.append((members.node[j], hub.node[i]))
            pairs = [pa.array(np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64), pa.int64()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(pairs, ["node", "hub"])

    dealt = rows.repartition("signature").sortWithinPartitions("signature", F.desc("weight"), "node")
    return dealt.mapInArrow(run, "node long, hub long")


def node_classes(docs: DataFrame, left: DataFrame, nodes: DataFrame, tables: Tables, width: int, num: int, den: int) -> DataFrame:
    """(node, label) for the nodes of left(signature, node, weight), the shared signatures; label is the class."""
    classes = tables.write(left.select("node").distinct().withColumn("label", F.col("node")), "classes")
    sketch_of = lambda c: nodes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}"))
    best = Window.partitionBy("signature").orderBy(F.desc("weight"), "node")
    hubs_each = FIRST_HUBS
    while not left.isEmpty():
        ranked = left.withColumn("rank", F.row_number().over(best))
        if hubs_each == FIRST_HUBS:  # one hub a bucket makes few pairs; classes are still the nodes
            met = left.join(ranked.where(F.col("rank") <= hubs_each).select("signature", F.col("node").alias("hub")), "signature").where("node <> hub")
        else:  # what the first hubs left may have many near misses, which are dropped where they meet
            met = near_pairs(left.join(classes, "node").join(nodes.select("node", "n", "sketch"), "node"), hubs_each, num, den)
        # a pair is looked at once, not in every bucket and not from both ends
        pairs = met.groupBy(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).agg(F.min("hub").alias("hub"))
        if hubs_each == FIRST_HUBS:
            pairs = pairs.join(sketch_of("a"), "a").join(sketch_of("b"), "b").where(within_reach("n_a", "sketch_a", "n_b", "sketch_b", num, den))
        pairs = pairs.select("hub", F.when(F.col("hub") == F.col("a"), F.col("b")).otherwise(F.col("a")).alias("node"))
        pairs = tables.write(pairs, "pairs")
        links = tables.write(linked_pairs(docs, nodes, pairs, tables, width, num, den), "links")
        classes = merge_classes(classes, links, tables)
        rest = ranked.where(F.col("rank") > hubs_each).drop("rank")
        apart = rest.join(classes, "node").groupBy("signature").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
        left = tables.write(rest.join(apart.select("signature"), "signature", "left_semi"), "members")
        hubs_each *= MORE_HUBS
    for name in ("members", "pairs", "wanted", "links", "edges", "hooks"):
        tables.drop(name)
    return classes


def jaccard_components(docs: DataFrame, width: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """doc_id, n_shingles and component_id for every row of docs(doc_id, text).

    Two texts are linked when their sets of width-word shingles have a Jaccard similarity of at least
    num / den; component_id is the smallest doc_id that links reach.  NULL and blank texts have the empty
    set and are linked with nothing, not even each other: their component is their own id.  Rows with one
    id are separate documents; a NULL id is a component's only if it has no other.  An empty table gives
    none.  Other columns are not read.  Sets are told apart by 64-bit digests of 64-bit shingle hashes.
    """
    tables = Tables(docs.sparkSession)
    signed = tables.write(signed_sets(docs, width, Bands(num, den)), "signed")
    left = tables.write(bucket_members(signed, tables), "members")
    tables.drop("buckets")
    tables.drop("repeats")
    with_sketch = signed.where(F.size("sketch") > 0).join(left.select("node").distinct(), "node", "left_semi")
    nodes = tables.write(with_sketch.groupBy("node").agg(
        F.min_by(F.struct("row_key", F.col("n_shingles").alias("n"), "sketch"), "row_key").alias("s")).select("node", "s.*"), "nodes")
    sets = tables.write(signed.select("doc_id", "node", "n_shingles"), "sets")
    tables.drop("signed")
    classes = node_classes(docs, left, nodes, tables, width, num, den)
    tables.drop("nodes")
    members = sets.join(classes, "node", "left").select("doc_id", "n_shingles", F.coalesce("label", "node").alias("label"))
    least = members.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("component_id"))
    return members.join(least, "label", "left").select(
        "doc_id", "n_shingles", F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_per_group(docs: DataFrame, width: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of docs with the smallest doc_id of their component; all columns stay.

    Of rows that repeat an id whole, one stays; documents without words all stay.
    """
    found = jaccard_components(docs, width, num, den)
    key = "kept_key"
    while key in docs.columns:
        key += "_"
    key_of = F.concat(F.when(F.col("doc_id").isNull(), "").otherwise("="), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias(key)
    keep = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(key_of).distinct()
    # rows are shuffled by the key, which serves the join and the repeated rows alike
    return docs.select("*", key_of).join(keep, key, "left_semi").dropDuplicates().drop(key)
