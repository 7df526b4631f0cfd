"""Benchmark decontamination by latent semantic retrieval.

TF-IDF vectors of passages, over the benchmark's words, are projected on the leading right singular vectors of the matrix of the
passages of the benchmark and of all documents, found by a distributed randomised SVD (range finder with power iterations) on its
normal matrix, which one pass over the documents sums up.  Windows of every document
whose cosine with a benchmark passage reaches CANDIDATE_COSINE are candidates, and so are those that hold
GRAM words of an item in a row, whatever their cosine; each is then checked on the words themselves: the longest common subsequence with the item, and that of the item's answer (its
last sentence), so that paraphrases count and mere similarity of topic does not.

Document frequencies come from all documents, without the words of such runs, so that a widely copied item
does not lower its own weight; all windows are searched.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polidata.llm.common import lower_words, written

RANK, OVERSAMPLING, POWER_PASSES, SEED = 256, 8, 2, 5
#: The passages of all documents together weigh in the SVD as those of so many would (of fewer, as they are), and how much more one of the benchmark does.
DOCUMENTS_WEIGHT, ITEM_WEIGHT = 400, 8.0
#: Cells of the normal matrix that a task sums up at once, and about how many words it goes through.
CELLS, TASK_WORDS = 1 << 24, 16_000_000
#: Bytes of the rows of the normal matrix that are one part (one row, if that is larger), and of the parts that are about one file: a task reads a file at once.
PART_BYTES, FILE_BYTES = 1 << 18, 1 << 22
#: Words whose passages are multiplied at once.
GROUP_WORDS = 8_192
WINDOW, STRIDE = 32, 16
CANDIDATE_COSINE = 0.25
#: A match holds this share of the item in order; or the smaller one together with this share of the answer.
WHOLE_SHARE, PARAPHRASE_SHARE, ANSWER_SHARE = 0.8, 0.6, 0.8
#: So many words of an item in a row make a window a candidate; of a shorter item, the whole item.
GRAM = 3
#: Items with fewer words must occur word by word.
SHORT_ITEM = 8
#: Items that are searched for at once; more are searched for in further passes.
BLOCK_ITEMS = 200
#: Words of a document that are projected at once.
SLICE_WORDS = 50_000

MARKS = b".,;:!?'\"()[]{}*#%&$|-_/<>"
SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


class FeatureIds(dict):
    """word -> feature of the word without surrounding marks; 0 for words that the benchmark does not have.

    A cache that forgets all at its limit.
    """

    def __init__(self, features: dict[bytes, int]):
        super().__init__()
        self.features = features

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 200_000:
            self.clear()
        f = self[word] = self.features.get(word.strip(MARKS) or word, 0)
        return f


def plain_words(text: str | None) -> list[bytes]:
    return [w.strip(MARKS) or w for w in lower_words(text)]


def feature_ids(words: list[bytes], cache: FeatureIds) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), np.int32, len(words))


# ---- runs of an item's words -------------------------------------------------------------------------------------

MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93], np.uint64)


def gram_hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of the `length` features from each place on (as many as there are whole runs)."""
    x, n = ids.astype(np.uint64), max(0, len(ids) - length + 1)
    h = x[:n] * MULTIPLIERS[0]
    for j in range(1, length):
        h += x[j: j + n] * MULTIPLIERS[j]
    return h


class GramIndex:
    """The runs of GRAM words (of a shorter item, the whole item) of benchmark items, by hash."""

    def __init__(self, items: list[np.ndarray]):
        by_length: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for n, ids in enumerate(items):
            length = min(GRAM, len(ids))
            if length:
                own = np.unique(gram_hashes(ids, length))
                by_length.setdefault(length, []).append((own, np.full(len(own), n)))
        #: (length, hashes ascending, item of each, which leading bits occur)
        self.tables = []
        for length, parts in sorted(by_length.items()):
            hashes, owner = (np.concatenate(c) for c in zip(*parts))
            order = np.argsort(hashes, kind="stable")
            bits = max(10, len(hashes).bit_length() + 6)
            seen = np.zeros(1 << bits, bool)
            seen[hashes >> np.uint64(64 - bits)] = True
            self.tables.append((length, hashes[order], owner[order], seen, np.uint64(64 - bits)))

    def runs(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """For each length that occurs: places of a text where a run begins, the first and last rank of its hash, and owners by rank."""
        for length, hashes, owner, seen, shift in self.tables:
            h = gram_hashes(ids, length)
            at = seen[h >> shift].nonzero()[0]
            if not len(at):
                continue
            h = h[at]
            last = hashes.searchsorted(h, "right")
            on = hashes[last - 1] == h  # rank -1 is the largest hash, which a hash below all does not equal
            if on.any():
                yield length, at[on], hashes.searchsorted(h[on]), last[on], owner

    def hits(self, ids: np.ndarray) -> set[tuple[int, int]]:
        """(item, start of the window) for the runs in a text; windows start at multiples of STRIDE."""
        found = set()
        for _, at, first, last, owner in self.runs(ids):
            for a, lo, hi in set(zip((at // STRIDE * STRIDE).tolist(), first.tolist(), last.tolist())):
                found.update((n, a) for n in owner[lo:hi].tolist())
        return found

    def outside(self, ids: np.ndarray) -> np.ndarray:
        """The features of a text that are in no run."""
        keep = None
        for length, at, *_ in self.runs(ids):
            keep = np.ones(len(ids), bool) if keep is None else keep
            for j in range(length):
                keep[at + j] = False
        return ids if keep is None else ids[keep]


# ---- statistics and latent space -----------------------------------------------------------------------------

def stored_ids(docs: DataFrame, features: dict[bytes, int]) -> DataFrame:
    """doc_id and ids (int32, little-endian): the features of all words of each row's text, written once for the passes over them."""
    shared = docs.sparkSession.sparkContext.broadcast(features)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = FeatureIds(shared.value)
        for batch in batches:
            for at in range(0, len(batch), 1_000):
                part = batch.slice(at, 1_000)
                ids = [feature_ids(lower_words(t.as_py()), cache).tobytes() for t in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return written(docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids binary"), "feature-ids")


def from_binary(value: pa.Scalar) -> np.ndarray:
    return np.frombuffer(value.as_buffer(), np.int32)


def document_frequencies(docs: DataFrame, features: dict[bytes, int], grams: GramIndex) -> tuple[np.ndarray, int]:
    """Documents per feature that have it outside the items' runs, and documents, over all rows; a sum per benchmark word reaches the driver."""
    return id_frequencies(stored_ids(docs.withColumn("doc_id", F.lit(0)), features), len(features) + 1, grams)


def id_frequencies(stored: DataFrame, size: int, grams: GramIndex) -> tuple[np.ndarray, int]:
    """document_frequencies from stored ids."""
    shared = stored.sparkSession.sparkContext.broadcast(grams)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, total = shared.value, np.zeros(size + 1, np.int64)
        for batch in batches:
            for ids in batch.column(0):
                total[:size] += np.bincount(index.outside(from_binary(ids)), minlength=size) > 0
            total[size] += len(batch)
        cell = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(total[cell])], ["feature", "n"])

    sums = stored.select("ids").mapInArrow(run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(size + 1, np.int64)
    counts[sums.column("feature").to_numpy()] = sums.column("n").to_numpy()
    return counts[:size], int(counts[size])


def inverse_frequencies(df: np.ndarray, n_docs: int) -> np.ndarray:
    """IDF by feature; feature 0, all other words, counts like the median benchmark word in lengths of vectors."""
    idf = np.maximum(np.log((n_docs + 1) / (df + 1)), 0.01)
    idf[0] = np.median(idf[1:])
    return idf


def passage_rows(texts: list[np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries of the texts' rows in the TF-IDF matrix, of length 1: row, feature (not 0) and value, by row."""
    lengths = np.array([len(ids) for ids in texts])
    passages = -(-lengths // WINDOW)
    place = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    row = place // WINDOW + np.repeat(np.cumsum(passages) - passages, lengths)
    cell, tf = np.unique(row * len(idf) + np.concatenate(texts), return_counts=True)
    row, f = np.divmod(cell, len(idf))
    x = np.where(f == 0, np.sqrt(tf), tf) * idf[f]  # words beside the benchmark's: as many different ones
    norm = np.sqrt(np.bincount(row, x * x))
    on = f > 0
    return row[on], f[on], x[on] / norm[row[on]]


def text_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The texts of batches(ids), several together and long ones in parts of whole passages: at most about twice GROUP_WORDS words."""
    most = max(1, GROUP_WORDS // WINDOW) * WINDOW
    held, size = [], 0
    for batch in batches:
        for ids in map(from_binary, batch.column(0)):
            for at in range(0, len(ids), most):
                held.append(ids[at: at + most])
                size += len(held[-1])
                if size >= most:
                    yield held
                    held, size = [], 0
    if held:
        yield held


def part_rows(size: int) -> int:
    """Rows of a normal matrix of this size that are one part."""
    return max(1, PART_BYTES // (8 * size))


def normal_matrix(stored: DataFrame, idf: np.ndarray, n_words: int) -> DataFrame:
    """(part, sums): the normal matrix transpose(A) A of the passage matrix A of all rows, part_rows of it a part (float64).

    A task sums up at most CELLS cells; a larger matrix is gone through in bands of its rows.  Parts are small and
    dealt over many files, since a task holds all rows of a batch, and those of a file, at once.
    """
    shared = stored.sparkSession.sparkContext.broadcast(idf)
    size = len(idf)
    rows = part_rows(size)
    band = max(rows, CELLS // size // rows * rows)
    bands = -(-size // band)

    def sums(low: int):
        high = min(size, low + band)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            weights, total = shared.value, np.zeros((high - low) * size, np.float32)
            for texts in text_groups(batches):
                row, f, x = passage_rows(texts, weights)
                # each entry with all of its row: first and number of a row's entries, by entry
                count = np.bincount(row)
                first = (np.cumsum(count) - count)[row]
                count = count[row]
                own = (f >= low) & (f < high)
                left = np.repeat(np.flatnonzero(own), count[own])
                right = np.arange(len(left)) - np.repeat(np.cumsum(count[own]) - count[own], count[own]) + first[left]
                np.add.at(total, (f[left] - low) * size + f[right], (x[left] * x[right]).astype(np.float32))
            total = total.reshape(-1, size)
            for i in range(0, len(total), rows):
                if total[i: i + rows].any():
                    yield pa.RecordBatch.from_arrays([pa.array([(low + i) // rows], pa.int32()), pa.array([total[i: i + rows].tobytes()], pa.binary())], ["part", "sums"])

        return run

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = np.zeros(1), None
        for batch in batches:
            for part, held in zip(batch.column("part"), batch.column("sums")):
                total = total + np.frombuffer(held.as_buffer(), np.float32).astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array([part.as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], ["part", "sums"])

    few = stored.select("ids").coalesce(1 + n_words // TASK_WORDS)
    found = None
    for i in range(bands):
        own = few.mapInArrow(sums(i * band), "part int, sums binary")
        found = own if found is None else found.union(own)

    files = -(-8 * size * size // FILE_BYTES)
    return written(found.repartition(files, "part").groupBy("part").applyInArrow(add, "part int, sums binary"), "svd-normal")


def normal_product(parts: list[tuple[DataFrame, float]], basis: np.ndarray) -> np.ndarray:
    """The sum of normal matrices, each times its weight, times basis; a row of it for each feature reaches the driver."""
    size, width = basis.shape
    shared = parts[0][0].sparkSession.sparkContext.broadcast(basis)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, held in zip(batch.column(0), batch.column(1)):
                product = np.frombuffer(held.as_buffer()).reshape(-1, size) @ shared.value
                yield pa.RecordBatch.from_arrays([pa.array([part.as_py()], pa.int32()), pa.array([product.tobytes()], pa.binary())], ["part", "sums"])

    product = np.zeros((size, width))
    for matrix, weight in parts:
        for row in matrix.mapInArrow(run, "part int, sums binary").collect():
            own = np.frombuffer(bytes(row["sums"])).reshape(-1, width)
            product[row["part"] * part_rows(size):][: len(own)] += weight * own
    return product


def singular_vectors(parts: list[tuple[DataFrame, float]], size: int, rank: int = RANK) -> np.ndarray:
    """Leading right singular vectors (features x rank) of the passage matrix, by randomised SVD on its normal matrix."""
    width = min(rank + OVERSAMPLING, size)
    basis = np.linalg.qr(np.random.default_rng(SEED).normal(size=(size, width)))[0]
    for _ in range(POWER_PASSES):
        basis = np.linalg.qr(normal_product(parts, basis))[0]
    values, inner = np.linalg.eigh(basis.T @ normal_product(parts, basis))
    best = np.argsort(values)[::-1][:rank]
    return basis @ inner[:, best[values[best] > 1e-9]]


# ---- checks on the words ----------------------------------------------------------------------------------------

def common_subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence, with one bit for each word of a."""
    places: dict = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    row = full = (1 << len(a)) - 1
    for w in b:
        hit = row & places.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@dataclass
class Item:
    item_id: int | None
    words: list[bytes]
    answer: list[bytes]


def benchmark_item(item_id: int | None, text: str | None) -> Item:
    """The item's words, and those of its answer: the last sentence if there are several, else all."""
    sentences = [s for s in SENTENCE.split((text or "").strip()) if plain_words(s)]
    return Item(item_id, plain_words(text), plain_words(sentences[-1]) if len(sentences) > 1 else plain_words(text))


def contains_run(words: list, run: list) -> bool:
    return any(words[i: i + len(run)] == run for i in range(len(words) - len(run) + 1))


class Searcher:
    """Benchmark items in the latent space, and the search of one text for them."""

    def __init__(self, items: list[Item], features: dict[bytes, int], idf: np.ndarray, vectors: np.ndarray):
        self.items, self.features = items, features
        self.square = (idf ** 2).astype(np.float32)
        latent = idf[:, None] * vectors
        latent[0] = 0
        cache = FeatureIds(features)
        owner, rows = [], []
        for n, item in enumerate(items):
            ids = feature_ids(item.words, cache)
            for i in range(0, max(1, len(ids) - WINDOW // 2), WINDOW):  # a long item is searched for by its windows
                own = ids[i: i + WINDOW] if len(ids) > 2 * WINDOW else ids
                rows.append(latent[own].sum(0) / max(np.sqrt(self.square[own].sum()), 1e-9))
                owner.append(n)
                if own is ids:
                    break
        self.owner = np.array(owner)
        #: Words of items and answers as features, which no other word of a text has; and the different ones of items.
        self.words = [feature_ids(item.words, cache).tolist() for item in items]
        self.answers = [feature_ids(item.answer, cache).tolist() for item in items]
        self.kinds = [frozenset(w) for w in self.words]
        self.grams = GramIndex([np.array(w, np.int32) for w in self.words])
        #: Products of each word's latent vector with each query's: sums of them are the products of windows.
        self.product = (latent @ np.array(rows).T).astype(np.float32)
        self.bound = np.maximum(self.product.max(1), 0)

    def near(self, ids: np.ndarray, least: float) -> Iterator[tuple[int, np.ndarray]]:
        """(number of window, cosine with each query) for the windows where some query may reach `least`.

        A window starts at STRIDE times its number.  No cosine is above the sum of its words' largest
        products with any query; windows whose bound is too low are passed over.  A word counts once
        in each stride of a window.
        """
        starts = np.arange(0, len(ids), STRIDE)
        square, bound = np.add.reduceat(self.square[ids], starts), np.add.reduceat(self.bound[ids], starts)
        if len(starts) > 1:
            square, bound = square[:-1] + square[1:], bound[:-1] + bound[1:]
        length = np.sqrt(np.maximum(square, 1e-9))
        for w in np.flatnonzero(bound >= least * length):
            at = int(w) * STRIDE
            words = [f for half in (ids[at: at + STRIDE], ids[at + STRIDE: at + WINDOW]) for f in set(half.tolist())]
            yield int(w), self.product[words].sum(0) / length[w]

    def candidates(self, words: list[bytes], cache: FeatureIds) -> dict[tuple[int, int], float | None]:
        """(item, start of window) -> cosine, for the windows of a text that are near enough to an item; None if they only share a run with it."""
        return self.windows(feature_ids(words, cache))

    def windows(self, ids: np.ndarray) -> dict[tuple[int, int], float | None]:
        found: dict[tuple[int, int], float | None] = {}
        for at in range(0, len(ids), SLICE_WORDS):
            part = ids[at: at + SLICE_WORDS + WINDOW]
            for w, cosine in self.near(part, CANDIDATE_COSINE):
                for q in np.flatnonzero(cosine >= CANDIDATE_COSINE):
                    key = int(self.owner[q]), at + w * STRIDE
                    found[key] = max(found.get(key) or 0.0, float(cosine[q]))
            for n, start in self.grams.hits(part):
                found.setdefault((n, at + start))
        return found

    def cosine(self, n: int, ids: np.ndarray) -> float:
        """The largest cosine of one window with the queries of an item."""
        words = [f for half in (ids[:STRIDE], ids[STRIDE:]) for f in set(half.tolist())]
        first, last = np.searchsorted(self.owner, [n, n + 1])
        return float(self.product[words, first:last].sum(0).max() / np.sqrt(max(self.square[ids].sum(), 1e-9)))

    def leaks(self, text: str | None, cache: FeatureIds) -> list[tuple[int | None, int, float, float, float]]:
        """(item_id, first word of the window, cosine, share of the item, share of its answer), the best window per item."""
        return self.leaks_of(feature_ids(lower_words(text), cache))

    def leaks_of(self, ids: np.ndarray) -> list[tuple[int | None, int, float, float, float]]:
        """leaks of a text by the features of its words."""
        if not len(ids) or not self.items:
            return []
        best: dict[int, tuple] = {}
        for (n, at), cosine in self.windows(ids).items():
            own, answer_words = self.words[n], self.answers[n]
            region = ids[max(0, at - len(own)): at + WINDOW + len(own)].tolist()
            most = len(own) - len(self.kinds[n]) + len(self.kinds[n].intersection(region))  # no subsequence is longer
            if most / len(own) < PARAPHRASE_SHARE:
                continue
            share = common_subsequence(own, region) / len(own)
            if share < PARAPHRASE_SHARE:
                continue
            answer = common_subsequence(answer_words, region) / len(answer_words)
            if len(own) < SHORT_ITEM:
                matches = contains_run(region, own)
            else:
                matches = share >= WHOLE_SHARE or answer >= ANSWER_SHARE
            if matches and cosine is None:
                cosine = self.cosine(n, ids[at: at + WINDOW])
            if matches and (n not in best or (share, cosine, -at) > (best[n][3], best[n][2], -best[n][1])):
                best[n] = self.items[n].item_id, at, cosine, share, answer
        return list(best.values())


# ---- Spark jobs ---------------------------------------------------------------------------------------------------

def distinct_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = sorted(set().union(*(plain_words(t.as_py()) for t in batch.column("text"))))
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.binary())], ["word"])


def benchmark_grams(items: DataFrame, features: dict[bytes, int]) -> GramIndex:
    """The runs of all benchmark items."""
    cache = FeatureIds(features)
    return GramIndex([feature_ids(plain_words(r["text"]), cache) for r in items.select("text").distinct().toLocalIterator()])


def searchers(docs: DataFrame, benchmark: DataFrame) -> list:
    """Broadcast searchers, each for a block of at most about BLOCK_ITEMS benchmark rows."""
    return fitted_searchers(docs, benchmark)[0]


def fitted_searchers(docs: DataFrame, benchmark: DataFrame) -> tuple[list, DataFrame | None]:
    """searchers, and the stored features of all documents' words (none without items)."""
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text").where(F.length(F.trim("text")) > 0)
    n_items = items.count()
    if n_items == 0:
        return [], None
    names = items.mapInArrow(distinct_words, "word binary").distinct().orderBy("word").toArrow().column("word").to_pylist()
    features = {w: i + 1 for i, w in enumerate(names)}
    stored = stored_ids(docs, features)
    df, n_docs = id_frequencies(stored, len(features) + 1, benchmark_grams(items, features))
    idf = inverse_frequencies(df, n_docs)
    words = lambda rows: (rows.agg(F.sum(F.octet_length("ids"))).first()[0] or 0) // 4
    everywhere = normal_matrix(stored, idf, words(stored)), min(1.0, DOCUMENTS_WEIGHT / max(1, n_docs))
    blocks = -(-n_items // BLOCK_ITEMS)
    found = []
    for block in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block) if blocks > 1 else items
        rows = sorted((benchmark_item(r["item_id"], r["text"]) for r in own.collect()), key=lambda i: (i.item_id is None, i.item_id or 0, i.words))
        rows = [i for i in rows if i.words]
        if rows:
            own_ids = stored_ids(own.select(F.col("item_id").alias("doc_id"), "text"), features)
            vectors = singular_vectors([everywhere, (normal_matrix(own_ids, idf, words(own_ids)), ITEM_WEIGHT ** 2)], len(idf))
            found.append(spark.sparkContext.broadcast(Searcher(rows, features, idf, vectors)))
    return found, stored


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows (doc_id, item_id, first_word, cosine, item_share, answer_share): benchmark items found in documents.

    One row per row of docs(doc_id, text) and row of benchmark(item_id, text) that match, with the best
    window; first_word is where that window starts.  Whole texts are searched.  NULL and blank texts match
    nothing; an empty table on either side gives no rows; repeated rows match alike, each on its own.
    Other columns are not read.
    """
    fitted, stored = fitted_searchers(docs, benchmark)
    kind, item_kind = docs.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()
    fields = [("item_id", pa.int64()), ("first_word", pa.int64()), ("cosine", pa.float64()), ("item_share", pa.float64()), ("answer_share", pa.float64())]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, rows = [], []
            for i, ids in enumerate(batch.column(1)):
                own = [leak for s in fitted for leak in s.value.leaks_of(from_binary(ids))]
                places += [i] * len(own)
                rows += own
            columns = list(zip(*rows)) if rows else [()] * len(fields)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(places, pa.int64())), *(pa.array(c, t) for c, (_, t) in zip(columns, fields))],
                                             ["doc_id", *(f for f, _ in fields)])

    if stored is None:
        stored = docs.limit(0).select("doc_id", F.lit(b"").alias("ids"))
    found = stored.mapInArrow(run, f"doc_id {kind}, item_id long, first_word long, cosine double, item_share double, answer_share double")
    return found.withColumn("item_id", F.col("item_id").cast(item_kind))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that hold no benchmark item, with all their columns."""
    fitted = searchers(docs, benchmark)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = FeatureIds(fitted[0].value.features if fitted else {})
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            clean = [not any(s.value.leaks(t.as_py(), cache) for s in fitted) for t in texts]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
