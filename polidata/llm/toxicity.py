"""Toxicity: a factorization machine over hashed terms.

A document is the set of its hashed terms: its words and the beginnings of its words, so that unseen
endings of a known stem count.  Besides a weight, each term has a short vector, and the products of
two terms' vectors add what neither term says alone (an insult with the mention of a group).  Only terms
that lean clearly to one label in the training sample are fitted, so that the many neutral terms of
long texts do not drown the signal; the fit is AdaGrad with a proximal L1 step.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polidata.llm.common import is_held_out, lower_words
from polidata.llm.training import FOLDS, HELD_OUT, labelled_sample, sigmoid

TRAIN_ROWS = 16_000
BITS, FACTORS = 19, 4
#: Lengths in bytes of the beginnings of words.
PREFIXES = (4, 5)
#: Removed from both ends of a word.
MARKS = b".,;:!?'\"()[]{}*#%&$|-_/<>"
#: Terms of fewer training documents, or with no clear lean (in standard deviations), get no weight.
LEAST_DOCUMENTS, LEAST_Z = 4, 5.0
EPOCHS, BATCH, RATE, FIRST, L1, L2, SEED = 10, 128, 0.15, 1e-4, 1e-5, 1e-3, 11
#: Small samples are gone through more often, until so many steps.
LEAST_STEPS = 400
#: 1: both classes weigh alike in total; 0: every document weighs alike.
BALANCE = 0.5


class TermCache(dict):
    """word -> hashed terms, those that `known` marks if it is given; forgets all at its limit."""

    def __init__(self, known: np.ndarray | None = None):
        super().__init__()
        self.known = known

    def __missing__(self, word: bytes) -> tuple[int, ...]:
        if len(self) >= 400_000:
            self.clear()
        core = word.strip(MARKS) or word
        terms = {b"w" + core, *(b"p" + core[:n] for n in PREFIXES if len(core) >= n)}
        hashed = [xxhash.xxh32_intdigest(t) >> (32 - BITS) for t in terms]
        found = self[word] = tuple(h for h in hashed if self.known is None or self.known[h])
        return found


def term_ids(text: str | None, cache: TermCache) -> np.ndarray:
    """The distinct hashed terms of a whole text, ascending."""
    return np.unique(np.fromiter(chain.from_iterable(map(cache.__getitem__, set(lower_words(text)))), np.int32))


class FactorizationMachine:
    def __init__(self, seed: int = SEED):
        r = np.random.default_rng(seed)
        self.start = 0.0
        self.weight = np.zeros(1 << BITS, np.float32)
        self.vector = r.normal(0, 0.02, (1 << BITS, FACTORS)).astype(np.float32)

    def margin(self, ids: np.ndarray) -> float:
        w = self.weight[ids]
        on = w != 0
        v = self.vector[ids[on]]
        return float(self.start + w.sum() + 0.5 * (v.sum(0) ** 2 - (v ** 2).sum(0)).sum())

    @staticmethod
    def telling(docs: list[np.ndarray], y: np.ndarray) -> np.ndarray:
        """Terms whose share of toxic documents is off the average by at least LEAST_Z standard deviations."""
        size, rate = 1 << BITS, y.mean()
        n = np.bincount(np.concatenate(docs), minlength=size)
        toxic = np.bincount(np.concatenate(docs), np.repeat(y, [len(d) for d in docs]), size)
        z = (toxic - n * rate) / np.sqrt(np.maximum(n * rate * (1 - rate), 1e-9))
        return (n >= LEAST_DOCUMENTS) & (np.abs(z) >= LEAST_Z)

    def fit(self, docs: list[np.ndarray], labels: list[int], epochs: int = EPOCHS, least_steps: int = LEAST_STEPS) -> FactorizationMachine:
        """Logistic loss over shuffled batches; both classes weigh alike in total."""
        y = np.array(labels, np.float64)
        if len(set(labels)) < 2:
            self.start = 6.0 if labels and labels[0] else -6.0
            return self
        class_weight = np.where(y > 0, (0.5 / y.mean()) ** BALANCE, (0.5 / (1 - y.mean())) ** BALANCE)
        told = self.telling(docs, y)
        docs = [d[told[d]] for d in docs]
        r = np.random.default_rng(SEED)
        g_w, g_v, g_0 = np.full(len(self.weight), FIRST), np.full(self.vector.shape, FIRST), FIRST
        for _ in range(max(epochs, -(-least_steps * BATCH // len(docs)))):
            order = r.permutation(len(docs))
            for at in range(0, len(order), BATCH):
                pick = order[at: at + BATCH]
                sizes = np.array([len(docs[i]) for i in pick])
                owner = np.repeat(np.arange(len(pick)), sizes)
                used, place = np.unique(np.concatenate([docs[i] for i in pick]), return_inverse=True)
                if not len(used):
                    continue
                w, v = self.weight[used], self.vector[used] * (self.weight[used] != 0)[:, None]
                per_doc = lambda x: np.bincount(owner, x, len(pick))
                sums = np.stack([per_doc(v[place, f]) for f in range(FACTORS)], 1)
                squares = np.stack([per_doc(v[place, f] ** 2) for f in range(FACTORS)], 1)
                p = sigmoid(self.start + per_doc(w[place]) + 0.5 * (sums ** 2 - squares).sum(1))
                error = (p - y[pick]) * class_weight[pick] / len(pick)
                g_0 += error.sum() ** 2
                self.start -= RATE * error.sum() / np.sqrt(g_0)
                per_term = lambda x: np.bincount(place, x, len(used))
                d_w = per_term(error[owner])
                g_w[used] += d_w ** 2
                rate = RATE / np.sqrt(g_w[used])
                moved = w - rate * d_w
                self.weight[used] = np.sign(moved) * np.maximum(np.abs(moved) - rate * L1, 0)
                d_v = np.stack([per_term(error[owner] * sums[owner, f]) for f in range(FACTORS)], 1) - d_w[:, None] * v + L2 * v
                g_v[used] += d_v ** 2
                self.vector[used] -= (RATE * d_v / np.sqrt(g_v[used])).astype(np.float32)
        self.vector[self.weight == 0] = 0
        return self


def train_toxicity(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> FactorizationMachine:
    """Fit on at most `rows` labelled documents outside the held-out fold; the driver gets their term ids only."""
    sample = labelled_sample(docs, labels, "toxic", rows)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = TermCache()
        for batch in batches:
            terms = [term_ids(t.as_py(), cache).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(terms, pa.binary()), batch.column(2)], ["doc_id", "terms", "label"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = sorted(sample.mapInArrow(run, f"doc_id {kind}, terms binary, label int").collect(), key=lambda r: (r["doc_id"], bytes(r["terms"])))
    return FactorizationMachine().fit([np.frombuffer(bytes(r["terms"]), np.int32) for r in got], [r["label"] for r in got])


def score_toxicity(docs: DataFrame, model: FactorizationMachine) -> DataFrame:
    """doc_id and score (0 to 1) of every row of docs(doc_id, text).

    Whole texts are read; NULL and empty ones have no terms and get the score of the start weight.
    Repeated rows get equal scores; other columns are not read; without labels nothing is toxic.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = TermCache(shared.value.weight != 0)
        for batch in batches:
            margins = np.array([shared.value.margin(term_ids(t.as_py(), cache)) for t in batch.column(1)], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sigmoid(margins))], ["doc_id", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Scores with the held-out mark and the prediction at a threshold."""
    scored = score_toxicity(docs, train_toxicity(docs, labels))
    return scored.select("doc_id", is_held_out(F.col("doc_id"), FOLDS, HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))
