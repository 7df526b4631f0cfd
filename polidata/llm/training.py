"""Labelled rows for the classifiers: all, or a bounded and reproducible choice; never the held-out ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polidata.llm.common import is_held_out

#: Rows are held out of training when crc32 of their id has this remainder.
FOLDS, HELD_OUT = 5, 0


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """doc_id, text and label (int) of at most `rows` labelled documents outside the held-out fold.

    The documents with the lowest hashes of their ids are taken, so that the choice depends neither on
    the order of rows nor on their partitions.  NULL labels and NULL ids are left out; of several labels
    of one id the highest counts; an id with several rows is one row, of the text with the lowest hash, so
    that an id with very many rows is not more of the sample than any other.
    """
    chosen = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id"), FOLDS, HELD_OUT))
              .groupBy(F.col("doc_id").alias("chosen_id")).agg(F.max(label).cast("int").alias("label"))
              .orderBy(F.xxhash64("chosen_id"), "chosen_id").limit(rows))
    return (docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen_id"))
            .groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("label").alias("label")))


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """doc_id, text and label (int) of all labelled documents outside the held-out fold; one row an id, as in labelled_sample."""
    known = (labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~is_held_out(F.col("doc_id"), FOLDS, HELD_OUT))
             .groupBy(F.col("doc_id").alias("known_id")).agg(F.max(label).cast("int").alias("label")))
    fitted = docs.select("doc_id", "text").where(~is_held_out(F.col("doc_id"), FOLDS, HELD_OUT))
    return (fitted.join(known, F.col("doc_id") == F.col("known_id"))
            .groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"), F.max("label").alias("label")))


def sigmoid(x):
    import numpy as np

    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))
