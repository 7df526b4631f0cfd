"""Catalogue queries of the operators: each applies one to its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from polidata.llm import bpe, decontam, html_text, jaccard, lm, manifest, neighbours, quality, rules, secrets, toxicity, warc, whitening
from polidata.plans.tables import table
from polidata.session import ship_package

#: The public vocabulary file that op5 encodes with.
VOCABULARY = "word_bpe_49k.json"


def vocabulary_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(VOCABULARY))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_records(table(spark, sf_dir, "pages"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(table(spark, sf_dir, "documents"), vocabulary_path())


def op6_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.jaccard_components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.language_model_scores(table(spark, sf_dir, "documents"))


def op10_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "failed_rules")


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.verify_tampering(table(spark, sf_dir, "documents"))


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_rows(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_rows(table(spark, sf_dir, "embeddings"))


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {q.__name__: shipped(q) for q in (op1_warc, op2_decontamination, op3_html, op4_secrets, op5_bpe,
                                           op6_jaccard, op7_quality, op8_toxicity, op9_lm, op10_rules, op11_manifest,
                                           op12_neighbours, op13_whitening)}
