"""A corpus-cleaning pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``.  All but the
last return the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.llm import common as C
from arrivals.llm import jaccard_join, language_id, packing, paragraph_dedup, secrets_scan
from arrivals.llm.queries import vocabulary_path

#: Words whose ids a packing worker keeps, fewer and not as long as where packing runs
#: alone: the executors also hold what other stages took, before and after.
PACKING_RUNS = 50_000


def _measured(docs: DataFrame) -> DataFrame:
    """``n_chars``, where there is one, follows the changed text."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.length(F.col("text").cast("string")).cast(kind))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents without a language: null texts and those without a letter."""
    lang, score = (C.fresh(x, docs.columns) for x in ("lang_pred", "score"))
    found = language_id.identify(docs, language_id.learn(docs), lang_pred=lang, score=score)
    return found.filter(F.col(lang) != language_id.UNKNOWN).drop(lang, score)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies, the one with the smallest id."""
    return jaccard_join.one_of_each(docs)


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes passages that an earlier document has; the rest of the text stays."""
    return _measured(paragraph_dedup.drop_repeats(docs))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts."""
    model = secrets_scan.train(secrets_scan.labelled_findings(spark))
    return _measured(secrets_scan.redact(docs, model))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all texts into sequences of token ids."""
    return packing.pack(docs, vocabulary_path(), runs=PACKING_RUNS, forget=True)


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_copies),
    ("paragraph_dedup", drop_repeated_passages),
    ("secret_scan", redact_secrets),
    ("packing", pack_sequences),
]

#: Forests, profiles, MinHash and tokens are beyond SQL; tests/llm compares each
#: stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = C.stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
