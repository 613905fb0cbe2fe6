"""One registered query per operator, over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.llm import common as C


#: The vocabulary that queries 7 and 8 are asked to use; operators take a path.
VOCABULARY = "word_bpe_49k.json"


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arrivals.llm import language_id as L
    docs = C.table(spark, sf_dir, "documents")
    out = L.held_out("doc_id", 4, 2)
    profiles = L.learn(docs.filter(~out))
    return (L.identify(docs.select("doc_id", "text"), profiles)
            .select("doc_id", out.alias("held_out"), "lang_pred", "score"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arrivals.llm.html_text import main_text
    return main_text(C.table(spark, sf_dir, "pages"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arrivals.llm import secrets_scan as S
    return S.scan(C.table(spark, sf_dir, "documents"), S.train(S.labelled_findings(spark)))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arrivals.llm import toxicity as T
    docs, labels = C.table(spark, sf_dir, "documents"), C.table(spark, sf_dir, "labels")
    out = T.held_out("doc_id", 5, 0)
    model = T.learn(docs, labels.filter(~out))
    return (T.score(docs.select("doc_id", "text"), model)
            .select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arrivals.llm.topk import top_inner_products
    return top_inner_products(C.table(spark, sf_dir, "embeddings"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arrivals.llm.fingerprints import edit_study
    return edit_study(C.table(spark, sf_dir, "documents"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arrivals.llm.packing import pack
    return pack(C.table(spark, sf_dir, "documents"), vocabulary_path()).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arrivals.llm import bpe
    path = vocabulary_path()
    coded = bpe.encode(C.table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    return bpe.decode(coded, path).select(
        "doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op9_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arrivals.llm.paragraph_dedup import repeated_paragraphs
    return repeated_paragraphs(C.table(spark, sf_dir, "documents"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arrivals.llm.jaccard_join import jaccard_components
    return jaccard_components(C.table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arrivals.llm.token_alignment import align
    return align(C.table(spark, sf_dir, "documents"), vocabulary_path("byte_bpe_50k.json"),
                 vocabulary_path("piece_bpe_32k.model"), digest=True).withColumnRenamed("groups", "groups_sha256")


def op12_pitman_yor(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arrivals.llm.language_id import held_out
    from arrivals.llm.pitman_yor import score
    scored = score(C.table(spark, sf_dir, "documents"), ~held_out("doc_id", 10, 0))
    return scored.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from arrivals.llm.hard_negatives import mine
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(C.table(spark, sf_dir, "embeddings").withColumn("label", label))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit() and callable(f)}


#: Floored vectors and their integer inner product, in DuckDB.
_VECTORS = """
v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS e
      FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"""
_PRODUCT = "CAST(list_sum(list_transform(range(1, len({a}.e) + 1), lambda i: {a}.e[i] * {b}.e[i])) AS BIGINT)"

_TOPK = f"""
WITH {_VECTORS.format(scale=64)},
s AS (SELECT q.vec_id AS query_id, c.vec_id, {_PRODUCT.format(a="q", b="c")} AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20"""

_NEGATIVES = f"""
WITH {_VECTORS.format(scale=256)},
w AS (SELECT vec_id, e, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label
      FROM v WHERE label IS NOT NULL),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, {_PRODUCT.format(a="a", b="c")} AS score
      FROM w a JOIN w c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, CAST(row_number() OVER (
      PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank
      FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
      AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""


def oracle_sql() -> dict[str, str]:
    """SQL for the two operators it can express and run over the whole table."""
    return {"op5_exact_topk": _TOPK, "op13_hard_negatives": _NEGATIVES}
