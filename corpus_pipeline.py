"""The corpus pipeline: documents in, token ids of a clean, mixed corpus out.

Each stage takes what its predecessor kept, calls one operator, and lets its decisions take effect. All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from niimble.llm import bpe, importance, language_id, mixing, ngram_join
from niimble.llm.frames import fold, materialize, read_table, text_session
from niimble.llm.queries import WEIGHTS, vocabulary_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Cosines of texts in no language of the corpus scatter by 1 / sqrt(1024) = 0.03. Those of texts in one grow with
# their letters, as do those of chance letters, but less: a text of up to SHORT letters must reach LEAST_COSINE,
# one of twice as many COSINE_PER_DOUBLING more, and so on up to ENOUGH_COSINE.
SHORT = 32
LEAST_COSINE, COSINE_PER_DOUBLING, ENOUGH_COSINE = 0.08, 0.03, 0.2


def _as_rows(docs: DataFrame) -> DataFrame:
    """The text, and all columns as ``row``: an operator carries it like an id."""
    return docs.select(F.struct(*docs.columns).alias("row"), "text")


def least_cosine(letters: Column) -> Column:
    """What the score of a text of so many letters must reach."""
    doublings = F.log2(F.greatest(letters, F.lit(SHORT)) / F.lit(SHORT))
    return F.least(LEAST_COSINE + COSINE_PER_DOUBLING * doublings, F.lit(ENOUGH_COSINE))


def keep_known_languages(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a letter, and those like no language of the corpus, go."""
    profiles = language_id.learn(docs.where(fold("doc_id") != 0))
    found = language_id.predict(_as_rows(docs), profiles, "row", letters_column="n_letters")
    known = (F.col("lang_pred") != language_id.UNDETERMINED) & (F.col("score") >= least_cosine(F.col("n_letters")))
    return found.where(known).select("row.*")


def keep_good_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that importance resampling leaves out go."""
    model = importance.learn(docs, read_table(spark, folder, "labels").where(fold("doc_id") != 0))
    return importance.resample(_as_rows(docs), model, "row", noise_column="row.doc_id").where("kept").select("row.*")


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Of each group of near copies the document of the smallest id stays; of repeated rows one."""
    key = F.struct(F.col("doc_id"), F.xxhash64("text").alias("text_hash"))
    keyed = docs.withColumn("_key", key)
    groups = ngram_join.join_components(keyed, "_key").where(F.col("_key").eqNullSafe(F.col("component_id")))
    kept = materialize(groups.groupBy("_key").count(), "one-of-near-copies")
    one = keyed.alias("doc").join(kept, F.col("doc._key").eqNullSafe(kept["_key"]), "left_semi")
    if kept.where(F.col("count") > 1).limit(1).count():  # rows that repeat an id and its text
        one = one.dropDuplicates(["_key"])
    return one.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Each document as often as the mix of its source takes it."""
    return mixing.mixed_documents(docs, WEIGHTS)


def encode_texts(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token ids of every document in the mix."""
    return bpe.encode(docs, bpe.read_vocabulary(vocabulary_path("byte_bpe_50k.json")))


def _in_text_session(stage: Stage) -> Stage:
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(text_session(spark), docs, sf_dir)

    return run


STAGES: list[tuple[str, Stage]] = [
    (name, _in_text_session(stage))
    for name, stage in (
        ("language", keep_known_languages),
        ("quality", keep_good_quality),
        ("near_copies", keep_one_of_near_copies),
        ("mixing", mix_sources),
        ("encoding", encode_texts),
    )
]

# Trained models and token ids are not expressible in SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each is written and read again, so a lost executor costs one stage."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
