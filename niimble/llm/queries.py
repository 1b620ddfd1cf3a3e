"""Queries of the operators on whole tables, with production parameters, and their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from niimble.llm import (
    bpe, fingerprints, hard_negatives, importance, language_id, mixing, ngram_join, quality_rules, substring_dedup,
    token_counts, toxicity, warc, whitening,
)
from niimble.llm.frames import fold, read_table, scratch_path, text_session

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(build: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(text_session(spark), folder)

    QUERIES[build.__name__] = run
    return build


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.join_components(read_table(spark, folder, "documents"))


WEIGHTS = (5, 2, 1)


@query
def op2_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, folder, "documents"), WEIGHTS)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op3_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    return importance.resample(docs, importance.learn(docs, labels.where(fold("doc_id") != 0)))


@query
def op4_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text")
    labels = read_table(spark, folder, "labels").select("doc_id", "toxic")
    learned = fold("doc_id") != 0
    model = toxicity.learn(docs.where(learned), labels.where(learned))
    return toxicity.score(docs, model).withColumn("held_out", fold("doc_id") == 0)


@query
def op5_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compare_with_next(read_table(spark, folder, "documents"))


@query
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    pieces = token_counts.read_pieces(vocabulary_path("piece_bpe_32k.model"))
    return token_counts.count_tokens(read_table(spark, folder, "documents"), pieces)


@query
def op7_warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    root = scratch_path(spark, "warc")
    warc.write_archives(read_table(spark, folder, "pages"), root)
    return warc.read_archives(spark, root, with_payload=False).select(
        F.col("page").cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast("long").alias("refers_to"),
    )


@query
def op8_bpe_encoding(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = bpe.read_vocabulary(vocabulary_path("byte_bpe_50k.json"))
    return bpe.digests(read_table(spark, folder, "documents"), vocabulary)


@query
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents").select("doc_id", "text", "lang")
    profiles = language_id.learn(docs.where(fold("doc_id") != 0))
    found = language_id.predict(docs, profiles)
    return found.select("doc_id", (fold("doc_id") == 0).alias("held_out"), "lang_pred", "score")


@query
def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    trees = quality_rules.learn(docs, labels.where(fold("doc_id") != 0))
    return quality_rules.judge(docs, trees)


@query
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % 100 == 0)


@query
def op12_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    # DECIMAL holds what a long cannot at tens of millions of rows; such a deviation is NULL here
    found = whitening.whiten(read_table(spark, folder, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


@query
def op13_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    digest = F.sha2(F.col("kept"), 256).alias("kept_sha256")
    return substring_dedup.remove_repeats(read_table(spark, folder, "documents"), of_kept=digest)


SQL["op7_warc_archives"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""

SQL["op1_ngram_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)
  UNION
  SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND 4
), n AS (
  SELECT doc_id, count(shingle) AS n FROM d LEFT JOIN s USING (doc_id) GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM pairs p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)
), edges AS (
  SELECT x, y FROM links UNION SELECT y, x FROM links
), reach AS (
  SELECT x, y FROM edges
  UNION
  SELECT r.x, l.y FROM reach r JOIN edges l ON r.y = l.x
)
SELECT n.doc_id, n.n::BIGINT AS n_shingles, least(n.doc_id, min(r.y)) AS component_id
FROM n LEFT JOIN reach r ON n.doc_id = r.x GROUP BY n.doc_id, n.n
"""

SQL["op2_source_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    (('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE)
      / 4503599627370496::DOUBLE AS u
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::DOUBLE AS w
  FROM d GROUP BY source
), a AS (
  SELECT *, sum(source_size) OVER () * 1.5::DOUBLE AS words,
    coalesce(sum(source_size * 2) OVER (ORDER BY source_size / w, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS earlier,
    sum(w) OVER (ORDER BY source_size / w, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
  FROM s
), b AS (
  SELECT *, w * (words - earlier) > source_size * 2 * rest AS is_full FROM a
), c AS (
  SELECT source, source_size,
    CASE WHEN is_full THEN (source_size * 2)::DOUBLE
      ELSE w * (words - coalesce(sum(CASE WHEN is_full THEN source_size * 2 END) OVER (), 0)::DOUBLE)
        / sum(CASE WHEN NOT is_full THEN w END) OVER () END AS target
  FROM b
), e AS (
  SELECT d.doc_id, d.source, d.size, d.u, c.source_size, c.target,
    CASE WHEN c.source_size > 0 THEN least(c.target / c.source_size, 2::DOUBLE) ELSE 0 END AS expected
  FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source
), f AS (
  SELECT *, floor(expected) AS certain, expected - floor(expected) AS p FROM e
), g AS (
  SELECT *, (u / (1 - u)) / (p / (1 - p)) AS odds, target - sum(certain * size) OVER (PARTITION BY source) AS open
  FROM f
), h AS (
  SELECT *, CASE WHEN p > 0 THEN floor(odds / (1 + odds) * 1099511627776::DOUBLE)::BIGINT END AS pos FROM g
), r AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY pos NULLS LAST, doc_id
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS reached,
    sum(size) OVER (PARTITION BY source, pos, doc_id) AS own
  FROM h
)
SELECT doc_id, size, source_size, target,
  ((certain + CASE WHEN p > 0 AND open - (reached - own) > 0
      AND (reached <= open OR reached - open <= open - (reached - own)) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM r
"""

SQL["op11_hard_negatives"] = """
WITH x AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM x a JOIN x b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, p.positive_id, s.id AS negative_id, p.positive_score, s.score AS negative_score,
  row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id)::INT AS rank
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
QUALIFY rank <= 5
"""

SQL["op13_substring_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT r, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
  FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)
), c AS (
  SELECT DISTINCT r, unnest(range(i, i + 35)) AS place
  FROM s WHERE h IN (SELECT h FROM s GROUP BY h HAVING count(*) > 1)
), k AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS kept
  FROM (SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM d) ANTI JOIN c USING (r, place) GROUP BY r
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(k.n, 0))::BIGINT AS n_removed,
  sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""
