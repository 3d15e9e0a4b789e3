"""The registered digests of the training-data operators, one ``opN_<name>`` each."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fill_in_middle, language, licenses, mixing, near_dedup, packing, quality, spelling, substrings, token_codes, topk, toxicity, warc
from .common import materialise, read_table


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"), words=2).drop("text_key")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.divergence(read_table(spark, sf_dir, "documents")).drop("lang", "text_key")


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    sized = materialise(docs.select("doc_id", "source", mixing.size_of(docs["text"]).alias("size")), "sizes")
    return mixing.copies(sized).select("doc_id", "size", "source_size", "target",
                                       (F.col("copies") * F.col("size")).alias("taken"))


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return token_codes.read_tokens(token_codes.write_tokens(docs, public_tokenizers.path("word_bpe_49k.json")))


def archive_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_back(spark, warc.convert(spark, warc.write_arc(read_table(spark, sf_dir, "pages"))))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: a source is a repository, ids give the directories, and a
    document that opens or ends with a licence line stands for its directory's licence file."""
    docs = read_table(spark, sf_dir, "documents")
    ends = F.concat_ws("\n", F.substring_index("text", "\n", 1), F.substring_index("text", "\n", -1))
    opens = F.coalesce(ends.rlike(r"(?i)licen[cs]e|rights reserved"), F.lit(False))
    name = F.concat(F.when(opens, F.lit("LICENSE-")).otherwise(F.lit("")), F.col("doc_id").cast("string"))
    path = F.concat_ws("/", F.floor(F.col("doc_id") / 1000).cast("string"), F.floor(F.col("doc_id") / 100).cast("string"), name)
    return licenses.scan(docs.select("doc_id", F.col("source").alias("repo"), path.alias("path"), "text"))


def exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = materialise(topk.integer_vectors(read_table(spark, sf_dir, "embeddings")), "vectors")
    index, shards = topk.build(vectors)
    return topk.search(vectors.where("vec_id % 100 = 0"), index, shards)


TOPK_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
q AS MATERIALIZED (SELECT *, row_number() OVER () AS q_row FROM v WHERE vec_id % 100 = 0),
s AS (
  SELECT q_row, q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: CAST(p[1] * p[2] AS BIGINT))) AS BIGINT) AS score
  FROM q JOIN v c ON q.vec_id <> c.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY q_row ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    fold = language.remainder(F.col("doc_id"), 5)
    lexicon = toxicity.train(docs, read_table(spark, sf_dir, "labels").where(fold != 0))
    return toxicity.score(docs, lexicon).select("doc_id", (fold == 0).alias("held_out"), "score", "predicted")


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    fold = language.remainder(F.col("doc_id"), 3)
    model = language.train(docs.where(fold != 1))
    return language.predict(docs, model).select("doc_id", (fold == 1).alias("held_out"), "lang_pred", "score")


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.remove_repeats(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(read_table(spark, sf_dir, "documents"))


def fill_in_the_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle.transform(read_table(spark, sf_dir, "documents"))
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"),
                      sha(fill_in_middle.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": near_duplicates,
    "op3_quality_divergence": quality_rules,
    "op6_source_mix": source_mix,
    "op2_best_fit_packing": best_fit_packing,
    "op8_archive_conversion": archive_conversion,
    "op7_license_scan": license_scan,
    "op4_exact_topk": exact_topk,
    "op9_toxicity": toxicity_scores,
    "op10_language_id": language_id,
    "op5_token_codes": token_output,
    "op11_substring_dedup": substring_dedup,
    "op12_spelling_variants": spelling_variants,
    "op13_fill_in_middle": fill_in_the_middle,
}
MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
         [3, 1, 2][1 + (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3]::DOUBLE AS weight FROM s),
o AS (  -- sources in the order in which a rising level fills them
  SELECT *, cap / weight AS full_at,
         coalesce(sum(cap) OVER before, 0) AS given, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open_weight,
         1.5::DOUBLE * sum(source_size) OVER () AS wanted
  FROM w WINDOW before AS (ORDER BY cap / weight, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lv AS (SELECT arg_min((wanted - given) / open_weight, full_at) FILTER ((wanted - given) / open_weight < full_at) AS level FROM o),
t AS (SELECT source, source_size, CASE WHEN source_size = 0 THEN 0 ELSE least(cap, weight * coalesce(level, 0)) END AS target FROM o, lv),
r AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, CASE WHEN t.source_size = 0 THEN 0 ELSE t.target / t.source_size END AS rate,
         CAST('0x' || substr(md5('mix-1:' || coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, CAST(target AS DOUBLE) AS target,
       CAST(size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM r
"""
REPEATS_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos, len(words) AS n FROM d),
starts AS (
  SELECT doc_id, pos, word, list(word) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS win, n FROM w),
again AS (
  SELECT doc_id, pos, word, n, pos + 19 <= n AND row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) > 1 AS later FROM starts),
covered AS (
  SELECT doc_id, pos, word, max(later::INT) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone FROM again),
kept AS (
  SELECT doc_id, sum(gone)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (gone = 0) AS text FROM covered GROUP BY doc_id)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
MIDDLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u FROM documents),
k AS (
  SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(u) + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (len(u) + 1) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 90
              THEN 'plain' WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (
  SELECT *, array_to_string(u[1:least(a, b)], '') AS pre, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS mid,
         array_to_string(u[greatest(a, b) + 1:], '') AS suf FROM k)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(pre) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(mid) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM p
"""
ORACLE: dict[str, str] = {"op13_fill_in_middle": MIDDLE_SQL, "op11_substring_dedup": REPEATS_SQL, "op4_exact_topk": TOPK_SQL, "op6_source_mix": MIX_SQL}
