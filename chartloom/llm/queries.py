"""Registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm.bytepairs import decode_ids, encode_texts
from chartloom.llm.common import fold, table
from chartloom.llm.fingerprints import edit_fingerprints
from chartloom.llm.graph import nearest
from chartloom.llm.language import identify_held_out
from chartloom.llm.minhash import near_duplicates
from chartloom.llm.mixing import mix_plan
from chartloom.llm.negatives import hard_negatives
from chartloom.llm.packing import pack_documents
from chartloom.llm.preferences import format_preferences, reply_pairs
from chartloom.llm.scoring import score_texts
from chartloom.llm.spelling import spelling_variants
from chartloom.llm.suffixes import without_repeats
from chartloom.llm.toxicity import score_toxicity

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

# One-byte signs for the letters of two bytes, as the SQL engine's edit distance goes by bytes.
ACCENTED = "".join(map(chr, range(0xC0, 0x100)))
SIGNS = "".join(chr(c) for c in range(0x20, 0x7F) if not chr(c).islower() and chr(c) not in "'")[: len(ACCENTED)]

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


@register
def op1_context_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), fold("doc_id", 7) == 2)


@register
def op2_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_held_out(table(spark, sf_dir, "documents"), fold("doc_id", 4) == 2)


@register
def op3_pruned_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest(vectors, vectors.where("vec_id % 20 = 0"))


@register
def op4_pack_tiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(table(spark, sf_dir, "documents"), WORD_VOCABULARY)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@register
def op5_noisy_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return score_toxicity(documents, labels, fold("doc_id", 3) == 1)


@register
def op6_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_preferences(reply_pairs(table(spark, sf_dir, "conversations")))


@register
def op7_super_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=2)


@register
def op8_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))


@register
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(table(spark, sf_dir, "documents"))
    taken = F.aggregate("draws", F.lit(0).cast("long"), lambda total, draw: total + draw["words"])
    return plan.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "draws")


@register
def op10_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edit_fingerprints(table(spark, sf_dir, "documents"))


@register
def op11_pivotal_grams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"), damage=97)


ORACLES["op11_pivotal_grams"] = """
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS run FROM documents)
  GROUP BY ALL
), digests AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295, flatten(list_transform(bytes, lambda b: list_transform(range(8), lambda i: (b >> i) & 1)))),
    lambda c, bit: xor(c >> 1, 3988292384 * ((c & 1) + bit - 2 * (c & bit))))) AS h
  FROM (SELECT run, n, flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''),
          lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195, unicode(c)::BIGINT - 64] END)) AS bytes
        FROM runs)
), words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
                    ELSE run END AS word, n FROM digests)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cuts AS (
  SELECT word, n, unnest(list_prepend(word, list_transform(range(1, length(word) + 1),
                                                           lambda i: word[:i - 1] || word[i + 1:]))) AS part
  FROM words
), near AS MATERIALIZED (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n
  FROM cuts AS a JOIN cuts AS b USING (part)
  WHERE a.word <> b.word AND levenshtein(translate(a.word, letters, signs), translate(b.word, letters, signs)) = 1
), best AS (
  SELECT word, n, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n
  FROM near GROUP BY word, n
), named AS MATERIALIZED (
  SELECT word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 2 * words.n THEN other END AS form,
         CASE WHEN other_n >= 2 * words.n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS place, form AS next FROM named
  UNION ALL
  SELECT chain.word, named.word, named.form FROM chain JOIN named ON named.word = chain.next
)
SELECT word, form, place AS root, n, n_near, form_n FROM named JOIN chain USING (word) WHERE next IS NULL
""".replace("letters", f"'{ACCENTED}'").replace("signs", f"'{SIGNS}'")


@register
def op12_vertical_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0, label)


ORACLES["op12_vertical_scan"] = """
WITH clean AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM clean AS a JOIN clean AS b ON a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score,
         row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id)::INTEGER AS positive_rank
  FROM scored WHERE alike QUALIFY positive_rank <= 5
)
SELECT anchor_id, positive_id, other_id AS negative_id, positive_score, score AS negative_score, positive_rank,
       row_number() OVER (PARTITION BY anchor_id, positive_rank ORDER BY score DESC, other_id)::INTEGER AS rank
FROM positives JOIN scored USING (anchor_id)
WHERE NOT alike AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
QUALIFY rank <= 5
"""


@register
def op13_token_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_texts(table(spark, sf_dir, "documents"), BYTE_RANKS, public_tokenizers.PATTERN)
    return decode_ids(encoded, BYTE_RANKS, public_tokenizers.PATTERN).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
