"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and returns the documents it keeps.

Every stage but the last returns the columns of `documents`, as they are but for `text` and `n_chars`; further columns
go through whatever their names, as each stage carries them in a struct or under names with two underscores. Empty inputs
give empty outputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm.common import cut, row_key
from chartloom.llm.language import UNKNOWN, fit_decoder, identify
from chartloom.llm.minhash import linked_rows
from chartloom.llm.mixing import mixed_rows
from chartloom.llm.packing import pack_documents
from chartloom.llm.queries import WORD_VOCABULARY
from chartloom.llm.suffixes import cut_repeats


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts in some language: those without letters, and those of which no language has half the share, go."""
    rows = docs.select("text", F.struct(*docs.columns).alias("row"))
    found = identify(rows, fit_decoder(docs.select("text", "lang")), keep=("row",))
    return found.where((F.col("lang_pred") != UNKNOWN) & ~F.col("ambiguous")).select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, five-word shingles and a similarity of 0.8: the one of least id.

    Rows without id stay. Of rows with the same id and text one stays; unlike texts under one id are documents of their own.
    """
    found = linked_rows(docs, words=5, percent=80).where("doc_id IS NOT NULL")
    rows = found.groupBy("root", "doc_id", "uid").agg(F.count(F.lit(1)).alias("rows"))
    kept = cut(rows.groupBy("root").agg(F.min(F.struct("doc_id", "uid", "rows")).alias("r")).select("r.uid", "r.rows"))
    named = docs.where("doc_id IS NOT NULL").withColumn("__uid", row_key())
    single = named.join(kept.where("rows = 1"), named["__uid"] == kept["uid"], "left_semi")
    several = named.join(kept.where("rows > 1"), named["__uid"] == kept["uid"], "left_semi").dropDuplicates(["__uid"])
    return single.unionByName(several).select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 200 bytes that are anywhere else as well."""
    return cut_repeats(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights; a document taken twice is there twice."""
    return mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences with their token ids."""
    return pack_documents(docs, WORD_VOCABULARY)


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("mix_sources", mix),
    ("pack", pack),
]
