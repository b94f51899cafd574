"""Corpus pipeline: the stages that turn raw documents into packed sequences."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from chartloom.llm import stages
from chartloom.session import shared_folder

STAGES = stages.STAGES
ORACLE_SQL = None  # no stage is expressible in SQL; tests/llm compares them with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each reads what the one before wrote."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
