"""Audit and lineage messages, and the two halves of a file's lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions.keys import is_uuid

# Columns of the lineage table. These four are what the ingesting side reports.
OUTCOME_COLUMNS = ["is_inserted", "retry_count", "error_code", "reject_location"]
FIRST_HALF_COLUMNS = [
    "filepath_id", "resource_type", "fhir_request_url", "record_count", "pipeline_type",
    "destination_location", "created_date",
]
WARN_EVERY = 10


def first_half(resources: DataFrame, pipeline_type: str, as_of: str) -> DataFrame:
    """One row per staged file: what was asked for, how much came, where it lies.

    Needs the columns filepath_id, resource_type, fhir_request_url, destination_location.
    """
    keys = ["filepath_id", "resource_type", "fhir_request_url", "destination_location"]
    counts = resources.groupBy(*keys).agg(F.count(F.lit(1)).cast("int").alias("record_count"))
    return counts.withColumns(
        {"pipeline_type": F.lit(pipeline_type), "created_date": F.lit(as_of).cast("timestamp")}
    ).select(*FIRST_HALF_COLUMNS)


def second_half(audit: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One outcome row per file that has audit rows. Of several outcomes the one with the highest code counts."""
    files = audit.select("filepath_id").distinct()
    worst_first = ["error_code", "retry_count", *[c for c in OUTCOME_COLUMNS if c not in ("error_code", "retry_count")]]
    single = outcomes.groupBy("filepath_id").agg(F.max(F.struct(*worst_first)).alias("_outcome"))
    joined = files.join(single, "filepath_id", "left")
    return joined.select("filepath_id", *[F.col(f"_outcome.{c}").alias(c) for c in OUTCOME_COLUMNS])


def with_outcome(
    messages: DataFrame,
    is_inserted: Column | None = None,
    retry_count: Column | None = None,
    error_code: Column | None = None,
    reject_location: Column | None = None,
) -> DataFrame:
    """Set the given outcome fields on message rows and leave the others alone."""
    given = {
        "is_inserted": is_inserted,
        "retry_count": retry_count,
        "error_code": error_code,
        "reject_location": reject_location,
    }
    return messages.withColumns({name: value for name, value in given.items() if value is not None})


def merge_halves(first: DataFrame, second: DataFrame, as_of: str) -> DataFrame:
    """Lineage rows of files with both halves; only the outcome fields are overwritten."""
    reported = second.where(is_uuid(F.col("filepath_id"))).select("filepath_id", *OUTCOME_COLUMNS)
    known = first.select(*FIRST_HALF_COLUMNS)
    return known.join(reported, "filepath_id").withColumn(
        "updated_date", F.lit(as_of).cast("timestamp")
    )


def waiting_halves(first: DataFrame, second: DataFrame) -> DataFrame:
    """Outcomes whose file is not known yet, to be tried again."""
    waiting = second.join(first.select("filepath_id"), "filepath_id", "left_anti")
    count = F.coalesce("reschedule_count", F.lit(0)) + 1
    return waiting.withColumn("reschedule_count", count).withColumn(
        "is_warned", F.col("reschedule_count") % WARN_EVERY == 0
    )


def route(messages: DataFrame) -> DataFrame:
    """Buffer every message belongs to: audit, lineage_first or lineage_second."""
    target = (
        F.when(F.col("table_name") == "fhir_audit", "audit")
        .when(F.col("pipeline_type").isNotNull(), "lineage_first")
        .otherwise("lineage_second")
    )
    return messages.withColumn("route", target)


def property_rows(rows: DataFrame, column: str, value: str) -> DataFrame:
    return rows.where(F.col(column) == value)
