"""What changed: versions, sources, and how an incoming row relates to the stored one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.catalog import SHARED_TABLES
from chartloom.functions.keys import batch_file_id, event_file_id
from chartloom.operators.frames import blank_to_null, latest_per_key

# Operations, the folder mark of single-resource files, valid table names.
NEW, UPDATE, DUPLICATE = "new", "update", "duplicate"
EVENT_MARK = "event-load"
SIZE_COLUMNS = [f"{table}_max_array_size" for table in SHARED_TABLES]
RESOURCE_TYPE_PATTERN = r"^[a-z][a-z0-9_]*$"

# Columns of the audit table.
AUDIT_COLUMNS = [
    "resource_id", "operation", "meta_versionid", "meta_lastupdated", "meta_source",
    "resource_type", "filepath_id", "pipeline_type",
]


def version_id(version: Column) -> Column:
    """Whole-number version, 0 when it is missing or no number."""
    text = F.trim(version.cast("string"))
    return F.coalesce(F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint")), F.lit(0).cast("bigint"))


def identifier_source(identifiers: Column, default: str) -> Column:
    """Value of the first identifier whose system mentions `source`, else the default."""
    marked = F.filter(identifiers, lambda i: F.contains(F.lower(i["system"]), F.lit("source")))
    return F.coalesce(blank_to_null(F.get(marked, F.lit(0))["value"]), F.lit(default))


def is_resource_type(name: Column) -> Column:
    return F.coalesce(F.lower(name).rlike(RESOURCE_TYPE_PATTERN), F.lit(False))


def incoming_versions(parsed: DataFrame, default_source: str) -> DataFrame:
    """Id, version, update time and source of parsed documents, with the carried columns."""
    carried = [c for c in parsed.columns if c not in ("id", "meta", "identifier")]
    source = F.lit(default_source)
    if "identifier" in parsed.columns:
        # Some types have one identifier instead of a list.
        single = isinstance(parsed.schema["identifier"].dataType, T.StructType)
        identifiers = F.array("identifier") if single else F.col("identifier")
        source = identifier_source(identifiers, default_source)
    return parsed.select(
        "id",
        version_id(F.col("meta.versionId")).alias("meta_versionid"),
        F.col("meta.lastUpdated").alias("meta_lastupdated"),
        source.alias("meta_source"),
        *carried,
    )


def file_ids(rows: DataFrame) -> DataFrame:
    """Add `filepath_id`: per resource and version below event folders, else per file.

    An id that came with the rows is kept.
    """
    made = F.when(
        from_event(), event_file_id(F.col("id"), F.col("meta_versionid"))
    ).otherwise(batch_file_id(F.col("url")))
    given = [F.col("filepath_id")] if "filepath_id" in rows.columns else []
    return rows.withColumn("filepath_id", F.coalesce(*given, made))


def from_event() -> Column:
    """Whether a row's file was staged by the event exporter."""
    return F.coalesce(F.contains("url", F.lit(EVENT_MARK)), F.lit(False))


def newest_versions(rows: DataFrame) -> DataFrame:
    """One row per id: highest version, then latest update time."""
    return latest_per_key(rows, ["id"], newest_first(rows))


def newest_first(rows: DataFrame) -> list[Column]:
    """Order by version and instant of the update; rows equal in both go by their digest, so reruns agree."""
    instant = F.col("meta_lastupdated").try_cast("timestamp")
    return [
        F.col("meta_versionid").desc(),
        instant.desc_nulls_last(),
        F.col("meta_lastupdated").desc_nulls_last(),
        F.xxhash64(*rows.columns).desc(),
    ]


def with_stored(incoming: DataFrame, state: DataFrame) -> DataFrame:
    """Stored version and array sizes beside each incoming row; null where nothing is stored.

    A plain left join: Spark broadcasts the state only when its measured size allows, and
    splits skewed ids otherwise.
    """
    stored = state.select(
        "id",
        F.col("meta_versionid").alias("meta_versionid_db"),
        *[F.col(c).alias(f"{c}_db") for c in SIZE_COLUMNS],
    )
    return incoming.join(stored, "id", "left")


def operation_of(stored: Column, incoming: Column) -> Column:
    """new without a stored version, duplicate when it is not older, else update."""
    known = F.coalesce(stored, F.lit(0))
    return (
        F.when(known == 0, NEW).when(known >= incoming, DUPLICATE).otherwise(UPDATE)
    )


def classify(joined: DataFrame) -> DataFrame:
    return joined.withColumn(
        "operation", operation_of(F.col("meta_versionid_db"), F.col("meta_versionid"))
    )


def classify_by_file(joined: DataFrame) -> DataFrame:
    """As `classify`, but the first version of a resource from an event is always new."""
    looked_up = operation_of(F.col("meta_versionid_db"), F.col("meta_versionid"))
    first = from_event() & (F.col("meta_versionid") == 1)
    return joined.withColumn("operation", F.when(first, NEW).otherwise(looked_up))


def changed_rows(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("operation") != DUPLICATE)


def stored_sizes(classified: DataFrame) -> DataFrame:
    """Stored array sizes of the updated ids, 0 where unknown."""
    sizes = [F.coalesce(f"{c}_db", F.lit(0)).cast("int").alias(f"{c}_db") for c in SIZE_COLUMNS]
    return classified.where(F.col("operation") == UPDATE).select("id", *sizes)


def audit_rows(classified: DataFrame) -> DataFrame:
    """Audit table rows; empty texts become null."""
    named = classified.withColumnRenamed("id", "resource_id")
    texts = {c: blank_to_null(F.col(c)) for c in AUDIT_COLUMNS if c != "meta_versionid"}
    return named.select(*[texts.get(c, F.col(c)).alias(c) for c in AUDIT_COLUMNS])
