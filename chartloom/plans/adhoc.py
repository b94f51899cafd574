"""The produced tables as SQL views, and the documented queries on them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.catalog import SHARED_TABLES, Catalog
from chartloom.operators.frames import union_frames
from chartloom.operators.shared import normalize, resource_table, shared_table


def register_views(
    spark: SparkSession,
    documents: dict[str, DataFrame],
    catalog: Catalog,
    only: dict[str, list[str]] | None = None,
) -> None:
    """Views over documents by resource type, plus the shared tables of all of them.

    A view is a plan: a query parses only for the tables it names. `only` lists the elements
    the queries need, by resource type, so that the others are skipped in parsing.

    The optimizer knows the size of the files, not of the rows parsed from them, which are many times larger, and would
    send a whole view to every task. So joins of views are merged; a broadcast that a query asks for goes before.
    """
    shared: dict[str, list[DataFrame]] = {table: [] for table in SHARED_TABLES}
    for resource, lines in documents.items():
        chosen = (only or {}).get(resource)
        wide = normalize(lines, resource, catalog, chosen)
        resource_table(wide).hint("merge").createOrReplaceTempView(resource.lower())
        for table in SHARED_TABLES:
            elements = [
                e.name
                for e in catalog.of_shape(resource, table)
                if chosen is None or e.name in chosen
            ]
            if elements:
                rows = normalize(lines, resource, catalog, elements, (table,))
                shared[table].append(shared_table(rows, table))
    for table, parts in shared.items():
        rows = union_frames(None, parts)
        if rows is not None:
            rows.hint("merge").createOrReplaceTempView(table)


def save_colocated(rows: DataFrame, name: str, path: str, buckets: int = 16) -> None:
    """Save a produced table hashed by id, so that joins on id with others need no shuffle.

    Tables to be joined must have the same number of buckets.
    """
    (
        rows.write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, "id")
        .sortBy("id")
        .saveAsTable(name)
    )


# The documented queries that users of the tables run, with their table and column names.
PATIENT_DEMOGRAPHICS = """
    SELECT id, gender, birthdate, name_family, name_given FROM patient ORDER BY id LIMIT {limit}
"""
OBSERVATION_UNITS = """
    SELECT o.id, c.seq_no, c.text AS code_text, o.valuequantity_value, o.valuequantity_unit
    FROM observation o JOIN codeableconcept c ON c.id = o.id AND c.field_name = 'code'
    WHERE o.valuequantity_value IS NOT NULL
"""
CONDITION_CODES = """
    SELECT c.code, c.text, count(*) AS n
    FROM condition co JOIN codeableconcept c ON c.id = co.id AND c.field_name = 'code'
    GROUP BY c.code, c.text ORDER BY n DESC, c.code LIMIT {limit}
"""
OBSERVATIONS_PER_PATIENT = """
    SELECT r.reference AS patient_ref, count(*) AS observation_count
    FROM observation o JOIN reference r ON r.id = o.id AND r.field_name = 'subject'
    GROUP BY r.reference ORDER BY observation_count DESC, patient_ref LIMIT {limit}
"""
RECENT_PROPERTIES = """
    SELECT * FROM properties ORDER BY updated_date DESC, property LIMIT {limit}
"""
LATEST_SUCCESS = """
    SELECT folder_name, total_files, backup_timestamp, hostname FROM run_log
    WHERE status = 'SUCCESS' ORDER BY backup_timestamp DESC LIMIT 1
"""


def manifest_missing(expected: DataFrame, present: DataFrame, folder: str) -> DataFrame:
    """Expected files (path, size) whose path is not among the present names of a folder."""
    inside = F.col("name").startswith(folder)
    paths = present.where(inside).select(F.expr(f"substr(name, {len(folder) + 1})").alias("path"))
    return expected.join(paths, "path", "left_anti")
