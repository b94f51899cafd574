"""Registry of queries and their SQL, and the SQL pieces they share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chartloom.catalog import Catalog
from chartloom.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

CATALOG = Catalog.builtin()
AS_OF = "2024-02-01 00:00:00"

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its name, with the SQL expected to give the same rows."""

    def register(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return query(prepare(spark), sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return query

    return register


def uuid5_sql(name: str) -> str:
    """DuckDB text of the version-5 UUID of `name` in the DNS namespace."""
    digest = f"sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode({name}))"
    low = f"('0x' || substr({digest}, 17, 1))::INTEGER % 4"
    return (
        f"(substr({digest}, 1, 8) || '-' || substr({digest}, 9, 4) || '-5' || substr({digest}, 14, 3)"
        f" || '-' || substr('89ab', {low} + 1, 1) || substr({digest}, 18, 3)"
        f" || '-' || substr({digest}, 21, 12))"
    )


def key_sql(text: str) -> str:
    """DuckDB text of the 64-bit key of `text`."""
    return f"CAST(('0x' || left(md5({text}), 16))::UBIGINT AS VARCHAR)"


# Patient columns straight from the customer table.
PATIENT_VERSION = "CASE WHEN c_custkey % 50 = 0 THEN 0 ELSE 1 + c_custkey % 3 END"
PATIENT_UPDATED = "'2024-01-' || lpad(CAST(1 + c_custkey % 28 AS VARCHAR), 2, '0') || 'T00:00:00Z'"
# Stored state of four in five patients.
STORED = """
    SELECT 'pat-' || c_custkey AS id, CAST(1 + c_custkey % 2 AS INTEGER) AS meta_versionid,
           CAST(c_custkey % 4 AS INTEGER) AS codeableconcept_max_array_size,
           CAST(c_custkey % 3 AS INTEGER) AS reference_max_array_size,
           CAST(c_custkey % 2 AS INTEGER) AS identifier_max_array_size
    FROM customer WHERE c_custkey % 5 <> 0
"""
