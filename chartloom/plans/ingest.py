"""Batch ingest: staged lines of one resource type into the published tables."""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from functools import cached_property

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.catalog import SHARED_TABLES, Catalog
from chartloom.operators import changes, errors, load
from chartloom.operators.flatten import parse_documents
from chartloom.operators.published import Snapshot, TableSet, Written
from chartloom.operators.shared import normalize, resource_table, shared_table
from chartloom.sources.ndjson import scan_documents

VERSION_ELEMENTS = ("meta", "identifier")


@dataclass
class Ingest:
    """Settings of an ingest run."""

    resource: str
    catalog: Catalog
    tables: TableSet
    work: str
    as_of: str
    default_source: str = "default"
    pipeline_type: str = "core-data-ingester"

    def __post_init__(self) -> None:
        # Every resource type numbers its batches itself.
        self.tables = self.tables.of(self.table)

    @property
    def table(self) -> str:
        return self.resource.lower()

    def shared_name(self, shared: str) -> str:
        return f"{self.table}_{shared}"

    @cached_property
    def schemas(self) -> dict[str, T.StructType]:
        """Schemas of the tables the resource type is loaded into."""
        nothing = self.tables.spark.createDataFrame([], "value string")
        normalized = normalize(nothing, self.resource, self.catalog)
        stamp = T.StructField("updated_date", T.TimestampType())
        schemas = {self.table: T.StructType([*resource_table(normalized).schema.fields, stamp])}
        for shared in SHARED_TABLES:
            if f"{shared}_rows" in normalized.columns:
                fields = shared_table(normalized, shared).schema.fields
                schemas[self.shared_name(shared)] = T.StructType([*fields, stamp])
        return schemas

    def read(self, table: str) -> DataFrame:
        """Published rows of one of the tables."""
        return self.tables.read(table, self.schemas[table])

    def rejected(self, version: int) -> DataFrame:
        """Lines of a batch that could not be loaded, with their error code."""
        incoming = self.tables.spark.read.parquet(f"{self.work}/{version}/in")
        return incoming.where(F.col("error_code").isNotNull()).select(
            "url", "filepath_id", F.col("document").alias("value"), "error_code", "unknown_elements"
        )


class StepFailed(Exception):
    """A step of an ingest failed as a whole; `code` is what its lines are reported with."""

    def __init__(self, code: str):
        super().__init__(code)
        self.code = code


@contextmanager
def step(code: str) -> Iterator[None]:
    try:
        yield
    except (PySparkException, Py4JJavaError) as error:
        raise StepFailed(code) from error


def classified_documents(lines: DataFrame, run: Ingest, snapshot: Snapshot) -> DataFrame:
    """Incoming lines (value, url) with their operation against the published state.

    Rows that cannot be loaded have an error code instead. Further columns of the lines, such
    as a `filepath_id` given with the file, stay. Only the buckets of the incoming ids are
    read.
    """
    ids = parse_documents(lines.select("value"), run.resource, run.catalog, [])
    buckets = run.tables.touched(ids)
    scanned = scan_documents(lines, run.resource, run.catalog)
    used = [f"doc.{e.name}" for e in run.catalog.elements(run.resource) if e.name in VERSION_ELEMENTS]
    kept = [c for c in lines.columns if c != "value"]
    parsed = scanned.select(
        *kept, F.col("value").alias("document"), "unknown_elements", "error_code", "doc.id", *used
    )
    incoming = changes.file_ids(changes.incoming_versions(parsed, run.default_source)).withColumns(
        {"resource_type": F.lit(run.resource), "pipeline_type": F.lit(run.pipeline_type)}
    )
    stored = run.tables.read(run.table, run.schemas[run.table], buckets, snapshot)
    # A type without one of the shared tables has size 0 there.
    missing = {c: F.lit(0) for c in changes.SIZE_COLUMNS if c not in stored.columns}
    version = changes.version_id(F.col("meta_versionid"))
    joined = changes.with_stored(
        incoming, stored.withColumns({**missing, "meta_versionid": version})
    )
    classified = changes.classify_by_file(joined)
    loadable = F.col("error_code").isNull()
    return classified.withColumn("operation", F.when(loadable, F.col("operation")))


def ingest(
    spark: SparkSession,
    lines: DataFrame,
    run: Ingest,
    version: int,
    seen: tuple[Observation, list[Column]] | None = None,
) -> DataFrame:
    """Load one batch and publish it; returns the audit rows of what could be loaded.

    Classified documents and normalized rows are each written once to the shared folder, so
    the four tables neither parse again nor depend on the executors that parsed. The tables
    are written at the same time and published together. `seen` are metrics taken of all classified lines as they are
    written. A failing step raises `StepFailed` and publishes nothing.
    """
    at, before = f"{run.work}/{version}", run.tables.snapshot(before=version)
    with step(errors.READ_FAILED):
        classified = classified_documents(lines, run, before)
        observed = classified.observe(seen[0], *seen[1]) if seen else classified
        observed.write.mode("overwrite").parquet(f"{at}/in")
    classified = spark.read.parquet(f"{at}/in").where(F.col("error_code").isNull())
    with step(errors.SHAPE_FAILED):
        newest = changes.newest_versions(changes.changed_rows(classified))
        documents = newest.select(F.col("document").alias("value"))
        normalize(documents, run.resource, run.catalog).write.mode("overwrite").parquet(f"{at}/rows")
    normalized = spark.read.parquet(f"{at}/rows")

    # Rows stored for any loaded id go, whatever it was classified as.
    replaced = normalized.select("id")

    def write(table: str) -> Written:
        rows = resource_table(normalized) if table == run.table else None
        if rows is None:
            rows = shared_table(normalized, table.removeprefix(f"{run.table}_"))
        stamped = load.stamped(rows, run.as_of).drop("__op")
        return run.tables.upsert(table, run.schemas[table], stamped, replaced, version, before)

    with step(errors.INSERT_FAILED):
        with ThreadPoolExecutor(len(run.schemas)) as pool:
            written = dict(zip(run.schemas, pool.map(write, run.schemas), strict=True))
        run.tables.publish(version, {t: w for t, (w, _) in written.items()}, {t: a for t, (_, a) in written.items()})
    return changes.audit_rows(classified)
