"""Documents from NDJSON files and JSON texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.catalog import IGNORED_ELEMENTS, Catalog
from chartloom.functions.exact import at_risk, marked, marked_where_needed, merged_sql, unmarked
from chartloom.operators.frames import explode_present

# Error codes.
READ_FAILED = "601"
SHAPE_FAILED = "602"


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per line with the file it came from."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("path"))


def scan_documents(lines: DataFrame, resource: str, catalog: Catalog) -> DataFrame:
    """Parse lines and say per row whether it can be loaded.

    Blank lines are skipped. `error_code` is null for good rows, 601 for text that is not
    JSON and 602 for a value of the wrong shape, an unknown element or a missing id.
    """
    known = [e.name for e in catalog.elements(resource)] + list(IGNORED_ELEMENTS)
    schema = catalog.struct_type(resource).add("_corrupt", T.StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    doc = F.from_json("value", schema, options)
    texts = catalog.json_texts(resource)
    exact = F.when(at_risk(F.col("value")), F.from_json(marked(F.col("value")), texts))
    keys = F.filter(F.json_object_keys("value"), lambda k: ~k.startswith("_"))
    unknown = F.array_except(keys, F.array(*[F.lit(k) for k in known]))
    # A generator of one row, as in `parse_documents`: no filter on it parses again.
    scanned = F.struct(doc.alias("doc"), unknown.alias("unknown_elements"), exact.alias("_exact"))
    rows = lines.where(F.col("value").rlike(r"\S")).select(*lines.columns, F.inline(F.array(scanned)))
    code = F.when(
        F.col("doc._corrupt").isNotNull(),
        F.when(F.try_parse_json("value").isNull(), READ_FAILED).otherwise(SHAPE_FAILED),
    ).when(
        (F.size("unknown_elements") > 0) | F.col("doc.id").isNull(),
        SHAPE_FAILED,
    )
    columns = []
    for field in schema.fields:
        value = f"doc.`{field.name}`"
        if field.name in texts.fieldNames():
            found = merged_sql(texts[field.name].dataType, value, f"_exact.`{field.name}`", field.dataType)
            value = f"if(_exact IS NULL, {value}, {found})"
        columns.append(f"'{field.name}', {value}")
    whole = F.expr(f"named_struct({', '.join(columns)})")
    return rows.withColumns({"error_code": code, "doc": whole}).drop("_exact")


def good_documents(scanned: DataFrame) -> DataFrame:
    return scanned.where(F.col("error_code").isNull()).select("doc.*").drop("_corrupt")


def rejected_lines(scanned: DataFrame) -> DataFrame:
    return scanned.where(F.col("error_code").isNotNull()).drop("doc")


def batch_documents(texts: DataFrame) -> DataFrame:
    """Documents of batches given as a JSON list or as NDJSON text, in a `value` column; numbers as written."""
    items = F.when(
        F.ltrim("value").startswith("["),
        F.from_json(marked_where_needed(F.col("value")), "array<string>"),
    ).otherwise(F.split("value", r"\r?\n"))
    rows = explode_present(texts.withColumn("value", items), "value", "document")
    rows = rows.withColumn("document", unmarked(F.col("document")))
    return rows.where(F.col("document").rlike(r"\S"))
