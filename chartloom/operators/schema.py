"""Schema derivation over tables of schema documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.catalog import IGNORED_ELEMENTS, PRIMITIVE_COLUMN_TYPES

PROPERTY = "struct<`$ref`:string,items:struct<`$ref`:string,enum:array<string>>,enum:array<string>,type:string>"
DEFINITIONS = f"definitions map<string,struct<properties:map<string,{PROPERTY}>>>"

CODED = ("CodeableConcept", "Coding")
SHARED = ("CodeableConcept", "Coding", "Reference", "Identifier")


def element_catalog(documents: DataFrame) -> DataFrame:
    """Rows (resource, element, fhir_type, is_array) from JSON-schema texts in `value`."""
    parsed = documents.select(F.from_json("value", DEFINITIONS)["definitions"].alias("definitions"))
    # The outer form keeps the optimizer from parsing again for a size check.
    definitions = parsed.select(F.explode_outer("definitions").alias("resource", "definition"))
    elements = definitions.select(
        "resource", F.explode_outer("definition.properties").alias("element", "spec")
    ).where(~F.col("element").isin(*IGNORED_ELEMENTS) & ~F.col("element").startswith("_"))
    target = F.coalesce(F.col("spec.$ref"), F.col("spec.items.$ref"))
    enum = F.col("spec.enum").isNotNull() | F.col("spec.items.enum").isNotNull()
    fhir_type = (
        F.when(target.isNotNull(), F.substring_index(target, "/", -1))
        .when(enum, "enum")
        .otherwise(F.coalesce("spec.type", F.lit("string")))
    )
    # A bare `type` is never a list here: lists always name their items.
    is_list = (F.col("spec.type") == "array") & (target.isNotNull() | enum)
    return elements.select(
        "resource", "element", fhir_type.alias("fhir_type"), F.coalesce(is_list, F.lit(False)).alias("is_array")
    )


def column_type(fhir_type: Column) -> Column:
    """Column type of a FHIR type; every other type is kept as JSON."""
    known = F.create_map(*[F.lit(x) for pair in PRIMITIVE_COLUMN_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, fhir_type), F.lit("JSON"))


def element_class(resource: Column, fhir_type: Column, is_array: Column) -> Column:
    """Layout class of an element."""
    is_complex = F.substring(fhir_type, 1, 1).rlike("[A-Z]")
    return (
        F.when(fhir_type.startswith(F.concat(resource, F.lit("_"))), "backbone")
        .when(~is_complex, "primitive")
        .when(fhir_type.isin(*CODED), "codeableconcept")
        .when(fhir_type == "Reference", "reference")
        .when(fhir_type == "Identifier", "identifier")
        .when(fhir_type == "Extension", "extension")
        .when(is_array, "array_complex")
        .otherwise("complex")
    )


def nested_type(base: Column, *repeats: Column) -> Column:
    """The base type wrapped in ARRAY<> once per repeating level."""
    wrapped = base
    for level in repeats:
        # Dates inside arrays stay text.
        inner = F.when(wrapped == "DATETIME", "STRING").otherwise(wrapped)
        wrapped = F.when(level, F.concat(F.lit("ARRAY<"), inner, F.lit(">"))).otherwise(wrapped)
    return wrapped


def flatten_plan(elements: DataFrame, children: DataFrame) -> DataFrame:
    """Target columns (resource, column_name, column_type) of catalogued elements.

    `children` holds the first-level children of data types and backbones, in the same
    layout as `elements` with the type's name in `resource`.
    """
    classed = elements.withColumn(
        "class", element_class(F.col("resource"), F.col("fhir_type"), F.col("is_array"))
    )
    whole = F.col("class").isin("primitive", "extension") | (
        (F.col("class") == "backbone") & F.col("is_array")
    )
    base = F.when(F.col("class") == "primitive", column_type(F.col("fhir_type"))).otherwise("JSON")
    own = classed.where(whole).select(
        "resource",
        F.lower("element").alias("column_name"),
        nested_type(base, F.col("is_array")).alias("column_type"),
    )
    split = classed.where(~whole & F.col("class").isin("complex", "array_complex", "backbone"))
    parts = children.select(
        F.col("resource").alias("fhir_type"),
        F.col("element").alias("child"),
        column_type(F.col("fhir_type")).alias("child_type"),
        F.col("is_array").alias("child_is_array"),
        F.col("fhir_type").rlike("^[A-Z][A-Za-z]*$").alias("child_is_datatype"),
    )
    # Inside a backbone a complex value is one JSON column, also when it repeats.
    whole_json = (F.col("class") == "backbone") & F.col("child_is_datatype")
    child_repeats = F.col("child_is_array") & ~whole_json
    child_columns = split.join(parts, "fhir_type").select(
        "resource",
        F.lower(F.concat_ws("_", "element", "child")).alias("column_name"),
        nested_type(F.col("child_type"), child_repeats, F.col("is_array")).alias("column_type"),
    )
    return own.unionByName(child_columns)


def shared_field_map(elements: DataFrame) -> DataFrame:
    """Fields of every resource that live in a shared table, as a sorted list."""
    table = F.when(F.col("fhir_type").isin(*CODED), "codeableconcept").otherwise(
        F.lower("fhir_type")
    )
    return (
        elements.where(F.col("fhir_type").isin(*SHARED))
        .groupBy("resource", table.alias("table_name"))
        .agg(F.array_join(F.sort_array(F.collect_set(F.lower("element"))), ",").alias("fields"))
    )


def history_upsert(history: DataFrame, changes: DataFrame, as_of: str, user: str) -> DataFrame:
    """Schema history after changes: versions go up, creation facts stay."""
    return _upsert(history, changes, "table_name", as_of, user).withColumn(
        "version",
        F.when(F.col("is_changed"), F.coalesce("version", F.lit(0)) + 1).otherwise(F.col("version")),
    ).drop("is_changed")


def property_upsert(properties: DataFrame, changes: DataFrame, as_of: str, user: str) -> DataFrame:
    """The same for key-value properties, which have no version."""
    return _upsert(properties, changes, "property", as_of, user).drop("is_changed")


def _upsert(
    stored: DataFrame, changes: DataFrame, key: str, as_of: str, user: str
) -> DataFrame:
    moment = F.lit(as_of).cast("timestamp")
    fresh = changes.select(
        key,
        F.col("status").alias("new_status"),
        F.nullif("description", F.lit("")).alias("new_description"),
        F.lit(True).alias("changed"),
    )
    changed = F.coalesce("changed", F.lit(False))
    values = {
        "status": F.coalesce("new_status", "status"),
        "description": F.coalesce("new_description", "description"),
        "created_date": F.when(changed, F.coalesce("created_date", moment)).otherwise(
            F.col("created_date")
        ),
        "created_by": F.when(changed, F.coalesce("created_by", F.lit(user))).otherwise(
            F.col("created_by")
        ),
        "updated_date": F.when(changed, moment).otherwise(F.col("updated_date")),
    }
    joined = stored.join(fresh, key, "full_outer")
    return joined.select(
        *[values.get(c, F.col(c)).alias(c) for c in stored.columns], changed.alias("is_changed")
    )
