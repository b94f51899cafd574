"""Schema derivation over schema documents."""

from pyspark.sql import functions as F

from chartloom.operators import schema
from chartloom.sources.shaped import spread, table
from checks.base import AS_OF, CATALOG, check

# One definition per part. Its `kind` element takes a different type by part size.
KINDS = ["string", "dateTime", "positiveInt", "HumanName", "Reference", "Identifier", "Extension", "Coding"]
KIND_SQL = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"


def schema_documents(spark, sf_dir):
    kinds = ", ".join(f"'{k}'" for k in KINDS)
    ref = '"$ref":"#/definitions/'
    return spread(table(spark, sf_dir, "part"), "p_partkey").selectExpr(
        f"""concat('{{"definitions":{{"Part', p_partkey, '":{{"properties":{{',
          '"resourceType":{{"const":"x"}},',
          '"kind":{{{ref}', element_at(array({kinds}), int(1 + p_size % 8)), '"}},',
          '"kindList":{{"type":"array","items":{{{ref}',
              element_at(array({kinds}), int(1 + (p_size + p_partkey) % 8)), '"}}}},',
          '"status":{{"enum":["a","b"]}},"codes":{{"type":"array","items":{{"enum":["a"]}}}},',
          '"valueBoolean":{{"type":"boolean"}},"_valueBoolean":{{{ref}Element"}},',
          '"span":{{{ref}Period"}},',
          '"item":{{"type":"array","items":{{{ref}Part', p_partkey, '_Item"}}}}}}}}}}}}') AS value"""
    )


def elements(spark, sf_dir):
    return schema.element_catalog(schema_documents(spark, sf_dir))


ELEMENTS = f"""
    SELECT 'Part' || p_partkey AS resource, e.element, e.is_array,
           CASE e.element WHEN 'kind' THEN {KIND_SQL}[1 + p_size % 8]
             WHEN 'kindList' THEN {KIND_SQL}[1 + (p_size + p_partkey) % 8]
             WHEN 'valueBoolean' THEN 'boolean' WHEN 'span' THEN 'Period'
             WHEN 'item' THEN 'Part' || p_partkey || '_Item' ELSE 'enum' END AS fhir_type
    FROM part, (VALUES ('kind', false), ('kindList', true), ('status', false), ('codes', true),
                ('valueBoolean', false), ('span', false), ('item', true)) e(element, is_array)
"""
COLUMN_TYPE = """CASE {0} WHEN 'string' THEN 'STRING' WHEN 'enum' THEN 'STRING'
    WHEN 'dateTime' THEN 'DATETIME' WHEN 'positiveInt' THEN 'INTEGER' WHEN 'boolean' THEN 'BOOLEAN'
    ELSE 'JSON' END"""
CLASS = """CASE WHEN fhir_type IN ('string', 'dateTime', 'positiveInt', 'boolean', 'enum') THEN 'primitive'
    WHEN fhir_type = 'Coding' THEN 'codeableconcept' WHEN fhir_type = 'Reference' THEN 'reference'
    WHEN fhir_type = 'Identifier' THEN 'identifier' WHEN fhir_type = 'Extension' THEN 'extension'
    WHEN fhir_type LIKE 'Part%' THEN 'backbone' WHEN is_array THEN 'array_complex' ELSE 'complex' END"""


@check("element_catalog", f"SELECT resource, element, fhir_type, is_array FROM ({ELEMENTS})")
def element_catalog(spark, sf_dir):
    return elements(spark, sf_dir)


@check(
    "type_mapping",
    f"SELECT resource, element, {COLUMN_TYPE.format('fhir_type')} AS db_type FROM ({ELEMENTS})",
)
def type_mapping(spark, sf_dir):
    db_type = schema.column_type(F.col("fhir_type"))
    return elements(spark, sf_dir).select("resource", "element", db_type.alias("db_type"))


@check("classify_elements", f"SELECT resource, element, {CLASS} AS class FROM ({ELEMENTS})")
def classify_elements(spark, sf_dir):
    layout = schema.element_class(F.col("resource"), F.col("fhir_type"), F.col("is_array"))
    return elements(spark, sf_dir).select("resource", "element", layout.alias("class"))


# Columns of the two complex types that occur, when they do not repeat.
CHILDREN = """(VALUES ('HumanName', 'extension', 'JSON', 1), ('HumanName', 'use', 'STRING', 0),
    ('HumanName', 'text', 'STRING', 0), ('HumanName', 'family', 'STRING', 0),
    ('HumanName', 'given', 'STRING', 1), ('HumanName', 'prefix', 'STRING', 1),
    ('HumanName', 'suffix', 'STRING', 1), ('HumanName', 'period', 'JSON', 0),
    ('Period', 'extension', 'JSON', 1), ('Period', 'start', 'DATETIME', 0),
    ('Period', 'end', 'DATETIME', 0)) c(parent, child, base, depth)"""


@check(
    "flatten_plan",
    f"""
    WITH planned AS (
      SELECT resource, lower(element) AS column_name, {COLUMN_TYPE.format('fhir_type')} AS base,
             CAST(is_array AS INTEGER) AS depth
      FROM ({ELEMENTS}) WHERE {CLASS} IN ('primitive', 'extension', 'backbone')
      UNION ALL
      SELECT resource, lower(element) || '_' || child, base, depth + CAST(is_array AS INTEGER)
      FROM ({ELEMENTS}) JOIN {CHILDREN} ON parent = fhir_type)
    SELECT resource, column_name,
           CASE depth WHEN 0 THEN base
             WHEN 1 THEN 'ARRAY<' || replace(base, 'DATETIME', 'STRING') || '>'
             ELSE 'ARRAY<ARRAY<' || replace(base, 'DATETIME', 'STRING') || '>>' END AS column_type
    FROM planned
    """,
)
def flatten_plan(spark, sf_dir):
    return schema.flatten_plan(elements(spark, sf_dir), CATALOG.rows(spark, children=True))


@check(
    "shared_field_map",
    f"""
    SELECT resource, CASE fhir_type WHEN 'Coding' THEN 'codeableconcept' ELSE lower(fhir_type) END
             AS table_name, string_agg(lower(element), ',' ORDER BY lower(element)) AS fields
    FROM ({ELEMENTS}) WHERE fhir_type IN ('Coding', 'Reference', 'Identifier') GROUP BY 1, 2
    """,
)
def shared_field_map(spark, sf_dir):
    return schema.shared_field_map(elements(spark, sf_dir))


def history(spark, sf_dir):
    return table(spark, sf_dir, "part").where("p_partkey % 3 <> 0").selectExpr(
        "concat('table', p_partkey) AS table_name",
        "timestamp'2023-01-01' AS created_date",
        "'loader' AS created_by",
        "cast(null AS timestamp) AS updated_date",
        "p_size AS version",
        "'OLD' AS status",
        "p_name AS description",
    )


def history_changes(spark, sf_dir, key):
    return table(spark, sf_dir, "part").where("p_partkey % 2 = 0").selectExpr(
        f"concat('table', p_partkey) AS {key}",
        "'SUCCESS' AS status",
        "if(p_partkey % 4 = 0, '', 'changed') AS description",
    )


HISTORY = f"""
    SELECT 'table' || p_partkey AS name,
           CASE WHEN p_partkey % 3 <> 0 THEN TIMESTAMP '2023-01-01' ELSE TIMESTAMP '{AS_OF}' END
             AS created_date,
           CASE WHEN p_partkey % 3 <> 0 THEN 'loader' ELSE 'admin' END AS created_by,
           CASE WHEN p_partkey % 2 = 0 THEN TIMESTAMP '{AS_OF}' END AS updated_date,
           CAST(CASE WHEN p_partkey % 3 <> 0 THEN p_size ELSE 0 END
                + CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 0 END AS INTEGER) AS version,
           CASE WHEN p_partkey % 2 = 0 THEN 'SUCCESS' ELSE 'OLD' END AS status,
           CASE WHEN p_partkey % 4 = 2 THEN 'changed' WHEN p_partkey % 3 <> 0 THEN p_name END AS description
    FROM part WHERE p_partkey % 3 <> 0 OR p_partkey % 2 = 0
"""


@check("schema_history_upsert", HISTORY.replace("AS name", "AS table_name"))
def schema_history_upsert(spark, sf_dir):
    changes = history_changes(spark, sf_dir, "table_name")
    return schema.history_upsert(history(spark, sf_dir), changes, AS_OF, "admin")


@check("property_upsert", f"SELECT * EXCLUDE (name, version), name AS property FROM ({HISTORY})")
def property_upsert(spark, sf_dir):
    stored = history(spark, sf_dir).withColumnRenamed("table_name", "property").drop("version")
    changes = history_changes(spark, sf_dir, "property")
    return schema.property_upsert(stored, changes, AS_OF, "admin")
