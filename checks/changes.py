"""Change detection against the stored state."""

from pyspark.sql import functions as F

from chartloom.functions.keys import batch_file_id, event_file_id, is_uuid
from chartloom.operators import changes
from chartloom.operators.flatten import parse_documents
from chartloom.sources.shaped import documents, table
from checks.base import CATALOG, PATIENT_UPDATED, PATIENT_VERSION, STORED, check, uuid5_sql

BATCH_URL = "https://store/stage/batch-load/20240201T0000/Patient-"
MESSY_VERSION = """
    CASE c_custkey % 6 WHEN 0 THEN '"7"' WHEN 1 THEN '" 7 "' WHEN 2 THEN '"abc"' WHEN 3 THEN 'null'
      WHEN 4 THEN '"1.5"' ELSE concat('"', c_custkey, '"') END
"""


def stored_state(spark, sf_dir):
    return table(spark, sf_dir, "customer").where("c_custkey % 5 <> 0").selectExpr(
        "concat('pat-', c_custkey) AS id",
        "int(1 + c_custkey % 2) AS meta_versionid",
        "int(c_custkey % 4) AS codeableconcept_max_array_size",
        "int(c_custkey % 3) AS reference_max_array_size",
        "int(c_custkey % 2) AS identifier_max_array_size",
    )


def incoming(spark, sf_dir, url):
    """Versions of all patient documents, with the file each came in."""
    lines = documents(spark, sf_dir, "Patient", ("k",)).withColumn("url", F.expr(url))
    parsed = parse_documents(lines.drop("k"), "Patient", CATALOG, ["meta", "identifier"])
    versions = changes.file_ids(changes.incoming_versions(parsed, "default"))
    return versions.withColumns(
        {"resource_type": F.lit("Patient"), "pipeline_type": F.lit("core-data-ingester")}
    )


def classified(spark, sf_dir):
    rows = incoming(spark, sf_dir, f"concat('{BATCH_URL}', k div 1000, '.ndjson')")
    return changes.classify(changes.with_stored(rows, stored_state(spark, sf_dir)))


# Patients with the stored version and the operation that follows from it.
CLASSIFIED = f"""
    SELECT c.id, c.v AS meta_versionid, c.u AS meta_lastupdated, c.source, c.k, s.*,
           CASE WHEN s.meta_versionid IS NULL THEN 'new' WHEN s.meta_versionid >= c.v THEN 'duplicate'
                ELSE 'update' END AS operation
    FROM (SELECT 'pat-' || c_custkey AS id, CAST({PATIENT_VERSION} AS BIGINT) AS v,
                 {PATIENT_UPDATED} AS u, c_custkey AS k,
                 CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment ELSE 'default' END AS source
          FROM customer) c
    LEFT JOIN ({STORED.replace("AS id,", "AS stored_id,")}) s ON s.stored_id = c.id
"""


@check(
    "extract_version_id",
    """
    SELECT 'pat-' || c_custkey AS id,
           CAST(CASE c_custkey % 6 WHEN 0 THEN 7 WHEN 1 THEN 7 WHEN 5 THEN c_custkey ELSE 0 END
                AS BIGINT) AS meta_versionid
    FROM customer
    """,
)
def extract_version_id(spark, sf_dir):
    text = f"""concat('{{"id":"pat-', c_custkey, '","meta":{{"versionId":', {MESSY_VERSION}, '}}}}')"""
    lines = table(spark, sf_dir, "customer").selectExpr(f"{text} AS value")
    parsed = parse_documents(lines, "Patient", CATALOG, ["meta"])
    return parsed.select("id", changes.version_id(F.col("meta.versionId")).alias("meta_versionid"))


@check(
    "extract_last_updated",
    """
    SELECT 'obs-' || event_id AS id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS meta_lastupdated FROM events
    UNION ALL SELECT 'cond-' || event_id, NULL FROM events WHERE event_type = 'error'
    """,
)
def extract_last_updated(spark, sf_dir):
    parts = []
    for resource in ("Observation", "Condition"):
        parsed = parse_documents(documents(spark, sf_dir, resource), resource, CATALOG, ["meta"])
        parts.append(parsed.select("id", F.col("meta.lastUpdated").alias("meta_lastupdated")))
    return parts[0].unionByName(parts[1])


@check(
    "identifier_source",
    """
    SELECT 'pat-' || c_custkey AS id,
           CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment ELSE 'default' END AS meta_source
    FROM customer
    """,
)
def identifier_source(spark, sf_dir):
    parsed = parse_documents(documents(spark, sf_dir, "Patient"), "Patient", CATALOG, ["identifier"])
    source = changes.identifier_source(F.col("identifier"), "default")
    return parsed.select("id", source.alias("meta_source"))


@check(
    "state_lookup",
    f"""
    SELECT id, meta_versionid_1 AS meta_versionid_db,
           codeableconcept_max_array_size AS codeableconcept_max_array_size_db,
           reference_max_array_size AS reference_max_array_size_db,
           identifier_max_array_size AS identifier_max_array_size_db
    FROM (SELECT c.id, s.meta_versionid AS meta_versionid_1, s.* EXCLUDE (meta_versionid)
          FROM ({CLASSIFIED}) c LEFT JOIN ({STORED.replace("AS id,", "AS stored,")}) s ON s.stored = c.id)
    """,
)
def state_lookup(spark, sf_dir):
    joined = classified(spark, sf_dir)
    return joined.select("id", "meta_versionid_db", *[f"{c}_db" for c in changes.SIZE_COLUMNS])


@check("classify_change", f"SELECT id, meta_versionid, operation FROM ({CLASSIFIED})")
def classify_change(spark, sf_dir):
    return classified(spark, sf_dir).select("id", "meta_versionid", "operation")


@check(
    "classify_event_change",
    f"""
    SELECT id, meta_versionid, CASE WHEN meta_versionid = 1 THEN 'new' ELSE operation END AS operation,
           {uuid5_sql("(id || meta_versionid)")} AS filepath_id
    FROM ({CLASSIFIED})
    """,
)
def classify_event_change(spark, sf_dir):
    rows = incoming(spark, sf_dir, "concat('https://store/stage/event-load/pat-', k, '/Patient-1.ndjson')")
    joined = changes.with_stored(rows, stored_state(spark, sf_dir))
    return changes.classify_by_file(joined).select("id", "meta_versionid", "operation", "filepath_id")


@check(
    "drop_duplicates_unchanged",
    f"SELECT id, operation FROM ({CLASSIFIED}) WHERE operation <> 'duplicate'",
)
def drop_duplicates_unchanged(spark, sf_dir):
    return changes.changed_rows(classified(spark, sf_dir)).select("id", "operation")


@check(
    "array_counts",
    f"""
    SELECT id, codeableconcept_max_array_size AS codeableconcept_max_array_size_db,
           reference_max_array_size AS reference_max_array_size_db,
           identifier_max_array_size AS identifier_max_array_size_db
    FROM ({CLASSIFIED}) WHERE operation = 'update'
    """,
)
def array_counts(spark, sf_dir):
    return changes.stored_sizes(classified(spark, sf_dir))


FILE_ID = uuid5_sql(f"('{BATCH_URL}' || k // 1000 || '.ndjson')")


@check(
    "audit_rows",
    f"""
    SELECT id AS resource_id, operation, meta_versionid, meta_lastupdated, source AS meta_source,
           'Patient' AS resource_type, {FILE_ID} AS filepath_id, 'core-data-ingester' AS pipeline_type
    FROM ({CLASSIFIED})
    """,
)
def audit_rows(spark, sf_dir):
    return changes.audit_rows(classified(spark, sf_dir))


@check(
    "batch_file_id",
    f"""
    SELECT o_orderkey, {uuid5_sql("('https://store/stage/' || o_orderkey || '/Encounter-1.ndjson')")}
             AS filepath_id
    FROM orders
    """,
)
def batch_file_ids(spark, sf_dir):
    url = "concat('https://store/stage/', o_orderkey, '/Encounter-1.ndjson')"
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", batch_file_id(F.expr(url)).alias("filepath_id")
    )


@check(
    "event_file_id",
    f"""
    SELECT event_id, {uuid5_sql("('obs-' || event_id || (1 + event_id % 4))")} AS filepath_id FROM events
    """,
)
def event_file_ids(spark, sf_dir):
    file_id = event_file_id(F.expr("concat('obs-', event_id)"), F.expr("1 + event_id % 4"))
    return table(spark, sf_dir, "events").select("event_id", file_id.alias("filepath_id"))


@check(
    "valid_uuid",
    "SELECT o_orderkey FROM orders WHERE o_orderkey % 5 IN (0, 1)",
)
def valid_uuid(spark, sf_dir):
    url = F.expr("concat('https://store/', o_orderkey)")
    ids = table(spark, sf_dir, "orders").withColumn("file_id", batch_file_id(url))
    messy = ids.withColumn(
        "file_id",
        F.expr(
            """CASE o_orderkey % 5 WHEN 0 THEN file_id WHEN 1 THEN upper(file_id)
               WHEN 2 THEN replace(file_id, '-', '') WHEN 3 THEN null
               ELSE concat(file_id, ' OR 1=1') END"""
        ),
    )
    return messy.where(is_uuid(F.col("file_id"))).select("o_orderkey")


@check(
    "valid_resource_type",
    """
    SELECT p_partkey, p_partkey % 4 IN (0, 3) AS is_valid FROM part
    """,
)
def valid_resource_type(spark, sf_dir):
    name = F.expr(
        """CASE p_partkey % 4 WHEN 0 THEN concat('Part', p_size) WHEN 1 THEN concat(p_size, 'Part')
           WHEN 2 THEN 'patient; drop table x' ELSE 'care_team' END"""
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", changes.is_resource_type(name).alias("is_valid")
    )
