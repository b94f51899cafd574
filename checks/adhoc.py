"""Ad-hoc SQL on the produced tables."""

from pyspark.sql import functions as F

from chartloom.plans import adhoc
from chartloom.sources.shaped import documents, table
from checks.base import CATALOG, check


def views(spark, sf_dir, **elements):
    """Views of the named resource types, with the elements the query at hand needs."""
    docs = {resource: documents(spark, sf_dir, resource) for resource in elements}
    adhoc.register_views(spark, docs, CATALOG, elements)


@check(
    "sql_patient_demographics",
    """
    SELECT 'pat-' || c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
           c_name || CASE WHEN c_custkey % 2 = 0 THEN ',-' ELSE '' END AS families
    FROM customer ORDER BY id LIMIT 5
    """,
)
def sql_patient_demographics(spark, sf_dir):
    views(spark, sf_dir, Patient=["gender", "birthDate", "name"])
    rows = spark.sql(adhoc.PATIENT_DEMOGRAPHICS.format(limit=5))
    return rows.select("id", "gender", F.array_join("name_family", ",", "-").alias("families"))


@check(
    "sql_observation_units",
    """
    SELECT 'obs-' || event_id AS id, CAST(n AS INTEGER) AS seq_no, event_type AS code_text,
           value AS valuequantity_value, 'u' || event_id % 3 AS valuequantity_unit
    FROM events, (SELECT unnest(range(2)) AS n) WHERE event_id % 10 <> 0
    """,
)
def sql_observation_units(spark, sf_dir):
    views(spark, sf_dir, Observation=["valueQuantity", "code"])
    rows = spark.sql(adhoc.OBSERVATION_UNITS)
    return rows.withColumn("valuequantity_value", F.col("valuequantity_value").cast("double"))


@check(
    "sql_condition_codes",
    """
    SELECT 'E' || event_id % 12 AS code, 'error ' || event_id % 12 AS text, count(*) AS n
    FROM events WHERE event_type = 'error' GROUP BY 1, 2 ORDER BY n DESC, code LIMIT 10
    """,
)
def sql_condition_codes(spark, sf_dir):
    views(spark, sf_dir, Condition=["code"])
    return spark.sql(adhoc.CONDITION_CODES.format(limit=10))


@check(
    "sql_obs_per_patient",
    """
    SELECT 'Patient/pat-' || user_id AS patient_ref, count(*) AS observation_count
    FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10
    """,
)
def sql_obs_per_patient(spark, sf_dir):
    views(spark, sf_dir, Observation=["subject"])
    return spark.sql(adhoc.OBSERVATIONS_PER_PATIENT.format(limit=10))


@check(
    "sql_table_count",
    """
    SELECT 'patient' AS table_name, count(*) AS n FROM customer
    UNION ALL SELECT 'encounter', count(*) FROM orders
    UNION ALL SELECT 'observation', count(*) FROM events
    UNION ALL SELECT 'condition', count(*) FROM events WHERE event_type = 'error'
    UNION ALL SELECT 'identifier', (SELECT count(*) + count(*) FILTER (c_custkey % 4 <> 0) FROM customer)
                                   + (SELECT count(*) FROM orders)
    """,
)
def sql_table_count(spark, sf_dir):
    kept = ["identifier"]
    views(spark, sf_dir, Patient=kept, Encounter=kept, Observation=[], Condition=[])
    names = ["patient", "encounter", "observation", "condition", "identifier"]
    counts = [f"SELECT '{name}' AS table_name, count(*) AS n FROM {name}" for name in names]
    return spark.sql(" UNION ALL ".join(counts))


@check(
    "sql_recent_properties",
    """
    SELECT 'property-' || o_orderkey AS property, o_orderdate AS updated_date
    FROM orders ORDER BY o_orderdate DESC, property LIMIT 10
    """,
)
def sql_recent_properties(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").selectExpr(
        "concat('property-', o_orderkey) AS property", "o_orderdate AS updated_date"
    )
    rows.createOrReplaceTempView("properties")
    return spark.sql(adhoc.RECENT_PROPERTIES.format(limit=10))


@check(
    "sql_latest_success",
    """
    SELECT 'backup-' || event_id AS folder_name, CAST(event_id % 100 AS INTEGER) AS total_files,
           ts AS backup_timestamp, 'host-' || user_id AS hostname
    FROM events WHERE event_type <> 'error' ORDER BY ts DESC, event_id DESC LIMIT 1
    """,
)
def sql_latest_success(spark, sf_dir):
    log = table(spark, sf_dir, "events").selectExpr(
        "concat('backup-', event_id) AS folder_name",
        "int(event_id % 100) AS total_files",
        "ts AS backup_timestamp",
        "concat('host-', user_id) AS hostname",
        "if(event_type = 'error', 'FAILED', 'SUCCESS') AS status",
    )
    log.createOrReplaceTempView("run_log")
    return spark.sql(adhoc.LATEST_SUCCESS)


@check(
    "manifest_missing",
    """
    SELECT 'store/' || l_orderkey || '/' || l_linenumber AS path, count(*) AS expected
    FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
    GROUP BY 1
    """,
)
def manifest_missing(spark, sf_dir):
    expected = table(spark, sf_dir, "lineitem").selectExpr(
        "concat('store/', l_orderkey, '/', l_linenumber) AS path", "l_quantity AS size"
    )
    present = (
        table(spark, sf_dir, "orders")
        .where("o_orderstatus = 'F'")
        .selectExpr("explode(sequence(1, 7)) AS n", "o_orderkey")
        .selectExpr("concat('backup/store/', o_orderkey, '/', n) AS name")
    )
    missing = adhoc.manifest_missing(expected, present, "backup/")
    return missing.groupBy("path").agg(F.count(F.lit(1)).alias("expected"))
