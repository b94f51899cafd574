"""Audit and lineage messages."""

from pyspark.sql import functions as F

from chartloom.functions.keys import batch_file_id
from chartloom.operators import lineage
from chartloom.sources.shaped import table
from checks.base import AS_OF, check, uuid5_sql

URL = "concat('https://store/stage/', o_custkey, '/Encounter-', o_orderkey % 5, '.ndjson')"
URL_SQL = "('https://store/stage/' || o_custkey || '/Encounter-' || o_orderkey % 5 || '.ndjson')"


def staged(spark, sf_dir):
    """Orders as records of staged files; a file holds the orders of a customer by key."""
    rows = table(spark, sf_dir, "orders").selectExpr("*", f"{URL} AS destination_location")
    return rows.withColumns(
        {
            "filepath_id": batch_file_id(F.col("destination_location")),
            "resource_type": F.lit("Encounter"),
            "fhir_request_url": F.concat(F.lit("https://server/Encounter?page="), F.expr("o_orderkey % 5")),
            "file_no": F.expr("o_custkey * 5 + o_orderkey % 5"),
        }
    )


FILES = f"""
    SELECT DISTINCT o_custkey * 5 + o_orderkey % 5 AS file_no, {uuid5_sql("u")} AS filepath_id, u,
           'https://server/Encounter?page=' || o_orderkey % 5 AS request,
           count(*) OVER (PARTITION BY u) AS n
    FROM (SELECT *, {URL_SQL} AS u FROM orders)
"""
FIRST = f"""
    SELECT filepath_id, 'Encounter' AS resource_type, request AS fhir_request_url,
           CAST(n AS INTEGER) AS record_count, 'batch-load-exporter' AS pipeline_type,
           u AS destination_location, TIMESTAMP '{AS_OF}' AS created_date, file_no
    FROM ({FILES}) WHERE file_no % 7 <> 0
"""
SECOND = f"""
    SELECT CASE WHEN file_no % 11 = 0 THEN 'bad-' || file_no ELSE filepath_id END AS filepath_id,
           file_no % 2 = 0 AS is_inserted, CAST(file_no % 4 AS INTEGER) AS retry_count,
           CASE WHEN file_no % 2 = 1 THEN '603' END AS error_code,
           CASE WHEN file_no % 2 = 1 THEN '603/' || file_no END AS reject_location, file_no
    FROM ({FILES}) WHERE file_no % 3 = 0
"""
FIRST_NAMES = ", ".join(lineage.FIRST_HALF_COLUMNS)
OUTCOME_NAMES = ", ".join(lineage.OUTCOME_COLUMNS)


def first_half(spark, sf_dir):
    rows = staged(spark, sf_dir).where("file_no % 7 <> 0")
    return lineage.first_half(rows, "batch-load-exporter", AS_OF)


def second_half(spark, sf_dir):
    """Audit rows of every third file, some with a broken id, and the outcome of each."""
    audit = staged(spark, sf_dir).where("file_no % 3 = 0").withColumn(
        "filepath_id", F.expr("if(file_no % 11 = 0, concat('bad-', file_no), filepath_id)")
    )
    failed = F.col("file_no") % 2 == 1
    outcomes = lineage.with_outcome(
        audit.select("filepath_id", "file_no").distinct(),
        is_inserted=~failed,
        retry_count=F.expr("int(file_no % 4)"),
        error_code=F.when(failed, "603"),
        reject_location=F.when(failed, F.concat(F.lit("603/"), F.col("file_no").cast("string"))),
    )
    return lineage.second_half(audit, outcomes)


@check("lineage_first_half", f"SELECT {FIRST_NAMES} FROM ({FIRST})")
def lineage_first_half(spark, sf_dir):
    return first_half(spark, sf_dir)


@check("lineage_second_half", f"SELECT filepath_id, {OUTCOME_NAMES} FROM ({SECOND})")
def lineage_second_half(spark, sf_dir):
    return second_half(spark, sf_dir)


@check(
    "outcome_setters",
    """
    SELECT event_id, event_type <> 'error' AS is_inserted, CAST(event_id % 4 AS INTEGER) AS retry_count,
           '603' AS error_code, '603/' || user_id AS reject_location
    FROM events
    """,
)
def outcome_setters(spark, sf_dir):
    messages = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id")
    inserted = lineage.with_outcome(messages, is_inserted=F.col("event_type") != "error")
    return lineage.with_outcome(
        inserted,
        retry_count=F.expr("int(event_id % 4)"),
        error_code=F.lit("603"),
        reject_location=F.concat(F.lit("603/"), F.col("user_id").cast("string")),
    ).drop("event_type", "user_id")


@check(
    "merge_lineage",
    f"""
    SELECT {", ".join("f." + c for c in lineage.FIRST_HALF_COLUMNS)}, {OUTCOME_NAMES},
           TIMESTAMP '{AS_OF}' AS updated_date
    FROM ({FIRST}) f JOIN ({SECOND}) s ON s.filepath_id = f.filepath_id
    """,
)
def merge_lineage(spark, sf_dir):
    return lineage.merge_halves(first_half(spark, sf_dir), second_half(spark, sf_dir), AS_OF)


@check(
    "lineage_waiting",
    f"""
    SELECT filepath_id, CAST(1 + file_no % 12 AS INTEGER) AS reschedule_count,
           (1 + file_no % 12) % 10 = 0 AS is_warned
    FROM ({SECOND}) WHERE filepath_id NOT IN (SELECT filepath_id FROM ({FIRST}))
    """,
)
def lineage_waiting(spark, sf_dir):
    seconds = staged(spark, sf_dir).where("file_no % 3 = 0").selectExpr(
        "if(file_no % 11 = 0, concat('bad-', file_no), filepath_id) AS filepath_id",
        "int(nullif(file_no % 12, 0)) AS reschedule_count",
    )
    return lineage.waiting_halves(first_half(spark, sf_dir), seconds.distinct())


@check(
    "route_audit_message",
    """
    SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'audit' WHEN event_id % 2 = 0 THEN 'lineage_first'
                          ELSE 'lineage_second' END AS route
    FROM events
    """,
)
def route_audit_message(spark, sf_dir):
    messages = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "if(event_id % 3 = 0, 'fhir_audit', 'fhir_lineage') AS table_name",
        "if(event_id % 2 = 0, 'batch-load-exporter', null) AS pipeline_type",
    )
    return lineage.route(messages).select("event_id", "route")


@check(
    "property_lookup",
    "SELECT p_partkey, p_name AS description FROM part WHERE p_brand = 'Brand#7'",
)
def property_lookup(spark, sf_dir):
    rows = table(spark, sf_dir, "part").selectExpr(
        "p_partkey", "p_brand AS property", "p_name AS description"
    )
    return lineage.property_rows(rows, "property", "Brand#7").drop("property")
