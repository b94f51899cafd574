"""Streaming jobs, drained and compared with what a batch would give."""

from pyspark.sql import functions as F

from chartloom.operators.published import TableSet
from chartloom.plans.ingest import Ingest
from chartloom.session import work_dir
from chartloom.sources.shaped import documents
from chartloom.streaming import jobs
from checks.base import AS_OF, CATALOG, PATIENT_VERSION, check, uuid5_sql


def patient_run(spark, work):
    tables = TableSet(spark, f"{work}/tables", buckets=8)
    return Ingest("Patient", CATALOG, tables, f"{work}/runs", AS_OF)


@check(
    "stream_ingest",
    """
    -- Every patient comes twice: first as version 1, then as its real version. One without
    -- a version counts as version 0, which is new each time.
    SELECT 'pat-' || c_custkey AS id,
           CASE WHEN c_custkey % 50 <> 0 THEN CAST(1 + c_custkey % 3 AS VARCHAR) END AS meta_versionid,
           CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
           CASE WHEN c_custkey % 50 <> 0 AND c_custkey % 3 = 0 THEN 'first' ELSE 'second' END
             AS practitioner_row,
           CASE WHEN c_custkey % 50 = 0 THEN 'new' WHEN c_custkey % 3 = 0 THEN 'duplicate'
                ELSE 'update' END AS last_operation
    FROM customer
    """,
)
def stream_ingest(spark, sf_dir):
    work = work_dir(spark, "ingest")
    run = patient_run(spark, work)
    docs = documents(spark, sf_dir, "Patient")
    first = r"""replace(regexp_replace(value, '"versionId":"\\d+"', '"versionId":"1"'),
                '"display":"Dr ', '"type":"first","display":"Dr ') AS value"""
    for name, text in (("a", first), ("b", "value")):
        docs.selectExpr(text).write.mode("append").text(f"{work}/stage/{name}")
        lines = jobs.line_stream(spark, f"{work}/stage")
        jobs.ingest_stream(spark, lines, run, work)
    patients = run.read("patient")
    references = run.read("patient_reference").where(
        "field_name = 'generalpractitioner' AND seq_no = 0"
    )
    audit = spark.read.option("basePath", f"{work}/audit").parquet(f"{work}/audit")
    last = audit.groupBy(F.col("resource_id").alias("id")).agg(
        F.max_by("operation", "batch").alias("last_operation")
    )
    marked = references.select("id", F.coalesce("type", F.lit("second")).alias("practitioner_row"))
    wide = patients.select("id", "meta_versionid", "gender")
    return wide.join(marked, "id").join(last, "id")


def event_patients(of_type):
    """DuckDB text: users with an event of one of three types. Odd encounters exist nowhere."""
    return f"SELECT DISTINCT user_id AS k FROM events WHERE event_id % 13 {of_type}"


@check(
    "stream_events",
    f"""
    SELECT 'Patient' AS resource_type, 'pat-' || c_custkey AS id, 'new' AS outcome,
           {uuid5_sql(f"('pat-' || c_custkey || {PATIENT_VERSION})")} AS filepath_id, NULL AS delay_minutes
    FROM customer JOIN ({event_patients("NOT IN (0, 1, 2)")}) ON k = c_custkey
    UNION ALL
    SELECT 'Encounter', 'enc-' || o_orderkey, 'new', {uuid5_sql("('enc-' || o_orderkey || '1')")}, NULL
    FROM orders JOIN ({event_patients("IN (1, 2)")}) ON 2 * k = o_orderkey
    UNION ALL
    SELECT 'Patient', 'pat-' || k, 'event_queue', NULL, 5 FROM ({event_patients("NOT IN (0, 1, 2)")})
    WHERE k NOT IN (SELECT c_custkey FROM customer)
    UNION ALL
    SELECT 'Encounter', 'enc-' || 2 * k, 'event_queue', NULL, 5 FROM ({event_patients("IN (1, 2)")})
    WHERE 2 * k NOT IN (SELECT o_orderkey FROM orders)
    UNION ALL
    SELECT 'Group', 'pat-' || k, 'failure_area', NULL, NULL FROM ({event_patients("= 0")})
    """,
)
def stream_events(spark, sf_dir):
    work = work_dir(spark, "events")
    patients = patient_run(spark, work)
    encounters = Ingest("Encounter", CATALOG, patients.tables, f"{work}/runs-encounter", AS_OF)
    server = TableSet(spark, f"{work}/server", buckets=8)
    docs = {
        "Patient": documents(spark, sf_dir, "Patient", ("k",)).selectExpr("concat('pat-', k) AS id", "value"),
        "Encounter": documents(spark, sf_dir, "Encounter", ("k",)).selectExpr("concat('enc-', k) AS id", "value"),
    }
    jobs.serve(server, docs, 1)
    events = jobs.table_stream(spark, sf_dir, "events").selectExpr(
        """concat('host/fhir/', CASE WHEN event_id % 13 = 0 THEN concat('Group/pat-', user_id)
             WHEN event_id % 13 IN (1, 2) THEN concat('Encounter/enc-', 2 * user_id)
             ELSE concat('Patient/pat-', user_id) END) AS subject""",
        "'ResourceCreated' AS eventType",
    )
    jobs.event_stream(spark, events, server, [patients, encounters], work)
    audit = spark.read.option("recursiveFileLookup", "true").parquet(f"{work}/audit")
    loaded = patients.read("patient").select("id").union(encounters.read("encounter").select("id"))
    done = audit.join(loaded, F.col("resource_id") == F.col("id"), "left_semi").selectExpr(
        "resource_type", "resource_id AS id", "operation AS outcome", "filepath_id", "cast(null AS int) AS delay_minutes"
    )
    missed = spark.read.parquet(f"{work}/unfetched").selectExpr(
        "resource_type", "id", "disposition AS outcome", "cast(null AS string) AS filepath_id", "delay_minutes"
    )
    return done.unionByName(missed)


@check(
    "stream_audit_flush",
    """
    SELECT CASE WHEN event_id % 3 = 0 THEN 'audit' WHEN event_id % 2 = 0 THEN 'lineage_first'
                ELSE 'lineage_second' END AS route,
           count(*) AS messages, min(event_id) AS first_id, max(event_id) AS last_id
    FROM events GROUP BY 1
    """,
)
def stream_audit_flush(spark, sf_dir):
    work = work_dir(spark, "flush")
    messages = jobs.table_stream(spark, sf_dir, "events").selectExpr(
        "event_id",
        "if(event_id % 3 = 0, 'fhir_audit', 'fhir_lineage') AS table_name",
        "if(event_id % 2 = 0, 'batch-load-exporter', null) AS pipeline_type",
    )
    jobs.audit_flush_stream(messages, work, AS_OF)
    flushed = spark.read.parquet(f"{work}/flushed")
    return flushed.groupBy("route").agg(
        F.count(F.lit(1)).alias("messages"),
        F.min("event_id").alias("first_id"),
        F.max("event_id").alias("last_id"),
    )


@check(
    "stream_lineage_join",
    """
    SELECT 'file-' || o_orderkey AS filepath_id,
           CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderkey % 100 AS INTEGER) END AS record_count,
           CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 2 = 0 END AS is_inserted,
           CASE WHEN o_orderkey % 3 = 0 THEN '603' END AS error_code,
           CASE WHEN o_orderkey % 7 = 0 THEN 'waiting' WHEN o_orderkey % 3 <> 0 THEN 'open'
                ELSE 'complete' END AS state,
           CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS reschedule_count
    FROM orders WHERE o_orderkey % 7 <> 0 OR o_orderkey % 3 = 0
    """,
)
def stream_lineage_join(spark, sf_dir):
    work = work_dir(spark, "lineage")
    tables = TableSet(spark, f"{work}/tables", key="filepath_id", buckets=8)
    orders = jobs.table_stream(spark, sf_dir, "orders")
    # An order stands for a file. Its outcome is reported before the file itself.
    halves = orders.selectExpr(
        "o_orderkey",
        """explode(filter(array(
             if(o_orderkey % 3 = 0, 'second', null), if(o_orderkey % 7 <> 0, 'first', null)),
             h -> h is not null)) AS half""",
    )
    messages = halves.selectExpr(
        "concat('file-', o_orderkey) AS filepath_id",
        "o_orderkey * 2 + int(half = 'first') AS message_no",
        "if(half = 'first', int(o_orderkey % 100), null) AS record_count",
        "if(half = 'first', 'batch-load-exporter', null) AS pipeline_type",
        "if(half = 'second', o_orderkey % 2 = 0, null) AS is_inserted",
        "if(half = 'second', '603', null) AS error_code",
    )
    jobs.lineage_stream(messages, tables, work)
    state = jobs.rescheduled(tables.read("lineage", jobs.LINEAGE_STATE), 1)
    return state.select(
        "filepath_id", "record_count", "is_inserted", "error_code", jobs.lineage_state(), "reschedule_count"
    )


@check(
    "stream_redelivery",
    """
    SELECT event_id, batch AS delivered_by FROM (
      SELECT event_id, CASE WHEN due <= TIMESTAMP '2024-01-10' THEN 0 WHEN due <= TIMESTAMP '2024-01-20' THEN 1
                            WHEN due <= TIMESTAMP '2024-01-21' THEN 2 END AS batch
      FROM (SELECT event_id, ts + to_minutes(CAST(event_id % 4 * 1440 AS INTEGER)) AS due FROM events))
    """,
)
def stream_redelivery(spark, sf_dir):
    work = work_dir(spark, "redelivery")
    times = ("2024-01-10 00:00:00", "2024-01-20 00:00:00", "2024-01-21 00:00:00")
    # All messages come with the first run; the other two find nothing new and deliver by time.
    for _ in times:
        messages = jobs.table_stream(spark, sf_dir, "events").selectExpr(
            "event_id", "cast(ts AS timestamp) + make_dt_interval(int(event_id % 4)) AS not_before"
        )
        jobs.redelivery_stream(messages, work, lambda n: times[n], slot=86400)
    delivered = spark.read.option("basePath", f"{work}/delivered").parquet(f"{work}/delivered")
    by_batch = delivered.select("event_id", F.col("batch").alias("delivered_by"))
    waiting = jobs.redelivered(spark, work).where("state = 'waiting'")
    return by_batch.unionByName(waiting.select("event_id", F.lit(None).cast("int").alias("delivered_by")))


@check(
    "stream_latest_version",
    """
    SELECT 'user-' || user_id AS id, CAST(max(event_id % 50) AS INTEGER) AS meta_versionid,
           arg_max(event_id, (event_id % 50) * 1000000000 + event_id) AS payload
    FROM events GROUP BY user_id
    """,
)
def stream_latest_version(spark, sf_dir):
    work = work_dir(spark, "latest")
    tables = TableSet(spark, f"{work}/tables", buckets=8)
    versions = jobs.table_stream(spark, sf_dir, "events").selectExpr(
        "concat('user-', user_id) AS id",
        "int(event_id % 50) AS meta_versionid",
        "ts AS meta_lastupdated",
        "event_id AS payload",
    )
    jobs.latest_version_stream(versions, tables, "newest", versions.schema, work)
    return tables.read("newest", versions.schema).drop("meta_lastupdated")
