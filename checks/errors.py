"""Failure routing and retries."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.operators import errors, lineage
from chartloom.operators.published import TableSet
from chartloom.plans.ingest import Ingest
from chartloom.plans.reported import reported_ingest
from chartloom.session import work_dir
from chartloom.sources.shaped import documents, table
from checks.base import AS_OF, CATALOG, check
from checks.sources import DIRTY

MAX_RETRIES, DELAY = 3, 5


@check(
    "pull_error_disposition",
    f"""
    SELECT event_id, disposition,
           CASE WHEN disposition <> 'retry_queue' THEN CAST(event_id % 4 + 1 AS INTEGER) END AS retry_count,
           CASE disposition WHEN 'retry_queue' THEN true WHEN 'failure_area' THEN NULL
                ELSE CASE WHEN event_id % 5 = 0 THEN false END END AS retry_message,
           CASE WHEN event_id % 2 = 0 THEN 'event-load-exporter' ELSE 'batch-load-exporter' END
             AS application_name,
           CASE WHEN disposition = 'event_queue' THEN {DELAY} END AS delay_minutes
    FROM (SELECT *, CASE WHEN event_id % 7 = 0 THEN 'failure_area'
                         WHEN event_id % 4 = 2 THEN 'retry_queue'
                         WHEN event_id % 2 = 0 THEN 'event_queue' ELSE 'parameter_queue' END AS disposition
          FROM events)
    """,
)
def pull_error_disposition(spark, sf_dir):
    messages = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "nullif(int(event_id % 4), 0) AS retry_count",
        "CASE WHEN event_id % 7 = 0 THEN true WHEN event_id % 5 = 0 THEN false END AS retry_message",
        "if(event_id % 2 = 0, 'event-load-exporter', 'batch-load-exporter') AS application_name",
    )
    return errors.pull_disposition(messages, MAX_RETRIES, DELAY)


@check(
    "read_error_disposition",
    """
    SELECT event_id, 'file-' || event_id AS filepath_id, CAST(event_id % 4 + 1 AS INTEGER) AS retry_count,
           CASE WHEN event_id % 4 >= 2 THEN 'failure_area' ELSE 'requeue' END AS disposition,
           CASE WHEN event_id % 4 >= 2 THEN '601' END AS error_code
    FROM events
    """,
)
def read_error_disposition(spark, sf_dir):
    messages = table(spark, sf_dir, "events").selectExpr(
        "event_id", "concat('file-', event_id) AS filepath_id", "string(event_id % 4) AS retry_count"
    )
    return errors.read_disposition(messages, MAX_RETRIES)


@check(
    "failure_path",
    """
    SELECT event_id, CASE event_id % 4
             WHEN 0 THEN '404/' || strftime(ts, '%Y%m%dT%H%M%S') || '/pat-' || user_id || '.json'
             WHEN 1 THEN '404/' || strftime(ts, '%Y%m%dT%H%M%S') || '/Patient-'
                         || CASE WHEN event_id % 8 = 1 THEN 0 ELSE event_id % 9 END || '.json'
             WHEN 2 THEN '404/' || user_id || '/Patient-1.ndjson'
             ELSE '404/plain' END AS failure_path
    FROM events
    """,
)
def failure_path(spark, sf_dir):
    messages = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "'404' AS error_code",
        "if(event_id % 4 = 0, 'event-load-exporter', 'batch-load-exporter') AS application_name",
        """date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'") AS event_time""",
        "concat('pat-', user_id) AS resource_id",
        """if(event_id % 4 = 1, date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), null) AS end_time""",
        "'Patient' AS resource_type",
        "int(if(event_id % 8 = 1, null, event_id % 9)) AS page_number",
        """if(event_id % 4 = 2, concat('https://store/stage_', user_id, '/Patient-1.ndjson'), 'plain')
           AS url""",
    )
    return errors.failure_path(messages).select("event_id", "failure_path")


@check(
    "strip_error_prefix",
    """
    SELECT event_id, '602/' || CASE event_id % 3 WHEN 2 THEN '6021/' ELSE '' END
                     || 'event-load/pat-' || user_id || '/Patient-1.ndjson' AS reject_location
    FROM events
    """,
)
def strip_error_prefix(spark, sf_dir):
    paths = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        """concat('https://store/failure/', element_at(array('', '601/', '6021/'), int(event_id % 3) + 1),
                  'event-load/pat-', user_id, '/Patient-1.ndjson') AS url""",
    )
    location = errors.reject_location(F.lit("602"), F.col("url"))
    return paths.select("event_id", location.alias("reject_location"))


@check(
    "retry_eligible",
    """
    SELECT event_id FROM events WHERE event_id % 4 IN (1, 2) AND event_id % 3 = 1 AND event_id % 11 <> 0
    """,
)
def retry_eligible(spark, sf_dir):
    messages = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "element_at(array('601', '602', '603', '699'), int(event_id % 4) + 1) AS error_code",
        """if(event_id % 11 = 0, null, concat('https://store/602/batch-load/2024-01-01/',
           element_at(array('Patient', 'Patient-1', 'Patient-1-2'), int(event_id % 3) + 1), '.ndjson'))
           AS url""",
    )
    return errors.retry_eligible(messages).select("event_id")


@check(
    "retry_split",
    """
    SELECT event_id, 'file-' || user_id AS filepath_id,
           'Observation-3-' || n || '.ndjson' AS record_file,
           'https://store/stage/batch-load/' || user_id || '/Observation-3-' || n || '.ndjson' AS record_url
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events)
    """,
)
def retry_split(spark, sf_dir):
    records = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "concat('file-', user_id) AS filepath_id",
        "concat('https://store/602/batch-load/', user_id, '/Observation-3.ndjson') AS url",
    )
    split = errors.retry_split(records, "event_id", "https://store/stage")
    return split.select("event_id", "filepath_id", "record_file", "record_url")


# Customers in three batches: one is loaded, one fails while its tables are written, one before it is classified.
REPORTED = """
    SELECT c_custkey AS k, c_custkey % 3 AS batch, 1 + c_custkey // 1000 AS page,
           CASE WHEN c_custkey % 3 = 2 THEN '699' WHEN c_custkey % 100 = 1 THEN '601'
                WHEN c_custkey % 100 IN (3, 4) THEN '602' WHEN c_custkey % 3 = 1 THEN '603' END AS code
    FROM customer WHERE c_custkey % 100 <> 2
"""


def reported(spark, sf_dir, rejects):
    """Reports of the three batches."""
    work = work_dir(spark, "reported")
    lines = documents(spark, sf_dir, "Patient", ("k",)).selectExpr(
        "k", DIRTY, "concat('https://h/c/batch-load/', k % 3, '/Patient-', 1 + k div 1000, '.ndjson') AS url"
    )
    spark.range(1).selectExpr("'a file where a folder should be'").write.text(f"{work}/file")
    blocked = spark.read.text(f"{work}/file").inputFiles()[0]
    spark.range(1).selectExpr("'no list of buckets'").write.text(f"{work}/broken/published/patient/batch_no=1")
    for batch, path in enumerate((f"{work}/tables", blocked, f"{work}/broken")):
        run = Ingest("Patient", CATALOG, TableSet(spark, path, buckets=8), f"{work}/runs-{batch}", AS_OF)
        part = lines.where(F.col("k") % 3 == batch).drop("k")
        yield reported_ingest(spark, part, run, 2, f"{rejects}/{batch}")


@check(
    "error_codes",
    f"""
    SELECT 'https://h/c/batch-load/' || batch || '/Patient-' || page || '.ndjson' AS fhir_request_url,
           CAST(count(*) AS INTEGER) AS record_count, max(code) AS error_code, count(code) = 0 AS is_inserted,
           max(code) || '/batch-load/' || batch || '/Patient-' || page || '.ndjson' AS reject_location
    FROM ({REPORTED}) GROUP BY batch, page
    """,
)
def error_codes(spark, sf_dir):
    halves = [
        lineage.merge_halves(report.first, report.second, AS_OF)
        for report in reported(spark, sf_dir, work_dir(spark, "rejects"))
    ]
    return reduce(DataFrame.unionByName, halves).select(
        "fhir_request_url", "record_count", "error_code", "is_inserted", "reject_location"
    )


@check(
    "reject_sink",
    f"""
    SELECT code AS error_code, count(*) AS failed, count(DISTINCT (batch, page)) AS files,
           count(*) AS counted
    FROM ({REPORTED}) WHERE code IS NOT NULL GROUP BY code
    """,
)
def reject_sink(spark, sf_dir):
    folder = work_dir(spark, "rejects")
    counts = [report.counts for report in reported(spark, sf_dir, folder)]
    counted = F.create_map(*[
        F.lit(x) for code in (errors.READ_FAILED, errors.SHAPE_FAILED, errors.INSERT_FAILED, errors.UNEXPECTED)
        for x in (code, sum(found.get(code, 0) for found in counts))
    ])
    schema = "url string, filepath_id string, value string"
    back = reduce(DataFrame.unionByName, [
        spark.read.schema(f"{schema}, error_code string").parquet(f"{folder}/{batch}/job=2") for batch in range(3)
    ])
    return back.groupBy("error_code").agg(
        F.count(F.lit(1)).alias("failed"),
        F.countDistinct("filepath_id").alias("files"),
        F.max(counted[F.col("error_code")].cast("long")).alias("counted"),
    )
