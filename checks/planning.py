"""Sync windows and tasks."""

from pyspark.sql import functions as F

from chartloom.operators.flatten import parse_documents
from chartloom.plans import windows
from chartloom.sources import bundles
from chartloom.sources.shaped import documents, table
from checks.base import AS_OF, CATALOG, check

INTERVAL, MULTIPLIER, MAX_CYCLES = 15, 4, 5
TYPES = ["Patient", " Observation", "Encounter"]
TYPE_ROWS = "(SELECT unnest(['Patient', 'Observation', 'Encounter']) AS resource_type)"


def schedules(spark, sf_dir):
    """A sync state per order: lag from 0 to 16 hours, end before, inside or after it."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_orderdate AS last",
        "timestamp_seconds(unix_timestamp(o_orderdate) + (o_orderkey % 1000) * 60 + 30) AS now",
        "timestamp_seconds(unix_timestamp(o_orderdate) + (o_orderkey % 7) * 6000) AS end",
    )


def due(spark, sf_dir):
    return windows.plan_windows(schedules(spark, sf_dir), INTERVAL, MULTIPLIER, MAX_CYCLES)


# Minutes of lag rounded to the interval decide the number and the length of windows.
WINDOWS = f"""
    SELECT o_orderkey, CAST(n AS INTEGER) AS cycle,
           last + to_minutes(CAST(n * step AS INTEGER)) AS window_start,
           least(last + to_minutes(CAST((n + 1) * step AS INTEGER)), finish) AS window_end
    FROM (SELECT o_orderkey, o_orderdate AS last,
                 o_orderdate + to_minutes(CAST((o_orderkey % 7) * 100 AS INTEGER)) AS finish,
                 CASE WHEN lag_minutes = {INTERVAL} THEN {INTERVAL} ELSE {INTERVAL * MULTIPLIER} END AS step,
                 unnest(range(CASE WHEN lag_minutes < {INTERVAL} THEN 0 WHEN lag_minutes = {INTERVAL} THEN 1
                   ELSE least(lag_minutes // {INTERVAL * MULTIPLIER}, {MAX_CYCLES}) END)) AS n
          FROM (SELECT *, (o_orderkey % 1000) // {INTERVAL} * {INTERVAL} AS lag_minutes FROM orders))
    WHERE last + to_minutes(CAST(n * step AS INTEGER)) < finish
"""


@check("plan_windows", WINDOWS)
def plan_windows(spark, sf_dir):
    return due(spark, sf_dir).select("o_orderkey", "cycle", "window_start", "window_end")


@check(
    "sync_log_append",
    f"""
    SELECT window_start AS since_date_time, window_end AS till_date_time,
           TIMESTAMP '{AS_OF}' AS created_date
    FROM ({WINDOWS})
    """,
)
def sync_log_append(spark, sf_dir):
    return windows.sync_log(due(spark, sf_dir), AS_OF)


@check(
    "sync_watermark",
    f"""
    SELECT 'logged' AS log, max(window_end) AS last FROM ({WINDOWS})
    UNION ALL SELECT 'empty', TIMESTAMP '2020-01-01'
    """,
)
def sync_watermark(spark, sf_dir):
    log = windows.sync_log(due(spark, sf_dir), AS_OF)
    start = "2020-01-01 00:00:00"
    logs = {"logged": log, "empty": log.where("till_date_time < since_date_time")}
    marks = [
        windows.sync_watermark(rows, start).withColumn("log", F.lit(name))
        for name, rows in logs.items()
    ]
    return marks[0].unionByName(marks[1])


@check(
    "sync_watermark_by_type",
    """
    SELECT 'Type' || t.k AS resource_type,
           coalesce(max(o_orderdate), TIMESTAMP '1990-01-01') AS last
    FROM (SELECT p_partkey AS k FROM part) t
    LEFT JOIN orders ON o_custkey % 700 = t.k GROUP BY t.k
    """,
)
def sync_watermark_by_type(spark, sf_dir):
    log = table(spark, sf_dir, "orders").selectExpr(
        "concat('Type', o_custkey % 700) AS resource_type", "o_orderdate AS till_date_time"
    )
    types = table(spark, sf_dir, "part").selectExpr("concat('Type', p_partkey) AS resource_type")
    return windows.sync_watermark_by_type(log, types, "1990-01-01 00:00:00")


TASKS = f"""
    SELECT o_orderkey, cycle, resource_type, strftime(window_start, '%Y-%m-%dT%H:%M:%S') AS start_time,
           strftime(window_end, '%Y-%m-%dT%H:%M:%S') AS end_time,
           'batch-load/' || strftime(window_end, '%Y%m%dT%H%M') AS folder_name
    FROM ({WINDOWS}), {TYPE_ROWS}
"""


@check("fan_out_tasks", TASKS)
def fan_out_tasks(spark, sf_dir):
    tasks = windows.fan_out_tasks(due(spark, sf_dir), TYPES)
    return tasks.drop("last", "now", "end")


@check(
    "window_task_message",
    f"""
    SELECT resource_type, start_time, end_time, '2024-02-01T00:00:00' AS request_time,
           strftime(CAST(end_time AS TIMESTAMP), '%Y%m%dT%H%M%S') AS folder_name,
           CAST(cycle AS INTEGER) AS page_number, 'https://server/' || resource_type AS fhir_url,
           CAST(o_orderkey % 4 AS INTEGER) AS retry_count, o_orderkey % 7 = 0 AS retry_message
    FROM ({TASKS})
    """,
)
def window_task_message(spark, sf_dir):
    tasks = windows.fan_out_tasks(due(spark, sf_dir), TYPES).withColumns(
        {
            "page_number": F.col("cycle"),
            "fhir_url": F.concat(F.lit("https://server/"), "resource_type"),
            "retry_count": F.expr("int(o_orderkey % 4)"),
            "retry_message": F.expr("o_orderkey % 7 = 0"),
        }
    )
    return windows.task_messages(tasks, "2024-02-01T00:00:00")


def spans(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_orderdate AS start",
        "timestamp_seconds(unix_timestamp(o_orderdate) + (o_orderkey % 40) * 86400 + 3600) AS end",
    )


@check(
    "export_windows",
    f"""
    SELECT o_orderkey, resource_type, false AS keeps_rest, start + to_days(CAST(n * 7 AS INTEGER)) AS since,
           start + to_days(CAST((n + 1) * 7 AS INTEGER)) AS till
    FROM (SELECT o_orderkey, o_orderdate AS start, unnest(range((o_orderkey % 40) // 7)) AS n FROM orders),
         {TYPE_ROWS}
    UNION ALL
    SELECT o_orderkey, 'Patient', true, start + to_days(CAST(n * 7 AS INTEGER)),
           least(start + to_days(CAST((n + 1) * 7 AS INTEGER)),
                 start + to_days(CAST(o_orderkey % 40 AS INTEGER)) + INTERVAL 1 HOUR)
    FROM (SELECT o_orderkey, o_orderdate AS start, unnest(range((o_orderkey % 40) // 7 + 1)) AS n
          FROM orders)
    """,
)
def export_windows(spark, sf_dir):
    whole = windows.export_windows(spans(spark, sf_dir), 7, ["Patient", "Observation", "Encounter"])
    rest = windows.export_windows(spans(spark, sf_dir), 7, ["Patient"], keep_rest=True)
    parts = [whole.withColumn("keeps_rest", F.lit(False)), rest.withColumn("keeps_rest", F.lit(True))]
    return parts[0].unionByName(parts[1]).drop("start", "end")


@check(
    "resource_list",
    """
    SELECT p_partkey, 'Type' || p_size AS resource_type, 'statement' AS origin FROM part
    UNION ALL SELECT p_partkey, p_brand, 'statement' FROM part
    UNION ALL SELECT p_partkey, p_type, 'list' FROM part
    UNION ALL SELECT p_partkey, p_name, 'list' FROM part
    """,
)
def resource_list(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    statements = part.selectExpr(
        "p_partkey",
        """concat('{"rest":[{"resource":[{"type":"Type', p_size, '"},{"type":"', p_brand, '"}]}]}')
           AS value""",
    )
    lists = part.selectExpr("p_partkey", "concat(p_type, ' , ', p_name) AS description")
    found = bundles.capability_resources(statements).withColumn("origin", F.lit("statement"))
    listed = bundles.listed_resources(lists, "description").withColumn("origin", F.lit("list"))
    return found.unionByName(listed)


@check(
    "incremental_filter",
    """
    SELECT 'obs-' || event_id AS id FROM events
    WHERE date_trunc('second', ts) BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20 12:00:00'
    """,
)
def incremental_filter(spark, sf_dir):
    parsed = parse_documents(documents(spark, sf_dir, "Observation"), "Observation", CATALOG, ["meta"])
    rows = parsed.select("id", F.col("meta.lastUpdated").cast("timestamp").alias("updated"))
    start, end = F.lit("2024-01-10").cast("timestamp"), F.lit("2024-01-20 12:00:00").cast("timestamp")
    return windows.changed_between(rows, "updated", start, end).select("id")
