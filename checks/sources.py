"""Reading, staging and addressing documents."""

from pyspark.sql import functions as F

from chartloom.operators import errors, load
from chartloom.operators.flatten import parse_documents
from chartloom.operators.frames import latest_per_key
from chartloom.operators.published import TableSet
from chartloom.session import work_dir
from chartloom.sources import bundles, ndjson, pages, staging
from chartloom.sources.shaped import documents, table
from checks.base import CATALOG, check, uuid5_sql

DIRTY = """
    CASE k % 100
      WHEN 1 THEN substr(value, 1, 70)
      WHEN 2 THEN '  '
      WHEN 3 THEN replace(value, '"gender"', '"gendre"')
      WHEN 4 THEN concat('{"resourceType":"Patient","id":"pat-', k, '","name":{"family":"x"}}')
      ELSE value END AS value
"""


@check(
    "scan_ndjson",
    """
    SELECT CASE WHEN c_custkey % 100 IN (1, 3, 4) THEN NULL ELSE 'pat-' || c_custkey END AS id,
           CASE WHEN c_custkey % 100 IN (1, 3, 4) THEN NULL
                WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
           CASE c_custkey % 100 WHEN 1 THEN '601' WHEN 3 THEN '602' WHEN 4 THEN '602' END AS error_code
    FROM customer WHERE c_custkey % 100 <> 2
    """,
)
def scan_ndjson(spark, sf_dir):
    folder = work_dir(spark, "ndjson")
    documents(spark, sf_dir, "Patient", ("k",)).selectExpr(DIRTY).write.text(folder)
    scanned = ndjson.scan_documents(ndjson.read_lines(spark, folder), "Patient", CATALOG)
    good = F.col("error_code").isNull()
    return scanned.select(
        F.when(good, F.col("doc.id")).alias("id"),
        F.when(good, F.col("doc.gender")).alias("gender"),
        "error_code",
    )


# Numbers that a double would print in another way, in documents and in what is to come out.
PRICED = """concat('{"photo":[{"extension":[{"valueDecimal":', k, '.50},{"valueDecimal":0.1234567890123456',
    lpad(k % 10000, 4, '0'), '},{"valueDecimal":-1.0E+', k % 40, ',"valueString":"at 2.50, \\\\"3.0\\\\""}]}],', substr(value, 2)) AS value"""
PRICES = """'{"valueDecimal":' || c_custkey || '.50}|{"valueDecimal":0.1234567890123456'
    || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') || '}|{"valueDecimal":-1.0E+' || c_custkey % 40
    || ',"valueString":"at 2.50, \\"3.0\\""}' AS prices"""


def prices():
    """The numbers of photos, as texts."""
    return F.array_join(F.flatten("photo.extension"), "|").alias("prices")


@check(
    "scan_json_array",
    f"SELECT 'pat-' || c_custkey AS id, c_custkey // 20 AS batch, {PRICES} FROM customer",
)
def scan_json_array(spark, sf_dir):
    docs = documents(spark, sf_dir, "Patient", ("k",)).selectExpr("k", PRICED)
    # Batches of twenty documents, as a JSON list and as NDJSON text in turn.
    batches = docs.groupBy(F.expr("k div 20").alias("batch")).agg(F.collect_list("value").alias("v"))
    texts = batches.selectExpr(
        "batch",
        """if(batch % 2 = 0, concat('[', array_join(v, ','), ']'),
              concat(array_join(v, '\n'), '\n')) AS value""",
    )
    rows = ndjson.batch_documents(texts).withColumnRenamed("document", "value")
    return parse_documents(rows, "Patient", CATALOG, ["photo"]).select("id", "batch", prices())


@check(
    "bundle_explode",
    f"""
    SELECT 'pat-' || c_custkey AS id,
           CASE WHEN (c_custkey // 50) % 3 <> 2
                THEN 'https://server/Patient?page=' || (c_custkey // 50 + 1) END AS next_url,
           {PRICES}
    FROM customer WHERE c_custkey % 11 <> 0
    """,
)
def bundle_explode(spark, sf_dir):
    docs = documents(spark, sf_dir, "Patient", ("k",)).selectExpr("k", PRICED)
    entry = "if(k % 11 = 0, '{}', concat('{\"resource\":', value, '}'))"
    # Pages of fifty documents.
    pages = docs.groupBy(F.expr("k div 50").alias("page")).agg(
        F.concat_ws(",", F.collect_list(F.expr(entry))).alias("entries")
    )
    following = """if(page % 3 <> 2, concat(',{"relation":"next","url":"https://server/Patient?page=',
                      page + 1, '"}'), '')"""
    value = f"""concat('{{"entry":[', entries, '],"link":[{{"relation":"self","url":"s"}}',
                       {following}, ']}}') AS value"""
    rows = bundles.explode_bundles(pages.selectExpr(value))
    return parse_documents(rows, "Patient", CATALOG, ["photo"]).select("id", "next_url", prices())


@check(
    "stage_ndjson",
    """
    WITH paged AS (
      SELECT 'Patient' AS resource_type, (row_number() OVER (ORDER BY c_custkey) - 1) // 1000 AS p
      FROM customer
      UNION ALL
      SELECT 'Observation', (row_number() OVER (ORDER BY event_id) - 1) // 1000 FROM events)
    SELECT resource_type, CAST(p + 1 AS INTEGER) AS page, count(*) AS lines, count(*) AS ids,
           'batch-load_20240201T0000_' || resource_type || '-' || (p + 1) || '.ndjson' AS file_name,
           count(*) AS may_be_retried, true AS is_whole
    FROM paged GROUP BY resource_type, p
    """,
)
def stage_ndjson(spark, sf_dir):
    folder = work_dir(spark, "stage")
    kinds = ("Patient", "Observation")
    docs = [
        documents(spark, sf_dir, r, ("string(k) AS id",)).withColumn("resource_type", F.lit(r))
        for r in kinds
    ]
    lines = docs[0].unionByName(docs[1]).withColumn("folder", F.lit("batch-load/20240201T0000"))
    paged = staging.assign_pages(lines, ["folder", "resource_type"], "id")
    # The same job twice: the second run replaces the files of the first one.
    for _ in range(2):
        pages.write_pages(paged, folder)
    back = pages.read_pages(spark, folder)
    wrong = pages.missing_pages(paged, back).select("page_file", F.lit(False).alias("_whole"))
    retried = errors.retry_eligible(back.withColumn("error_code", F.lit(errors.SHAPE_FAILED)))
    found = retried.groupBy(
        "page_file",
        staging.stage_resource_type(F.col("url")).alias("resource_type"),
        pages.page_number(F.col("url")).alias("page"),
        staging.stage_file_name(F.col("url")).alias("file_name"),
    ).agg(
        F.count(F.lit(1)).alias("lines"),
        F.countDistinct(F.get_json_object("value", "$.id")).alias("ids"),
        F.count_if(F.col("error_code").isNotNull()).alias("may_be_retried"),
    )
    whole = F.coalesce("_whole", F.lit(True)).alias("is_whole")
    return found.join(wrong, "page_file", "left").select("*", whole).drop("page_file", "_whole")


@check(
    "export_requests",
    """
    SELECT o_orderkey,
           'https://server/fhir/' || CASE o_orderkey % 2 WHEN 0 THEN 'Patient' ELSE 'Encounter' END
           || '?_lastUpdated=ge' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
           || '&_lastUpdated=le' || strftime(o_orderdate + INTERVAL 15 MINUTE, '%Y-%m-%dT%H:%M:%S')
           || '&_count=1000' AS url
    FROM orders
    """,
)
def export_requests(spark, sf_dir):
    tasks = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "if(o_orderkey % 2 = 0, 'Patient', 'Encounter') AS resource_type",
        "date_format(o_orderdate, \"yyyy-MM-dd'T'HH:mm:ss\") AS start_time",
        "date_format(o_orderdate + interval 15 minutes, \"yyyy-MM-dd'T'HH:mm:ss\") AS end_time",
    )
    return staging.export_url("https://server/fhir", tasks).select("o_orderkey", "url")


CHANGE_EVENTS = [
    "event_id",
    "concat('host/fhir/Patient/pat-', user_id) AS subject",
    "if(event_id % 13 = 0, null, if(event_type = 'view', 'ResourceUpdated', 'ResourceCreated'))"
    " AS eventType",
]


@check(
    "event_target",
    """
    SELECT event_id, 'Patient' AS resource_type, 'https://host/fhir/Patient/pat-' || user_id AS url,
           event_type = 'view' AND event_id % 13 <> 0 AS is_update
    FROM events
    """,
)
def event_target(spark, sf_dir):
    events = table(spark, sf_dir, "events").selectExpr(*CHANGE_EVENTS)
    return staging.event_target(events).select("event_id", "resource_type", "url", "is_update")


STAGE_URL = """
    CASE WHEN o_orderkey % 9 = 0 THEN concat('Patient-', o_orderkey, '.ndjson')
         ELSE concat('https://store/stage/batch-load/', year(o_orderdate), '/Encounter-',
                     o_orderkey % 1000, '.ndjson') END
"""


@check(
    "parse_stage_path",
    """
    SELECT o_orderkey,
           CASE WHEN o_orderkey % 9 = 0 THEN 'Patient' ELSE 'Encounter' END AS resource_type,
           CASE WHEN o_orderkey % 9 = 0 THEN 'Patient-' || o_orderkey || '.ndjson'
                ELSE 'batch-load_' || year(o_orderdate) || '_Encounter-' || (o_orderkey % 1000)
                     || '.ndjson' END AS file_name
    FROM orders
    """,
)
def parse_stage_path(spark, sf_dir):
    urls = table(spark, sf_dir, "orders").selectExpr("o_orderkey", f"{STAGE_URL} AS url")
    return urls.select(
        "o_orderkey",
        staging.stage_resource_type(F.col("url")).alias("resource_type"),
        staging.stage_file_name(F.col("url")).alias("file_name"),
    )


@check(
    "stage_message",
    f"""
    SELECT url, '2024-02-01T00:00:00' AS request_time, {uuid5_sql("url")} AS filepath_id
    FROM (SELECT 'https://store/stage/batch-load/' || o_custkey || '/Encounter-' || o_orderkey
                 || '.ndjson' AS url FROM orders)
    """,
)
def stage_message(spark, sf_dir):
    files = table(spark, sf_dir, "orders").selectExpr(
        "concat('batch-load/', o_custkey) AS folder",
        "concat('Encounter-', o_orderkey, '.ndjson') AS file_name",
    )
    messages = staging.stage_messages(files, "https://store/stage", "2024-02-01T00:00:00")
    return messages.select("url", "request_time", "filepath_id")


@check(
    "keyed_upsert_sink",
    """
    SELECT 'part-' || p_partkey AS id,
           CASE WHEN p_partkey % 3 = 0 THEN p_retailprice + 1 ELSE p_retailprice END AS price
    FROM part WHERE p_partkey % 7 <> 0
    UNION ALL SELECT 'fresh-' || p_partkey, p_retailprice FROM part WHERE p_partkey % 11 = 0
    """,
)
def keyed_upsert_sink(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    rows = part.selectExpr("concat('part-', p_partkey) AS id", "p_retailprice AS price", "p_partkey AS k")
    tables = TableSet(spark, work_dir(spark, "upsert"))
    first = rows.select("id", "price")
    schema = first.schema
    tables.write("part", first, 1)
    tables.publish(1, {"part": tables.touched(first)})

    changed = rows.where("k % 3 = 0").selectExpr("id", "price + 1 AS price", "0 AS __op", "0 AS __seq")
    deleted = rows.where("k % 7 = 0").selectExpr("id", "price", "1 AS __op", "1 AS __seq")
    fresh = part.where("p_partkey % 11 = 0").selectExpr(
        "concat('fresh-', p_partkey) AS id", "p_retailprice AS price", "0 AS __op", "0 AS __seq"
    )
    batch = changed.unionByName(deleted).unionByName(fresh)
    at = work_dir(spark, "batch")
    last = latest_per_key(batch, ["id"], [F.col("__seq").desc()])
    last.write.parquet(at)
    last = spark.read.parquet(at)
    whole, added = tables.upsert("part", schema, last.where(F.col("__op") == load.UPSERT), last, 2)
    tables.publish(2, {"part": whole}, {"part": added})
    return tables.read("part", schema)


@check(
    "audit_sink",
    """
    SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS audit_rows, count(DISTINCT user_id) AS users
    FROM events GROUP BY ALL
    """,
)
def audit_sink(spark, sf_dir):
    folder = work_dir(spark, "audit")
    rows = table(spark, sf_dir, "events").selectExpr(
        "concat('pat-', user_id) AS resource_id", "ts AS meta_lastupdated", "'new' AS operation"
    )
    staging.append_by_day(rows, folder, "meta_lastupdated")
    return spark.read.parquet(folder).groupBy(F.col("day").cast("string").alias("day")).agg(
        F.count(F.lit(1)).alias("audit_rows"), F.countDistinct("resource_id").alias("users")
    )
