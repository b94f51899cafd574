"""FHIR scalar functions over whole tables, and the curated tables built from them."""

from pyspark.sql import functions as F

from chartloom.functions import fhir
from chartloom.functions.dates import date_parts
from chartloom.functions.keys import hash64
from chartloom.operators.flatten import parse_documents
from chartloom.plans import marts
from chartloom.sources.shaped import documents, table
from checks.base import CATALOG, check, key_sql


def parsed(spark, sf_dir, resource, only):
    return parse_documents(documents(spark, sf_dir, resource), resource, CATALOG, only)


# Every form a date may come in, by event number; the last ones have no date.
DATE_TEXT = """
    CASE event_id % 12
      WHEN 0 THEN date_format(ts, 'yyyy')
      WHEN 1 THEN date_format(ts, 'yyyy-MM')
      WHEN 2 THEN date_format(ts, 'MM-yyyy')
      WHEN 3 THEN date_format(ts, 'M/yyyy')
      WHEN 4 THEN date_format(ts, 'yyyy-M-d')
      WHEN 5 THEN date_format(ts, 'yyyy/MM/dd')
      WHEN 6 THEN date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
      WHEN 7 THEN concat(date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), '-05:30')
      WHEN 8 THEN date_format(ts, 'yyyy-MM-dd HH:mm:ss')
      WHEN 9 THEN '0001-01-01T00:00:00'
      WHEN 10 THEN event_type
      ELSE date_format(ts, 'MMMM d, yyyy') END
"""
DATE_VALUE = """
    CASE WHEN event_id % 12 = 0 THEN date_trunc('year', ts)
         WHEN event_id % 12 IN (1, 2, 3) THEN date_trunc('month', ts)
         WHEN event_id % 12 IN (4, 5, 11) THEN date_trunc('day', ts)
         WHEN event_id % 12 IN (6, 8) THEN date_trunc('second', ts)
         WHEN event_id % 12 = 7 THEN date_trunc('second', ts) + INTERVAL 330 MINUTE END
"""


@check(
    "fhir_date_parts",
    f"""
    SELECT event_id, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
           CAST(day(d) AS INTEGER) AS day, strftime(d, '%Y-%m-%d') AS date,
           strftime(d, '%Y-%m-%d %H:%M:%S') AS datetime, strftime(d, '%H:%M:%S') AS time
    FROM (SELECT event_id, CAST({DATE_VALUE} AS TIMESTAMP) AS d FROM events)
    """,
)
def fhir_date_parts(spark, sf_dir):
    texts = table(spark, sf_dir, "events").selectExpr("event_id", f"{DATE_TEXT} AS text")
    return texts.select("event_id", date_parts("text").alias("d")).select("event_id", "d.*")


@check(
    "extension_display",
    """
    SELECT 'pat-' || c_custkey AS id, 'Group ' || c_custkey % 5 AS group_display,
           CASE WHEN c_custkey % 3 = 0 THEN 'Inner ' || c_custkey % 4 END AS inner_display,
           NULL::VARCHAR AS nested_url_display
    FROM customer
    """,
)
def extension_display(spark, sf_dir):
    rows = parsed(spark, sf_dir, "Patient", ["extension"])
    extensions = F.col("extension")
    nested = ["extension.valueCoding"]
    return rows.select(
        "id",
        fhir.extension_display(extensions, ["urn:ext:group"], ["valueCode", "valueCoding"]).alias(
            "group_display"
        ),
        fhir.extension_display(extensions, ["urn:ext:nested"], nested).alias("inner_display"),
        fhir.extension_display(extensions, ["inner"], ["valueCoding"]).alias("nested_url_display"),
    )


@check(
    "reference_key",
    f"""
    SELECT 'pat-' || c_custkey AS id, {key_sql("CAST(c_custkey % 40 AS VARCHAR)")} AS practitioner_key,
           NULL::VARCHAR AS group_key
    FROM customer
    """,
)
def reference_key(spark, sf_dir):
    rows = parsed(spark, sf_dir, "Patient", ["generalPractitioner"])
    references = F.col("generalPractitioner")
    return rows.select(
        "id",
        fhir.reference_key(references, "Practitioner").cast("string").alias("practitioner_key"),
        fhir.reference_key(references, "Group").cast("string").alias("group_key"),
    )


@check(
    "hash64",
    f"SELECT event_id, {key_sql('event_type || event_id')} AS hash FROM events",
)
def hash64_keys(spark, sf_dir):
    text = F.concat("event_type", F.col("event_id").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", hash64(text).cast("string").alias("hash"))


LINE_1 = "(c_custkey % 100 || ' Main St')"
LINE_2 = "(CASE WHEN c_custkey % 3 = 0 THEN 'Apt ' || c_custkey % 7 ELSE '' END)"
POSTAL = """(CASE WHEN c_custkey % 8 = 0 THEN '' ELSE
             lpad(CAST(c_custkey % 200 AS VARCHAR), 5, '0') END)"""
LOCATION = key_sql(f"({LINE_1} || {LINE_2} || {POSTAL})")


@check(
    "address_parts",
    f"""
    SELECT 'pat-' || c_custkey AS id, {LOCATION} AS location_id, {LINE_1} AS address_1,
           {LINE_2} AS address_2, {POSTAL} AS postalcode, 'City ' || c_nationkey AS city,
           CAST(c_nationkey AS VARCHAR) AS country, 'home' AS use, '' AS type, '' AS text,
           '' AS district, '' AS state
    FROM customer WHERE c_custkey % 10 <> 9
    UNION ALL
    SELECT 'pat-' || c_custkey, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL
    FROM customer WHERE c_custkey % 10 = 9
    """,
)
def address_parts(spark, sf_dir):
    rows = parsed(spark, sf_dir, "Patient", ["address"])
    parts = rows.select("id", fhir.address_parts(F.col("address")).alias("a")).select("id", "a.*")
    return parts.withColumn("location_id", F.col("location_id").cast("string"))


FULL_NAME = """(CASE WHEN c_custkey % 5 = 0 THEN 'Dr ' ELSE '' END || 'G' || c_custkey % 10 || ' H '
               || c_name)"""


@check(
    "human_name_parts",
    f"""
    SELECT 'pat-' || c_custkey AS id, 'official' AS use, '' AS text, c_name AS family,
           'G' || c_custkey % 10 AS given, CASE WHEN c_custkey % 5 = 0 THEN 'Dr' ELSE '' END AS prefix,
           '' AS suffix, '' AS period, {FULL_NAME} AS full_name
    FROM customer
    """,
)
def human_name_parts(spark, sf_dir):
    rows = parsed(spark, sf_dir, "Patient", ["name"])
    return rows.select("id", fhir.human_name_parts(F.col("name")).alias("n")).select("id", "n.*")


@check(
    "identifier_value",
    """
    SELECT 'pat-' || c_custkey AS id, CAST(c_custkey AS VARCHAR) AS custkey,
           CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS source, NULL::VARCHAR AS other
    FROM customer
    """,
)
def identifier_value(spark, sf_dir):
    rows = parsed(spark, sf_dir, "Patient", ["identifier"])
    systems = {"custkey": "urn:custkey", "source": "urn:Source", "other": "urn:other"}
    return rows.select(
        "id",
        *[fhir.identifier_value(F.col("identifier"), s).alias(n) for n, s in systems.items()],
    )


@check(
    "coding_display",
    "SELECT 'enc-' || o_orderkey AS id, 'class ' || o_orderstatus AS display FROM orders",
)
def coding_display(spark, sf_dir):
    rows = parsed(spark, sf_dir, "Encounter", ["class"])
    return rows.select("id", fhir.coding_display(F.array("class")).alias("display"))


@check(
    "concept_display",
    """
    SELECT 'enc-' || o_orderkey AS id, CASE WHEN o_orderkey % 3 <> 0 THEN 'one' END AS type_display,
           NULL::VARCHAR AS priority_display
    FROM orders
    """,
)
def concept_display(spark, sf_dir):
    rows = parsed(spark, sf_dir, "Encounter", ["type", "priority"])
    return rows.select(
        "id",
        fhir.concept_display(F.col("type")).alias("type_display"),
        fhir.concept_display(F.array("priority")).alias("priority_display"),
    )


NOTE = """CASE event_id % 4 WHEN 0 THEN 'note ' || event_id % 9
          WHEN 1 THEN 'first ' || event_id % 9 END"""


@check("annotation_text", f"SELECT 'obs-' || event_id AS id, {NOTE} AS note FROM events")
def annotation_text(spark, sf_dir):
    rows = parsed(spark, sf_dir, "Observation", ["note"])
    return rows.select("id", fhir.annotation_text(F.col("note")).alias("note"))


@check(
    "quantity_value",
    """
    SELECT 'obs-' || event_id AS id, CASE WHEN event_id % 10 <> 0 THEN value END AS value FROM events
    """,
)
def quantity_value(spark, sf_dir):
    rows = parsed(spark, sf_dir, "Observation", ["valueQuantity"])
    value = fhir.quantity_value(F.array("valueQuantity")).cast("double")
    return rows.select("id", value.alias("value"))


@check(
    "backbone_child",
    f"""
    SELECT 'enc-' || o_orderkey AS id, {key_sql("CAST(o_orderkey % 50 AS VARCHAR)")} AS location_key,
           CASE WHEN o_orderkey % 4 <> 3 THEN 'lead ' || o_orderkey % 3 END AS role,
           NULL::DOUBLE AS part_value
    FROM orders
    UNION ALL
    SELECT 'obs-' || event_id, NULL, NULL, CASE WHEN event_id % 5 = 0 THEN value END FROM events
    """,
)
def backbone_child(spark, sf_dir):
    encounters = parsed(spark, sf_dir, "Encounter", ["location", "participant"])
    place = fhir.backbone_child(F.col("location"), "location", "Reference", "Location")
    role = fhir.backbone_child(F.col("participant"), "type", "CodeableConcept")
    observations = parsed(spark, sf_dir, "Observation", ["component"])
    value = fhir.backbone_child(F.col("component"), "valueQuantity", "SimpleQuantity")
    left = encounters.select("id", place.cast("string").alias("location_key"), role.alias("role"))
    right = observations.select("id", value.cast("double").alias("part_value"))
    return left.unionByName(right, allowMissingColumns=True)


@check(
    "location_dimension",
    f"""
    SELECT {LOCATION} AS location_id, {LINE_1} AS address_1, {LINE_2} AS address_2,
           {POSTAL} AS postalcode, count(*) AS residents, min('City ' || c_nationkey) AS city,
           min(CAST(c_nationkey AS VARCHAR)) AS country
    FROM customer WHERE c_custkey % 10 <> 9 GROUP BY 1, 2, 3, 4
    """,
)
def location_dimension(spark, sf_dir):
    rows = marts.location_dimension(documents(spark, sf_dir, "Patient"), CATALOG)
    return rows.withColumn("location_id", F.col("location_id").cast("string"))


@check(
    "patient_dimension",
    f"""
    SELECT 'pat-' || c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
           {FULL_NAME} AS full_name, c_name AS family, 'G' || c_custkey % 10 AS given,
           CAST(1940 + c_custkey % 60 AS INTEGER) AS birth_year,
           CAST(CASE WHEN c_custkey % 3 < 2 THEN 1 + c_custkey % 12 ELSE 1 END AS INTEGER) AS birth_month,
           CAST(CASE WHEN c_custkey % 3 = 0 THEN 1 + c_custkey % 28 ELSE 1 END AS INTEGER) AS birth_day,
           CAST(c_custkey AS VARCHAR) AS external_id,
           CASE WHEN c_custkey % 10 <> 9 THEN {LOCATION} END AS location_id,
           CASE WHEN c_custkey % 6 > 1 THEN lower(c_mktsegment) END AS marital_status
    FROM customer
    """,
)
def patient_dimension(spark, sf_dir):
    rows = marts.patient_dimension(documents(spark, sf_dir, "Patient"), CATALOG, "urn:custkey")
    return rows.withColumn("location_id", F.col("location_id").cast("string"))


@check(
    "observation_fact",
    f"""
    SELECT {key_sql("'pat-' || user_id")} AS patient_key, 'event ' || event_type AS code_display,
           count(*) AS observations, count(*) FILTER (event_id % 10 <> 0) AS measured,
           max(CASE WHEN event_id % 10 <> 0 THEN value END) AS max_value,
           strftime(max(ts), '%Y-%m-%d') AS last_day, min({NOTE}) AS first_note
    FROM events GROUP BY user_id, event_type
    """,
)
def observation_fact(spark, sf_dir):
    rows = marts.observation_fact(documents(spark, sf_dir, "Observation"), CATALOG)
    return rows.withColumn("patient_key", F.col("patient_key").cast("string"))


@check(
    "extension_cohorts",
    """
    SELECT 'Group ' || c_custkey % 5 AS cohort, count(*) AS patients FROM customer GROUP BY 1
    """,
)
def extension_cohorts(spark, sf_dir):
    return marts.extension_cohorts(
        documents(spark, sf_dir, "Patient"), CATALOG, ["urn:ext:group"], ["valueCoding"]
    )


@check(
    "encounter_backbone_fact",
    f"""
    SELECT 'enc-' || o_orderkey AS id, {key_sql("CAST(o_orderkey % 50 AS VARCHAR)")} AS location_key,
           CASE WHEN o_orderkey % 4 <> 3
                THEN {key_sql("CAST(o_orderkey % 40 AS VARCHAR)")} END AS person_key,
           CASE WHEN o_orderkey % 4 <> 3 THEN 'lead ' || o_orderkey % 3 END AS role
    FROM orders
    """,
)
def encounter_backbone_fact(spark, sf_dir):
    rows = marts.encounter_backbone_fact(documents(spark, sf_dir, "Encounter"), CATALOG)
    keys = {c: F.col(c).cast("string") for c in ("location_key", "person_key")}
    return rows.withColumns(keys)
