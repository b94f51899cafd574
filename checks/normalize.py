"""Flattening documents, and the three shared tables."""

from pyspark.sql import functions as F

from chartloom.functions.keys import row_digest
from chartloom.operators import frames
from chartloom.operators.flatten import flatten, parse_documents
from chartloom.operators.shared import melted, normalize, resource_table, shared_table
from chartloom.sources.ndjson import scan_documents
from chartloom.sources.shaped import documents, table
from checks.base import CATALOG, check


def flat(spark, sf_dir, resource, only):
    """Wide columns of some elements only."""
    return flatten(documents(spark, sf_dir, resource), resource, CATALOG, only)


def long_rows(spark, sf_dir, resource, shared, only):
    lines = documents(spark, sf_dir, resource)
    return shared_table(normalize(lines, resource, CATALOG, only, (shared,)), shared)


BIRTH_DATE = """
    CASE c_custkey % 3
      WHEN 0 THEN make_timestamp(1940 + c_custkey % 60, 1 + c_custkey % 12, 1 + c_custkey % 28, 0, 0, 0.0)
      WHEN 1 THEN make_timestamp(1940 + c_custkey % 60, 1 + c_custkey % 12, 1, 0, 0, 0.0)
      ELSE make_timestamp(1940 + c_custkey % 60, 1, 1, 0, 0, 0.0) END
"""
GENDER = "CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END"


@check(
    "flatten_primitives",
    f"""
    SELECT 'pat-' || c_custkey AS id, c_acctbal >= 0 AS active, {GENDER} AS gender,
           {BIRTH_DATE} AS birthdate,
           CASE WHEN c_custkey % 20 = 0 THEN CAST(c_custkey % 3 AS INTEGER) END AS multiplebirthinteger
    FROM customer
    """,
)
def flatten_primitives(spark, sf_dir):
    elements = ["active", "gender", "birthDate", "multipleBirthInteger"]
    return flat(spark, sf_dir, "Patient", elements)


@check(
    "flatten_struct",
    """
    SELECT 'enc-' || o_orderkey AS id, o_orderdate AS period_start,
           o_orderdate + INTERVAL 1 DAY AS period_end, o_totalprice AS length_value,
           'min' AS length_unit, CAST(1 + o_orderkey % 2 AS VARCHAR) AS meta_versionid,
           strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS meta_lastupdated
    FROM orders
    """,
)
def flatten_struct(spark, sf_dir):
    wide = flat(spark, sf_dir, "Encounter", ["meta", "period", "length"])
    return wide.select(
        "id",
        "period_start",
        "period_end",
        F.col("length_value").cast("double").alias("length_value"),
        "length_unit",
        "meta_versionid",
        "meta_lastupdated",
    )


@check(
    "flatten_array_struct",
    """
    SELECT 'pat-' || c_custkey AS id,
           'phone' || CASE WHEN c_custkey % 3 = 0 THEN ',email' ELSE '' END AS systems,
           'tel-' || c_custkey
             || CASE WHEN c_custkey % 3 = 0 THEN ',mail-' || c_custkey ELSE '' END AS contacts,
           (1 + c_custkey % 3) || CASE WHEN c_custkey % 3 = 0 THEN ',-' ELSE '' END AS ranks
    FROM customer
    """,
)
def flatten_array_struct(spark, sf_dir):
    wide = flat(spark, sf_dir, "Patient", ["telecom"])
    return wide.select(
        "id",
        F.array_join("telecom_system", ",", "-").alias("systems"),
        F.array_join("telecom_value", ",", "-").alias("contacts"),
        F.array_join("telecom_rank", ",", "-").alias("ranks"),
    )


@check(
    "nested_array",
    """
    SELECT 'pat-' || c_custkey AS id,
           'G' || c_custkey % 10 || '+H' || CASE WHEN c_custkey % 2 = 0 THEN ';N' ELSE '' END AS given,
           CASE WHEN c_custkey % 5 = 0 THEN 'Dr' ELSE '-' END
             || CASE WHEN c_custkey % 2 = 0 THEN ';-' ELSE '' END AS prefix
    FROM customer
    """,
)
def nested_array(spark, sf_dir):
    wide = flat(spark, sf_dir, "Patient", ["name"])

    def joined(column):
        return F.array_join(F.transform(column, lambda x: F.array_join(x, "+")), ";", "-")

    return wide.select("id", joined("name_given").alias("given"), joined("name_prefix").alias("prefix"))


@check(
    "flatten_backbone",
    """
    SELECT 'enc-' || o_orderkey AS id,
           CASE WHEN o_orderkey % 5 = 0
                THEN '{"reference":"Location/' || o_orderkey % 50 || '"}' END AS hospitalization_origin,
           CASE WHEN o_orderkey % 5 = 0 THEN '{"text":"home"}' END AS hospitalization_dischargedisposition
    FROM orders
    """,
)
def flatten_backbone(spark, sf_dir):
    wide = flat(spark, sf_dir, "Encounter", ["hospitalization"])
    return wide.select("id", "hospitalization_origin", "hospitalization_dischargedisposition")


@check(
    "keep_backbone_array",
    """
    SELECT 'pat-' || c_custkey AS id,
           CASE WHEN c_custkey % 4 = 0 THEN '{"name":{"family":"C' || c_custkey || '"}}' END AS contact,
           '{"language":{"text":"en"},"preferred":true}' AS communication,
           '{"extension":[{"valueDecimal":1.50},{"valueDecimal":100000000000000000000.00000000000000000001}]}' AS link
    FROM customer
    """,
)
def keep_backbone_array(spark, sf_dir):
    numbers = """concat('{"link":[{"extension":[{"valueDecimal":1.50},
        {"valueDecimal":100000000000000000000.00000000000000000001}]}],', substr(value, 2)) AS value"""
    docs = documents(spark, sf_dir, "Patient").selectExpr(numbers)
    wide = flatten(docs, "Patient", CATALOG, ["contact", "communication", "link"])
    return wide.select(
        "id",
        F.array_join("link", "|").alias("link"),
        F.array_join("contact", "|").alias("contact"),
        F.array_join("communication", "|").alias("communication"),
    )


@check(
    "keep_extensions",
    """
    SELECT 'obs-' || event_id AS id,
           '{"url":"urn:props","valueString":"' || replace(props, '"', '\\"') || '"}' AS extension,
           '{"extension":[{"valueDecimal":' || event_id || '.50},{"valueDecimal":0.12345678901234567890}]}' AS referencerange
    FROM events
    """,
)
def keep_extensions(spark, sf_dir):
    numbers = """concat('{"referenceRange":[{"extension":[{"valueDecimal":', replace(get_json_object(value, '$.id'), 'obs-', ''),
        '.50},{"valueDecimal":0.12345678901234567890}]}],', substr(value, 2)) AS value"""
    docs = documents(spark, sf_dir, "Observation").selectExpr(numbers)
    wide = flatten(docs, "Observation", CATALOG, ["extension", "referenceRange"])
    return wide.select(
        "id",
        F.array_join("extension", "|").alias("extension"),
        F.array_join("referencerange", "|").alias("referencerange"),
    )


@check(
    "drop_ignored",
    f"""
    SELECT 'pat-' || c_custkey AS id, {GENDER} AS gender, NULL::VARCHAR AS error_code,
           0 AS ignored_columns
    FROM customer
    """,
)
def drop_ignored(spark, sf_dir):
    extra = """{"implicitRules":"urn:r","contained":[{"id":"c"}],"modifierExtension":[],"_gender":{},"""
    docs = documents(spark, sf_dir, "Patient")
    lines = docs.withColumn("value", F.concat(F.lit(extra), F.expr("substr(value, 2)")))
    scanned = scan_documents(lines, "Patient", CATALOG).select("error_code", "doc.*")
    ignored = {"implicitRules", "contained", "modifierExtension", "_gender", "resourceType"}
    return scanned.select(
        "id", "gender", "error_code", F.lit(len(ignored & set(scanned.columns))).alias("ignored_columns")
    )


@check(
    "melt_shared",
    """
    SELECT 'pat-' || c_custkey AS id, 'generalpractitioner' AS field_name, 0 AS position,
           '{"reference":"Practitioner/' || c_custkey % 40 || '","display":"Dr ' || c_custkey % 40 || '"}'
             AS json
    FROM customer
    UNION ALL
    SELECT 'pat-' || c_custkey, 'generalpractitioner', 1,
           '{"identifier":"{\\"system\\":\\"urn:npi\\",\\"value\\":\\"' || c_custkey % 17 || '\\"}"}'
    FROM customer WHERE c_custkey % 2 = 0
    UNION ALL
    SELECT 'pat-' || c_custkey, 'managingorganization', 0,
           '{"reference":"Organization/nation-' || c_nationkey || '","type":"Organization"}'
    FROM customer
    """,
)
def melt_shared(spark, sf_dir):
    elements = CATALOG.of_shape("Patient", "reference")
    names = [e.name for e in elements]
    parsed = parse_documents(documents(spark, sf_dir, "Patient"), "Patient", CATALOG, names)
    entries = parsed.select("id", F.explode(F.expr(melted(elements))).alias("entry"))
    items = entries.select(
        "id", F.col("entry.field_name"), F.posexplode("entry.items").alias("position", "item")
    )
    return items.select("id", "field_name", "position", F.to_json("item").alias("json"))


# One row per (order, field, number) of the concepts an encounter carries.
ENCOUNTER_TYPES = """
    SELECT 'enc-' || o_orderkey AS id, 'type' AS field_name, n AS seq_no, 'urn:type' AS system,
           ['T1', 'T2A', 'T2B'][n + 1] AS code, ['one', 'two a', NULL][n + 1] AS display,
           CASE WHEN n > 0 THEN 'two' END AS text,
           CASE WHEN o_orderkey % 3 = 1 THEN NULL
                WHEN n = 0 THEN '{"url":"urn:c"}'
                WHEN n = 1 AND o_orderkey % 2 = 0 THEN '{"url":"urn:c"}|{"url":"urn:e"}'
                WHEN n = 1 THEN '{"url":"urn:e"}' END AS extension
    FROM orders, (SELECT CAST(unnest(range(3)) AS INTEGER) AS n)
    WHERE o_orderkey % 3 = 2 OR (o_orderkey % 3 = 1 AND n = 0)
"""
CONCEPT_COLUMNS = ["id", "field_name", "seq_no", "system", "code", "display", "text"]


@check(
    "codeableconcept_rows",
    f"""
    SELECT id, field_name, seq_no, system, code, display, text FROM ({ENCOUNTER_TYPES})
    UNION ALL
    SELECT 'enc-' || o_orderkey, 'priority', 0, NULL, NULL, NULL, o_orderpriority FROM orders
    UNION ALL
    SELECT 'pat-' || c_custkey, 'maritalstatus', 0,
           CASE WHEN c_custkey % 6 > 1 THEN 'urn:segment' END,
           CASE WHEN c_custkey % 6 > 1 THEN c_mktsegment END,
           CASE WHEN c_custkey % 6 > 1 THEN lower(c_mktsegment) END, c_mktsegment
    FROM customer WHERE c_custkey % 6 > 0
    """,
)
def codeableconcept_rows(spark, sf_dir):
    encounters = long_rows(spark, sf_dir, "Encounter", "codeableconcept", ["type", "priority"])
    patients = long_rows(spark, sf_dir, "Patient", "codeableconcept", ["maritalStatus"])
    return encounters.unionByName(patients).select(*CONCEPT_COLUMNS)


@check(
    "coding_rows",
    """
    SELECT 'enc-' || o_orderkey AS id, 'class' AS field_name, 0 AS seq_no, 'urn:class' AS system,
           o_orderstatus AS code, 'class ' || o_orderstatus AS display,
           o_orderkey % 2 = 0 AS userselected
    FROM orders
    """,
)
def coding_rows(spark, sf_dir):
    rows = long_rows(spark, sf_dir, "Encounter", "codeableconcept", ["class"])
    return rows.select("id", "field_name", "seq_no", "system", "code", "display", "userselected")


@check(
    "concept_extension_merge",
    f"""
    SELECT id, seq_no, code,
           -- The one extension of the second concept joins its first coding only.
           extension
    FROM ({ENCOUNTER_TYPES})
    """,
)
def concept_extension_merge(spark, sf_dir):
    rows = long_rows(spark, sf_dir, "Encounter", "codeableconcept", ["type"])
    return rows.select("id", "seq_no", "code", F.array_join("extension", "|").alias("extension"))


@check(
    "reference_rows",
    """
    SELECT 'pat-' || c_custkey AS id, 'generalpractitioner' AS field_name, 0 AS seq_no,
           'Practitioner/' || c_custkey % 40 AS reference, NULL::VARCHAR AS type,
           NULL::VARCHAR AS identifier, 'Dr ' || c_custkey % 40 AS display
    FROM customer
    UNION ALL
    SELECT 'pat-' || c_custkey, 'generalpractitioner', 1, NULL, NULL,
           '{"system":"urn:npi","value":"' || c_custkey % 17 || '"}', NULL
    FROM customer WHERE c_custkey % 2 = 0
    UNION ALL
    SELECT 'pat-' || c_custkey, 'managingorganization', 0, 'Organization/nation-' || c_nationkey,
           'Organization', NULL, NULL
    FROM customer
    UNION ALL
    SELECT 'enc-' || o_orderkey, 'subject', 0, 'Patient/pat-' || o_custkey, NULL, NULL,
           'customer ' || o_custkey
    FROM orders
    """,
)
def reference_rows(spark, sf_dir):
    fields = ["generalPractitioner", "managingOrganization"]
    patients = long_rows(spark, sf_dir, "Patient", "reference", fields)
    encounters = long_rows(spark, sf_dir, "Encounter", "reference", ["subject"])
    return patients.unionByName(encounters).select(
        "id", "field_name", "seq_no", "reference", "type", "identifier", "display"
    )


@check(
    "identifier_rows",
    """
    SELECT 'pat-' || c_custkey AS id, 0 AS seq_no, NULL::VARCHAR AS use, NULL::VARCHAR AS type,
           'urn:Source' AS system, c_mktsegment AS value, NULL::TIMESTAMP AS period_start,
           NULL::TIMESTAMP AS period_end, NULL::VARCHAR AS assigner
    FROM customer WHERE c_custkey % 4 <> 0
    UNION ALL
    SELECT 'pat-' || c_custkey, CASE WHEN c_custkey % 4 <> 0 THEN 1 ELSE 0 END, 'usual',
           '{"text":"MR"}', 'urn:custkey', CAST(c_custkey AS VARCHAR), TIMESTAMP '2020-01-01',
           CASE WHEN c_custkey % 2 = 0 THEN TIMESTAMP '2021-06-01' END, '{"display":"registry"}'
    FROM customer
    """,
)
def identifier_rows(spark, sf_dir):
    rows = long_rows(spark, sf_dir, "Patient", "identifier", ["identifier"])
    return rows.drop("field_name", "record_id", "extension")


@check(
    "seq_no",
    """
    SELECT 'obs-' || event_id AS id, field_name, n AS seq_no,
           'obs-' || event_id || '_' || field_name || '_' || n AS record_id
    FROM events, (SELECT 'category' AS field_name, 0 AS n UNION ALL SELECT 'code', 0
                  UNION ALL SELECT 'code', 1)
    """,
)
def seq_no(spark, sf_dir):
    rows = long_rows(spark, sf_dir, "Observation", "codeableconcept", ["category", "code"])
    return rows.select("id", "field_name", "seq_no", "record_id")


@check(
    "max_array_sizes",
    """
    SELECT 'enc-' || o_orderkey AS id,
           CASE WHEN o_orderkey % 3 = 2 THEN 2 ELSE 0 END AS codeableconcept_max_array_size,
           0 AS reference_max_array_size, 0 AS identifier_max_array_size
    FROM orders
    UNION ALL
    SELECT 'pat-' || c_custkey, 0, CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END,
           CASE WHEN c_custkey % 4 <> 0 THEN 1 ELSE 0 END
    FROM customer
    """,
)
def max_array_sizes(spark, sf_dir):
    parts = []
    for resource in ("Encounter", "Patient"):
        shared = CATALOG.of_shape(resource, "codeableconcept", "reference", "identifier")
        lines = documents(spark, sf_dir, resource)
        wide = normalize(lines, resource, CATALOG, [e.name for e in shared])
        sizes = [c for c in wide.columns if c.endswith("_max_array_size")]
        parts.append(wide.select("id", *sizes))
    return parts[0].unionByName(parts[1])


@check(
    "assemble_resource",
    f"""
    SELECT 'pat-' || c_custkey AS id, c_acctbal >= 0 AS active, {GENDER} AS gender,
           {BIRTH_DATE} AS birthdate, CASE WHEN c_custkey % 50 <> 0 THEN
             CAST(1 + c_custkey % 3 AS VARCHAR) END AS meta_versionid,
           c_name || CASE WHEN c_custkey % 2 = 0 THEN ',-' ELSE '' END AS families,
           CASE WHEN c_custkey % 10 <> 9 THEN 'City ' || c_nationkey END AS cities,
           0 AS codeableconcept_max_array_size,
           CASE WHEN c_custkey % 2 = 0 THEN 1 ELSE 0 END AS reference_max_array_size,
           CASE WHEN c_custkey % 4 <> 0 THEN 1 ELSE 0 END AS identifier_max_array_size
    FROM customer
    """,
)
def assemble_resource(spark, sf_dir):
    wide = resource_table(normalize(documents(spark, sf_dir, "Patient"), "Patient", CATALOG))
    return wide.select(
        "id",
        "active",
        "gender",
        "birthdate",
        "meta_versionid",
        F.array_join("name_family", ",", "-").alias("families"),
        F.array_join("address_city", ",").alias("cities"),
        "codeableconcept_max_array_size",
        "reference_max_array_size",
        "identifier_max_array_size",
    )


@check(
    "coerce_int_arrays",
    """
    SELECT 'pat-' || c_custkey AS id, c_custkey % 5 || ',-,-,' || c_custkey % 3 AS ranks
    FROM customer
    """,
)
def coerce_int_arrays(spark, sf_dir):
    lines = table(spark, sf_dir, "customer").selectExpr(
        """concat('{"id":"pat-', c_custkey, '","telecom":[{"rank":', c_custkey % 5,
                  '.0},{"rank":NaN},{"system":"x"},{"rank":', c_custkey % 3, '}]}') AS value"""
    )
    wide = flatten(lines, "Patient", CATALOG, ["telecom"])
    # The entry with nothing but NaN still counts as present.
    return wide.select("id", F.array_join("telecom_rank", ",", "-").alias("ranks"))


@check(
    "serialize_field",
    """
    SELECT 'enc-' || o_orderkey AS id,
           CASE WHEN o_orderkey % 3 = 1
                THEN '[{"coding":[{"system":"urn:type","code":"T1","display":"one"}]}]'
                WHEN o_orderkey % 3 = 2
                THEN '[{"coding":[{"system":"urn:type","code":"T1","display":"one",'
                     || '"extension":["{\\"url\\":\\"urn:c\\"}"]}]},'
                     || '{"coding":[{"system":"urn:type","code":"T2A","display":"two a"'
                     || CASE WHEN o_orderkey % 2 = 0
                             THEN ',"extension":["{\\"url\\":\\"urn:c\\"}"]' ELSE '' END
                     || '},{"system":"urn:type","code":"T2B"}],"text":"two",'
                     || '"extension":["{\\"url\\":\\"urn:e\\"}"]}]' END AS type,
           '{"reference":"Patient/pat-' || o_custkey || '","display":"customer ' || o_custkey || '"}'
             AS subject
    FROM orders
    """,
)
def serialize_field(spark, sf_dir):
    lines = documents(spark, sf_dir, "Encounter")
    parsed = parse_documents(lines, "Encounter", CATALOG, ["type", "subject"])
    return frames.serialized(parsed, ["type", "subject"])


@check(
    "row_hash",
    """
    SELECT user_id, event_type, count(*) AS documents, true AS order_free, 64 AS digest_length,
           count(DISTINCT value) AS digests
    FROM events GROUP BY user_id, event_type
    """,
)
def row_hash(spark, sf_dir):
    docs = table(spark, sf_dir, "events").selectExpr(
        "user_id",
        "event_type",
        "to_json(struct(user_id, event_type, value)) AS one",
        "to_json(struct(value, event_type, user_id)) AS other",
    )
    hashed = docs.select(
        "user_id",
        "event_type",
        row_digest(F.col("one")).alias("one"),
        row_digest(F.col("other")).alias("other"),
    )
    return hashed.groupBy("user_id", "event_type").agg(
        F.count(F.lit(1)).alias("documents"),
        F.bool_and(F.col("one") == F.col("other")).alias("order_free"),
        F.max(F.length("one")).alias("digest_length"),
        F.countDistinct("one").alias("digests"),
    )


@check(
    "blank_to_null",
    """
    SELECT 'obs-' || event_id AS id,
           CASE event_id % 4 WHEN 0 THEN '-|note ' || event_id % 9
                             WHEN 1 THEN 'first ' || event_id % 9 END AS notes
    FROM events
    """,
)
def blank_to_null(spark, sf_dir):
    wide = flat(spark, sf_dir, "Observation", ["note"])
    cleaned = frames.blank_to_null(F.col("note_text"), 1)
    return wide.select("id", F.array_join(cleaned, "|", "-").alias("notes"))


@check(
    "union_frames",
    """
    SELECT 'pat-' || c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'female' ELSE 'male' END AS gender,
           NULL::VARCHAR AS status
    FROM customer
    UNION ALL
    SELECT 'enc-' || o_orderkey, NULL, CASE o_orderstatus WHEN 'F' THEN 'finished'
      WHEN 'O' THEN 'in-progress' ELSE 'planned' END FROM orders
    UNION ALL SELECT 'obs-' || event_id, NULL, 'final' FROM events
    """,
)
def union_frames(spark, sf_dir):
    patients = flat(spark, sf_dir, "Patient", ["gender"])
    others = [flat(spark, sf_dir, r, ["status"]) for r in ("Encounter", "Observation")]
    return frames.union_frames(patients, [others[0], None, others[1]])


@check(
    "rename_drop_if_present",
    f"SELECT 'pat-' || c_custkey AS id, {GENDER} AS sex FROM customer",
)
def rename_drop_if_present(spark, sf_dir):
    wide = flat(spark, sf_dir, "Patient", ["gender", "active"])
    renamed = frames.rename_if_present(wide, {"gender": "sex", "no_such_column": "other"})
    return frames.drop_if_present(renamed, ["active", "no_such_column"])
