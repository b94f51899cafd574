"""Keyed loads and publishing."""

from pyspark.sql import functions as F

from chartloom.operators import changes, load
from chartloom.operators.published import TableSet
from chartloom.operators.shared import normalize, shared_table
from chartloom.session import work_dir
from chartloom.sources.shaped import documents, table
from checks.base import AS_OF, CATALOG, check
from checks.changes import CLASSIFIED, classified, stored_state

FIELDS = ["generalpractitioner", "managingorganization"]
FIELD_ROWS = "(SELECT unnest(['generalpractitioner', 'managingorganization']) AS field_name)"
# Stored reference rows of a patient: number 0 of both fields, and more for some.
STORED_REFERENCES = f"""
    SELECT id, field_name, CAST(n AS INTEGER) AS seq_no, 'old' AS reference
    FROM (SELECT id, field_name, unnest(range(reference_max_array_size + 1)) AS n
          FROM (SELECT 'pat-' || c_custkey AS id, c_custkey % 3 AS reference_max_array_size
                FROM customer WHERE c_custkey % 5 <> 0), {FIELD_ROWS})
    UNION ALL SELECT 'pat-' || c_custkey, 'link', 0, 'kept' FROM customer WHERE c_custkey % 5 <> 0
"""
NEW_REFERENCES = f"""
    SELECT id, 'managingorganization' AS field_name, 0 AS seq_no,
           'Organization/nation-' || c_nationkey AS reference
    FROM ({CLASSIFIED}) c JOIN customer ON c.k = c_custkey WHERE operation <> 'duplicate'
    UNION ALL
    SELECT id, 'generalpractitioner', 0, 'Practitioner/' || k % 40
    FROM ({CLASSIFIED}) WHERE operation <> 'duplicate'
    UNION ALL
    SELECT id, 'generalpractitioner', 1, NULL
    FROM ({CLASSIFIED}) WHERE operation <> 'duplicate' AND k % 2 = 0
"""


def stored_references(spark, sf_dir):
    state = stored_state(spark, sf_dir)
    names = F.explode(F.array(*map(F.lit, FIELDS))).alias("field_name")
    own = (
        state.select("id", "reference_max_array_size", names)
        .withColumn("seq_no", F.explode(F.sequence(F.lit(0), "reference_max_array_size")))
        .selectExpr("id", "field_name", "seq_no", "'old' AS reference")
    )
    kept = state.selectExpr("id", "'link' AS field_name", "0 AS seq_no", "'kept' AS reference")
    return own.unionByName(kept)


def new_references(spark, sf_dir):
    """Reference rows of the patients that are new or updated."""
    lines = documents(spark, sf_dir, "Patient")
    wanted = ["generalPractitioner", "managingOrganization"]
    rows = shared_table(normalize(lines, "Patient", CATALOG, wanted, ("reference",)), "reference")
    changed = changes.changed_rows(classified(spark, sf_dir)).select("id")
    return rows.join(changed, "id", "left_semi").select("id", "field_name", "seq_no", "reference")


TOMBSTONES = f"""
    SELECT id, field_name, CAST(n AS INTEGER) AS seq_no, id || '_' || field_name || '_' || n AS record_id,
           1 AS __op
    FROM (SELECT id, field_name, unnest(range(reference_max_array_size + 1)) AS n
          FROM ({CLASSIFIED}), {FIELD_ROWS} WHERE operation = 'update')
"""


@check("tombstones", TOMBSTONES)
def tombstones(spark, sf_dir):
    sizes = changes.stored_sizes(classified(spark, sf_dir))
    return load.tombstones(sizes, "reference_max_array_size_db", FIELDS)


@check(
    "change_batch",
    f"""
    SELECT id, field_name, seq_no, __op, NULL::VARCHAR AS reference, NULL::TIMESTAMP AS updated_date
    FROM ({TOMBSTONES})
    UNION ALL
    SELECT id, field_name, seq_no, 0, reference, TIMESTAMP '{AS_OF}' FROM ({NEW_REFERENCES})
    """,
)
def change_batch(spark, sf_dir):
    sizes = changes.stored_sizes(classified(spark, sf_dir))
    deletes = load.tombstones(sizes, "reference_max_array_size_db", FIELDS)
    batch = load.change_batch(deletes, new_references(spark, sf_dir), AS_OF)
    return batch.drop("record_id", "__seq")


@check(
    "distinct_ids",
    "SELECT DISTINCT 'pat-' || user_id AS id FROM events WHERE event_id % 3 < 2",
)
def distinct_ids(spark, sf_dir):
    rows = table(spark, sf_dir, "events").selectExpr(
        "concat('pat-', user_id) AS id",
        """element_at(array('batch-load_20240201_Patient-1.ndjson', 'utilitiesdata.ndjson',
                            'Patient.ndjson'), int(event_id % 3) + 1) AS file_name""",
    )
    return load.batch_ids(rows)


@check(
    "apply_changes",
    f"""
    SELECT id, field_name, seq_no, reference FROM ({STORED_REFERENCES}) s
    WHERE NOT EXISTS (SELECT 1 FROM ({TOMBSTONES}) t WHERE t.id = s.id AND t.field_name = s.field_name
                      AND t.seq_no = s.seq_no)
      AND NOT EXISTS (SELECT 1 FROM ({NEW_REFERENCES}) n WHERE n.id = s.id
                      AND n.field_name = s.field_name AND n.seq_no = s.seq_no)
    UNION ALL SELECT id, field_name, seq_no, reference FROM ({NEW_REFERENCES})
    """,
)
def apply_changes(spark, sf_dir):
    sizes = changes.stored_sizes(classified(spark, sf_dir))
    deletes = load.tombstones(sizes, "reference_max_array_size_db", FIELDS)
    batch = load.change_batch(deletes, new_references(spark, sf_dir), AS_OF)
    merged = load.apply_changes(stored_references(spark, sf_dir), batch, load.SHARED_KEY)
    return merged.select("id", "field_name", "seq_no", "reference")


@check(
    "replace_shared_rows",
    f"""
    SELECT id, field_name, seq_no, reference FROM ({STORED_REFERENCES})
    WHERE field_name = 'link' OR id NOT IN (SELECT id FROM ({CLASSIFIED}) WHERE operation = 'update')
    UNION ALL SELECT id, field_name, seq_no, reference FROM ({NEW_REFERENCES})
    """,
)
def replace_shared_rows(spark, sf_dir):
    updated = load.updated_ids(classified(spark, sf_dir))
    return load.replace_shared_rows(
        stored_references(spark, sf_dir), new_references(spark, sf_dir), updated, FIELDS
    )


@check(
    "skip_empty",
    """
    SELECT 'pat-' || c_custkey AS id, CAST(1 + c_custkey % 2 AS BIGINT) AS meta_versionid
    FROM customer WHERE c_custkey % 5 <> 0
    """,
)
def skip_empty(spark, sf_dir):
    state = stored_state(spark, sf_dir).select("id", "meta_versionid")
    nothing = classified(spark, sf_dir).where("operation = 'none'")
    deletes = load.tombstones(changes.stored_sizes(nothing), "reference_max_array_size_db", FIELDS)
    batch = load.change_batch(deletes.select("id", "__op"), nothing.select("id", "meta_versionid"), AS_OF)
    return load.apply_changes(state, batch, ["id"]).select("id", "meta_versionid")


@check(
    "publish_all_or_none",
    """
    SELECT 'part' AS table_name, 'p-' || p_partkey AS id, p_retailprice AS amount FROM part
    UNION ALL SELECT 'supplier', 's-' || s_suppkey, s_acctbal + 1 FROM supplier
    """,
)
def publish_all_or_none(spark, sf_dir):
    """Two tables load three batches: published, published, and failed before publishing."""
    tables = TableSet(spark, work_dir(spark, "publish"))
    part = table(spark, sf_dir, "part").selectExpr(
        "concat('p-', p_partkey) AS id", "p_retailprice AS amount"
    )
    supplier = table(spark, sf_dir, "supplier").selectExpr(
        "concat('s-', s_suppkey) AS id", "s_acctbal AS amount"
    )
    raised = supplier.withColumn("amount", F.col("amount") + 1)
    every = set(range(tables.buckets))
    tables.write("part", part, 1)
    tables.write("supplier", supplier, 1)
    tables.publish(1, {"part": every, "supplier": every})
    tables.write("supplier", raised, 2)
    tables.publish(2, {"supplier": every})
    tables.write("part", part.withColumn("amount", -F.col("amount")), 3)
    seen = [
        tables.read(name, part.schema).withColumn("table_name", F.lit(name))
        for name in ("part", "supplier")
    ]
    return seen[0].unionByName(seen[1])
