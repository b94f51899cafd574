"""Helpers that have to hold with one very large group."""

from pyspark.sql import functions as F

from chartloom.operators import frames
from chartloom.operators.changes import classify, newest_versions, with_stored
from chartloom.operators.errors import retry_split
from chartloom.operators.load import replace_shared_rows
from chartloom.sources.staging import assign_pages


def test_positions_are_dense_with_a_hot_group(spark):
    rows = spark.range(5000).selectExpr("id", "if(id % 3 = 0, 'hot', string(id % 500)) AS g")
    numbered = frames.dense_positions(rows, ["g"], ["id"], F.floor(F.col("id") / 100))
    got = {(r.g, r.position): r.id for r in numbered.collect()}
    for group in ("hot", "1", "250"):
        members = sorted(i for (g, _), i in got.items() if g == group)
        assert [got[group, n + 1] for n in range(len(members))] == members
    assert len(got) == 5000


def test_rows_without_a_group_are_numbered_too(spark):
    rows = spark.range(10).selectExpr("id", "if(id < 4, null, 'g') AS g")
    numbered = frames.dense_positions(rows, ["g"], ["id"], F.expr("id div 3")).collect()
    assert sorted((r.g or "", r.position) for r in numbered) == [
        *[("", n) for n in range(1, 5)],
        *[("g", n) for n in range(1, 7)],
    ]


def test_pages_are_full_but_the_last(spark):
    rows = spark.range(2345).selectExpr("string(id) AS id", "'Patient' AS resource_type")
    pages = assign_pages(rows, ["resource_type"], "id").groupBy("page").count().collect()
    assert sorted((r.page, r["count"]) for r in pages) == [(1, 1000), (2, 1000), (3, 345)]


def test_split_numbers_follow_file_order(spark):
    rows = spark.range(50).selectExpr("id", "'https://s/602/batch-load/x/Patient-3.ndjson' AS url").repartition(7)
    split = retry_split(rows, "id", "https://b", pieces=7).orderBy("id").collect()
    assert [r.record_file for r in split] == [f"Patient-3-{i + 1}.ndjson" for i in range(50)]
    assert split[0].record_url == "https://b/batch-load/x/Patient-3-1.ndjson"


def test_split_of_sparse_orders_and_missing_addresses(spark):
    rows = spark.range(300).selectExpr(
        "id * id * 1000003L AS at", "if(id % 3 = 0, null, concat('https://s/602/batch-load/x/Patient-', id % 3, '.ndjson')) AS url"
    )
    split = retry_split(rows, "at", "https://b", pieces=16)
    assert split.columns == ["at", "url", "record_no", "record_file", "record_url"]
    numbered = split.selectExpr("*", "row_number() OVER (PARTITION BY url ORDER BY at) AS want")
    assert numbered.where("record_no = want").count() == 300


def test_latest_keeps_one_row_per_key_before_the_shuffle(spark):
    rows = spark.range(1000).selectExpr("id % 3 AS k", "id AS v")
    latest = frames.latest_per_key(rows, ["k"], [F.col("v").desc()])
    assert sorted((r.k, r.v) for r in latest.collect()) == [(0, 999), (1, 997), (2, 998)]
    plan = latest._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle


def test_newest_version_then_latest_update_wins(spark):
    rows = spark.createDataFrame(
        [("a", 1, "2024-01-03"), ("a", 2, "2024-01-01"), ("a", 2, "2024-01-02"), ("b", 0, None)],
        "id string, meta_versionid int, meta_lastupdated string",
    )
    kept = {r.id: (r.meta_versionid, r.meta_lastupdated) for r in newest_versions(rows).collect()}
    assert kept == {"a": (2, "2024-01-02"), "b": (0, None)}


def test_stored_version_zero_counts_as_new(spark):
    sizes = ["codeableconcept", "reference", "identifier"]
    state = spark.createDataFrame(
        [("a", 0, 0, 0, 0), ("b", 2, 0, 0, 0), ("c", 1, 0, 0, 0)],
        ["id", "meta_versionid", *[f"{s}_max_array_size" for s in sizes]],
    )
    incoming = spark.createDataFrame([("a", 1), ("b", 2), ("c", 2), ("d", 0)], ["id", "meta_versionid"])
    found = {r.id: r.operation for r in classify(with_stored(incoming, state)).collect()}
    assert found == {"a": "new", "b": "duplicate", "c": "update", "d": "new"}


def test_state_is_not_forced_into_a_broadcast(spark):
    columns = "id string, meta_versionid int, codeableconcept_max_array_size int, " + (
        "reference_max_array_size int, identifier_max_array_size int"
    )
    joined = with_stored(
        spark.createDataFrame([("a", 1)], "id string, meta_versionid int"),
        spark.createDataFrame([], columns),
    )
    assert "ResolvedHint" not in joined._jdf.queryExecution().analyzed().toString()


def test_union_skips_absent_frames_and_fills_columns(spark):
    one, two = spark.range(2).toDF("id"), spark.range(2, 4).withColumn("x", F.lit(1))
    assert frames.union_frames(None, [None]) is None
    rows = frames.union_frames(one, [None, two]).collect()
    assert sorted((r.id, r.x) for r in rows if r.x) == [(2, 1), (3, 1)] and len(rows) == 4


def test_newest_goes_by_the_instant_and_ties_by_the_row(spark):
    rows = spark.createDataFrame(
        [("a", 1, "2024-01-01T10:00:00+09:00", "x"), ("a", 1, "2024-01-01T05:00:00Z", "y"),
         ("b", 1, None, "x"), ("b", 1, None, "y")],
        "id string, meta_versionid int, meta_lastupdated string, document string",
    )
    kept = {r.id: r.document for r in newest_versions(rows).collect()}
    turned = {r.id: r.document for r in newest_versions(rows.orderBy("document", ascending=False)).collect()}
    assert kept["a"] == "y" and kept == turned


def test_shared_rows_without_a_field_name_stay(spark):
    columns = "id string, field_name string, seq_no int"
    state = spark.createDataFrame([("a", None, 0), ("a", "code", 0), ("a", "other", 0), ("b", "code", 0)], columns)
    ids = spark.createDataFrame([("a",)], "id string")
    kept = replace_shared_rows(state, state.where("false"), ids, ["code"]).collect()
    assert {(r.id, r.field_name) for r in kept} == {("a", None), ("a", "other"), ("b", "code")}
