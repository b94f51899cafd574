"""How produced tables lie on disk."""

from pyspark.sql import functions as F

from chartloom.operators.published import TableSet
from chartloom.operators.shared import normalize, resource_table, shared_table
from chartloom.plans.adhoc import OBSERVATION_UNITS, register_views, save_colocated
from chartloom.sources.ndjson import good_documents, scan_documents
from chartloom.sources.shaped import documents
from chartloom.sources.staging import append_by_day, live_days, write_rejects


def test_saved_tables_join_without_a_shuffle(spark, catalog, sf_dir, tmp_path):
    rows = normalize(documents(spark, sf_dir, "Observation"), "Observation", catalog, ["valueQuantity", "code"])
    tables = {"observation": resource_table(rows), "codeableconcept": shared_table(rows, "codeableconcept")}
    try:
        for name, table in tables.items():
            save_colocated(table, f"saved_{name}", f"{tmp_path}/{name}", buckets=4)
        query = OBSERVATION_UNITS.replace("SELECT o.id", "SELECT /*+ MERGE(c) */ o.id")
        for name in tables:
            query = query.replace(f" {name} ", f" saved_{name} ")
        joined = spark.sql(query)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == 2 * rows.where("valuequantity_value IS NOT NULL").count()
    finally:
        for name in tables:
            spark.sql(f"DROP TABLE IF EXISTS saved_{name}")


def test_views_of_small_files_are_not_sent_whole(spark, catalog, sf_dir):
    docs = documents(spark, sf_dir, "Observation")
    register_views(spark, {"Observation": docs}, catalog, {"Observation": ["valueQuantity", "code"]})
    joined = spark.sql(OBSERVATION_UNITS)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    rows = normalize(docs, "Observation", catalog, ["valueQuantity"])
    assert joined.count() == 2 * rows.where("valuequantity_value IS NOT NULL").count()


def test_only_live_days_are_read(spark, tmp_path):
    rows = spark.sql("SELECT id, timestamp'2024-03-01' - make_dt_interval(int(id * 100)) AS t FROM range(6)")
    append_by_day(rows, f"{tmp_path}/audit", "t")
    live = live_days(spark.read.parquet(f"{tmp_path}/audit"), "2024-03-01")
    assert sorted(r.id for r in live.collect()) == [0, 1, 2, 3]
    assert "PartitionFilters: [isnotnull(day" in live._jdf.queryExecution().executedPlan().toString()


def test_a_repeated_job_adds_nothing_twice(spark, tmp_path):
    rows = spark.sql("SELECT id, timestamp'2024-03-01' AS t, '602' AS error_code FROM range(6)")
    for job in (1, 2, 2):
        append_by_day(rows, f"{tmp_path}/audit", "t", job)
        write_rejects(rows, f"{tmp_path}/rejects", job)
    assert live_days(spark.read.parquet(f"{tmp_path}/audit"), "2024-03-02").count() == 12
    assert spark.read.parquet(f"{tmp_path}/rejects").where("error_code = 602").count() == 12


def test_reading_some_buckets_prunes_the_others(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path), buckets=8, lookups=("system",))
    rows = spark.range(100).selectExpr("string(id) AS id", "concat('s', id % 3) AS system")
    tables.write("t", rows, 1)
    tables.publish(1, {"t": set(range(8))})
    some = tables.read("t", rows.schema, {2, 5})
    assert 0 < some.count() < 100
    files = some.select(F.col("_metadata.file_path").alias("f")).distinct().collect()
    assert {r.f.split("bucket_no=")[1][0] for r in files} == {"2", "5"}
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "bucket_no" in plan[plan.index("PartitionFilters") : plan.index("PushedFilters")]
    assert tables.read("t", rows.schema).count() == 100


def test_first_publish_of_nothing_is_an_empty_table(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path))
    tables.publish(1, {})
    assert tables.snapshot() == {} and tables.snapshot(before=2) == {}
    schema = spark.range(1).schema
    assert tables.read("t", schema).count() == 0


def test_filtering_scanned_rows_parses_once(lines, catalog):
    good = good_documents(scan_documents(lines({"id": "p"}), "Patient", catalog))
    plan = good.where(F.col("gender") == "male")._jdf.queryExecution().optimizedPlan().toString()
    # Once for all, and once more under the test for numbers that a double would print in another way.
    assert plan.count("from_json") == 2 and plan.count("CASE WHEN (RLIKE(value") == 1


def test_many_versions_in_force_are_one_flat_filter(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path), buckets=2000)
    rows = spark.range(20).selectExpr("string(id) AS id")
    tables.write("t", rows, 1)
    snapshot = {("t", bucket): (1,) for bucket in range(2000)}
    assert tables.read("t", rows.schema, snapshot=snapshot).count() == 20
    for version in range(2, 2001):
        (tmp_path / "t" / f"batch_no={version}").mkdir()
        snapshot["t", 2001 - version] = (version,)
    tables.read("t", rows.schema, snapshot=snapshot).count()


def test_a_batch_writes_about_as_many_rows_as_it_has(spark, tmp_path):
    tables = TableSet(spark, str(tmp_path), buckets=4)
    rows = spark.range(20_000).selectExpr("concat('k', id) AS id", "sha2(string(id), 256) AS payload")
    want = {r.id: r.payload for r in rows.collect()}
    sizes, every = {}, {0, 1, 2, 3}
    for version in range(1, 11):
        batch = rows if version == 1 else spark.createDataFrame(
            [(f"k{k}", f"v{version}") for k in range(version, 20_000, 500)] + [(f"new{version}", "n")], rows.schema
        )
        gone = spark.createDataFrame([(f"k{100 + version}",)], "id string")
        replaced = batch.select("id").union(gone)
        whole, added = tables.upsert("t", rows.schema, batch, replaced, version)
        assert (whole, added) == ((every, set()) if version in (1, 9) else (set(), every))
        tables.publish(version, {"t": whole}, {"t": added})
        want.update({r.id: r.payload for r in batch.collect()} if version > 1 else {})
        if version > 1:
            want.pop(f"k{100 + version}", None)
        found = {r.id: r.payload for r in tables.read("t", rows.schema).collect()}
        assert found == want if version > 1 else len(found) == 20_000
        sizes[version] = sum(f.stat().st_size for f in (tmp_path / "t" / f"batch_no={version}").rglob("*.parquet"))
    assert max(sizes[v] for v in (2, 3, 4)) < sizes[1] / 20 and sizes[9] > sizes[1] / 2
    # A replay of the last batch starts from the versions before it.
    before = tables.snapshot()
    tables.publish(10, *({"t": x} for x in tables.upsert("t", rows.schema, batch, replaced, 10)))
    assert tables.snapshot() == before and {r.id: r.payload for r in tables.read("t", rows.schema).collect()} == want
