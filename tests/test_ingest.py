"""Batches and streams into the published tables."""

import json
import os

import pytest
from pyspark.sql import functions as F

from chartloom.operators.published import TableSet
from chartloom.plans.ingest import Ingest, ingest
from chartloom.session import work_dir
from chartloom.streaming import jobs

AS_OF = "2024-01-01 00:00:00"


def patient(number, version, concepts=1, **more):
    coding = [{"code": f"c{i}"} for i in range(concepts)]
    document = {"id": f"p{number}", "meta": {"versionId": str(version)}, **more}
    return {**document, "maritalStatus": {"coding": coding}} if concepts else document


def new_run(spark, catalog, name, resource="Patient"):
    work = work_dir(spark, name)
    return Ingest(resource, catalog, TableSet(spark, f"{work}/tables"), f"{work}/runs", AS_OF)


def operations(audit):
    return sorted((r.resource_id, r.meta_versionid, r.operation) for r in audit.collect())


def concepts_of(run):
    rows = run.read("patient_codeableconcept").collect()
    return sorted((r.id, r.seq_no, r.code) for r in rows)


def test_replaying_a_batch_changes_nothing_and_is_all_duplicate(spark, catalog, lines):
    run = new_run(spark, catalog, "replay")
    batch = lines(patient(1, 1), patient(2, 3), url="s/Patient-1.ndjson")
    first = ingest(spark, batch, run, 1)
    assert operations(first) == [("p1", 1, "new"), ("p2", 3, "new")]
    before = concepts_of(run)
    again = ingest(spark, batch, run, 2)
    assert {r.operation for r in again.collect()} == {"duplicate"}
    assert concepts_of(run) == before and run.read("patient").count() == 2


def test_update_replaces_shared_rows_also_when_none_are_left(spark, catalog, lines):
    run = new_run(spark, catalog, "update")
    ingest(spark, lines(patient(1, 1, 3), patient(2, 1, 2), url="u"), run, 1)
    ingest(spark, lines(patient(1, 2, 1), patient(2, 2, 0), url="u"), run, 2)
    assert concepts_of(run) == [("p1", 0, "c0")]


def test_same_id_twice_in_a_batch_keeps_the_highest_version(spark, catalog, lines):
    run = new_run(spark, catalog, "twice")
    audit = ingest(spark, lines(patient(1, 2, gender="male"), patient(1, 1), url="u"), run, 1)
    assert len(operations(audit)) == 2
    rows = run.read("patient").collect()
    assert [(r.id, r.meta_versionid, r.gender) for r in rows] == [("p1", "2", "male")]


def test_empty_batch_keeps_the_tables(spark, catalog, lines):
    run = new_run(spark, catalog, "empty")
    ingest(spark, lines(patient(1, 1), url="u"), run, 1)
    assert ingest(spark, lines(patient(1, 1), url="u").where("false"), run, 2).count() == 0
    assert run.read("patient").count() == 1


def test_failed_batch_stays_invisible_and_can_be_repeated(spark, catalog, lines, monkeypatch):
    run = new_run(spark, catalog, "failed")
    ingest(spark, lines(patient(1, 1), url="u"), run, 1)
    second = lines(patient(1, 2, 2), url="u")

    def broken(*_):
        raise RuntimeError("lost the driver before publishing")

    with monkeypatch.context() as patched:
        patched.setattr(run.tables, "publish", broken)
        try:
            ingest(spark, second, run, 2)
        except RuntimeError:
            pass
    assert [r.meta_versionid for r in run.read("patient").collect()] == ["1"]
    assert concepts_of(run) == [("p1", 0, "c0")]
    assert operations(ingest(spark, second, run, 2)) == [("p1", 2, "update")]
    # The same batch once more, as after a crash between publishing and the checkpoint.
    assert operations(ingest(spark, second, run, 2)) == [("p1", 2, "update")]
    assert concepts_of(run) == [("p1", 0, "c0"), ("p1", 1, "c1")]


def test_only_touched_buckets_are_rewritten(spark, catalog, lines):
    run = new_run(spark, catalog, "buckets")
    ingest(spark, lines(*[patient(i, 1) for i in range(40)], url="u"), run, 1)
    ingest(spark, lines(patient(7, 2), url="u"), run, 2)
    versions = [v for (table, _), v in run.tables.snapshot().items() if table == "patient"]
    assert versions.count((1, 2)) == 1 and versions.count((1,)) == len(versions) - 1 and run.read("patient").count() == 40


def test_first_version_event_is_new_without_a_lookup(spark, catalog, lines):
    run = new_run(spark, catalog, "event")
    url = "s/event-load/p1/Patient-1.ndjson"
    ingest(spark, lines(patient(1, 1), url=url), run, 1)
    assert operations(ingest(spark, lines(patient(1, 1), url=url), run, 2)) == [("p1", 1, "new")]
    assert concepts_of(run) == [("p1", 0, "c0")]
    assert operations(ingest(spark, lines(patient(1, 3), url=url), run, 3)) == [("p1", 3, "update")]


def test_streamed_files_give_what_one_batch_gives(spark, catalog, lines, tmp_path):
    run = new_run(spark, catalog, "stream")
    stage, work = tmp_path / "stage", work_dir(spark, "stream-work")
    stage.mkdir()
    versions = [[(i, 1) for i in range(10)], [(i, 2) for i in range(5)], [(i, 1) for i in range(5)]]
    for number, rows in enumerate(versions):
        text = "\n".join(json.dumps(patient(i, v, v)) for i, v in rows)
        (stage / f"Patient-{number}.ndjson").write_text(text)
        jobs.ingest_stream(spark, jobs.line_stream(spark, str(stage), 1), run, work)
    loaded = {r.id: r.meta_versionid for r in run.read("patient").collect()}
    assert loaded == {f"p{i}": "2" if i < 5 else "1" for i in range(10)}
    assert run.read("patient_codeableconcept").count() == 15
    audit = spark.read.parquet(f"{work}/audit").groupBy("batch", "operation").count().collect()
    assert {(r.batch, r.operation): r["count"] for r in audit} == {
        (0, "new"): 10, (1, "update"): 5, (2, "duplicate"): 5,
    }


def write_messages(spark, folder, name, rows, schema):
    frame = spark.createDataFrame(rows, schema).coalesce(1)
    frame.write.mode("append").parquet(f"{folder}/{name}")


def message_stream(spark, folder, schema):
    return (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", 1)
        .parquet(folder)
    )


def test_redelivery_takes_up_what_waited(spark, tmp_path):
    schema = "id int, not_before timestamp"
    stamp = "timestamp'2024-01-0{}'"
    work = work_dir(spark, "redelivery")
    for number, days in enumerate([(1, 3), (2, 5)]):
        rows = spark.sql(
            " UNION ALL ".join(f"SELECT {d} AS id, {stamp.format(d)} AS not_before" for d in days)
        )
        rows.coalesce(1).write.parquet(f"{tmp_path}/m{number}")
        stream = message_stream(spark, str(tmp_path), schema)
        jobs.redelivery_stream(stream, work, lambda n: f"2024-01-0{2 * n + 2} 00:00:00")
    rows = spark.read.parquet(f"{work}/delivered").collect()
    assert sorted((r.batch, r.id) for r in rows) == [(0, 1), (1, 2), (1, 3)]
    states = jobs.redelivered(spark, work).select("state", "id").collect()
    assert sorted(map(tuple, states)) == [("due", 1), ("due", 2), ("due", 3), ("waiting", 5)]


@pytest.mark.parametrize("buckets", [1, 64])
def test_lineage_halves_meet_over_batches(spark, tmp_path, buckets):
    schema = (
        "filepath_id string, message_no long, pipeline_type string, record_count int, "
        "is_inserted boolean, retry_count int, error_code string, reject_location string"
    )
    work = work_dir(spark, "halves")
    tables = TableSet(spark, f"{work}/tables", key="filepath_id", buckets=buckets)
    first = ("b", 2, "batch-load-exporter", 9, None, None, None, None)
    batches = [
        [("a", 1, None, None, False, 1, "603", "603/x"), first, ("c", 5, None, None, True, 0, None, None)],
        [("d", 6, None, None, True, 0, None, None)],
        [("a", 7, "batch-load-exporter", 5, None, None, None, None), ("d", 8, None, None, False, 1, "699", None)],
        [("a", 9, None, None, True, 2, None, None)],
    ]
    for number, rows in enumerate(batches):
        write_messages(spark, tmp_path, f"m{number}", rows, schema)
        jobs.lineage_stream(message_stream(spark, str(tmp_path), schema), tables, work)
    state = jobs.rescheduled(tables.read("lineage", jobs.LINEAGE_STATE), len(batches))
    found = {
        r.filepath_id: (r.state, r.record_count, r.is_inserted, r.error_code, r.reschedule_count)
        for r in state.select("*", jobs.lineage_state()).collect()
    }
    assert found == {
        "a": ("complete", 5, True, None, 2), "b": ("open", 9, None, None, 0),
        "c": ("waiting", None, True, None, 4), "d": ("waiting", None, False, "699", 3),
    }


def test_latest_version_over_batches(spark, tmp_path):
    schema = "id string, meta_versionid int, meta_lastupdated string, payload string"
    work = work_dir(spark, "latest")
    tables = TableSet(spark, f"{work}/tables", buckets=4)
    batches = [
        [("a", 1, "t1", "a1"), ("a", 3, "t3", "a3"), ("b", 1, "t1", "b1")],
        [("a", 2, "t9", "a2"), ("b", 2, "t2", "b2")],
    ]
    for number, rows in enumerate(batches):
        write_messages(spark, tmp_path, f"m{number}", rows, schema)
        stream = message_stream(spark, str(tmp_path), schema)
        jobs.latest_version_stream(stream, tables, "newest", stream.schema, work)
    rows = tables.read("newest", stream.schema).collect()
    assert sorted(r.payload for r in rows) == ["a3", "b2"]


def test_disposition_counts_and_flags(spark):
    from chartloom.operators.errors import pull_disposition

    rows = [("e", None, None), ("e", 2, None), ("e", 2, True), ("b", None, False)]
    messages = spark.createDataFrame(rows, "k string, retry_count int, retry_message boolean")
    source = F.when(F.col("k") == "e", "event-load-exporter").otherwise("batch-load-exporter")
    routed = pull_disposition(messages.withColumn("application_name", source), 3, 5).collect()
    assert [(r.disposition, r.retry_count, r.retry_message) for r in routed] == [
        ("event_queue", 1, None),
        ("retry_queue", None, True),
        ("failure_area", 3, None),
        ("parameter_queue", 1, False),
    ]


def test_a_table_streams_from_one_file_or_from_a_folder(spark, sf_dir, tmp_path):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    events.repartition(3, "event_id").write.parquet(f"{tmp_path}/events.parquet")
    for folder, batches in ((sf_dir, 1), (str(tmp_path), 3)):
        counts = []
        jobs.drain(
            jobs.table_stream(spark, folder, "events", 1),
            work_dir(spark, "files"),
            lambda batch, number, counts=counts: counts.append(batch.count()),
        )
        assert len(counts) == batches and sum(counts) == events.count()


def test_given_file_id_and_single_identifier(spark, lines):
    from chartloom.catalog import Catalog

    small = Catalog.builtin()
    encounter = small.resources["Encounter"]
    one = [e if e.name != "identifier" else type(e)(e.owner, e.name, e.fhir_type, False) for e in encounter]
    run = new_run(spark, Catalog({"Encounter": one}, small.datatypes), "single", "Encounter")
    document = {"id": "e1", "identifier": {"system": "urn:Source", "value": "north"}}
    audit = ingest(spark, lines(document, url="u", filepath_id="given"), run, 1).first()
    assert (audit.meta_source, audit.filepath_id, audit.meta_versionid) == ("north", "given", 0)
    assert run.read("encounter_identifier").first().value == "north"


def test_bad_lines_are_rejected_and_the_rest_of_the_file_loads(spark, catalog, lines):
    run = new_run(spark, catalog, "rejects")
    texts = [patient(1, 1), '{"id": "p2", "meta": {"versionId"', "  ", {**patient(3, 1), "shoeSize": 4}]
    audit = ingest(spark, lines(*texts, {"meta": {}}, url="s/Patient-1.ndjson"), run, 1)
    assert operations(audit) == [("p1", 1, "new")]
    assert [r.id for r in run.read("patient").collect()] == ["p1"]
    rejected = sorted((r.error_code, r.unknown_elements or []) for r in run.rejected(1).collect())
    assert rejected == [("601", []), ("602", []), ("602", ["shoeSize"])]


def test_types_of_one_set_number_their_batches_themselves(spark, catalog, lines):
    run = new_run(spark, catalog, "types")
    other = Ingest("Encounter", catalog, run.tables, f"{run.work}/encounters", AS_OF)
    ingest(spark, lines(patient(1, 1), url="u"), run, 1)
    ingest(spark, lines({"id": "e1", "meta": {"versionId": "1"}}, url="u"), other, 1)
    ingest(spark, lines(patient(2, 1), url="u"), run, 2)
    assert run.read("patient").count() == 2 and other.read("encounter").count() == 1


def test_versions_beyond_four_bytes_are_kept(spark, catalog, lines):
    run = new_run(spark, catalog, "long")
    ingest(spark, lines(patient(1, 20240101120000), url="u"), run, 1)
    again = ingest(spark, lines(patient(1, 4294967296), url="u"), run, 2)
    assert operations(again) == [("p1", 4294967296, "duplicate")]


EVENT = "subject string, eventType string"


def test_events_of_several_types_are_loaded_and_the_others_get_a_disposition(spark, catalog, tmp_path):
    run, work = new_run(spark, catalog, "events"), work_dir(spark, "events-work")
    other = Ingest("Encounter", catalog, run.tables, f"{run.work}/encounters", AS_OF)
    server = TableSet(spark, f"{work}/server")
    visit = {"id": "e1", "meta": {"versionId": "1"}, "status": "planned"}
    served = {"Patient": ("p1", patient(1, 1)), "Encounter": ("e1", visit)}
    document = "id string, value string"
    rows = {t: spark.createDataFrame([(i, json.dumps(d))], document) for t, (i, d) in served.items()}
    jobs.serve(server, rows, 1)
    batches = [["Patient/p1", "Encounter/e1", "Patient/p1"], ["Patient/p2", "Encounter/e9"], ["Group/p1"]]
    for number, names in enumerate(batches):
        write_messages(spark, tmp_path, f"m{number}", [(f"h/{n}", "Created") for n in names], EVENT)
        jobs.event_stream(spark, message_stream(spark, str(tmp_path), EVENT), server, [run, other], work)
    missed = spark.read.parquet(f"{work}/unfetched")
    missed = missed.select("resource_type", "id", "reason", "disposition", "retry_count", "delay_minutes").collect()
    assert sorted(map(tuple, missed), key=str) == [
        ("Encounter", "e9", "not_found", "event_queue", 1, 5),
        ("Group", "p1", "other_type", "failure_area", 1, None),
        ("Patient", "p2", "not_found", "event_queue", 1, 5),
    ]
    assert run.read("patient").count() == 1 and run.read("patient_codeableconcept").count() == 1
    assert [r.status for r in other.read("encounter").collect()] == ["planned"]


def test_a_missed_event_that_was_tried_often_goes_to_the_retry_queue(spark, catalog, tmp_path):
    run, work = new_run(spark, catalog, "tried"), work_dir(spark, "tried-work")
    schema = f"{EVENT}, retry_count int, retry_message boolean"
    events = [("h/Patient/a", "Created", 2, None), ("h/Patient/b", "Created", 1, True), ("h/Patient/c", "Created", None, None)]
    write_messages(spark, tmp_path, "m", events, schema)
    server = TableSet(spark, f"{work}/server")
    jobs.event_stream(spark, message_stream(spark, str(tmp_path), schema), server, [run], work)
    missed = spark.read.parquet(f"{work}/unfetched").select("id", "disposition").collect()
    assert sorted(map(tuple, missed)) == [("a", "retry_queue"), ("b", "failure_area"), ("c", "event_queue")]


def test_documents_are_fetched_from_the_buckets_of_their_ids(spark, capsys):
    server = TableSet(spark, work_dir(spark, "server"), buckets=16)
    documents = spark.range(200).selectExpr("concat('p', id) AS id", "string(id) AS value")
    jobs.serve(server, {"Patient": documents}, 1)
    jobs.serve(server, {"Patient": spark.sql("SELECT 'p7' AS id, 'newer' AS value")}, 2)
    wanted = spark.sql("SELECT 'p7' AS id")
    found = jobs.fetch(server, "Patient", wanted)
    assert [tuple(r) for r in found.collect()] == [("p7", "newer")]
    (bucket,) = server.of("patient").touched(wanted)
    read = server.of("patient").read("patient", jobs.DOCUMENT, {bucket})
    assert 0 < read.count() < 60
    found.explain()
    plan = capsys.readouterr().out
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan


def test_waiting_messages_are_told_once_over_batches(spark, tmp_path):
    schema, work = "k string, not_before timestamp", work_dir(spark, "waiting")
    for number, day in enumerate(("2024-01-01", "2024-01-03", "2024-01-09")):
        row = spark.sql(f"SELECT 'k{number}' AS k, timestamp'{day}' AS not_before").first()
        write_messages(spark, tmp_path, f"m{number}", [tuple(row)], schema)
        stream = message_stream(spark, str(tmp_path), schema)
        jobs.redelivery_stream(stream, work, lambda batch: f"2024-01-0{batch + 1} 12:00:00")
    found = jobs.redelivered(spark, work).select("k", "state").collect()
    assert sorted(map(tuple, found)) == [("k0", "due"), ("k1", "due"), ("k2", "waiting")]


def stored_files(path):
    path = path.removeprefix("file:")
    return {os.path.join(at, f): os.stat(os.path.join(at, f)).st_mtime_ns for at, _, fs in os.walk(path) for f in fs}


def test_waiting_messages_leave_by_time_alone_and_once(spark, tmp_path):
    schema, work = "k string, not_before timestamp", work_dir(spark, "by-time")
    rows = spark.sql("""SELECT * FROM VALUES ('a', timestamp'2024-01-01'), ('b', timestamp'2024-01-02 12:00:00'),
        ('c', timestamp'2024-01-02 12:30:00'), ('d', timestamp'2024-01-05'), ('e', null) AS t(k, not_before)""")
    rows.coalesce(1).write.parquet(f"{tmp_path}/m")
    times = ("2024-01-01", "2024-01-02 12:00:00", "2024-01-02 12:00:00", "2024-01-02 11:00:00", "2024-01-03")
    waiting = None
    for number in range(len(times)):
        jobs.redelivery_stream(message_stream(spark, str(tmp_path), schema), work, lambda n: times[n])
        now = {f: at for f, at in stored_files(f"{work}/waiting").items() if f.endswith(".parquet")}
        assert waiting in (None, now), "a batch without new messages writes none"
        waiting = now
    rows = spark.read.parquet(f"{work}/delivered").collect()
    assert sorted((r.batch, r.k) for r in rows) == [(0, "a"), (0, "e"), (1, "b"), (4, "c")]
    left = jobs.redelivered(spark, work).where("state = 'waiting'").collect()
    assert [r.k for r in left] == ["d"]


def test_a_replayed_delivery_keeps_its_time(spark, tmp_path):
    schema, work = "k string, not_before timestamp", work_dir(spark, "replayed")
    spark.sql("SELECT 'a' AS k, timestamp'2024-01-02' AS not_before").write.parquet(f"{tmp_path}/m")
    jobs.redelivery_stream(message_stream(spark, str(tmp_path), schema), work, lambda n: "2024-01-01")
    jobs.redelivery_stream(message_stream(spark, str(tmp_path), schema), work, lambda n: "2024-01-03")
    # As after a crash between the output of the second batch and its commit.
    os.remove(f"{work.removeprefix('file:')}/checkpoint/commits/1")
    checksum = f"{work.removeprefix('file:')}/checkpoint/commits/.1.crc"
    if os.path.exists(checksum):
        os.remove(checksum)
    jobs.redelivery_stream(message_stream(spark, str(tmp_path), schema), work, lambda n: "2024-01-01 01:00:00")
    delivered = spark.read.parquet(f"{work}/delivered").collect()
    assert [(r.k, r.batch) for r in delivered] == [("a", 1)]
