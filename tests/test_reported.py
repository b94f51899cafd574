"""What an ingest reports of bad lines and of steps that fail."""

import pytest
from pyspark.sql import functions as F

from chartloom.operators import errors, lineage
from chartloom.operators.published import TableSet
from chartloom.plans import ingest as ingests
from chartloom.plans.ingest import Ingest, StepFailed, ingest
from chartloom.plans.reported import GOOD, reported_ingest
from chartloom.session import work_dir

AS_OF = "2024-01-01 00:00:00"
A, B = (f"https://h/c/batch-load/{n}/Patient-1.ndjson" for n in "ab")


def new_run(spark, catalog):
    work = work_dir(spark, "reported")
    return Ingest("Patient", catalog, TableSet(spark, f"{work}/tables"), f"{work}/runs", AS_OF), f"{work}/rejects"


def patient(number):
    return f'{{"id": "p{number}", "meta": {{"versionId": "1"}}}}'


@pytest.fixture
def two_files(spark):
    """File a with a good line, a cut one, a blank one and one of a wrong shape; file b with good lines."""
    rows = [(patient(1), A), ('{"id": "p', A), (" ", A), ('{"id": "p2", "shoeSize": 4}', A), (patient(3), B), (patient(4), B)]
    return spark.createDataFrame(rows, "value string, url string")


def halves(report):
    rows = lineage.merge_halves(report.first, report.second, AS_OF).collect()
    return sorted((r.fhir_request_url, r.record_count, r.is_inserted, r.error_code, r.reject_location) for r in rows)


def codes(spark, rejects):
    rows = spark.read.option("basePath", rejects).parquet(rejects).groupBy("error_code").count().collect()
    return {str(r["error_code"]): r["count"] for r in rows}


def test_bad_lines_are_counted_kept_and_told_by_file(spark, catalog, two_files):
    run, rejects = new_run(spark, catalog)
    for _ in range(2):
        report = reported_ingest(spark, two_files, run, 1, rejects)
        assert report.counts == {GOOD: 3, "601": 1, "602": 1} and report.cause is None
        assert codes(spark, rejects) == {"601": 1, "602": 1}
    assert halves(report) == [
        (A, 3, False, "602", "602/batch-load/a/Patient-1.ndjson"),
        (B, 2, True, None, None),
    ]
    assert run.read("patient").count() == 3 and report.audit.count() == 3


def lost(*_, **__):
    raise RuntimeError("lost")


def unreadable(rows):
    return rows.withColumn("id", F.raise_error(F.lit("no space")).cast("string"))


@pytest.mark.parametrize("step, code", [("resource_table", "603"), ("normalize", "602")])
def test_a_failing_step_gives_its_code_to_the_good_lines(spark, catalog, two_files, monkeypatch, step, code):
    run, rejects = new_run(spark, catalog)
    assert run.schemas
    whole = getattr(ingests, step)
    monkeypatch.setattr(ingests, step, lambda *given: unreadable(whole(*given)))
    report = reported_ingest(spark, two_files, run, 1, rejects)
    bad = {"601": 1, "602": 1}
    expected = {**bad, code: 3 + bad.get(code, 0)}
    assert report.audit is None and "no space" in report.cause
    assert report.counts == expected == codes(spark, rejects)
    assert [h[2:4] for h in halves(report)] == [(False, max("602", code)), (False, code)]
    assert run.read("patient").count() == 0
    monkeypatch.setattr(ingests, step, whole)
    assert reported_ingest(spark, two_files, run, 1, rejects).counts == {GOOD: 3, **bad}
    assert run.read("patient").count() == 3 and codes(spark, rejects) == bad


def test_an_unknown_failure_is_699_for_every_line(spark, catalog, two_files, monkeypatch):
    run, rejects = new_run(spark, catalog)
    monkeypatch.setattr(run.tables, "snapshot", lost)
    report = reported_ingest(spark, two_files, run, 1, rejects)
    assert report.counts == {"699": 5} == codes(spark, rejects) and report.cause == "lost"
    assert halves(report) == [(u, n, False, "699", f"699/batch-load/{f}/Patient-1.ndjson") for u, n, f in ((A, 3, "a"), (B, 2, "b"))]


def test_files_that_cannot_be_read_are_601(spark, catalog, two_files):
    run, rejects = new_run(spark, catalog)
    at = work_dir(spark, "gone")
    two_files.write.parquet(at)
    found = spark.read.parquet(at)
    broken = found.withColumn("value", F.when(F.col("url") == B, F.raise_error(F.lit("gone"))).otherwise(F.col("value")))
    for load in (lambda: ingest(spark, broken, run, 1), lambda: reported_ingest(spark, broken, run, 1, rejects)):
        with pytest.raises(StepFailed) as failure:
            load()
        assert failure.value.code == errors.READ_FAILED


def test_no_lines(spark, catalog, two_files):
    run, rejects = new_run(spark, catalog)
    report = reported_ingest(spark, two_files.where("false"), run, 1, rejects)
    assert report.counts == {} and report.first.count() == 0 and report.second.count() == 0


def test_codes_by_the_steps_that_were_passed(spark):
    rows = spark.sql("""SELECT * FROM VALUES (1, false, null, null), (2, true, false, null), (3, true, true, false),
        (4, true, true, null), (5, true, true, true) AS t(k, read, shaped, inserted)""")
    code = errors.outcome_code(F.col("read"), F.col("shaped"), F.col("inserted"))
    assert [r[0] for r in rows.orderBy("k").select(code).collect()] == ["601", "602", "603", "699", None]


def test_several_outcomes_of_a_file_give_one_second_half(spark):
    audit = spark.sql("SELECT * FROM VALUES ('a'), ('a'), ('b'), ('c') AS t(filepath_id)")
    outcomes = spark.sql("""SELECT * FROM VALUES ('a', true, null, null, null), ('a', false, 1, '602', 'x'),
        ('a', false, 2, '602', 'y'), ('b', true, null, null, null)
        AS t(filepath_id, is_inserted, retry_count, error_code, reject_location)""")
    rows = {r.filepath_id: tuple(r)[1:] for r in lineage.second_half(audit, outcomes).collect()}
    nothing = (None, None, None)
    assert rows == {"a": (False, 2, "602", "y"), "b": (True, *nothing), "c": (None, *nothing)}
