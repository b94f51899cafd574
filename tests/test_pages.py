"""Staged pages: names, replaced files, the read-back check, and what reads them next."""

import os

import pytest
from pyspark.sql import functions as F

from chartloom.operators import errors
from chartloom.session import work_dir
from chartloom.sources import pages, staging


def paged(spark, count, size=3, folder="batch-load/20240201", kind="Patient"):
    rows = spark.range(1, count + 1).selectExpr("id", "concat('{\"id\":', id, '}') AS value")
    rows = rows.withColumns({"folder": F.lit(folder), "resource_type": F.lit(kind)})
    return staging.assign_pages(rows, ["folder", "resource_type"], "id", size)


def names(folder):
    return sorted(
        os.path.relpath(os.path.join(at, f), folder) for at, _, files in os.walk(folder) for f in files
    )


def local(path):
    return path.removeprefix("file:")


def test_pages_have_the_names_that_are_parsed(spark):
    folder = work_dir(spark, "pages")
    rows = paged(spark, 8).unionByName(paged(spark, 2, kind="Group"))
    pages.write_pages(rows, folder)
    at = "batch-load/20240201"
    assert names(local(folder)) == [f"{at}/{n}.ndjson" for n in ("Group-1", "Patient-1", "Patient-2", "Patient-3")]
    staged = pages.read_pages(spark, folder)
    found = staged.select(
        staging.stage_resource_type(F.col("url")), pages.page_number(F.col("url")), staging.stage_file_name(F.col("url"))
    ).distinct()
    assert ("Patient", 3, "batch-load_20240201_Patient-3.ndjson") in [tuple(r) for r in found.collect()]
    assert pages.missing_pages(rows, staged).count() == 0
    failed = staged.withColumn("error_code", F.lit(errors.INSERT_FAILED))
    assert errors.retry_eligible(failed).count() == 10


def test_a_repeated_job_replaces_its_pages_and_leaves_other_folders(spark):
    folder = work_dir(spark, "pages")
    pages.write_pages(paged(spark, 20), folder)
    pages.write_pages(paged(spark, 4, folder="event-load/p1"), folder)
    again = paged(spark, 5)
    pages.write_pages(again, folder)
    assert names(local(folder)) == [
        "batch-load/20240201/Patient-1.ndjson", "batch-load/20240201/Patient-2.ndjson",
        "event-load/p1/Patient-1.ndjson", "event-load/p1/Patient-2.ndjson",
    ]
    staged = pages.read_pages(spark, folder)
    assert pages.missing_pages(again, staged.where("page_file LIKE 'batch%'")).count() == 0


def test_read_back_tells_lost_cut_and_foreign_pages(spark):
    folder = work_dir(spark, "pages")
    rows = paged(spark, 9)
    pages.write_pages(rows, folder)
    at = f"{local(folder)}/batch-load/20240201"
    with open(f"{at}/Patient-2.ndjson", "w") as file:
        file.write("{}\n")
    with open(f"{at}/Patient-9.ndjson", "w") as file:
        file.write("{}\n")
    lost = rows.unionByName(paged(spark, 1, kind="Group"))
    found = {tuple(r) for r in pages.missing_pages(lost, pages.read_pages(spark, folder)).collect()}
    at = "batch-load/20240201"
    assert found == {(f"{at}/Patient-2.ndjson", 3, 1), (f"{at}/Patient-9.ndjson", None, 1), (f"{at}/Group-1.ndjson", 1, None)}


def test_a_failed_task_leaves_no_half_page(spark):
    folder = work_dir(spark, "pages")
    rows = paged(spark, 9)
    broken = rows.withColumn("value", F.when(F.col("id") == 5, F.raise_error(F.lit("lost"))).otherwise(F.col("value")))
    with pytest.raises(Exception, match="lost"):
        pages.write_pages(broken, folder)
    assert not [n for n in names(local(folder)) if not n.rpartition("/")[2].startswith("_") and "Patient-2" in n]
    pages.write_pages(rows, folder)
    assert pages.missing_pages(rows, pages.read_pages(spark, folder)).count() == 0


def test_no_rows_and_null_lines(spark):
    folder = work_dir(spark, "pages")
    pages.write_pages(paged(spark, 3).withColumn("value", F.expr("if(id = 2, null, value)")), folder)
    assert pages.read_pages(spark, folder).count() == 2
    pages.write_pages(paged(spark, 3).where("false"), folder)
    assert pages.read_pages(spark, folder).count() == 2
