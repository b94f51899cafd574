"""Staged files: pages, addresses, messages, and the requests that fill them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.functions.keys import batch_file_id
from chartloom.operators.frames import dense_positions, hash_chunk

# Records per staged file, and days an audit row stays.
PAGE_SIZE = 1000
LIVE_DAYS = 365


def assign_pages(
    documents: DataFrame,
    group: list[str],
    key: str,
    page_size: int = PAGE_SIZE,
    chunks: int = 1024,
) -> DataFrame:
    """Spread the rows of every group over pages of at most `page_size` rows, from page 1.

    `chunks` is the number of pieces a group is numbered in; take more for larger groups.
    """
    numbered = dense_positions(documents, group, [key], hash_chunk(key, chunks))
    return numbered.withColumn(
        "page", F.floor((F.col("position") - 1) / page_size).cast("int") + 1
    ).drop("position")


def export_url(server: str, tasks: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Search address of every task (resource_type, start_time, end_time)."""
    return tasks.withColumn(
        "url",
        F.format_string(
            f"{server}/%s?_lastUpdated=ge%s&_lastUpdated=le%s&_count={page_size}",
            "resource_type",
            "start_time",
            "end_time",
        ),
    )


def event_target(events: DataFrame) -> DataFrame:
    """Resource type and address a change event points to, and whether it is an update."""
    parts = F.split("subject", "/")
    return events.select(
        "*",
        F.get(parts, F.size(parts) - 2).alias("resource_type"),
        F.concat(F.lit("https://"), "subject").alias("url"),
        F.coalesce(F.contains("eventType", F.lit("Update")), F.lit(False)).alias("is_update"),
    )


def stage_file_name(url: Column) -> Column:
    """Last three path parts joined by `_`; all parts when there are fewer."""
    parts = F.split(url, "/")
    start = F.greatest(F.size(parts) - 2, F.lit(1))
    return F.array_join(F.slice(parts, start, F.lit(3)), "_")


def stage_resource_type(url: Column) -> Column:
    """Base name up to the first `-`."""
    return F.substring_index(F.substring_index(url, "/", -1), "-", 1)


def stored_path(url: Column) -> Column:
    """Address without its host and container."""
    parts = F.split(url, "/")
    return F.array_join(F.slice(parts, F.lit(5), F.greatest(F.size(parts) - 4, F.lit(0))), "/")


def stage_messages(files: DataFrame, base_url: str, as_of: str) -> DataFrame:
    """Message per staged file (folder, file_name): address, request time, file id."""
    url = F.concat_ws("/", F.lit(base_url), "folder", "file_name")
    return files.withColumn("url", url).withColumns(
        {"request_time": F.lit(as_of), "filepath_id": batch_file_id(F.col("url"))}
    )


def _add(rows: DataFrame, path: str, column: str, job: int | None) -> None:
    """Append rows; those of a numbered job replace what the same job wrote before.

    All writers of a path give a job, or none does.
    """
    if job is None:
        rows.write.mode("append").partitionBy(column).parquet(path)
    else:
        rows.write.mode("overwrite").partitionBy(column).parquet(f"{path}/job={job}")


def append_by_day(rows: DataFrame, path: str, stamp: str, job: int | None = None) -> None:
    """Append audit rows into day folders, gathered by day so that each gets few files.

    Give `job` a number of its own for every run and a repeated run adds nothing twice.
    """
    _add(rows.withColumn("day", F.to_date(stamp)).hint("rebalance", "day"), path, "day", job)


def live_days(rows: DataFrame, as_of: str, days: int = LIVE_DAYS) -> DataFrame:
    """Rows of the day folders still within retention; older folders are not read."""
    return rows.where(F.col("day") > F.date_sub(F.lit(as_of).cast("date"), days))


def write_rejects(rows: DataFrame, path: str, job: int | None = None) -> None:
    """Keep failed rows below a folder per error code; `job` as in `append_by_day`."""
    _add(rows, path, "error_code", job)
