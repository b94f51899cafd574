"""Where failed messages and files go, and what may be tried again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.operators.frames import dense_positions
from chartloom.sources.staging import stage_file_name, stored_path

# Codes of the ingesting side, and names of the exporting jobs.
READ_FAILED, SHAPE_FAILED, INSERT_FAILED, UNEXPECTED = "601", "602", "603", "699"
RETRYABLE = (SHAPE_FAILED, INSERT_FAILED)
EVENT_EXPORTER, BATCH_EXPORTER = "event-load-exporter", "batch-load-exporter"


def pull_disposition(messages: DataFrame, max_retries: int, delay_minutes: int) -> DataFrame:
    """Next stop of a message whose download failed.

    A message that came from the retry queue fails for good. One that used up its tries
    moves to the retry queue, flagged and with its count cleared. All others go back to
    where they came from, event messages after a delay.
    """
    count = F.coalesce("retry_count", F.lit(0)) + 1
    flagged = F.coalesce("retry_message", F.lit(False))
    from_events = F.col("application_name") == EVENT_EXPORTER
    disposition = (
        F.when(flagged, "failure_area")
        .when(count == max_retries, "retry_queue")
        .when(from_events, "event_queue")
        .otherwise("parameter_queue")
    )
    routed = messages.withColumns({"retry_count": count, "disposition": disposition})
    to_retry = F.col("disposition") == "retry_queue"
    source = F.when(from_events, EVENT_EXPORTER).otherwise(BATCH_EXPORTER)
    return routed.withColumns(
        {
            "retry_count": F.when(~to_retry, F.col("retry_count")),
            "retry_message": F.when(to_retry, True).when(
                F.col("disposition") != "failure_area", F.col("retry_message")
            ),
            "application_name": F.when(to_retry, source).otherwise(F.col("application_name")),
            "delay_minutes": F.when(F.col("disposition") == "event_queue", delay_minutes),
        }
    )


def read_disposition(messages: DataFrame, max_retries: int) -> DataFrame:
    """A file that cannot be read is requeued until its tries are used up."""
    count = F.coalesce("retry_count", F.lit(0)).cast("int") + 1
    used_up = count >= max_retries
    return messages.withColumns(
        {
            "retry_count": count,
            "disposition": F.when(used_up, "failure_area").otherwise("requeue"),
            "error_code": F.when(used_up, READ_FAILED),
        }
    )


def event_failure_path(code: Column, event_time: Column, resource_id: Column) -> Column:
    moment = F.try_to_timestamp(F.substring(event_time, 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    stamp = F.date_format(moment, "yyyyMMdd'T'HHmmss")
    return F.format_string("%s/%s/%s.json", code, stamp, resource_id)


def batch_failure_path(code: Column, end: Column, resource_type: Column, page: Column) -> Column:
    stamp = F.translate(end, "-:", "")
    page = F.coalesce(page, F.lit(0))
    return F.format_string("%s/%s/%s-%d.json", code, stamp, resource_type, page)


def file_failure_path(code: Column, url: Column) -> Column:
    """The last two parts of the address, cut at `/` and at `_`."""
    parts = F.split(F.translate(url, "/", "_"), "_")
    last = F.get(parts, F.size(parts) - 1)
    before = F.get(parts, F.size(parts) - 2)
    return F.when(F.size(parts) > 2, F.concat_ws("/", code, before, last)).otherwise(
        F.concat_ws("/", code, last)
    )


def failure_path(messages: DataFrame) -> DataFrame:
    """Failure-area path by kind of message."""
    code = F.col("error_code")
    path = (
        F.when(
            F.col("application_name") == EVENT_EXPORTER,
            event_failure_path(code, F.col("event_time"), F.col("resource_id")),
        )
        .when(
            F.col("end_time").isNotNull(),
            batch_failure_path(
                code, F.col("end_time"), F.col("resource_type"), F.col("page_number")
            ),
        )
        .otherwise(file_failure_path(code, F.col("url")))
    )
    return messages.withColumn("failure_path", path)


def without_code(path: Column) -> Column:
    """Path without the three-digit code of an earlier failure."""
    return F.regexp_replace(path, r"^\d{3}(/|$)", "")


def reject_location(code: Column, url: Column) -> Column:
    """Where a failed file is kept: its stored path below the new code."""
    return F.concat_ws("/", code, without_code(stored_path(url)))


def retry_eligible(messages: DataFrame) -> DataFrame:
    """Messages whose file may be tried again: right code, and not split before."""
    base = F.substring_index("url", "/", -1)
    dashes = F.length(base) - F.length(F.replace(base, F.lit("-"), F.lit("")))
    return messages.where(F.col("error_code").isin(*RETRYABLE) & (dashes == 1))


def retry_split(
    records: DataFrame, order: str, base_url: str, pieces: int = 256
) -> DataFrame:
    """One file per record of a failed file, numbered from 1 in file order.

    A file is numbered in pieces between quantiles of `order`, so the pieces are alike however
    the numbers lie. `record_url` is where that file is staged: below the folder the failed
    file came from.
    """
    shares = F.array(*[F.lit(i / pieces) for i in range(1, pieces)]) if pieces > 1 else F.array(F.lit(1.0))
    bounds = records.groupBy(F.col("url").alias("_url")).agg(
        F.percentile_approx(order, shares, F.lit(40 * pieces)).alias("_bounds")
    )
    placed = records.join(bounds, F.col("url").eqNullSafe(F.col("_url")))
    below = F.size(F.filter("_bounds", lambda bound: bound < F.col(order)))
    cut = placed.select(*records.columns, below.alias("_piece"))
    numbered = dense_positions(cut, ["url"], [order], F.col("_piece"), "record_no").drop("_piece")
    # A folder name may hold several levels, joined by `_`.
    parts = F.split(F.translate(stage_file_name(F.col("url")), "_", "/"), "/")
    folder = F.array_join(F.slice(parts, F.lit(1), F.lit(2)), "/")
    base = F.regexp_replace(F.element_at(parts, -1), r"\.ndjson$", "")
    name = F.concat(base, F.lit("-"), F.col("record_no").cast("string"), F.lit(".ndjson"))
    return numbered.withColumns(
        {"record_file": name, "record_url": F.concat_ws("/", F.lit(base_url), folder, name)}
    )


def outcome_code(read: Column, shaped: Column, inserted: Column) -> Column:
    """Error code of a row from the steps it passed; null steps were never reached."""
    return (
        F.when(~read, READ_FAILED)
        .when(~shaped, SHAPE_FAILED)
        .when(~inserted, INSERT_FAILED)
        .when(read.isNull() | shaped.isNull() | inserted.isNull(), UNEXPECTED)
    )
