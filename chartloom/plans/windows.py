"""Sync planning: which time windows to pull next, and the tasks they give."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.operators.frames import explode_present

SECOND = "yyyy-MM-dd'T'HH:mm:ss"
LOG = "since_date_time timestamp, till_date_time timestamp, created_date timestamp, cycle int"


def _seconds(moment: Column) -> Column:
    return F.unix_timestamp(moment)


def _later(moment: Column, seconds: Column) -> Column:
    return F.timestamp_seconds(_seconds(moment) + seconds)


def plan_windows(schedules: DataFrame, interval: int, multiplier: int, max_cycles: int) -> DataFrame:
    """Windows due for every schedule row (last, end, now), as window_start and window_end.

    With exactly one interval of lag the window is one interval long. With more lag there
    are catch-up windows of `interval * multiplier` minutes, as many as fit into the lag and
    at most `max_cycles`; a lag too short for one of them gives none. No window passes the
    end.
    """
    lag = F.floor((_seconds(F.col("now")) - _seconds(F.col("last"))) / 60)
    steps = F.floor(lag / interval)
    catch_up = F.least(F.floor(steps * interval / (interval * multiplier)), F.lit(max_cycles))
    in_sync = steps == 1
    count = (
        F.when((F.col("last") >= F.col("end")) | (steps < 1), 0)
        .when(in_sync, 1)
        .otherwise(catch_up)
        .cast("int")
    )
    step = F.when(in_sync, interval * 60).otherwise(interval * multiplier * 60)
    planned = schedules.withColumn("_step", step).withColumn(
        "_cycles", F.when(count > 0, F.sequence(F.lit(0), count - 1))
    )
    start = _later(F.col("last"), F.col("cycle") * F.col("_step"))
    return (
        explode_present(planned, "_cycles", "cycle")
        .withColumn("window_start", start)
        .where(F.col("window_start") < F.col("end"))
        .withColumn(
            "window_end",
            F.least(_later(F.col("window_start"), F.col("_step")), F.col("end")),
        )
        .drop("_step")
    )


def sync_watermark(log: DataFrame, start: str) -> DataFrame:
    """End of the latest window, or the configured start before the first one."""
    latest = F.max("till_date_time")
    return log.agg(F.coalesce(latest, F.lit(start).cast("timestamp")).alias("last"))


def sync_watermark_by_type(log: DataFrame, types: DataFrame, start: str) -> DataFrame:
    """The same for every listed resource type, also those never pulled."""
    latest = log.groupBy("resource_type").agg(F.max("till_date_time").alias("till"))
    return types.join(latest, "resource_type", "left").select(
        "resource_type", F.coalesce("till", F.lit(start).cast("timestamp")).alias("last")
    )


def sync_log(windows: DataFrame, as_of: str) -> DataFrame:
    """Log rows of planned windows."""
    return windows.select(
        F.col("window_start").alias("since_date_time"),
        F.col("window_end").alias("till_date_time"),
        F.lit(as_of).cast("timestamp").alias("created_date"),
    )


def append_sync_log(rows: DataFrame, path: str, cycle: int) -> None:
    """Add the log rows of one sync cycle; a repeated cycle replaces its own rows."""
    rows.write.mode("overwrite").parquet(f"{path}/cycle={cycle}")


def read_sync_log(spark: SparkSession, path: str) -> DataFrame:
    """Log rows of all cycles so far, none before the first one."""
    try:
        return spark.read.schema(LOG).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LOG)


def sync_cycle(
    spark: SparkSession, path: str, cycle: int, start: str, end: str, now: str,
    types: list[str], interval: int, multiplier: int, max_cycles: int,
) -> DataFrame:
    """Tasks of the next sync cycle: watermark of the log, due windows, log rows, fan-out.

    Only cycles before this one count for the watermark, so a repeated cycle gives the same tasks.
    """
    log = read_sync_log(spark, path).where(F.col("cycle") < cycle)
    moments = {"end": F.lit(end).cast("timestamp"), "now": F.lit(now).cast("timestamp")}
    last = sync_watermark(log, start).withColumns(moments)
    append_sync_log(sync_log(plan_windows(last, interval, multiplier, max_cycles), now), path, cycle)
    logged = spark.read.schema(LOG).parquet(f"{path}/cycle={cycle}")
    windows = logged.select(
        F.col("since_date_time").alias("window_start"), F.col("till_date_time").alias("window_end")
    )
    return fan_out_tasks(windows, types)


def fan_out_tasks(windows: DataFrame, types: list[str]) -> DataFrame:
    """One task per window and resource type, with the folder its files go to."""
    others = [c for c in windows.columns if c not in ("window_start", "window_end")]
    return windows.select(
        *others,
        F.explode(F.array(*[F.lit(t.strip()) for t in types])).alias("resource_type"),
        F.date_format("window_start", SECOND).alias("start_time"),
        F.date_format("window_end", SECOND).alias("end_time"),
        F.concat(
            F.lit("batch-load/"), F.date_format("window_end", "yyyyMMdd'T'HHmm")
        ).alias("folder_name"),
    )


def export_windows(
    spans: DataFrame, days: int, types: list[str], keep_rest: bool = False
) -> DataFrame:
    """Bulk-export plan: windows of `days` over every span (start, end), per resource type.

    Days left over at the end are dropped unless `keep_rest` asks for a last short window.
    """
    length = days * 86400
    span = _seconds(F.col("end")) - _seconds(F.col("start"))
    whole = F.floor(F.floor(span / 86400) / days).cast("int")
    count = F.ceil(span / length).cast("int") if keep_rest else whole
    planned = spans.withColumn("_n", F.when(count > 0, F.sequence(F.lit(0), count - 1)))
    windows = explode_present(planned, "_n", "_cycle").withColumns(
        {
            "since": _later(F.col("start"), F.col("_cycle") * length),
            "till": F.least(_later(F.col("start"), (F.col("_cycle") + 1) * length), F.col("end")),
        }
    )
    return windows.drop("_cycle").withColumn(
        "resource_type", F.explode(F.array(*[F.lit(t) for t in types]))
    )


def task_messages(tasks: DataFrame, as_of: str) -> DataFrame:
    """Retryable message per task; the folder is the end time without `:` and `-`."""
    return tasks.select(
        "resource_type",
        "start_time",
        "end_time",
        F.lit(as_of).alias("request_time"),
        F.translate("end_time", ":-", "").alias("folder_name"),
        "page_number",
        "fhir_url",
        "retry_count",
        "retry_message",
    )


def changed_between(rows: DataFrame, column: str, start: Column, end: Column) -> DataFrame:
    """Rows last updated inside a window, both ends included.

    Rows on a shared edge come twice; the version check drops the second copy.
    """
    return rows.where(F.col(column).between(start, end))
