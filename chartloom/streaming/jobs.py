"""Streaming jobs. Every one drains what is there and stops, or runs on with a trigger.

Each micro-batch writes below a folder named by its number, so a replayed batch replaces
its own output and nothing is counted twice.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartloom.operators import changes, errors, lineage
from chartloom.operators.frames import latest_per_key
from chartloom.operators.published import TableSet
from chartloom.plans.ingest import Ingest, ingest
from chartloom.sources.staging import event_target

FILES_PER_BATCH = 1000


def table_stream(
    spark: SparkSession, folder: str, name: str, files_per_batch: int = FILES_PER_BATCH
) -> DataFrame:
    """Stream over the Parquet files of a table, arriving files included.

    A stream wants a folder, but a table may be one file. Written as a pattern, the same
    path stands for either.
    """
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{folder}/{name}[.]parquet")


def line_stream(spark: SparkSession, folder: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """Stream over staged text files, with the file of each line."""
    lines = (
        spark.readStream.option("maxFilesPerTrigger", files_per_batch)
        .option("recursiveFileLookup", "true")
        .text(folder)
    )
    return lines.select("value", F.col("_metadata.file_path").alias("url"))


def drain(
    stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], seconds: int | None = None
) -> None:
    """Hand every micro-batch to `each`; without `seconds` stop when all input is read."""
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if seconds is None:
        writer.trigger(availableNow=True).start().awaitTermination()
    else:
        writer.trigger(processingTime=f"{seconds} seconds").start().awaitTermination()


def _batch_folder(path: str, batch: int) -> str:
    return f"{path}/batch={batch}"


def ingest_stream(spark: SparkSession, lines: DataFrame, run: Ingest, work: str) -> None:
    """Classify, normalize and load staged lines (value, url); audit rows go to `work`/audit."""

    def each(batch: DataFrame, number: int) -> None:
        # Table versions start at 1: version 0 of a replay has nothing before it.
        audit = ingest(spark, batch, run, number + 1)
        audit.write.mode("overwrite").parquet(_batch_folder(f"{work}/audit", number))

    drain(lines, f"{work}/checkpoint", each)


# What a server has of a resource type: a table per type in a `TableSet`, named as the type in lower case.
DOCUMENT = T.StructType([T.StructField("id", T.StringType()), T.StructField("value", T.StringType())])


def serve(server: TableSet, documents: dict[str, DataFrame], version: int) -> None:
    """Publish documents (id, value) by resource type, hashed by id, for `event_stream` to fetch from.

    Documents of an id replace what an earlier version has of it.
    """
    for resource, rows in documents.items():
        table, tables = resource.lower(), server.of(resource.lower())
        whole, added = tables.upsert(table, DOCUMENT, rows.select("id", "value"), rows, version)
        tables.publish(version, {table: whole}, {table: added})


def fetch(server: TableSet, resource: str, wanted: DataFrame) -> DataFrame:
    """The rows of `wanted` (id) with the `value` of their document or null. Only the buckets of the ids are read."""
    table, tables = resource.lower(), server.of(resource.lower())
    return wanted.join(tables.read(table, DOCUMENT, tables.touched(wanted)), "id", "left")


def event_stream(
    spark: SparkSession,
    events: DataFrame,
    server: TableSet,
    runs: list[Ingest],
    work: str,
    max_retries: int = 3,
    delay_minutes: int = 5,
) -> None:
    """Change events to loaded resources, of all the types there is a run for.

    `server` (see `serve`) stands for the server the resources are fetched from. Several events of a batch on one
    resource fetch it once. The types of a batch are loaded side by side, each by its own run. Targets that cannot be
    loaded go to `work`/unfetched with the reason and the next stop of their message: no document has the id
    (`not_found`, tried again as `pull_disposition` says; events may carry `retry_count` and `retry_message`), or no run
    loads the type (`other_type`, to the failure area).
    """
    by_type = {run.resource: run for run in runs}

    def load(resource: str, wanted: DataFrame, number: int) -> None:
        at = _batch_folder(f"{work}/fetched/{resource}", number)
        fetch(server, resource, wanted).write.mode("overwrite").parquet(at)
        found = spark.read.parquet(at).where(F.col("value").isNotNull())
        folder = F.concat(F.lit("event-load/"), F.col("id"), F.lit(f"/{resource}-1.ndjson"))
        audit = ingest(spark, found.select("value", folder.alias("url")), by_type[resource], number + 1)
        audit.write.mode("overwrite").parquet(_batch_folder(f"{work}/audit", number) + f"/type={resource}")

    def each(batch: DataFrame, number: int) -> None:
        at = _batch_folder(f"{work}/wanted", number)
        known = [c for c in ("retry_count", "retry_message") if c in batch.columns]
        targets = event_target(batch).select(
            "resource_type", F.substring_index("subject", "/", -1).alias("id"), *known
        )
        targets = targets.groupBy("resource_type", "id").agg(
            *[F.max(c).alias(c) if c in known else F.lit(None).cast(kind).alias(c)
              for c, kind in (("retry_count", "int"), ("retry_message", "boolean"))]
        )
        targets.write.mode("overwrite").parquet(at)
        wanted = spark.read.schema(targets.schema).parquet(at)
        mine = F.col("resource_type").isin(list(by_type))
        present = [r[0] for r in wanted.where(mine).select("resource_type").distinct().collect()]
        parts = [(r, wanted.where(F.col("resource_type") == r)) for r in present]
        with ThreadPoolExecutor(max(len(parts), 1)) as pool:
            list(pool.map(lambda part: load(*part, number), parts))
        missed = [wanted.where(~mine | mine.isNull()).withColumn("reason", F.lit("other_type"))]
        for resource in present:
            fetched = spark.read.parquet(_batch_folder(f"{work}/fetched/{resource}", number))
            lost = fetched.where(F.col("value").isNull()).drop("value")
            missed.append(lost.withColumn("reason", F.lit("not_found")))
        messages = reduce(DataFrame.unionByName, missed).withColumn("application_name", F.lit(errors.EVENT_EXPORTER))
        routed = errors.pull_disposition(messages, max_retries, delay_minutes)
        lost_for_good = F.col("reason") == "other_type"
        routed = routed.withColumns({
            "disposition": F.when(lost_for_good, "failure_area").otherwise(F.col("disposition")),
            "delay_minutes": F.when(~lost_for_good, F.col("delay_minutes")),
        })
        routed.write.mode("overwrite").parquet(_batch_folder(f"{work}/unfetched", number))

    drain(events, f"{work}/checkpoint", each)


def audit_flush_stream(messages: DataFrame, work: str, as_of: str, seconds: int | None = None) -> None:
    """Route audit and lineage messages into three tables; one micro-batch is one flush."""

    def each(batch: DataFrame, number: int) -> None:
        routed = lineage.route(batch).withColumn("created_date", F.lit(as_of).cast("timestamp"))
        (
            routed.write.mode("overwrite")
            .partitionBy("route")
            .parquet(_batch_folder(f"{work}/flushed", number))
        )

    drain(messages, f"{work}/checkpoint", each, seconds)


LINEAGE_STATE = T.StructType(
    [
        T.StructField("filepath_id", T.StringType()),
        T.StructField("resource_type", T.StringType()),
        T.StructField("fhir_request_url", T.StringType()),
        T.StructField("record_count", T.IntegerType()),
        T.StructField("pipeline_type", T.StringType()),
        T.StructField("destination_location", T.StringType()),
        T.StructField("is_inserted", T.BooleanType()),
        T.StructField("retry_count", T.IntegerType()),
        T.StructField("error_code", T.StringType()),
        T.StructField("reject_location", T.StringType()),
        T.StructField("reschedule_count", T.IntegerType()),
        T.StructField("waiting_since", T.LongType()),
    ]
)
FIRST_VALUES = [
    "resource_type", "fhir_request_url", "record_count", "pipeline_type", "destination_location",
]


def lineage_stream(messages: DataFrame, tables: TableSet, work: str) -> None:
    """Keep one row per file from the halves of its lineage, in whatever order they come.

    A half that came alone waits in the same table until the other one is there; see
    `lineage_state`. Only the rows of the files at hand are written.
    """

    def each(batch: DataFrame, number: int) -> None:
        version = number + 1
        at = f"{work}/halves/{version}"
        batch.select(
            F.col("message_no").alias("_order"),
            *[F.col(f.name).cast(f.dataType) for f in LINEAGE_STATE if f.name in batch.columns],
        ).write.mode("overwrite").parquet(at)
        halves = batch.sparkSession.read.parquet(at)
        before = tables.snapshot(before=version)
        stored = tables.read("lineage", LINEAGE_STATE, tables.touched(halves), before)
        stored = stored.join(halves.select("filepath_id"), "filepath_id", "left_semi")
        merged = f"{work}/merged/{version}"
        merge_state(stored, halves, version).write.mode("overwrite").parquet(merged)
        rows = batch.sparkSession.read.schema(LINEAGE_STATE).parquet(merged)
        whole, added = tables.upsert("lineage", LINEAGE_STATE, rows, rows, version, before)
        tables.publish(version, {"lineage": whole}, {"lineage": added})

    drain(messages, f"{work}/checkpoint", each)


def merge_state(state: DataFrame, halves: DataFrame, batch: int) -> DataFrame:
    """Newest first-half values and newest outcome of every file at hand.

    An outcome that came before its file waits from batch to batch: `waiting_since` is the first one. When the file
    comes, `reschedule_count` is how many batches the outcome has waited, whatever else they held.
    """
    everything = state.withColumn("_order", F.lit(-1).cast("long")).unionByName(
        halves, allowMissingColumns=True
    )
    is_first = F.col("pipeline_type").isNotNull()
    is_second = F.col("is_inserted").isNotNull()

    def newest(columns: list[str], present: Column) -> Column:
        return F.max(F.when(present, F.struct("_order", *columns)))

    merged = everything.groupBy("filepath_id").agg(
        newest(FIRST_VALUES, is_first).alias("first"),
        newest(lineage.OUTCOME_COLUMNS, is_second).alias("second"),
        F.max("reschedule_count").alias("tries"),
        F.min("waiting_since").alias("since"),
    )
    waits = F.col("first").isNull()
    waited = (F.lit(batch) - F.col("since")).cast("int")
    return merged.select(
        "filepath_id",
        *[F.col(f"first.{c}").alias(c) for c in FIRST_VALUES],
        *[F.col(f"second.{c}").alias(c) for c in lineage.OUTCOME_COLUMNS],
        F.coalesce("tries", F.when(~waits, F.coalesce(waited, F.lit(0)))).alias("reschedule_count"),
        F.when(waits, F.coalesce("since", F.lit(batch).cast("long"))).alias("waiting_since"),
    )


def rescheduled(state: DataFrame, batches: int) -> DataFrame:
    """The table of `lineage_stream` after so many batches, with the count of those that still wait up to now."""
    waited = (F.lit(batches) + 1 - F.col("waiting_since")).cast("int")
    return state.withColumn("reschedule_count", F.coalesce("reschedule_count", waited)).drop("waiting_since")


def lineage_state() -> Column:
    """complete with both halves, open without an outcome, waiting without the file itself."""
    return (
        F.when(F.col("pipeline_type").isNull(), "waiting")
        .when(F.col("is_inserted").isNull(), "open")
        .otherwise("complete")
        .alias("state")
    )


def with_ticks(messages: DataFrame) -> DataFrame:
    """A stream that has something to do at every trigger: one `_tick` row beside the messages, if any."""
    ticks = messages.sparkSession.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()
    return messages.withColumn("_tick", F.lit(False)).unionByName(
        ticks.select(F.lit(True).alias("_tick")), allowMissingColumns=True
    )


# Time of a micro-batch, in whole seconds since 1970.
CLOCK = "at long"


def _written(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _time_of(spark: SparkSession, work: str, batch: int) -> int | None:
    clock = _written(spark, _batch_folder(f"{work}/clock", batch), CLOCK)
    row = clock.first() if clock is not None else None
    return row and row["at"]


def _moment(seconds: int) -> Column:
    return F.timestamp_seconds(F.lit(seconds))


def _due_slot(moment: Column, slot: int) -> Column:
    return F.floor(F.unix_timestamp(moment) / slot)


def redelivery_stream(
    messages: DataFrame,
    work: str,
    now: Callable[[int], str] = lambda number: datetime.now(UTC).strftime("%Y-%m-%d %H:%M:%S"),
    seconds: int | None = None,
    slot: int = 3600,
) -> None:
    """Deliver messages to `work`/delivered once their `not_before` is reached; one without it is due at once.

    Every trigger is a micro-batch, with new messages or not, so what waits leaves by time alone: start the job again,
    or let it run on with `seconds`. A message that is not due is written once, by the slot (of so
    many seconds) it is due in. Batch n delivers what fell due after the time of batch n - 1 and up to its own, so nothing
    is rewritten and nothing comes twice; only the slots in between are read. Take slots about as long as messages wait. `now` gives the time of a batch; it is kept, so a replayed batch delivers the same. A
    clock that goes back stands still.
    """
    spark = messages.sparkSession

    def each(batch: DataFrame, number: int) -> None:
        last, at = _time_of(spark, work, number - 1), _time_of(spark, work, number)
        if at is None:
            clock = spark.range(1).select(
                F.greatest(F.unix_timestamp(F.lit(now(number)).cast("timestamp")), F.lit(last).cast("long")).alias("at")
            )
            clock.coalesce(1).write.mode("overwrite").parquet(_batch_folder(f"{work}/clock", number))
            at = _time_of(spark, work, number)
        here = batch.sparkSession
        fresh, time = batch.where(~F.col("_tick")).drop("_tick"), _moment(at)
        waits = F.coalesce(F.col("not_before") > time, F.lit(False))
        (
            fresh.where(waits)
            .withColumns({"due_slot": _due_slot(F.col("not_before"), slot), "batch": F.lit(number)})
            .hint("rebalance", "due_slot")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("due_slot", "batch")
            .parquet(f"{work}/waiting")
        )
        due = fresh.where(~waits)
        if last is not None:
            due = due.unionByName(_waiting(here, work, fresh.schema).where(
                F.col("due_slot").between(last // slot, at // slot)
                & (F.col("batch") < number)
                & (F.col("not_before") > _moment(last))
                & (F.col("not_before") <= time)
            ).drop("due_slot", "batch"))
        due.write.mode("overwrite").parquet(_batch_folder(f"{work}/delivered", number))

    drain(with_ticks(messages), f"{work}/checkpoint", each, seconds)


def _waiting(spark: SparkSession, work: str, message: T.StructType) -> DataFrame:
    """Messages that had to wait, delivered since or not."""
    place = [T.StructField("due_slot", T.LongType()), T.StructField("batch", T.IntegerType())]
    schema = T.StructType([*message.fields, *place])
    rows = _written(spark, f"{work}/waiting", schema)
    return spark.createDataFrame([], schema) if rows is None else rows


def redelivered(spark: SparkSession, work: str) -> DataFrame:
    """Every message once: those delivered by any batch, and those that wait beyond the time of the newest batch."""
    delivered = spark.read.option("basePath", f"{work}/delivered").parquet(f"{work}/delivered").drop("batch")
    newest = spark.read.schema(CLOCK).parquet(f"{work}/clock").agg(F.max("at")).first()[0]
    left = _waiting(spark, work, delivered.schema).where(F.col("not_before") > _moment(newest))
    waiting = left.select(*delivered.columns, F.lit("waiting").alias("state"))
    return delivered.withColumn("state", F.lit("due")).unionByName(waiting)


def latest_version_stream(
    rows: DataFrame, tables: TableSet, table: str, schema: T.StructType, work: str
) -> None:
    """Keep the highest version of every id over all micro-batches."""
    order = changes.newest_first(rows)

    def each(batch: DataFrame, number: int) -> None:
        version, at = number + 1, f"{work}/newest/{number}"
        latest_per_key(batch, ["id"], order).write.mode("overwrite").parquet(at)
        newest = batch.sparkSession.read.parquet(at)
        before = tables.snapshot(before=version)
        stored = tables.read(table, schema, tables.touched(newest), before)
        stored = stored.join(newest.select("id"), "id", "left_semi")
        winners = f"{work}/winners/{number}"
        latest_per_key(stored.unionByName(newest), ["id"], order).write.mode("overwrite").parquet(winners)
        rows = batch.sparkSession.read.parquet(winners)
        whole, added = tables.upsert(table, schema, rows, rows, version, before)
        tables.publish(version, {table: whole}, {table: added})

    drain(rows, f"{work}/checkpoint", each)
