"""An ingest that reports: what went wrong with which code, where it is kept, and both halves of the files' lineage."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from chartloom.functions.keys import batch_file_id
from chartloom.operators import errors, lineage
from chartloom.plans.ingest import Ingest, StepFailed, ingest
from chartloom.sources.staging import write_rejects

# Name of the count of lines that were fine until a step failed or all were loaded.
GOOD = "good"


@dataclass
class Report:
    """`counts` of lines by code as the pass over them saw them; `cause` is the failure that ended the run, if any."""

    audit: DataFrame | None
    first: DataFrame
    second: DataFrame
    counts: dict[str, int]
    cause: str | None


def _line_counts() -> list[Column]:
    code = F.col("error_code")
    return [
        F.count_if(code.isNull()).alias(GOOD),
        *[F.count_if(code == c).alias(c) for c in (errors.READ_FAILED, errors.SHAPE_FAILED)],
    ]


def reported_ingest(
    spark: SparkSession, lines: DataFrame, run: Ingest, version: int, rejects: str
) -> Report:
    """Load a batch as `ingest` does and report every line of it, whatever happens.

    Lines that are no JSON get 601, those of a wrong shape 602. If a step fails for all, the tables stay as they were and
    the good lines get the code of the step: 602 normalizing, 603 writing or publishing tables, 699 anything else. Failed
    lines go below `rejects`, a folder per code; a repeated version replaces its own. Files that cannot be read have no
    lines to report; then `StepFailed` is raised with 601, and `read_disposition` tells where their message goes.

    The first half has a row per file with the lines it brought. So has the second half: `is_inserted` says whether every
    line of the file was loaded, `error_code` is the highest code of its lines, so that a run's failure hides bad lines
    and not the other way round. The counts come from the pass that classifies, by an observation on its write.
    """
    seen, at = Observation(f"lines-{version}"), f"{run.work}/{version}"
    audit, failed, cause = None, None, None
    try:
        audit = ingest(spark, lines, run, version, (seen, _line_counts()))
    except StepFailed as error:
        if error.code == errors.READ_FAILED:
            raise
        failed, cause = error.code, str(error.__cause__)
    except Exception as error:  # a run that fails in an unknown way is reported as such
        failed, cause = errors.UNEXPECTED, str(error)
    rows = _lines(spark, lines, at, failed in (None, errors.SHAPE_FAILED, errors.INSERT_FAILED))
    rows = rows.withColumn("error_code", F.coalesce("error_code", F.lit(failed)))
    bad = rows.where(F.col("error_code").isNotNull())
    write_rejects(bad, rejects, version)

    located = rows.withColumns({
        "resource_type": F.lit(run.resource),
        "fhir_request_url": F.col("url"),
        "destination_location": F.lit(run.table),
    })
    first = lineage.first_half(located, run.pipeline_type, run.as_of)
    second = rows.groupBy("filepath_id").agg(F.max("error_code").alias("error_code"), F.min("url").alias("url"))
    second = second.select(
        "filepath_id",
        F.col("error_code").isNull().alias("is_inserted"),
        F.lit(None).cast("int").alias("retry_count"),
        "error_code",
        F.when(
            F.col("error_code").isNotNull(), errors.reject_location(F.col("error_code"), F.col("url"))
        ).alias("reject_location"),
    )
    counts = _counts(rows) if failed else dict(seen.get)
    return Report(audit, first, second, {c: n for c, n in counts.items() if n}, cause)


def _counts(rows: DataFrame) -> dict[str, int]:
    found = rows.groupBy("error_code").agg(F.count(F.lit(1)).alias("n")).collect()
    return {r["error_code"] or GOOD: r["n"] for r in found}


def _lines(spark: SparkSession, lines: DataFrame, at: str, classified: bool) -> DataFrame:
    """Lines with `filepath_id` and their own code: as classified, or as they came if the run did not get that far."""
    if classified:
        columns = ["url", "filepath_id", F.col("document").alias("value"), "error_code"]
        return spark.read.parquet(f"{at}/in").select(*columns)
    given = [F.col("filepath_id")] if "filepath_id" in lines.columns else []
    file = F.coalesce(*given, batch_file_id(F.col("url"))).alias("filepath_id")
    plain = lines.where(F.col("value").rlike(r"\S")).select("url", file, "value")
    return plain.withColumn("error_code", F.lit(None).cast("string"))
