"""Keyed loads: deletes, upserts, and publishing the tables of a batch together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.operators.changes import UPDATE
from chartloom.operators.frames import latest_per_key

UPSERT, DELETE = 0, 1
SHARED_KEY = ["id", "field_name", "seq_no"]


def record_id() -> Column:
    return F.concat_ws("_", "id", "field_name", "seq_no")


def tombstones(sizes: DataFrame, size: str, fields: list[str]) -> DataFrame:
    """Delete row for every id, shared field and number from 0 to the stored `size`."""
    names = F.array(*[F.lit(f) for f in fields]) if fields else F.array().cast("array<string>")
    return (
        sizes.select("id", F.col(size).alias("size"), F.explode(names).alias("field_name"))
        .select("id", "field_name", F.explode(F.sequence(F.lit(0), "size")).alias("seq_no"))
        .withColumns({"record_id": record_id(), "__op": F.lit(DELETE)})
    )


def stamped(rows: DataFrame, as_of: str) -> DataFrame:
    """Upsert rows with their load time."""
    return rows.withColumns({"updated_date": F.lit(as_of).cast("timestamp"), "__op": F.lit(UPSERT)})


def change_batch(deletes: DataFrame, rows: DataFrame, as_of: str) -> DataFrame:
    """Deletes followed by upserts; `__seq` keeps that order."""
    ordered = deletes.withColumn("__seq", F.lit(0))
    return ordered.unionByName(
        stamped(rows, as_of).withColumn("__seq", F.lit(1)), allowMissingColumns=True
    )


def batch_ids(rows: DataFrame, file_name: str = "file_name") -> DataFrame:
    """Distinct ids of files whose stored rows have to go first."""
    name = F.col(file_name)
    marked = F.contains(name, F.lit("_")) | F.contains(name, F.lit("utilitiesdata"))
    return rows.where(marked).select("id").distinct()


def apply_changes(state: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Keyed table after a batch: per key the last row wins, and a delete removes it.

    Only the batch is sorted. The stored rows pass an anti join on its keys, which needs no
    shuffle of the table as long as the keys of the batch are small enough to broadcast.
    """
    last = latest_per_key(batch, keys, [F.col("__seq").desc()])
    kept = state.join(last.select(*keys), keys, "left_anti")
    written = last.where(F.col("__op") == UPSERT).drop("__op", "__seq")
    return kept.unionByName(written, allowMissingColumns=True).select(*state.columns)


def replace_shared_rows(
    state: DataFrame, rows: DataFrame, updated_ids: DataFrame, fields: list[str]
) -> DataFrame:
    """The net effect of tombstones and upserts: old rows of updated ids go, new ones come.

    Driven by the set of updated ids, so an update that drops its last row still clears it.
    """
    names = F.array(*[F.lit(f) for f in fields]) if fields else F.array().cast("array<string>")
    doomed = updated_ids.select("id").distinct().select("id", F.explode(names).alias("field_name"))
    kept = state.join(doomed, ["id", "field_name"], "left_anti")
    return kept.select(*state.columns).unionByName(rows, allowMissingColumns=True)


def updated_ids(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("operation") == UPDATE).select("id")
