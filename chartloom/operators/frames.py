"""Small table helpers shared by the operators."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def explode_present(df: DataFrame, array: str, name: str) -> DataFrame:
    """One row per non-null entry of an array column.

    The outer form keeps the optimizer from copying a size check, and with it the whole
    expression behind the array (often a JSON parse), below the projection.
    """
    others = [c for c in df.columns if c != array]
    return df.select(*others, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def union_frames(parent: DataFrame | None, frames: list[DataFrame | None]) -> DataFrame | None:
    """Parent and all given frames stacked by column name; absent frames are skipped."""
    present = [f for f in [parent, *frames] if f is not None]
    if not present:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)


def rename_if_present(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def drop_if_present(df: DataFrame, names: list[str]) -> DataFrame:
    return df.drop(*names)


def blank_to_null(value: Column, depth: int = 0) -> Column:
    """Empty text becomes null, also inside `depth` levels of arrays."""
    if depth:
        return F.transform(value, lambda item: blank_to_null(item, depth - 1))
    return F.nullif(value, F.lit(""))


def latest_per_key(df: DataFrame, keys: list[str], newest_first: list[Column]) -> DataFrame:
    """The first row of every key in the given order.

    The rank filter lets Spark keep one row per key and partition before the shuffle, so a
    key with very many rows never meets in one task.
    """
    window = Window.partitionBy(*keys).orderBy(*newest_first)
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def dense_positions(
    df: DataFrame, group: list[str], order: list[str], chunk: Column, name: str = "position"
) -> DataFrame:
    """Number the rows of every group from 1 in `order`, without gathering a group in one task.

    `chunk` cuts a group into pieces and must not decrease along `order`. Rows are numbered
    inside their piece; the piece's offset comes from the counts of the pieces before it.
    """
    pieces = df.withColumn("_chunk", chunk)
    inside = Window.partitionBy(*group, "_chunk").orderBy(*order)
    before = (
        Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        pieces.groupBy(*group, "_chunk")
        .agg(F.count(F.lit(1)).alias("_count"))
        .withColumn("_offset", F.coalesce(F.sum("_count").over(before), F.lit(0)))
    )
    numbered = pieces.withColumn("_inside", F.row_number().over(inside)).alias("n")
    # Null-safe, so that rows without a group or chunk are numbered too.
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in [*group, "_chunk"]]
    return numbered.join(offsets.alias("o"), reduce(and_, same)).select(
        *[F.col(f"n.{c}") for c in df.columns],
        (F.col("_offset") + F.col("_inside")).alias(name),
    )


def hash_chunk(column: str, chunks: int) -> Column:
    """Piece number for rows whose order inside a group does not matter."""
    return F.pmod(F.xxhash64(column), F.lit(chunks))


def serialized(df: DataFrame, columns: list[str]) -> DataFrame:
    """Structs and lists as JSON text, absent fields left out."""
    return df.withColumns({c: F.to_json(c) for c in columns})
