"""Search result pages and capability statements."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.functions.exact import marked_where_needed, unmarked
from chartloom.operators.frames import explode_present

PAGE = "entry array<struct<resource:string>>, link array<struct<relation:string,url:string>>"
CAPABILITY = "rest array<struct<resource:array<struct<type:string>>>>"


def explode_bundles(pages: DataFrame) -> DataFrame:
    """One row per resource on a page, numbers as written, with the address of the next page if there is one."""
    others = [c for c in pages.columns if c != "value"]
    text = marked_where_needed(F.col("value"))
    parsed = pages.select(*others, F.from_json(text, PAGE).alias("page"))
    following = F.filter("page.link", lambda link: link["relation"] == "next")
    resources = F.filter("page.entry.resource", lambda r: r.isNotNull())
    rows = parsed.select(
        *others, F.get(following, F.lit(0))["url"].alias("next_url"), resources.alias("resources")
    )
    return explode_present(rows, "resources", "value").withColumn("value", unmarked(F.col("value")))


def capability_resources(statements: DataFrame) -> DataFrame:
    """Resource types a server lists in its capability statement."""
    others = [c for c in statements.columns if c != "value"]
    parsed = statements.select(*others, F.from_json("value", CAPABILITY).alias("doc"))
    types = F.get("doc.rest", F.lit(0))["resource"]["type"]
    return explode_present(parsed.select(*others, types.alias("types")), "types", "resource_type")


def listed_resources(rows: DataFrame, column: str) -> DataFrame:
    """Resource types from a comma-separated list, trimmed."""
    return (
        rows.where(F.col(column) != "")
        .withColumn("_types", F.split(column, ","))
        .withColumn("resource_type", F.explode("_types"))
        .withColumn("resource_type", F.trim("resource_type"))
        .drop("_types", column)
    )
