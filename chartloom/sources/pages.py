"""A sink for staged pages: one NDJSON file per page, named as the loading side expects it.

Spark's text writer names files itself. This one is a data source whose tasks write `folder/Type-page.ndjson`. A page is
written under a name of its task's own and moved to its final name when it is whole, so a reader never sees half of one,
and a task that is run again, or twice at once, puts the same bytes in place.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "staged_pages"
NAME = r"/([^/]+)-(\d+)\.ndjson$"


@dataclass
class LastPages(WriterCommitMessage):
    """Highest page a task wrote, by folder and type."""

    last: dict[str, int]


class PageWriter(DataSourceArrowWriter):
    """Writes rows (series, page, value) that come page by page; `series` is `folder/Type`."""

    def __init__(self, path: str):
        self.path = path

    def _root(self) -> tuple[fs.FileSystem, str]:
        if "://" in self.path or self.path.startswith("/"):
            return fs.FileSystem.from_uri(self.path)
        return fs.FileSystem.from_uri(self.path.replace("file:", "file://", 1))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> LastPages:
        files, root = self._root()
        written: dict[str, int] = {}
        current, out, draft = None, None, ""

        def finish() -> None:
            if current is not None:
                out.close()
                files.move(draft, f"{root}/{current[0]}-{current[1]}.ndjson")
                written[current[0]] = max(written.get(current[0], 0), current[1])

        for batch in iterator:
            runs = pc.run_end_encode(pc.binary_join_element_wise(
                batch["series"].cast(pa.string()), batch["page"].cast(pa.string()), "\n"
            ))
            start = 0
            for name, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
                series, page = name.rsplit("\n", 1)
                if (series, int(page)) != current:
                    finish()
                    current = (series, int(page))
                    folder, _, kind = f"{root}/{series}".rpartition("/")
                    files.create_dir(folder, recursive=True)
                    draft = f"{folder}/_{kind}-{page}.{uuid.uuid4().hex}"
                    out = files.open_output_stream(draft)
                lines = batch["value"].slice(start, end - start).to_pylist()
                out.write("".join(f"{line}\n" for line in lines).encode())
                start = end
        finish()
        return LastPages(written)

    def commit(self, messages: list[LastPages | None]) -> None:
        """Remove what a longer job left: pages follow each other, so the first one missing ends the search."""
        files, root = self._root()
        last: dict[str, int] = {}
        for message in filter(None, messages):
            for series, page in message.last.items():
                last[series] = max(last.get(series, 0), page)
        for series, page in last.items():
            while True:
                page += 1
                name = f"{root}/{series}-{page}.ndjson"
                if files.get_file_info(name).type != fs.FileType.File:
                    break
                files.delete_file(name)

    def abort(self, messages: list[LastPages | None]) -> None:
        """Whole pages stay, as the repeated job writes them again."""


class StagedPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> PageWriter:
        return PageWriter(self.options["path"])


def write_pages(paged: DataFrame, path: str) -> None:
    """Write the `value` lines of rows (folder, resource_type, page) as `folder/Type-page.ndjson` below `path`.

    `path` is one that pyarrow's file systems reach: a local or shared folder, or a URI. A page goes to one task, where
    pages come one after the other, each by `position` if there is such a column, else by its text. A repeated job
    replaces the pages of its folders; pages are numbered from 1 without gaps, as `assign_pages` does. Null lines are
    left out.
    """
    paged.sparkSession.dataSource.register(StagedPages)
    series = F.concat_ws("/", "folder", "resource_type").alias("series")
    order = "position" if "position" in paged.columns else "value"
    lines = paged.where(F.col("value").isNotNull()).select(series, F.col("page").cast("int"), "value", order)
    placed = lines.repartition("series", "page").sortWithinPartitions("series", "page", order)
    placed.select("series", "page", "value").write.format(FORMAT).mode("append").save(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Staged lines with the `url` of their file and its name below `path`, as `page_file`.

    Names that start with `_` are pages not yet whole; Spark skips them.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    root = path.split(":", 1)[-1].strip("/") + "/"
    return lines.select("value", F.col("_metadata.file_path").alias("url")).withColumn(
        "page_file", F.substring_index("url", root, -1)
    )


def page_number(url: Column) -> Column:
    return F.regexp_extract(url, NAME, 2).try_cast("int")


def missing_pages(expected: DataFrame, staged: DataFrame) -> DataFrame:
    """Read-back check: pages whose number of lines is not the expected one; no rows mean that all arrived.

    `expected` are the rows given to `write_pages`, `staged` what `read_pages` finds. A page that is not there has null
    `found`, one that nobody expects null `lines`.
    """
    name = F.format_string("%s/%s-%d.ndjson", "folder", "resource_type", "page")
    wanted = expected.where(F.col("value").isNotNull()).groupBy(name.alias("page_file"))
    found = staged.groupBy("page_file").agg(F.count(F.lit(1)).alias("found"))
    counts = wanted.agg(F.count(F.lit(1)).alias("lines")).join(found, "page_file", "full")
    return counts.where(~F.col("lines").eqNullSafe(F.col("found")))
