"""Tables kept as bucketed Parquet versions, visible only once their batch is published.

A batch writes under its own number, for as many tables as it has, and then writes one list of (table, bucket,
version). That one small file makes all its tables visible together; a batch that failed before it leaves nothing a
reader can see. A replayed batch starts from the versions before its own and writes the same folders again.

A bucket has a first version and what later batches added: new rows, and the keys whose older rows they replace. Reading
drops a row if a later version in force has its key. So a batch writes about as many rows as it has, however large the
tables are. A bucket with FOLD versions is written whole by the next batch that touches it.

Tables that are published together are a group with numbers and lists of its own, so batches of
other groups in the same folder neither see nor undo them.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PUBLISHED = "table string, bucket int, version long"
FOLD = 8

# (table, bucket) -> its versions in force, the oldest first. Bounded by buckets, however large the tables are.
Snapshot = dict[tuple[str, int], tuple[int, ...]]

# Buckets of a batch by table: those written whole, and those that got rows and keys added.
Written = tuple[set[int], set[int]]


class TableSet:
    """Keyed tables below one folder, split by a hash of `key` into `buckets`."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str = "id",
        buckets: int = 16,
        lookups: tuple[str, ...] = (),
        group: str = "all",
    ):
        """`lookups` are columns often searched for single values; they get bloom filters.

        Batch numbers have to be unique within `group`.
        """
        self.spark = spark
        self.path = path
        self.key = key
        self.buckets = buckets
        self.lookups = (key, *lookups)
        self.group = group

    def of(self, group: str) -> TableSet:
        """The tables of another group in the same folder."""
        others = tuple(c for c in self.lookups if c != self.key)
        return TableSet(self.spark, self.path, self.key, self.buckets, others, group)

    @property
    def _log(self) -> str:
        return f"{self.path}/published/{self.group}"

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _listed(self, folder: str, schema: str) -> DataFrame | None:
        try:
            return self.spark.read.schema(schema).parquet(folder)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def snapshot(self, before: int | None = None) -> Snapshot:
        """Published versions, the newest ones or those in force before a batch. Only one list is read."""
        every = self._listed(self._log, f"{PUBLISHED}, batch_no long")
        files = every.inputFiles() if every is not None else []
        numbers = {int(re.findall(r"batch_no=(\d+)/", f)[-1]) for f in files}
        newest = max((n for n in numbers if before is None or n < before), default=None)
        if newest is None:
            return {}
        versions: dict[tuple[str, int], list[int]] = {}
        for r in self._listed(f"{self._log}/batch_no={newest}", PUBLISHED).collect():
            versions.setdefault((r["table"], r["bucket"]), []).append(r["version"])
        return {place: tuple(sorted(found)) for place, found in versions.items()}

    def _folder(self, table: str, version: int) -> str:
        return f"{self.path}/{table}/batch_no={version}"

    def read(
        self,
        table: str,
        schema: T.StructType,
        only: set[int] | None = None,
        snapshot: Snapshot | None = None,
    ) -> DataFrame:
        """Published rows, of all buckets or of some."""
        in_force = self.snapshot() if snapshot is None else snapshot
        places = [
            (version, bucket)
            for (name, bucket), versions in in_force.items()
            if name == table and (only is None or bucket in only)
            for version in versions
        ]
        if not places:
            return self.spark.createDataFrame([], schema)
        rows = self._stored(table, schema, places)
        first = {bucket: versions[0] for (name, bucket), versions in in_force.items() if name == table}
        added = [(version, bucket) for version, bucket in places if version != first[bucket]]
        if added:
            keys = self._stored(f"{table}.keys", T.StructType([schema[self.key]]), added)
            gone = keys.select(F.col(self.key).alias("_key"), F.col("batch_no").alias("_since"))
            replaced = (rows[self.key] == gone["_key"]) & (rows["batch_no"] < gone["_since"])
            rows = rows.join(gone, replaced, "left_anti")
        return rows.drop("batch_no", "bucket_no")

    def _stored(self, table: str, schema: T.StructType, places: list[tuple[int, int]]) -> DataFrame:
        """Rows of some (version, bucket) with `batch_no` and `bucket_no`."""
        partition = [
            T.StructField("batch_no", T.LongType()),
            T.StructField("bucket_no", T.IntegerType()),
        ]
        stored = T.StructType([*schema.fields, *partition])
        # One flat set over the partition columns, however many versions are in force.
        chosen = [version * self.buckets + bucket for version, bucket in places]
        place = F.col("batch_no") * self.buckets + F.col("bucket_no")
        return (
            self.spark.read.schema(stored)
            .option("basePath", f"{self.path}/{table}")
            .parquet(*[self._folder(table, version) for version in sorted({v for v, _ in places})])
            .where(place.isin(chosen))
        )

    def write(self, table: str, rows: DataFrame, version: int, filters: bool = True) -> None:
        """Write rows under a version, with bloom filters on the lookups or not; nothing shows before `publish`.

        The rebalance splits a bucket that got very many rows and joins small ones.
        """
        bucketed = rows.withColumn("bucket_no", self._bucket()).hint("rebalance", "bucket_no")
        blooms = {
            f"parquet.bloom.filter.enabled#{c}": str(filters).lower()
            for c in self.lookups
            if c in rows.columns
        }
        (
            bucketed.write.mode("overwrite")
            .options(**blooms)
            .partitionBy("bucket_no")
            .parquet(self._folder(table, version))
        )

    def touched(self, rows: DataFrame) -> set[int]:
        """Buckets the rows fall into."""
        return {r[0] for r in rows.select(self._bucket().alias("bucket")).distinct().collect()}

    def publish(
        self, version: int, whole: dict[str, set[int]], added: dict[str, set[int]] | None = None
    ) -> None:
        """Make buckets of all tables visible with one file: those written `whole`, and those `added` to."""
        versions = self.snapshot(before=version)
        versions.update({(t, b): (version,) for t, buckets in whole.items() for b in buckets})
        for table, buckets in (added or {}).items():
            versions.update({(table, b): (*versions.get((table, b), ()), version) for b in buckets})
        listed = [(table, b, v) for (table, b), found in sorted(versions.items()) for v in found]
        rows = self.spark.createDataFrame(listed, PUBLISHED)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self._log}/batch_no={version}")

    def upsert(
        self,
        table: str,
        schema: T.StructType,
        rows: DataFrame,
        replaced: DataFrame,
        version: int,
        snapshot: Snapshot | None = None,
    ) -> Written:
        """Write a batch: `rows` come, and what is stored for the keys in `replaced` goes.

        `rows` have no other keys than `replaced`. Give both as frames that are cheap to evaluate more than once.
        Returns the buckets for `publish`: written whole, as they were new or due, and added to.
        """
        before = self.snapshot(before=version) if snapshot is None else snapshot
        keys = replaced.select(self.key).distinct()
        buckets = self.touched(keys)
        held = {bucket: len(before.get((table, bucket), ())) for bucket in buckets}
        whole = {bucket for bucket, versions in held.items() if versions == 0 or versions >= FOLD}
        due = {bucket for bucket in whole if held[bucket]}
        written = rows.select(*schema.fieldNames())
        if due:
            kept = self.read(table, schema, due, before).join(keys, self.key, "left_anti")
            written = written.unionByName(kept.select(*schema.fieldNames()))
        # A filter has a megabyte, more than most additions.
        self.write(table, written, version, filters=bool(whole))
        added = buckets - whole
        if added:
            self.write(f"{table}.keys", keys.where(self._bucket().isin(list(added))), version, filters=False)
        return whole, added

    def rewrite(
        self,
        table: str,
        schema: T.StructType,
        buckets: set[int],
        version: int,
        change: Callable[[DataFrame], DataFrame],
        snapshot: Snapshot | None = None,
    ) -> None:
        """Write buckets whole: `change` turns their stored rows into the new ones. For changes of every row."""
        before = self.snapshot(before=version) if snapshot is None else snapshot
        state = self.read(table, schema, buckets, before)
        self.write(table, change(state).select(*schema.fieldNames()), version)
