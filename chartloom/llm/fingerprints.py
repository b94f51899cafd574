"""Document fingerprints by a threshold-scaled sketch.

The sketch of a text keeps every hash of its character shingles below one fixed fraction of the hash range, the same
for all texts. Sketches of one fraction are complete below it, so they merge by union, and resemblance and containment
are read off them however unequal the texts are. The error shrinks with the root of the number of hashes kept.

Two sketches without a hash are alike (1), an empty and a filled one are not (0): nulls, empty texts and the few short
texts that have no hash below the threshold. Equal texts have equal sketches in any case. Texts
shorter than a shingle count as one shingle. Rows with equal ids are neighbours in the order of their texts; null ids
come after all others. Columns other than `doc_id` and `text` are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import mix64

#: One hash in SCALE is kept, as 32 bits: about as many bytes as the text has.
WIDTH, SCALE = 6, 4
_factors = mix64(np.arange(1, WIDTH + 1, dtype=np.uint64)) | np.uint64(1)


def sketch(text: str | None, scale: int = SCALE) -> np.ndarray:
    """All distinct hashes of the text's shingles below 2**32 / `scale`, in ascending order."""
    points = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    n = len(points)
    if not n:
        return np.empty(0, np.uint32)
    width = min(WIDTH, n)
    total = np.full(n - width + 1, np.uint64(width))
    for i in range(width):
        total += points[i : n - width + 1 + i] * _factors[i]
    hashes = (mix64(total) >> np.uint64(32)).astype(np.uint32)
    return np.unique(hashes[hashes < 2**32 // scale])


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of two texts together."""
    return np.union1d(a, b)


def likeness(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """Estimated resemblance of two texts, and the share of the first's shingles found in the second."""
    if not len(a) or not len(b):
        same = float(len(a) == len(b))
        return same, same
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common), common / len(a)


def encode(values: np.ndarray) -> str:
    return base64.b64encode(values.astype("<u4").tobytes()).decode()


def decode(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u4")


def fingerprint_column(texts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in texts:
        prints = [encode(sketch(t)) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.string())], ["doc_id", "fingerprint"])


def fingerprints(documents: DataFrame) -> DataFrame:
    """`doc_id` and `fingerprint` of every document."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(fingerprint_column, f"doc_id {kind}, fingerprint string")


def with_next(documents: DataFrame) -> DataFrame:
    """Documents in ranges of descending id, one range a partition, each closed by a copy of the row that follows it.

    The range bounds are quantiles, as many as there are shuffle partitions; the last range is closed by the first row
    of all. Columns `doc_id`, `key`, `text` and `closing`.
    """
    spark = documents.sparkSession
    keyed = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("key"),
        "text",
    )
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    places = keyed.select("key").approxQuantile("key", [i / parts for i in range(1, parts)], 1 / (4 * parts))
    splits = [-float("inf"), *sorted(set(places) or {0.0}), float("inf")]
    bins = Bucketizer(splits=splits, inputCol="at", outputCol="bin")
    placed = bins.transform(keyed.withColumn("at", F.col("key").cast("double")))
    placed = placed.select("doc_id", "key", "text", F.col("bin").cast("int").alias("bin"))
    first = {r["bin"]: r["key"] for r in placed.groupBy("bin").agg(F.max("key").alias("key")).collect()}
    order = sorted(first, reverse=True)
    closers = [(first[order[(i + 1) % len(order)]], bin_) for i, bin_ in enumerate(order)]
    edges = spark.createDataFrame(closers, "key long, other int").hint("broadcast")  # one row a partition
    extra = placed.join(edges, "key").select("doc_id", "key", "text", F.col("other").alias("bin"), F.lit(True).alias("closing"))
    rows = placed.withColumn("closing", F.lit(False)).unionByName(extra)
    dealt = rows.repartitionById(max(1, len(splits) - 1), F.col("bin"))
    return dealt.sortWithinPartitions("closing", F.desc("key"), F.asc_nulls_first("text")).drop("bin")


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, kept_share double, next_share double"
)


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    types = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    schema = pa.schema([(c.split()[0], types[c.split()[1]]) for c in SCHEMA.split(", ")])
    held = None
    for batch in batches:
        out = []
        for doc_id, text, closing in zip(
            *(batch.column(c).to_pylist() for c in ("doc_id", "text", "closing")), strict=True
        ):
            text = text or ""
            own = sketch(text)
            if held is not None:
                before_id, before, print_ = held
                swap = len(before) // 3
                edited = before[: len(before) - swap] + text[:swap]
                changed = sketch(edited) if edited != before else print_
                near, kept = likeness(print_, changed)
                next_, shared = likeness(print_, own)
                digest = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                out.append((before_id, len(before), digest, encode(print_), encode(changed), near, next_, kept, shared))
            if closing:
                held = None
                break
            held = (doc_id, text, own)
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
        if held is None:
            return


def edit_fingerprints(documents: DataFrame) -> DataFrame:
    """Fingerprints of every text and of the text whose last third gives way to the head of the next document."""
    return with_next(documents).mapInArrow(_neighbours, SCHEMA)
