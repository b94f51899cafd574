"""Helpers that several operators share: lineage cuts, null-safe columns and 64-bit hashes."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.session import shared_folder

ODD = np.uint64(0x9E3779B97F4A7C15)
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: ASCII white space, as bytes.split() sees it: 0x20 and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(frame: DataFrame) -> DataFrame:
    """`frame` computed once and kept in the shared checkpoint folder, so that lost executors cost no recomputation."""
    context = frame.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(frame.sparkSession))
    return frame.checkpoint()


def stored(frame: DataFrame) -> DataFrame:
    """`frame` written as Parquet in the shared folder and read again: as `cut`, for many rows, as it is compressed."""
    folder = f"{shared_folder(frame.sparkSession)}/stored-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def row_key() -> Column:
    """Tells documents apart by id and text; equal rows have equal keys."""
    return F.xxhash64("doc_id", "text")


def fold(doc_id: Column | str, parts: int) -> Column:
    """crc32 of the id's decimal text modulo `parts`; null ids fall into fold 0."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % parts, F.lit(0))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


_bytes_table = mix64(np.arange(1, 257, dtype=np.uint64) * ODD)
_powers = np.ones(1, np.uint64)


def _power_table(length: int) -> np.ndarray:
    """Powers of an odd number modulo 2**64, at least `length` of them."""
    global _powers
    if len(_powers) < length:
        factors = np.full(max(length, 2 * len(_powers)), np.uint64(0xD1342543DE82EF95))
        factors[0] = 1
        _powers = np.multiply.accumulate(factors)
    return _powers


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """64-bit hash, start and length of each white-space separated word of `data`."""
    raw = np.frombuffer(data, np.uint8)
    inside = ~SPACE[raw]
    edges = np.diff(np.concatenate(([0], inside.view(np.int8), [0])))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return np.empty(0, np.uint64), starts, starts
    lengths = ends - starts
    letters = raw[inside]
    firsts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(len(letters)) - np.repeat(firsts, lengths)
    powers = _power_table(int(lengths.max()))
    sums = np.add.reduceat(_bytes_table[letters] * powers[place], firsts)
    return mix64(sums + lengths.astype(np.uint64) * ODD), starts, lengths


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of all runs of `size` words, sorted; fewer words count as one whole run."""
    n = len(words)
    if n == 0:
        return words
    width = min(size, n)
    total = np.full(n - width + 1, np.uint64(width))
    for i in range(width):
        total = mix64(total * ODD + words[i : n - width + 1 + i])
    return np.unique(total)
