"""Hard negatives by vertical scans of columnar blocks (branch and bound on decomposed vectors).

Rows are dealt to blocks that keep one column per dimension with its least and greatest value. An anchor reads the
columns of a block in descending order of its own magnitude there. What the columns not yet read can add lies between
two sums, from their least and greatest values, so every candidate has bounds; those whose bounds rule them out leave
the candidate bitmap, and the last ones are scored exactly. All arithmetic is on whole numbers and exact.

A first scan finds each anchor's best rows of its own label, the positives. A second one finds, for every positive, the
best rows of other labels whose score lies in a window below the positive's; one scan serves all windows of an anchor.
Blocks return at most `k` rows an anchor (and window), which are merged. Every batch of anchors meets every block in a
task of its own, which computes for seconds on the megabytes that both sides bring.

Rows take no part if label or vector is null, if a component is null or not finite, or if the squared length of the
whole-number vector is 2**62 or more, as its scores need not fit 64 bits. Vectors of unlike lengths are never compared;
empty ones have score 0 with each other. Equal rows (id, label and vector) travel as one with a count and come out as
often as they are there; as anchors they are one. Unlike rows with one id are rows of their own. Rows without id are
candidates with a null id, last among ties, and no anchors. Ties go to the smaller id. Columns other than the three are not read. An empty table gives no rows.
"""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartloom.llm.common import cut

BLOCK_VALUES = 1 << 21  # numbers in a block: at 64 dimensions 32,768 rows
ANCHORS = 1024  # anchors of one length that travel as one row
STEP = 8  # columns read between two looks at the bounds
FEW = 64  # candidates that are scored without more bounds
EXACT = 2.0**53
NO_ID = 2**63 - 1


def whole_rows(vectors: DataFrame, label: Column, scale: int) -> DataFrame:
    """`vec_id`, `label`, `values` (whole numbers), `size` and `copies` of the rows that take part, equal ones as one."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), "embedding")
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x))
    rows = rows.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    length = F.aggregate("embedding", F.lit(0.0), lambda sum_, x: sum_ + F.pow(F.floor(scale * x.cast("double")).cast("double"), 2))
    rows = rows.where(length < 2.0**62)
    values = F.transform("embedding", lambda x: F.floor(scale * x.cast("double")).cast("long"))
    rows = rows.select("vec_id", "label", values.alias("values")).groupBy("vec_id", "label", "values")
    return rows.agg(F.count(F.lit(1)).alias("copies")).withColumn("size", F.size("values"))


def _packed(**arrays: np.ndarray) -> bytes:
    data = io.BytesIO()
    np.savez(data, **arrays)
    return data.getvalue()


def _columns(table: pa.Table) -> pa.Table:
    """One block: its rows as a column per dimension."""
    rows = table.num_rows
    flat = table.column("values").combine_chunks().flatten().to_numpy().reshape(rows, table.column("size")[0].as_py())
    if flat.size and np.abs(flat).max() < 2**31:
        flat = flat.astype(np.int32)
    ids = table.column("vec_id").fill_null(NO_ID).to_numpy()
    order = np.argsort(ids, kind="stable")
    data = _packed(
        columns=np.ascontiguousarray(flat[order].T),
        keys=table.column("key").to_numpy()[order],
        ids=ids[order],
        labels=table.column("label").to_numpy()[order],
        copies=table.column("copies").to_numpy()[order],
    )
    key = [table.column(c).slice(0, 1) for c in ("size", "block")]
    return pa.table([*key, pa.array([data], pa.binary())], names=["size", "block", "data"])


class Block:
    """Rows as columns, in the order of their ids."""

    def __init__(self, data: bytes):
        held = np.load(io.BytesIO(data))
        self.columns, self.keys, self.ids = held["columns"], held["keys"], held["ids"]
        self.labels, self.copies = held["labels"], held["copies"]
        self.low, self.high = (self.columns.min(1), self.columns.max(1)) if len(self.ids) else (None, None)
        self.greatest = max((abs(int(x)) for x in (self.low.min(initial=0), self.high.max(initial=0))), default=0)

    def scan(self, anchor: np.ndarray, rows: np.ndarray, open_: Callable) -> tuple[np.ndarray, np.ndarray]:
        """Those of `rows` that stay open and their exact scores; open_(rows, low, high) tells which ones by their bounds."""
        size = len(anchor)
        exact = size * self.greatest * int(np.abs(anchor).max(initial=0)) < EXACT
        kind = np.float64 if exact else object
        order = np.argsort(-np.abs(anchor), kind="stable")
        weights = anchor[order].astype(kind)
        ends = np.stack((weights * self.low[order].astype(kind), weights * self.high[order].astype(kind)))
        least, most = (np.append(np.cumsum(e[::-1])[::-1], kind(0) if exact else 0) for e in (ends.min(0), ends.max(0)))
        scores = np.zeros(len(rows), kind)
        for at in range(0, size, STEP):
            columns = order[at : at + STEP]
            if len(rows) <= FEW:
                columns = order[at:]
            some = self.columns[columns] if len(rows) == len(self.ids) else self.columns[np.ix_(columns, rows)]
            scores = scores + weights[at : at + len(columns)] @ some.astype(kind)
            at += len(columns)
            stay = open_(rows, scores + least[at], scores + most[at])
            rows, scores = rows[stay], scores[stay]
            if at == size or not len(rows):
                break
        return rows, scores


def _kth(scores: np.ndarray, copies: np.ndarray, k: int):
    """The k-th greatest of `scores`, each there `copies` times; None if there are fewer."""
    if not len(scores):
        return None
    whole = scores.dtype == object or len(scores) <= 4 * k
    order = np.argsort(-scores, kind="stable") if whole else np.argpartition(-scores, k)[: k + 1]
    order = order[np.argsort(-scores[order], kind="stable")]
    enough = np.flatnonzero(np.cumsum(copies[order]) >= k)
    return scores[order[enough[0]]] if len(enough) else None


def _best(block: Block, rows: np.ndarray, scores: np.ndarray, k: int) -> Iterator[tuple[int, int]]:
    """(score, id) of the k best rows, each as often as it is there. Rows are in the order of ids."""
    left = k
    for i in np.argsort(-scores, kind="stable")[:k]:
        for _ in range(min(left, int(block.copies[rows[i]]))):
            yield int(scores[i]), int(block.ids[rows[i]])
        left -= min(left, int(block.copies[rows[i]]))
        if not left:
            return


def positives_in(block: Block, anchor: dict, k: int) -> list[tuple]:
    """The k best other rows of the anchor's label: (rank of the window: 0, score, id)."""
    copies = block.copies - (block.keys == anchor["key"])
    rows = np.flatnonzero((block.labels == anchor["label"]) & (copies > 0))

    def open_(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        least = _kth(low, copies[rows], k)
        return np.ones(len(rows), bool) if least is None else high >= least

    rows, scores = block.scan(anchor["values"], rows, open_)
    held, block.copies = block.copies, copies
    found = [(0, *pair) for pair in _best(block, rows, scores, k)]
    block.copies = held
    return found


def negatives_in(block: Block, anchor: dict, k: int, least_percent: int) -> list[tuple]:
    """For each window of the anchor the k best rows of other labels in it: (its number, score, id)."""
    tops = [(n, top) for n, top in enumerate(anchor["tops"]) if top >= 0]
    windows = [(n, -(-least_percent * top // 100), top) for n, top in tops]
    rows = np.flatnonzero(block.labels != anchor["label"])

    def open_(rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        stay = np.zeros(len(rows), bool)
        for _, bottom, top in windows:
            sure = np.flatnonzero((high <= top) & (low >= bottom))
            least = _kth(low[sure], block.copies[rows[sure]], k)
            stay |= (high >= (bottom if least is None else max(bottom, least))) & (low <= top)
        return stay

    rows, scores = block.scan(anchor["values"], rows, open_)
    found = []
    for n, bottom, top in windows:
        inside = (scores >= bottom) & (scores <= top)
        found += [(n, *pair) for pair in _best(block, rows[inside], scores[inside], k)]
    return found


def _scan_blocks(search: Callable[[Block, dict], list[tuple]]) -> Callable:
    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        for data in left["data"]:
            block = Block(data)
            for keys, labels, values, tops in zip(right["keys"], right["labels"], right["vectors"], right["tops"], strict=True):
                vectors = np.array(values, np.int64).reshape(len(keys), -1)
                for key, label, vector, top in zip(keys, labels, vectors, tops, strict=True):
                    anchor = {"key": key, "label": label, "values": vector, "tops": [] if top is None else [int(t) for t in top]}
                    out += [(key, *row) for row in search(block, anchor)]
        columns = [np.array(c, np.int64) for c in zip(*out, strict=True)] or [np.empty(0, np.int64)] * 4
        return pd.DataFrame(dict(zip(("key", "window", "score", "id"), columns, strict=True)))

    return run


def _found(blocks: DataFrame, anchors: DataFrame, search: Callable[[Block, dict], list[tuple]], k: int) -> DataFrame:
    """`key`, `window`, `rank`, `score` and `id` of the k best of all blocks. `anchors`: key, label, values, size, tops."""
    one = F.struct("key", "label", "values", "tops")
    lanes, count = max(1, -(-anchors.count() // ANCHORS)), blocks.agg(F.max("block")).first()[0] or 0
    dealt = anchors.withColumn("lane", F.pmod(F.xxhash64("key"), F.lit(lanes)).cast("int"))
    batches = dealt.groupBy("size", "lane").agg(F.sort_array(F.collect_list(one)).alias("many"))
    batches = batches.select(
        "size", "lane", F.col("many.key").alias("keys"), F.col("many.label").alias("labels"),
        F.flatten("many.values").alias("vectors"), F.col("many.tops").alias("tops"),
        F.explode(F.sequence(F.lit(0), F.lit(count))).alias("block"),
    )
    left = blocks.withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))).groupBy("size", "block", "lane")
    right = batches.groupBy("size", "block", "lane")
    found = left.cogroup(right).applyInPandas(_scan_blocks(search), "key long, window long, score long, id long")
    rank = F.row_number().over(Window.partitionBy("key", "window").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame, anchors: Column, label: Column, scale: int = 256, positives: int = 5, negatives: int = 5, least_percent: int = 80
) -> DataFrame:
    """For each anchor and positive the best rows of other labels that score `least_percent` to 100 percent of it.

    `vectors` has `vec_id` and `embedding`; `anchors` is a condition on `vec_id`, `label` an expression over `vectors`.
    Scores are inner products of floor(scale * component).
    """
    rows = cut(whole_rows(vectors, label, scale).withColumn("key", F.xxhash64("vec_id", "label", "values")))
    asked = cut(rows.where(F.col("vec_id").isNotNull() & anchors).select("vec_id", "key", "label", "values", "size"))
    parts = max(1, -(-(rows.agg(F.sum("size")).first()[0] or 0) // BLOCK_VALUES))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int"))
    blocks = cut(dealt.groupBy("size", "block").applyInArrow(_columns, "size int, block int, data binary"))
    none = F.lit(None).cast("array<long>")
    near = cut(_found(blocks, asked.withColumn("tops", none), lambda *x: positives_in(*x, positives), positives))
    tops = F.sort_array(F.collect_list(F.struct("rank", "score"))).getField("score").alias("tops")
    named = asked.join(near.groupBy("key").agg(tops), "key")
    hard = _found(blocks, named, lambda *x: negatives_in(*x, negatives, least_percent), negatives)
    given = asked.select("key", F.col("vec_id").alias("anchor_id")).join(near.drop("window"), "key").select(
        "key", "anchor_id", (F.col("rank") - 1).cast("long").alias("window"), F.nullif("id", F.lit(NO_ID)).alias("positive_id"),
        F.col("score").alias("positive_score"), F.col("rank").alias("positive_rank"),
    )
    return given.join(hard, ["key", "window"]).select(
        "anchor_id", "positive_id", "rank", F.nullif("id", F.lit(NO_ID)).alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"), "positive_rank",
    )
