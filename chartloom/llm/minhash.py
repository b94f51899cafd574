"""Near-duplicate documents by SuperMinHash.

Every word shingle of a document deals correlated ranks: in round j it takes the j-th place of its own random
permutation and offers j plus a fraction there. Rounds stop as soon as every place of the signature is taken, since
later offers are higher. Signatures are cut into bands; documents that share a band are candidates, candidates are
verified on their full shingle sets, and links are joined to components.

Documents with equal shingle sets are one class and go through as one. A class can share with others only shingles that
are in some other candidate as well; where these are too few for any link, it is no candidate. Within a bucket not all
pairs are made: all members are compared with the one that has the least of its own, which joins nearly all that belong
together. Members left outside the bucket's largest component are then compared with all of that component, block by
block within tasks, and with each other. A pair of bucket mates is left out only if it is known to be in one component
or too unlike, so no link between components is missed, and no bucket is capped.

Null and empty texts have no shingles and are linked with nothing; rows with a null id stand alone. Rows are told
apart by id and text, so rows with equal ids and different texts can be in different components. Columns other than `doc_id` and `text` are not read. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import ODD, cut, mix64, row_key, shingle_hashes, word_hashes
from chartloom.llm.components import components

PLACES, ROWS = 128, 4
CHUNK = 500
BLOCK = 512


def signatures(hashes: np.ndarray, owner: np.ndarray, count: int, places: int = PLACES) -> np.ndarray:
    """SuperMinHash signatures of `count` sets given as element hashes and the set each belongs to."""
    best = np.full((count, places), np.inf)
    flat, order = best.ravel(), None
    for j, step in enumerate(np.arange(1, places + 1, dtype=np.uint64) * ODD):
        seed = mix64(hashes + step)
        offer = j + (seed >> np.uint64(11)).astype(np.float64) / 2.0**53
        pick = j + ((mix64(seed) >> np.uint64(32)) * np.uint64(places - j) >> np.uint64(32)).astype(np.int64)
        if order is None:
            place = pick
        else:
            rows = np.arange(len(hashes))
            place = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[:, j]
        np.minimum.at(flat, owner * places + place, offer)
        stay = np.isinf(best).any(axis=1)[owner]
        if not stay.any():
            break
        if order is None:
            hashes, owner, pick = hashes[stay], owner[stay], pick[stay]
            order = np.tile(np.arange(places, dtype=np.min_scalar_type(places)), (len(hashes), 1))
            order[np.arange(len(hashes)), pick] = 0
        elif not stay.all():
            hashes, owner, order = hashes[stay], owner[stay], order[stay]
    return best


def band_keys(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key a band for each signature; the band's number is part of the key."""
    bits = signature.view(np.uint64).reshape(len(signature), -1, rows)
    key = np.tile(np.arange(1, bits.shape[1] + 1, dtype=np.uint64), (len(bits), 1))
    for i in range(rows):
        key = mix64(key * ODD + bits[:, :, i])
    return key.view(np.int64)


def _digests(sets: list[np.ndarray]) -> np.ndarray:
    salts = np.array([0x51, 0xA7], np.uint64) * ODD
    return np.array([[mix64(s ^ salt).sum() for salt in salts] for s in sets], np.uint64).reshape(-1, 2).view(np.int64)


def shingle_set(text: str | None, words: int) -> np.ndarray:
    return shingle_hashes(word_hashes((text or "").encode("utf-8", "surrogatepass").lower())[0], words)


def sketched(documents: DataFrame, words: int) -> DataFrame:
    """`doc_id`, `uid`, `n_shingles`, a 128-bit digest of the shingles (`d1`, `d2`) and `bands` of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                some = batch.slice(at, CHUNK)
                sets = [shingle_set(t, words) for t in some.column("text").to_pylist()]
                sizes = np.array([len(s) for s in sets], np.int64)
                keys = band_keys(signatures(np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes), len(sets)))
                digests = _digests(sets)
                offsets = np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column("doc_id").cast(pa.int64()),
                        some.column("uid"),
                        pa.array(sizes),
                        pa.array(digests[:, 0]),
                        pa.array(digests[:, 1]),
                        pa.ListArray.from_arrays(offsets, pa.array(keys.ravel())),
                    ],
                    ["doc_id", "uid", "n_shingles", "d1", "d2", "bands"],
                )

    rows = documents.select("doc_id", row_key().alias("uid"), "text")
    return rows.mapInArrow(run, "doc_id long, uid long, n_shingles long, d1 long, d2 long, bands array<long>")


def shingle_sets(documents: DataFrame, words: int) -> DataFrame:
    """`node` and its sorted `shingles`, of rows with `node` and `text`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                some = batch.slice(at, CHUNK)
                sets = [shingle_set(t, words).view(np.int64) for t in some.column("text").to_pylist()]
                offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [some.column("node"), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sets)))],
                    ["node", "shingles"],
                )

    return documents.mapInArrow(run, "node long, shingles array<long>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (`a`, `b`) whose sets share at least `percent` of their union."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    common = F.size(F.array_intersect("x", "y"))
    both = pairs.join(left, "a").join(right, "b").withColumn("common", common)
    return both.where(100 * F.col("common") >= percent * (F.size("x") + F.size("y") - F.col("common"))).select("a", "b")


def _candidates(first: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs of bucket mates (`first` with any other member) in different components that can be linked at all.

    What two of them have in common is at most what either shares with any candidate.
    """
    x, y = first.alias("x"), members.alias("y")
    common = F.least("x.shared", "y.shared")
    fits = 100 * common >= percent * (F.col("x.n") + F.col("y.n") - common)
    pairs = x.join(y, "bucket").where("x.node <> y.node AND x.component <> y.component").where(fits)
    return pairs.select(
        F.greatest("x.node", "y.node").alias("a"), F.least("x.node", "y.node").alias("b")
    ).distinct()


def _able(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Members with the number of their shingles that other members have (`shared`), where it suffices for a link."""
    single = sets.select("node", F.explode("shingles").alias("shingle")).groupBy("shingle")
    single = single.agg(F.count(F.lit(1)).alias("holders"), F.min("node").alias("node")).where("holders = 1")
    own = single.groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    shared = members.join(own, "node", "left").withColumn("shared", F.col("n") - F.coalesce("own", F.lit(0)))
    return shared.where(100 * F.col("shared") >= percent * F.col("n")).drop("own")


def linked_components(classes: DataFrame, documents: DataFrame, words: int, percent: int) -> DataFrame:
    """`node` and `component` of the classes (`node`, `n`, `bands`) that are linked to a lower one."""
    banded = classes.select("node", "n", F.explode("bands").alias("bucket"))
    mates = cut(banded.groupBy("bucket").agg(F.count(F.lit(1)).alias("mates")).where("mates > 1").select("bucket"))
    members = cut(banded.join(mates, "bucket").select("bucket", "node", "n"))
    wanted = members.select("node").distinct()
    texts = documents.select(row_key().alias("node"), "text").join(wanted, "node", "left_semi")
    sets = cut(shingle_sets(texts, words))
    members = cut(_able(members, sets, percent))
    least = F.min(F.struct((F.col("n") - F.col("shared")) / F.col("n"), "node"))["node"]
    hubs = cut(members.groupBy("bucket").agg(least.alias("hub"), F.count(F.lit(1)).alias("mates")).where("mates > 1"))
    members = cut(members.join(hubs.drop("mates"), "bucket"))
    fresh = members.withColumn("component", F.col("node"))
    links = cut(verified(_candidates(fresh.where("node = hub"), fresh, percent), sets, percent))
    placed = cut(_placed(members, links))
    sizes = placed.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("held"))
    main = sizes.groupBy("bucket").agg(
        F.max(F.struct("held", "component"))["component"].alias("main"), F.count(F.lit(1)).alias("kinds")
    )
    outside = cut(placed.join(cut(main.where("kinds > 1")), "bucket").where("component <> main"))
    return components(links.union(_against(outside, placed, sets, percent)))


def _placed(members: DataFrame, links: DataFrame) -> DataFrame:
    found = components(links)
    return members.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _against(outside: DataFrame, placed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of the nodes `outside` with any member of their buckets' `main` component, and with each other.

    One link is enough for each node, block and component.

    Both sides are dealt to blocks of about BLOCK sets; every pair of blocks is compared in a task of its own.
    """
    asked = cut(outside.select(F.col("main").alias("part"), "node", "component").distinct())
    parts = asked.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("p"))
    inside = placed.select(F.col("component").alias("part"), "node", "component").distinct()
    held = cut(inside.join(cut(parts), "part").union(asked.join(parts, "part")))
    blocks = held.groupBy("part", "p").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("q"))
    blocks = cut(blocks)

    def dealt(rows: DataFrame, own: str, mine: str, every: str, other: str) -> DataFrame:
        cells = rows.join(blocks, "part").withColumn(own, F.pmod(F.xxhash64("node"), F.col(mine)))
        cells = cells.withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), F.col(every) - 1)))
        named = cells.join(sets, "node").select("part", "x", "y", "node", "component", "shingles")
        return named.toDF("part", "x", "y", "node", "component", "shingles").groupBy("part", "x", "y")

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            sizes = right["shingles"].map(len).to_numpy()
            values = np.concatenate(right["shingles"].to_numpy())
            order = np.argsort(values, kind="stable")
            values, owner = values[order], np.repeat(np.arange(len(right)), sizes)[order]
            parts = right["component"].to_numpy()
            for node, part, own in zip(left["node"], left["component"], left["shingles"], strict=True):
                first, last = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
                spans = last - first
                at = np.repeat(first - np.cumsum(spans) + spans, spans) + np.arange(spans.sum())
                common = np.bincount(owner[at], minlength=len(right))
                hits = np.flatnonzero((100 * common >= percent * (len(own) + sizes - common)) & (parts != part))
                for at in hits[np.unique(parts[hits], return_index=True)[1]]:
                    found.append((node, right["node"].iloc[at]))
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": pairs.max(1, initial=-(2**63)), "b": pairs.min(1, initial=2**63 - 1)})

    cells = dealt(asked, "x", "p", "q", "y").cogroup(dealt(held.drop("p"), "y", "q", "p", "x"))
    return cells.applyInPandas(compare, "a long, b long")


def linked_rows(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """`doc_id`, `uid` (row_key), `n_shingles`, `root` and `component_id` of every document.

    `root` tells components apart; `component_id` is the least id of a component, which two of them can have in common.
    """
    rows = cut(sketched(documents, words))
    able = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    classes = cut(
        rows.where(able)
        .groupBy("d1", "d2", "n_shingles")
        .agg(F.min(F.struct("doc_id", "uid")).alias("low"), F.first("bands").alias("bands"))
        .select("d1", "d2", F.col("n_shingles").alias("n"), F.col("low.uid").alias("node"), F.col("low.doc_id").alias("low"), "bands")
    )
    found = linked_components(classes, documents, words, percent)
    named = classes.join(found, "node", "left").select(
        "d1", "d2", F.col("n").alias("n_shingles"), F.coalesce("component", "node").alias("root"), "low"
    )
    named = cut(named)
    least = cut(named.groupBy("root").agg(F.min("low").alias("component_id")))
    linked = rows.where(able).drop("bands").join(named.drop("low").join(least, "root"), ["d1", "d2", "n_shingles"])
    alone = rows.where(~able).drop("bands").withColumn("root", F.col("uid")).withColumn("component_id", F.col("doc_id"))
    return linked.unionByName(alone).select("doc_id", "uid", "n_shingles", "root", "component_id")


def near_duplicates(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """`doc_id`, `n_shingles`, `component_id` (the least id linked with it, however far) and `kept` of every document."""
    every = linked_rows(documents, words, percent)
    return every.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
