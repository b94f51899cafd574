"""Exact repeats of long byte strings by a suffix array over anchored contexts, and their removal.

A byte string of LENGTH that occurs twice has the same lowest SEED-byte hash in both places. These anchors, about one in
eighty bytes, are the sampled suffixes. Anchors with equal seeds form a bucket of the suffix array:

* An anchor's context reaches as far to either side as a string of LENGTH around the seed can. Contexts that occur twice
  as a whole are repeated as a whole; they are found by counting, and never meet in one task.
* The distinct contexts of a seed are sorted by what follows; a stack scan over the common prefixes of neighbours gives
  the tree of prefix intervals. In each interval members are ordered by what precedes them: where the left extensions
  of neighbours agree far enough, members share a maximal repeat. All members of an interval are tested, not only
  neighbours in the suffix array, so every repeat of LENGTH or more is found with all its occurrences.

* A seed with more than BUCKET distinct contexts is not brought into one task. Every string of LENGTH belongs to the
  leftmost lowest seed in it, so the strings of such a seed are told by a hash each, at most as many as the bytes in
  question, and counted; those that occur twice are repeats. Groups combine before the shuffle, and none is cut.

Matches never cross documents; equal strings in one document count. Nulls and empty texts have no bytes. Documents are
told apart by id and text, so that rows with equal ids, or none, keep their own spans; equal rows repeat each other.
Columns other than `doc_id` and `text` are only carried. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import ODD, _bytes_table, _power_table, cut, mix64, stored

LENGTH, SEED = 200, 40
#: Most contexts that one task holds of a group.
BUCKET = 4096
#: Most rows of two numbers that are sent to every task; more are joined by a shuffle.
SMALL = 500_000
STEP = 1 << 21
_inverses = np.ones(1, np.uint64)


def _inverse_table(length: int) -> np.ndarray:
    """Inverses of the powers in _power_table, modulo 2**64."""
    global _inverses
    if len(_inverses) < length:
        factors = np.full(max(length, 2 * len(_inverses)), np.uint64(pow(int(_power_table(2)[1]), -1, 1 << 64)))
        factors[0] = 1
        _inverses = np.multiply.accumulate(factors)
    return _inverses


def _slide(op, x: np.ndarray, width: int) -> np.ndarray:
    """`op` (minimum or maximum) over every run of `width` values."""
    size = 1
    while 2 * size <= width:
        x, size = op(x[:-size], x[size:]), 2 * size
    return op(x[: len(x) - (width - size)], x[width - size :]) if size < width else x


def anchors(data: bytes, length: int = LENGTH, seed: int = SEED) -> tuple[np.ndarray, ...]:
    """Key of the seed, hash of the context, position, and bytes of context before and from there, of each anchor."""
    n, reach = len(data), length - seed
    parts = []
    for first in range(0, n - length + 1, STEP):
        low, high = max(0, first - reach), min(n, first + STEP + 2 * length)
        raw = np.frombuffer(data, np.uint8, high - low, low)
        powers, inverses = _power_table(len(raw) + 1), _inverse_table(len(raw) + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_bytes_table[raw] * powers[: len(raw)])))
        keys = mix64((sums[seed:] - sums[:-seed]) * inverses[: len(raw) - seed + 1])
        starts = min(STEP, n - length + 1 - first)
        lowest = _slide(np.minimum, keys[first - low : first - low + starts + reach], reach + 1)
        bounds = np.concatenate((np.zeros(reach, np.uint64), lowest, np.zeros(reach, np.uint64)))
        at = first - low + np.flatnonzero(
            _slide(np.maximum, bounds, reach + 1) == keys[first - low : first - low + starts + reach]
        )
        before = np.minimum(at + low, reach)
        after = np.minimum(n - (at + low), length)
        context = (sums[at + after] - sums[at - before]) * inverses[at - before]
        context = mix64(context + (before * 1024 + after).astype(np.uint64) * ODD)
        parts.append((keys[at], context, at + low, before, after))
    if not parts:
        empty = np.empty(0, np.int64)
        return empty.astype(np.uint64), empty.astype(np.uint64), empty, empty, empty
    joined = [np.concatenate(x) for x in zip(*parts, strict=True)]
    _, once = np.unique(joined[2], return_index=True)
    return tuple(x[once] for x in joined)


def _encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _uid():
    return F.xxhash64("doc_id", "text")


def anchor_rows(documents: DataFrame, length: int, seed: int) -> DataFrame:
    """`key`, `context`, `uid`, `at`, `before`, `after` of all anchors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 512):
                some = batch.slice(first, 512)
                found = [anchors(_encoded(t), length, seed) for t in some.column("text").to_pylist()]
                uid = np.repeat(some.column("uid").to_numpy(), [len(f[0]) for f in found])
                key, context, at, before, after = (np.concatenate(x) for x in zip(*found, strict=True))
                columns = [key.view(np.int64), context.view(np.int64), uid, at, before.astype(np.int16), after.astype(np.int16)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in columns], ["key", "context", "uid", "at", "before", "after"]
                )

    rows = documents.select(_uid().alias("uid"), "text")
    return rows.mapInArrow(run, "key long, context long, uid long, at long, before short, after short")


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while low < high:
        middle = (low + high + 1) // 2
        if a[:middle] == b[:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def prefix_intervals(common: list[int]) -> Iterator[tuple[int, int, int]]:
    """Intervals (prefix length, first, last) of the tree over a suffix array, from its neighbours' common prefixes."""
    stack: list[tuple[int, int]] = []
    for i, value in enumerate([*common, -1]):
        first = i
        while stack and stack[-1][0] > value:
            length, first = stack.pop()
            yield length, first, i
        if not stack or stack[-1][0] < value:
            stack.append((value, first))


def maximal_repeats(members: list[tuple[bytes, bytes]], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """Bytes before and from the anchor of each maximal repeat of at least `length` bytes, and all its occurrences.

    `members` are (reversed text before, text from the anchor on). An interval of the prefix tree holds all members with
    the same bytes from the anchor on. Ordered by what precedes, they form a second tree, whose intervals have left
    extensions that differ. A group is maximal if its members differ in the next byte on the right as well.
    """
    order = sorted(range(len(members)), key=lambda i: members[i][1])
    place = {i: at for at, i in enumerate(order)}
    common = [_shared(members[i][1], members[j][1]) for i, j in zip(order, order[1:], strict=False)]
    for right, first, last in prefix_intervals(common):
        inside = [i for i in order[first : last + 1] if len(members[i][0]) + right >= length]
        if len(inside) < 2:
            continue
        inside.sort(key=lambda i: members[i][0])
        lefts = [_shared(members[i][0], members[j][0]) for i, j in zip(inside, inside[1:], strict=False)]
        for left, low, high in prefix_intervals(lefts):
            if left + right < length:
                continue
            group = inside[low : high + 1]
            ends = min(group, key=place.get), max(group, key=place.get)
            if _shared(members[ends[0]][1], members[ends[1]][1]) == right:
                yield left, right, group


def repeats(members: list[tuple[bytes, bytes]], length: int) -> list[tuple[int, int] | None]:
    """For each member, how far the maximal repeats it occurs in reach to either side of the anchor."""
    reach: list[tuple[int, int] | None] = [None] * len(members)
    for left, right, group in maximal_repeats(members, length):
        for m in group:
            known = reach[m] or (0, 0)
            reach[m] = (max(known[0], left), max(known[1], right))
    return reach


def own_strings(members: list[tuple[bytes, bytes]], length: int, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Member, hash and start from the anchor of every string of `length` whose leftmost lowest seed is at its anchor.

    `members` are (reversed text before, text from the anchor on), each as far as a string of `length` can reach.
    """
    reach = length - seed
    raw = np.frombuffer(b"".join(part for left, right in members for part in (left[::-1], right)), np.uint8)
    before = np.array([len(left) for left, _ in members], np.int64)
    after = np.array([len(right) for _, right in members], np.int64)
    at = np.cumsum(before + after) - after
    powers, inverses = _power_table(len(raw) + 1), _inverse_table(len(raw) + 1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_bytes_table[raw] * powers[: len(raw)])))
    keys = mix64((sums[seed:] - sums[:-seed]) * inverses[: len(raw) - seed + 1])
    steps, own = np.arange(1, reach + 1), keys[at][:, None]
    lower = (steps <= before[:, None]) & (keys[np.maximum(at[:, None] - steps, 0)] <= own)
    higher = (steps <= after[:, None] - seed) & (keys[np.minimum(at[:, None] + steps, len(keys) - 1)] < own)
    first = -np.minimum(np.where(lower.any(1), lower.argmax(1), reach), before)
    last = np.minimum(np.where(higher.any(1), higher.argmax(1), reach) - reach, after - length)
    counts = np.maximum(0, last - first + 1)
    which = np.repeat(np.arange(len(at)), counts)
    starts = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts - first, counts)
    places = at[which] + starts
    return which, mix64((sums[places + length] - sums[places]) * inverses[places]), starts


def _strings(length: int, seed: int):
    """`key`, `string`, `uid`, `first` of all strings of the anchors given with their contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 1024):
                some = batch.slice(begin, 1024)
                members = list(zip(some.column("left").to_pylist(), some.column("right").to_pylist(), strict=True))
                which, hashes, starts = own_strings(members, length, seed)
                key, uid, at = (some.column(c).to_numpy()[which] for c in ("key", "uid", "at"))
                columns = [key, hashes.view(np.int64), uid, at + starts]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key", "string", "uid", "first"])

    return run


def _joined_runs(length: int):
    """Strings of `length` as `uid`, `first`, `last`, those of a batch that touch as one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            uid, first = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("uid", "first"))
            order = np.lexsort((first, uid))
            uid, first = uid[order], first[order]
            begins = np.concatenate(([True], (uid[1:] != uid[:-1]) | (first[1:] - first[:-1] > length)))
            at = np.flatnonzero(begins)
            last = first[np.append(at[1:], len(first)) - 1] + length
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (uid[at], first[at], last)], ["uid", "first", "last"])

    return run


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut the contexts of a document's listed anchors out of its text."""
    names = ["key", "uid", "at", "left", "right"]
    for batch in batches:
        out = []
        for uid, text, spots in zip(*(batch.column(c).to_pylist() for c in ("uid", "text", "spots")), strict=True):
            data = _encoded(text)
            for s in spots:
                at = s["at"]
                out.append((s["key"], uid, at, data[at - s["before"] : at][::-1], data[at : at + s["after"]]))
        columns = list(zip(*out, strict=True)) or [()] * 5
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _bucket_repeats(length: int):
    """Repeats within the groups of a partition sorted by `key`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def spans(rows: list[tuple]) -> list[tuple[int, int, int]]:
            found = repeats([(left, right) for _, _, left, right in rows], length) if len(rows) > 1 else []
            return [(r[0], r[1] - f[0], r[1] + f[1]) for r, f in zip(rows, found, strict=False) if f]

        held, key_now = [], None
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            columns = [batch.column(c).to_pylist() for c in ("key", "uid", "at", "left", "right")]
            for key, *row in zip(*columns, strict=True):
                if key != key_now:
                    out += spans(held)
                    held, key_now = [], key
                held.append(tuple(row))
            yield _span_batch(out)
        yield _span_batch(spans(held))

    return run


def _span_batch(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["uid", "first", "last"])


def _repeated_strings(contexts: DataFrame, length: int, seed: int) -> DataFrame:
    """Spans of the strings of hot seeds that occur twice.

    Strings are counted by seed and hash, 128 bits. They are made once for the counts, which combine before the shuffle,
    and once more to find the places of the repeated ones, so that they are never written.
    """
    schema = "key long, string long, uid long, first long"
    strings = contexts.mapInArrow(_strings(length, seed), schema)
    again = cut(strings.groupBy("key", "string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"))
    if again.count() <= SMALL:
        again = F.broadcast(again)
    return strings.join(again, ["key", "string"]).select("uid", "first").mapInArrow(
        _joined_runs(length), "uid long, first long, last long"
    )


def repeated_spans(documents: DataFrame, length: int = LENGTH, seed: int = SEED, bound: int = BUCKET) -> DataFrame:
    """`uid` and the byte range `first` to `last` (exclusive) of repeats; ranges of a document may overlap."""
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = anchor_rows(documents, length, seed)
    again = cut(found.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key"))
    rows = stored(found.join(again, "key"))
    contexts = stored(
        rows.groupBy("key", "context").agg(
            F.count(F.lit(1)).alias("n"), *[F.first(c).alias(c) for c in ("uid", "at", "before", "after")]
        )
    )
    whole = contexts.where(f"n > 1 AND before + after >= {length}").select("key", "context")
    covered = rows.join(whole, ["key", "context"]).select(
        "uid", (F.col("at") - F.col("before")).alias("first"), (F.col("at") + F.col("after")).alias("last")
    )
    diverse = cut(contexts.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).where("kinds > 1"))

    spots = contexts.join(diverse.select("key"), "key").groupBy("uid").agg(
        F.collect_list(F.struct("key", "at", "before", "after")).alias("spots")
    )
    texts = documents.select(_uid().alias("uid"), "text").join(spots, "uid")
    strings = texts.mapInArrow(_contexts, "key long, uid long, at long, left binary, right binary")
    hot = diverse.where(f"kinds > {bound}").select("key")
    if not hot.isEmpty():
        strings = stored(strings)
        covered = covered.unionByName(_repeated_strings(strings.join(hot, "key", "left_semi"), length, seed))
        strings = strings.join(hot, "key", "left_anti")
    buckets = strings.repartition(parts, "key").sortWithinPartitions("key")
    partial = buckets.mapInArrow(_bucket_repeats(length), "uid long, first long, last long")
    return covered.unionByName(partial)


def _merged(spans: list | None) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s in sorted((s["first"], s["last"]) for s in spans or ()):
        if out and s[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], s[1])
        else:
            out.append(list(s))
    return [tuple(s) for s in out]


def without_repeats(documents: DataFrame, length: int = LENGTH, texts: bool = False) -> DataFrame:
    """`doc_id`, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256` of every document; with `texts` also `kept_text`.

    Every byte of a repeat goes, at all its occurrences. `kept_text` leaves out characters that lost some of their bytes.
    """
    spans = repeated_spans(documents, length).groupBy("uid").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    joined = documents.select("doc_id", _uid().alias("uid"), "text").join(spans, "uid", "left").select("doc_id", "text", "spans")
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, spans in zip(*(batch.column(c).to_pylist() for c in ("text", "spans")), strict=True):
                data, gone = _encoded(text), _merged(spans)
                ends = [0, *(x for s in gone for x in s), len(data)]
                kept = b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True))
                left = (text if not gone else kept.decode("utf-8", "ignore")) if texts else None
                out.append((len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), left))
            columns = list(zip(*out, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"],
            )

    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"
    result = joined.mapInArrow(run, schema)
    return result if texts else result.drop("kept_text")


def cut_repeats(documents: DataFrame, length: int = LENGTH) -> DataFrame:
    """`documents` with the bytes of repeats cut from `text`, and `n_chars`, where there is one, counted again."""
    spans = repeated_spans(documents, length).groupBy("uid").agg(F.collect_set(F.struct("first", "last")).alias("__spans"))
    rows = documents.withColumn("__uid", _uid()).join(spans.withColumnRenamed("uid", "__uid"), "__uid", "left")

    names = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("__spans").to_pylist(), strict=True):
                if found:
                    data, gone = _encoded(text), _merged(found)
                    ends = [0, *(x for s in gone for x in s), len(data)]
                    text = b"".join(data[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True)).decode("utf-8", "ignore")
                left.append(text)
            columns = [pa.array(left, pa.string()) if n == "text" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    result = rows.select(*documents.columns, "__spans").mapInArrow(run, documents.schema)
    if "n_chars" in documents.columns:
        result = result.withColumn("n_chars", F.length("text").cast(documents.schema["n_chars"].dataType))
    return result
