"""Language-model scoring by context-tree weighting over the bytes of words.

A text is its words in turn, each closed by a space, then an end. Every byte is eight binary decisions. A decision's
contexts are the bytes before it, none to DEPTH of them, whichever words they are of. Each context keeps a Krichevsky-Trofimov estimate, and the weighted probability of a context is half its own estimate
and half the product of its children's, over all depths. Predictions of the trained tree are linear in the estimates
along a path, so the tree is folded from the leaves up for its weights and from the root down for its predictions.
Counts of distinct n-grams are dealt by the last TOP bytes of context, so each task folds whole subtrees; the levels
above them, bounded by the alphabet, are folded on the driver.

The corpus comes in blocks, parts of file splits of bounded size. A block asks once for each of its distinct words and
n-grams, so frequent words are one row a block however many documents hold them; answers meet the block's texts again.

Null and empty texts are the end alone. Rows with equal ids are scored each. Null ids are learned from. Without training
texts every decision has probability one half and every base probability is 1. Columns other than `doc_id` and `text`
are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartloom.llm.common import ODD, cut, mix64, word_hashes

DEPTH, TOP = 6, 2
SLICE = 1 << 20
BLOCK_BYTES = 16 << 20
END = b"\n"
END_HASH = np.uint64(0xE4D)


def with_block(documents: DataFrame) -> DataFrame:
    """`documents` with `block`: the file split a row comes from, in parts where splits are large."""
    size = documents.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    parts = max(1, round(size / BLOCK_BYTES))
    part = F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts))
    return documents.withColumn("block", F.xxhash64(F.input_file_name(), F.expr("input_file_block_start()"), part))


def _lower(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()


def words_of(data: bytes) -> np.ndarray:
    """Hashes of the words of a text, then of the end."""
    return np.append(word_hashes(data)[0], END_HASH)


def gram_keys(data: bytes, depth: int = DEPTH) -> Iterator[np.ndarray]:
    """One number for each byte of a text: its `depth` bytes of context, oldest first, and the byte."""
    raw = np.frombuffer(END * depth + b" ".join([b"", *data.split(), END]), np.uint8).astype(np.int64)
    for at in range(0, len(raw) - depth - 1, SLICE):
        some = raw[at : at + SLICE + depth + 1]
        key = some[depth + 1 :].copy()
        for back in range(1, depth + 1):
            key += some[depth + 1 - back : len(some) - back] << (8 * back)
        yield key


def _folded(keys: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    found, where = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(where, np.concatenate(n), len(found))


class _Tally:
    """Distinct keys of a block with their counts in training texts."""

    def __init__(self):
        self.keys, self.n = [np.empty(0, np.int64)], [np.empty(0)]
        self.fresh: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
        self.size = 0

    def add(self, keys: np.ndarray, held_out: bool) -> None:
        self.fresh[held_out].append(keys.view(np.int64))
        self.size += len(keys)
        if self.size > 4 * SLICE:
            self.fold()

    def fold(self) -> tuple[np.ndarray, np.ndarray]:
        for held_out, parts in enumerate(self.fresh):
            if parts:
                keys, n = np.unique(np.concatenate(parts), return_counts=True)
                self.keys.append(keys)
                self.n.append(n * (0.0 if held_out else 1.0))
        keys, n = _folded(self.keys, self.n)
        self.keys, self.n, self.fresh, self.size = [keys], [n], ([], []), 0
        return keys, n


def _asked(split: Callable[[bytes], Iterable[np.ndarray]]):
    """Rows (`block`, `key`, `n`) of what the texts of each block are made of."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, _Tally] = {}
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("block", "held_out", "text"))
            for block, held_out, text in zip(*columns, strict=True):
                tally = found.setdefault(block, _Tally())
                for keys in split(_lower(text)):
                    tally.add(keys, bool(held_out))
        for block, tally in found.items():
            keys, n = tally.fold()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), block)), pa.array(keys), pa.array(n.astype(np.int64))],
                ["block", "key", "n"],
            )

    return run


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after a shift by eight, exact to about 1e-12 for x >= 0.5."""
    y, product = x + 8, np.ones_like(x)
    for i in range(8):
        product = product * (x + i)
    series = 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5)
    return (y - 0.5) * np.log(y) - y + 0.5 * math.log(2 * math.pi) + series - np.log(product)


def estimate(zero: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Log probability of the counts under Krichevsky and Trofimov."""
    return _log_gamma(zero + 0.5) + _log_gamma(one + 0.5) - math.log(math.pi) - _log_gamma(zero + one + 1)


class Level:
    """Nodes (context and bits so far) of one depth: counts, weighted probability, and whether they are leaves."""

    def __init__(self, node, zero, one, weighted, leaf: bool = False):
        order = np.argsort(node)
        self.node, self.zero, self.one, self.weighted = (x[order] for x in (node, zero, one, weighted))
        self.leaf = leaf

    @classmethod
    def of_leaves(cls, node: np.ndarray, zero: np.ndarray, one: np.ndarray) -> Level:
        found, where = np.unique(node, return_inverse=True)
        zero, one = (np.bincount(where, x, len(found)) for x in (zero, one))
        return cls(found, zero, one, estimate(zero, one), True)

    def parents(self, depth: int) -> np.ndarray:
        return (self.node >> 8 & (1 << 8 * (depth - 1)) - 1) << 8 | self.node & 255

    def above(self, depth: int) -> Level:
        """The level of depth - 1: parents of these nodes."""
        found, where = np.unique(self.parents(depth), return_inverse=True)
        zero, one, below = (np.bincount(where, x, len(found)) for x in (self.zero, self.one, self.weighted))
        return Level(found, zero, one, np.logaddexp(estimate(zero, one), below) - math.log(2))

    def mixed(self, sure: np.ndarray, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Prediction of a one settled down to here, and the share left to deeper contexts."""
        chance = (self.one + 0.5) / (self.zero + self.one + 1)
        if self.leaf:
            return sure + open_ * chance, np.zeros_like(open_)
        share = np.exp(estimate(self.zero, self.one) - self.weighted - math.log(2))
        return sure + open_ * share * chance, open_ * (1 - share)


def _bits(keys: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Node and bit of each of the eight decisions of a key."""
    context, byte = keys >> 8 & (1 << 48) - 1, keys & 255
    for j in range(8):
        yield context << 8 | (1 << j) + (byte >> 8 - j), byte >> 7 - j & 1


def fold_up(keys: np.ndarray, n: np.ndarray, depth: int, top: int) -> dict[int, Level]:
    """Levels `depth` to `top` of the subtrees that hold `keys`."""
    node, bit = (np.concatenate(x) for x in zip(*_bits(keys), strict=True))
    every = np.tile(n, 8)
    levels = {depth: Level.of_leaves(node, np.where(bit == 0, every, 0), np.where(bit == 1, every, 0))}
    for d in range(depth, top, -1):
        levels[d - 1] = levels[d].above(d)
    return levels


def gram_scores(counts: DataFrame, depth: int = DEPTH, top: int = TOP) -> DataFrame:
    """`key` and `log10p`, the model's probability of the byte in its context, from training counts (`key`, `n`)."""
    part = F.shiftright("key", 8).bitwiseAND(F.lit((1 << 8 * top) - 1))
    counts = cut(counts.select("key", "n", part.alias("part")))

    def roots(table: pa.Table) -> pa.Table:
        keys, n = table.column("key").to_numpy(), table.column("n").to_numpy().astype(float)
        level = fold_up(keys, n, depth, top)[top]
        names = ["node", "zero", "one", "weighted"]
        return pa.table([pa.array(getattr(level, c)) for c in names], names=names)

    tops = counts.groupBy("part").applyInArrow(roots, "node long, zero double, one double, weighted double").toPandas()
    levels = [Level(*(tops[c].to_numpy() for c in ("node", "zero", "one", "weighted")))]
    for d in range(top, 0, -1):
        levels.insert(0, levels[0].above(d))
    sure, open_ = np.zeros(len(levels[0].node)), np.ones(len(levels[0].node))
    for d, level in enumerate(levels):
        if d:
            at = np.searchsorted(levels[d - 1].node, level.parents(d))
            sure, open_ = sure[at], open_[at]
        if d < top:
            sure, open_ = level.mixed(sure, open_)
    shared = counts.sparkSession.sparkContext.broadcast((levels[-1].node, sure, open_))

    def score(table: pa.Table) -> pa.Table:
        keys, n = table.column("key").to_numpy(), table.column("n").to_numpy().astype(float)
        tree, (node, sure, open_) = fold_up(keys, n, depth, top), shared.value
        known: dict[int, tuple] = {}
        for d in range(top, depth + 1):
            if d == top:
                at = np.searchsorted(node, tree[d].node)
                known[d] = tree[d].mixed(sure[at], open_[at])
            else:
                at = np.searchsorted(tree[d - 1].node, tree[d].parents(d))
                known[d] = tree[d].mixed(*(x[at] for x in known[d - 1]))
        total = np.zeros(len(keys))
        for node, bit in _bits(keys):
            one = known[depth][0][np.searchsorted(tree[depth].node, node)]
            total += np.log10(np.where(bit == 1, one, 1 - one))
        return pa.table([pa.array(keys), pa.array(total)], names=["key", "log10p"])

    return counts.groupBy("part").applyInArrow(score, "key long, log10p double")


SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double, n_bytes long, bits_per_byte double"
)


class Lookup:
    """Values of distinct keys by direct address; keys whose place is taken are looked up in a table of their own."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, level: int = 1):
        self.shift = np.uint64(64 - max(3, len(keys).bit_length() + 1))
        self.factor = mix64(np.full(1, level, np.uint64)) | np.uint64(1)
        place = self._place(keys)
        holder = np.full(1 << 64 - int(self.shift), -1)
        holder[place] = np.arange(len(keys))
        late = holder[place] != np.arange(len(keys))
        self.keys, self.values = np.append(keys, 0)[holder], np.append(values, 0.0)[holder]
        self.rest = Lookup(keys[late], values[late], level + 1) if late.any() else None

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * self.factor >> self.shift).view(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """Values of keys that are all in the table."""
        place = self._place(keys)
        found = self.values[place]
        if self.rest is not None:
            late = np.flatnonzero(self.keys[place] != keys)
            found[late] = self.rest(keys[late])
        return found


def _groups(ids: list, held_out: list, texts: list) -> Iterator[list[tuple]]:
    """Rows with their lower-cased bytes, about SLICE bytes at a time."""
    some, size = [], 0
    for row in zip(ids, held_out, map(_lower, texts), strict=True):
        some.append(row)
        size += len(row[2])
        if size > SLICE:
            yield some
            some, size = [], 0
    if some:
        yield some


def _sums(values: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Sums of runs of the given sizes, none of which is empty."""
    return np.add.reduceat(values, np.cumsum([0, *sizes[:-1]]))


def _scorer(total: int, distinct: int):
    """Scores of a block's texts from the answers to what it asked."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        is_word, keys, values = (right.column(c).to_numpy() for c in ("word", "key", "value"))
        counted, logs = Lookup(keys[is_word], values[is_word]), Lookup(keys[~is_word], values[~is_word])
        out, base = [], math.log10(total + distinct + 1)
        for some in _groups(*(left.column(c).to_pylist() for c in ("doc_id", "held_out", "text"))):
            grams = [[*gram_keys(data)] for *_, data in some]
            words_ = [words_of(data).view(np.int64) for *_, data in some]
            counts = counted(np.concatenate(words_))
            score = _sums(logs(np.concatenate([k for keys in grams for k in keys])), [sum(map(len, keys)) for keys in grams])
            sizes = [len(w) for w in words_]
            base_score = _sums(np.log10(counts + 1) - base, sizes)
            known = _sums((counts > 0).astype(np.int64), sizes)
            for i, (doc_id, held_out, _) in enumerate(some):
                size = sum(map(len, grams[i]))
                bits = -float(score[i]) / math.log10(2) / size
                out.append((doc_id, held_out, sizes[i], int(known[i]), total, float(base_score[i]), float(score[i]), size, bits))
        kinds = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
        fields = [(f.split()[0], kinds[f.split()[1]]) for f in SCHEMA.split(", ")]
        data = list(zip(*out, strict=True)) or [()] * len(fields)
        return pa.table([pa.array(c, k) for c, (_, k) in zip(data, fields, strict=True)], names=[n for n, _ in fields])

    return run


def score_texts(documents: DataFrame, held_out: Column) -> DataFrame:
    """Token counts, unigram base score and context-tree score (log10) of every text; learned from those not held out.

    Words are told apart by a 64-bit hash.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    blocks = with_block(rows)
    texts, schema = blocks.select("block", "held_out", "text"), "block long, key long, n long"
    asked_words = texts.mapInArrow(_asked(lambda data: [words_of(data)]), schema)
    asked_grams = texts.mapInArrow(_asked(gram_keys), schema)
    counted = asked_words.groupBy("key").agg(F.sum("n").alias("n"))
    totals = counted.agg(F.sum("n").alias("n"), F.sum((F.col("n") > 0).cast("long")).alias("v")).first()
    scores = cut(gram_scores(asked_grams.groupBy("key").agg(F.sum("n").alias("n"))))
    held = F.sum("n").over(Window.partitionBy("key"))
    word_answers = asked_words.select("block", F.lit(True).alias("word"), "key", held.cast("double").alias("value"))
    gram_answers = asked_grams.drop("n").join(scores, "key")
    gram_answers = gram_answers.select("block", F.lit(False).alias("word"), "key", F.col("log10p").alias("value"))
    scorer = _scorer(totals["n"] or 0, totals["v"] or 0)
    return blocks.groupBy("block").cogroup(word_answers.union(gram_answers).groupBy("block")).applyInArrow(scorer, SCHEMA)
