"""Spelling variants by pivotal grams: words that are one edit apart, and the commonest form of each.

Bigrams are ordered by the number of words that have them, rare ones first. A word's prefix is its three rarest bigrams
(and all others equal to the third); two disjoint ones of the prefix, chosen by dynamic programming as the rarest such
pair, are its pivots. Of two words one edit apart, take the one whose third bigram comes first in the order: the edit
leaves one of its pivots whole, and that one is in the other word's prefix, since it is no later than the other's third
bigram either. So pivots are looked up among prefixes only.

A pivot is looked up with its position limits. The edit lies behind the first pivot or before the second one, so a word
that holds the pivot has it at the same distance from the start, or from the end. The part with the edit is halved: one
half is untouched, and its letters are part of the key as well. What keys bring together is verified by edit distance.

Words have at least MIN_LENGTH code points; null texts have none, null ids count as empty in the digest of damaged()
runs. Words that are there once in a text or a thousand times count each time; equal rows count each. Ties of the count
go to the smaller word. Only `doc_id` and `text` are read, so other columns cannot clash. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import cut

RUN = re.compile("[A-Za-z\u00C0-\u00FF]+")
MIN_LENGTH, MIN_COUNT = 5, 3
GRAM = 2
ROWS = 2000
MEMORY = 200_000
TASK_WORDS = 10_000


def damaged(run: str, digest: int, every: int) -> str:
    """`run` without one code point where `every` divides `digest`."""
    at = digest % len(run)
    return run if digest % every else run[:at] + run[at + 1 :]


def _counted(every: int | None):
    """Counts of the words in batches of documents, given out whenever there are MEMORY different ones."""

    def rows(counts: Counter) -> pa.RecordBatch:
        kept = [w for w in counts if len(w) >= MIN_LENGTH]
        return pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), pa.array([counts[w] for w in kept], pa.int64())], ["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                # bytes.lower() changes A-Z alone
                found = RUN.findall((text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))
                if every:
                    seed = crc32(f"{'' if doc_id is None else doc_id}:".encode())
                    for word, n in Counter(found).items():
                        counts[damaged(word, crc32(word.encode(), seed), every)] += n
                else:
                    counts.update(found)
                if len(counts) > MEMORY:
                    yield rows(counts)
                    counts.clear()
        yield rows(counts)

    return run


def count_words(documents: DataFrame, damage: int | None = None) -> DataFrame:
    """`word` and its count `n`, of the words that are long and frequent enough.

    With `damage`, a run loses a code point where that number divides the crc32 of `<doc_id>:<run>`.
    """
    parts = documents.select("doc_id", "text").mapInArrow(_counted(damage), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_COUNT)


def gram_order(words: DataFrame) -> dict[str, int]:
    """Rank of every bigram, rare ones first. Runs have 90 letters, so there are at most 8,100."""
    places = F.sequence(F.lit(1), F.char_length("word") - 1)
    grams = F.array_distinct(F.transform(places, lambda i: F.substr(F.col("word"), i, F.lit(GRAM))))
    counts = words.select(F.explode(grams).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("holders"))
    return {r.gram: rank for rank, r in enumerate(sorted(counts.collect(), key=lambda r: (r.holders, r.gram)))}


def prefix(word: str, order: dict[str, int]) -> list[tuple[int, int]]:
    """(rank, place) of the three rarest bigrams and all others equal to the third, by place; the greatest rank is the third's."""
    grams = [(order[word[i : i + GRAM]], i) for i in range(len(word) - GRAM + 1)]
    third = sorted(grams)[GRAM][0]
    return [g for g in grams if g[0] <= third]


def pivots(grams: list[tuple[int, int]], count: int = 2) -> list[int]:
    """Places of the `count` disjoint bigrams of least total rank, by dynamic programming over places."""
    best: list[list[tuple[int, list[int]] | None]] = [[(0, [])] + [None] * count]
    for i, (rank, place) in enumerate(grams):
        free = next((j for j in range(i, 0, -1) if grams[j - 1][1] + GRAM <= place), 0)
        row = list(best[i])
        for taken in range(1, count + 1):
            if (before := best[free][taken - 1]) is not None:
                total = before[0] + rank
                if row[taken] is None or total < row[taken][0]:
                    row[taken] = (total, [*before[1], place])
        best.append(row)
    return best[-1][count][1]


def _key(kind: str, place: int, length: int, kept: str) -> int:
    """Key of a pivot at `place` in a word of `length`, with the letters that no edit has touched."""
    return xxhash.xxh3_64_intdigest(f"{kind}{place}|{length}|{kept}".encode()) - (1 << 63)


def pivot_keys(word: str, places: list[int]) -> list[int]:
    """Keys under which a word looks for others: the edit is behind its first pivot or before its second, in either half."""
    size, (first, second) = len(word), places
    behind, half = first + GRAM, first + GRAM + (size - first - GRAM + 1) // 2
    return [
        _key("a", first, size, word[:half]),
        _key("b", first, size, f"{word[:behind]} {word[half:]}"),
        _key("c", second, size, word[second // 2 :]),
        _key("d", second, size, f"{word[: second // 2]} {word[second:]}"),
    ]


def prefix_keys(word: str, places: list[int]) -> list[int]:
    """Keys under which a word is found by others that are as long, one longer or one shorter."""
    size, keys = len(word), []
    for place in places:
        behind = place + GRAM
        for other in (size - 1, size, size + 1):
            half = behind + (other - behind + 1) // 2
            tail = size - (other - half)
            if other - behind >= GRAM and tail >= behind:
                keys.append(_key("a", place, other, word[:half]))
                keys.append(_key("b", place, other, f"{word[:behind]} {word[tail:]}"))
            second = place + other - size
            start = second // 2 + size - other
            if second >= GRAM and start >= 0:
                keys.append(_key("c", second, other, word[start:]))
                if second // 2 <= place:
                    keys.append(_key("d", second, other, f"{word[: second // 2]} {word[place:]}"))
    return keys


def keyed(words: DataFrame, order: dict[str, int]) -> DataFrame:
    """`word`, `n`, the rank of its third bigram (`last`), its `pivots` and its `index` keys."""
    shared = words.sparkSession.sparkContext.broadcast(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                some = batch.slice(at, ROWS)
                texts = some.column("word").to_pylist()
                prefixes = [prefix(w, shared.value) for w in texts]
                last = [max(rank for rank, _ in p) for p in prefixes]
                asked = [pivot_keys(w, pivots(p)) for w, p in zip(texts, prefixes, strict=True)]
                held = [prefix_keys(w, [place for _, place in p]) for w, p in zip(texts, prefixes, strict=True)]
                lists = [pa.array(x, pa.list_(pa.int64())) for x in (asked, held)]
                yield pa.RecordBatch.from_arrays(
                    [some.column("word"), some.column("n"), pa.array(last, pa.int32()), *lists],
                    ["word", "n", "last", "pivots", "index"],
                )

    return words.mapInArrow(run, "word string, n long, last int, pivots array<long>, index array<long>")


def near_words(words: DataFrame) -> DataFrame:
    """Pairs of `words` one edit apart, once each: a < b with their counts na and nb."""
    spread = words.repartition(max(1, -(-words.count() // TASK_WORDS)))
    rows = cut(keyed(spread, gram_order(words)))
    asked = rows.select(F.col("word").alias("a"), F.col("n").alias("na"), F.col("last").alias("la"), F.explode("pivots").alias("key"))
    held = rows.select(F.col("word").alias("b"), F.col("n").alias("nb"), F.col("last").alias("lb"), F.explode("index").alias("key"))
    met = asked.join(held, "key").where("la <= lb").where(F.levenshtein("a", "b", 1) == 1)
    one, other = F.struct(F.col("a").alias("w"), F.col("na").alias("n")), F.struct(F.col("b").alias("w"), F.col("nb").alias("n"))
    pairs = met.select(F.least(one, other).alias("x"), F.greatest(one, other).alias("y"))
    return pairs.select(
        F.col("x.w").alias("a"), F.col("y.w").alias("b"), F.col("x.n").alias("na"), F.col("y.n").alias("nb")
    ).distinct()


def forms(words: DataFrame, near: DataFrame) -> DataFrame:
    """`word`, `n`, `n_near`, and `form` and `form_n`: the commonest near word, if it is at least twice as common."""
    def seen(word: str, other: str, count: str) -> Column:
        best = F.struct((-F.col(count)).alias("less"), F.col(other).alias("form"))
        return F.struct(F.col(word).alias("word"), best.alias("best"))

    both = near.select(F.inline(F.array(seen("a", "b", "nb"), seen("b", "a", "na"))))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("best").alias("best"))
    able = -F.col("best.less") >= 2 * F.col("n")
    return words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(able, F.col("best.form")).alias("form"),
        F.when(able, -F.col("best.less")).alias("form_n"),
    )


def roots(named: DataFrame) -> DataFrame:
    """`word` and `root` of the words that have a form: where following forms ends.

    Each step at least doubles the count, so chains are short; every round halves what is left of them.
    """
    left = cut(named.where("form IS NOT NULL").select("word", F.col("form").alias("root"), F.lit(False).alias("done")))
    while left.where("NOT done").limit(1).count():
        ahead = left.select(F.col("word").alias("at"), F.col("root").alias("next"), F.col("done").alias("end"))
        moved = left.join(ahead, left["root"] == ahead["at"], "left")
        stop = F.col("at").isNull() | F.col("end")
        left = cut(moved.select("word", F.coalesce("next", "root").alias("root"), stop.alias("done")))
    return left.select("word", "root")


def spelling_variants(documents: DataFrame, damage: int | None = None) -> DataFrame:
    """`word`, `form`, `root`, `n`, `n_near` and `form_n` of every word of `documents`."""
    words = cut(count_words(documents, damage))
    named = cut(forms(words, near_words(words)))
    return named.join(roots(named), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
