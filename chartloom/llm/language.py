"""Language identification with error-correcting output codes.

Every language has a codeword. For each bit a binary n-gram classifier, the log ratio of hashed byte 3-grams and 4-grams
between the languages with and without that bit, gives a margin. Decoding takes the codeword with the least logistic
loss over the margins, each bit weighted by how well it separates the languages. A text is ambiguous if the runner-up is
close.

N-gram counts are summed over all training rows; the model has 2 * BUCKETS rows per bit whatever the corpus size.
A text that is null or without letters is `und` with score 0. Rows without training language are only predicted. With
no training rows at all, every text is `und`; with one language, every text with letters is of it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 15
SLICE = 1 << 20
UNKNOWN = "und"
#: ASCII other than letters becomes a space.
_letters = bytes(c if chr(c).isalpha() or c >= 128 else 32 for c in range(256))


def has_letters(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def gram_ids(text: str) -> Iterator[np.ndarray]:
    """Buckets of the byte 3-grams and 4-grams of the letters, a slice of the text at a time."""
    raw = np.frombuffer(b" " + text.lower().encode("utf-8", "replace").translate(_letters) + b" ", np.uint8)
    blank = raw == 32
    raw = raw[~(blank & np.concatenate(([False], blank[:-1])))].astype(np.uint32)
    for at in range(0, max(1, len(raw) - 3), SLICE):
        x = raw[at : at + SLICE + 3]
        if len(x) >= 3:
            three = (x[:-2] | x[1:-1] << 8 | x[2:] << 16) * np.uint32(0x9E3779B1)
            yield (three >> np.uint32(17)).astype(np.int64)
            four = ((x[:-3] | x[1:-2] << 8 | x[2:-1] << 16 | x[3:] << 24) ^ np.uint32(0x5BD1E995)) * np.uint32(0x85EBCA6B)
            yield (four >> np.uint32(17)).astype(np.int64) + BUCKETS


def codewords(classes: int) -> np.ndarray:
    """Codewords of -1 and 1: all two-sided splits of up to five classes, else the best of some random codes."""
    if classes < 2:
        return np.zeros((classes, 0), np.int64)
    if classes <= 5:
        bits = [[1 if (j >> i) & 1 else -1 for i in range(classes)] for j in range(1, 1 << max(0, classes - 1))]
        return np.array(bits).T.reshape(classes, -1)
    random, width = np.random.default_rng(7), math.ceil(10 * math.log2(classes))
    best, apart = None, -1
    for _ in range(50):
        code = random.choice((-1, 1), (classes, width))
        code = code[:, np.abs(code.sum(0)) < classes]
        distance = (code.shape[1] - code @ code.T) // 2
        least = distance[~np.eye(classes, dtype=bool)].min()
        if least > apart:
            best, apart = code, least
    return best


@dataclass
class Decoder:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    reliability: np.ndarray

    @classmethod
    def fit(cls, languages: list[str], counts: np.ndarray) -> Decoder:
        """From n-gram counts, one column per language."""
        code = codewords(len(languages))
        if not code.shape[1]:
            return cls(languages, code, np.zeros((2 * BUCKETS, 0), np.float32), np.zeros(0))
        shares = (counts + 0.5) / (counts + 0.5).sum(0)
        logs = [np.log(shares[:, code[:, j] == 1].mean(1) / shares[:, code[:, j] == -1].mean(1)) for j in range(code.shape[1])]
        weights = np.stack(logs, 1)
        means = code * (shares.T @ weights)
        weights /= np.maximum(np.abs(means).mean(0), 1e-9)
        reliability = np.clip(means.min(0) / np.maximum(np.abs(means).mean(0), 1e-9), 0.05, None)
        return cls(languages, code, weights.astype(np.float32), reliability / reliability.sum())

    def decode(self, text: str | None, sharpness: float) -> tuple[str, float, bool]:
        """Language, share of it among all, and whether the runner-up is close."""
        if not self.languages or not has_letters(text):
            return UNKNOWN, 0.0, False
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        total, seen = np.zeros(self.weights.shape[1]), 0
        for ids in gram_ids(text):
            total += self.weights[ids].sum(0, dtype=np.float64)
            seen += len(ids)
        margins = total / max(1, seen)
        loss = np.logaddexp(0, -self.code * margins * sharpness) @ self.reliability
        share = np.exp((loss.min() - loss) * sharpness)
        share /= share.sum()
        best = int(np.argmin(loss))
        return self.languages[best], float(share[best]), bool(share[best] < 0.5)


def gram_counts(labelled: DataFrame) -> DataFrame:
    """`lang`, `gram` and `n` over all rows of (`text`, `lang`)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
                found = sums.setdefault(lang, np.zeros(2 * BUCKETS, np.int64))
                for ids in gram_ids(text):
                    found += np.bincount(ids, minlength=2 * BUCKETS)
        for lang, found in sums.items():
            grams = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.int64()), pa.array(found[grams])],
                ["lang", "gram", "n"],
            )

    rows = labelled.where("text IS NOT NULL AND lang IS NOT NULL").select("text", F.col("lang").cast("string"))
    counted = rows.mapInArrow(count, "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def fit_decoder(labelled: DataFrame) -> Decoder:
    """The decoder learned from all rows of (`text`, `lang`); its counts, 2 * BUCKETS a language, come to the driver."""
    counts = gram_counts(labelled).toPandas()
    languages = sorted(counts["lang"].unique())
    matrix = np.zeros((2 * BUCKETS, len(languages)))
    for j, lang in enumerate(languages):
        own = counts[counts["lang"] == lang]
        matrix[own["gram"].to_numpy(), j] = own["n"].to_numpy()
    return Decoder.fit(languages, matrix)


def identify(documents: DataFrame, decoder: Decoder, sharpness: float = 4.0, keep: tuple[str, ...] = ()) -> DataFrame:
    """`doc_id`, `lang_pred`, `score`, `ambiguous` of every document, and the columns named in `keep`."""
    model = documents.sparkSession.sparkContext.broadcast(decoder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.value.decode(t, sharpness) for t in batch.column("__text").to_pylist()]
            named, score, unsure = list(zip(*found, strict=True)) or [(), (), ()]
            columns = [batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(named, pa.string()), pa.array(score, pa.float64()), pa.array(unsure, pa.bool_())],
                [*keep, "lang_pred", "score", "ambiguous"],
            )

    kept = documents.select(*keep, F.col("text").alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.select(*keep).schema)
    return kept.mapInArrow(run, f"{schema}, lang_pred string, score double, ambiguous boolean")


def identify_held_out(documents: DataFrame, held_out: Column) -> DataFrame:
    """Predictions for all documents by a decoder that has learned from those not held out."""
    decoder = fit_decoder(documents.where(~held_out).select("text", "lang"))
    return identify(documents.select("doc_id", held_out.alias("held_out"), "text"), decoder, keep=("doc_id", "held_out"))
