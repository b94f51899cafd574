"""Toxicity of texts read through a noisy channel.

Tokens with a sign next to a letter, a letter twice or a separator between letters, and runs of single signs whatever
white space is between them, become a lattice: every sign may stand for the letters it is used for, runs of a letter for
one or two of them, separators for nothing, signs at the ends for punctuation as well. A
Viterbi pass over the lattice picks the likeliest reading under a character trigram model learned from all texts. The
restored words, their first four to six letters included, are scored by how much of the labelled text that has them is
toxic; evidence is combined as a noisy or.

The classifier is fitted on at most SAMPLE labelled rows, the lowest by a hash of their id; the character model counts
all texts. A feature tells if the toxic texts that have it are too many for chance among exp(LOG_FEATURES) features. Null and empty texts score the rate of toxic texts without any evidence. Rows with equal ids are
scored each, null labels are not learned from, and without labels nothing is toxic. An empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartloom.llm.common import cut, row_key
from chartloom.llm.minhash import linked_rows

SAMPLE = 50_000
LOG_FEATURES = 16.0
#: Tokens that a worker remembers.
TOKENS = 300_000
# Letters that signs commonly stand for.
SIGNS = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e",
}
SIZE = 28
WORD = re.compile(r"[^\W\d_]+")
SIGN = "01345789@$!|+(€"
LETTER = r"[^\W\d_]"
#: Three or more single letters or signs apart, whatever is between them.
SPACED = re.compile(rf"(?<![^\W_])(?<![@$!|+(€])(?:(?:[^\W_]|[@$!|+(€])[\s.\-_*]+){{2,}}(?:[^\W_]|[@$!|+(€])(?![^\W_])")
#: A sign next to a letter, a letter twice, or a separator between letters.
DISGUISED = re.compile(rf"{LETTER}[{SIGN}]|[{SIGN}]{LETTER}|({LETTER})\1|{LETTER}[.\-_*]+(?:{LETTER}|[{SIGN}])")
#: Punctuation at the ends of a token; some of it may as well stand for a letter.
OPENING, CLOSING, SOUNDLESS = ".,;:?*#%&\"'(!$|+", ".,;:!?*#%&$|+(\"')", ".,;:?*#%&\"')"


def letter(c: str) -> int:
    """1 to 26 for a to z, 27 for any other letter, 0 for the border of a word."""
    return ord(c) - 96 if "a" <= c <= "z" else 27


def trigram_counts(words: list[str]) -> np.ndarray:
    points = np.frombuffer(("  " + "  ".join(words) + "  ").encode("utf-32-le", "replace"), "<u4").astype(np.int64)
    code = np.where((points >= 97) & (points <= 122), points - 96, np.where(points == 32, 0, 27))
    triples = (code[:-2] * SIZE + code[1:-1]) * SIZE + code[2:]
    return np.bincount(triples, minlength=SIZE**3)


class Restorer:
    """Likeliest plain reading of a disguised word under a character trigram model."""

    def __init__(self, counts: np.ndarray):
        cube = counts.reshape(SIZE, SIZE, SIZE) + 0.1
        self.model = np.log(cube / cube.sum(2, keepdims=True)).tolist()
        self.known: dict[str, str] = {}
        self.read: dict[str, tuple[str, ...]] = {}

    @staticmethod
    def lattice(word: str) -> list[list[tuple[str, float]]]:
        """What each run of equal signs may stand for, with the cost of that reading."""
        steps = []
        for run in re.finditer(r"(.)\1*", word):
            sign, n = run[1], len(run[0])
            if sign.isalpha():
                few = [(sign * k, 0.0 if n <= 2 and k == n else -0.7) for k in (1, 2) if k <= n]
                steps.append(few)
            elif sign in SIGNS:
                steps.append([(c * k, -1.0) for c in SIGNS[sign] for k in range(1, min(n, 2) + 1)])
            else:
                steps.append([("", 0.0)])
        return steps

    def decode(self, word: str) -> str:
        if word not in self.known:
            if len(self.known) > 100_000:
                self.known.clear()
            best: dict[tuple[int, int], tuple[float, str]] = {(0, 0): (0.0, "")}
            for step in self.lattice(word):
                after: dict[tuple[int, int], tuple[float, str]] = {}
                if step[0][1] == 0.0 and len(step) == len(step[0][0]) == 1:
                    c, z = step[0][0], letter(step[0][0])
                    for (a, b), (value, text) in best.items():
                        total = value + self.model[a][b][z]
                        if (b, z) not in after or after[b, z][0] < total:
                            after[b, z] = (total, text + c)
                    best = after
                    continue
                for (a, b), (value, text) in best.items():
                    for reading, cost in step:
                        x, y, total = a, b, value + cost
                        for c in reading:
                            z = letter(c)
                            total += self.model[x][y][z]
                            x, y = y, z
                        if (x, y) not in after or after[x, y][0] < total:
                            after[x, y] = (total, text + reading)
                best = after
            ends = [(v + self.model[a][b][0], text) for (a, b), (v, text) in best.items()]
            self.known[word] = max(ends)[1]
        return self.known[word]

    @staticmethod
    def forms(token: str) -> set[str]:
        """A token with the signs at its ends as letters, and without them as punctuation."""
        return {token.strip(SOUNDLESS), token.lstrip(OPENING).rstrip(CLOSING)} - {""}

    def readings(self, token: str) -> tuple[str, ...]:
        """Words that a token restores to if it looks disguised."""
        if token not in self.read:
            if len(self.read) > 100_000:
                self.read.clear()
            # Forms are parts of their token, so one that does not look disguised has none that does.
            forms = self.forms(token) if DISGUISED.search(token) else ()
            self.read[token] = tuple({w for f in forms if DISGUISED.search(f) for w in WORD.findall(self.decode(f))})
        return self.read[token]

    def spaced(self, lowered: str) -> Iterator[str]:
        """Words that runs of single signs in a text restore to."""
        for spaced in SPACED.finditer(lowered):
            run = re.sub(r"[\s.\-_*]", "", spaced[0])
            if WORD.search(run):
                yield from (w for f in self.forms(run) for w in WORD.findall(self.decode(f)))

    def words(self, text: str | None) -> set[str]:
        """Words of a text in lower case, disguised ones restored as well."""
        lowered = (text or "").lower()
        found = set(WORD.findall(lowered))
        for token in set(lowered.split()):
            found.update(self.readings(token))
        found.update(self.spaced(lowered))
        return found


def features(words: set[str]) -> set[str]:
    """Words, and their beginnings of four to six letters marked by an asterisk."""
    return {w for w in words if len(w) > 2} | {w[:k] + "*" for w in words for k in (4, 5, 6) if len(w) >= k}


NONE: frozenset[str] = frozenset()


class Evidence:
    """Telling features of texts, looked up once for each different token: words never cross white space."""

    def __init__(self, restorer: Restorer, telling: dict[str, float]):
        self.restorer, self.telling = restorer, telling
        self.starts = {feature[:3] for feature in telling}
        self.known: dict[str, frozenset[str]] = {}

    def of_words(self, words: Iterable[str]) -> frozenset[str]:
        # Features of a word begin with its first three letters.
        some = {w for w in words if w[:3] in self.starts}
        return frozenset(self.telling.keys() & features(some)) if some else NONE

    def __call__(self, text: str | None) -> list[str]:
        """Features of `text` that are telling, in order."""
        lowered, known = (text or "").lower(), self.known
        if len(known) > TOKENS:
            known.clear()
        tokens = set(lowered.split())
        for token in tokens.difference(known):
            known[token] = self.of_words([*WORD.findall(token), *self.restorer.readings(token)])
        return sorted(self.of_words(self.restorer.spaced(lowered)).union(*map(known.__getitem__, tokens)))


def character_model(documents: DataFrame) -> np.ndarray:
    """Trigram counts over the words of all texts; SIZE**3 of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE**3, np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                total += trigram_counts(WORD.findall((text or "").lower()))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["gram", "n"])

    rows = documents.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    counts = np.zeros(SIZE**3, np.int64)
    for row in rows.collect():
        counts[row["gram"]] = row["n"]
    return counts


def labelled_sample(labels: DataFrame, learned: Column, size: int) -> DataFrame:
    """At most `size` labelled ids, the lowest by hash."""
    own = labels.where(learned & F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
    picked = own.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)
    rows = [(r["doc_id"], r["toxic"]) for r in picked.collect()]
    return labels.sparkSession.createDataFrame(rows, "doc_id long, toxic int")


def one_of_copies(documents: DataFrame, sample: DataFrame) -> DataFrame:
    """`text` and `toxic` of the sample, with one row for near copies (pairs of words, 0.8) of one label.

    Copies of one text are no independent evidence for its words. Texts without words are none.
    """
    texts = documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    texts = cut(texts.select("doc_id", row_key().alias("uid"), "toxic", "text"))
    found = linked_rows(texts, words=2, percent=80).where("n_shingles > 0").join(texts.select("uid", "toxic").distinct(), "uid")
    kept = found.groupBy("root", "toxic").agg(F.min(F.struct("doc_id", "uid"))["uid"].alias("uid")).select("uid")
    return cut(texts.join(kept, "uid", "left_semi").dropDuplicates(["uid"]).select("text", "toxic"))


def fit_evidence(texts: DataFrame, restorer: Restorer, least: int = 5) -> tuple[dict[str, float], float]:
    """Share of toxic texts among those with a feature, for telling features, and the rate of toxic ones without any."""
    model = texts.sparkSession.sparkContext.broadcast(restorer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                counts[toxic].update(features(model.value.words(text)) | {""})
        names = list(counts[0].keys() | counts[1].keys())
        columns = [pa.array(names, pa.string()), *[pa.array([c[n] for n in names], pa.int64()) for c in counts]]
        yield pa.RecordBatch.from_arrays(columns, ["feature", "clean", "toxic"])

    counted = texts.mapInArrow(run, "feature string, clean long, toxic long").groupBy("feature")
    counted = counted.agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    telling = counted.where((F.col("feature") == "") | (F.col("toxic") >= F.greatest(F.lit(least), 9 * F.col("clean"))))
    counts = {r["feature"]: (r["toxic"], r["clean"]) for r in telling.collect()}
    toxic, clean = counts.pop("", (0, 0))
    rarity = -math.log(max(toxic, 1) / max(toxic + clean, 1))
    evidence = {
        f: t / (t + c + 1) for f, (t, c) in counts.items() if t * rarity - math.log(math.comb(t + c, c)) >= LOG_FEATURES
    }
    return evidence, 0.02 if toxic else 0.0


def score_toxicity(documents: DataFrame, labels: DataFrame, held_out: Column, size: int = SAMPLE) -> DataFrame:
    """`doc_id`, `held_out`, `score`, `predicted` and the strongest `evidence` of every document."""
    restorer = Restorer(character_model(documents))
    texts = one_of_copies(documents, labelled_sample(labels, ~held_out, size))
    evidence, rest = fit_evidence(texts, restorer)
    model = documents.sparkSession.sparkContext.broadcast((Evidence(restorer, evidence), rest))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        telling, base = model.value
        for batch in batches:
            scores, why = [], []
            for text in batch.column("text").to_pylist():
                hits = telling(text)
                open_ = (1 - base) * math.prod(1 - telling.telling[h] for h in hits)
                scores.append(1 - open_)
                why.append(max(hits, key=lambda h: (telling.telling[h], h), default=None))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(scores, pa.float64()),
                 pa.array([int(s >= 0.7) for s in scores], pa.int32()), pa.array(why, pa.string())],
                ["doc_id", "held_out", "score", "predicted", "evidence"],
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, evidence string")
