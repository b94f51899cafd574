"""Spelling variants, hard negatives and byte-pair trees against brute force, the SQL and a public library."""

import base64
import random
import zlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from chartloom.llm import bytepairs, negatives, spelling
from chartloom.llm.queries import BYTE_RANKS

PATTERN = public_tokenizers.PATTERN
rng = random.Random(8)


# --- spelling variants


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    left, right = a[i:], b[i:]
    return left[1:] == right[1:] or left == right[1:] or left[1:] == right


def variants(rows, every=97):
    counts = Counter()
    for doc_id, text in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in spelling.RUN.findall(lowered):
            digest = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            at = digest % len(run)
            counts[run if digest % every else run[:at] + run[at + 1 :]] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 5 and c >= 3}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {w: min(near[w], key=lambda x: (-n[x], x), default=None) for w in n}
    form = {w: f if f is not None and n[f] >= 2 * n[w] else None for w, f in form.items()}

    def root(word):
        return word if form[word] is None else root(form[word])

    return sorted((w, form[w] or "", root(w), n[w], len(near[w]), n[form[w]] if form[w] else 0) for w in n)


def test_variants_match_brute_force(spark):
    base = ["".join(rng.choices("abcÀéÿ÷xyzß", k=rng.randint(4, 9))) for _ in range(40)]
    words = []
    for word in base:
        for times in (40, 12, 3, 3):
            at = rng.randrange(len(word))
            words += [rng.choice([word, word[:at] + word[at + 1 :], word[:at] + "q" + word[at:], word[:at] + "Z" + word[at + 1 :]])] * times
    rng.shuffle(words)
    rows = [(i if i % 5 else None, " ".join(words[i::30])) for i in range(30)]
    rows += [rows[3], rows[3], (3, None), (4, ""), (5, "x" * 100_000), (6, " 12 \n"), (7, ("lotsa " * 30_000))]
    docs = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id long, text string, word string, n int").repartition(3)
    found = spelling.spelling_variants(docs, damage=97).collect()
    assert sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in found) == variants(rows)
    assert any(r.form and r.form != r.root for r in found)
    assert spelling.spelling_variants(docs.limit(0)).count() == 0


@pytest.mark.parametrize("letters", ["ab", "abcde", "aé÷xyzpq"])
def test_pivots_and_prefixes_meet_for_every_pair_one_edit_apart(letters):
    words = sorted({"".join(rng.choices(letters, k=rng.randint(5, 9))) for _ in range(400)})
    holders = Counter(g for w in words for g in {w[i : i + 2] for i in range(len(w) - 1)})
    order = {g: i for i, g in enumerate(sorted(holders, key=lambda g: (holders[g], g)))}
    held, pairs = {}, set()
    grams = {w: spelling.prefix(w, order) for w in words}
    last = {w: max(rank for rank, _ in grams[w]) for w in words}
    for w in words:
        for key in spelling.prefix_keys(w, [place for _, place in grams[w]]):
            held.setdefault(key, []).append(w)
    for w in words:
        first, second = spelling.pivots(grams[w])
        ranks = {place: rank for rank, place in grams[w]}
        assert second >= first + 2
        assert ranks[first] + ranks[second] == min(ranks[a] + ranks[b] for a in ranks for b in ranks if b >= a + 2)
        for key in spelling.pivot_keys(w, [first, second]):
            pairs |= {frozenset((w, x)) for x in held.get(key, []) if last[w] <= last[x] and one_edit(w, x)}
    assert pairs == {frozenset((a, b)) for a in words for b in words if one_edit(a, b)}


# --- hard negatives


def mined(rows, k=5):
    kept = []
    for vec_id, vector, label in rows:
        if label is None or vector is None or any(x is None or x != x or abs(x) == float("inf") for x in vector):
            continue
        label = (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label
        kept.append((vec_id, label, tuple(int(256 * x // 1) for x in vector)))
    out = []
    for anchor in {r for r in kept if r[0] is not None and r[0] % 100 == 0}:
        others = list(kept)
        others.remove(anchor)
        scored = [
            (-sum(a * b for a, b in zip(anchor[2], r[2], strict=True)), r[0] is None, r[0] or 0, r)
            for r in others
            if len(r[2]) == len(anchor[2])
        ]
        scored.sort(key=lambda s: s[:3])
        for place, (less, _, _, positive) in enumerate([s for s in scored if s[3][1] == anchor[1]][:k], 1):
            hard = [s for s in scored if s[3][1] != anchor[1] and 80 * -less <= 100 * -s[0] <= 100 * -less][:k]
            out += [(anchor[0], place, positive[0], i, s[3][0], -less, -s[0]) for i, s in enumerate(hard, 1)]
    return sorted(out, key=repr)


def run_negatives(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, block int, key string"
    vectors = spark.createDataFrame([(*r, 1, "k") for r in rows], schema).repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = negatives.hard_negatives(vectors, F.col("vec_id") % 100 == 0, label).collect()
    columns = ("anchor_id", "positive_rank", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return sorted((tuple(r[c] for c in columns) for r in found), key=repr)


def exact_floats(count):
    return [rng.randint(-512, 512) / 256 for _ in range(count)]


@pytest.mark.parametrize("block_values", [1 << 21, 600])
def test_negatives_match_brute_force(spark, monkeypatch, block_values):
    monkeypatch.setattr(negatives, "BLOCK_VALUES", block_values)
    monkeypatch.setattr(negatives, "FEW", 4)
    centre = exact_floats(20)
    rows = [(i, [c + x / 8 for c, x in zip(centre, exact_floats(20), strict=True)], i % 3) for i in range(301)]
    rows += [(i, centre, 4) for i in range(400, 430)] + [(7000, centre, 4)] * 3 + [(None, centre, 5)]
    rows += [(500, None, 1), (600, exact_floats(20), None), (700, [float("nan")] * 20, 1), (800, [None] * 20, 1)]
    rows += [(900, [float("inf")] * 20, 1), (1000, [], 1), (1001, [], 1), (1002, [], 2), (1100, exact_floats(7), 1), (1101, exact_floats(7), 2)]
    rows += [(1200, [0.0] * 20, 1), (1300, [-x for x in centre], 2), (100, exact_floats(20), 2)]
    want = mined(rows)
    assert run_negatives(spark, rows) == want and len({w[0] for w in want}) > 3


def test_negatives_with_large_numbers_are_exact(spark):
    rows = [(i, [float(rng.randint(-4000, 4000)) * 1000 for _ in range(6)], i % 2) for i in range(0, 400, 2)]
    assert run_negatives(spark, rows) == mined(rows)
    assert run_negatives(spark, rows[:0]) == [] == run_negatives(spark, rows[:1])


# --- byte pairs


@pytest.fixture(scope="module")
def coder():
    return bytepairs.TreeCoder(BYTE_RANKS, PATTERN)


@pytest.fixture(scope="module")
def library(coder):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=coder.ranks, special_tokens={})


TEXTS = ["", " ", "x" * 5000, "ab" * 3000, "the" * 2000 + "\n" * 700, "a" * 12_345 + "b", "  " * 999 + "x", "é" * 1000]
TEXTS += ["it's we'll 'r 're 'x", "tab\t\r\n  end  ", "日本語テキスト 👍🏽 Σß", "\x1c\x85  a", "<|endoftext|> 12½"]


@pytest.mark.parametrize("leaf", [2, 5, 1024])
def test_trees_encode_as_the_library(coder, library, monkeypatch, leaf):
    monkeypatch.setattr(bytepairs, "LEAF_CHARS", leaf)
    monkeypatch.setattr(bytepairs, "LEAF_BYTES", min(leaf, 8))
    coder.known.clear()
    alphabet = "aàé'stvrelmd  \t\n\r    12½.,!日本Σß👍\x85xxX"
    texts = TEXTS + ["".join(rng.choices(alphabet, k=rng.randint(0, 90))) for _ in range(600)]
    for text in texts:
        assert coder.encode(text).tolist() == library.encode_ordinary(text), repr(text[:50])


def test_joins_are_exact_for_any_ranks():
    """Ranks drawn at random, so a long token may come before its parts; plain merging is the brute force."""
    for seed in range(20):
        draw = random.Random(seed)
        tokens = [bytes([b]) for b in b"abc"] + list({bytes(draw.choices(b"abc", k=draw.randint(2, 5))) for _ in range(25)})
        ranks = dict(zip(tokens, draw.sample(range(len(tokens)), len(tokens)), strict=True))
        tree = bytepairs.TreeCoder.__new__(bytepairs.TreeCoder)
        tree.ranks, tree.tokens, tree.highest = ranks, {r: t for t, r in ranks.items()}, len(ranks)
        tree.fits, tree.short = {}, {}
        for _ in range(100):
            data = bytes(draw.choices(b"abc", k=draw.randint(0, 60)))
            parts = [data[i : i + 1] for i in range(len(data))]
            while True:
                able = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
                if not able:
                    break
                i = min(able)[1]
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            assert tree.encode_bytes(data) == [ranks[p] for p in parts]


def test_halves_that_fit_are_tested_once(coder, monkeypatch):
    calls, fit = [], bytepairs.TreeCoder.fit
    monkeypatch.setattr(bytepairs.TreeCoder, "fit", lambda self, a, b: calls.append((a, b)) or fit(self, a, b))
    left, right = coder.merged(b"12"), coder.merged(b" x")
    assert coder.join(left, right) == coder.merged(b"12 x") == left + right
    assert calls == [(left[-1], right[0])]
    ids = coder.encode("it's a 日本 end")
    assert coder.decode(ids) == "it's a 日本 end".encode() and coder.decode(ids[:0]) == b""


def test_ids_round_trip_over_rows(spark, coder, library):
    rows = [(i, t, "i", 1) for i, t in enumerate([None, *TEXTS])] + [(1, "twice", "i", 1)] * 2 + [(None, "no id", "i", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, decoded int").repartition(2)
    found = bytepairs.decode_ids(bytepairs.encode_texts(docs, BYTE_RANKS, PATTERN), BYTE_RANKS, PATTERN).collect()
    want = sorted((repr(i), library.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in rows)
    assert sorted((repr(r.doc_id), list(r.ids), bytes(r.decoded)) for r in found) == want
    assert bytepairs.encode_texts(docs.limit(0), BYTE_RANKS, PATTERN).count() == 0
    with open(BYTE_RANKS, "rb") as file:
        assert len(coder.ranks) == sum(1 for line in file if base64.b64decode(line.split()[0]))
