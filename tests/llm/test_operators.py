"""Operators against brute force on small tables with nulls, empty and long texts, ties, copies and clashing columns."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from chartloom.llm import fingerprints, graph, language, minhash, mixing, packing, preferences, scoring, suffixes, toxicity
from chartloom.llm.common import fold
from chartloom.llm.queries import WORD_VOCABULARY

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, key string, bucket int"
rng = random.Random(5)
WORDS = ["".join(rng.choices("abcdefgho", k=rng.randint(2, 7))) for _ in range(300)]


def prose(n):
    return " ".join(rng.choices(WORDS, k=n))


def _rows():
    base, passage = prose(120), prose(60)
    texts = [None, "", " \t\n", "a", "it. was", base, base, base.replace(WORDS[0], "changed"), base + " tail", "x" * 900]
    texts += [prose(50) + " " + passage + " " + prose(40), prose(70) + " " + passage, prose(20_000), "é" * 300, "ß Ünï çode"]
    texts += [prose(rng.randint(1, 300)) for _ in range(25)]
    made = [(i * 3, t, "en" if i % 2 else "fr", f"s{i % 4}" if i % 7 else None, None, "k", 1) for i, t in enumerate(texts)]
    return [*made, made[5], (made[6][0], "another text under one id", "en", "s1", 3, "k", 2)]


ROWS = _rows()


def rows():
    return ROWS


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return (text or "").encode().lower().split()


def test_scores(docs, none):
    held = fold("doc_id", 7) == 2
    found = scoring.score_texts(docs, held).collect()
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in {r[0] for r in rows()}}
    counts = Counter(w for r in rows() if not out[r[0]] for w in [*words(r[1]), b"\n"])
    n, v = sum(counts.values()), len(counts)
    want = sorted(
        (r[0], len(words(r[1])) + 1, sum(counts[w] > 0 for w in [*words(r[1]), b"\n"]),
         round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in [*words(r[1]), b"\n"]), 6))
        for r in rows()
    )
    assert sorted((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in found) == want
    assert all(r.score < 0 and r.train_tokens == n for r in found)
    assert scoring.score_texts(none, held).count() == 0


def test_tree_predictions_are_a_distribution():
    keys = np.unique(np.concatenate(list(scoring.gram_keys(b"abcab abcd abca"))))
    tree = scoring.fold_up(keys, np.ones(len(keys)), scoring.DEPTH, 0)
    total = scoring.estimate(np.array([3.0]), np.array([0.0]))
    assert tree[0].node.min() == 1 and math.isclose(math.exp(total[0]), 0.5 * 0.75 * 5 / 6)


def test_languages(docs, none):
    found = language.identify_held_out(docs, fold("doc_id", 4) == 2).collect()
    assert len(found) == docs.count()
    bad = {r[0] for r in rows() if not language.has_letters(r[1])}
    assert {r.doc_id for r in found if r.lang_pred == "und"} == bad
    assert all(0 <= r.score <= 1 for r in found)
    assert language.identify_held_out(none, F.lit(False)).count() == 0
    code = language.codewords(12)
    assert ((code.shape[1] - code @ code.T) // 2)[~np.eye(12, dtype=bool)].min() >= 5


def test_near_duplicates(docs, none):
    sets = []
    for doc_id, text, *_ in rows():
        w = words(text)
        sets.append((doc_id, frozenset(zip(w, w[1:], strict=False)) if len(w) > 1 else frozenset([tuple(w)] if w else [])))
    group = list(range(len(sets)))
    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                group = [group[i] if g == group[j] else g for g in group]
    least = {g: min(d for (d, _), h in zip(sets, group, strict=True) if h == g) for g in group}
    found = minhash.near_duplicates(docs, words=2).collect()
    want = [(d, len(s), least[g]) for (d, s), g in zip(sets, group, strict=True)]
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted(want)
    assert minhash.near_duplicates(none, words=2).count() == 0


def test_signature_estimates_resemblance():
    a = np.arange(1, 401, dtype=np.uint64)
    mixed = np.concatenate((a[:300], a[:300] + np.uint64(100)))
    signs = minhash.signatures(minhash.mix64(mixed), np.repeat([0, 1], 300), 2, 128)
    assert abs((signs[0] == signs[1]).mean() - 0.5) < 0.15


def test_repeats(docs, none):
    every = Counter()
    for r in rows():
        data = (r[1] or "").encode()
        every.update(data[i : i + 200] for i in range(len(data) - 199))
    want = []
    for r in rows():
        data = (r[1] or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 199):
            if every[data[i : i + 200]] > 1:
                gone[i : i + 200] = b"\1" * 200
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        want.append((r[0], len(data), len(data) - len(kept), hashlib.sha256(kept).hexdigest()))
    found = suffixes.without_repeats(docs).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in found) == sorted(want)
    assert suffixes.without_repeats(none).count() == 0
    cut = suffixes.cut_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()


def test_mix(docs, none):
    plan = mixing.mix_plan(docs, blocks=8, shards=4).collect()
    assert len(plan) == len(rows())
    taken = Counter()
    for r in plan:
        own = sum(d.words for d in r.draws)
        assert own <= 2 * r["size"]
        taken[r.source] += own
    assert all(abs(taken[r.source] - r.target) <= 1 for r in plan)
    assert mixing.mix_plan(none).count() == 0
    mixed = mixing.mixed_rows(docs, blocks=8, shards=4)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r.source] += len((r.text or "").split())
    assert words == Counter({s: n for s, n in taken.items() if n})


def test_mix_keeps_one_text_of_several_sources_apart(spark):
    rows = [(i, prose(10), s) for i in range(40) for s in ("a", "b", "c")]
    rows = [(i, rows[3 * i][1], s) for i, _, s in rows]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    targets = {r.source: r.target for r in mixing.mix_plan(frame).collect()}
    words = Counter()
    for r in mixing.mixed_rows(frame).collect():
        words[r.source] += len(r.text.split())
    assert len(targets) == 3 and all(abs(words[s] - t) <= 1 for s, t in targets.items())


def test_mix_moves_texts_once(spark, tmp_path):
    frame = spark.createDataFrame([(i, prose(30), f"s{i % 3}") for i in range(60)], "doc_id long, text string, source string")
    frame.write.parquet(f"{tmp_path}/docs")
    mixed = mixing.mixed_rows(spark.read.parquet(f"{tmp_path}/docs"))
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan
    assert not [x for x in plan.splitlines() if "Scan ExistingRDD" in x and "row#" in x]  # no texts in a checkpoint


def test_mix_of_many_blocks(spark, docs, monkeypatch):
    few = mixing.mixed_rows(docs, blocks=8, shards=4).collect()
    monkeypatch.setattr(mixing, "SMALL", 0)
    assert mixing.mixed_rows(docs, blocks=8, shards=4).collect() == few


def test_stages_carry_columns_of_any_name(spark):
    from chartloom.llm import stages

    names = ["score", "lang_pred", "ambiguous", "size", "draw", "row_key", "shard", "order", "row", "uid", "rows", "block"]
    texts = [(i, prose(60), "en", f"s{i % 3}", 0) for i in range(12)]
    frame = spark.createDataFrame(
        [(*t, *[f"{n}{t[0]}" for n in names]) for t in texts],
        "doc_id long, text string, lang string, source string, n_chars int, " + ", ".join(f"`{n}` string" for n in names),
    )
    for name, stage in stages.STAGES[:-1]:
        kept = stage(spark, frame, "")
        assert kept.columns == frame.columns, name
        found = kept.collect()
        assert found and all(r[n] == f"{n}{r.doc_id}" for r in found for n in names), name
    assert stages.pack(spark, frame, "").count() >= 12


def test_words_met_again_are_not_learned_again(monkeypatch):
    monkeypatch.setattr(packing, "MEMORY", 40)
    encoder, learned = packing.WordEncoder(WORD_VOCABULARY), []
    learn = encoder.learn
    monkeypatch.setattr(encoder, "learn", lambda words: learned.extend(words) or learn(words))
    for n in range(12):
        text = f"the common, word's É{n} " + " ".join(f"w{n}x{i}" for i in range(12))
        assert encoder([text, None]) == [encoder.plain(text), b""]
    assert all(learned.count(w) == 1 for w in (b"the", b"common,", b"word's"))
    assert len(encoder.words) + len(encoder.old_words) <= 80


def test_ascii_texts_are_not_learned_word_by_word():
    encoder = packing.WordEncoder(WORD_VOCABULARY)
    text = "word, word; (word) word's WORD-word 'll''d 12\x1c3\x0bword.\x00" + "".join(map(chr, range(128))).replace("|", "")
    every = ["".join(map(chr, range(a, 592))) + " é" for a in (0, 60, 124, 125)] + ["½ word\u00a0wörd\x85w²a, Ωmega ǆ don’t"]
    assert encoder([text]) == [encoder.plain(text)] and not encoder.words
    assert encoder(every) == [encoder.plain(t) for t in every] and {b"word", b",", b"'s"} <= encoder.parts.keys()


def test_packing(docs, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(WORD_VOCABULARY)
    pieces = packing.pack_documents(docs, WORD_VOCABULARY).collect()
    ids = sorted([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1] for r in rows())
    assert sum(map(len, ids)) == sum(p.length for p in pieces)
    assert Counter(x for d in ids for x in d) == Counter(x for p in pieces for x in np.frombuffer(p.ids, "<u4").tolist())
    sequences = {}
    for p in sorted(pieces, key=lambda p: p.offset):
        assert sequences.get(p.sequence_id, 0) == p.offset
        sequences[p.sequence_id] = p.offset + p.length
    assert all(n <= 2048 and n & (n - 1) == 0 for n in sequences.values())
    assert packing.pack_documents(none, WORD_VOCABULARY).count() == 0


def test_fingerprints(docs, none):
    found = fingerprints.edit_fingerprints(docs).collect()
    order = sorted(((r[0], r[1] or "") for r in rows()), key=lambda r: (-r[0], r[1]))
    want = []
    for (doc_id, text), (_, after) in zip(order, [*order[1:], order[0]], strict=True):
        swap = len(text) // 3
        want.append((doc_id, len(text), hashlib.sha256((text[: len(text) - swap] + after[:swap]).encode()).hexdigest()))
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == sorted(want)
    a, b = fingerprints.sketch(prose(400)), fingerprints.sketch(prose(30))
    assert fingerprints.likeness(a, fingerprints.merge(a, b))[1] == 1
    for r in found:
        own, edited = fingerprints.decode(r.fingerprint), fingerprints.decode(r.edited_fingerprint)
        assert (r.near_edited, r.kept_share) == fingerprints.likeness(own, edited)
    assert fingerprints.edit_fingerprints(none).count() == 0


def test_sketches_keep_every_hash_below_one_threshold():
    def shingles(text):
        return {text[i : i + 6] for i in range(max(1, len(text) - 5))} if text else set()

    errors = []
    for n in (0, 1, 3, 20, 200, 2000):
        text = prose(n)
        every, some = fingerprints.sketch(text, 1), fingerprints.sketch(text)
        assert len(every) == len(shingles(text))
        assert some.tolist() == [h for h in every.tolist() if h < 2**32 // fingerprints.SCALE]
        other = text[: len(text) * 2 // 3] + prose(n // 3)
        true = shingles(text) & shingles(other), shingles(text) | shingles(other)
        if n >= 200:
            near = fingerprints.likeness(some, fingerprints.sketch(other))[0]
            errors.append(abs(near - len(true[0]) / len(true[1])))
            assert errors[-1] < 4 * (0.25 * fingerprints.SCALE / len(true[1])) ** 0.5
    assert fingerprints.likeness(fingerprints.sketch(None), fingerprints.sketch("")) == (1, 1)
    assert fingerprints.likeness(fingerprints.sketch(""), fingerprints.sketch(prose(50))) == (0, 0)


def test_toxicity(spark, docs, none):
    restorer = toxicity.Restorer(toxicity.trigram_counts(["stupid", "idiot", "the", "and"] * 50))
    for disguised in ("st0p 1d10t", "i d i o t now", "idiiiiot", "an i.d.i.o.t!"):
        assert "idiot" in restorer.words(disguised)
    assert "moron" not in restorer.words("m oron")
    labels = spark.createDataFrame([(0, 1), (3, 0), (None, 1), (6, None)], "doc_id long, toxic int")
    found = toxicity.score_toxicity(docs, labels, fold("doc_id", 3) == 1).collect()
    assert len(found) == len(rows()) and all(0 <= r.score <= 1 for r in found)
    assert toxicity.score_toxicity(none, labels.limit(0), F.lit(False)).count() == 0


def test_evidence_is_looked_up_once_a_token(monkeypatch):
    texts = [None, "", "st0p, the i d i o t! letter-box", "STUPID stu.pid idiiiiot\u00a0the \u0130diot", "the letter the bo++om a", prose(200)]
    restorer = toxicity.Restorer(toxicity.trigram_counts(["stupid", "idiot", "the", "letter", "bottom"] * 50))
    every = set().union(*(toxicity.features(restorer.words(t)) for t in texts))
    telling = {f: 0.9 for f in sorted(every)[::2]}
    asked, readings = [], restorer.readings
    monkeypatch.setattr(restorer, "readings", lambda token: asked.append(token) or readings(token))
    evidence = toxicity.Evidence(restorer, telling)
    found = [evidence(t) for t in texts * 2]
    assert len(asked) == len(set(asked))
    monkeypatch.undo()
    assert found == [sorted(telling.keys() & toxicity.features(restorer.words(t))) for t in texts] * 2


def test_preferences(spark):
    turns = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 2, "user", "r"), (1, 3, "assistant", "b"),
             (2, 0, "user", None), (2, 1, "assistant", "other"), (4, 0, None, "")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    found = {r.pair_id: r for r in preferences.format_preferences(preferences.reply_pairs(frame)).collect()}
    first = found[1]
    assert first.prompt_turns == 3 and first.prompt.endswith("r\n<|end|>\n")
    start, length = first.chosen_loss[0]
    assert first.chosen_completion[start : start + length] == "b\n<|end|>\n"
    assert "other" in first.rejected_completion and found[4].rejected_completion is None
    assert preferences.format_preferences(preferences.reply_pairs(frame.limit(0))).count() == 0


def test_nearest(spark):
    random_ = np.random.default_rng(3)
    vectors = random_.normal(size=(400, 8)) * random_.uniform(0.5, 2, (400, 1))
    vectors[7] = vectors[9]
    data = [(i, v.tolist()) for i, v in enumerate(vectors)] + [(900, None), (901, [0.0] * 8), (902, [math.nan] * 8), (903, [None] * 8)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    found = graph.nearest(frame, frame.where("vec_id % 20 = 0"), 10).collect()
    exact = vectors.astype(np.float32).astype(float)
    hits = 0
    for q in range(0, 400, 20):
        scores = exact @ exact[q]
        scores[q] = -math.inf
        best = set(np.lexsort((np.arange(400), -scores))[:10].tolist())
        own = [r for r in found if r.query_id == q]
        assert [r.rank for r in sorted(own, key=lambda r: (-r.score, r.vec_id))] == list(range(1, 11))
        hits += len(best & {r.vec_id for r in own})
    assert hits >= 0.9 * 200
    assert graph.nearest(frame.limit(0), frame.limit(0)).count() == 0
