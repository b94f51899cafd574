"""The whole job where operators once did less: full contexts, evidence of unlike texts, disguises of all kinds,
hot seeds in bounded groups, partners over gaps of ids,
stages of the pipeline, vectors of every length."""

import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from chartloom.llm import language, minhash, mixing, preferences, scoring, stages, suffixes, toxicity

rng = random.Random(7)
WORDS = ["".join(rng.choices("abcdefgho", k=rng.randint(3, 7))) for _ in range(400)]


def prose(n):
    return " ".join(rng.choices(WORDS, k=n))


def test_contexts_reach_over_word_borders():
    data = b"to be or not to be that is"
    raw = scoring.END * (scoring.DEPTH - 1) + b" " + data + b" " + scoring.END
    want = [int.from_bytes(raw[i - scoring.DEPTH : i + 1], "big") for i in range(scoring.DEPTH, len(raw))]
    assert np.concatenate(list(scoring.gram_keys(data))).tolist() == want
    assert scoring.DEPTH >= 6


def test_evidence_keeps_unlike_texts_and_other_labels(spark):
    lowest = min((f"{a} {b}" for a in WORDS[:60] for b in WORDS[:60]), key=lambda p: minhash.shingle_set(p, 2)[0])
    texts = [lowest + " " + prose(30) for _ in range(12)]
    lows = [minhash.shingle_set(t, 2)[0] for t in texts]
    assert max(lows.count(x) for x in lows) > 2
    copies = [texts[0] + " tail", texts[0], texts[0]]
    frame = spark.createDataFrame(list(enumerate(texts + copies)), "doc_id long, text string")
    sample = spark.createDataFrame([(i, int(i in (1, 14))) for i in range(15)], "doc_id long, toxic int")
    kept = sorted((r.text, r.toxic) for r in toxicity.one_of_copies(frame, sample).collect())
    assert kept == sorted([(t, int(i == 1)) for i, t in enumerate(texts)] + [(texts[0], 1)])


def test_unlike_texts_of_one_id_are_rows_of_their_own(spark):
    a, b = prose(60), prose(60)
    frame = spark.createDataFrame([(2, a), (5, a + " x"), (5, b), (9, b + " y")], "doc_id long, text string")
    found = {(r.doc_id, r.n_shingles): r.component_id for r in minhash.near_duplicates(frame, words=2).collect()}
    assert sorted(found.values()) == [2, 2, 5, 5]


def test_disguises_are_read():
    for disguised, word in [
        ("a$$hole", "asshole"), ("pu$$y", "pussy"), ("b@$tard", "bastard"), ("b!+ch", "bitch"), ("tr@$h", "trash"),
        ("stuupid", "stupid"), ("sc.um", "scum"), ("f a g", "fag"), ("$ c u m", "scum"), ("s\tc\tu\tm", "scum"),
        ("s\nc\nu\nm", "scum"), ("s   c   u   m", "scum"), ("an a$$", "ass"), ("(stuupid)", "stupid"), ("tr@$h!", "trash"),
    ]:
        restorer = toxicity.Restorer(toxicity.trigram_counts([word, "the", "and", "good"] * 50))
        assert word in restorer.words(disguised), disguised
    assert restorer.words("1 2 3 2024 12:30") == set()


def _passages():
    passage = (prose(60) + " ")[:230]
    texts = [prose(rng.randint(5, 20)) + passage[rng.randint(0, 25) :] + prose(rng.randint(5, 20)) for _ in range(40)]
    return texts + [prose(15) + passage[60:130] + prose(15) for _ in range(20)] + [passage, texts[0] + "tail", passage[:205]]


def test_strings_of_hot_seeds_are_counted(spark, monkeypatch):
    texts = _passages()
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")

    def spans(bound):
        rows = suffixes.repeated_spans(frame, bound=bound).collect()
        found = {}
        for r in rows:
            found.setdefault(r.uid, []).append(r.asDict())
        return {uid: suffixes._merged(s) for uid, s in found.items()}

    whole = spans(10**6)
    assert len(whole) > 35
    assert spans(4) == whole
    monkeypatch.setattr(suffixes, "SMALL", 0)
    assert spans(4) == whole


def test_every_string_has_one_anchor():
    long_ = (prose(200) + " ab" * 200 + prose(100)).encode()
    for data in (b"a" * 200, b"a" * 450, b"abc" * 200, long_, long_[:200], prose(300).encode()):
        _, _, at, before, after = suffixes.anchors(data)
        members = [(data[p - b : p][::-1], data[p : p + n]) for p, b, n in zip(at, before, after, strict=True)]
        which, hashes, starts = suffixes.own_strings(members, 200, 40)
        places = (at[which] + starts).tolist()
        assert sorted(places) == list(range(len(data) - 199))
        strings = {}
        for h, s in zip(hashes.tolist(), places, strict=True):
            strings.setdefault(h, set()).add(data[s : s + 200])
        assert all(len(v) == 1 for v in strings.values())
        assert len(strings) == len({data[s : s + 200] for s in places})


def test_groups_are_all_maximal_repeats():
    for _ in range(60):
        alphabet = "ab" if rng.random() < 0.5 else "abc"
        members = [
            ("".join(rng.choices(alphabet, k=rng.randint(0, 5))).encode(), b"x" + "".join(rng.choices(alphabet, k=rng.randint(0, 5))).encode())
            for _ in range(rng.randint(0, 9))
        ]
        length = rng.randint(2, 5)
        want = set()
        for left in range(6):
            for right in range(1, 7):
                groups = {}
                for i, (before, after) in enumerate(members):
                    if left + right >= length and len(before) >= left and len(after) >= right:
                        groups.setdefault((before[:left], after[:right]), []).append(i)
                for group in groups.values():
                    nexts = [{side[n : n + 1] or i for i, side in ((i, members[i][k]) for i in group)} for k, n in ((0, left), (1, right))]
                    if len(group) > 1 and all(len(n) > 1 for n in nexts):
                        want.add((left, right, tuple(group)))
        found = [(left, right, tuple(sorted(group))) for left, right, group in suffixes.maximal_repeats(members, length)]
        same = {g for g in found}
        assert len(found) == len(same)
        ends = {i: members.count(m) for i, m in enumerate(members)}
        if max(ends.values(), default=1) == 1:  # contexts are distinct in use
            assert same == want


def test_partners_over_gaps(spark):
    ids = sorted(rng.sample(range(-(10**12), 10**12), 60))
    silent = set(ids[5:9] + ids[30:31] + ids[-2:])
    turns = [(i, 0, "user", f"q{i}") for i in ids] + [(i, 1, "assistant", f"a{i}") for i in ids if i not in silent]
    turns += [(None, 0, "user", "lost"), (None, 1, "assistant", "found")]
    frame = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    rows = preferences.format_preferences(preferences.reply_pairs(frame)).collect()
    assert len(rows) == len(ids) + 2
    found = {r.pair_id: r for r in rows if r.pair_id is not None}
    show = preferences.STOP.join
    for at, i in enumerate(ids):
        after = next((j for j in ids[at + 1 :] if j not in silent), None)
        r = found[i]
        assert r.prompt == show([f"<|user|>\nq{i}", ""]) and r.prompt_turns == 1
        assert r.chosen_completion == ("" if i in silent else show([f"<|assistant|>\na{i}", ""]))
        partner = None if after is None or i in silent else show([f"<|assistant|>\na{after}", ""])
        assert r.rejected_completion == partner and (r.rejected_loss is None) == (partner is None)
    lost = sorted((r.prompt, r.chosen_completion) for r in rows if r.pair_id is None)
    assert lost == [("", show(["<|assistant|>\nfound", ""])), (show(["<|user|>\nlost", ""]), "")]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def _stage_rows():
    a, b, c = prose(80), prose(90), prose(100)
    texts = [(2, a), (5, a + " tail"), (5, b), (9, b + " tail"), (9, c), (9, c), (None, a), (None, a), (11, None), (11, ""), (12, "")]
    texts += [(20 + i, prose(rng.randint(1, 60))) for i in range(12)]
    return [(i, t, "en" if n % 2 else "fr", f"s{n % 3}", len(t or "")) for n, (i, t) in enumerate(texts)]


STAGE_ROWS = _stage_rows()


def _near_dedup(rows):
    """Rows that near_dedup keeps."""
    rows = [r for r in rows if r[0] is not None]
    sets = []
    for r in rows:
        w = (r[1] or "").split()
        n = min(5, len(w))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if w else set())
    group = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if rows[i][:2] == rows[j][:2] or a and b and 100 * len(a & b) >= 80 * len(a | b):
                group = [group[i] if g == group[j] else g for g in group]
    least = {g: min(r[0] for r, h in zip(rows, group, strict=True) if h == g) for g in group}
    return sorted((i, g) for g, i in least.items())


def test_near_dedup_by_row(spark):
    frame = spark.createDataFrame(STAGE_ROWS, SCHEMA).repartition(3)
    kept = [tuple(r) for r in stages.near_dedup(spark, frame, "").collect()]
    assert sorted(r[0] for r in kept if r[0] is not None) == [i for i, _ in _near_dedup(STAGE_ROWS)]
    assert sum(r[0] is None for r in kept) == 2
    assert {r[1] for r in kept if r[0] == 9} == {next(r[1] for r in STAGE_ROWS if r[0] == 9 and "tail" not in r[1])}
    assert [r[1] for r in kept if r[0] == 5] == [STAGE_ROWS[2][1]]


def test_run_is_its_stages(spark, tmp_path):
    import corpus_pipeline
    from tokenizers import Tokenizer

    from chartloom.llm.queries import WORD_VOCABULARY

    frame = spark.createDataFrame(STAGE_ROWS, SCHEMA)
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    outs, stages_ = {}, corpus_pipeline.STAGES

    def noted(name, stage):
        def run(spark_, docs, sf_dir):
            before = [tuple(r) for r in docs.collect()]
            outs[name] = (before, out := stage(spark_, docs, sf_dir).cache())
            return out

        return name, run

    corpus_pipeline.STAGES = [noted(*s) for s in stages_]
    try:
        last = corpus_pipeline.run(spark, str(tmp_path)).collect()
    finally:
        corpus_pipeline.STAGES = stages_
    after = {name: [tuple(r) for r in out.collect()] for name, (_, out) in outs.items()}
    before = {name: rows for name, (rows, _) in outs.items()}
    names = [name for name, _ in stages_]
    for name, following in zip(names, names[1:], strict=False):
        assert Counter(after[name]) == Counter(before[following])
    decoder = language.fit_decoder(frame.select("text", "lang"))
    found = language.identify(frame, decoder, keep=tuple(frame.columns)).collect()
    want = Counter(tuple(r[c] for c in frame.columns) for r in found if r.lang_pred != language.UNKNOWN and not r.ambiguous)
    assert Counter(after["language"]) == want and sum(want.values()) > 5
    ids = sorted(r[0] for r in after["near_dedup"] if r[0] is not None)
    assert ids == [i for i, _ in _near_dedup(before["near_dedup"])]
    every = Counter()
    for r in before["suffix_dedup"]:
        data = (r[1] or "").encode()
        every.update(data[i : i + 200] for i in range(len(data) - 199))
    cut = []
    for r in before["suffix_dedup"]:
        data = (r[1] or "").encode()
        gone = {j for i in range(len(data) - 199) if every[data[i : i + 200]] > 1 for j in range(i, i + 200)}
        text = None if r[1] is None else bytes(x for i, x in enumerate(data) if i not in gone).decode()
        cut.append((*r[:1], text, *r[2:4], None if text is None else len(text)))
    assert Counter(after["suffix_dedup"]) == Counter(cut)
    given, taken = before["mix_sources"], Counter()
    for i, text, lang, source, n in after["mix_sources"]:
        assert n == len(text)
        assert any((i, lang, source) == (r[0], r[2], r[3]) and r[1].split()[: len(text.split())] == text.split() for r in given)
        taken[source] += len(text.split())
    targets = {r.source: r.target for r in mixing.mix_plan(spark.createDataFrame(given, SCHEMA)).collect()}
    assert all(abs(taken[source] - target) <= 1 for source, target in targets.items())
    tokenizer = Tokenizer.from_file(WORD_VOCABULARY)
    tokens = Counter(t for r in before["pack"] for t in [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1])
    assert tokens == Counter(t for p in last for t in np.frombuffer(p.ids, "<u4").tolist())


def test_vectors_of_every_length_are_found(spark):
    from chartloom.llm import graph

    random_ = np.random.default_rng(5)
    vectors = {i: random_.normal(size=3 if i % 10 == 0 else 8) for i in range(300)}
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in vectors.items()] + [(900, [1.0])], "vec_id long, embedding array<float>")
    for first in (8, 3):
        order = frame.orderBy(F.size("embedding") != first).coalesce(1)
        found = graph.nearest(order, frame.where("vec_id IN (20, 30, 7, 900)"), 5).collect()
        for q in (20, 30, 7):
            own = [r.vec_id for r in sorted((r for r in found if r.query_id == q), key=lambda r: r["rank"])]
            alike = [i for i, v in vectors.items() if len(v) == len(vectors[q]) and i != q]
            want = sorted(alike, key=lambda i: -float(vectors[i].astype("f4") @ vectors[q].astype("f4")))[:5]
            assert len(set(own) & set(want)) >= 4
        assert not [r for r in found if r.query_id == 900]
