"""Near dedup, substring dedup, language, quality: brute force, held-out accuracy and edge rows."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from realty_spark.llm import fm_index, graph, language, near_dedup, quality, substring_dedup
from realty_spark.llm.words import grams, hashes, split
from tests.llm import edge


def shingles(text, k):
    w = split(text, lower=True)
    if not w:
        return set()
    return {tuple(w)} if len(w) < k else {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute_components(rows, k, num, den):
    """Least reachable id of each id, linking every pair of rows by the rule."""
    sets = [(i, shingles(t, k)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if x and y and den * len(x & y) >= num * len(x | y):
                p, q = sorted((find(i), find(j)))
                up[q] = p
    return {i: find(i) for i in up}


def check_near(spark, rows, k, num, den, frame):
    got = near_dedup.near_duplicates(frame, k=k, num=num, den=den).collect()
    want = brute_components(rows, k, num, den)
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got if r.doc_id is not None} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    assert all(r.component_id is None and r.kept for r in got if r.doc_id is None)
    sizes = {}
    for i, t in rows:
        sizes.setdefault(i, set()).add(len(shingles(t, k)))
    assert all(r.n_shingles in sizes[r.doc_id] for r in got)


def test_near_dedup_edge_rows(spark):
    rows = [(r[0], r[1]) for r in edge.documents()]
    check_near(spark, rows, 3, 85, 100, edge.frame(spark))
    assert near_dedup.near_duplicates(edge.empty(spark)).count() == 0


def test_near_dedup_finds_chains_and_links_outside_the_star(spark):
    r = random.Random(11)
    base, rows = edge.words(150, 7, 3000), []
    for i in range(250):
        w = list(base)
        for at in r.sample(range(150), r.choice([0, 1, 2, 3, 5, 8])):
            w[at] = f"e{r.randrange(40)}"
        rows.append((i, " ".join(w)))
    for i in range(250, 330):  # each a small change of the one before
        w = rows[-1][1].split()
        w[r.randrange(150)] = f"c{i}"
        rows.append((i, " ".join(w)))
    r.shuffle(rows)
    check_near(spark, rows, 3, 85, 100, spark.createDataFrame(rows, "doc_id long, text string").repartition(4))


def test_needed_differences_never_lose_a_linked_pair():
    r = random.Random(2)
    universe = list(range(60))
    for _ in range(4000):
        c = set(r.sample(universe, r.randrange(5, 40)))
        x, y = (set(v for v in c if r.random() > p) | {100 + e for e in range(8) if r.random() < p} for p in (r.random() * .5, r.random() * .5))
        if not x or not y:
            continue
        link = lambda a, b: 100 * len(a & b) >= 85 * len(a | b)
        if link(x, y) and not link(y, c) and x != y:
            k = near_dedup.needed(len(x ^ c), len(x), len(c), 85, 100)
            assert len((x ^ c) & (y ^ c)) >= k


def test_components(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 202), (300, 300)] + [(500, 501 + i) for i in range(50)]
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = {**{i: 0 for i in range(41)}, 100: 0, 200: 200, 201: 200, 202: 200, 500: 500, **{501 + i: 500 for i in range(50)}}
    assert got == want


def test_sketch_of_few_shingles_is_filled_alike():
    sk = near_dedup.Sketcher()
    a = np.unique(grams(hashes([b"w%d" % i for i in range(9)]), 3))
    b = a[:-1]
    assert len(set(sk.sketch(a).tolist())) <= len(a) and set(sk.sketch(b).tolist()) <= set(b.tolist())
    assert np.mean(sk.sketch(a) == sk.sketch(b)) > 0.5


def brute_repeats(rows, window):
    first = {}
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = split(t)
        for p in range(len(w) - window + 1):
            first.setdefault(tuple(w[p:p + window]), i)
    out = []
    for i, t in rows:
        w = split(t)
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p:p + window])] < i:
                gone.update(range(p, p + window))
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((-1 if i is None else i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def repeats(frame, **options):
    got = substring_dedup.remove_repeats(frame, **options).collect()
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in got)


def test_substring_dedup_edge_rows(spark):
    rows = [(r[0], r[1]) for r in edge.documents()]
    assert repeats(edge.frame(spark)) == brute_repeats(rows, 50)
    assert repeats(edge.empty(spark)) == []


@pytest.mark.parametrize("hot, shard_words", [(4096, 200_000), (3, 300)])
def test_substring_dedup_random(spark, hot, shard_words):
    r = random.Random(4)
    passages = [edge.words(r.randrange(10, 60), 50 + i) for i in range(6)]
    rows = []
    for i in range(80):
        w = []
        for _ in range(r.randrange(4)):
            w += edge.words(r.randrange(30), 1000 + i, 8) + r.choice(passages)
        rows.append((r.randrange(60) if i % 9 else None, " ".join(w)))
    rows = list({i if i is not None else -k: (i, t) for k, (i, t) in enumerate(rows, 1)}.values())
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert repeats(frame, window=12, gram=4, hot_segments=hot, shard_words=shard_words) == brute_repeats(rows, 12)


def test_backward_search_counts_occurrences():
    r = np.random.default_rng(1)
    text = np.append(r.integers(1, 5, 300), 0)
    index = fm_index.FMIndex(text, np.zeros(len(text), dtype=np.int64), 5, 6)
    for _ in range(50):
        pattern = r.integers(1, 5, r.integers(1, 6))
        lo, hi = np.array([0]), np.array([len(text)])
        for c in pattern[::-1]:
            lo, hi = index.extend(np.array([c]), lo, hi)
        count = sum((text[i:i + len(pattern)] == pattern).all() for i in range(len(text) - len(pattern)))
        assert hi[0] - lo[0] == count


def test_streamed_texts_find_their_windows_in_the_index_alone():
    r = random.Random(1)
    for trial in range(25):
        window, vocabulary = r.choice([1, 2, 3, 5, 8]), r.choice([2, 3, 20])
        held = [np.array([r.randrange(1, vocabulary + 1) for _ in range(r.randrange(1, 30))]) for _ in range(r.randrange(1, 12))]
        index = fm_index.FMIndex(np.concatenate([np.append(s, 0) for s in held]), np.repeat(np.arange(len(held)), [len(s) + 1 for s in held]),
                                 vocabulary + 1, window)
        streams = [np.array([r.choice([-1, *range(1, vocabulary + 1)]) for _ in range(r.randrange(1, 25))]) for _ in range(5)]
        offsets, lo, hi = index.matches(streams)
        for at, stream in zip(offsets, streams):
            for i in range(len(stream)):
                owners = sorted(d for d, s in enumerate(held) for k in range(len(s) - window + 1)
                                if i + window <= len(stream) and (s[k:k + window] == stream[i:i + window]).all())
                assert sorted(index.documents[lo[at + i]:hi[at + i]].tolist()) == owners


def test_the_index_is_smaller_than_its_text():
    r = random.Random(2)
    words = [b"word%d" % i for i in range(3000)]
    texts = [[r.choice(words) for _ in range(120)] for _ in range(500)]
    number = {w: i + 1 for i, w in enumerate(words)}
    ids = [np.array([number[w] for w in t]) for t in texts]
    index = fm_index.FMIndex(np.concatenate([np.append(s, 0) for s in ids]), np.repeat(np.arange(500), 121), 3001, 50)
    assert index.nbytes < sum(len(w) + 1 for t in texts for w in t)
    assert not [v for v in vars(index).values() if isinstance(v, np.ndarray) and v.dtype == np.int64 and len(v) >= index.size]


@pytest.fixture(scope="module")
def sf(request):
    return "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in language.op4_language_id(spark, sf).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [i for i, r in got.items() if r.held_out]
    assert len(got) == len(truth) and np.mean([got[i].lang_pred == truth[i] for i in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_edge_rows(spark):
    docs = edge.frame(spark)
    model = language.fit(docs)
    got = language.identify(docs, model).collect()
    assert len(got) == len(edge.documents())
    texts = {r[0]: r[1] for r in edge.documents()}
    for r in got:
        if r.doc_id in (6, 7, 8, 17):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif texts[r.doc_id]:
            assert r.lang_pred in ("en", "de", "fr")
    assert language.fit(edge.empty(spark)) is None
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}
    kept = language.keep_known(docs, model)
    assert kept.columns == docs.columns and not {6, 7, 8, 17} & {r.doc_id for r in kept.collect()}


def test_many_languages_are_kept_with_high_scores(spark):
    r, rows = random.Random(6), []
    langs = [lang for own in language.FAMILIES.values() for lang in own[:3]]
    for k, lang in enumerate(langs):  # each language its own letters
        words = ["".join(chr(0x4E00 + 40 * k + r.randrange(12)) for _ in range(r.randrange(2, 6))) for _ in range(30)]
        rows += [(len(rows) + i, " ".join(r.choices(words, k=40)), lang) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language.fit(docs)
    assert len(model.top.classes) == len(language.FAMILIES) == 16
    assert {x.doc_id for x in language.keep_known(docs, model).collect()} == {i for i, *_ in rows}
    got = {x.doc_id: x for x in language.identify(docs, model).collect()}
    assert np.mean([got[i].lang_pred == lang for i, _, lang in rows]) > 0.97
    assert np.median([x.score for x in got.values()]) > 0.7 and all(0 <= x.score <= 1 for x in got.values())


def test_features_do_not_depend_on_chunks(monkeypatch):
    text = " ".join(edge.words(900, 8)) + " Grüße"
    whole = language.features(text)
    monkeypatch.setattr(language, "CHUNK", 701)
    assert np.allclose(language.features(text), whole)


def test_quality_held_out_accuracy(spark, sf):
    got = {r.doc_id: r for r in quality.op6_quality(spark, sf).collect()}
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [i for i, r in got.items() if r.held_out and i in truth]
    assert np.mean([got[i].predicted == truth[i] for i in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_quality_edge_rows(spark):
    docs = edge.frame(spark)
    labels = spark.createDataFrame([(1, 1, 0, "x"), (2, 1, 0, "x"), (12, 0, 0, "x"), (12, 1, 0, "x"), (None, 0, 0, "x"), (15, 0, None, "x"),
                                    (3, None, 0, "x"), (17, 0, 0, "x")], "doc_id long, quality int, toxic int, text string")
    scores = quality.score_quality(docs, quality.fit(docs, labels)).collect()
    assert len(scores) == len(edge.documents()) and all(0 <= r.score <= 1 for r in scores)
    none = quality.fit(docs, labels.limit(0))
    assert {r.score for r in quality.score_quality(docs, none).collect()} == {0.5}
    assert quality.score_quality(edge.empty(spark), none).count() == 0


def test_marginals_match_enumeration():
    r = np.random.default_rng(3)
    sizes, move = np.array([4, 1, 3]), r.normal(size=(2, 2))
    odds = r.normal(size=8)
    got, at = quality.marginals(odds, sizes, move), 0
    for n in sizes:
        total, good = 0.0, np.zeros(n)
        for path in np.ndindex(*(2,) * n):
            s = sum(odds[at + i] * y for i, y in enumerate(path)) + sum(move[a, b] for a, b in zip(path, path[1:]))
            total += np.exp(s)
            good += np.exp(s) * np.array(path)
        assert np.allclose(got[at:at + n], good / total)
        at += n


def test_rows_that_share_an_id_link_their_texts(spark):
    x, y, z = (" ".join(edge.words(60, s)) for s in (21, 22, 23))
    rows = [(5, x), (5, y), (6, x + " more"), (7, y + " more"), (9, z), (9, z), (8, z + " more")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.component_id) for r in near_dedup.near_duplicates(frame).collect()}
    assert got == {(5, 5), (6, 5), (7, 5), (9, 8), (8, 8)}
    apart = near_dedup.near_duplicates(frame, by_id=False).collect()
    assert len({r.root for r in apart}) == 3 and {(r.doc_id, r.component_id) for r in apart} == got


def test_pairs_meet_at_their_first_common_difference_alone_if_they_may_be_linked(spark):
    """Brute force over random families: every linked pair outside the stars meets, few others do."""
    r = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(90):
        t = list(base)
        for _ in range(r.choice([1, 3, 5, 7])):
            at = r.randrange(0, 110)
            t[at:at + r.randrange(1, 3)] = [f"n{r.randrange(60)}"]
        rows.append((i, " ".join(t)))
    for k, num in ((5, 80), (3, 85)):
        check_near(spark, rows, k, num, 100, spark.createDataFrame(rows, "doc_id long, text string").repartition(4))


def test_late_links_join_components(spark):
    first = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (10, 10), (11, 10), (20, 20), (21, 20)], "node long, component long")
    late = spark.createDataFrame([(11, 3), (50, 51), (21, 60)], "a long, b long")
    got = {r.node: r.component for r in near_dedup.merged(first, late).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 10: 1, 11: 1, 20: 20, 21: 20, 60: 20, 50: 50, 51: 50}


def test_pairs_outside_stars_are_found(spark):
    base = list(range(200))
    sets = {0: base, 1: base[:150] + [1000 + i for i in range(50)], 2: base[:152] + [1000 + i for i in range(48)], 3: base[:110] + [5000 + i for i in range(90)]}
    mixed = {i: np.unique(grams(hashes([b"s%d" % v for v in s]), 1)) for i, s in sets.items()}
    key = {i: bytes([i]) for i in sets}
    frame = spark.createDataFrame([(bytearray(key[i]), bytearray(v.tobytes())) for i, v in mixed.items()], "class_key binary, items binary")
    edges = spark.createDataFrame([(bytearray(key[0]), bytearray(key[i])) for i in (1, 2, 3)], "c binary, x binary")
    checked = near_dedup.land(near_dedup.confirm(edges, frame, 85, 100, differences=True), "checked")
    assert checked.where("linked").count() == 0
    none = spark.createDataFrame([], "node binary, component binary")
    assert [(bytes(r.c), bytes(r.x)) for r in near_dedup.pairs_outside_stars(checked, none, 85, 100).collect()] == [(key[1], key[2])]


def test_line_field_gradient_matches_finite_differences():
    r = np.random.default_rng(3)
    sizes = np.array([4, 1, 6])
    odds, transition, weight = r.normal(size=11), r.normal(size=(2, 2)), np.array([0.5, 2.0, 1.0])
    y = np.repeat([1, 0, 1], sizes)
    y[2] = 0
    value, by_odds, by_move = quality.likelihood(odds, y, sizes, weight, transition)
    for i in range(11):
        up, down = odds.copy(), odds.copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        slope = (quality.likelihood(up, y, sizes, weight, transition)[0] - quality.likelihood(down, y, sizes, weight, transition)[0]) / 2e-6
        assert abs(slope - by_odds[i]) < 1e-6
    for i in range(4):
        up, down = transition.ravel().copy(), transition.ravel().copy()
        up[i] += 1e-6
        down[i] -= 1e-6
        slope = (quality.likelihood(odds, y, sizes, weight, up.reshape(2, 2))[0] - quality.likelihood(odds, y, sizes, weight, down.reshape(2, 2))[0]) / 2e-6
        assert abs(slope - by_move.ravel()[i]) < 1e-6


def test_texts_without_letters_have_no_language(spark):
    docs = spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog " * 5, "en"), ("le chat et le chien " * 5, "fr")] * 8)]
                                 + [(90 + i, t, None) for i, t in enumerate(["½ ² Ⅷ ①", "12 + 3 = 15!", "½ chat"])], "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language.identify(docs, language.fit(docs)).collect()}
    assert got[90] == got[91] == "und" and got[92] in ("en", "fr")


def test_machines_of_many_unlisted_languages_stay_few():
    langs = [f"x{i:03d}" for i in range(300)] + ["en", "de"]
    named = language.families(langs)
    members = {}
    for v, f in named.items():
        members.setdefault(f, []).append(v)
    machines = len(members) * (len(members) - 1) // 2 + sum(len(m) * (len(m) - 1) // 2 for m in members.values())
    assert named["en"] == named["de"] == "germanic" and max(map(len, members.values())) <= 8 and machines < 2500
    assert len(set(language.families(["q1", "q2", "q3"]).values())) == 3
