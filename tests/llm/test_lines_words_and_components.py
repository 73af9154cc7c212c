"""Line dedup, spelling variants and whitening against brute force, with the rows every operator must take."""

import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from realty_spark.llm import line_dedup, spelling, whitening
from realty_spark.llm.acceptor import Acceptor
from realty_spark.llm.common import land
from tests.llm import edge

SPACE = " \t\n\x0b\x0c\r"


# ------------------------------------------------------------- line dedup --
def line_key(line: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def lines_by_force(rows, threshold, min_chars):
    held = defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            if i is not None and len(line_key(line)) >= min_chars:
                held[line_key(line)].add(i)
    gone = {k for k, ids in held.items() if len(ids) >= threshold}
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if line_key(x) not in gone]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def shared_lines():
    r = random.Random(5)
    pool = ["Share this", "  share THIS\t", "menu | home", "É accent", "é accent", "", "   ", "once", "\x0bfoot\x0c", "foot"]
    rows = [(i, "\n".join(r.choice(pool) for _ in range(r.randrange(0, 12)))) for i in range(60)]
    return rows + [(7, "Share this\nother"), (7, "Share this\nother"), (7, None), (None, "Share this\nkept line"), (None, None), (None, "foot"),
                   (61, "\n" * 5), (62, "menu | home\n" * 20_000 + "end"), (63, "Share this"), (63, "Share this")]


@pytest.mark.parametrize(("threshold", "min_chars", "batches", "fanout"), [(10, 1, 6, 3), (3, 5, 7, 2), (1, 1, 1, 2), (25, 1, 5, 9)])
def test_lines_that_many_documents_hold_go(spark, threshold, min_chars, batches, fanout):
    rows = shared_lines()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = line_dedup.drop_shared_lines(docs, threshold, min_chars, batches=batches, fanout=fanout)
    got = Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in out.collect())
    assert got == lines_by_force(rows, threshold, min_chars)


def test_lines_of_edge_rows_and_clashing_columns(spark):
    rows = [r[:2] for r in edge.documents()]
    out = line_dedup.drop_shared_lines(edge.frame(spark), 2, payload=["key", "source"])
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in out.collect()) == lines_by_force(rows, 2, 1)
    assert {r.row.key for r in out.collect()} == {"x"}
    assert line_dedup.drop_shared_lines(edge.empty(spark)).count() == 0


def test_runs_are_levelled_and_not_shuffled_by_later_batches(spark):
    docs = spark.createDataFrame(shared_lines(), "doc_id long, text string")
    lines = line_dedup.land_by(line_dedup.line_hashes(docs, 1, 5), "batch", "lines")
    runs = line_dedup.LineRuns(spark, threshold=10, fanout=3)
    for batch in range(4):
        runs.add(lines.where(F.col("batch") == batch))
    assert [len(level) for level in runs.levels] == [1, 1]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = runs.unsettled(lines.where("batch = 4"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("SortMergeJoin") == 2 and plan.count("Bucketed: true") == 2
    assert plan.count("Exchange") == 2  # those of the batch's own counts
    settled = runs.settled().count()
    names = runs.names()
    runs.drop()
    assert settled and not any(spark.catalog.tableExists(n) for n in names)


# ------------------------------------------------------ spelling variants --
def near(u: str, v: str) -> bool:
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    u, v = sorted((u, v), key=len, reverse=True)
    return len(u) == len(v) + 1 and any(u[:i] + u[i + 1:] == v for i in range(len(u)))


def pairs_by_force(words) -> set:
    words = sorted(words)
    return {(u, v) for i, u in enumerate(words) for v in words[i + 1:] if near(u, v)}


@settings(max_examples=150, deadline=None)
@given(st.sets(st.text("abé", max_size=7), max_size=40))
def test_composition_enumerates_each_near_pair_once(words):
    acceptor = Acceptor(sorted(words))
    got = [tuple(sorted(p)) for p in acceptor.one_edit_pairs()]
    assert len(got) == len(set(got)) and set(got) == pairs_by_force(words)


@settings(max_examples=100, deadline=None)
@given(st.sets(st.text("ab", max_size=6), min_size=1, max_size=30))
def test_acceptor_is_minimal_and_accepts_its_words_alone(words):
    acceptor = Acceptor(sorted(words))

    def tails(state):
        return ({""} if acceptor.final[state] else set()) | {a + t for a, to in acceptor.arcs[state].items() for t in tails(to)}
    accepted = [frozenset(tails(s)) for s in range(len(acceptor.arcs))]
    assert accepted[acceptor.start] == words and len(set(accepted)) == len(accepted)


def vocabulary():
    r = random.Random(3)
    words = {"".join(r.choice("ab") for _ in range(r.randint(1, 9))) for _ in range(500)}
    return words | {"a" * k for k in range(1, 14)} | {"x" * 12 + "".join(r.choice("pq") for _ in range(3)) for _ in range(6)}


@pytest.mark.parametrize(("crowded", "depth", "long"), [(2000, 24, 64), (10, 24, 64), (5, 3, 64), (3, 2, 6)])
def test_near_pairs_of_crowded_deep_and_long_words(spark, crowded, depth, long):
    words = vocabulary()
    rows = land(spark.createDataFrame([(w, len(w)) for w in words], "word string, n long"), "words")
    got = [(r.a, r.an, r.b, r.bn) for r in spelling.near_pairs(rows, crowded, depth, long).collect()]
    assert len(got) == len(set(got)) and set(got) == {(u, len(u), v, len(v)) for u, v in pairs_by_force(words)}


def variants_by_force(rows, min_chars, min_count, every, factor):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    n = {w: c for w, c in count.items() if len(w) >= min_chars and c >= min_count}
    beside = defaultdict(set)
    for u, v in pairs_by_force(n):
        beside[u].add(v)
        beside[v].add(u)
    form = {w: b for w in n if beside[w] and n[b := min(beside[w], key=lambda x: (-n[x], x))] >= factor * n[w]}

    def root(w):
        return root(form[w]) if w in form else w
    return {(w, form.get(w), root(w), n[w], len(beside[w]), n.get(form.get(w))) for w in n}


@pytest.mark.parametrize(("every", "factor"), [(31, 10), (2, 1.5), (1, 2)])
def test_variants_match_brute_force(spark, every, factor):
    r = random.Random(9)
    common = ["remarkable", "Straßenbahn", "éléphants", "wonderful", "wonderfull", "wondrful", "ÿÿÿÿÿÿÿ", "ab×÷cdefg"]
    rows = [(i, " ".join(r.choice(common[:1 + r.randrange(8)]) for _ in range(r.randrange(60)))) for i in range(80)]
    rows += [r[:2] for r in edge.documents()] + [(None, "remarkable wonderful"), (90, "remarkabl remarkabl remarkab"), (90, "remarkabl"),
                                                 (91, "b" * 30_000 + " " + "b" * 29_999 + "c " + "b" * 30_000), (92, "b" * 30_000 + " " + "b" * 29_999 + "c")]
    out = spelling.spelling_variants(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), every=every, factor=factor, crowded=3)
    got = {(x.word, x.form, x.root, x.n, x.n_near, x.form_n) for x in out.collect()}
    assert got == variants_by_force(rows, 7, 2, every, factor) and out.count() == len(got)


def test_variants_of_clashing_columns_and_empty_tables(spark):
    assert spelling.spelling_variants(edge.empty(spark)).count() == 0
    got = {(x.word, x.n) for x in spelling.spelling_variants(edge.frame(spark), min_chars=5).collect()}
    assert got == {(w, n) for w, _, _, n, _, _ in variants_by_force([r[:2] for r in edge.documents()], 5, 2, 31, 10)}


# --------------------------------------------------------------- whitening --
@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(0, 40), st.integers(0, 10_000))
def test_leading_pairs_match_a_dense_solver(dims, rank, seed):
    a = np.random.default_rng(seed).standard_normal((dims, min(rank, dims)))
    a = a @ a.T
    values, vectors = whitening.leading(lambda b: a @ b, dims, 4)
    want = np.linalg.eigvalsh(a)[::-1][:4]
    scale = max(want[0], 1e-300)
    assert np.allclose(values / scale, want / scale, atol=1e-12)
    assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-12)
    assert np.all(np.linalg.norm(a @ vectors - vectors * values, axis=0) <= 1e-12 * scale)


def test_leading_pairs_of_equal_and_close_values():
    for diagonal in ([3.0] * 30, [5.0, 5.0, 5.0, 1.0] + [0.5] * 20, list(1 + 1e-9 * np.arange(25)), [1e12, 1.0, 1e-3, 1e-6] + [0.0] * 8):
        q = np.linalg.qr(np.random.default_rng(1).standard_normal((len(diagonal),) * 2))[0]
        a = (q * np.array(diagonal)) @ q.T
        a = (a + a.T) / 2
        values, vectors = whitening.leading(lambda b, a=a: a @ b, len(a), 4)
        assert np.allclose(values, sorted(diagonal, reverse=True)[:4], rtol=1e-12, atol=1e-13 * max(diagonal))
        assert np.linalg.norm(a @ vectors - vectors * values, axis=0).max() <= 1e-12 * max(diagonal)


def test_inner_solver_reaches_an_indefinite_system():
    rng = np.random.default_rng(2)
    q = np.linalg.qr(rng.standard_normal((12, 12)))[0]
    a = (q * np.linspace(-3, 4, 12)) @ q.T
    b = rng.standard_normal((12, 3))
    x = whitening.minres_block(lambda v: a @ v, b, 40, 1e-13)
    assert np.allclose(a @ x, b, atol=1e-8)


SCHEMA = "vec_id long, embedding array<float>, label int, x string, part string, at string, n string, dims string"


def embeddings():
    rng = np.random.default_rng(4)
    base = (rng.standard_normal((300, 6)) * [3, 2, 1.5, 1, 0.5, 0.1]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(300 + i, base[0].tolist()) for i in range(150)] + [(5, base[5].tolist()), (None, base[6].tolist()), (1, base[7].tolist())]
    bad = [(900, None), (901, []), (902, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (903, [float("nan")] * 6), (904, [float("inf")] * 6), (905, [1.0, 2.0])]
    return rows, bad


def test_whitening_matches_a_dense_solver(spark):
    rows, bad = embeddings()
    df = spark.createDataFrame([(*r, 1, *"vwxyz") for r in rows + bad], SCHEMA).repartition(5)
    got = whitening.whiten(df).collect()
    x = np.floor(256 * np.array([v for _, v in rows], dtype=np.float64)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:4], vectors[:, ::-1][:, :4]
    want = Counter()
    for (i, _), row in zip(rows, x):
        y = (row - sums / n) @ vectors / np.sqrt(values)
        for k in range(4):
            want[i, k + 1, n, int(((n * row - sums) ** 2).sum()), round(abs(float(y[k])), 9)] += 1
    assert Counter((r.vec_id, r.component, r.n, r.deviation, round(abs(r.whitened), 9)) for r in got) == want
    total = np.trace(centred.T @ centred / n)
    assert all(abs(r.explained - values[r.component - 1] / total) < 1e-12 and r.identity_error < 1e-10 for r in got)
    assert len({(r.component, r.explained, r.identity_error) for r in got}) == 4


def test_whitening_of_few_vectors(spark):
    def run(rows):
        return whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert run([]) == [] and run([(1, None), (2, [])]) == []
    assert run([(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []  # no variance
    two = run([(1, [0.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0])])
    assert sorted((r.vec_id, r.component, r.n, r.deviation, round(abs(r.whitened), 12), r.explained) for r in two) == [
        (1, 1, 2, 256 ** 2, 1.0, 1.0), (2, 1, 2, 256 ** 2, 1.0, 1.0), (2, 1, 2, 256 ** 2, 1.0, 1.0)]
    far = run([(1, [1e30]), (2, [-1e30]), (3, [0.0])])  # the nearest long; the deviation is beyond 64 bits
    assert {r.vec_id: r.deviation for r in far} == {1: None, 2: None, 3: 1}


def test_covariance_products_leave_one_partial_sum_a_task(spark):
    rows, _ = embeddings()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    fit = land(whitening.integers(df, "vec_id", "embedding", 256).select("x").distinct(), "fit")
    cov = whitening.Covariance(fit, 6)
    x = np.array([r.x for r in fit.collect()], dtype=np.float64)
    b = np.random.default_rng(0).standard_normal((6, 3))
    assert np.allclose(cov.times(b), np.cov(x.T, bias=True) @ b, rtol=1e-10)
    assert np.isclose(cov.trace(), np.trace(np.cov(x.T, bias=True)), rtol=1e-10)


def test_words_are_counted_without_taking_a_batch_out_at_once():
    """A batch of 40 MB of texts leaves a task's Python memory small, and every text is counted."""
    words = ["abcdefg", "hijklmno", "pqrstuvw", "abcdefgh"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4000), pa.int64()), pa.array([f"{words[i % 4]} " + "." * 10_000 for i in range(4000)])], names=["doc_id", "text"])
    tracemalloc.start()
    got = list(spelling.counted_words([batch, batch.slice(0, 0)], 7, 1 << 40))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert {w: n for b in got for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist())} == dict.fromkeys(words, 1000)
    assert peak < 10e6
