"""Token files and packing: exact round trips against the tokenizer, file format, optimality of the packing program."""

from __future__ import annotations

import glob
import random
import zlib

import numpy as np
import pytest
import zstandard
from tokenizers import Tokenizer

from realty_spark.llm import packing, token_files, tokens
from tests.llm import edge


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(tokens.default_tokenizer())


def plain(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids + [0]


def test_chunks_give_the_tokenizers_ids(tok, monkeypatch):
    r = random.Random(5)
    pieces = ["a", "The", "don't", "we'll", "x.", "é", "ß!", "  ", " ", "\n", "\t", "12", "$$$", "a,b", "…", " ", "'s", "Ünï", "?!"]
    texts = ["".join(r.choice(pieces) + r.choice(["", " ", " "]) for _ in range(r.randrange(40))) for _ in range(400)]
    texts += [t for _, t, *_ in edge.documents()]
    want = [plain(tok, t) for t in texts]
    for bound in (tokens.CACHE_CHUNKS, 10):  # a small cache turns over its generations
        monkeypatch.setattr(tokens, "CACHE_CHUNKS", bound)
        got = [np.frombuffer(b, "<u4").tolist() for b in tokens.Encoder(tokens.default_tokenizer()).batch(texts)]
        assert got == want


def test_long_texts_between_short_ones(tok, monkeypatch):
    monkeypatch.setattr(tokens, "BLOCK", 20)
    texts = []
    for k in range(6):
        texts += [" ".join(edge.words(12, 60 + k)), " ".join(edge.words(90, 70 + k)) + ".", " ".join(edge.words(12, 60))]
    want = [plain(tok, t) for t in texts]
    for bound in (10, 40, 100, 300):  # long texts turn the cache over while short ones wait
        e = tokens.Encoder(tokens.default_tokenizer())
        e.bound = bound
        assert [np.frombuffer(b, "<u4").tolist() for b in e.batch(texts)] == want


class NoText:
    """A tokenizer that takes no text with a space between words."""

    def __init__(self, tok):
        self.tok = tok

    def encode_batch_fast(self, texts, **options):
        assert not any(" " in t.strip() for t in texts)
        return self.tok.encode_batch_fast(texts, **options)


def test_words_of_letters_are_merged_without_cutting_text(tok):
    r = random.Random(8)
    letters = [c for c in map(chr, range(0x250)) if c.isalpha()]
    words = [c * n for c in letters for n in (1, 2)] + ["".join(r.choices(letters, k=r.randrange(1, 9))) for _ in range(3000)]
    e = tokens.Encoder(tokens.default_tokenizer())
    e.tok = NoText(e.tok)
    text = " ".join(["start", *words])
    assert np.frombuffer(next(iter(e.batch([text]))), "<u4").tolist() == plain(tok, text)
    other = " ".join(["start", *(w + c for w in words[:500] for c in "\u4e2d\u0434\u00b2"), "x1", "don't"])
    e = tokens.Encoder(tokens.default_tokenizer())
    assert np.frombuffer(next(iter(e.batch([other]))), "<u4").tolist() == plain(tok, other)


def test_frequent_chunks_stay_in_a_full_table(tok, monkeypatch):
    monkeypatch.setattr(tokens, "GROUP", 50)
    often, rare = edge.words(5, 1), iter([f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{i}" for i in range(2000)])
    texts = [" ".join(["a", *often, *(next(rare) for _ in range(10)), *often]) for _ in range(100)]
    e, met = tokens.Encoder(tokens.default_tokenizer()), []
    e.bound = 40
    monkeypatch.setattr(e, "_encode", lambda new, f=e._encode: met.extend(new) or f(new))
    assert [np.frombuffer(b, "<u4").tolist() for b in e.batch(texts)] == [plain(tok, t) for t in texts]
    assert max(met.count(w) for w in often) == 1 and len(e.inner) < 40 + 100
    e.bound = 2  # more chunks are frequent than may stay
    assert [np.frombuffer(b, "<u4").tolist() for b in e.batch(texts)] == [plain(tok, t) for t in texts]
    assert len(e.inner) < 2 + 100


def test_token_files_round_trip(spark, tok, tmp_path, monkeypatch):
    path = f"{tmp_path}/shards"
    docs = edge.frame(spark)
    token_files.write_tokens(docs, path, shard_tokens=5000)
    rows = token_files.read_tokens(spark, path).collect()
    want = sorted(((i is not None, i or 0, plain(tok, t)) for i, t, *_ in edge.documents()), key=lambda x: x[:2])
    got = [(r.doc_id is not None, r.doc_id or 0, np.frombuffer(r.ids, "<u4").tolist()) for r in sorted(rows, key=lambda r: r.start)]
    assert sorted(map(str, got)) == sorted(map(str, want)) and [g[:2] for g in got] == [w[:2] for w in want]
    starts = sorted((r.start, r.n_tokens) for r in rows)
    assert starts[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:]))
    some = token_files.read_tokens(spark, path, doc_ids=[12, 14, 99]).collect()
    assert sorted(r.doc_id for r in some) == [12, 14, 14]


def test_shard_is_a_zstandard_stream_and_reads_few_frames(monkeypatch):
    w = token_files.ShardWriter()
    docs = [np.arange(n, dtype="<u4").tobytes() for n in (10, 40_000, 600_000, 0, 7)]
    for i, d in enumerate(docs):
        w.add(i if i else None, d)
    data = w.render(3, 1)
    assert zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read() == b"".join(docs)
    r = token_files.ShardReader(data)
    assert (r.partition, r.shard, r.null.tolist()) == (3, 1, [True, False, False, False, False])
    opened = []
    monkeypatch.setattr(r, "frame", lambda k, f=r.frame: opened.append(k) or f(k))
    assert [r.ids(4), r.ids(0)] == [docs[4], docs[0]] and len(set(opened)) == 2 < len(r.entries)
    assert [r.ids(i) for i in range(5)] == docs
    broken = bytearray(data)
    broken[int(r.frame_at[1]) + 40] ^= 1
    with pytest.raises((ValueError, zstandard.ZstdError)):
        token_files.ShardReader(bytes(broken)).ids(2)


def test_token_files_of_an_empty_table(spark, tmp_path):
    token_files.write_tokens(edge.empty(spark), f"{tmp_path}/none")
    assert token_files.read_tokens(spark, f"{tmp_path}/none").count() == 0


def cost(cuts, pen, window):
    total, begin = 0.0, 0
    for c in cuts:
        n = c - begin
        free = n & (n - 1) == 0 and n >= min(packing.SHORTEST, window)
        total += (0 if free else window - n) + pen[c]
        begin = c
    return total


def best(at, pen, window):
    least = {0: 0.0}
    for p in at:
        least[p] = min(least[b] + cost([p - b], {p - b: pen[p]}, window) for b in least if 0 < p - b <= window)
    return least[at[-1]]


def test_plan_is_optimal():
    r = random.Random(3)
    for window in (16, 128):
        for _ in range(60):
            at = sorted(r.sample(range(1, 6 * window), r.randrange(1, 3 * window)) + list(range(window, 7 * window, window)))
            at = sorted(set(at))
            pen = {p: float(r.choice([0, 2, 9])) for p in at}
            cuts = packing.plan(at, [pen[p] for p in at], window)
            assert set(cuts) <= set(at) and cuts[-1] == at[-1]
            assert all(b - a <= window for a, b in zip([0, *cuts], cuts))
            assert cost(cuts, pen, window) == pytest.approx(best(at, pen, window))


def test_candidates_reach_into_long_sentences():
    at, kind = packing.candidates(np.array([5000]), np.array([10, 5000]), 5000, 1024)
    assert at[0] == 10 and at[-1] == 5000 and np.diff(np.concatenate([[0], at])).max() <= 1024 and set(kind.tolist()) == {0, 2}


def test_pieces_cover_every_id_once(spark, tok):
    rows = packing.pack_documents(edge.frame(spark), segment_tokens=4000).collect()
    texts = sorted(((i is not None, i or 0, plain(tok, t)) for i, t, *_ in edge.documents()), key=lambda x: x[:2])
    whole, by = {}, {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
        whole.setdefault((r.doc_id is not None, r.doc_id or 0), []).append(r)
    for parts in by.values():
        parts.sort(key=lambda r: r.offset)
        assert [p.offset for p in parts] == np.cumsum([0, *(p.length for p in parts)])[:-1].tolist()
        assert sum(p.length for p in parts) == parts[0].sequence_length <= 1024
    assert sorted(len(t) for *_, t in texts) == sorted(n for p in whole.values() for n in [r.doc_tokens for r in p if r.start == 0])
    single = {k: t for *k, t in map(lambda x: (*x[:2], x[2]), texts) for k in [tuple(k)]}
    for key, parts in whole.items():
        if sum(1 for *k, _ in texts if tuple(k) == key) == 1:
            parts.sort(key=lambda r: r.start)
            ids = np.frombuffer(b"".join(bytes(p.ids) for p in parts), "<u4").tolist()
            assert ids == single[key]
    digests = packing.digest(packing.pack_documents(edge.frame(spark))).collect()
    nine = next(r for r in digests if r.doc_id == 9)
    assert nine.ids_crc32 == zlib.crc32(np.array(plain(tok, "one"), "<u4").tobytes())
    assert packing.pack_documents(edge.empty(spark)).count() == 0
