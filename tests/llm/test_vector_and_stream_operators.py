"""Exact top-k, neighbours, mixing, licences, pipeline and the registered queries."""

from __future__ import annotations

import random
from collections import Counter
from itertools import islice

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from realty_spark.llm import catalog, hnsw, licences, mixing, topk
from tests.llm import edge

SF = "/root/testdata/sf0.001"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x", "x") for i, v in rows],
                                 "vec_id long, embedding array<float>, score string, vec string, shard string").repartition(3)


def sample(n, dims=8, seed=0, copies=0):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dims)).astype(np.float32)
    x[1:1 + copies] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(n, None), (n + 1, []), (n + 2, [1.0] * (dims - 1) + [None]), (n + 3, [float("nan")] * dims), (n + 4, [float("inf")] * dims),
           (None, [1.0] * dims), (3, rows[3][1]), (n + 20 - n % 20, [0.0] * dims), (n + 7, [1.0] * (dims + 1))]
    return rows, rows + odd


@pytest.mark.parametrize("copies, shard", [(0, 40), (90, 8192)])
def test_top_k_is_exact(spark, copies, shard):
    rows, given = sample(150, copies=copies)
    z = {i: np.floor(64 * np.array(v, dtype=np.float64)).astype(int) for i, v in rows}
    z[160] = np.zeros(8, dtype=int)
    got = topk.top_k(vectors(spark, given), F.col("vec_id") % 20 == 0, shard_vectors=shard, block_queries=3).collect()
    want = {(q, k + 1, i, s) for q in z if q % 20 == 0
            for k, (s, i) in enumerate(sorted(((int(z[q] @ z[i]), i) for i in z if i != q), key=lambda p: (-p[0], p[1]))[:20])}
    assert {(r.query_id, r["rank"], r.vec_id, r.score) for r in got} == want


def test_top_k_stops_early_and_handles_large_numbers():
    r = np.random.default_rng(1)
    rows = np.floor(64 * r.normal(size=(5000, 2)))
    rows[17] = [900, 900]
    lists = topk.SortedLists(np.arange(5000), rows)
    read = []
    lists.down = type("Down", (np.ndarray,), {"__getitem__": lambda s, k: read.append(k) or np.asarray(s).__getitem__(k)})(
        lists.down.shape, lists.down.dtype, lists.down.tobytes())
    at, _ = lists.top(-1, np.array([64.0, 64.0]), 1)
    assert at.tolist() == [17] and max(k[1].stop for k in read if isinstance(k[1], slice) and len(k[0])) < 100
    big = topk.SortedLists(np.arange(3), np.array([[2.0 ** 27, 1], [2.0 ** 27, 2], [1, 1]]))
    assert big.top(-1, np.array([2.0 ** 30, 1.0]), 2)[1].tolist() == [2 ** 57 + 2, 2 ** 57 + 1]


def test_top_k_of_few_rows(spark):
    assert topk.top_k(vectors(spark, []), F.col("vec_id") % 20 == 0).count() == 0
    got = topk.top_k(vectors(spark, [(0, [1.0]), (1, [1.0]), (2, [0.5])]), F.col("vec_id") % 20 == 0).collect()
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(got, key=lambda r: r["rank"])] == [(1, 1, 4096), (2, 2, 2048)]


@pytest.mark.parametrize("copies", [0, 400])
def test_neighbours_recall(spark, copies):
    rows, given = sample(1500, dims=16, seed=2, copies=copies)
    x = np.array([v for _, v in rows], dtype=np.float64)
    got = hnsw.nearest_neighbours(vectors(spark, given), F.col("vec_id") % 20 == 0, shard_vectors=400).collect()
    by = {}
    for r in got:
        by.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert set(by) == set(range(0, 1500, 20))
    hits = 0
    for q, found in by.items():
        s = x @ x[q]
        s[q] = -np.inf
        found.sort()
        assert [f[0] for f in found] == list(range(1, 21)) and q not in {f[1] for f in found}
        assert np.allclose([f[2] for f in found], s[[f[1] for f in found]], rtol=0, atol=1e-12)
        want = np.lexsort((np.arange(len(s)), -s))[:20]
        hits += len({f[1] for f in found} & set(want.tolist()))
    assert hits / (20 * len(by)) >= 0.95
    assert hnsw.nearest_neighbours(vectors(spark, []), F.col("vec_id") % 20 == 0).count() == 0


def test_graph_is_navigable_when_lengths_differ():
    r = np.random.default_rng(5)
    x = r.normal(size=(1200, 12)) * r.uniform(0.1, 4, size=(1200, 1))
    g = hnsw.Graph.load(hnsw.Graph.build(np.arange(1200), x).dump())
    beams, hits = g.search(x[:100].astype(np.float32), 128), 0
    for q, nodes in enumerate(beams):
        ids, _ = g.nearest(q, x[q], nodes, 20)
        s = x @ x[q]
        s[q] = -np.inf
        hits += len(set(ids.tolist()) & set(np.argsort(-s)[:20].tolist()))
    assert hits >= 0.95 * 2000


def test_schedule_stays_within_a_block():
    for weights in ({"a": 1.0}, {"a": 5.0, "b": 3.0, "c": 1.0}, {f"s{i}": 1.0 + i % 7 for i in range(50)}):
        slots, period = mixing.quotas(weights, 1000)
        plan = mixing.schedule(slots, period)
        assert sum(slots.values()) == period and [p[4] for p in plan] == list(range(period))
        had = Counter()
        for name, j, release, deadline, t in plan:
            assert release <= t < deadline and j == had[name]
            had[name] += 1
            assert all(abs(had[n] - (t + 1) * slots[n] / period) < 1 for n in slots)


def furthest(weights, slots):
    """Greatest deviation, in blocks, of what a source has had from its target after any number of slots."""
    w, worst = np.array([weights[n] for n in sorted(weights)]), 0.0
    w, at, counts = w / w.sum(), {n: k for k, n in enumerate(sorted(weights))}, np.zeros(len(weights))
    for t, name in enumerate(slots):
        counts[at[name]] += 1
        worst = max(worst, float(np.abs(counts - (t + 1) * w).max()))
    return worst


def test_stream_keeps_to_its_weights(spark):
    for weights in ({"big": 0.999, "small": 0.001}, {"half": 0.5, **{f"s{i:04d}": 0.5 / 999 for i in range(999)}}, {"a": 3 ** 0.5, "b": 7 ** 0.5, "c": 1e-3}):
        order = [p[0] for p in islice(mixing.plan(weights, dict.fromkeys(weights, 10 ** 9)), 12_000)]
        assert furthest(weights, order) < 1 + 1e-6
    rows = [(i, "small" if i % 2000 == 7 else "big") for i in range(8000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string"), weights={"big": 0.999, "small": 0.001}, block_docs=1).collect()
    assert sorted(g.slot for g in got if g.source == "small") == [pytest.approx(1000 * k + 500, abs=500) for k in range(4)]


def test_sources_without_weight_come_last():
    got = list(mixing.plan({"a": 1.0, "none": 0.0, "b": 3.0, "nil": 0}, {"a": 2, "b": 1, "none": 2, "nil": 1}))
    assert [(p[0], p[1]) for p in got] == [("b", 0), ("a", 0), ("a", 1), ("nil", 0), ("none", 0), ("none", 1)]
    assert all(r <= t < d for _, _, r, d, t in got) and len({p[4] for p in got}) == 6
    assert list(mixing.plan({}, {})) == []


def test_mixing_takes_any_number_of_sources(spark):
    got = mixing.mix(spark.range(10_050).selectExpr("id as doc_id", "cast(id as string) as source"))
    assert sorted(r.position for r in got.select("position").collect()) == list(range(10_050))


def test_mixing_places_every_row(spark):
    r = random.Random(1)
    rows = [(i, "t", "en", r.choice(["big"] * 6 + ["mid"] * 2 + ["small", None, ""]), 1, *("x",) * 17) for i in range(700)]
    rows += rows[:2]
    got = mixing.mix(spark.createDataFrame(rows, edge.SCHEMA).repartition(5), payload=["doc_id", "key"], block_docs=4, period=60).collect()
    got.sort(key=lambda g: g.position)
    assert [g.position for g in got] == list(range(702)) and Counter(g.doc_id for g in got) == Counter(x[0] for x in rows)
    assert all(g["row"]["doc_id"] == g.doc_id and g["row"]["key"] == "x" for g in got)
    by = {}
    for g in got:
        assert g.release <= g.slot < g.deadline
        by.setdefault(g.source, []).append(g)
    for own in by.values():
        assert [g.doc_id for g in own] == sorted(g.doc_id for g in own)
        assert [g.block for g in own] == [k // 4 for k in range(len(own))]
    assert len({(g.source, g.block, g.slot) for g in got}) == len({g.slot for g in got})
    given = mixing.mix(spark.createDataFrame(rows, edge.SCHEMA), weights={"big": 1, None: 1}, block_docs=1, period=100)
    assert given.count() == 702
    assert mixing.mix(edge.empty(spark)).count() == 0
    assert mixing.mix(edge.frame(spark)).count() == len(edge.documents())


def test_mixing_ranks_numbers_not_payload(spark, monkeypatch):
    r = random.Random(4)
    rows = [(r.choice([None, *range(200)]), r.choice(["big", "big", "big", "small", None]), f"t{k}") for k in range(500)]
    ranked, joined = [], []
    number, join = mixing.number_rows, mixing.join_small
    monkeypatch.setattr(mixing, "number_rows", lambda df, *a: ranked.append(df.columns) or number(df, *a))
    monkeypatch.setattr(mixing, "join_small", lambda left, small, on, **k: joined.append(left.columns) or join(left, small, on, max_rows=3, **k))
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(4), payload=["text"], block_docs=3).collect()
    assert len(ranked) == 1 and not any("row" in c for c in ranked + joined)  # texts are sorted and joined by nothing but their number
    got.sort(key=lambda g: g.position)
    assert [g.position for g in got] == list(range(500))
    assert Counter((g.doc_id, g.source, g["row"]["text"]) for g in got) == Counter(rows)
    assert [(g.slot, g.block) for g in got] == sorted((g.slot, g.block) for g in got)
    for own in ([g for g in got if g.source == name] for name in ("big", "small", None)):
        assert [g.block for g in own] == [k // 3 for k in range(len(own))]
        assert [(g.doc_id is not None, g.doc_id or 0) for g in own] == sorted((g.doc_id is not None, g.doc_id or 0) for g in own)


def test_licences(spark):
    rows = [(1, "a/LICENSE", "Released under the MIT License."), (2, "a/x/one.py", "import os"), (3, "a/x/two.py", "# Licensed under CC BY-NC 4.0.\ncode"),
            (4, "b/three.py", "nothing"), (5, "a/x/y/COPYING.txt", "This work is licensed under the GNU General Public License, version 3.\nmore text"),
            (6, "a/x/y/z/four.py", None), (7, "a/x/y/five.py", ""), (8, None, "plain"), (9, None, "Licensed under the Apache License, Version 2.0."),
            (10, "six.py", "under the license"), (2, "a/x/one.py", "import os"), (11, "a/x/y/NOTICE", "no licence named here")]
    frame = spark.createDataFrame([(i, p, t, "x", "x") for i, p, t in rows], "id long, path string, text string, licence string, dir string")
    got = {r.id: (r.licence, r.from_dir) for r in licences.scan(frame).collect()}
    assert got == {1: ("MIT", None), 2: ("MIT", "a"), 3: ("CC-BY-NC-4.0", None), 4: (None, None), 5: ("GPL-3.0", None), 6: ("GPL-3.0", "a/x/y"),
                   7: ("GPL-3.0", "a/x/y"), 8: (None, None), 9: ("Apache-2.0", None), 10: (None, None), 11: ("GPL-3.0", "a/x/y")}
    assert licences.scan(frame).count() == len(rows)
    root = spark.createDataFrame([(1, "LICENSE", "Released under the MIT License."), (2, "p/q.py", "x")], "id long, path string, text string")
    assert {r.id: (r.licence, r.from_dir) for r in licences.scan(root).collect()} == {1: ("MIT", None), 2: ("MIT", "")}
    assert licences.scan(frame.limit(0)).count() == 0
    plan = licences.scan(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


MIT = """MIT License

Copyright (c) 2020 Somebody

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.
"""
BSD = """Copyright (c) 2020, Somebody. All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.
3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software.
"""
GPL = """/* This {work} is free software: you can redistribute it and/or modify
 * it under the terms of the GNU {kind}General Public License as published by
 * the Free Software Foundation, either version {version} of the License, or
 * (at your option) any later version.
 */
int main() {{ return 0; }}
"""
APACHE = """# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance
# with the License.  You may obtain a copy of the License at
import os
"""
CC = """Attribution-ShareAlike 4.0 International
Creative Commons Attribution-ShareAlike
4.0 International Public License
By exercising the Licensed Rights"""


def test_wrapped_notices_and_full_texts(spark):
    filler = " ".join(edge.words(600, 9))
    texts = {("m/LICENSE", MIT): "MIT", ("b/LICENSE.txt", BSD): "BSD-3-Clause", ("src/a.py", "".join(f"# {x}\n" for x in MIT.splitlines())): "MIT",
             ("src/b.py", "".join(f"// {x}\n" for x in BSD.splitlines())): "BSD-3-Clause", ("src/c.py", APACHE): "Apache-2.0",
             ("src/d.c", GPL.format(work="program", kind="", version=3)): "GPL-3.0", ("src/e.c", GPL.format(work="program", kind="", version=2)): "GPL-2.0",
             ("src/f.c", GPL.format(work="library", kind="Lesser ", version=3)): "LGPL-3.0", ("c/LICENSE", CC): "CC-BY-SA-4.0", ("src/g.txt", CC): None,
             ("g/COPYING", "GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007\n\nPreamble " + filler): "GPL-3.0",
             ("src/h.txt", filler + " " + MIT.replace("\n", " ") + filler): "MIT", ("src/i.txt", filler): None, (None, MIT): "MIT"}
    for k in range(470, 530, 7):  # over the seam of two pieces
        texts[f"src/seam{k}.txt", " ".join(edge.words(k, 9)) + "\n" + APACHE] = "Apache-2.0"
    rows = [(i, p, t) for i, (p, t) in enumerate(texts)]
    got = {r.id: r for r in licences.scan(spark.createDataFrame(rows + [(99, "m/x/y.py", "import os"), (0, "m/LICENSE", "other words")],
                                                                "id long, path string, text string")).collect()}
    assert [got[i].licence for i, *_ in rows] == list(texts.values())
    assert (got[99].licence, got[99].from_dir) == ("MIT", "m")


def test_pipeline_stages(spark, tmp_path):
    docs = edge.frame(spark)
    columns, ids = docs.columns, Counter(r[0] for r in edge.documents())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == columns
        now = Counter(r.doc_id for r in docs.select("doc_id").collect())
        if name == "language":
            assert set(ids) - set(now) == {6, 7, 8, 17}
        if name == "near_dedup":
            assert not {2, 4, 5, 13, 14} & set(now) and now[1] == now[3] == 1 and now[None] == ids[None]
        if name == "substring_dedup":
            text = {r.doc_id: r.text for r in docs.collect()}
            assert text[1].startswith("The first") and len(text[18].split()) == 60 and text[15] == dict(r[:2] for r in edge.documents())[15]
        if name == "mixing":
            assert now == ids
        ids = now
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert Counter(p.doc_id for p in pieces if p.start == 0) == ids
    empty = edge.empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_every_operator_is_registered():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert set(entry.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = catalog.QUERIES[name](spark, SF)
    got = df.collect()
    res = con.execute(catalog.ORACLE[name])
    columns = [d[0] for d in res.description]
    assert sorted(columns) == sorted(df.columns)
    assert Counter(tuple(r[c] for c in columns) for r in got) == Counter(res.fetchall())


def test_null_ids_keep_their_licence_and_bsd_has_two_kinds(spark):
    binary = "2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer.\n"
    two = BSD[:BSD.index("3. ")] + binary
    rows = [(None, "m/LICENSE", "Released under the MIT License."), (None, "m/a.py", "import os"), (None, "m/b.py", "import sys"), (3, "t/LICENSE", two),
            (4, "t/x.py", "pass"), (5, "u/LICENSE", two + BSD[BSD.index("3. "):]), (5, "u/other", "nothing here")]
    got = {(r.id, r.path): (r.licence, r.from_dir) for r in licences.scan(spark.createDataFrame(rows, "id long, path string, text string")).collect()}
    assert got == {(None, "m/LICENSE"): ("MIT", None), (None, "m/a.py"): ("MIT", "m"), (None, "m/b.py"): ("MIT", "m"), (3, "t/LICENSE"): ("BSD-2-Clause", None),
                   (4, "t/x.py"): ("BSD-2-Clause", "t"), (5, "u/LICENSE"): ("BSD-3-Clause", None), (5, "u/other"): ("BSD-3-Clause", "u")}
