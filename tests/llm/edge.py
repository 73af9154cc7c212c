"""Rows that every operator must take: nulls, empty and very long texts, ties, repeated rows, clashing column names."""

from __future__ import annotations

import random

CLASHING = ("component_id string, kept string, rank string, score string, row string, key string, position string, words string, "
            "class_key string, shard string, rep string, spans string, file string, start string, slot string, path string, `all` string")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING


def words(n: int, seed: int, vocabulary: int = 400) -> list[str]:
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def documents() -> list[tuple]:
    passage = " ".join(words(70, 1))
    near = words(120, 2)
    texts = [
        (1, "The first document. " + passage), (2, "Another one here. " + passage + " and more"),
        (3, " ".join(near)), (4, " ".join(near[:60] + ["changed"] + near[61:])), (5, " ".join(near).upper()),
        (6, None), (7, ""), (8, "   \n\t "), (9, "one"), (10, "two words"), (11, "ONE"),
        (12, " ".join(words(30_000, 3))), (13, passage), (14, passage), (14, passage), (None, passage), (None, None),
        (15, "Über Straße. Ça va?  nbsp  two  spaces\n\nlines"), (16, "<|endoftext|> is text"), (17, "12 + 34 = 46 !!"),
        (18, " ".join(near[:30]) + " " + passage + " " + " ".join(near[30:60])),
    ]
    clash = ("x",) * 17
    return [(i, t, [None, "en", "de", "fr"][k % 4], ["a", "b", None, ""][k % 4], None if t is None else len(t), *clash)
            for k, (i, t) in enumerate(texts)]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
