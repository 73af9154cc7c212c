"""Hierarchical language identification: the family first, then one-versus-one linear SVMs within the family.

A text's features are its hashed 1- to 3-grams of lower-cased letters (any
other run of characters is one space), square-rooted counts scaled to length
one.  Linear support vector machines (squared hinge) separate each pair of
families and, within a family, each pair of languages; pairwise votes are the
machines' calibrated probabilities.

The machines are fitted on at most ``PER_LANGUAGE`` labelled documents of each
language and ``SAMPLE`` in all; everything else covers all documents.

Null text, text without a letter, and any text while nothing could be learned:
``und`` with score 0.  Every input row gives one output row, also null and
repeated doc_ids.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from realty_spark.llm.common import read_table
from realty_spark.llm.sampling import bounded, fold
from realty_spark.llm.worker import tidied

UNKNOWN = "und"
DIMS = 4096
PER_LANGUAGE = 400
SAMPLE = 2000
CHUNK = 1 << 18  # characters of a long text taken at once

# Families of frequent languages, by ISO 639-1 code.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "is", "nl", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "pt", "ro"],
    "slavic": ["bg", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "baltic": ["lt", "lv"],
    "uralic": ["et", "fi", "hu"],
    "turkic": ["az", "kk", "tr", "uz"],
    "indo-aryan": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
    "iranian": ["fa", "ku", "ps"],
    "semitic": ["ar", "he"],
    "sino-tibetan": ["my", "zh"],
    "japonic": ["ja"],
    "koreanic": ["ko"],
    "austroasiatic": ["km", "vi"],
    "tai": ["lo", "th"],
    "austronesian": ["id", "ms", "tl"],
    "hellenic": ["el"],
}
_FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}
_OTHER = re.compile(r"[\W\d_]+")


def families(langs: Iterable[str]) -> dict[str, str]:
    """The family of each language.

    Languages that the table lacks are families of their own while they are
    few; k of them form families of about the cube root of k, in alphabetical
    order, so that the machines grow with k to the power 4/3 and not with its square.
    """
    unknown = sorted({v for v in langs if v not in _FAMILY_OF})
    size = max(1, int(round(len(unknown) ** (1 / 3), 9)))
    own = {v: unknown[i - i % size] for i, v in enumerate(unknown)}
    return {v: _FAMILY_OF.get(v) or own[v] for v in langs}


def has_letter(text: str) -> bool:
    """Whether a text holds a character of the categories L*."""
    return any(map(str.isalpha, text))


def features(text: str, dims: int = DIMS) -> np.ndarray:
    counts = np.zeros(dims)
    mask, before = np.uint32(dims - 1), np.zeros(0, dtype=np.uint32)
    for at in range(0, len(text), CHUNK):
        part = _OTHER.sub(" ", text[at:at + CHUNK].lower())
        if len(before) and before[-1] == 32 and part[:1] == " ":  # one run of other characters over the seam
            part = part[1:]
        c = np.concatenate([before, np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype="<u4")])
        new = len(before)  # n-grams over the seam of two chunks are counted once
        h = c * np.uint32(0x9E3779B1)
        for n in (1, 2, 3):
            if n > 1:
                h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(0x85EBCA6B) + c[n - 1:] * np.uint32(0xC2B2AE35)
            counts += np.bincount(((h ^ (h >> np.uint32(13))) & mask)[max(0, new - n + 1):], minlength=dims)
            if len(h) < 2:
                break
        before = c[-2:]
    counts = np.sqrt(counts)
    return (counts / max(np.linalg.norm(counts), 1e-12)).astype(np.float32)


class Machine:
    """A linear SVM for two classes with a probability: sigmoid of the scaled margin."""

    def __init__(self, x: np.ndarray, y: np.ndarray, steps: int = 150, c: float = 100.0):
        mean = x.mean(axis=0)
        w, b = np.zeros(x.shape[1], dtype=np.float64), 0.0
        weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
        centred = (x - mean).astype(np.float64)
        lipschitz = 1.0 / c + 2.0 * float(np.max(np.sum(centred * centred, axis=1)) + 1.0)
        vw, vb, t = w.copy(), b, 1.0
        for _ in range(steps):  # accelerated gradient steps on the squared hinge
            slack = np.maximum(0.0, 1.0 - y * (centred @ vw + vb))
            g = -2.0 * weight * slack * y
            nw = vw - (centred.T @ g + vw / c) / lipschitz
            nb = vb - g.sum() / lipschitz
            nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
            vw, vb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
            w, b, t = nw, nb, nt
        margin = np.abs(centred @ w + b)
        self.scale = 3.0 / max(1e-6, float(np.median(margin)))
        self.w, self.b = (w * self.scale).astype(np.float32), float((b - mean @ w) * self.scale)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(x @ self.w + self.b, -30, 30)))


class OneVersusOne:
    def __init__(self, x: np.ndarray, labels: np.ndarray):
        self.classes = sorted(set(labels.tolist()))
        self.machines = {}
        for i, a in enumerate(self.classes):
            for b in self.classes[i + 1:]:
                rows = (labels == a) | (labels == b)
                self.machines[a, b] = Machine(x[rows], np.where(labels[rows] == a, 1.0, -1.0))

    def shares(self, x: np.ndarray) -> np.ndarray:
        """Of each class, the mean probability of its own machines: a clear class has nearly 1, however many classes there are."""
        out = np.zeros((len(x), len(self.classes)))
        for (a, b), m in self.machines.items():
            p = m.probability(x)
            out[:, self.classes.index(a)] += p
            out[:, self.classes.index(b)] += 1 - p
        return out / (len(self.classes) - 1) if self.machines else np.ones_like(out)


class Hierarchy:
    """Family machines, and language machines within each family."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        langs = np.array(langs, dtype=object)
        named = families(langs.tolist())
        of = np.array([named[v] for v in langs], dtype=object)
        self.top = OneVersusOne(x, of)
        self.within = {f: OneVersusOne(x[of == f], langs[of == f]) for f in self.top.classes}

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        shares = self.top.shares(x)
        best = shares.argmax(axis=1)
        names, scores = [""] * len(x), np.zeros(len(x))
        groups = defaultdict(list)
        for i, f in enumerate(best.tolist()):
            groups[f].append(i)
        for f, rows in groups.items():
            inner = self.within[self.top.classes[f]]
            p = inner.shares(x[rows])
            pick = p.argmax(axis=1)
            for i, k, s in zip(rows, pick.tolist(), p.max(axis=1).tolist()):
                names[i], scores[i] = inner.classes[k], shares[i, f] * s
        return names, scores


def _columns(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"), docs[lang_col].alias("lang"))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_out: int = 2,
        folds: int = 4, per_language: int = PER_LANGUAGE, sample: int = SAMPLE) -> Hierarchy | None:
    """Fit on a bounded sample of the labelled documents outside the held-out fold; None if there are none."""
    docs = _columns(docs, id_col, text_col, lang_col)
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull()
                        & (fold(folds) != held_out))
    chosen = bounded(usable.select("doc_id", "lang"), "lang", per_language, sample).select("doc_id").distinct()
    texts = usable.join(F.broadcast(chosen), "doc_id", "left_semi").select("doc_id", "lang", "text")  # at most `sample` ids

    def run(batches):
        for batch in batches:
            rows = [(d, l, features(t).tobytes()) for d, l, t in zip(*(c.to_pylist() for c in batch.columns)) if has_letter(t)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()),
                                              pa.array([r[2] for r in rows], pa.binary())], names=["doc_id", "lang", "x"])
    rows = sorted(texts.mapInArrow(run, "doc_id long, lang string, x binary").collect())
    if not rows:
        return None
    return Hierarchy(np.stack([np.frombuffer(r.x, dtype=np.float32) for r in rows]), [r.lang for r in rows])


def classify(model: Hierarchy | None, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
    known = [] if model is None else [i for i, t in enumerate(texts) if t and has_letter(t)]
    for at in range(0, len(known), 256):
        rows = known[at:at + 256]
        got, scores[rows] = model.predict(np.stack([features(texts[i]) for i in rows]))
        for i, name in zip(rows, got):
            names[i] = name
    return names, scores


def identify(docs: DataFrame, model: Hierarchy | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row, from the whole text alone."""
    def run(batches):
        for batch in batches:
            names, scores = classify(model, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names, pa.string()), pa.array(scores)],
                                             names=["doc_id", "lang_pred", "score"])
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(
        tidied(run), "doc_id long, lang_pred string, score double")


def keep_known(docs: DataFrame, model: Hierarchy | None, text_col: str = "text") -> DataFrame:
    """The rows, unchanged, whose language is known, whatever the score; all go if nothing could be learned."""
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            names, _ = classify(model, batch.column(at).to_pylist())
            yield batch.filter(pa.array([n != UNKNOWN for n in names], pa.bool_()))
    return docs.mapInArrow(tidied(run), docs.schema)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document's whole text, learned outside the fold crc32(doc_id) mod 4 = 2."""
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs, fit(docs)).select("doc_id", (fold(4) == 2).alias("held_out"), "lang_pred", "score")
