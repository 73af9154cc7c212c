"""Document quality from a linear-chain conditional random field over lines.

Each line is good or bad.  Its features are shape measures of the line (length,
letter case, digits, punctuation, symbols, separators, repetition) and the same
measures of the lines before and after.  The field is fitted on documents whose
lines all carry the document's label; forward-backward marginals of a
document's lines, weighted by line length, are its quality.

The field is fitted on at most ``PER_LABEL`` documents of each label; scores
cover every line of every document.

Null and empty texts have one empty line and get its marginal.  With no
labelled documents, or one label alone, every score is the share of label 1
(0.5 without labels).  A document whose labels differ counts for its least
label.  Every input row gives one output row, also null and repeated doc_ids.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from realty_spark.llm.common import read_table
from realty_spark.llm.sampling import bounded, fold

PER_LABEL = 500
SEQUENCE = 64  # longer training documents become several sequences
STEPS = 200
L2 = 1e-3

_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = b"0123456789"
_STOPS = b".,;:?'\"()-"
_MARKS = b"!#$%&*+/<=>@[\\]^_`{|}~"
_BREAKS = b"|\t"
SHAPES = 12


def shapes(lines: list[bytes]) -> np.ndarray:
    """One row of measures for each line of a document."""
    out = np.zeros((len(lines), SHAPES))
    seen = Counter(lines)
    for i, line in enumerate(lines):
        n = len(line)
        if not n:
            out[i, 0] = 1.0
            continue
        words = line.split()
        m = max(1, len(words))
        upper, lower = n - len(line.translate(None, _UPPER)), n - len(line.translate(None, _LOWER))
        out[i, 1:] = (
            min(n, 2000) / 2000, upper / max(1, upper + lower), (n - len(line.translate(None, _DIGIT))) / n,
            min(1.0, (n - len(line.translate(None, _STOPS))) / m), min(1.0, (n - len(line.translate(None, _MARKS))) / m),
            min(1.0, (n - len(line.translate(None, _BREAKS))) / m), min(1.0, n / m / 20), len(set(words)) / m,
            max(Counter(words).values(), default=0) / m, 1.0 if seen[line] > 1 else 0.0, 1.0 if line.rstrip()[-1:] in b".!?" else 0.0)
    return out


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line (own, previous and next shapes, bias) and the lines' lengths."""
    lines = (text or "").encode("utf-8", "surrogatepass").split(b"\n")
    own = shapes(lines)
    edge = np.zeros((1, SHAPES))
    x = np.hstack([own, np.vstack([edge, own[:-1]]), np.vstack([own[1:], edge]), np.ones((len(lines), 1))])
    return x, np.array([len(v) + 1.0 for v in lines])


def messages(odds: np.ndarray, sizes: np.ndarray, transition: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(emit, forward, backward, log of each forward step's sum) of sequences that follow each other; messages are scaled to sum one."""
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    good = 1.0 / (1.0 + np.exp(-np.clip(odds, -30, 30)))
    emit = np.stack([1 - good, good], axis=1)
    move = np.exp(transition)
    forward, backward, scale = np.zeros_like(emit), np.ones_like(emit), np.zeros(len(emit))
    longest = int(sizes[0]) if len(sizes) else 0
    alive = np.searchsorted(-sizes, -np.arange(longest), side="left")  # sequences longer than t
    for t in range(longest):
        at = starts[:alive[t]] + t
        f = emit[at] * (forward[at - 1] @ move) if t else emit[at]
        total = f.sum(axis=1, keepdims=True)
        forward[at], scale[at] = f / total, np.log(total[:, 0])
    for t in range(longest - 2, -1, -1):
        at = starts[:alive[t + 1]] + t
        b = (emit[at + 1] * backward[at + 1]) @ move.T
        backward[at] = b / b.sum(axis=1, keepdims=True)
    return emit, forward, backward, scale


def marginals(odds: np.ndarray, sizes: np.ndarray, transition: np.ndarray) -> np.ndarray:
    """P(good) of each line.  odds: the lines' log-odds of good, sequence after sequence; sizes: lines of each sequence."""
    _, forward, backward, _ = messages(odds, sizes, transition)
    p = forward * backward
    return p[:, 1] / p.sum(axis=1)


def likelihood(odds: np.ndarray, y: np.ndarray, sizes: np.ndarray, weight: np.ndarray, transition: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """The sequences' weighted log-likelihood and its derivatives in the lines' odds and in the transition; a sequence has one weight."""
    first = np.cumsum(sizes) - sizes
    of = np.repeat(np.arange(len(sizes)), sizes)
    inner = np.setdiff1d(np.arange(len(y)), first)
    emit, forward, backward, scale = messages(odds, sizes, transition)
    p = forward * backward
    p = p / p.sum(axis=1, keepdims=True)
    pair = forward[inner - 1, :, None] * np.exp(transition) * (emit[inner] * backward[inner])[:, None, :]
    pair /= pair.sum(axis=(1, 2), keepdims=True)
    seen = np.zeros_like(pair)
    seen[np.arange(len(inner)), y[inner - 1], y[inner]] = 1
    w = weight[of]
    value = float((w * (np.log(emit[np.arange(len(y)), y]) - scale)).sum() + (w[inner] * transition[y[inner - 1], y[inner]]).sum())
    return value, w * (y - p[:, 1]), (w[inner, None, None] * (seen - pair)).sum(axis=0)


class Field:
    """Weights of good against bad for each feature, and of each move between the two labels."""

    def __init__(self, x: np.ndarray, y: np.ndarray, sizes: np.ndarray):
        self.mean, self.spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
        self.mean[-1], self.spread[-1] = 0.0, 1.0
        z = np.clip((x - self.mean) / self.spread, -8, 8)
        self.w, self.transition = np.zeros(x.shape[1]), np.zeros((2, 2))
        lines = y[np.cumsum(sizes) - sizes]  # a sequence's lines share its label
        weight = np.where(lines == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
        m, v, k = np.zeros(len(self.w) + 4), np.zeros(len(self.w) + 4), 0
        for _ in range(STEPS):  # Adam on the penalised log-likelihood
            _, by_odds, by_move = likelihood(z @ self.w, y, sizes, weight, self.transition)
            g = np.append(z.T @ by_odds / len(y) - L2 * self.w, (by_move / len(y) - 0.05 * self.transition).ravel())
            k += 1
            m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
            step = 0.1 * (m / (1 - 0.9 ** k)) / (np.sqrt(v / (1 - 0.99 ** k)) + 1e-9)
            self.w = self.w + step[:len(self.w)]
            self.transition = self.transition + step[len(self.w):].reshape(2, 2)

    def scores(self, xs: list[np.ndarray], lengths: list[np.ndarray]) -> np.ndarray:
        sizes = np.array([len(v) for v in lengths])
        z = np.clip((np.vstack(xs) - self.mean) / self.spread, -8, 8)
        p, w = marginals(z @ self.w, sizes, self.transition), np.concatenate(lengths)
        at = np.cumsum(sizes) - sizes
        return np.clip(np.add.reduceat(p * w, at) / np.add.reduceat(w, at), 0.0, 1.0)


class Constant:
    def __init__(self, value: float):
        self.value = value

    def scores(self, xs: list[np.ndarray], lengths: list[np.ndarray]) -> np.ndarray:
        return np.full(len(xs), self.value)


def fit(docs: DataFrame, labels: DataFrame, held_out: int = 1, folds: int = 3, per_label: int = PER_LABEL) -> Field | Constant:
    """Fit the field on a bounded sample of the labelled documents outside the held-out fold."""
    known = (labels.select(labels["doc_id"].cast("long").alias("doc_id"), labels["quality"].cast("int").alias("quality"))
             .where("doc_id is not null and quality in (0, 1)").where(fold(folds) != held_out)
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    texts = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"))
    present = known.join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    chosen = bounded(present, "quality", per_label, 2 * per_label)
    rows = texts.join(F.broadcast(chosen), "doc_id")  # at most 2 * per_label ids

    def run(batches):
        for batch in batches:
            xs = [line_features(t)[0].astype(np.float32) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([x.tobytes() for x in xs], pa.binary())],
                                             names=["doc_id", "quality", "x"])
    got = sorted(rows.select("doc_id", "text", "quality").mapInArrow(run, "doc_id long, quality int, x binary").collect())
    ys = [r.quality for r in got]
    if len(set(ys)) < 2:
        return Constant(float(np.mean(ys)) if ys else 0.5)
    xs = [np.frombuffer(r.x, dtype=np.float32).reshape(-1, 3 * SHAPES + 1).astype(np.float64) for r in got]
    y = np.concatenate([np.full(len(x), q) for x, q in zip(xs, ys)])
    sizes = [min(SEQUENCE, len(x) - a) for x in xs for a in range(0, len(x), SEQUENCE)]
    return Field(np.vstack(xs), y, np.array(sizes))


def score_quality(docs: DataFrame, model: Field | Constant, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row, from all lines of its text alone."""
    def run(batches):
        for batch in batches:
            texts, scores = batch.column(1).to_pylist(), []
            for at in range(0, len(texts), 512):
                xs, lengths = zip(*(line_features(t) for t in texts[at:at + 512]))
                scores.extend(model.scores(list(xs), list(lengths)).tolist())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores, pa.float64())], names=["doc_id", "score"])
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(
        run, "doc_id long, score double")


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document's whole text, learned outside the fold crc32(doc_id) mod 3 = 1."""
    docs = read_table(spark, sf_dir, "documents")
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    return score_quality(docs, model).select("doc_id", (fold(3) == 1).alias("held_out"), "score",
                                             (F.col("score") >= 0.5).cast("int").alias("predicted"))
