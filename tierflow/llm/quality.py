"""Quality score (operator 10) by positive-unlabelled learning.

Trusted positives are the training rows labelled 1; everything in the table
counts as unlabelled web text. No negative label is used. A linear logit f is
fitted to the risk

    R(f) = p * E_pos[l(f)] + max(0, E_all[l(-f)] - p * E_pos[l(-f)]) + penalty

with the logistic loss l and the share p of positives. As l(f) - l(-f) = -f,
the part inside is convex in the weights, so Newton steps with a line search
on R reach its minimum; where the second term would fall below zero a step is
shortened, which is what keeps a model from paying for positives among the
unlabelled. Each step needs only sums over the rows (gradient, Hessian, risk),
which Spark adds up over all rows; the driver sees sums of a fixed size.

p is estimated from the data: a first fit ranks the rows, and p is the ratio of
the two tails of the score, share of all rows above t / share of positives
above t, at the threshold t where the upper confidence bound of that ratio is
least (so a short tail, whose ratio may be low by chance, is not preferred).

Features describe the form of a text (how often one class of character follows
another, repeated lines and words, lengths), so they are alike in all
languages. Scores are logistic of f; empty and null texts have a feature vector
too (all zero but one). Labels, language, source and id are never inputs.

Repeated rows count as often as they occur and get equal scores; ties cannot
arise. An empty table gives an empty result. Without a trusted positive nothing
can be learned and every score is 0. Only id and text are read, so other
columns may have any name.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm.common import arrow_map, code_points, held_out, staged, table, text_blocks

BLOCK_CHARS = 200_000
THRESHOLD = 0.3
PENALTY = 1e-3
STEPS = 8
BINS = 400
#: Chance that a tail's share is further off than the bound that chooses the threshold.
DOUBT = 0.1

# Classes of characters; index 0 is everything that no other class holds.
CLASSES = ("lower", "upper", "digit", "blank", "\n", ".,;:", "!?", "|", "%&$#*@^~", "\"'()[]{}<>", "-_/\\=+")
K = len(CLASSES) + 1
EXTRA = 8
WIDTH = K * K + EXTRA + 1


@functools.lru_cache(maxsize=1)
def char_kinds() -> np.ndarray:
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x3000):
        s = chr(c)
        if s.islower():
            out[c] = 1
        elif s.isupper():
            out[c] = 2
        elif s.isdigit():
            out[c] = 3
        elif s.isspace():
            out[c] = 4
    for i, members in enumerate(CLASSES[4:], 5):
        for s in members:
            out[ord(s)] = i
    return out


def features(texts: list[str]) -> np.ndarray:
    """One row of WIDTH numbers for each text; the last is always 1."""
    n = len(texts)
    points, starts, sizes = code_points(texts)
    kind = char_kinds()[points].astype(np.int64)
    owner = np.repeat(np.arange(n), sizes + 1)
    inside = owner[1:] == owner[:-1]
    cell = (owner[:-1] * K + kind[:-1]) * K + kind[1:]
    pairs = np.bincount(cell[inside], minlength=n * K * K).reshape(n, K * K)
    out = np.zeros((n, WIDTH))
    out[:, :K * K] = np.sqrt(pairs / np.maximum(1, sizes)[:, None])
    for i, t in enumerate(texts):
        words = t.split()
        lines = [x for x in t.split("\n") if x]
        k = K * K
        if words:
            out[i, k] = np.log1p(len(words)) / 10
            out[i, k + 1] = min(1.0, len(t) / len(words) / 20)
            out[i, k + 2] = len(set(words)) / len(words)
            out[i, k + 3] = sum(a == b for a, b in zip(words, words[1:])) / len(words)
        if lines:
            out[i, k + 4] = len(set(lines)) / len(lines)
            out[i, k + 5] = np.log1p(len(lines)) / 10
            out[i, k + 6] = min(1.0, len(t) / len(lines) / 1000)
        out[i, k + 7] = not t
    out[:, -1] = 1.0
    return out


def feature_table(docs: DataFrame) -> DataFrame:
    """(doc_id, x): features of every whole text as packed 16-bit floats."""

    def run(batches):
        for ids, texts in text_blocks(batches, BLOCK_CHARS):
            packed = [row.tobytes() for row in features(texts).astype("<f2")]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(packed, pa.binary())], names=["doc_id", "x"])

    return arrow_map(docs.select(F.col("doc_id").cast("long"), "text"), run, "doc_id long, x binary")


def unpack(column) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, "<f2").reshape(-1, WIDTH).astype(np.float64)


def summed(rows: DataFrame, run, size: int) -> np.ndarray:
    """Sum over tasks of the vector that ``run`` returns for each; added up by Spark, entry by entry."""

    def entries(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += run(batch)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["i", "v"])

    got = arrow_map(rows, entries, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros(size)
    out[np.array(got.column("i"), np.int64)] = np.array(got.column("v"))
    return out


def log1pexp(z):
    return np.logaddexp(0, z)


def moments(rows: DataFrame) -> np.ndarray:
    """For positives and for all rows: count, sum and sum of squares of the features."""

    def run(batch):
        x, pos = unpack(batch.column(0)), np.array(batch.column(1).to_pylist(), bool)
        out = []
        for part in (x[pos], x):
            out += [[len(part)], part.sum(0), (part ** 2).sum(0)]
        return np.concatenate(out)

    return summed(rows, run, 2 * (1 + 2 * WIDTH))


def risk_sums(rows: DataFrame, tries: list[np.ndarray], at: np.ndarray | None, scale) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Loss sums of each weight vector in ``tries``; gradient and Hessian of the unlabelled loss at ``at``."""
    center, width = scale
    upper = np.triu_indices(WIDTH)
    size = 3 * len(tries) + (WIDTH + len(upper[0]) if at is not None else 0)

    def run(batch):
        x = (unpack(batch.column(0)) - center) * width
        pos = np.array(batch.column(1).to_pylist(), bool)
        out = []
        for w in tries:
            z = x @ w
            out += [log1pexp(-z[pos]).sum(), log1pexp(z[pos]).sum(), log1pexp(z).sum()]
        if at is not None:
            s = 1 / (1 + np.exp(-np.clip(x @ at, -500, 500)))
            out = np.concatenate([out, s @ x, ((x * (s * (1 - s))[:, None]).T @ x)[upper]])
        return np.asarray(out)

    got = summed(rows, run, size)
    losses = got[:3 * len(tries)].reshape(-1, 3)
    if at is None:
        return losses, np.empty(0), np.empty((0, 0))
    rest = got[3 * len(tries):]
    hessian = np.zeros((WIDTH, WIDTH))
    hessian[upper] = rest[WIDTH:]
    return losses, rest[:WIDTH], hessian + np.triu(hessian, 1).T


def minimise(rows: DataFrame, prior: float, scale, sums: np.ndarray, steps: int) -> np.ndarray:
    """Weights (on scaled features) of least non-negative risk."""
    n_pos, n_all = sums[0], sums[1 + 2 * WIDTH]
    center, width = scale
    mean_pos = (sums[1:1 + WIDTH] / n_pos - center) * width
    penalty = np.full(WIDTH, PENALTY)
    penalty[-1] = 0.0

    def risk(losses, w):
        pos, pos_as_neg, every = losses[0] / n_pos, losses[1] / n_pos, losses[2] / n_all
        return prior * pos + max(0.0, every - prior * pos_as_neg) + 0.5 * (penalty * w * w).sum()

    w = np.zeros(WIDTH)
    w[-1] = np.log(prior / (1 - prior))
    step, best = np.zeros(WIDTH), None
    for _ in range(steps):
        lengths = (1.0, 0.5, 0.2, 0.05)
        if best is not None:
            tries = [w + k * step for k in lengths]
            losses, _, _ = risk_sums(rows, tries, None, scale)
            risks = [risk(x, t) for x, t in zip(losses, tries)]
            k = int(np.argmin(risks))
            if risks[k] >= best - 1e-6:
                break
            w = tries[k]
        losses, grad, hessian = risk_sums(rows, [w], w, scale)
        best = risk(losses[0], w)
        slope = grad / n_all - prior * mean_pos + penalty * w
        step = -np.linalg.solve(hessian / n_all + np.diag(penalty + 1e-9), slope)
    return w


class Model:
    def __init__(self, weights, scale, prior):
        self.weights, self.scale, self.prior = weights, scale, prior

    def logit(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), -np.inf)
        return ((x - self.scale[0]) * self.scale[1]) @ self.weights


def tail_prior(rows: DataFrame, model: Model) -> float:
    """Ratio of the tails of the score where its bound is least: an estimate of the share of positives."""

    def run(batch):
        score = 1 / (1 + np.exp(-np.clip(model.logit(unpack(batch.column(0))), -500, 500)))
        at = np.minimum((score * BINS).astype(np.int64), BINS - 1)
        pos = np.array(batch.column(1).to_pylist(), bool)
        return np.concatenate([np.bincount(at[pos], minlength=BINS), np.bincount(at, minlength=BINS)]).astype(float)

    got = summed(rows, run, 2 * BINS)
    n_pos, n_all = got[:BINS].sum(), got[BINS:].sum()
    pos, every = (np.cumsum(x[::-1])[::-1] / max(1.0, x.sum()) for x in (got[:BINS], got[BINS:]))
    some = pos > 0
    pos, every = pos[some], every[some]
    margin = np.sqrt(np.log(4 / DOUBT) / 2) * (n_pos ** -0.5 + n_all ** -0.5)
    at = int(np.argmin((every + margin) / pos))
    return float(np.clip(every[at] / pos[at], 0.01, 0.99))


def fit(rows: DataFrame) -> Model:
    """``rows``: (x, trusted), written to the shared folder before."""
    sums = moments(rows)
    n_pos, n_all = sums[0], sums[1 + 2 * WIDTH]
    if not n_pos:
        return Model(None, None, 0.0)
    rest = sums[2 + 2 * WIDTH:]
    center = rest[:WIDTH] / n_all
    spread = np.sqrt(np.maximum(rest[WIDTH:] / n_all - center ** 2, 0))
    width = np.where(spread > 1e-4, 1 / np.maximum(spread, 1e-4), 0.0)
    center[-1], width[-1] = 0.0, 1.0
    scale = (center, width)
    first = Model(minimise(rows, 0.5, scale, sums, STEPS // 2), scale, 0.5)
    prior = tail_prior(rows, first)
    return Model(minimise(rows, prior, scale, sums, STEPS), scale, prior)


def predictions(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    trusted = (labels.filter((F.col("quality") == 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
               .select(F.col("doc_id").cast("long").alias("doc_id")).distinct().withColumn("trusted", F.lit(True)))
    rows = staged(feature_table(docs).join(trusted, "doc_id", "left")
                  .select("doc_id", "x", F.coalesce("trusted", F.lit(False)).alias("trusted")), "quality-features")
    model = fit(rows.select("x", "trusted"))

    def run(batches):
        for batch in batches:
            z = model.logit(unpack(batch.column(1))) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))))],
                                             names=["doc_id", "score"])

    scored = arrow_map(rows.select("doc_id", "x"), run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
