"""Document quality by positive-unlabelled learning.

Trusted positives are documents labelled 1; everything else, labelled or not,
is an unlabelled mixture. With the class prior pi, the risk

    pi * E_p[l(f)] + max(0, E_u[l(-f)] - pi * E_p[l(-f)])

needs no negatives and is kept from going negative, which is how a flexible
model would overfit. The prior is the share of ones among labelled training
documents; those labels also calibrate the scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.llm import text as T
from remitlens.llm.scratch import Shipped
from remitlens.llm.langid import in_fold

#: Bound of the sample: labelled documents, and unlabelled ones (about).
SAMPLE = 6000
CLASSES = 12


def _classes() -> np.ndarray:
    """Fixed classes of bytes: letters, digits, spaces, marks by their use."""
    t = np.full(256, 11, np.uint8)
    t[97:123], t[65:91], t[48:58], t[128:] = 0, 1, 2, 3
    for number, marks in ((4, b" \t"), (5, b"\n\r"), (6, b"."), (7, b",;:'\"-()"), (8, b"!?"), (9, b"|#*$%&@~^_=+<>"), (10, b"/\\[]{}`")):
        t[list(marks)] = number
    return t


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row per text: class pairs, words, repetition, lines, length."""
    n = len(offsets) - 1
    kind = _classes()[data].astype(np.int64)
    length = np.diff(offsets)
    owner = np.repeat(np.arange(n), length)
    single = np.bincount(owner * CLASSES + kind, minlength=n * CLASSES).reshape(n, CLASSES)
    inner = owner[1:] == owner[:-1] if len(owner) else owner
    code = (owner[1:] * CLASSES + kind[:-1]) * CLASSES + kind[1:]
    pairs = np.bincount(code[inner], minlength=n * CLASSES**2).reshape(n, -1)
    size = np.maximum(length, 1)[:, None]
    starts, ends, first = T.words(data, offsets, T.space_words())
    hashes = T.word_hashes(data, starts, ends)
    line_table = np.ones(256, bool)
    line_table[[10, 13]] = False
    line_starts, line_ends, line_first = T.words(data, offsets, line_table)
    lines = T.word_hashes(data, line_starts, line_ends)
    shape = np.zeros((n, 9))
    total = np.concatenate([[0], np.cumsum(ends - starts)])
    for i, (a, b, c, d) in enumerate(zip(first[:-1].tolist(), first[1:].tolist(), line_first[:-1].tolist(), line_first[1:].tolist(), strict=True)):
        words, own = b - a, d - c
        if not words:
            continue
        _, count = np.unique(hashes[a:b], return_counts=True)
        kinds = len(count)
        shape[i] = (
            (total[b] - total[a]) / words,
            kinds / words,
            np.log(kinds + 1) / np.log(words + 1),
            count.max() / words,
            (count[count > 1].sum() if kinds else 0) / words,
            len(np.unique(lines[c:d])) / own if own else 1.0,
            np.log1p(own),
            np.log1p(words / max(own, 1)),
            np.log1p(words),
        )
    return np.hstack([np.sqrt(single / size), np.sqrt(pairs / size), shape, np.log1p(length)[:, None]])


@dataclass
class Scorer:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -6, 6) @ self.weights + self.bias

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margin(x) + self.shift, -30, 30)))


def learn_pu(
    positive: np.ndarray, unlabelled: np.ndarray, prior: float, epochs: int = 60, batch: int = 512, rate: float = 0.01, decay: float = 1e-4, seed: int = 11
) -> Scorer:
    """Minimise the non-negative risk of a linear model with the sigmoid loss,
    by Adam on minibatches. A batch whose negative part falls below zero steps
    back along that part."""
    rng = np.random.default_rng(seed)
    both = np.vstack([positive, unlabelled])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-6
    p, u = (np.clip((x - mean) / scale, -6, 6) for x in (positive, unlabelled))
    theta = np.zeros(p.shape[1] + 1)
    theta[-1] = np.log(prior / (1 - prior))
    first, second, step = np.zeros_like(theta), np.zeros_like(theta), 0
    rounds = max(1, len(u) // batch)

    def slope_of(x: np.ndarray, sign: float) -> tuple[float, np.ndarray]:
        """Mean of the loss sigmoid(-sign * f) and its gradient."""
        loss = 1 / (1 + np.exp(np.clip(sign * (x @ theta[:-1] + theta[-1]), -30, 30)))
        g = -sign * loss * (1 - loss) / len(x)
        return float(loss.mean()), np.append(g @ x, g.sum())

    for _ in range(epochs):
        for own in np.array_split(rng.permutation(len(u)), rounds):
            chosen = p[rng.integers(0, len(p), min(len(p), batch))]
            _, right = slope_of(chosen, 1)
            taken, as_negative = slope_of(chosen, -1)
            rest, of_rest = slope_of(u[own], -1)
            negative = of_rest - prior * as_negative
            gradient = prior * right + negative if rest - prior * taken >= 0 else -negative
            gradient[:-1] += decay * theta[:-1]
            step += 1
            first = 0.9 * first + 0.1 * gradient
            second = 0.999 * second + 0.001 * gradient**2
            theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return Scorer(mean, scale, theta[:-1], float(theta[-1]), 1.0, 0.0)


def calibrate(model: Scorer, x: np.ndarray, truth: np.ndarray, rounds: int = 200) -> None:
    """Fit slope and shift of the probability to labels, by Newton steps."""
    z = model.margin(x)
    spread = float(z.std()) or 1.0
    a, b = 1.0, 0.0
    for _ in range(rounds):
        q = 1 / (1 + np.exp(-np.clip(a * z / spread + b, -30, 30)))
        w = q * (1 - q) + 1e-6
        error = q - truth
        grad = np.array([(error * z / spread).sum() + 1e-2 * a, error.sum()])
        hess = np.array([[(w * (z / spread) ** 2).sum() + 1e-2, (w * z / spread).sum()], [(w * z / spread).sum(), w.sum()]])
        move = np.linalg.solve(hess + 1e-6 * np.eye(2), grad)
        a, b = a - np.clip(move[0], -1, 1), b - np.clip(move[1], -1, 1)
    model.slope, model.shift = float(max(a, 1e-3) / spread), float(b)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a, b, data, offsets in T.pieces(batch.column(1)):
            rows = [x.astype(np.float32).tobytes() for x in features(data, offsets)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(rows, pa.binary())], names=["quality", "x"])


def _vectors(rows: list) -> np.ndarray:
    return np.array([np.frombuffer(r["x"], np.float32) for r in rows], dtype=np.float64)


def fit(docs: DataFrame, labels: DataFrame, learn: Column, sample: int = SAMPLE) -> Scorer | None:
    """A model from at most ``sample`` labelled and about as many unlabelled
    training documents, drawn by a hash of the id."""
    order = F.xxhash64(F.lit("quality"), "doc_id")
    known = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(learn)
        .groupBy("doc_id")
        .agg(F.min("quality").cast("int").alias("quality"))
        .orderBy(order, "doc_id")
        .limit(sample)
        .select(F.col("doc_id").alias("id"), "quality")
    )
    own = docs.where(learn).select("doc_id", "text")
    # at most ``sample`` rows
    marked = own.join(F.broadcast(known), F.col("doc_id") == F.col("id")).select("quality", "text").limit(2 * sample)
    marked = marked.mapInArrow(_features, "quality int, x binary").collect()
    total = own.count()
    draw = F.pmod(F.xxhash64(F.lit("unlabelled"), "doc_id", "text"), F.lit(1 << 30)) < F.lit(int(min(1.0, sample / max(total, 1)) * (1 << 30)))
    others = own.where(draw).select(F.lit(None).cast("int").alias("quality"), "text").limit(2 * sample)
    others = sorted(others.mapInArrow(_features, "quality int, x binary").collect(), key=lambda r: r["x"])
    marked = sorted(marked, key=lambda r: (r["quality"], r["x"]))
    positive = [r for r in marked if r["quality"] == 1]
    if not positive or not others:
        return None
    prior = float(np.clip(len(positive) / len(marked), 0.01, 0.99))
    model = learn_pu(_vectors(positive), _vectors(others), prior)
    calibrate(model, _vectors(marked), np.array([r["quality"] for r in marked], dtype=float))
    return model


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, data, offsets in T.pieces(batch.column(2)):
                p = model.value.score(features(data, offsets))
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(p, pa.float64())], names=["doc_id", "held_out", "score"])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Learns from documents whose crc32(doc_id) mod 5 is not 0 (a null id is held
    out); the text alone is scored, null as empty. Of several labels of a
    document the lowest counts. Without positives every score is 0.5. Other
    columns are ignored. An empty table gives no rows.
    """
    held_out = in_fold(5, 0)
    model = fit(docs.select("doc_id", "text"), labels.select("doc_id", "quality"), ~held_out, sample)
    rows = docs.select("doc_id", held_out.alias("held_out"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if model is None:
        scored = rows.select("doc_id", "held_out", F.lit(0.5).alias("score"))
    else:
        kind = rows.schema["doc_id"].dataType.simpleString()
        scored = rows.mapInArrow(_score(Shipped(docs.sparkSession, model)), f"doc_id {kind}, held_out boolean, score double")
    return scored.select("*", (F.col("score") >= threshold).cast("int").alias("predicted"))
