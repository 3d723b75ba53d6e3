"""Language identification: averaged embeddings of hashed subwords under a
linear softmax, trained by stochastic gradient descent in numpy."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.llm import text as T
from remitlens.llm.scratch import Shipped

#: Rows of the embedding table, half for each subword length.
BUCKETS = 1 << 14
#: Documents that a language trains on, about; the bound of the sample.
PER_LANGUAGE = 600
UNKNOWN = "und"
_U64 = np.uint64


def letters() -> np.ndarray:
    """Byte map: lower-cased letters stay (all of non-ASCII), the rest is one
    space, so that marks and digits tell nothing."""
    t = T.lower_table()
    t[:128][~np.isin(np.arange(128), [*range(65, 91), *range(97, 123)])] = 0x20
    return t


def subwords(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two subwords around every letter byte: ids of three and of four bytes,
    and for each text the index of its first letter."""
    x = letters()[data]
    n = len(x)
    wide = np.full(n + 3, 0x20, np.uint32)
    wide[1 : n + 1] = x
    before, here, after, then = wide[:n].copy(), wide[1 : n + 1], wide[2 : n + 2].copy(), wide[3 : n + 3].copy()
    heads = offsets[:-1][offsets[:-1] < n]
    before[heads] = 0x20  # texts don't touch
    after[heads[heads > 0] - 1] = 0x20
    then[heads[heads > 0] - 1] = 0x20
    then[np.maximum(heads[heads > 1] - 2, 0)] = 0x20
    at = np.flatnonzero(x != 0x20)
    three = before[at] | here[at] << np.uint32(8) | after[at] << np.uint32(16)
    four = three | then[at] << np.uint32(24)
    half = BUCKETS // 2
    shift = np.uint32(32 - half.bit_length() + 1)
    a = (three * np.uint32(2654435761)) >> shift
    b = ((four ^ np.uint32(0x5BD1E995)) * np.uint32(2246822519)) >> shift
    return a.astype(np.int32), b.astype(np.int32) + half, np.searchsorted(at, offsets)


@dataclass
class Model:
    languages: list[str]
    #: embedding table times softmax weights
    scores: np.ndarray
    bias: np.ndarray
    temperature: float
    reject_below: float

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True)

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Calibrated probabilities, a row per text."""
        a, b, first = subwords(data, offsets)
        own = self.scores[a]
        own += self.scores[b]
        count = np.diff(first)
        sums = np.zeros((len(count), len(self.languages)))
        some = count > 0
        if some.any():
            sums[some] = np.add.reduceat(own, first[:-1][some], axis=0)
        return self.probabilities(sums / np.maximum(2 * count, 1)[:, None] + self.bias)


def _cross_entropy(logits: np.ndarray, truth: np.ndarray, temperature: float) -> float:
    z = logits / temperature
    z = z - z.max(axis=1, keepdims=True)
    return float((np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(z)), truth]).mean())


def train(
    rows: list[tuple[str, int, np.ndarray, np.ndarray]], dim: int = 16, epochs: int = 6, rate: float = 4.0, seed: int = 7
) -> Model | None:
    """Fit on (language, fold, subword ids, weights); fold 0 calibrates.

    The temperature minimises the cross-entropy of fold 0. Texts less certain
    than the rejection threshold are rejected: half the probability that
    one in a thousand right answers of fold 0 falls below, at most a half.
    """
    languages = sorted({r[0] for r in rows})
    if not languages:
        return None
    number = {x: i for i, x in enumerate(languages)}
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / dim, 1 / dim, (BUCKETS, dim))
    out = np.zeros((dim, len(languages)))
    bias = np.zeros(len(languages))
    fit = [r for r in rows if r[1] != 0] or rows
    steps, done = epochs * len(fit), 0
    for _ in range(epochs):
        for i in rng.permutation(len(fit)):
            language, _, ids, weights = fit[i]
            step = rate * (1 - done / steps)
            done += 1
            mean = weights @ table[ids]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[number[language]] -= 1
            back = out @ p
            out -= step * np.outer(mean, p)
            bias -= 0.01 * step * p
            table[ids] -= step * weights[:, None] * back
    model = Model(languages, (table @ out).astype(np.float32), bias, 1.0, 0.0)
    held = [r for r in rows if r[1] == 0]
    if held and len(languages) > 1:
        logits = np.array([r[3] @ model.scores[r[2]] + bias for r in held])
        truth = np.array([number[r[0]] for r in held])
        grid = np.exp(np.linspace(np.log(0.2), np.log(5), 41))
        model.temperature = float(min(grid, key=lambda t: _cross_entropy(logits, truth, t)))
        p = model.probabilities(logits)
        right = p.max(axis=1)[p.argmax(axis=1) == truth]
        model.reject_below = min(0.5, float(np.quantile(right, 0.001)) / 2) if len(right) else 0.0
    return model


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, fold, ids, weights) of whole sample texts, and of a short
    passage of each, for certainty about short texts."""
    for batch in batches:
        langs, hashes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for first, _, data, offsets in T.pieces(batch.column(2)):
            a, b, at = subwords(data, offsets)
            rows = []
            for k in range(len(offsets) - 1):
                i, j = int(at[k]), int(at[k + 1])
                if j == i:
                    continue
                h = abs(hashes[first + k])
                length = 6 + h % 60
                begin = i + (h >> 8) % max(1, j - i - length)
                for lo, hi in ((i, j), (begin, min(j, begin + length))):
                    ids, counts = np.unique(np.concatenate([a[lo:hi], b[lo:hi]]), return_counts=True)
                    rows.append((langs[first + k], h % 5, ids.astype(np.int32).tobytes(), (counts / counts.sum()).astype(np.float32).tobytes()))
            columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.int64(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "fold", "ids", "weights"])


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The parts of the model of all rows of :func:`_features`; none without rows."""
    rows = []
    for batch in batches:
        for language, fold, ids, weights in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            rows.append((language, fold, np.frombuffer(ids, np.int32), np.frombuffer(weights, np.float32).astype(float)))
    model = train(sorted(rows, key=lambda r: (r[0], r[1], r[2].tobytes())))
    if model:
        parts = [model.languages, model.scores.tobytes(), model.bias.tobytes(), model.temperature, model.reject_below]
        kinds = (pa.list_(pa.string()), pa.binary(), pa.binary(), pa.float64(), pa.float64())
        names = ["languages", "scores", "bias", "temperature", "reject_below"]
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(parts, kinds, strict=True)], names=names)


def fit(docs: DataFrame, learn: Column, per_language: int = PER_LANGUAGE) -> Model | None:
    """A model from rows (doc_id, text, lang) where ``learn`` holds.

    Every non-null lang value is learned. The sample is bounded:
    ``per_language`` documents of each language, about, by a hash of the id and
    text; rows equal in all three count once, so that no row crowds out others.
    One task trains on it; only the model comes to the driver.
    """
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("text").isNotNull())
    rows = rows.select("lang", F.xxhash64("doc_id", "text").alias("draw"), F.xxhash64(F.lit("order"), "doc_id", "text").alias("h"), "text")
    share = rows.select("lang", "h").distinct().groupBy("lang").agg((F.lit(float(per_language)) / F.count(F.lit(1))).alias("share"))
    sample = (
        rows.join(F.broadcast(share), "lang")
        .where(F.pmod("draw", F.lit(1 << 30)) / F.lit(float(1 << 30)) < F.col("share"))
        .select("lang", "h", "text")
        .dropDuplicates(["lang", "h"])
        .mapInArrow(_features, "lang string, fold long, ids binary, weights binary")
    )
    kinds = "languages array<string>, scores binary, bias binary, temperature double, reject_below double"
    for languages, scores, bias, temperature, reject_below in sample.repartition(1).mapInArrow(_trained, kinds).collect():
        table = np.frombuffer(scores, np.float32).reshape(BUCKETS, -1)
        return Model(list(languages), table, np.frombuffer(bias), temperature, reject_below)
    return None


def _predict(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        for batch in batches:
            last = batch.num_columns - 1
            for a, b, data, offsets in T.pieces(batch.column(last)):
                p = m.predict(data, offsets)
                best = p.argmax(axis=1)
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(i) for i in range(last)), pa.array(best, pa.int64()), pa.array(p.max(axis=1), pa.float64())],
                    names=[*batch.schema.names[:last], "best", "p"],
                )

    return run


def identify(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """The columns ``keep`` of ``docs``, and lang_pred, score, rejected.

    ``lang_pred`` is the likeliest learned language, or ``und`` with score 0
    where the text is null or has no letter, or no model could be learned.
    ``rejected`` marks those and texts below the calibrated threshold.
    """
    spark = docs.sparkSession
    own = docs.select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)],
        F.coalesce(F.col("text").cast("string").rlike(r"\p{L}"), F.lit(False)).alias("speaks"),
        F.col("text").cast("string").alias("text"),
    )
    names = [F.col(f"c{i}").alias(c) for i, c in enumerate(keep)]
    if model is None:
        return own.select(*names, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    kinds = [f"{f.name} {f.dataType.simpleString()}" for f in own.schema.fields[:-1]]
    scored = own.mapInArrow(_predict(Shipped(spark, model)), ", ".join([*kinds, "best long, p double"]))
    known = F.array(*[F.lit(x) for x in model.languages])
    return scored.select(
        *names,
        F.when(F.col("speaks"), F.element_at(known, (F.col("best") + 1).cast("int"))).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(F.col("speaks"), F.col("p")).otherwise(0.0).alias("score"),
        (~F.col("speaks") | (F.col("p") < model.reject_below)).alias("rejected"),
    )


def in_fold(divisor: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder; a null id does."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor == remainder, F.lit(True))


def predicted_languages(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected.

    Learns from documents whose crc32(doc_id) mod 3 is not 1, from text and
    non-null lang alone; a null id counts as held out. An empty table gives no
    rows; without learnable rows all are ``und``.
    """
    held_out = in_fold(3, 1)
    own = docs.select("doc_id", "text", "lang")
    model = fit(own, ~held_out, per_language)
    return identify(own.withColumn("held_out", held_out), model, ["doc_id", "held_out"])


def spoken_documents(docs: DataFrame) -> DataFrame:
    """The documents that language identification does not reject."""
    model = fit(docs.select("doc_id", "text", "lang"), ~in_fold(3, 1))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "text")
    return identify(packed, model, ["row"]).where(~F.col("rejected")).select("row.*")
