"""Language identification by sparse multinomial logistic regression.

Features are hashed character n-grams of one to three letters, weighted by term frequency
and inverse document frequency and scaled to length 1. Document frequencies cover all
documents. The regression is trained with follow-the-regularised-leader (proximal, per
coordinate, with an elastic net) on a bounded sample of the labelled rows and calibrated
by one temperature on a part of the sample that it has not seen.

The sample takes about ``SAMPLE_PER_LABEL`` rows of each label, by a hash of row content,
so a label with most of the rows does not enlarge it. It is the only bounded part; the
training of it is one task.

Defined results: a null text, or one without a letter, is ``und`` with score 0; so is
every text if nothing can be learnt; null labels are not learnt from; repeated rows are
judged alone; tables may be empty; extra columns are left as they are.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "und"
SLOTS = 1 << 16
SAMPLE_PER_LABEL = 1500
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
EPOCHS = 3
#: One of this many sampled rows fits the temperature instead of the weights.
HELD_FOR_TEMPERATURE = 5


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), np.bool_, 0x110000)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Slots and counts of the n-grams of a text, lower-cased, with all but letters as one separator."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(_letters()[points], points, 32)
    if len(codes) > 1:
        codes = codes[np.concatenate([[True], (codes[1:] != 32) | (codes[:-1] != 32)])]
    one = codes * np.uint32(2654435761)
    two = (one[:-1] ^ np.uint32(0x9E3779B9)) * np.uint32(2246822519) + codes[1:]
    two = two * np.uint32(2654435761)
    three = (two[:-1] ^ np.uint32(0x85EBCA6B)) * np.uint32(3266489917) + codes[2:]
    three = three * np.uint32(2654435761)
    all_slots = np.concatenate([one, two, three]) >> np.uint32(16)
    counts = np.bincount(all_slots, minlength=SLOTS)
    slots = np.flatnonzero(counts)
    return slots, counts[slots]


def weighted(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots and TF-IDF weights, the latter scaled to length 1."""
    slots, counts = gram_counts(text)
    x = (1 + np.log(counts)) * idf[slots]
    return slots, x / max(float(np.sqrt(x @ x)), 1e-12)


def document_frequencies(docs: DataFrame, text: str = "text") -> tuple[np.ndarray, int]:
    """Documents per slot and in all, over all rows; at most ``SLOTS`` + 1 sums reach the driver."""

    def count(batches):
        found, n = np.zeros(SLOTS + 1, np.int64), 0
        for batch in batches:
            for t in batch.column(0):
                found[gram_counts(t.as_py() or "")[0]] += 1
                n += 1
        found[SLOTS] = n
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(found[at], pa.int64())], names=["slot", "n"])

    rows = docs.select(text).mapInArrow(count, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    found = np.zeros(SLOTS + 1, np.int64)
    found[rows.column("slot").to_numpy()] = rows.column("n").to_numpy()
    return found[:SLOTS], int(found[SLOTS])


def inverse(frequencies: np.ndarray, n: int) -> np.ndarray:
    return (np.log((1 + n) / (1 + frequencies)) + 1).astype(np.float32)


class FollowTheLeader:
    """FTRL-proximal for a softmax over ``k`` classes."""

    def __init__(self, k: int):
        self.z, self.n = np.zeros((SLOTS + 1, k)), np.zeros((SLOTS + 1, k))  # the last row is the intercept

    def weights(self, at) -> np.ndarray:
        z = self.z[at]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2))

    def learn(self, slots: np.ndarray, x: np.ndarray, label: int) -> None:
        at, x = np.append(slots, SLOTS), np.append(x, 1.0)
        w = self.weights(at)
        gap = softmax(x @ w)
        gap[label] -= 1
        g = x[:, None] * gap
        self.z[at] += g - (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA * w
        self.n[at] += g * g


def softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log-loss, by golden section on its logarithm.

    One more text than the ``n`` given is taken to have another label, as a share of each text's
    target. Without it, texts that are all told rightly would have the temperature fall to
    its least value and every score be 1.
    """
    n, k = scores.shape
    if not n or k < 2:
        return 1.0
    target = np.full((n, k), 1 / (n + 1) / (k - 1))
    target[np.arange(n), labels] = n / (n + 1)
    loss = lambda t: -(target * np.log(softmax(scores / np.exp(t)) + 1e-300)).sum(1).mean()
    low, high, ratio = -4.0, 3.0, (5**0.5 - 1) / 2
    while high - low > 1e-3:
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def learn(texts: list[str], labels: list[int], k: int, idf: np.ndarray) -> tuple[np.ndarray, float]:
    rows = [weighted(t, idf) for t in texts]
    order = np.random.default_rng(7).permutation(len(rows))
    held = np.arange(len(rows)) % HELD_FOR_TEMPERATURE == 0
    if len(rows) < 10 * HELD_FOR_TEMPERATURE:
        held[:] = False
    model = FollowTheLeader(k)
    for _ in range(EPOCHS):
        for i in order:
            if not held[i]:
                model.learn(*rows[i], labels[i])
    w = model.weights(slice(None))
    seen = np.flatnonzero(held)
    scores = np.array([x @ w[s] + w[SLOTS] for s, x in (rows[i] for i in seen)]).reshape(len(seen), k)
    return w, fit_temperature(scores, np.array([labels[i] for i in seen], np.int64))


class Model:
    """Labels, weights (a row per slot and one for the intercept), temperature and idf."""

    def __init__(self, labels: list[str], weights: np.ndarray, temperature: float, idf: np.ndarray):
        self.labels, self.idf = labels, idf
        self.weights = (weights / temperature).astype(np.float32)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.labels or not has_letter(text):
            return UNKNOWN, 0.0
        slots, x = weighted(text, self.idf)
        p = softmax(x @ self.weights[slots] + self.weights[SLOTS])
        best = int(p.argmax())
        return self.labels[best], float(p[best])


def train(docs: DataFrame, learnable: Column, row: Column, text: str = "text", label: str = "lang") -> Model:
    """Model of ``docs``: frequencies of the rows that are ``learnable``, weights of a sample of them.

    ``row`` is what tells rows apart, for the sample and for its order.
    """
    idf = inverse(*document_frequencies(docs.where(learnable), text))
    rows = docs.where(learnable & F.col(label).isNotNull() & F.col(text).isNotNull())
    totals = rows.groupBy(label).agg(F.count("*").alias("n")).orderBy(label).collect()
    names = [r[label] for r in totals]
    if not names:
        return Model([], np.zeros((SLOTS + 1, 0)), 1.0, idf)
    share = F.lit(0.0)
    for r in totals:
        share = F.when(F.col(label) == r[label], SAMPLE_PER_LABEL / r["n"]).otherwise(share)
    draw = F.xxhash64(row, F.col(text))
    sample = rows.where(F.pmod(draw, F.lit(1 << 30)) < share * (1 << 30)).select(F.col(text), F.col(label), draw.alias("_draw"))

    def fit(batches):
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        rows.sort(key=lambda r: (r[2], r[1], r[0]))
        w, t = learn([r[0] for r in rows], [names.index(r[1]) for r in rows], len(names), idf)
        at, k = np.nonzero(w)
        columns = [pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(k, 0), pa.int32()), pa.array(np.append(w[at, k], t))]
        yield pa.RecordBatch.from_arrays(columns, names=["slot", "label", "weight"])

    found = sample.repartition(1).mapInArrow(fit, "slot int, label int, weight double").toArrow()
    slot, k, w = (found.column(c).to_numpy() for c in ("slot", "label", "weight"))
    weights = np.zeros((SLOTS + 1, len(names)))
    weights[slot[slot >= 0], k[slot >= 0]] = w[slot >= 0]
    return Model(names, weights, float(w[slot < 0][0]) if (slot < 0).any() else 1.0, idf)


def predict(text: Column, model) -> Column:
    """Struct of ``lang_pred`` and ``score``; ``model`` is a broadcast variable."""
    kind = pa.struct([("lang_pred", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("lang_pred string, score double")
    def guess(texts: pa.Array) -> pa.Array:
        own = model.value
        made = [own.predict(t.as_py()) for t in texts]
        return pa.array([{"lang_pred": a, "score": b} for a, b in made], kind)

    return guess(text)
