"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled rows of quality 1, the unlabelled text is that of all rows to learn from; labels of quality 0 are not
used. The risk is the non-negative one with squared loss on fixed random features of measurements of the text. That loss needs of the
rows no more than second moments, which tasks sum and send as one matrix each, so the machine learns from all rows in two passes
without a sample, and the descent runs on matrices of a fixed size.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import crc, mapped, small_batches, small_enough, stored, texts

#: Groups of ASCII characters; the share of each is a measurement.
GROUPS = ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " ", "\n", "\t\r", ".", ",;:", "!?", "'\"", "()[]{}", "#*$%&", "|", "<>=+~^_`", "@/\\", "-")
#: Random features of the machine, the ridge on their weights, and what a feature adds to it over the number of trusted positives.
HIDDEN, RIDGE, RIDGE_PER_FEATURE = 16, 0.01, 0.5
#: How steep the score is in the machine's value, which is near 1 for clear positives and near -1 for clear negatives.
STEEPNESS = 3.0
_GROUP_OF = np.full(256, len(GROUPS) + 1)
_GROUP_OF[128:192] = len(GROUPS) + 2  # bytes within a character
_GROUP_OF[192:] = len(GROUPS)
for _i, _chars in enumerate(GROUPS):
    _GROUP_OF[list(_chars.encode())] = _i


def measured(text: bytes) -> np.ndarray:
    """Shares of character groups, of repeats among words, pairs of words and lines, and of words of certain forms; sizes as logarithms."""
    groups = np.bincount(_GROUP_OF, np.bincount(np.frombuffer(text, "u1"), minlength=256), len(GROUPS) + 3)
    chars = max(1.0, groups[:-1].sum())
    words = text.split()
    n = max(1, len(words))
    counts = Counter(words)
    sizes = np.fromiter(map(len, words), "f8", len(words)) if words else np.zeros(1)
    pairs = len(set(zip(words, words[1:])))
    same = sum(map(bytes.__eq__, words, words[1:]))
    forms = sum(m for w, m in counts.items() if w.isupper()), sum(m for w, m in counts.items() if not w[-1:].isalnum() and w[-1] < 128), sum(m for w, m in counts.items() if w.istitle())
    plain = sum(m for w, m in counts.items() if w.isalpha() or w[0] > 127)
    lines = [x for x in text.split(b"\n") if x.strip()]
    k = max(1, len(lines))
    ended = sum(x.rstrip()[-1:] in b".!?" for x in lines)
    more = [
        math.log1p(len(words)), math.log1p(len(lines)), math.log1p(len(words) / k), sizes.mean(), sizes.std(), min(sizes.max(), 100.0) / 10, (sizes <= 3).mean(), (sizes >= 12).mean(),
        len(counts) / n, math.log(len(counts) + 1) / math.log(n + 1.5), max(counts.values(), default=0) / n, pairs / n, same / n, forms[0] / n, forms[1] / n, forms[2] / n, plain / n,
        len(set(lines)) / k, ended / k, float(not words),
    ]
    return np.concatenate([groups / chars, more])


INPUTS = len(measured(b""))


def expanded(x: np.ndarray, mean: np.ndarray, sd: np.ndarray, hidden: int = HIDDEN) -> np.ndarray:
    """1, the standardised measurements, and saturated random mixtures of them; the mixtures are the same at every call."""
    z = np.clip((x - mean) / sd, -6, 6)
    rng = np.random.default_rng(13)
    mix, shift = rng.normal(size=(x.shape[1], hidden)) * (1.2 / math.sqrt(x.shape[1])), rng.normal(size=hidden)
    return np.hstack([np.ones((len(x), 1)), z, np.tanh(z @ mix + shift)])


class Moments:
    """Second moments of the unlabelled and the positive rows: all that the squared loss needs of them."""

    def __init__(self, unlabelled: np.ndarray, positive: np.ndarray, prior: float, ridge: float = 0.0):
        """Both as sums of outer products of features that start with 1."""
        self.prior, self.ridge = prior, np.diag([0.0, *[ridge] * (len(unlabelled) - 1)])
        self.u, self.p = unlabelled / unlabelled[0, 0], positive / positive[0, 0]

    def loss(self, w: np.ndarray, moments: np.ndarray, side: int) -> float:
        """Mean of (1 - side * value)^2 / 4."""
        return float(1 - 2 * side * moments[0] @ w + w @ moments @ w) / 4

    def negative_part(self, w: np.ndarray) -> float:
        """The risk of the negatives, as that of the unlabelled without the positives among them; below 0 it is overfitted."""
        return self.loss(w, self.u, -1) - self.prior * self.loss(w, self.p, -1)

    def risk(self, w: np.ndarray) -> float:
        return self.prior * self.loss(w, self.p, 1) + max(0.0, self.negative_part(w)) + float(w @ self.ridge @ w) / 4

    def minimise(self, steps: int = 400) -> np.ndarray:
        """Weights of the least non-negative risk.

        Without the bound the risk is a quadratic, solved at once; if its negatives cost 0 or more there, it is the answer. Else steps
        follow: down the whole risk where the bound does not bind, down the positives' and up the negatives' part where it does.
        """
        scale = np.linalg.inv(self.u + self.ridge + 1e-9 * np.eye(len(self.u)))
        w = scale @ (2 * self.prior * self.p[0] - self.u[0])
        if self.negative_part(w) >= 0:
            return w
        best = w
        for t in range(steps):
            below = self.negative_part(w) < 0
            up = (self.u[0] + self.u @ w - self.prior * (self.p[0] + self.p @ w)) * (-1 if below else 1)
            down = 0.0 if below else self.prior * (self.p @ w - self.p[0]) + self.ridge @ w
            w = w - scale @ (down + up) * (0.5 / math.sqrt(1 + t))
            best = min(best, w, key=self.risk)
        return best


def prior_bound(unlabelled: np.ndarray, positive: np.ndarray, ridge: float) -> float:
    """The largest share of positives that leaves second moments which a set of negatives can have."""
    u, p = (m / m[0, 0] + ridge * np.eye(len(m)) for m in (unlabelled, positive))
    half = np.linalg.inv(np.linalg.cholesky(p))
    return float(np.clip(np.linalg.eigvalsh(half @ u @ half.T)[0], 0.01, 0.99))


def _rows(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("x").flatten().to_numpy().reshape(-1, INPUTS)


def _summed(rows: DataFrame, features: Callable[[np.ndarray], np.ndarray], parts: int = 16) -> tuple[np.ndarray, np.ndarray, int]:
    """Sums of outer products of the features, over all rows and over those of quality 1, and the number of those of quality 0.

    Each task sends one matrix; a few tasks add them as they come, in a fixed order.
    """
    kind = "part long, u binary, p binary, n long"
    schema = pa.schema([("part", pa.int64()), ("u", pa.binary()), ("p", pa.binary()), ("n", pa.int64())])

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u = p = n = 0
        for batch in batches:
            if batch.num_rows:
                f, quality = features(_rows(batch)), batch.column("quality").fill_null(-1).to_numpy(zero_copy_only=False)
                good = f[quality == 1]
                u, p, n = u + f.T @ f, p + good.T @ good, n + int((quality == 0).sum())
        if np.ndim(u):
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "u": [u.tobytes()], "p": [p.tobytes()], "n": [n]}, schema=schema)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u = p = n = 0
        for batch in batches:
            for a, b, c in zip(*(batch.column(x).to_pylist() for x in ("u", "p", "n"))):
                u, p, n = u + np.frombuffer(a), p + np.frombuffer(b), n + c
        if np.ndim(u):
            yield pa.RecordBatch.from_pydict({"part": [0], "u": [u.tobytes()], "p": [p.tobytes()], "n": [n]}, schema=schema)

    found = rows.mapInArrow(sums, kind).repartition(parts, "part").sortWithinPartitions("part").mapInArrow(add, kind).collect()
    if not found:
        return np.zeros((1, 1)), np.zeros((1, 1)), 0
    u, p = (np.sum([np.frombuffer(r[i]) for r in found], axis=0) for i in (1, 2))
    size = math.isqrt(len(u))
    return u.reshape(size, size), p.reshape(size, size), sum(r[3] for r in found)


class Machine:
    """Feature scales and weights, ready to score rows of measurements."""

    def __init__(self, mean: np.ndarray, sd: np.ndarray, weights: np.ndarray | None = None):
        self.mean, self.sd, self.weights = mean, sd, weights

    def features(self, x: np.ndarray) -> np.ndarray:
        return expanded(x, self.mean, self.sd)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.full(len(x), 0.5)
        return 1 / (1 + np.exp(-STEEPNESS * np.clip(self.features(x) @ self.weights, -9, 9)))


def fit(rows: DataFrame, labels: DataFrame, prior: float | None = None) -> Machine:
    """A machine from all rows of (doc_id, x) and those of them that (doc_id, quality) marks with 1.

    The class prior is the share of 1 among the labelled rows; with no 0 among them, or on request, another one.
    """
    with_one = lambda x: np.hstack([np.ones((len(x), 1)), x])
    sums, _, _ = _summed(rows.select("x", F.lit(None).cast("int").alias("quality")), with_one)
    if not sums[0, 0]:
        return Machine(np.zeros(INPUTS), np.ones(INPUTS))
    mean = sums[0, 1:] / sums[0, 0]
    sd = np.sqrt(np.maximum(0, np.diag(sums)[1:] / sums[0, 0] - mean**2))
    machine = Machine(mean, np.where(sd < 1e-6, 1.0, sd))
    marks = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    u, p, zeros = _summed(rows.join(small_enough(marks, 24), "doc_id", "left").select("x", "quality"), machine.features)
    ones = p[0, 0]
    if ones:
        ridge = RIDGE + RIDGE_PER_FEATURE * len(u) / ones
        prior = prior or (min(0.99, ones / (ones + zeros)) if zeros else prior_bound(u, p, ridge))
        machine.weights = Moments(u, p, prior, ridge).minimise()
    return machine


def score_quality(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document, from rows whose crc32 of doc_id is not 1 modulo 3.

    Null and empty texts are scored by their measurements as any other; whole texts of any length are read. A null doc_id has the
    checksum of the empty text and no label; repeated rows are learned from and scored each; an id with labels of both kinds is no
    positive; null labels do not count. Without any positive all scores are 0.5. Other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    id_field = docs.select("doc_id").limit(0).toArrow().schema.field(0)
    schema = pa.schema([id_field, ("held_out", pa.bool_()), ("x", pa.list_(pa.float64()))])

    def measure(batch: pa.RecordBatch) -> dict:
        found = np.concatenate([measured(t) for t in texts(batch)])
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "x": pa.ListArray.from_arrays(np.arange(0, len(found) + 1, INPUTS, "i4"), found)}

    held = docs.select("doc_id", (F.pmod(crc(F.col("doc_id")), F.lit(3)) == 1).alias("held_out"), "text")
    with small_batches(docs.sparkSession):
        rows = stored(held.mapInArrow(mapped(measure, schema), f"doc_id {kind}, held_out boolean, x array<double>"), "measurements")
    machine = fit(rows.where(~F.col("held_out")), labels.select("doc_id", "quality"), prior)
    scored = pa.schema([id_field, ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())])

    def score(batch: pa.RecordBatch) -> dict:
        found = machine.scores(_rows(batch))
        return {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "score": found, "predicted": (found >= 0.5).astype("i4")}

    return rows.mapInArrow(mapped(score, scored, 10_000), f"doc_id {kind}, held_out boolean, score double, predicted int")
