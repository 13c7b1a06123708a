"""Quality classifier by Bradley-Terry pairwise ranking.

A bounded sample of labelled documents (``SAMPLE`` of each label at most, the smallest hashes of
doc_id) gives preference pairs, good over bad; a document's strength is linear in its text features,
and the weights minimise the logistic loss on feature differences. The strength that cuts the labelled
population where its share of bad documents lies (a score quantile) is the threshold; a logistic curve
through it makes strengths scores. Threshold and slope are quantiles over all labelled documents that are
not held out, beyond the sample too. Features see the whole text and nothing else.

Null and empty texts are scored like any (their counts are 0); a very long text is scored as a whole (a worker
holds about 30 bytes for each of its words); equal texts have equal scores; columns named score and predicted
are replaced; an empty table has an empty result; without labels of both kinds every score
is the share of good labels (0.5 without any); labels that contradict each other for one document count
as bad; rows with a null doc_id are scored but never held out nor learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quirework.llm._common import slices, small_batches, spooled, text_buffers, word_bounds, word_hashes

#: Labelled documents learned from, of each label.
SAMPLE = 10_000
#: Preference pairs per learned document.
PAIRS = 4
RIDGE = 1e-3
#: Bins of strengths counted at a time when a quantile is looked for.
BINS = 1 << 12

_CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "space": b" \t\r\x0b\x0c",
    "line": b"\n",
    "stop": b".,;:'\"()-",
    "loud": b"!?",
    "odd": b"%$#&*|@^~=<>{}[]\\_/+`",
}
_CLASS = np.full(256, len(_CLASSES), np.uint8)  # the last: bytes beyond ASCII and control bytes
for _i, _chars in enumerate(_CLASSES.values()):
    _CLASS[np.frombuffer(_chars, np.uint8)] = _i
_K = len(_CLASSES) + 1


def features(data: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row for each text."""
    docs = len(offs) - 1
    size = np.diff(offs)
    counts = np.zeros((docs, _K))
    for lo in range(0, len(data), 1 << 20):  # a long text is counted bit by bit
        own = np.diff(np.clip(offs, lo, lo + (1 << 20)))
        some = np.flatnonzero(own)
        at = np.repeat(np.arange(len(some)), own[some]) * _K + _CLASS[data[lo : lo + (1 << 20)]]
        counts[some] += np.bincount(at, minlength=len(some) * _K).reshape(-1, _K)
    starts, ends, before = word_bounds(data, offs)
    hashes, _ = word_hashes(data, offs)
    words = np.diff(before)
    doc = np.repeat(np.arange(docs), words)
    length = (ends - starts).astype(float)
    add = lambda x: np.bincount(doc, x, minlength=docs)
    head = np.zeros(len(starts), bool)
    head[before[:-1][words > 0]] = True
    same = np.zeros(len(starts), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & ~head[1:]
    key = np.sort((doc.astype(np.uint64) << np.uint64(40)) | (hashes >> np.uint64(24)))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    distinct = np.bincount((key[new] >> np.uint64(40)).astype(np.int64), minlength=docs)
    last = _CLASS[data[ends - 1]] if len(ends) else np.zeros(0, np.uint8)
    first = _CLASS[data[starts]] if len(starts) else np.zeros(0, np.uint8)
    second = _CLASS[data[np.minimum(starts + 1, len(data) - 1)]] if len(starts) else first
    shout = add((first == 1) & (second == 1) & (length > 2))
    per_word, per_byte = 1 / np.maximum(words, 1), 1 / np.maximum(size, 1)
    share = counts * per_byte[:, None]
    ratio = np.stack([
        add(same) * per_word,
        1 - distinct * per_word,
        add(last == 7) * per_word,
        add(last == 6) * per_word,
        add(length == 1) * per_word,
        add((length == 1) & (first == 7)) * per_word,
        shout * per_word,
        add(length > 18) * per_word,
    ], axis=1)
    mean = add(length) * per_word
    plain = np.stack([np.log1p(words), mean / 10, np.sqrt(np.maximum(add(length * length) * per_word - mean * mean, 0)) / 10, counts[:, 4] * per_word, np.log1p(words) ** 2 / 10], axis=1)
    # a low share of repeats means more in a short text than in a long one
    crossed = ratio[:, :2] * np.log1p(words)[:, None]
    soft = lambda x: np.minimum(x / 0.1, 1)
    return np.concatenate([share, ratio, plain, crossed, np.sqrt(share), np.sqrt(ratio), soft(share[:, 6:8]), soft(ratio)], axis=1)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    slope: float

    def score(self, x: np.ndarray) -> np.ndarray:
        z = (self.strength(x) - self.threshold) * self.slope
        return 0.5 * (1 + np.tanh(z / 2))

    def strength(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.mean) / self.scale) @ self.weights


def constant(share: float) -> Model:
    """A model that scores every text alike."""
    p = min(max(share, 1e-9), 1 - 1e-9)
    return Model(np.zeros(1), np.ones(1), np.zeros(1), -float(np.log(p / (1 - p))), 1.0)


def rank(good: np.ndarray, bad: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mean, scale and Bradley-Terry weights from preference pairs, by Newton steps on the logistic loss."""
    both = np.concatenate([good, bad])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-6
    rng = np.random.default_rng(7)
    n = PAIRS * (len(good) + len(bad))
    x = (good[rng.integers(len(good), size=n)] - bad[rng.integers(len(bad), size=n)]) / scale
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 0.5 * (1 - np.tanh(x @ w / 2))  # the chance that the model gives the losing side
        grad = x.T @ p / n - RIDGE * w
        hess = (x * (p * (1 - p))[:, None]).T @ x / n + RIDGE * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w += step * min(1.0, 4.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return mean, scale, w


def fit(good: np.ndarray, bad: np.ndarray, n_good: int, n_bad: int) -> Model:
    """The ranking, the quantile threshold for n_good and n_bad labels in all, and the slope of the scores."""
    mean, scale, w = rank(good, bad)
    model = Model(mean, scale, w, 0.0, 1.0)
    s = np.concatenate([model.strength(bad), model.strength(good)])
    weight = np.concatenate([np.full(len(bad), n_bad / len(bad)), np.full(len(good), n_good / len(good))])
    order = np.argsort(s, kind="stable")
    share = np.cumsum(weight[order]) / weight.sum()
    at = min(int(np.searchsorted(share, n_bad / (n_good + n_bad), "right")), len(s) - 1)
    below = s[order][max(at - 1, 0)]
    model.threshold = float((below + s[order][at]) / 2)
    model.slope = 4.0 / (np.quantile(s, 0.75) - np.quantile(s, 0.25) + 1e-9)
    return model


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _vectors(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = features(*text_buffers(batch.column("text")))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), pa.array(x.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("good"), lists], ["doc_id", "good", "x"])

    return docs.select("doc_id", "good", "text").mapInArrow(run, "doc_id long, good int, x array<double>")


def strengths(docs: DataFrame, known: DataFrame, model: Model) -> DataFrame:
    """(good, s) of every document with a label in ``known``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            s = model.strength(features(*text_buffers(batch.column("text"))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s)], ["doc_id", "s"])

    # texts stay where they are: only ids and strengths meet the labels
    return spooled(docs.select("doc_id", "text").mapInArrow(run, "doc_id long, s double").join(known, "doc_id").select("good", "s"), "strengths")


def first_beyond(rows: DataFrame, target: float, weight: tuple[float, float] = (1.0, 1.0)) -> tuple[float, float]:
    """Of the sorted strengths (bad before good where equal) the first at which the weight so far exceeds ``target``, or the last, and before it the one below.

    Exact: the bin that holds it is divided again until its strengths are one."""
    low, high = rows.agg(F.min("s"), F.max("s")).first()
    below, bad, good = low, 0, 0
    while True:
        place = F.floor((F.col("s") - F.lit(low)) / F.lit(high - low) * BINS) if high > low else F.lit(0)
        inside = rows.where(F.col("s").between(low, high)).groupBy(place.alias("bin"))
        bins = inside.agg(F.count_if(F.col("good") == 0).alias("bad"), F.count_if(F.col("good") == 1).alias("good"), F.min("s").alias("low"), F.max("s").alias("high")).orderBy("bin").collect()
        so_far = np.cumsum([(b["bad"], b["good"]) for b in bins], axis=0) + (bad, good)
        at = min(int(np.searchsorted(so_far @ weight, target, "right")), len(bins) - 1)
        if at:
            below, (bad, good) = bins[at - 1]["high"], so_far[at - 1].tolist()
        low, high = bins[at]["low"], bins[at]["high"]
        if low == high:
            # the run of equal strengths: bad ones first, from the first of them or from a later one on
            head = (bad + 1, good) if bins[at]["bad"] else (bad, good + 1)
            return (below if np.dot(head, weight) > target or bins[at]["bad"] + bins[at]["good"] == 1 else low), low


def placed(model: Model, rows: DataFrame, n_good: int, n_bad: int) -> Model:
    """The model with the threshold and slope of all ``rows`` (good, s)."""
    n = {r["good"]: r["n"] for r in rows.groupBy("good").agg(F.count("*").alias("n")).collect()}
    threshold = float(np.mean(first_beyond(rows, n_bad, (n_bad / n[0], n_good / n[1]))))
    ends = []
    for q in (0.25, 0.75):
        place = (n[0] + n[1] - 1) * q
        a, b = first_beyond(rows, int(place) + 1)
        ends.append(a + (b - a) * (place - int(place)))
    return replace(model, threshold=threshold, slope=4.0 / (ends[1] - ends[0] + 1e-9))


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from the labels that are not held out."""
    small_batches(docs.sparkSession)
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.min("quality").cast("int").alias("good"))
    n = {r["good"]: r["n"] for r in known.groupBy("good").agg(F.count("*").alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return constant(1.0 if n.get(1) else 0.0 if n.get(0) else 0.5)
    order = F.xxhash64("doc_id")
    chosen = known.where("good = 1").orderBy(order, "doc_id").limit(sample).unionByName(known.where("good = 0").orderBy(order, "doc_id").limit(sample))
    # at most 2 * sample ids
    rows = _vectors(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")).orderBy("doc_id").collect()
    x = np.array([r["x"] for r in rows])
    y = np.array([r["good"] for r in rows])
    if not (y == 0).any() or not (y == 1).any():
        return constant(float(y.mean()) if len(y) else 0.5)
    model = fit(x[y == 1], x[y == 0], n[1], n[0])
    return model if max(n.values()) <= sample else placed(model, strengths(docs, known, model), n[1], n[0])


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from a score of 0.5), which replace columns of those names."""
    small_batches(docs.sparkSession)
    docs = docs.drop("score", "predicted")
    schema = docs.schema.simpleString()[len("struct<") : -1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = features(*text_buffers(batch.column(batch.schema.get_field_index("text"))))
            score = model.score(x if len(model.weights) > 1 else np.zeros((len(x), 1)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score), pa.array((score >= 0.5).astype(np.int32))], [*batch.schema.names, "score", "predicted"])

    return docs.mapInArrow(run, f"{schema}, score double, predicted int")


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
