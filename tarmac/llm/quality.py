"""Quality classifier: supervised subword embeddings, averaged per document, with a softmax.

The features of a text are its words, its pairs of neighbouring words (a word said twice in a
row is one feature of its own) and its n-grams of 3 to 5 characters, hashed into ``BUCKETS`` vectors.
Their mean goes through a linear layer and a softmax; vectors and layer are learned together by
numpy stochastic gradient descent on a bounded sample of labelled rows of each class. The sample
holds the classes in equal parts, so the bias is set back to the shares of all labelled rows.
As the layer is linear, a feature's vector and the layer collapse to one number for scoring. A
step of the vectors is the gradient of the row's log loss times the number of the row's features,
so that long texts teach as much as short ones; a feature's part of it is cut at four times the mean.

Nulls and edge cases: a null or empty text has no features and scores the bias alone; rows with
no label or a null one teach nothing, nor does a document whose labels contradict each other;
with no labels every score is 0.5; of a repeated id one row enters the fit, and repeated rows
are scored alike; no row is moved or dropped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import annotate, remainder

BUCKETS = 1 << 16
DIMENSION = 12
NGRAMS = (3, 4, 5)
SAMPLE_PER_CLASS = 1_500  # expected rows of a class in the fitting sample; the bound of the fit
EPOCHS, RATE = 5, 0.5
TEXT_AT_ONCE = 1 << 20

_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_PRIME = np.uint64(0x100000001B3)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return ((x >> np.uint64(40)) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _slices(text: str) -> Iterator[str]:
    """Parts of at most TEXT_AT_ONCE characters, cut at white space where there is some."""
    at = 0
    while at < len(text):
        stop = min(len(text), at + TEXT_AT_ONCE)
        if stop < len(text):
            cut = max(text.rfind(" ", at, stop), text.rfind("\n", at, stop))
            stop = cut + 1 if cut > at else stop
        yield text[at:stop]
        at = stop


def features(text: str | None) -> Iterator[np.ndarray]:
    """Bucket numbers of the text's features, in parts of bounded size."""
    for part in _slices(text or ""):
        data = np.frombuffer(f" {part} ".encode("utf-32-le", "surrogatepass"), "<u4")
        wide = data.astype(np.uint64) + np.uint64(1)
        for n in NGRAMS:
            if len(wide) >= n:
                mixed = np.full(len(wide) - n + 1, n, np.uint64)
                for i in range(n):
                    mixed = mixed * _PRIME + wide[i : len(wide) - n + 1 + i]
                yield _mix(mixed)
        white = _WHITE[np.minimum(data, len(_WHITE) - 1)]
        begin = np.flatnonzero(white[:-1] & ~white[1:]) + 1
        end = np.flatnonzero(~white[:-1] & white[1:]) + 1
        if len(begin):
            # A word's hash is the sum of its characters' mixed codes by place, from running sums.
            place = np.arange(len(data), dtype=np.int64) - np.repeat(np.append(0, begin), np.diff(np.concatenate([[0], begin, [len(data)]])))
            codes = (wide * np.uint64(0x9E3779B97F4A7C15)) ^ ((place.astype(np.uint64) + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F))
            codes = codes * _PRIME ^ (codes >> np.uint64(29))
            codes[white] = 0
            running = np.concatenate([[np.uint64(0)], np.cumsum(codes)])
            words = running[end] - running[begin]
            yield _mix(words)
            pairs = words[:-1] * _PRIME + words[1:]
            pairs[words[:-1] == words[1:]] = 1
            yield _mix(pairs)


@dataclass
class Model:
    scores: np.ndarray  # by bucket: the vector through the layer, class 1 less class 0
    bias: float

    def predict(self, text: str | None) -> float:
        total, n = 0.0, 0
        for part in features(text):
            total += float(self.scores[part].sum())
            n += len(part)
        return float(1 / (1 + np.exp(-np.clip(total / max(n, 1) + self.bias, -30, 30))))


def fit_sgd(rows: Sequence[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, rate: float = RATE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors, layer and bias, learned together; one step per row with a falling rate."""
    draw = np.random.default_rng(11)
    vectors = draw.uniform(-1, 1, (BUCKETS, DIMENSION)) / DIMENSION
    layer, bias = np.zeros((DIMENSION, 2)), np.zeros(2)
    steps, step = max(1, epochs * len(rows)), 0
    for _ in range(epochs):
        for i in draw.permutation(len(rows)):
            at, share, label = rows[i]
            pace = rate * (1 - step / steps)
            own = vectors[at]
            mean = share @ own
            logits = mean @ layer + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = layer @ p
            layer -= pace * np.outer(mean, p)
            bias -= pace * p
            # Every feature moves by the same step, as in a mean whose terms are updated alike.
            vectors[at] = own - pace * np.minimum(share * len(at), 4.0)[:, None] * back
            step += 1
    return vectors, layer, bias


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_PER_CLASS) -> Model:
    """Fit on ``labels.quality`` of documents whose id's remainder by 3 is not 1.

    The labels are sampled before they meet the texts: at most about twice ``sample`` ids are
    broadcast, and the sampled texts' sparse counts come to the driver.
    """
    own = labels.filter((remainder(F.col("doc_id"), 3) != 1) & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
    per_doc = own.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).filter("quality = most")
    shares = {r["quality"]: r["n"] for r in per_doc.groupBy("quality").agg(F.count("*").alias("n")).collect()}
    if len(shares) < 2:
        return Model(np.zeros(BUCKETS), {(): 0.0, (0,): -5.0, (1,): 5.0}[tuple(shares)])
    u = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rate = F.when(F.col("quality") == 1, min(1.0, sample / shares[1])).otherwise(min(1.0, sample / shares[0]))
    chosen = per_doc.filter(u < rate).select(F.col("doc_id").alias("__id"), F.col("quality").alias("__label"))
    told = docs.select("doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("__id"))  # bounded by ``sample``

    def make() -> Callable[[list], list]:
        def score(texts: list) -> list:
            out = []
            for text in texts:
                found = np.zeros(BUCKETS, np.int64)
                for part in features(text):
                    found += np.bincount(part, minlength=BUCKETS)
                out.append(found)
            at = [np.flatnonzero(f) for f in out]
            return [[a.astype("<u2").tobytes() for a in at], [f[a].astype("<u4").tobytes() for f, a in zip(out, at, strict=True)]]

        return score

    taken = annotate(told, "text", ["doc_id", "__label"], "at binary, n binary", make).filter(F.length("at") > 0)
    taken = taken.groupBy("doc_id").agg(F.min(F.struct("__label", "at", "n")).alias("row")).select("doc_id", "row.*").collect()
    rows = []
    for row in sorted(taken, key=lambda r: (r["doc_id"], bytes(r["at"]))):
        n = np.frombuffer(row["n"], "<u4").astype(float)
        rows.append((np.frombuffer(row["at"], "<u2").astype(np.int64), n / n.sum(), row["__label"]))
    vectors, layer, bias = fit_sgd(rows)
    drawn = {c: max(1, sum(r[2] == c for r in rows)) for c in (0, 1)}
    prior = np.log(shares[1] / shares[0]) - np.log(drawn[1] / drawn[0])
    return Model((vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(bias[1] - bias[0] + prior))


def classify(docs: DataFrame, model: Model, keep: Sequence[str], text: str = "text", name: str = "score") -> DataFrame:
    """``keep`` and the probability that the text would be labelled 1."""

    def make() -> Callable[[list], list]:
        return lambda texts: [[model.predict(t) for t in texts]]

    return annotate(docs, text, keep, f"`{name}` double", make)
