"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

Whole texts are lower-cased, everything but letters becomes one blank, and the n-grams of 1 to 3
letters are hashed into ``BUCKETS`` buckets. Inverse document frequencies count every training
row. The weights are fitted on a bounded sample of rows of each language by
follow-the-regularised-leader (FTRL-proximal) with an elastic net, which leaves most of them
zero; a temperature fitted on rows kept out of the fit calibrates the probabilities.

Nulls and edge cases: a null text, or one without a letter, is ``und`` with score 0; rows with a
null language or text teach nothing; with no training row every text is ``und``; repeated rows
count as often as they occur in the frequencies, and one row of an id in the fit; rows are
neither moved nor dropped. Every language with a training row is learned; the more there are, the
fewer rows of each are fitted, and the model grows by 128 KB a language.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import annotate, fresh, remainder, ship

BUCKETS = 1 << 14
ORDERS = (1, 2, 3)
SAMPLE_PER_LANGUAGE = 600  # expected rows of a language in the fitting sample
SAMPLE_ROWS = 6_000  # expected rows of all languages in it, the bound of the fit; every language keeps LEAST_ROWS
LEAST_ROWS = 8
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.05
CALIBRATED = 5  # one sampled row in so many is kept out of the fit for the temperature
TEXT_AT_ONCE = 1 << 20
UNDETERMINED = "und"

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """By code point: itself for a letter, 32 otherwise."""
    if not _LETTERS:
        _LETTERS.append(np.array([i if chr(i).isalpha() else 32 for i in range(0x110000)], np.uint32))
    return _LETTERS[0]


def counts(text: str | None) -> np.ndarray | None:
    """How often each bucket occurs among the text's n-grams; None without a letter."""
    if not text:
        return None
    text = text.lower()
    out, seen = np.zeros(BUCKETS, np.int64), False
    tail = np.array([32], np.uint32)
    for at in range(0, len(text), TEXT_AT_ONCE):
        points = np.frombuffer(text[at : at + TEXT_AT_ONCE].encode("utf-32-le", "surrogatepass"), "<u4")
        points = _letters()[points]
        seen = seen or bool((points != 32).any())
        if at + TEXT_AT_ONCE >= len(text):
            points = np.append(points, np.uint32(32))
        fresh_from = len(tail)
        points = np.concatenate([tail, points])
        keep = np.ones(len(points), bool)
        keep[1:] = (points[1:] != 32) | (points[:-1] != 32)
        fresh_from = int(keep[:fresh_from].sum())
        points = points[keep]
        for n in ORDERS:
            first = max(0, fresh_from - n + 1)
            if len(points) - first < n:
                continue
            mixed = np.full(len(points) - first - n + 1, n, np.uint32)
            for i in range(n):
                mixed = (mixed ^ points[first + i : len(points) - n + 1 + i]) * np.uint32(0x9E3779B1)
                mixed ^= mixed >> np.uint32(15)
            out += np.bincount(mixed & np.uint32(BUCKETS - 1), minlength=BUCKETS)
        tail = points[-(max(ORDERS) - 1) :]
    return out if seen else None


def weighed(found: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and their TF-IDF values, of length one."""
    at = np.flatnonzero(found)
    value = (1 + np.log(found[at])) * idf[at]
    return at, value / max(float(np.sqrt((value**2).sum())), 1e-12)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray  # language x bucket
    bias: np.ndarray
    temperature: float = 1.0

    def logits(self, at: np.ndarray, value: np.ndarray) -> np.ndarray:
        return self.weights[:, at] @ value + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        found = counts(text) if self.languages else None
        if found is None:
            return UNDETERMINED, 0.0
        p = softmax(self.logits(*weighed(found, self.idf)) / self.temperature)
        best = int(p.argmax())
        return self.languages[best], float(p[best])


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def fit_ftrl(rows: Sequence[tuple[np.ndarray, np.ndarray, int]], classes: int, epochs: int = EPOCHS) -> tuple[np.ndarray, np.ndarray]:
    """Weights and biases of the multinomial model, one FTRL-proximal step per row."""
    z, n = np.zeros((classes, BUCKETS + 1)), np.zeros((classes, BUCKETS + 1))

    def weights(at: np.ndarray) -> np.ndarray:
        zs, ns = z[:, at], n[:, at]
        shrunk = np.sign(zs) * np.maximum(np.abs(zs) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(ns)) / ALPHA + L2)

    draw = np.random.default_rng(7)
    for _ in range(epochs):
        for i in draw.permutation(len(rows)):
            at, value, label = rows[i]
            at, value = np.append(at, BUCKETS), np.append(value, 1.0)
            w = weights(at)
            p = softmax(w @ value)
            p[label] -= 1
            g = np.outer(p, value)
            z[:, at] += g - (np.sqrt(n[:, at] + g**2) - np.sqrt(n[:, at])) / ALPHA * w
            n[:, at] += g**2
    every = weights(np.arange(BUCKETS + 1))
    return every[:, :-1], every[:, -1]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden-section search on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        x = logits / np.exp(log_t)
        x = x - x.max(axis=1, keepdims=True)
        return float((np.log(np.exp(x).sum(axis=1)) - x[np.arange(len(labels)), labels]).mean())

    low, high, ratio = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _frequencies(texts: DataFrame) -> tuple[int, np.ndarray]:
    """Number of texts, and in how many each bucket occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(BUCKETS + 1, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                found = counts(text.as_py())
                if found is not None:
                    total[:BUCKETS] += found > 0
                    rows += 1
        total[BUCKETS] = rows
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS + 1)), pa.array(total)], names=["bucket", "n"])

    summed = texts.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS + 1, np.int64)
    for bucket, n in summed.collect():  # BUCKETS + 1 rows, whatever the input
        out[bucket] = n
    return int(out[BUCKETS]), out[:BUCKETS]


def train(docs: DataFrame, sample: int = SAMPLE_PER_LANGUAGE) -> Model:
    """Fit on the text and lang of documents that are not held out.

    Rows are sampled by a hash of the id at a rate that expects ``sample`` rows of a language,
    and fewer where there are so many that ``SAMPLE_ROWS`` would be passed; one row of an id is taken, so that a repeated or null id cannot swell the
    sample. Their sparse counts, not their texts, come to the driver.
    """
    ship(docs.sparkSession)
    known = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).filter(
        (remainder(F.col("doc_id"), 4) != 2) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    per_language = known.groupBy("lang").agg(F.count("*").alias("n")).collect()  # a row a language
    languages = sorted(r["lang"] for r in per_language)
    if not languages:
        return Model([], np.zeros(BUCKETS), np.zeros((0, BUCKETS)), np.zeros(0))
    sample = min(sample, max(LEAST_ROWS, SAMPLE_ROWS // len(languages)))
    total, df = _frequencies(known.select("text"))
    idf = np.log((1 + total) / (1 + df)) + 1
    rate = F.create_map(*[x for r in per_language for x in (F.lit(r["lang"]), F.lit(min(1.0, sample / r["n"])))])
    u = F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("sample")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = known.filter(u < rate[F.col("lang")])

    def make() -> Callable[[list], list]:
        def score(texts: list) -> list:
            found = [counts(t) for t in texts]
            at = [np.flatnonzero(c) if c is not None else np.array([], np.int64) for c in found]
            return [[a.astype("<u2").tobytes() for a in at], [(c[a] if c is not None else a).astype("<u4").tobytes() for c, a in zip(found, at, strict=True)]]

        return score

    rows, kept = [], []
    taken = annotate(chosen, "text", ["doc_id", "lang"], "at binary, n binary", make).filter(F.length("at") > 0)
    taken = taken.groupBy("doc_id").agg(F.min(F.struct("lang", "at", "n")).alias("row")).select("doc_id", "row.*").collect()
    for i, row in enumerate(sorted(taken, key=lambda r: (r["doc_id"] is None, r["doc_id"], bytes(r["at"])))):
        found = np.zeros(BUCKETS, np.int64)
        found[np.frombuffer(row["at"], "<u2")] = np.frombuffer(row["n"], "<u4")
        at, value = weighed(found, idf)
        (kept if i % CALIBRATED == 0 and len(taken) > 10 * CALIBRATED else rows).append((at, value, languages.index(row["lang"])))
    model = Model(languages, idf, *fit_ftrl(rows, len(languages)))
    logits = np.array([model.logits(at, value) for at, value, _ in kept]).reshape(len(kept), len(languages))
    model.temperature = fit_temperature(logits, np.array([label for *_, label in kept], np.int64))
    return model


def identify(docs: DataFrame, model: Model, keep: Sequence[str], text: str = "text", names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """``keep``, the predicted language and its calibrated probability."""

    def make() -> Callable[[list], list]:
        return lambda texts: [list(c) for c in zip(*map(model.predict, texts), strict=True)] if texts else [[], []]

    return annotate(docs, text, keep, f"`{names[0]}` string, `{names[1]}` double", make)


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents whose language is found with probability ``least`` or more; all columns."""
    pred, score = fresh(docs, "lang_pred"), fresh(docs, "lang_score")
    told = identify(docs, train(docs), docs.columns, names=(pred, score))
    return told.filter((F.col(pred) != UNDETERMINED) & (F.col(score) >= least)).select(*[F.col(f"`{c}`") for c in docs.columns])
