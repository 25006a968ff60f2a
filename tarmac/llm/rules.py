"""Quality rules: an isolation forest on rule statistics, with a threshold from labelled rows.

Each whole text gives counts (words, symbols, repeated lines and word runs) and from them
ratios. A ratio enters as its excess over the limit that nearly all rows of label 1 respect, so
that ordinary variation does not look odd. Trees of random splits are grown on samples of
documents' excesses, each drawn out of all documents by a hash of its own; where a sample does not
vary in an excess, splits are drawn from the range that it has over all documents. A document that few splits part from the rest has a short path and a
high anomaly score. All labelled rows set limits and threshold, by aggregates: the lowest threshold
that keeps all but a stated share of label 1. The base rules stand beside the verdict: what they fail is not kept.

Nulls and edge cases: a null text has no words; a text of no words fails the base rules; rows
without a label, or with labels that contradict each other, calibrate nothing; with no labelled row of either class nothing but the
base rules rejects; repeated rows are judged alike; rows are neither moved nor dropped.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import annotate, fresh, ship
from tarmac.operators.aggregates import exact_percentiles
from tarmac.operators.ranges import stored

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
LEAST_WORDS, MOST_REPEATED_PERCENT, WINDOW = 20, 30, 8

TREES, TREE_ROWS = 200, 256
SPARE = 1.5  # a tree's rows are the least hashes of so many times as many expected ones
GOOD_WITHIN, MARGIN, LEEWAY = 0.999, 1.1, 0.01  # a ratio's limit: that quantile of all rows of label 1, widened
GOOD_LOST = 0.004  # at most this share of the rows of label 1 may be rejected
BINS, SCORED_AT_ONCE = 1_000, 2_048

STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
RATIOS = ["symbol_share", "repeat_share", "dup_line_share", "upper_share", "mark_share", "mean_word", "echo_share", "long_word_share", "word_share"]
_WHITE_SET = frozenset(WHITE)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more, the first occurrence included.

    Windows are numbered exactly: pairs of numbers of half the length get a number each.
    """
    if len(words) <= window:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    width = 1
    while width < window:
        pairs = ids[:-width] * np.int64(len(words) + 1) + ids[width:]
        distinct, ids, times = np.unique(pairs, return_inverse=True, return_counts=True)
        width *= 2
        if width < window and len(distinct) == len(pairs):
            return 0
    again = np.flatnonzero(times[ids] > 1)
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, again, 1)
    np.add.at(covered, again + window, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """The base counts and the ratios of a text."""
    text = text or ""
    raw = text.encode()
    words = raw.split()  # bytes: ASCII white space alone
    n = len(words)
    word_chars = len(text) - sum(map(text.count, WHITE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = Counter(x for x in raw.split(b"\n") if x.split(None, 1))
    dup = sum(c - 1 for c in lines.values())
    repeat = repeated_words(words)
    points = np.frombuffer(raw, np.uint8)
    upper = int(((points >= 65) & (points <= 90)).sum())
    marks = sum(map(text.count, "!?;:'\"()[]{}_=+/\\~^@"))
    echo = sum(a == b for a, b in zip(words, words[1:], strict=False))
    long = sum(len(w) > 24 for w in words)
    chars, many = max(word_chars, 1), max(n, 1)
    ratios = [
        symbols / chars, repeat / many, dup / max(sum(lines.values()), 1), upper / chars, marks / chars,
        word_chars / many, echo / many, long / many, n / chars,
    ]
    return [n, word_chars, symbols, dup, repeat], ratios


def base_failed(counts: Sequence[int]) -> bool:
    return counts[0] < LEAST_WORDS or 100 * counts[4] > MOST_REPEATED_PERCENT * counts[0]


def mean_path(n: int) -> float:
    """Mean path length of an unsuccessful search among n rows."""
    return 0.0 if n < 2 else 2 * (np.log(n - 1) + 0.5772156649015329) - 2 * (n - 1) / n


@dataclass
class Forest:
    """Trees as flat arrays: at a node a feature and a split, or a leaf's path length."""

    trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    rows: int = 0
    threshold: float = np.inf
    limits: np.ndarray = field(default_factory=lambda: np.zeros(len(RATIOS)))

    def excess(self, x: np.ndarray) -> np.ndarray:
        """How far ratios exceed their limits, on a logarithmic scale."""
        return np.log1p(np.maximum(x - self.limits, 0) / (self.limits + LEEWAY))

    def anomaly(self, ratios: np.ndarray) -> np.ndarray:
        return self.score(self.excess(ratios))

    def score(self, x: np.ndarray) -> np.ndarray:
        """Anomaly scores of the rows of ``x``, 0 to 1."""
        if not self.trees:
            return np.zeros(len(x))
        total = np.zeros(len(x))
        every = np.arange(len(x))
        for feature, split, length in self.trees:
            at = np.zeros(len(x), np.int64)
            while True:
                inner = feature[at] >= 0
                if not inner.any():
                    break
                right = x[every, np.maximum(feature[at], 0)] >= split[at]
                at = np.where(inner, 2 * at + 1 + right, at)
            total += length[at]
        return 2 ** (-total / len(self.trees) / max(mean_path(self.rows), 1e-9))


@dataclass
class Sample:
    """Distinct rows drawn for some tree, the row numbers of each tree, and all documents' least and greatest values."""

    values: np.ndarray
    trees: list[np.ndarray]
    low: np.ndarray
    high: np.ndarray

    def __len__(self) -> int:
        return len(self.values)


def subsets(values: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 4) -> Sample:
    """Random subsets of rows that are all at hand."""
    draw = np.random.default_rng(seed)
    parts = [draw.choice(len(values), min(rows, len(values)), replace=False) for _ in range(trees if len(values) else 0)]
    none = np.zeros(values.shape[1])
    return Sample(values, parts, values.min(axis=0, initial=np.inf), values.max(axis=0, initial=-np.inf)) if len(values) else Sample(values, parts, none, none)


def grow(sample: Sample | np.ndarray, seed: int = 5) -> Forest:
    """A tree over each subset of the sample's rows, as deep as the logarithm of its size.

    A split lies in the range of the rows at the node or, where these are all equal, in what the
    splits above have left of the range of all documents.
    """
    sample = sample if isinstance(sample, Sample) else subsets(sample)
    draw = np.random.default_rng(seed)
    rows = max(map(len, sample.trees), default=0)
    depth = max(1, int(np.ceil(np.log2(max(rows, 2)))))
    out = Forest(rows=rows)
    for chosen in sample.trees:
        size = 2 ** (depth + 1) - 1
        feature, split, length = np.full(size, -1), np.zeros(size), np.zeros(size)
        todo = [(0, 0, sample.values[chosen], sample.low, sample.high)]
        while todo:
            node, level, part, low, high = todo.pop()
            if level == depth or len(part) < 2:
                length[node] = level + mean_path(len(part))
                continue
            least, most = part.min(axis=0), part.max(axis=0)
            start, stop = np.where(most > least, least, low), np.where(most > least, most, high)
            able = np.flatnonzero(stop > start)
            if not len(able):
                length[node] = level + mean_path(len(part))
                continue
            f = feature[node] = draw.choice(able)
            split[node] = draw.uniform(start[f], stop[f])
            right = part[:, f] >= split[node]
            below, above = high.copy(), low.copy()
            below[f] = above[f] = split[node]
            todo += [(2 * node + 1, level + 1, part[~right], low, below), (2 * node + 2, level + 1, part[right], above, high)]
        out.trees.append((feature, split, length))
    return out


def nth_largest(rows: DataFrame, value: str, n: int) -> float:
    """The value with ``n`` rows before it in descending order, exactly; ``rows`` has more than ``n``.

    Counts of equal parts of the range pick a part, until all values in it are equal.
    """
    x = F.col(value)
    ends = rows.agg(F.min(x).alias("low"), F.max(x).alias("high")).first()
    low, high = ends["low"], ends["high"]
    while low < high:
        inside = rows.filter(x.between(low, high))
        # the ends are set apart by name, so that rounding cannot keep both in one part
        part = F.when(x == high, BINS).otherwise(F.least(F.floor((x - low) / F.lit(high - low) * BINS), F.lit(BINS - 1)))
        counts = inside.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min(x).alias("low"), F.max(x).alias("high"))
        for r in sorted(counts.collect(), key=lambda r: -r["part"]):
            if n < r["n"]:
                low, high = r["low"], r["high"]
                break
            n -= r["n"]
    return float(low)


def calibrate(scored: DataFrame, lost: float = GOOD_LOST) -> float:
    """The lowest threshold that rejects at most ``lost`` of label 1; infinite if it rejects nothing of label 0.

    ``scored`` has (quality, anomaly) and should be a stored table: it is read several times.
    """
    good = scored.filter("quality = 1")
    count = good.count()
    if not count:
        return np.inf
    least = nth_largest(good, "anomaly", min(count - 1, int(np.ceil(lost * count))))  # at most that many good rows lie above
    above = scored.filter((F.col("quality") == 0) & (F.col("anomaly") > least)).agg(F.min("anomaly").alias("a")).first()["a"]
    return float((least + above) / 2) if above is not None else np.inf


def find_limits(good: DataFrame) -> np.ndarray:
    """Each ratio's limit: the exact quantile over all rows of ``good``, widened."""
    values = good.select(F.posexplode("ratios").alias("i", "v"))
    found = {r["i"]: r["q"] for r in exact_percentiles(values, ["i"], "v", {"q": GOOD_WITHIN}).collect()}
    return MARGIN * np.array([found[i] for i in range(len(RATIOS))], float) + LEEWAY


def score_ratios(labelled: DataFrame, forest: Forest) -> DataFrame:
    """quality and anomaly of the rows of (quality, ratios)."""
    ship(labelled.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SCORED_AT_ONCE):
                part = batch.slice(at, SCORED_AT_ONCE)
                scores = forest.anomaly(_ratios(part.column(1).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores, pa.float64())], names=["quality", "anomaly"])

    return labelled.select(F.col("quality").cast("int").alias("quality"), "ratios").mapInArrow(run, "quality int, anomaly double")


def _measure(docs: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` and the ``ratios`` of every text."""

    def make() -> Callable[[list], list]:
        def measure(texts: list) -> list:
            found = [statistics(t) for t in texts]
            return [[r for _, r in found], [base_failed(c) for c, _ in found]]

        return measure

    return annotate(docs, "text", keep, "ratios array<double>, failed boolean", make)


def draw_trees(measured: DataFrame) -> Sample:
    """Each tree's rows by its own hash of the id out of all documents, and the ratios' ranges over all rows.

    One row of an id counts in a tree, so that a repeated or null id cannot swell it. About
    ``TREES * TREE_ROWS * SPARE`` rows come to the driver, whatever the table's size.
    """
    units = measured.groupBy("doc_id").agg(F.min("ratios").alias("ratios"))
    count = units.count()
    least = int(min(1.0, SPARE * TREE_ROWS / max(count, 1)) * (1 << 52))
    unit = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    hashes = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.struct(t.alias("t"), F.pmod(F.xxhash64(unit, F.lit("tree"), t), F.lit(1 << 52)).alias("h")))
    drawn = units.select("ratios", F.filter(hashes, lambda x: x["h"] < least).alias("at")).filter(F.size("at") > 0).collect()
    drawn.sort(key=lambda r: (tuple(r["ratios"]), min(r["at"])))
    found: list[list[tuple[int, int]]] = [[] for _ in range(TREES)]
    for i, r in enumerate(drawn):
        for x in r["at"]:
            found[x["t"]].append((x["h"], i))
    trees = [np.array([i for _, i in sorted(x)[:TREE_ROWS]]) for x in found if x]
    ends = measured.agg(*[f(F.col("ratios")[i]).alias(f"{n}{i}") for n, f in (("low", F.min), ("high", F.max)) for i in range(len(RATIOS))]).first()
    return Sample(_ratios([r["ratios"] for r in drawn]), trees, *(np.array([ends[f"{n}{i}"] for i in range(len(RATIOS))], float) for n in ("low", "high")))


def train(docs: DataFrame, labels: DataFrame) -> Forest:
    """Grow the forest on rows drawn from all documents; set limits and threshold on all labelled ones.

    One row of an id counts among the labelled, the one of the least ratios.
    """
    known = labels.filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id")
    known = known.agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).filter("quality = most")
    if known.select("quality").distinct().count() < 2:
        return Forest()
    measured = stored(_measure(docs.select("doc_id", "text"), ["doc_id"]))
    drawn = draw_trees(measured)
    if not len(drawn):
        return Forest()
    # What fails the base rules is not kept in any case, so it does not set the threshold.
    told = measured.filter("NOT failed").groupBy("doc_id").agg(F.min("ratios").alias("ratios"))
    labelled = stored(told.join(known, "doc_id").select("quality", "ratios"))
    good = labelled.filter("quality = 1")
    if good.isEmpty():
        return Forest()
    return fit(drawn, find_limits(good), lambda forest: calibrate(stored(score_ratios(labelled, forest))))


def _ratios(rows: list) -> np.ndarray:
    return np.array(rows, float).reshape(len(rows), len(RATIOS))


def fit(sample: Sample, limits: np.ndarray, threshold: Callable[[Forest], float]) -> Forest:
    """Trees over the sample's excesses above the limits, and the threshold that is found for them."""
    excess = Forest(limits=limits).excess
    forest = grow(Sample(excess(sample.values), sample.trees, excess(sample.low), excess(sample.high)))
    forest.limits = limits
    forest.threshold = threshold(forest)
    return forest


SCHEMA = ", ".join(f"{c} bigint" for c in STATISTICS) + ", base_failed boolean, kept boolean, anomaly double"


def judge(docs: DataFrame, forest: Forest, keep: Sequence[str], prefix: str = "", text: str = "text") -> DataFrame:
    """``keep``, the counts, ``base_failed``, ``kept`` and the anomaly score; names get ``prefix``."""

    def make() -> Callable[[list], list]:
        def score(texts: list) -> list:
            found = [statistics(t) for t in texts]
            anomaly = forest.anomaly(_ratios([r for _, r in found]))
            failed = [base_failed(c) for c, _ in found]
            kept = [not f and bool(a <= forest.threshold) for f, a in zip(failed, anomaly, strict=True)]
            return [*([c[i] for c, _ in found] for i in range(len(STATISTICS))), failed, kept, anomaly.tolist()]

        return score

    return annotate(docs, text, keep, ", ".join(f"`{prefix}{f.split()[0]}` {f.split()[1]}" for f in SCHEMA.split(", ")), make)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the rules keep; all columns."""
    prefix = fresh(docs, "rule")
    while any(c.startswith(f"{prefix}_") for c in docs.columns):
        prefix += "_"
    judged = judge(docs, train(docs, labels), docs.columns, f"{prefix}_")
    return judged.filter(F.col(f"{prefix}_kept")).select(*[F.col(f"`{c}`") for c in docs.columns])
