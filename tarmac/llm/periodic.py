"""Periodic runs of words: by recursive frequency splitting, then a scan by lags.

A run is a stretch of consecutive words with the smallest period q (words q apart are equal), of
at least ``max(6, 4 q)`` words, that no neighbouring word extends. Each of its words stands in it
at least four times. A word that occurs more rarely in a segment is therefore in none of its runs
and splits it; the parts are split again by their own counts until nothing changes. Hardly any
words of ordinary prose survive.

In a segment that survives every lag q is tried at the multiples of q only: the words of a run
equal those q further on for 3 q words on end, and hence for the 2 q words from some multiple of
q. A multiple that passes is compared in full and extended. One that lies in a known run of a
smaller period is left out: what has both periods has a common divisor of them as its period. A
segment of n words has n ln n such places at most.

Nulls and edge cases: a null or empty text has no words, no runs and the digests of nothing; ties
for the longest run go to the smallest start, then period; rows are neither moved nor dropped, so
repeated rows and null ids pass through; a text of any length is gone through as a whole.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import annotate, fresh

LEAST_WORDS, LEAST_PERIODS = 6, 4
SHORT = 64  # segments of so many words are counted without numpy

Run = tuple[int, int, int]  # start, length, period


def segments(codes: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the stretches in which every word occurs at least four times, at any depth of splitting."""
    found, todo = [], [(0, len(codes))]
    while todo:
        low, high = todo.pop()
        if high - low < LEAST_WORDS:
            continue
        if high - low > SHORT:
            _, inverse, counts = np.unique(codes[low:high], return_inverse=True, return_counts=True)
            cuts = np.flatnonzero(counts[inverse] < LEAST_PERIODS).tolist()
        else:
            part = codes[low:high].tolist()
            often = Counter(part)
            cuts = [i for i, c in enumerate(part) if often[c] < LEAST_PERIODS]
        if not cuts:
            found.append((low, high))
            continue
        edges = [-1, *cuts, high - low]
        todo += [(low + a + 1, low + b) for a, b in zip(edges, edges[1:], strict=False) if b - a > LEAST_WORDS]
    return sorted(found)


def _same(w: np.ndarray, at: int, lag: int, count: int) -> bool:
    """Whether ``count`` words from ``at`` equal those ``lag`` further on; most differ at once, so little is read first."""
    done, step = 0, 8
    while done < count:
        stop = min(count, done + step)
        if not np.array_equal(w[at + done : at + stop], w[at + lag + done : at + lag + stop]):
            return False
        done, step = stop, 4 * step
    return True


def _reach(w: np.ndarray, at: int, lag: int, forward: bool) -> int:
    """How far the words go on to equal those ``lag`` further on, from ``at`` forwards or before ``at`` backwards."""
    most, done, step = len(w) - lag - at if forward else at, 0, 16
    while done < most:
        size = min(step, most - done)
        low = at + done if forward else at - done - size
        differ = np.flatnonzero(w[low : low + size] != w[low + lag : low + lag + size])
        if len(differ):
            return done + int(differ[0] if forward else size - 1 - differ[-1])
        done, step = done + size, 4 * step
    return done


def scan(w: np.ndarray) -> list[Run]:
    """All runs of one segment."""
    n, runs = len(w), []
    known = np.zeros(n, np.int64)  # the furthest end of a run found so far, for each of its words
    for q in range(1, n // LEAST_PERIODS + 1):
        at = np.arange(0, n - 3 * q + 1, q)
        at = at[known[at] < at + 3 * q]
        for offset in dict.fromkeys((0, q - 1, q // 2, q // 3)):
            if len(at):
                place = at + offset
                at = at[(w[place] == w[place + q]) & (w[place + q] == w[place + 2 * q])]
        for a in at.tolist():
            if known[a] >= a + 3 * q or not _same(w, a, q, 2 * q):
                continue
            start, end = a - _reach(w, a, q, False), a + q + _reach(w, a, q, True)
            if end - start >= max(LEAST_WORDS, LEAST_PERIODS * q):
                runs.append((start, end - start, q))
                np.maximum(known[start:end], end, out=known[start:end])
    return runs


def find(words: Sequence) -> list[Run]:
    """All runs of a sequence of words, by start, then period."""
    number: dict = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    runs = [(low + s, length, q) for low, high in segments(codes) for s, length, q in scan(codes[low:high])]
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapse(words: Sequence, runs: Sequence[Run]) -> list:
    """The words without those that a run holds after its first period."""
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        drop[start + q] += 1
        drop[start + length] -= 1
    kept = np.cumsum(drop[:-1]) == 0
    return [words[i] for i in np.flatnonzero(kept).tolist()] if runs else list(words)


def split_words(text: str | None) -> list[bytes]:
    """The words between ASCII white space, in UTF-8."""
    return (text or "").encode().split()


def planted(words: list[bytes], doc_id: str | None) -> list[bytes]:
    """The words, or for one id in ten a text whose end repeats a stretch; a null id counts as the empty text."""
    h, n = zlib.crc32((doc_id or "").encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def detect(docs: DataFrame, keep: Sequence[str], text: str = "text") -> DataFrame:
    """``keep``, the ``runs`` of every text (start, length, period) and its ``collapsed`` words."""

    def make() -> Callable[[list], list]:
        def work(texts: list) -> list:
            words = [split_words(t) for t in texts]
            runs = [find(w) for w in words]
            flat = [[x for run in r for x in run] for r in runs]
            return [flat, [b" ".join(collapse(w, r)).decode() for w, r in zip(words, runs, strict=True)]]

        return work

    found = annotate(docs, text, keep, "`runs` array<bigint>, `collapsed` string", make)
    places = F.when(F.size("runs") == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(0), F.size("runs") - 3, F.lit(3)))
    run = lambda i: F.struct(*[F.col("runs")[i + k].alias(n) for k, n in enumerate(("start", "length", "period"))])
    return found.withColumn("runs", F.transform(places, run))


def summarise(docs: DataFrame, plant: bool = False) -> DataFrame:
    """doc_id, the number of runs, the longest one, and the digests of all runs and of the collapsed text.

    With ``plant`` one id in ten has its text's end replaced by repetitions first.
    """
    told = fresh(docs, "__id")
    schema = "n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string"

    def make() -> Callable[[list], list]:
        def work(texts: list) -> list:
            rows = []
            for packed in texts:
                doc_id, text = _unpack(packed)
                words = split_words(text)
                if plant:
                    words = planted(words, doc_id)
                runs = find(words)
                best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
                row = [*best, 1000 * best[1] // best[2]] if best else [None] * 4
                listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
                short = b" ".join(collapse(words, runs))
                rows.append([len(runs), *row, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(short).hexdigest()])
            return list(zip(*rows, strict=True)) if rows else [[]] * 7

        return work

    # The id goes before the text and a line end; an id's decimal digits hold none.
    both = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("\n"), F.coalesce(F.col("text"), F.lit("")))
    found = annotate(docs.select("doc_id", both.alias(told)), told, ["doc_id"], schema, make)
    return found


def _unpack(packed: str) -> tuple[str, str]:
    doc_id, _, text = packed.partition("\n")
    return doc_id, text
