"""Alignment of two tokenisations of the same bytes, by divide and conquer at shared cuts.

Both tokenisers cut a text into tokens; where tokens of both end, the text has a shared cut. A
common end near the middle is located by bisection and the two halves are gone through in the same
way; an interval without a cut is a leaf: a group of tokens of both kinds. Inside a group every
token is linked to those whose bytes it overlaps.

A single space between two other marks is a cut of both by construction (neither tokeniser has a
token that goes over it), so texts come apart there before they are encoded, and a part that
recurs is encoded and aligned once. New parts are encoded many at a time and gone through together:
all open intervals of a level are probed at once. Links are counted corpus-wide by pair of ids:
each task sums up its rows' pairs, Spark sums up the tasks'. A document's pairs stay with it as arrays. The
pairs that have at least one in ``1 / FREQUENT`` of all links, at most that many whatever the
corpus, are broadcast and looked up; all others are joined by pair.

Nulls and edge cases: a text that is null or empty, or whose tokens of either kind do not spell a
space and the text, has no tokens: zeros and an empty column for the groups. Rows keep their own
number, so repeated rows and null or repeated ids are each answered; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.bpe import stand_ins
from tarmac.llm.common import annotate, ship
from tarmac.operators.ranges import stored

FREQUENT = 1 << 18  # most pairs that are broadcast
ID_BITS = 31  # a pair of ids is one number: the first id above so many bits of the second
PARTS_CACHED, CHARS_CACHED = 400_000, 8_000_000  # what a worker remembers at most, before a batch adds to it
JOINED = 256  # new parts that are encoded as one text
SUMMED = 500_000  # pairs that a task gathers before it sums them up
MARK = "▁"  # stands for a space in pieces, so a text that holds it is not spelt by them
BETWEEN = re.compile(r"(?<=\S) (?=\S)")  # a single space between other marks

_LOADED: dict[tuple[str, str], "Aligner"] = {}


def cuts(a: np.ndarray, b: np.ndarray, low: np.ndarray, high: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, j) with a[i] == b[j] for every shared end, rising, inside intervals a[low:high] and b[start:stop].

    Every interval is probed at its middle, by bisection among its part of ``b``, and then one step
    further on either side in turn. A hit splits it into two intervals; without one it is a leaf.
    """
    found, steps = [], np.zeros(len(low), np.int64)
    while len(low):
        near = (low + high) // 2 + np.where(steps % 2, (steps + 1) // 2, -(steps // 2))
        inside = (near >= low) & (near < high)
        at = np.where(inside, near, low)
        j = np.clip(np.searchsorted(b, a[at]), start, np.maximum(stop - 1, start))
        hit = inside & (stop > start) & (b[np.minimum(j, len(b) - 1)] == a[at])
        found.append((at[hit], j[hit]))
        left = (low[hit], at[hit], start[hit], j[hit], np.zeros(hit.sum(), np.int64))
        right = (at[hit] + 1, high[hit], j[hit] + 1, stop[hit], np.zeros(hit.sum(), np.int64))
        on = ~hit & (steps + 1 < 2 * (high - low))
        rest = (low[on], high[on], start[on], stop[on], steps[on] + 1)
        low, high, start, stop, steps = (np.concatenate(parts) for parts in zip(left, right, rest, strict=True))
        open_ = (high > low) & (stop > start)
        low, high, start, stop, steps = low[open_], high[open_], start[open_], stop[open_], steps[open_]
    i, j = (np.concatenate(c) for c in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2
    order = np.argsort(i, kind="stable")
    return i[order], j[order]


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of the tokens that share bytes, given the ends of both kinds."""
    first = np.searchsorted(b, np.concatenate([[0], a[:-1]]), side="right")
    count = np.searchsorted(b, a, side="left") - first + 1
    return np.repeat(np.arange(len(a)), count), _spread(first, count)


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers from each ``first`` on, ``count`` of them."""
    before = np.cumsum(count) - count
    return np.arange(int(count.sum())) - np.repeat(before - first, count)


def _told(ids: np.ndarray, last: np.ndarray, mark: str) -> np.ndarray:
    """Each id in decimal with what follows it: ``mark`` after the last of a group, else a comma."""
    texts = np.array([f"{i}," for i in ids.tolist()], object)
    texts[last] = [f"{i}{mark}" for i in ids[last].tolist()]
    return texts


class Aligner:
    """Aligns texts under a byte-level vocabulary (A, of a space and the text) and a sentencepiece one (B)."""

    def __init__(self, a_path: str, b_path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # the text of a special token is ordinary text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        letters = {c: i for i, c in enumerate(stand_ins())}
        spelt = {i: t for t, i in self.a.get_vocab().items() if all(c in letters for c in t)}
        self.a_bytes = [bytes(letters[c] for c in spelt.get(i, "")) for i in range(self.a.get_vocab_size())]
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.a_size, self.b_size = (np.array([len(x) for x in side], np.int64) for side in (self.a_bytes, self.b_bytes))
        self._forget()

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(MARK, " ").encode()

    def _forget(self) -> None:
        """Of each part seen so far: its numbers (A tokens, B tokens, groups, links), groups as text, links in a row."""
        self.index: dict[str, int] = {}
        self.chars = 0
        self.numbers = np.zeros((0, 4), np.int64)
        self.groups: list[str] = []
        self.links = np.zeros(0, np.int64)

    def _encoded(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The ids of both kinds for parts in a row, each after a space; None if either does not spell them."""
        spaced = [p for p in parts if p[0].isspace() or p[-1].isspace()]
        a_ids, b_ids = [], []
        if spaced:  # such a part stands at an end of its text: it goes alone
            for part in parts:
                a_ids.append(self.a.encode(" " + part, add_special_tokens=False).ids)
                b_ids.append(self.b.encode(part))
        else:
            runs = [" ".join(parts[at : at + JOINED]) for at in range(0, len(parts), JOINED)]
            a_ids = [e.ids for e in self.a.encode_batch_fast([" " + r for r in runs], add_special_tokens=False)]
            b_ids = self.b.encode(runs, num_threads=1)
        a, b = (np.fromiter((i for ids in side for i in ids), np.int64) for side in (a_ids, b_ids))
        whole = " ".join(["", *parts]).encode()
        told = (b"".join(map(side.__getitem__, ids.tolist())) for side, ids in ((self.a_bytes, a), (self.b_bytes, b)))
        return (a, b) if all(t == whole for t in told) else None

    def _learn(self, parts: list[str]) -> None:
        """Encode and align parts that are not known yet."""
        plain = [p for p in parts if not (p[0].isspace() or p[-1].isspace()) and MARK not in p]
        for some in (plain, *[[p] for p in set(parts).difference(plain)]):
            if not some:
                continue
            if (ids := self._encoded(some)) is not None:
                self._add(some, *ids)
            elif len(some) > 1:  # one of them is not spelt: halve until it is found
                middle = len(some) // 2
                self._learn(some[:middle])
                self._learn(some[middle:])
            else:
                self._remember(some, np.array([[-1, 0, 0, 0]]), [""], np.zeros(0, np.int64))

    def _remember(self, parts: list[str], numbers: np.ndarray, groups: list[str], links: np.ndarray) -> None:
        self.index.update(zip(parts, range(len(self.numbers), len(self.numbers) + len(parts)), strict=True))
        self.chars += sum(map(len, parts))
        self.numbers, self.links = np.concatenate([self.numbers, numbers]), np.concatenate([self.links, links])
        self.groups += groups

    def _add(self, parts: list[str], a: np.ndarray, b: np.ndarray) -> None:
        a_ends, b_ends = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        ends = np.cumsum([len(p.encode()) + 1 for p in parts])
        # How many tokens of either kind end by each part's end, and how many of its cuts.
        a_by, b_by = np.searchsorted(a_ends, ends, "right"), np.searchsorted(b_ends, ends, "right")
        begin = lambda by: np.concatenate([[0], by[:-1]])
        i, j = cuts(a_ends, b_ends, begin(a_by), a_by, begin(b_by), b_by)
        by = np.searchsorted(i, a_by, "left")
        x, y = overlaps(a_ends, b_ends)
        links_by = np.searchsorted(x, a_by, "left")
        # Texts: a group's A ids, then its B ids; a token comes after those of its kind and of the other's earlier groups.
        text = np.empty(len(a) + len(b), object)
        a_last, b_last = np.zeros(len(a), bool), np.zeros(len(b), bool)
        a_last[i], b_last[j] = True, True
        group_a, group_b = np.searchsorted(i, np.arange(len(a)), "left"), np.searchsorted(j, np.arange(len(b)), "left")
        text[np.arange(len(a)) + np.concatenate([[0], j + 1])[group_a]] = _told(a, a_last, "|")
        text[np.arange(len(b)) + (i + 1)[group_b]] = _told(b, b_last, ";")
        told, at = text.tolist(), (a_by + b_by).tolist()
        groups = ["".join(told[s:e]) for s, e in zip([0, *at], at, strict=False)]
        counts = [c - begin(c) for c in (a_by, b_by, by, links_by)]
        self._remember(parts, np.stack(counts, axis=1), groups, a[x] << ID_BITS | b[y])

    def texts(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray]:
        """Of each text: its numbers, its groups; and of all texts, the owners of links and the links.

        A text without tokens has zeros, an empty text for its groups, and no links.
        """
        split = [BETWEEN.split(t) if t else [] for t in texts]
        new = [p for p in dict.fromkeys(p for s in split for p in s) if p not in self.index]
        if len(self.index) + len(new) > PARTS_CACHED or self.chars > CHARS_CACHED:
            self._forget()
            new = list(dict.fromkeys(p for s in split for p in s))
        self._learn(new)
        places = np.fromiter((self.index[p] for s in split for p in s), np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(s) for s in split])
        numbers = np.zeros((len(texts), 4), np.int64)
        wrong = np.zeros(len(texts), bool)
        np.logical_or.at(wrong, owner, self.numbers[places, 0] < 0)
        places, owner = places[~wrong[owner]], owner[~wrong[owner]]
        np.add.at(numbers, owner, self.numbers[places])
        told, at = [self.groups[i] for i in places.tolist()], np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
        groups = ["".join(told[s:e])[:-1] for s, e in zip(at, at[1:], strict=False)]
        count = self.numbers[:, 3]
        first = np.cumsum(count) - count
        links = self.links[_spread(first[places], count[places])]
        return numbers, groups, np.repeat(owner, count[places]), links


def aligner(a_path: str, b_path: str) -> Aligner:
    """The aligner of two vocabularies, made once in a worker."""
    if (a_path, b_path) not in _LOADED:
        _LOADED[a_path, b_path] = Aligner(a_path, b_path)
    return _LOADED[a_path, b_path]


def groups(docs: DataFrame, keep: Sequence[str], a_path: str, b_path: str, text: str = "text") -> DataFrame:
    """``keep``, and the aligned ``groups`` of every text as ``a1,a2|b1;a3|b2,b3``; empty for a text without tokens."""

    def make() -> Callable[[list], list]:
        own = aligner(a_path, b_path)
        return lambda texts: [own.texts(texts)[1]]

    return annotate(docs, text, keep, "groups string", make)


def linked(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, the numbers and digest of each row, its different linked ``pairs``, and how often each is linked (``times``)."""
    schema = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<bigint>"

    def make() -> Callable[[list], list]:
        own = aligner(a_path, b_path)

        def work(texts: list) -> list:
            numbers, told, owner, links = own.texts(texts)
            digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in told]
            order = np.lexsort((links, owner))
            owner, links = owner[order], links[order]
            change = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (links[1:] != links[:-1])])) if len(links) else np.zeros(0, np.int64)
            times = np.diff(np.concatenate([change, [len(links)]]))
            ends = np.searchsorted(owner[change], np.arange(len(texts)), "right")
            pairs = np.split(links[change], ends[:-1]) if len(texts) else []
            return [*numbers.T, digests, pairs, np.split(times, ends[:-1]) if len(texts) else []]

        return work

    return annotate(docs, "text", ["doc_id"], schema, make)


def _flat(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False)


def counts(rows: DataFrame) -> DataFrame:
    """(pair, count): how many links of all rows join each pair of ids; a stored table."""
    ship(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, times, held = [], [], 0

        def summed() -> pa.RecordBatch:
            seen, place = np.unique(np.concatenate(pairs), return_inverse=True)
            total = np.zeros(len(seen), np.int64)
            np.add.at(total, place, np.concatenate(times))
            return pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total)], names=["pair", "count"])

        for batch in batches:
            pairs.append(_flat(batch.column(0)))
            times.append(_flat(batch.column(1)))
            held += len(pairs[-1])
            if held >= SUMMED:
                yield summed()
                pairs, times, held = [], [], 0
        if held:
            yield summed()

    parts = rows.select("pairs", "times").mapInArrow(run, "pair bigint, count bigint")
    return stored(parts.groupBy("pair").agg(F.sum("count").alias("count")))


def compare(docs: DataFrame, a_path: str, b_path: str, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every row.

    ``n_best`` are the links whose pair is linked as often, corpus-wide, as any pair of its B id;
    ``count_sum`` sums the corpus-wide counts over the row's links.
    """
    rows = stored(linked(docs, a_path, b_path).withColumn("row", F.monotonically_increasing_id()))
    total = counts(rows)
    second = F.col("pair").bitwiseAND(F.lit((1 << ID_BITS) - 1))
    best = total.groupBy(second.alias("b")).agg(F.max("count").alias("most"))  # one row for each B id of the vocabulary
    judged = stored(total.withColumn("b", second).join(best, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best")))
    links = total.agg(F.sum("count").alias("n")).first()["n"] or 0
    heavy = judged.filter(F.col("count") * F.lit(frequent) >= F.lit(links)).toPandas()  # at most ``frequent`` rows
    heavy = heavy.sort_values("pair")
    known = rows.sparkSession.sparkContext.broadcast((heavy["pair"].to_numpy(np.int64), heavy["count"].to_numpy(np.int64), heavy["best"].to_numpy(bool)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, count, is_best = known.value
        for batch in batches:
            pairs, times = _flat(batch.column(1)), _flat(batch.column(2))
            owner = np.repeat(np.arange(batch.num_rows), np.diff(batch.column(1).offsets.to_numpy()))
            place = np.minimum(np.searchsorted(keys, pairs), max(len(keys) - 1, 0))
            hit = keys[place] == pairs if len(keys) else np.zeros(len(pairs), bool)
            at, found, often = owner[hit], place[hit], times[hit]
            n_best, count_sum = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            np.add.at(n_best, at, often * is_best[found])
            np.add.at(count_sum, at, often * count[found])
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner[~hit], minlength=batch.num_rows))]).astype(np.int32)
            rest = [pa.ListArray.from_arrays(pa.array(ends), pa.array(c[~hit])) for c in (pairs, times)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n_best), pa.array(count_sum), *rest], names=["row", "n_best", "count_sum", "pairs", "times"])

    ship(rows.sparkSession)
    schema = "row bigint, n_best bigint, count_sum bigint, pairs array<bigint>, times array<bigint>"
    met = stored(rows.select("row", "pairs", "times").mapInArrow(run, schema))
    rare = met.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("z")).select("row", F.col("z.pairs").alias("pair"), F.col("z.times").alias("times"))
    rare = rare.join(judged.filter(F.col("count") * F.lit(frequent) < F.lit(links)), "pair")
    more = rare.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("count")).alias("more_sum")
    )
    joined = rows.drop("pairs", "times").join(met.drop("pairs", "times"), "row").join(more, "row", "left")
    none = F.lit(0).cast("bigint")
    return joined.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.coalesce("more_best", none)).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", none)).alias("count_sum"), "groups_sha256",
    )
