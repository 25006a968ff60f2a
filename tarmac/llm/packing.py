"""Packing of tokenised documents into windows by Karmarkar-Karp multiway differencing.

A document's ids are cut into pieces: whole windows as long as there are any, then pieces of
at most ``grain`` ids. Whole windows need no balancing. The other pieces are dealt at random into
blocks of a bounded number of pieces; inside a block, multiway differencing merges partial
partitions with opposing imbalances into as many near-equal windows as the ids need, and into
more whenever the fullest exceeds the capacity.

Nulls and edge cases: a null text is empty; an empty text is one piece that holds the end id
alone; rows with a null or repeated id are packed like any other; an empty table gives no piece.
"""

from __future__ import annotations

import heapq
import math
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import BATCH_ROWS, held, ship
from tarmac.operators.ranges import stored

CAPACITY = 4096
GRAIN = 1024  # a remainder above this is cut, so that windows hold enough pieces to balance
END_ID = 2
BLOCK_PIECES = 2048  # mean number of pieces in a block
WORDS_CACHED = 600_000
WORDS_AT_ONCE = 50_000
JOINED = 256  # new words encoded as one text
TAIL = "!#$%&()*+,-./:;<=>?@[]^_`{|}~"  # marks that join no letter; without the apostrophe, which does
MAX_BLOCK_WINDOWS = 1 << 24  # sequence ids of a block are its number times this, and up

_TOKENIZERS: dict[str, object] = {}


def _load(path: str):
    """The tokenizer, and by token id whether a token ends a word."""
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        vocabulary = Tokenizer.from_file(path)
        vocabulary.encode_special_tokens = True  # the text of a special token is ordinary text
        ends = np.zeros(vocabulary.get_vocab_size(), bool)
        ends[[i for token, i in vocabulary.get_vocab().items() if token.endswith("</w>")]] = True
        _TOKENIZERS[path] = vocabulary, ends
    return _TOKENIZERS[path]


def _raw(ids) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def add_words(path: str, new: list[str], known: dict[str, bytes]) -> None:
    """Add the little-endian ids of ``new`` words to ``known``.

    Words of letters alone are encoded many at a time and told apart by the tokens that end
    a word; one with a tail of marks is its letters' ids and its tail's. Others go one by one.
    """
    vocabulary, ends = _load(path)
    letters = set(filter(str.isalpha, new))
    parts = [(w, w.rstrip(TAIL)) for w in new if w not in letters]
    tailed = [(w, core, w[len(core):]) for w, core in parts if core.isalpha()]
    single = [w for w, core in parts if not core.isalpha()]
    letters.update(core for _, core, _ in tailed if core not in known)
    plain = list(letters)
    groups = [plain[at : at + JOINED] for at in range(0, len(plain), JOINED)]
    joined = vocabulary.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)
    for group, found in zip(groups, joined, strict=True):
        ids = np.asarray(found.ids, dtype="<u4")
        stops = 4 * (np.flatnonzero(ends[ids]) + 1)
        if len(stops) == len(group):  # every word gives one or more ends, so each gave one
            raw, begin = ids.tobytes(), 0
            for word, stop in zip(group, stops.tolist(), strict=True):
                known[word] = raw[begin:stop]
                begin = stop
        else:
            single += group
    single += {tail for _, _, tail in tailed}.difference(known)
    for word, found in zip(single, vocabulary.encode_batch_fast(single, add_special_tokens=False), strict=True):
        known[word] = _raw(found.ids)
    for word, core, tail in tailed:
        known[word] = known[core] + known[tail]


def encode_texts(path: str, texts: list[str | None]) -> list[bytes]:
    """Each text's ids and the end id, as little-endian unsigned 32-bit integers.

    The vocabulary drops white space and never merges across it, so what stands between
    spaces and line ends is looked up; what recurs is encoded once, and the words of several
    texts together.
    """
    known = held(path)
    end = _raw([END_ID])
    out, waiting, many = [], [], 0
    for text in texts:
        words = (text or "").replace("\n", " ").split(" ")
        if waiting and many + len(words) > WORDS_AT_ONCE:
            out += _looked_up(path, waiting, known)
            waiting, many = [], 0
        waiting.append(words)
        many += len(words)
    return [ids + end for ids in out + _looked_up(path, waiting, known)]


def _looked_up(path: str, texts: list[list[str]], known: dict[str, bytes]) -> list[bytes]:
    """The ids of each list of words; lists longer than ``WORDS_AT_ONCE`` words stand alone and are cut."""
    if len(texts) == 1 and len(texts[0]) > WORDS_AT_ONCE:
        cuts = [texts[0][at : at + WORDS_AT_ONCE] for at in range(0, len(texts[0]), WORDS_AT_ONCE)]
        return [b"".join(ids for words in cuts for ids in _looked_up(path, [words], known))]
    if len(known) > WORDS_CACHED:
        known.clear()
    if new := set().union(*texts).difference(known):
        add_words(path, list(new), known)
    return [b"".join(map(known.__getitem__, words)) for words in texts]


def cut(length: int, capacity: int, grain: int) -> Iterator[tuple[int, int]]:
    """(start, length) of a document's pieces: whole windows, then even pieces of at most ``grain``."""
    whole = length - length % capacity
    yield from ((at, capacity) for at in range(0, whole, capacity))
    rest = length - whole
    parts = math.ceil(rest / grain)
    for i in range(parts):
        a, b = rest * i // parts, rest * (i + 1) // parts
        yield whole + a, b - a


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, grain: int = GRAIN) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of every piece, and a random ``salt``."""
    ship(docs.sparkSession)
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "salt"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        draw = np.random.default_rng(TaskContext.get().partitionId())
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                rows = []
                texts = encode_texts(path, part.column(1).to_pylist())
                for doc, ids in zip(part.column(0).to_pylist(), texts, strict=True):
                    n = len(ids) // 4
                    rows += [(doc, a, b, zlib.crc32(ids[4 * a : 4 * (a + b)]), n) for a, b in cut(n, capacity, grain)]
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] if rows else [pa.array([], pa.int64())] * 5
                yield pa.RecordBatch.from_arrays([*columns, pa.array(draw.integers(0, 1 << 31, len(rows)))], names=names)

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def difference(sizes: np.ndarray, windows: int) -> list[list[int]]:
    """Karmarkar-Karp: item numbers of ``windows`` near-equal parts.

    Every item starts as a partition with one part filled. The two partitions of the
    widest spread are merged, the fullest part of one with the emptiest of the other,
    until one partition is left. Parts are nodes of a forest: a merge of two filled
    parts links them, any other keeps the node it has. Only filled parts are held, fullest
    first: two partitions that fit side by side are joined without a sum.
    """
    n = len(sizes)
    left, right = [], []
    heap = []
    for i in np.argsort(-sizes, kind="stable"):
        heap.append((-int(sizes[i]) if windows > 1 else 0, int(i), sizes[i : i + 1].astype(np.int64), np.array([i], np.int64)))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, mark, a, a_nodes = heapq.heappop(heap)
        _, _, b, b_nodes = heap[0]
        meet = len(a) + len(b) - windows  # parts of either that are filled in both
        sums, nodes = np.concatenate((a, b[::-1][max(meet, 0) :])), np.concatenate((a_nodes, b_nodes[::-1][max(meet, 0) :]))
        if meet > 0:
            sums[len(a) - meet : len(a)] += b[::-1][:meet]
            nodes[len(a) - meet : len(a)] = n + len(left) + np.arange(meet)
            left += a_nodes[len(a) - meet :].tolist()
            right += b_nodes[::-1][:meet].tolist()
        if meet > 0 or len(b) > 1 or b[0] > a[-1]:
            order = np.argsort(-sums, kind="stable")
            sums, nodes = sums[order], nodes[order]
        least = int(sums[-1]) if len(sums) == windows else 0
        heapq.heapreplace(heap, (least - int(sums[0]), mark, sums, nodes))
    out = []
    for root in heap[0][3].tolist() if heap else []:
        items, open_nodes = [], [root] if root >= 0 else []
        while open_nodes:
            node = open_nodes.pop()
            if node < n:
                items.append(node)
            else:
                open_nodes += (left[node - n], right[node - n])
        out.append(items)
    return out + [[] for _ in range(windows - len(out))] if heap else out


def balance(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """The parts of the fewest windows, counted up from what the sum needs, that respect ``capacity``."""
    windows = max(1, math.ceil(int(sizes.sum()) / capacity))
    while True:
        parts = [p for p in difference(sizes, windows) if p]
        over = max((int(sizes[p].sum()) for p in parts), default=0) - capacity
        if over <= 0:
            return parts
        windows += max(1, windows // 400)


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, grain: int = GRAIN, block_pieces: int = BLOCK_PIECES) -> DataFrame:
    """One row per piece with its ``sequence_id`` and gapless ``offset``.

    The pieces are a written table: their random salt, and with it a piece's block, stays the
    same when a task is run again. A block is dealt by salt alone, so no key can fill one.
    """
    cuts = stored(pieces(docs, path, capacity, grain))
    blocks = max(1, math.ceil(cuts.count() / block_pieces))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        sizes = group.column("length").to_numpy()
        loose = np.flatnonzero(sizes < capacity)
        windows = [[i] for i in np.flatnonzero(sizes >= capacity)]
        windows += [sorted(loose[p]) for p in balance(sizes[loose], capacity)] if len(loose) else []
        base = group.column("block")[0].as_py() * MAX_BLOCK_WINDOWS
        sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        for w, members in enumerate(windows):
            sequence[members] = base + w
            offset[members] = np.cumsum(sizes[members]) - sizes[members]
        kept = group.select(["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        return kept.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    dealt = cuts.withColumn("block", F.col("salt") % F.lit(blocks)).drop("salt")
    return dealt.groupBy("block").applyInArrow(run, schema)
