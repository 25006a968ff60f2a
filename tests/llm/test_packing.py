import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tarmac.llm import packing
from tarmac.llm.common import held

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def vocabulary():
    out = Tokenizer.from_file(PATH)
    out.encode_special_tokens = True
    return out


@pytest.mark.parametrize("text", [
    "", " ", None, "a\t b  c\n\nd'll DON'T 12 é é  x\x1cy", "İx it's' don't!! a.b.c ... !'s x'S ΑΣ #'re, _", "İİ aİ bb cc",
    "<|endoftext|> <|startoftext|>z", "日本語 🙂🙂 ﬁ", "x" * 5000, "word, " * 3000,
])
def test_ids_are_the_tokenizers(vocabulary, text):
    ids = np.frombuffer(packing.encode_texts(PATH, [text])[0], "<u4").tolist()
    assert ids == [*vocabulary.encode(text or "", add_special_tokens=False).ids, packing.END_ID]


def test_a_full_cache_changes_nothing(vocabulary, monkeypatch):
    monkeypatch.setattr(packing, "WORDS_CACHED", 3)
    monkeypatch.setattr(packing, "WORDS_AT_ONCE", 4)
    text = "the quick brown fox jumps over the lazy dog, again! and again!"
    assert np.frombuffer(packing.encode_texts(PATH, [text])[0], "<u4").tolist()[:-1] == vocabulary.encode(text, add_special_tokens=False).ids


def test_new_words_of_many_texts_are_encoded_together(vocabulary, monkeypatch):
    calls, add = [], packing.add_words
    monkeypatch.setattr(packing, "add_words", lambda path, new, known: (calls.append(len(new)), add(path, new, known)))
    held(None)
    texts = [f"text{'abcdefghij'[i % 10]} Wörd{'klmno'[i % 5]}, {i} é! DON'T" for i in range(100)] + [None, "", "x, x; y"]
    for text, ids in zip(texts, packing.encode_texts(PATH, texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == [*vocabulary.encode(text or "", add_special_tokens=False).ids, packing.END_ID]
    assert len(calls) == 1


def test_a_worker_remembers_for_one_operator_at_a_time():
    packing.encode_texts(PATH, ["some words"])
    assert "words" in held(PATH)
    assert held("another") == {} and held(PATH) == {}


@pytest.mark.parametrize("length", [1, 1023, 1024, 1025, 4095, 4096, 4097, 8192, 13000])
def test_cut_is_gapless_and_bounded(length):
    cuts = list(packing.cut(length, 4096, 1024))
    assert [a for a, _ in cuts] == [sum(n for _, n in cuts[:i]) for i in range(len(cuts))]
    assert sum(n for _, n in cuts) == length and all(0 < n <= 4096 for _, n in cuts)


def test_differencing_is_the_classic_example():
    parts = packing.difference(np.array([8, 7, 6, 5, 4]), 2)
    assert sorted(sum([8, 7, 6, 5, 4][i] for i in p) for p in parts) == [14, 16]


def test_differencing_places_every_item_once_and_evenly():
    sizes = np.random.default_rng(1).integers(1, 1025, 500)
    parts = packing.difference(sizes, 70)
    assert sorted(i for p in parts for i in p) == list(range(500))
    sums = [int(sizes[p].sum()) for p in parts]
    assert max(sums) - min(sums) < 100


def plain_difference(sizes, windows):
    """The same by whole partitions: sums of all parts, members as lists."""
    heap = [(-int(s) if windows > 1 else 0, i, [int(s)] + [0] * (windows - 1), [[i]] + [[] for _ in range(windows - 1)]) for i, s in enumerate(sizes)]
    while len(heap) > 1:
        (_, mark, a, x), (_, _, b, y) = sorted(heap, key=lambda h: h[:2])[:2]
        heap = sorted(heap, key=lambda h: h[:2])[2:]
        both = sorted(zip((p + q for p, q in zip(a, b[::-1])), (p + q for p, q in zip(x, y[::-1]))), key=lambda e: -e[0])
        sums, parts = [s for s, _ in both], [p for _, p in both]
        heap.append((sums[-1] - sums[0], mark, sums, parts))
    return heap[0][3]


def test_differencing_equals_the_plain_one():
    draw = np.random.default_rng(3)
    for windows in (1, 2, 7, 25, 60):
        for top in (3, 1025):
            sizes = draw.integers(1, top, 50)
            parts = packing.difference(sizes, windows)
            assert [sorted(p) for p in parts] == [sorted(p) for p in plain_difference(sizes, windows)]
    merges, concatenate = [], np.concatenate
    try:
        np.concatenate = lambda arrays, *a, **k: (merges.append(sum(map(len, arrays))), concatenate(arrays, *a, **k))[1]
        packing.difference(np.arange(1, 101), 1000)
    finally:
        np.concatenate = concatenate
    assert len(merges) == 2 * 99 and max(merges) == 100  # only filled parts are handled


def test_windows_rise_when_capacity_is_exceeded():
    parts = packing.balance(np.array([6, 6, 6, 6]), 10)  # the sum asks for 3 windows; no 2 fit in one
    assert len(parts) == 4


def checked(rows, texts, vocabulary, capacity):
    pieces = defaultdict(list)
    windows = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
        windows[r.sequence_id].append((r.offset, r.length))
    for doc, text in texts:
        ids = np.array([*vocabulary.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for start, length, crc, total in sorted(pieces[doc]):
            assert (start, total) == (at, len(ids)) and crc == zlib.crc32(ids[start : start + length].tobytes())
            at += length
        assert at == len(ids)
    for placed in windows.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= capacity
    return len(windows)


def test_pack_round_trip(frame, vocabulary):
    rng = np.random.default_rng(2)
    texts = [(i, " ".join(rng.choice(["alpha", "beta", "Gamma,", "δ"], int(n)))) for i, n in enumerate(rng.integers(0, 300, 120))]
    texts += [(500, None), (501, ""), (502, "long " * 9000)]
    rows = packing.pack(frame(texts), PATH, capacity=512, grain=128, block_pieces=64).collect()
    windows = checked(rows, texts, vocabulary, 512)
    total = sum(r.length for r in rows)
    assert total > 0.93 * 512 * windows


def test_repeated_rows_and_null_ids_are_packed_each(frame, cluttered):
    docs = cluttered(frame([(7, "same text")] * 50 + [(None, "no id")] * 3))
    rows = packing.pack(docs, PATH).collect()
    assert len(rows) == 53 and sum(r.doc_id is None for r in rows) == 3
    spots = {(r.sequence_id, r.offset) for r in rows}
    assert len(spots) == 53


def test_empty_table(frame, spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0
