import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tarmac.llm import alignment
from tarmac.llm.bpe import stand_ins

A, B = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
TEXTS = [
    "A plain line of words, and a few more.", "  two  spaces   and trailing  ", "tab\tand\n\nlines\n here \n", "", None, " ", "x",
    "Éai les, oution. Über naïve façade", "日本語 の テキスト 🎉🎉 ok", "a <|endoftext|> b <s> </s> <unk> <0x41>", "odd ▁ mark", "it's we'll don't 's",
    "1234567 8.90 --==** #$%&", "é combining   no-break 　 wide\x1cfile \x85 next", "nul \x00 byte", "long" * 300, "same same same same",
]


@pytest.fixture(scope="module")
def plain():
    """Whole texts encoded at once, aligned by sets and double loops."""
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = {c: i for i, c in enumerate(stand_ins())}
    vocab = {i: t for t, i in a.get_vocab().items()}

    def spans(ids, spell):
        at, out = 0, []
        for i in ids:
            out.append((at, at + len(spell(i)), i))
            at += len(spell(i))
        return out

    def piece(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    def work(text):
        if not text:
            return None
        spell = lambda i: bytes(letters[c] for c in vocab[i])
        left, right = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        if any(b"".join(map(f, ids)) != (" " + text).encode() for f, ids in ((spell, left), (piece, right))):
            return None
        left, right = spans(left, spell), spans(right, piece)
        ends = sorted({e for _, e, _ in left} & {e for _, e, _ in right})
        groups, start = [], 0
        for e in ends:
            groups.append("|".join(",".join(str(i) for s, f, i in side if s >= start and f <= e) for side in (left, right)))
            start = e
        links = [(i, j) for s, f, i in left for t, g, j in right if s < g and t < f]
        return len(left), len(right), ";".join(groups), links

    return work


def expected(texts, plain):
    found = [plain(t) for t in texts]
    count = Counter(p for f in found if f for p in f[3])
    most = {}
    for (_, j), c in count.items():
        most[j] = max(most.get(j, 0), c)
    rows = []
    for i, f in enumerate(found):
        if f is None:
            rows.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        best = sum(count[p] == most[p[1]] for p in links)
        told = hashlib.sha256(groups.encode()).hexdigest()
        rows.append((i, n_a, n_b, groups.count(";") + 1, len(links), best, sum(count[p] for p in links), told))
    return rows


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("frequent", [1 << 18, 40, 1])
def test_against_whole_texts_and_all_pairs(frame, cluttered, plain, frequent):
    draw = random.Random(3)
    words = "the of and tion enthe anly Hend oftionnten wherer, atreea. re-do 12 x!".split()
    texts = TEXTS + [" ".join(draw.choices(words, k=draw.randint(1, 60))) for _ in range(40)]
    docs = cluttered(frame(list(enumerate(texts))))
    told = alignment.compare(docs, A, B, frequent).select(COLUMNS).collect()
    assert sorted(map(tuple, told)) == expected(texts, plain)


def test_groups_are_given_as_text(frame, plain):
    rows = {r.doc_id: r.groups for r in alignment.groups(frame(list(enumerate(TEXTS))), ["doc_id"], A, B).collect()}
    assert rows == {i: f[2] if (f := plain(t)) else "" for i, t in enumerate(TEXTS)}


def test_repeated_rows_null_ids_and_an_empty_table(frame, spark):
    rows = [(1, "some words"), (1, "some words"), (None, "some words"), (None, None)]
    out = alignment.compare(frame(rows), A, B).collect()
    assert sorted((str(r.doc_id), r.n_links > 0) for r in out) == [("1", True), ("1", True), ("None", False), ("None", True)]
    assert len({r.count_sum for r in out if r.n_links}) == 1
    assert alignment.compare(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0


def test_caches_are_forgotten_without_a_trace(plain, monkeypatch):
    monkeypatch.setattr(alignment, "PARTS_CACHED", 5)
    monkeypatch.setattr(alignment, "JOINED", 3)
    own = alignment.Aligner(A, B)
    want = [f[2] if (f := plain(t)) else "" for t in TEXTS]
    for at in (1, 2, 5, 100):
        told = [g for i in range(0, len(TEXTS), at) for g in own.texts(TEXTS[i : i + at])[1]]
        assert told == want


def one(a, b):
    each = lambda n: np.array([n])
    i, j = alignment.cuts(np.array(a), np.array(b), each(0), each(len(a)), each(0), each(len(b)))
    return list(zip(i.tolist(), j.tolist(), strict=True))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5), min_size=1, max_size=40), st.randoms(use_true_random=False))
def test_cuts_are_the_shared_ends_and_links_the_overlaps(steps, draw):
    total = sum(steps)
    a = [sum(steps[: i + 1]) for i in range(len(steps))]
    b = sorted({draw.randint(1, total) for _ in range(draw.randint(0, 30))} | {total})
    assert [a[i] for i, _ in one(a, b)] == sorted(set(a) & set(b))
    assert all(a[i] == b[j] for i, j in one(a, b))
    found = list(zip(*(x.tolist() for x in alignment.overlaps(np.array(a), np.array(b))), strict=True))
    spans = [[(s, e) for s, e in zip([0, *ends], ends, strict=False)] for ends in (a, b)]
    assert found == [(i, j) for i, (s, e) in enumerate(spans[0]) for j, (t, f) in enumerate(spans[1]) if s < f and t < e]


def test_a_long_text_without_shared_cuts_in_its_middle():
    a, b = list(range(2, 6_001, 2)), [*range(1, 6_000, 2), 6_000]
    assert one(a, b) == [(len(a) - 1, len(b) - 1)]
