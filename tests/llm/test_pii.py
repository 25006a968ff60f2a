import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tarmac.llm import pii

PLAIN = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def luhn(digits):
    doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(digits))]
    return sum(v - 9 * (v > 9) for v in doubled) % 10 == 0


def valid(kind, hit):
    digits = re.sub("[^0-9]", "", hit)
    return (
        kind == 0
        or (kind == 1 and all(int(p) <= 255 for p in hit.split(".")))
        or (kind == 2 and 12 <= len(digits) <= 19 and luhn(digits))
        or (kind == 3 and 9 <= len(digits) <= 15)
    )


def brute(text):
    found = [(m.start(), k, m.end()) for k, p in enumerate(PLAIN) for m in re.finditer(p, text or "") if valid(k, m.group())]
    return sorted(found)


EDGES = [
    None, "", "a@b", "a@b.c x.y@z-1.co.uk_q@w.e 🙂 k@l.m", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.0255." + "0" * 50 + "1",
    "4111 1111-1111 1111 4111111111111111 4111  1111 1111 1111", "+1 (743) 555-3824 +1234 +12 345 678 9 0 1 2 3 4 5 6 +1-2",
    "é+44 20 7946 0958. a.b@c.d.e.f+g@h.i", "x@y..z q@-.-", "1.1.1.1@a.b +1.1.1.1 22.33", "a" * 200_000 + "@", "1" * 200_000, "u@" + "d." * 50_000 + "d",
]


def test_spans_equal_the_plain_patterns(frame):
    draw = random.Random(4)
    texts = EDGES + ["".join(draw.choices("a1.@+- 4é🙂()", k=60)) for _ in range(400)]
    rows = frame(list(enumerate(texts))).select("doc_id", "text", pii.base_spans(F.coalesce("text", F.lit(""))).alias("s")).collect()
    for row in rows:
        if len(row.text or "") > 150_000:  # the plain patterns are quadratic there
            continue
        assert [(s.start, s.kind, s.end) for s in row.s] == brute(row.text), row.text
    long = {len(r.text): [(s.kind, s.start, s.end) for s in r.s] for r in rows if len(r.text or "") > 150_000}
    assert all(spans == [] for spans in long.values())


def test_thousands_of_spans_in_one_text(frame):
    text = " ".join(f"10.0.{i % 256}.{i % 200}" for i in range(3000))
    (row,) = frame([(1, text)]).select(pii.base_spans(F.col("text")).alias("s")).collect()
    assert [(s.start, s.kind, s.end) for s in row.s] == brute(text)


@pytest.fixture(scope="module")
def corpus(spark):
    draw = random.Random(1)
    words = [f"w{chr(97 + i)}{chr(97 + j)}q" for i in range(26) for j in range(26)]
    text = lambda mid: " ".join(draw.sample(words, 8)) + mid + " ".join(draw.sample(words, 8))
    rows = [(i, text(" Zorblax wrote to jim@x.org ")) for i in range(6)]
    rows += [(i, text(" ")) for i in range(6, 300)]
    rows += [(300, "here ZORBLAX walks, zorblaxian not"), (301, None), (302, ""), (303, "common wrote"), (303, "common wrote")]
    rows += [(400 + i, text(" wrote ")) for i in range(20)]
    copy = text(" Quibble mailed ann@y.org ")
    rows += [(500 + i, copy) for i in range(30)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_terms_that_give_an_entity_away_are_found(corpus):
    assert {r.term for r in pii.disclosing(corpus).collect()} == {"zorblax"}  # not "wrote"; nor a copied text's words


def test_terms_are_marked_in_any_text(corpus):
    told = {r.doc_id: r.spans for r in pii.protect(corpus).select("doc_id", pii.joined_spans(pii.all_spans()).alias("spans")).collect()}
    assert told[300] == "term:5:12" and told[301] == "" and told[302] == "" and told[303] == ""
    assert re.fullmatch(r"term:40:47,email:57:66", told[0])


def test_disclosure_in_bits_by_hand(corpus):
    rows = pii.disclosing(corpus, remove=0.1, generalise=5.0, evidence=6).collect()
    by = {r.term: r.removed for r in rows}
    assert by["zorblax"] is False  # 6 of 7 texts leave 0.22 bits open
    assert by["wrote"] is False  # 6 of 27 leave 2.2


def test_sanitise_replaces_and_keeps_columns(corpus, cluttered):
    docs = cluttered(corpus.withColumn("n_chars", F.length("text").cast("long")))
    out = pii.sanitise(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[300].text == "here [REMOVED] walks, zorblaxian not" and rows[300].n_chars == len(rows[300].text)
    assert "[EMAIL]" in rows[0].text and "jim@" not in rows[0].text and rows[301].text is None and rows[302].text == ""


def test_overlapping_spans_and_digest(frame):
    text = "x 1.1.1.1@a.b y"
    (row,) = pii.protect(frame([(1, text)])).select(pii.joined_spans(F.col("pii.base")).alias("s"), pii.sanitised(F.col("text")).alias("t"), *pii.counted()).collect()
    assert row.s == "email:2:13,ip:2:9" and row.t == "x [EMAIL] y" and (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 0, 0)
    assert hashlib.sha256(row.s.encode()).hexdigest()


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.protect(empty).count() == 0 and pii.sanitise(empty).count() == 0


def test_no_python_in_the_plan(corpus):
    plan = pii.sanitise(corpus)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
