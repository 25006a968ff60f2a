"""Passages out of texts by corpus statistics: answers to any question, and the most salient sentence.

An answer is the sentence that scores highest for the words of a question: rare words count more
(inverse sentence frequency over all texts) and a word said again in a sentence counts less each
time (term saturation, Robertson and Zaragoza 2009). The statistics are one aggregate over the
texts, as many numbers as the question has words; scoring stays inside the row.

A summary is the sentence nearest to what the text is about: the mean weight of its different
words, a word weighing its count in the text times its inverse document frequency. Documents are
counted by a shuffle of (text, different word), with map-side sums for words that all texts have.
The weights of a text's words are an array sorted by word, in which each sentence's words are found by
halving: a map would be gone through from its start for every word.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.text import sentences, words
from tarmac.operators.ranges import stored

SATURATION, LENGTH_SHARE = 1.2, 0.75
ROUNDED = 6  # scores that agree to so many places are equal: the earlier sentence counts


def question_terms(question: str) -> list[str]:
    """The different words of a question, in order."""
    return list(dict.fromkeys(w for w in re.split("[^a-z]+", question.lower()) if w))


def _said(sentence: Column) -> Column:
    return F.filter(words(sentence), lambda w: w != "")


def _equals(term: str) -> Callable[[Column], Column]:
    return lambda w: w == term


def _counted(text: Column, terms: list[str]) -> Column:
    """Per sentence: its number of words, how often it says each term, its place and itself."""

    def one(sentence: Column, place: Column) -> Column:
        bound = F.transform(F.array(_said(sentence)), lambda w: F.struct(
            F.size(w).alias("size"), F.array(*[F.size(F.filter(w, _equals(t))) for t in terms]).alias("tf"),
            (-place).alias("order"), F.trim(sentence).alias("sentence"),
        ))
        return bound[0]  # the one-element array binds the words, so that they are split once

    return F.transform(sentences(text), one)


def answers(rows: DataFrame, key: str, text: str, question: str, name: str = "answer") -> DataFrame:
    """``key``, the best passage of every text for a question, and its score; null if no word of it is said."""
    terms = question_terms(question)
    if not terms:
        raise ValueError("the question has no word")
    counted = stored(rows.select(key, _counted(F.col(text), terms).alias("__s")))
    sums = lambda of: F.aggregate("__s", F.lit(0).cast("bigint"), lambda a, s: a + of(s))
    told = counted.agg(
        F.sum(F.size("__s")).alias("n"), F.sum(sums(lambda s: s["size"])).alias("words"),
        *[F.sum(sums(lambda s, i=i: (s["tf"][i] > 0).cast("bigint"))).alias(f"df{i}") for i in range(len(terms))],
    ).first()
    n = told["n"] or 0
    mean = F.lit(float(told["words"] or 0)) / F.lit(float(max(n, 1)))
    weight = [F.log(F.lit(1.0) + (F.lit(float(n)) - (told[f"df{i}"] or 0) + 0.5) / F.lit((told[f"df{i}"] or 0) + 0.5)) for i in range(len(terms))]

    def score(s: Column) -> Column:
        total = F.lit(0.0)
        damped = SATURATION * (1 - LENGTH_SHARE + LENGTH_SHARE * s["size"] / F.greatest(mean, F.lit(1e-9)))
        for i in range(len(terms)):
            tf = s["tf"][i].cast("double")
            total = total + weight[i] * tf * (SATURATION + 1) / (tf + damped)
        return F.round(total, ROUNDED)

    best = F.array_max(F.transform("__s", lambda s: F.struct(score(s).alias("score"), s["order"].alias("order"), s["sentence"].alias("sentence"))))
    found = counted.select(key, best.alias("b"))
    hit = F.col("b.score") > 0
    return found.select(key, F.when(hit, F.col("b.sentence")).alias(name), F.when(hit, F.col("b.score")).alias("score"))


def salient_sentences(rows: DataFrame, key: str, text: str, name: str = "summary") -> DataFrame:
    """``key`` and the most salient sentence of every text; ``key`` must tell texts apart. Null for a null text."""
    texts = rows.select(key, text)
    said = texts.select(key, F.explode(words(F.col(text))).alias("w")).filter(F.col("w") != "")
    said = stored(said.groupBy(key, "w").agg(F.count("*").alias("tf")))
    total = texts.filter(F.col(text).isNotNull()).count()
    df = said.groupBy("w").agg(F.count("*").alias("df"))
    idf = F.log(F.lit(float(total + 1)) / (F.col("df") + 1)) + 1
    weighed = said.join(df.select("w", idf.alias("idf")), "w").groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("w", (F.col("tf") * F.col("idf")).alias("weight")))).alias("__s")  # the words of one text
    )
    halves = F.expr("transform(sequence(length(bin(size(__s))) - 1, 0, -1), i -> shiftleft(1, i))")
    weighed = weighed.select(key, F.col("__s.w").alias("__words"), F.col("__s.weight").alias("__weights"), halves.alias("__halves"))
    joined = texts.join(weighed, key, "left")

    def weight(w: Column) -> Column:
        upto = F.aggregate("__halves", F.lit(0), lambda n, half: F.when(F.get("__words", n + half - 1) <= w, n + half).otherwise(n))
        return F.get("__weights", upto - 1)

    def score(sentence: Column) -> Column:
        unlike = F.sort_array(F.array_distinct(F.array_remove(words(sentence), "")))
        bound = F.transform(F.array(unlike), lambda u: F.struct(F.aggregate(u, F.lit(0.0), lambda a, w: a + weight(w)).alias("sum"), F.size(u).alias("n")))[0]
        return F.transform(F.array(bound), lambda b: F.round(F.coalesce(b["sum"], F.lit(0.0)) / F.greatest(b["n"], F.lit(1)), ROUNDED))[0]

    scored = F.transform(sentences(F.col(text)), lambda s, i: F.struct(score(s).alias("score"), (-i).alias("order"), F.trim(s).alias("sentence")))
    return joined.select(key, F.array_max(scored)["sentence"].alias(name))
