"""Text scoring as column expressions.

Everything works inside the row: a text is split into an array and reduced with
higher-order functions, so no word is shuffled and the same expressions serve
batch and streaming plans. Whole texts are read, never a prefix.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A small polarity lexicon of our own for service feedback.
POSITIVE_WORDS = (
    "amazing", "best", "brilliant", "comfortable", "courteous", "delicious", "easy", "enjoyed",
    "excellent", "fantastic", "friendly", "good", "great", "happy", "helpful", "impressed",
    "love", "loved", "outstanding", "perfect", "pleasant", "professional", "smooth", "superb",
    "thank", "thanks", "wonderful",
)
NEGATIVE_WORDS = (
    "angry", "appalling", "awful", "bad", "broken", "cancelled", "clown", "cold", "complaint",
    "cramped", "damaged", "delay", "delayed", "dirty", "disappointed", "disappointing",
    "disgusting", "frustrating", "horrible", "idiot", "late", "loser", "lost", "missed", "moron",
    "never", "pathetic", "poor", "refund", "rude", "scum", "stupid", "terrible", "trash",
    "unacceptable", "uncomfortable", "waited", "waiting", "worst", "worthless",
)
# The three standing questions and the words that point to an answer.
QUESTION_CUES = {
    "What specific problem did the customer experience?": NEGATIVE_WORDS,
    "What compensation or resolution does the customer want?": (
        "compensation", "expect", "money", "refund", "reimburse", "reimbursement", "replacement",
        "resolution", "upgrade", "voucher", "want",
    ),
    "How long was the delay or wait time mentioned?": (
        "day", "days", "hour", "hours", "minute", "minutes", "overnight", "waited", "waiting",
    ),
}
WORD_BREAK = "[^a-z]+"
SENTENCE_END = "([.!?])[ \\t\\r\\n]+"
DURATION = "([0-9]+(?:\\.[0-9]+)?) ?-?(minutes?|mins?|hours?|hrs?|days?)"


def words(text: Column) -> Column:
    return F.split(F.lower(text), WORD_BREAK)


def _hits(tokens: Column, vocabulary: Sequence[str]) -> Column:
    """How many of the words are in ``vocabulary`` (a hashed set lookup per word)."""
    return F.size(F.filter(tokens, lambda w: w.isin(*vocabulary)))


def sentiment(text: Column) -> Column:
    """(positive - negative) / (positive + negative) words; 0 without any, null for null.

    That is the mean sign of the polar words: one pass picks them out, and the
    sum and count are folded over just those few.
    """
    polar = F.filter(words(text), lambda w: w.isin(*POSITIVE_WORDS, *NEGATIVE_WORDS))
    return F.aggregate(
        polar,
        F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n")),
        lambda acc, w: F.struct(
            (acc["sum"] + F.when(w.isin(*POSITIVE_WORDS), 1).otherwise(-1)).alias("sum"), (acc["n"] + 1).alias("n")
        ),
        lambda acc: F.coalesce(acc["sum"] / F.nullif(acc["n"], F.lit(0)), F.lit(0.0)),
    )


def sentences(text: Column) -> Column:
    marked = F.regexp_replace(text, SENTENCE_END, "$1\u0001")
    return F.split(marked, "\u0001")


def scored_sentences(text: Column, *vocabularies: Sequence[str]) -> Column:
    """Array of (hits of each vocabulary, -position, sentence); each sentence is split once."""

    def score(sentence: Column, position: Column) -> Column:
        # the one-element array binds the words, so that they are not split per vocabulary
        return F.transform(
            F.array(words(sentence)),
            lambda w: F.struct(
                F.array(*[_hits(w, v) for v in vocabularies]).alias("hits"),
                (-position).alias("order"),
                F.trim(sentence).alias("sentence"),
            ),
        )[0]

    return F.transform(sentences(text), score)


def richest(scored: Column, vocabulary: int = 0, at_least: int = 0) -> Column:
    """The sentence with most hits (the earlier of equals), null if none has ``at_least``."""
    ranked = F.transform(
        F.filter(scored, lambda s: s["hits"][vocabulary] >= at_least),
        lambda s: F.struct(s["hits"][vocabulary].alias("hits"), s["order"].alias("order"), s["sentence"].alias("sentence")),
    )
    return F.array_max(ranked)["sentence"]


def summarise(text: Column) -> Column:
    """Extractive one-sentence summary: the most opinionated sentence, else the lead."""
    return richest(scored_sentences(text, POSITIVE_WORDS + NEGATIVE_WORDS))


def extract_answer(text: Column, question: str) -> Column:
    """Best passage for a standing question, null when no sentence bears a cue word."""
    return richest(scored_sentences(text, QUESTION_CUES[question]), at_least=1)


def first_duration(text: Column) -> Column:
    """First stated duration such as ``3 hours``, null if none."""
    return F.nullif(F.regexp_extract(F.lower(text), DURATION, 0), F.lit(""))
