"""Prompt texts assembled from rows and totals. Sending them to a model is the caller's."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.dates import AsOf
from tarmac.functions.text import QUESTION_CUES, first_duration, richest, scored_sentences
from tarmac.operators.joins import current_rows
from tarmac.operators.ordering import top_k
from tarmac.plans.reports import delay_briefing, ops_context
from tarmac.tables import Tables

# Wording of the three prompts (our own).
APOLOGY = (
    "You lead customer care at a premium airline. Write an empathetic personal reply of at most 150 words "
    "to {name}, a {tier} member. Name the problem, apologise, offer a concrete remedy. Their feedback: "
)
BRIEFING = (
    "You analyse airline operations. From the last 7 days of delays write a briefing of at most 200 words "
    "with the main concerns and recommendations. Data: "
)
ASSISTANT = "You assist airline operations. Answer briefly from the context and its numbers."


def fill(template: str, **values: Column) -> Column:
    """Text with ``{name}`` slots filled from columns (null if any is null)."""
    parts: list[Column] = []
    rest = template
    while "{" in rest:
        before, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        parts += [F.lit(before), values[name]]
    return F.concat(*parts, F.lit(rest))


def apology_prompts(
    t: Tables, tiers: tuple[str, ...] = ("DIAMOND", "PLATINUM"), below: float = -0.6, k: int | None = None
) -> DataFrame:
    """A reply prompt for each very unhappy top-tier passenger (the k worst if k is given)."""
    members = current_rows(t.passenger).filter(F.col("loyalty_tier").isin(*tiers))
    bad = t.feedback.filter(F.col("sentiment_score") < below)
    rows = bad.join(members.select("passenger_key", "first_name", "loyalty_tier"), "passenger_key")
    if k:
        rows = top_k(rows, [F.asc("sentiment_score")], ["feedback_key"], k)
    head = fill(APOLOGY, name=F.col("first_name"), tier=F.col("loyalty_tier"))
    return rows.select(
        "feedback_key", "first_name", "loyalty_tier", "feedback_text",
        F.concat(head, F.col("feedback_text")).alias("prompt"),
    )


def briefing_prompt(t: Tables, as_of: AsOf) -> DataFrame:
    return delay_briefing(t, as_of).select(F.concat(F.lit(BRIEFING), F.col("briefing")).alias("prompt"))


def assistant_prompt(t: Tables, as_of: AsOf, question: str) -> DataFrame:
    gap = F.lit("\n\n")
    context = F.concat(F.lit("CONTEXT: Operational summary - "), F.col("context"))
    return ops_context(t, as_of).select(
        F.concat(F.lit(ASSISTANT), gap, context, gap, F.lit("QUESTION: " + question)).alias("prompt")
    )


def extracted_issues(rows: DataFrame, key: str, text: str) -> DataFrame:
    """Answers to the three standing questions, with the duration stated in the text.

    The sentences are scored for all questions in one column, which the three
    answers then read.
    """
    scored = rows.withColumn("__scored", scored_sentences(F.col(text), *QUESTION_CUES.values()))
    names = ("extracted_problem", "desired_resolution", "delay_mentioned")
    answers = [richest(F.col("__scored"), n, at_least=1).alias(name) for n, name in enumerate(names)]
    return scored.select(key, *answers, first_duration(F.col(text)).alias("stated_duration"))
