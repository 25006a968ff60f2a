"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Targets: the sources, by code point and null last, take turns with the given weights and share a
multiple of all words. A source takes at most ``MOST_EPOCHS`` times its size; what is above that is
shared out again by weight. So a source's target is the lesser of its limit and its weight times
one level, and the level is found from running sums over the sources by limit per weight.

Draws: a document's key is -ln(u) / q, with u from a digest of its id and q its quality weight; the
smallest keys are an Efraimidis-Spirakis sample without replacement. A target is first met by
complete epochs, then by documents in the order of their keys up to the budget that is left; the
document at the border gives only as many words as the budget still asks for.

Only DataFrame functions are used. Order comes from range partitions, so that a source of a third
of all rows is spread over as many ranges as its rows ask for; sums are combined before they are
shuffled. The same input gives the same mix: nothing is drawn at run time.

Nulls and edge cases: a null text has no words, like an empty one, and takes nothing; a null doc_id
is drawn by the text "null"; rows of one id share u, and equal ones are interchangeable; sources
without words have the target 0; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.operators.ranges import ranged, running_in_ranges, stored

TURNS = (3, 1, 2)  # weights that sources take in turn
SHARE = 1.5  # words of the mix, as a multiple of all words
MOST_EPOCHS = 2
SEED = "mix:"
BLANKS = "\t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """The words between ASCII white space; none for a null text."""
    plain = F.translate(F.coalesce(text, F.lit("")), BLANKS, " " * len(BLANKS))
    return F.array_remove(F.split(plain, " "), "")


def quality(found: Column) -> Column:
    """A document's quality weight: one more than its different words, by one more than all its words."""
    return (F.size(F.array_distinct(found)) + 1).cast("double") / (F.size(found) + 1).cast("double")


def draw(doc_id: Column, weight: Column, seed: str = SEED) -> Column:
    """The exponential key of a document: -ln(u) over its weight, u from 52 bits of a digest."""
    digest = F.md5(F.concat(F.lit(seed), F.coalesce(doc_id.cast("string"), F.lit("null"))))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint").cast("double") + 0.5) / F.lit(float(1 << 52))
    return -F.log(u) / weight


def targets(sizes: DataFrame, turns: Sequence[int] = TURNS, share: float = SHARE, epochs: int = MOST_EPOCHS) -> DataFrame:
    """``sizes`` (no, source, source_size) with the ``target`` of each source; ``no`` marks the null source."""
    one = sizes.withColumn("all", F.lit(0)).withColumn("one", F.lit(1).cast("bigint"))
    placed = running_in_ranges(ranged(one, ["all"], ["no", "source"]), ["all"], ["no", "source"], "one", "place")
    turn = F.element_at(F.array(*map(F.lit, turns)), ((F.col("place") - 1) % len(turns) + 1).cast("int")).cast("bigint")
    placed = placed.withColumn("weight", turn).withColumn("most", F.col("source_size") * epochs)
    placed = placed.withColumn("level", F.col("most").cast("double") / F.col("weight").cast("double"))
    order = ["level", "no", "source"]
    rows = ranged(placed.select("all", *order, "source_size", "weight", "most"), ["all"], order)
    total = rows.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    rows = running_in_ranges(rows, ["all"], order, "most", "most_to")
    rows = running_in_ranges(rows, ["all"], order, "weight", "weight_to")
    # With the sources before this one at their limits, the level at which the others take the rest.
    left = F.lit(share * float(total["words"] or 0)) - (F.col("most_to") - F.col("most")).cast("double")
    level = left / (F.lit(total["weight"] or 0) - (F.col("weight_to") - F.col("weight"))).cast("double")
    rows = stored(rows.withColumn("at", level))
    # A source that does not reach its limit at that level ends the search; the first such has the highest.
    found = rows.filter(F.col("at") <= F.col("level")).agg(F.max("at").alias("at")).first()["at"]
    most = F.col("most").cast("double")
    target = most if found is None else F.least(most, F.col("weight").cast("double") * F.lit(found))
    return rows.select("no", "source", "source_size", target.alias("target"))


def mix(docs: DataFrame, turns: Sequence[int] = TURNS, share: float = SHARE, epochs: int = MOST_EPOCHS, seed: str = SEED) -> DataFrame:
    """doc_id, size, source_size, target and the words ``taken`` of every row, and its source."""
    found = docs.select(F.col("doc_id").alias("doc_id"), F.col("source").cast("string").alias("named"), words(F.col("text")).alias("words"))
    rows = stored(found.select(
        "doc_id", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("id"),
        F.col("named").isNull().cast("int").alias("no"), F.coalesce("named", F.lit("")).alias("source"),
        F.size("words").cast("bigint").alias("size"), draw(F.col("doc_id"), quality(F.col("words")), seed).alias("key"),
    ))
    aims = targets(rows.groupBy("no", "source").agg(F.sum("size").alias("source_size")), turns, share, epochs)
    order = ["key", "id", "size"]
    placed = running_in_ranges(ranged(rows, ["no", "source"], order), ["no", "source"], order, "size", "upto")
    budget = F.floor(F.col("target") + 0.5).cast("bigint")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("bigint")
    rest = budget - whole * F.col("source_size") - (F.col("upto") - F.col("size"))
    taken = whole * F.col("size") + F.least(F.col("size"), F.greatest(rest, F.lit(0).cast("bigint")))
    joined = placed.join(aims, ["no", "source"])
    source = F.when(F.col("no") == 0, F.col("source")).alias("source")
    return joined.select("doc_id", "size", "source_size", "target", taken.alias("taken"), source)
