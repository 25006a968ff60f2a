"""Personal data: pattern spans, and terms whose co-occurrence reveals who they belong to.

Base spans (e-mail, IP address, card, phone) come from patterns. Each different value is a
protected entity e. From the words around its occurrences the corpus tells how much a term t
discloses: with p(e|t) the share of the texts holding t in which t stands beside e, the pointwise
mutual information of e and t falls short of e's own information content by -log2 p(e|t) bits.
Terms that leave at most ``REMOVE_BITS`` open are removed, up to ``GENERALISE_BITS`` generalised,
in whatever text they stand. Evidence counts different surroundings, so that copies of one
passage do not make its words telling, and probabilities count different texts.

Only DataFrame functions are used. Statistics cover all documents: a pass over the base spans'
surroundings proposes terms, a pass over all words counts the proposed ones, and a third finds
the texts that hold disclosing ones. Tables of terms are joined by their size: written first, so
that the planner knows it and broadcasts what is small.

Nulls and edge cases: a null text is empty; an empty text has no spans and the digest of the
empty string; rows are not matched by id, so null and repeated ids and repeated rows are each
answered; spans of terms never overlap base spans; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import fresh
from tarmac.operators.ranges import stored

# The kinds in their order, and their patterns. Possessive quantifiers and the look
# behind keep long runs linear; they match what the plain patterns match.
KINDS = ["email", "ip", "card", "phone", "term"]
PATTERNS = [
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]
# What a text must hold before a pattern is tried.
HINTS = ["@", r"[0-9]\.[0-9]", r"[0-9](?:[\x20-]?[0-9]){11}", r"\+[0-9]"]
TERM = 4

BESIDE_CHARS, BESIDE_WORDS = 160, 6  # surroundings: words on either side, within so many characters
LEAST_TERM = 3
LEAST_EVIDENCE = 3  # different surroundings in which a term stands beside an entity
REMOVE_BITS, GENERALISE_BITS = 0.5, 1.0
NO_WORD = r"[^\p{L}\p{N}]+"

SPAN, TERM_SPAN = "struct<start:int,kind:int,end:int>", "struct<start:int,kind:int,end:int,removed:boolean>"
SPANS = f"array<{SPAN}>"


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _valid(hit: Column, kind: int) -> Column:
    if kind == 1:
        small = lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3) & (F.concat(F.lit("0"), F.right(p, F.lit(3))).cast("int") <= 255)
        return F.forall(F.split(hit, r"\."), small)
    if kind == 2:
        return F.length(_digits(hit)).between(12, 19) & F.call_function("luhn_check", _digits(hit))
    if kind == 3:
        return F.length(_digits(hit)).between(9, 15)
    return F.lit(True)


def _found(text: Column, pattern: Column, kind: int) -> Column:
    """Spans of a pattern's valid matches, from the lengths of the matches and the gaps before them."""
    hits = F.regexp_extract_all(text, pattern, F.lit(0))
    pairs = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(hits)), hits, lambda gap, hit: F.struct(F.length(gap).alias("skip"), hit.alias("hit")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["skip"]
        end = begin + F.length(x["hit"])
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"))
        spans = F.when(_valid(x["hit"], kind), F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    return F.aggregate(pairs, start, step, lambda acc: acc["spans"])


def base_spans(text: Column) -> Column:
    """All base spans by start, then kind; offsets are code points, ends are exclusive."""
    none = F.array().cast(SPANS)
    each = [F.when(text.rlike(hint), _found(text, F.lit(p), k)).otherwise(none) for k, (p, hint) in enumerate(zip(PATTERNS, HINTS, strict=True))]
    return F.sort_array(F.concat(*each))


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), NO_WORD), lambda w: F.length(w) >= LEAST_TERM)


def occurrences(docs: DataFrame) -> DataFrame:
    """Each base span's entity, the words beside it, and the digest of its text."""
    body = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select(body.alias("text"), F.explode(base_spans(body)).alias("s"))
    cut = lambda a, n: F.substring(F.col("text"), a, n)
    start, end = F.col("s.start"), F.col("s.end")
    hit = cut(start + 1, end - start)
    entity = F.concat(F.col("s.kind").cast("string"), F.lit(":"), F.when(F.col("s.kind") == 0, F.lower(hit)).when(F.col("s.kind") == 1, hit).otherwise(_digits(hit)))
    far = F.greatest(start - BESIDE_CHARS, F.lit(0))
    before, after = cut(far + 1, start - far), cut(end + 1, F.lit(BESIDE_CHARS))
    # A word that the limit cuts through is left out.
    before = F.when(far > 0, F.regexp_replace(before, r"^[\p{L}\p{N}]+", "")).otherwise(before)
    after = F.when(F.length(after) == BESIDE_CHARS, F.regexp_replace(after, r"[\p{L}\p{N}]+$", "")).otherwise(after)
    left, right = _words(before), _words(after)
    left = F.slice(left, F.greatest(F.size(left) - (BESIDE_WORDS - 1), F.lit(1)), F.lit(BESIDE_WORDS))
    beside = F.concat(left, F.slice(right, F.lit(1), F.lit(BESIDE_WORDS)))
    return found.select(entity.alias("entity"), F.md5("text").alias("digest"), beside.alias("beside"), F.xxhash64(beside).alias("surroundings"))


def proposed(docs: DataFrame, evidence: int = LEAST_EVIDENCE, bits: float = GENERALISE_BITS) -> DataFrame:
    """(entity, term, texts): terms often beside an entity and, beside entities, mostly beside that one."""
    near = stored(occurrences(docs))  # few rows, each dear to find again
    near = near.select("entity", "digest", "surroundings", F.explode(F.array_distinct("beside")).alias("term"))
    seen = near.groupBy("entity", "term", "surroundings").agg(F.count("*").alias("n")).groupBy("entity", "term").agg(F.count("*").alias("evidence"))
    seen = seen.filter(F.col("evidence") >= evidence)
    told = near.join(seen.select("term").distinct(), "term", "left_semi").select("entity", "term", "digest").distinct()
    by_pair = told.groupBy("entity", "term").agg(F.count("*").alias("texts"))
    by_term = told.select("term", "digest").distinct().groupBy("term").agg(F.count("*").alias("all_texts"))
    pairs = by_pair.join(seen, ["entity", "term"]).join(by_term, "term")
    return pairs.filter(F.col("texts") >= F.col("all_texts") * F.lit(2.0**-bits)).select("entity", "term", "texts")


def disclosing(docs: DataFrame, remove: float = REMOVE_BITS, generalise: float = GENERALISE_BITS, evidence: int = LEAST_EVIDENCE) -> DataFrame:
    """(term, removed) for the terms that disclose an entity in the corpus; a stored table."""
    terms = stored(proposed(docs, evidence, generalise))
    words = docs.filter(F.col("text").isNotNull()).select(F.md5("text").alias("digest"), F.explode(F.array_distinct(_words(F.col("text")))).alias("term"))
    counted = words.join(terms.select("term").distinct(), "term").distinct().groupBy("term").agg(F.count("*").alias("all_texts"))
    open_bits = -F.log2(F.least(F.col("texts") / F.col("all_texts"), F.lit(1.0)))
    judged = terms.join(counted, "term").withColumn("bits", open_bits).filter(F.col("bits") <= generalise)
    return stored(judged.groupBy("term").agg((F.min("bits") <= remove).alias("removed")))


def protect(docs: DataFrame, name: str = "pii", **thresholds: float) -> DataFrame:
    """All columns, and the struct ``name``: base spans, spans of terms, and the terms."""
    risky = disclosing(docs, **thresholds)
    words = docs.filter(F.col("text").isNotNull()).select(F.md5("text").alias("digest"), F.explode(F.array_distinct(_words(F.col("text")))).alias("term"))
    held = words.join(risky, "term").distinct()
    key, digest, terms, base = (fresh(docs, f"__{n}") for n in ("key", "digest", "terms", "base"))
    held = stored(held.groupBy(F.col("digest").alias(digest)).agg(F.collect_list(F.struct("term", "removed")).alias(terms)))
    body = F.coalesce(F.col("text"), F.lit(""))
    joined = docs.withColumn(key, F.md5(body)).join(held, F.col(key) == F.col(digest), "left").withColumn(base, base_spans(body))

    def of_term(t: Column) -> Column:
        pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])\Q"), t["term"], F.lit(r"\E(?![\p{L}\p{N}])"))
        return F.transform(_found(body, pattern, TERM), lambda s: F.struct(s["start"], s["kind"], s["end"], t["removed"]).cast(TERM_SPAN))

    def free(s: Column) -> Column:
        return ~F.exists(F.col(base), lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))

    found = F.sort_array(F.filter(F.flatten(F.transform(terms, of_term)), free))
    added = F.when(F.col(terms).isNull(), F.array().cast(f"array<{TERM_SPAN}>")).otherwise(found)
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], F.struct(F.col(base).alias("base"), added.alias("terms")).alias(name))


def joined_spans(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    kinds = F.array(*map(F.lit, KINDS))
    told = lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, told), ",")


def all_spans(pii: str = "pii") -> Column:
    plain = F.transform(F.col(f"{pii}.terms"), lambda s: F.struct(s["start"], s["kind"], s["end"]).cast(SPAN))
    return F.sort_array(F.concat(F.col(f"{pii}.base"), plain))


def counted(pii: str = "pii") -> list[Column]:
    """How many base spans there are of each kind."""
    of: Callable[[int], Column] = lambda k: F.size(F.filter(F.col(f"{pii}.base"), lambda s: s["kind"] == k)).cast("long")
    return [of(k).alias(f"n_{KINDS[k]}") for k in range(TERM)]


def sanitised(text: Column, pii: str = "pii") -> Column:
    """The text with base spans named by kind, removed terms left out and the others generalised.

    Of overlapping spans the later ones are cut short by what is already replaced.
    """
    base = F.transform(F.col(f"{pii}.base"), lambda s: F.struct(s["start"], s["kind"], s["end"], F.lit(False)).cast(TERM_SPAN))
    spans = F.sort_array(F.concat(base, F.col(f"{pii}.terms")))
    marks = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def mark(s: Column) -> Column:
        return F.when(s["removed"], F.lit("[REMOVED]")).otherwise(F.element_at(marks, s["kind"] + 1))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        plain = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        parts = F.when(s["start"] >= acc["at"], F.concat(acc["parts"], F.array(plain, mark(s)))).otherwise(acc["parts"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), parts.alias("parts"))

    def finish(acc: Column) -> Column:
        return F.concat(F.array_join(acc["parts"], ""), F.substring(text, acc["at"] + 1, F.length(text)))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, finish))


def sanitise(docs: DataFrame, **thresholds: float) -> DataFrame:
    """The documents with sanitised texts; a null text stays null, ``n_chars`` follows the text."""
    pii, clean = fresh(docs, "pii"), fresh(docs, "__clean")
    # A step of its own: a select that renames this to text must not compute from the new text.
    told = protect(docs, pii, **thresholds).withColumn(clean, sanitised(F.col("text"), pii))
    out = {c: F.col(f"`{c}`") for c in docs.columns} | {"text": F.col(clean)}
    if "n_chars" in out:
        out["n_chars"] = F.coalesce(F.length(clean).cast(docs.schema["n_chars"].dataType), out["n_chars"])
    return told.select(*[c.alias(n) for n, c in out.items()])
