"""Metrics and dimensions by name or synonym, joined by the declared relationships."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.tables import Tables

# The business names of columns, as published with the data model.
SYNONYMS: dict[str, dict[str, tuple[str, ...]]] = {
    "flight": {
        "flight_number": ("flight", "flight code", "service number"),
        "flight_status": ("status",),
        "departure_delay_min": ("delay", "departure delay", "late by"),
        "arrival_delay_min": ("arrival delay", "arrived late"),
        "pax_booked": ("passengers", "pax", "travelers", "booked passengers"),
        "pax_flown": ("flown passengers", "actual passengers"),
        "seat_capacity": ("capacity", "seats", "total seats"),
        "load_factor_pct": ("load factor", "occupancy", "fill rate"),
        "revenue_total": ("revenue", "income", "sales"),
        "fuel_consumed_kg": ("fuel burn", "fuel consumption", "fuel used"),
    },
    "booking": {
        "booking_reference": ("pnr", "booking ref", "reservation"),
        "booking_channel": ("channel", "booked via", "source"),
        "booking_status": (),
        "total_amount": ("price", "cost", "fare", "ticket price"),
        "ancillary_revenue": ("extras", "add-ons", "ancillary"),
        "days_before_departure": ("advance purchase", "booking lead time"),
    },
    "delay": {
        "delay_minutes": ("delay duration", "delay length", "how long delayed"),
        "delay_category": ("cause", "reason", "delay type"),
        "total_cost_impact": ("cost", "delay cost", "financial impact"),
        "pax_affected": ("affected passengers", "impacted travelers"),
        "compensation_amount": (),
    },
    "feedback": {
        "feedback_text": ("comment", "review", "complaint", "feedback"),
        "sentiment_score": ("sentiment", "mood", "satisfaction score"),
        "nps_score": ("nps", "promoter score", "recommendation score"),
        "overall_rating": ("rating", "stars", "score"),
        "feedback_channel": (),
    },
    "passenger": {
        "loyalty_tier": ("tier", "membership level", "status"),
        "lifetime_miles": (),
        "home_airport": (),
    },
    "airport": {
        "iata_code": ("airport code", "code"),
        "airport_name": ("airport", "name"),
        "city": (),
        "country": (),
        "hub_type": (),
    },
    "route": {
        "route_code": ("route", "city pair", "sector"),
        "route_type": ("type", "haul type"),
        "distance_km": (),
    },
    "date": {
        "full_date": ("date", "day"),
        "day_name": (),
        "month_name": (),
        "season": (),
        "is_weekend": (),
    },
}
# Many-to-one relationships as (table, column, parent, parent key).
RELATIONSHIPS = [
    ("flight", "flight_date_key", "date", "date_key"),
    ("flight", "origin_airport_key", "airport", "airport_key"),
    ("flight", "dest_airport_key", "airport", "airport_key"),
    ("flight", "route_key", "route", "route_key"),
    ("booking", "passenger_key", "passenger", "passenger_key"),
    ("booking", "flight_event_key", "flight", "flight_event_key"),
    ("delay", "flight_event_key", "flight", "flight_event_key"),
    ("feedback", "passenger_key", "passenger", "passenger_key"),
]
AGGREGATES = {
    "sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count,
    "count distinct": F.count_distinct,
}


@dataclass(frozen=True)
class Metric:
    """An aggregate of a named measure; ``count`` of ``rows`` counts fact rows.

    ``percent`` is the share of fact rows whose measure fulfils ``holds``, times 100.
    """

    aggregate: str
    measure: str
    name: str
    holds: Callable[[Column], Column] | None = None


def resolve(term: str, prefer: Sequence[str] = ()) -> tuple[str, str]:
    """(table, column) of a column name or synonym; an ambiguous term needs ``prefer``.

    ``table.column`` names any column of a table, with or without a business name.
    """
    wanted = term.strip().lower()
    table, _, column = wanted.partition(".")
    if column and table in SYNONYMS:
        return table, column
    found = [
        (table, column)
        for table, columns in SYNONYMS.items()
        for column, names in columns.items()
        if wanted in (column, column.replace("_", " "), *names)
    ]
    if not found:
        raise KeyError(f"unknown term {term!r}")
    preferred = [hit for table in prefer for hit in found if hit[0] == table]
    if len(found) > 1 and not preferred:
        raise KeyError(f"{term!r} is ambiguous: {found}")
    return (preferred or found)[0]


def path_to(base: str, target: str, via: str | None = None) -> list[tuple[str, str, str, str]]:
    """Shortest chain of many-to-one relationships from a fact to a table."""
    queue = deque([(base, [])])
    while queue:
        table, steps = queue.popleft()
        if table == target:
            return steps
        for link in RELATIONSHIPS:
            wrong_role = via and link[2] == target and link[1] != via
            if link[0] == table and link not in steps and not wrong_role:
                queue.append((link[2], [*steps, link]))
    raise KeyError(f"no relationship leads from {base} to {target}")


def semantic_query(
    t: Tables, metrics: Sequence[Metric], dimensions: Mapping[str, str] | Sequence[str],
    where: Column | None = None, via: str | None = None,
    only: Mapping[str, Callable[[Column], Column]] | None = None, top: tuple[str, int] | None = None,
) -> DataFrame:
    """Metrics by dimensions. All metrics must live on one fact table.

    ``dimensions`` lists terms, or maps output names to terms. ``via`` picks the
    foreign key where a dimension plays two roles (``dest_airport_key``). ``only`` keeps the
    rows whose terms, of the fact or a dimension, fulfil a predicate. ``top`` (metric, n) keeps
    the n groups with the greatest metric, nulls last and ties by the dimensions.
    """
    terms = dict(dimensions) if isinstance(dimensions, Mapping) else {d.rpartition(".")[2].replace(" ", "_"): d for d in dimensions}
    measured = [resolve(m.measure, ("flight", "booking", "delay", "feedback")) for m in metrics if m.measure != "rows"]
    facts = {table for table, _ in measured}
    if len(facts) != 1:
        raise KeyError(f"metrics must share one fact table, got {sorted(facts)}")
    base = facts.pop()
    rows: DataFrame = getattr(t, base)
    if where is not None:  # over the fact's own columns, whether or not they are selected
        rows = rows.filter(where)
    order = (base, "passenger", "airport", "route", "date")
    needed = {name: resolve(term, order) for name, term in terms.items()}
    tested = [(*resolve(term, order), holds) for term, holds in (only or {}).items()]
    for column, holds in [(c, h) for table, c, h in tested if table == base]:
        rows = rows.filter(holds(F.col(column)))
    tested = [x for x in tested if x[0] != base]

    links: list[tuple[str, str, str, str]] = []
    for table in [*(table for table, _ in needed.values()), *(table for table, _, _ in tested)]:
        links += [step for step in path_to(base, table, via) if step not in links]
    own = {c for table, c in needed.values() if table == base} | {c for _, c in measured}
    own |= {column for table, column, _, _ in links if table == base}
    rows = rows.select(*sorted(own))
    for _, column, parent, parent_key in links:
        wanted = {c for table, c in needed.values() if table == parent}
        wanted |= {c for table, c, _, _ in links if table == parent}
        side = getattr(t, parent)
        for c, holds in [(c, h) for table, c, h in tested if table == parent]:
            side = side.filter(holds(F.col(c)))
        side = side.select(F.col(parent_key).alias("__key"), *sorted(wanted - {parent_key}))
        rows = rows.join(side, F.col(column) == F.col("__key")).drop("__key")
    aggregates = []
    for m in metrics:
        value = F.lit(1) if m.measure == "rows" else F.col(resolve(m.measure, (base,))[1])
        if m.aggregate == "percent":
            out = F.count(F.when(m.holds(value), 1)) * 100.0 / F.nullif(F.count(F.lit(1)), F.lit(0))
        else:
            out = AGGREGATES[m.aggregate](value)
        aggregates.append(out.alias(m.name))
    told = rows.groupBy(*[F.col(c).alias(name) for name, (_, c) in needed.items()]).agg(*aggregates)
    return told if top is None else told.orderBy(F.desc_nulls_last(f"`{top[0]}`"), *[f"`{name}`" for name in needed]).limit(top[1])
