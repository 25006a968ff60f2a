"""Column tags, masking and row policies driven by schema metadata."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.functions.masks import ADMIN, MASK_BY_TAG, row_access

# The allowed values of each tag.
ALLOWED_TAGS = {
    "PII_CLASSIFICATION": ("NAME", "EMAIL", "PHONE", "PASSPORT", "ADDRESS", "DOB", "PAYMENT"),
    "DATA_SENSITIVITY": ("PUBLIC", "INTERNAL", "CONFIDENTIAL", "RESTRICTED"),
    "DATA_DOMAIN": ("PASSENGER", "FLIGHT_OPS", "COMMERCIAL", "MAINTENANCE", "FINANCE"),
}
PASSENGER_TAGS = {
    "first_name": {"PII_CLASSIFICATION": "NAME"},
    "last_name": {"PII_CLASSIFICATION": "NAME"},
    "email": {"PII_CLASSIFICATION": "EMAIL"},
    "phone": {"PII_CLASSIFICATION": "PHONE"},
    "date_of_birth": {"PII_CLASSIFICATION": "DOB"},
    "passport_country": {"PII_CLASSIFICATION": "PASSPORT"},
}


def tag_columns(df: DataFrame, tags: Mapping[str, Mapping[str, str]]) -> DataFrame:
    """Attach tags as field metadata; an unknown tag or value is refused."""
    for column, pairs in tags.items():
        for tag, value in pairs.items():
            if value not in ALLOWED_TAGS.get(tag, ()):
                raise ValueError(f"{column}: {tag} does not allow {value!r}")
        if column in df.columns:
            df = df.withMetadata(column, dict(pairs))
    return df


def tag_rows(tables: Mapping[str, DataFrame]) -> list[tuple[str, str, str, str]]:
    """(tag, value, table, column) of every tagged column, from schemas alone."""
    return sorted(
        (tag, value, table, field.name)
        for table, df in tables.items()
        for field in df.schema.fields
        for tag, value in field.metadata.items()
        if tag in ALLOWED_TAGS
    )


def tag_catalog(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Tagged columns with how many values each holds: one aggregate pass per table."""
    parts = []
    for name, df in tables.items():
        tags = tag_rows({name: df})
        if not tags:
            continue
        filled = df.agg(*[F.count(column).alias(column) for _, _, _, column in tags])
        described = [
            F.struct(
                F.lit(tag).alias("tag_name"), F.lit(value).alias("tag_value"),
                F.lit(table).alias("table_name"), F.lit(column).alias("column_name"),
                F.col(column).alias("filled_values"),
            )
            for tag, value, table, column in tags
        ]
        parts.append(filled.select(F.inline(F.array(*described))))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def policy_apply(
    df: DataFrame, role: str, home: str | None = None, literal: bool = True, required: Mapping[str, str] | None = None
) -> DataFrame:
    """The table as ``role`` may see it: tagged columns masked, rows filtered by home.

    ``literal`` keeps the published policies: a tag without a mask of its own hides nothing.
    Without it such a column is null for all but the administrator. ``required`` names columns and
    the tag each must bear; a column whose tag was lost on the way raises instead of passing in full.
    """
    for name, tag in (required or {}).items():
        found = df.schema[name].metadata.get("PII_CLASSIFICATION")
        if found != tag:
            raise ValueError(f"column {name} should be tagged {tag}, not {found}")
    if home:
        df = df.filter(row_access(F.col(home), role))
    out = []
    for field in df.schema.fields:
        tag = field.metadata.get("PII_CLASSIFICATION")
        mask, value = MASK_BY_TAG.get(tag), F.col(field.name)
        if mask:
            value = mask(value, role)
        elif tag and not literal and role != ADMIN:
            value = F.lit(None).cast(field.dataType)
        out.append(value.alias(field.name))
    return df.select(*out)
