"""Role-dependent masking expressions. The role is an argument, not session state."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ADMIN, ENGINEER, ANALYST = "ADMIN", "DATA_ENGINEER", "ANALYST"

# The patterns keep the outer characters and drop the middle.
EMAIL_PATTERN = r"^(.{2})(.*)(@.*)$"
PHONE_PATTERN = r"^(.{4})(.*)(.{4})$"
HIDDEN = "***MASKED***"
HOME_REGION = ("LHR", "LGW", "MAN", "EDI")


def _partial(value: Column, pattern: str, replacement: str) -> Column:
    # A value too short for the pattern would come back unmasked: hide it whole.
    return F.when(value.rlike(pattern), F.regexp_replace(value, pattern, replacement)).when(
        value.isNotNull(), HIDDEN
    )


def mask_email(value: Column, role: str) -> Column:
    if role in (ADMIN, ENGINEER):
        return value
    if role == ANALYST:
        return _partial(value, EMAIL_PATTERN, "$1***$3")
    return F.lit(HIDDEN)


def mask_phone(value: Column, role: str) -> Column:
    return value if role == ADMIN else _partial(value, PHONE_PATTERN, "$1****$3")


def mask_name(value: Column, role: str) -> Column:
    if role in (ADMIN, ENGINEER):
        return value
    if role == ANALYST:
        return F.concat(F.left(value, F.lit(1)), F.lit("****"))
    return F.lit("***")


def row_access(home: Column, role: str, visible: tuple[str, ...] = HOME_REGION) -> Column:
    """Row predicate: everything, the listed home airports, or nothing."""
    if role in (ADMIN, ENGINEER):
        return F.lit(True)
    if role == ANALYST:
        return F.coalesce(home.isin(*visible), F.lit(False))
    return F.lit(False)


MASK_BY_TAG = {"EMAIL": mask_email, "PHONE": mask_phone, "NAME": mask_name}
