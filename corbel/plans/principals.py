"""Flattening specification for the principals document."""

from __future__ import annotations

from pyspark.sql import DataFrame

from corbel.operators.nested import ArraySpec, flatten_documents, numbered, specs_from_maps

# Paths, array names, fields and output names that the flattened
# document must have.
HEADER = {
    "duns": "enriched.organization.duns",
    "primaryName": "enriched.organization.primaryName",
    "countryISOAlpha2Code": "enriched.organization.countryISOAlpha2Code",
}
PRINCIPALS = "enriched.organization.currentPrincipals"
ASSOCIATIONS = "currentPrincipals_associations"
DISQUALIFICATIONS = "currentPrincipals_disqualifications"
ACT_TYPES = "currentPrincipals_disqualifications_actType"
ASSOCIATION_FIELDS = ["primaryName", "duns", "startDate"]
PERSON_FIELDS = ["person.name", "person.age"]
DISQUALIFICATION_FIELDS = ["endDate", "actText", "startDate"]
DISQUALIFICATION_SLOTS = 3
SIMPLE_ORDER = [("primaryName", "ASC"), ("startDate", "DESC")]
COMPLEX_ORDER = [("primaryName", "ASC"), ("person.name", "DESC")]


def _slots(prefix: str, fields: list[str], count: int) -> dict[str, dict[int, str]]:
    """Output names: prefix, field path in lower case with ``_``, number from 1."""
    return {
        path: numbered(f"{prefix}_{path.replace('.', '_').lower()}", count) for path in fields
    }


def _specs(fields: list[str], count: int, order: list[tuple[str, str]]) -> list[ArraySpec]:
    act_type = numbered("currentprincipals_disqualifications_disqualificationtype_desc", 3)
    return specs_from_maps(
        {
            ASSOCIATIONS: order,
            ACT_TYPES: [("description", "ASC"), ("dnbCode", "ASC")],
            DISQUALIFICATIONS: [("endDate", "ASC")],
        },
        {
            ASSOCIATIONS: _slots("currentprincipals_associations", fields, count),
            ACT_TYPES: {"description": act_type},
            DISQUALIFICATIONS: _slots(
                "currentprincipals_disqualifications",
                DISQUALIFICATION_FIELDS,
                DISQUALIFICATION_SLOTS,
            ),
        },
    )


def simple_specs(count: int = 21) -> list[ArraySpec]:
    """Three fields of each association, 21 associations."""
    return _specs(ASSOCIATION_FIELDS, count, SIMPLE_ORDER)


def complex_specs(count: int = 2) -> list[ArraySpec]:
    """Associations with a nested person, two of them."""
    return _specs(ASSOCIATION_FIELDS + PERSON_FIELDS, count, COMPLEX_ORDER)


def flatten_principals(df: DataFrame, specs: list[ArraySpec]) -> DataFrame:
    """One row per principal of each document."""
    return flatten_documents(df, HEADER, PRINCIPALS, "currentPrincipals", specs)
