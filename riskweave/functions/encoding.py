"""Encoders and coercions as column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: category codes of the customer table ----------------------
CUSTOMER_CODES: dict[str, dict[str, int]] = {
    "FrequentFlyer": {"Yes": 1, "No": 0, "No Record": 0},
    "AnnualIncomeClass": {"Low Income": 0, "Middle Income": 1, "High Income": 2},
    "AccountSyncedToSocialMedia": {"Yes": 1, "No": 0},
    "BookedHotelOrNot": {"Yes": 0, "No": 1},
}
FLYER_CODES = {"Yes": 1, "No": 0, "yes": 1, "no": 0}
INCOME_CODES = {
    "Low Income": 0,
    "low income": 0,
    "Middle Income": 1,
    "middle income": 1,
    "High Income": 2,
    "high income": 2,
}
# ------------------------------------------------------------------------------


def map_encode(value: Column, mapping: Mapping[str, int], default: int = 0) -> Column:
    """Code of a category; null and unmapped values get ``default``."""
    if not mapping:
        return F.lit(default)
    table = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(table, value), F.lit(default)).cast("int")


def coerce_int(value: Column) -> Column:
    """Whole number of a text (fraction cut off); unreadable or null -> 0."""
    return F.coalesce(value.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))
