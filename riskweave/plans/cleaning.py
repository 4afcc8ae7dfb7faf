"""The two cleaning jobs as compositions of operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskweave.functions.encoding import FLYER_CODES, INCOME_CODES, coerce_int, map_encode, safe_ratio
from riskweave.operators import prep
from riskweave.operators.ordered import numeric_columns, text_columns
from riskweave.session import materialize

SERVICE_COLUMNS = ("walk_in_count", "web_login_count", "mobile_app_login_count")


def clean(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Median / mode imputation of the columns that have nulls (``keep``
    untouched): one count finds them, the others keep their type."""
    lacking = prep.columns_with_nulls(df)
    numeric = [c for c in numeric_columns(df) if c in lacking and c not in keep]
    text = [c for c in text_columns(df) if c in lacking and c not in keep]
    return prep.impute(df, prep.fit_medians(df, numeric), prep.fit_modes(df, text))


def derive(df: DataFrame, tercile_cuts: tuple[float, float] | None) -> DataFrame:
    """Frequency tercile, summed service contacts and spending share of income,
    each when its inputs exist."""
    out = df
    if "flight_count" in df.columns and tercile_cuts is not None:
        out = prep.with_tercile(out, "flight_count", tercile_cuts, "travel_frequency_score")
    out = prep.row_sum(out, SERVICE_COLUMNS, "service_utilization_rate")
    if {"annual_income", "total_spending"} <= set(df.columns):
        out = out.withColumn("spending_income_ratio", safe_ratio(F.col("total_spending"), F.col("annual_income") + 1))
    return out


def generic_cleaning(df: DataFrame, label: str, keys: Sequence[str] = (), write_input: bool = False) -> DataFrame:
    """Impute, derive, clip. The label and the key columns stay as they are.

    A count of nulls and two fitting jobs whatever the number of columns:
    medians and modes, then terciles and quartiles together; the result is one
    projection. ``write_input`` writes the table once before, for an input that
    is dear to compute (not for a plain scan).
    """
    df = materialize(df, "cleaning") if write_input else df
    keep = [label, *keys]
    filled = clean(df, keep)
    unlabelled = derive(filled, None)
    columns = [c for c in numeric_columns(unlabelled) if c not in keep]
    found = prep.fit_quantiles(unlabelled, columns, [0.25, *prep.TERCILES, 0.75])
    cuts = (found["flight_count"][1], found["flight_count"][2]) if "flight_count" in found else None
    bounds = prep.bounds_from_quartiles({c: (q[0], q[3]) for c, q in found.items()})
    return prep.clip(derive(filled, cuts), bounds)


def customer_cleaning(
    df: DataFrame,
    order_key: str,
    label: str | None = "Target",
    flyer: str = "FrequentFlyer",
    income: str = "AnnualIncomeClass",
    services: str = "ServicesOpted",
    write_input: bool = False,
) -> DataFrame:
    """Impute, map the ordered categories, code the other texts by first
    appearance along ``order_key``. The label is left as it is. ``write_input``
    as in :func:`generic_cleaning`."""
    df = materialize(df, "cleaning") if write_input else df
    out = clean(df, [order_key, *([label] if label else [])])
    kinds = dict(out.dtypes)
    changes = {}
    if "Age" in kinds or flyer != "FrequentFlyer":
        if kinds.get(flyer) == "string":
            changes[flyer] = map_encode(F.col(flyer), FLYER_CODES)
    if kinds.get(income) == "string":
        changes[income] = map_encode(F.col(income), INCOME_CODES)
    if kinds.get(services) == "string":
        changes[services] = coerce_int(F.col(services))
    if changes:
        out = out.withColumns(changes)
    remaining = [c for c in text_columns(out) if c != order_key]
    if remaining:
        out, _ = prep.encode_first_seen(out, remaining, order_key)
    return out
