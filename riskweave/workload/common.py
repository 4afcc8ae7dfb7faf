"""Small helpers of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column, so that both engines agree on the last digits."""
    return df.withColumns({n: F.round(n, digits) for n, t in df.dtypes if t == "double"})
