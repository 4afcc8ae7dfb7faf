"""Feature construction as one projection."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import combinations, combinations_with_replacement

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.operators.ordered import numeric_columns

MAX_GENERATED = 2_000


@dataclass(frozen=True)
class Ratio:
    """``numerator / (denominator + 1)``"""

    name: str
    numerator: str
    denominator: str


@dataclass(frozen=True)
class Product:
    name: str
    left: str
    right: str


# fixed values: base features of the customer table
CUSTOMER_BASE_FEATURES: tuple[Ratio | Product, ...] = (
    Ratio("services_per_age", "ServicesOpted", "Age"),
    Product("flyer_and_hotel", "FrequentFlyer", "BookedHotelOrNot"),
    Product("income_x_services", "AnnualIncomeClass", "ServicesOpted"),
)


def base_features(df: DataFrame, recipe: Sequence[Ratio | Product] = CUSTOMER_BASE_FEATURES) -> DataFrame:
    """Add each feature of ``recipe`` whose inputs exist."""
    made = []
    for item in recipe:
        if isinstance(item, Ratio) and {item.numerator, item.denominator} <= set(df.columns):
            value = F.try_divide(F.col(item.numerator).cast("double"), F.col(item.denominator).cast("double") + 1.0)
            made.append(value.alias(item.name))
        elif isinstance(item, Product) and {item.left, item.right} <= set(df.columns):
            made.append((F.col(item.left) * F.col(item.right)).alias(item.name))
    return df.select("*", *made)


def align_schema(df: DataFrame, columns: Sequence[str], on_missing: str = "error") -> DataFrame:
    """Project to a fixed column order; absent columns raise or become 0."""
    missing = [c for c in columns if c not in df.columns]
    if missing and on_missing == "error":
        raise ValueError(f"required columns are absent: {missing}")
    if on_missing not in ("error", "zero"):
        raise ValueError("on_missing is 'error' or 'zero'")
    return df.select(*[F.col(c) if c in df.columns else F.lit(0).alias(c) for c in columns])


@dataclass
class Interactions:
    """Products of numeric columns, named ``poly_0``, ``poly_1``, ...

    ``interaction_only`` leaves powers of a single column out. The fitted state
    is the ordered list of input columns, so applying it is a projection.
    """

    degree: int = 2
    interaction_only: bool = True
    recipe: Sequence[Ratio | Product] = CUSTOMER_BASE_FEATURES
    inputs: list[str] = field(default_factory=list)
    terms: list[tuple[str, ...]] = field(default_factory=list)

    def fit(self, df: DataFrame, exclude: Sequence[str] = ()) -> Interactions:
        """Fix the inputs from the schema (no job)."""
        self.inputs = numeric_columns(base_features(df, self.recipe), exclude)
        choose = combinations if self.interaction_only else combinations_with_replacement
        self.terms = []
        if len(self.inputs) >= 2:
            for d in range(2, self.degree + 1):
                self.terms += list(choose(self.inputs, d))
        if len(self.terms) > MAX_GENERATED:
            raise ValueError(f"{len(self.terms)} generated columns; limit is {MAX_GENERATED}")
        return self

    @property
    def names(self) -> list[str]:
        return [f"poly_{i}" for i in range(len(self.terms))]

    @property
    def labels(self) -> dict[str, tuple[str, ...]]:
        return dict(zip(self.names, self.terms))

    def transform(self, df: DataFrame) -> DataFrame:
        """Base features, then all products; absent inputs count as 0."""
        if not self.inputs:
            raise ValueError("not fitted")
        wide = base_features(df, self.recipe)
        absent = [c for c in self.inputs if c not in wide.columns]
        wide = wide.select("*", *[F.lit(0).alias(c) for c in absent])
        made = []
        for name, term in zip(self.names, self.terms):
            product = F.col(term[0]).cast("double")
            for c in term[1:]:
                product = product * F.col(c).cast("double")
            made.append(product.alias(name))
        return wide.select("*", *made)

    def label_table(self, spark: SparkSession) -> DataFrame:
        """``(name, label)`` with the multiplied columns joined by a space."""
        rows = [(name, " ".join(term)) for name, term in self.labels.items()]
        return spark.createDataFrame(rows, "name string, label string")
