"""Readers and writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.utils import AnalysisException

# fixed values: the customer table
CUSTOMER_SCHEMA = (
    "Age int, FrequentFlyer string, AnnualIncomeClass string, ServicesOpted int, "
    "AccountSyncedToSocialMedia string, BookedHotelOrNot string, Target int"
)
REQUEST_NAMES = {
    "age": "Age",
    "frequent_flyer": "FrequentFlyer",
    "annual_income_class": "AnnualIncomeClass",
    "services_opted": "ServicesOpted",
    "account_synced_to_social_media": "AccountSyncedToSocialMedia",
    "booked_hotel_or_not": "BookedHotelOrNot",
}
RESULTS_SCHEMA = (
    "model_name string, accuracy double, f1_score double, roc_auc double, precision double, recall double, "
    "threshold double, best_params string"
)
SUMMARY_ROW = (
    "struct<feature:string,type:string,test:string,statistic:double,ks_statistic:double,js_divergence:double,"
    "p_value:double,drift_detected:boolean,ref_mean:double,curr_mean:double,ref_std:double,curr_std:double,"
    "threshold:double,psi:double,psi_level:string>"
)
SUMMARY_SCHEMA = (
    "timestamp string, total_features int, drift_features int, p_threshold double, psi_threshold double, "
    "max_psi double, test_size double, source string, source_label string, reference_size bigint, "
    f"current_size bigint, results array<{SUMMARY_ROW}>, alert boolean, message string"
)
DEFAULT_P_THRESHOLD = 0.05
DEFAULT_TV_THRESHOLD = 0.2
TEST_BY_TYPE = {"numeric": "Kolmogorov-Smirnov", "categorical": "Jensen-Shannon divergence"}


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: str | StructType | None = None) -> DataFrame:
    """CSV with a header; a folder or glob reads every matching file.

    Give a schema for anything large: inferring types reads the data twice.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def append_journal(encoded: DataFrame, path: str) -> None:
    """Add rows to the input journal; safe for concurrent writers."""
    encoded.write.mode("append").parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """The table, or an empty one of the schema when there is no such path."""
    try:
        reader = spark.read.schema(schema)
        if fmt == "csv":
            reader = reader.option("header", True).option("escape", '"')
        return reader.format(fmt).load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def read_journal(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return read_or_empty(spark, path, schema)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, path, RESULTS_SCHEMA, "csv")


def rename(df: DataFrame, names: dict[str, str] = REQUEST_NAMES) -> DataFrame:
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def read_summaries(spark: SparkSession, path: str) -> DataFrame:
    """Stored drift summaries of any age, one row per document."""
    return spark.read.schema(SUMMARY_SCHEMA).option("multiLine", True).json(path)


def normalize_summary_rows(rows: DataFrame, p_threshold: str = "p_threshold") -> DataFrame:
    """Fill fields that old summaries name differently or lack.

    ``rows`` has the fields of one result entry and the document's threshold.
    """
    numeric = F.col("type") == "numeric"
    return rows.withColumns(
        {
            "statistic": F.coalesce("statistic", "ks_statistic", "js_divergence"),
            "test": F.coalesce(
                F.col("test"), F.when(numeric, TEST_BY_TYPE["numeric"]).otherwise(TEST_BY_TYPE["categorical"])
            ),
            "threshold": F.coalesce(
                F.col("threshold"),
                F.when(numeric, F.coalesce(F.col(p_threshold), F.lit(DEFAULT_P_THRESHOLD))).otherwise(
                    DEFAULT_TV_THRESHOLD
                ),
            ),
        }
    ).drop("ks_statistic", "js_divergence")


def summary_rows(summaries: DataFrame) -> DataFrame:
    """One row per document and feature, normalised."""
    exploded = summaries.select("timestamp", "p_threshold", F.explode("results").alias("_r")).select(
        "timestamp", "p_threshold", "_r.*"
    )
    return normalize_summary_rows(exploded)
