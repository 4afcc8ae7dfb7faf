
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskweave.functions.encoding import CUSTOMER_CODES, map_encode

CUTOFF = "2000-08-01"
SIDE_CUTOFF = "2024-01-16"
LABEL = "churn"
NUMERIC = ["n_orders", "total_spend", "tenure_days", "recency_days", "n_priorities"]
TEXT = ["frequent", "balance_class", "has_urgent", "has_open", "c_mktsegment"]


def load(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _flag(condition: Column) -> Column:
    return F.when(condition, "Yes").otherwise("No")


def customer_features(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer with an order before the cutoff.

    Features come from the orders before the cutoff, the label from those on or
    after it; both in one aggregation over the orders.
    """
    cutoff = F.lit(CUTOFF).cast("timestamp_ntz")
    before = F.col("o_orderdate") < cutoff
    history = (
        load(spark, folder, "orders")
        .groupBy("o_custkey")
        .agg(
            F.count_if(before).alias("n_orders"),
            F.round(F.sum(F.when(before, F.col("o_totalprice"))), 2).alias("total_spend"),
            F.min(F.when(before, F.col("o_orderdate"))).alias("_first"),
            F.max(F.when(before, F.col("o_orderdate"))).alias("_last"),
            F.count_distinct(F.when(before, F.col("o_orderpriority"))).alias("n_priorities"),
            F.count_if(before & (F.col("o_orderpriority") == "1-URGENT")).alias("_urgent"),
            F.count_if(before & (F.col("o_orderstatus") == "O")).alias("_open"),
            F.count_if(~before).alias("_after"),
        )
        .filter("n_orders > 0")
    )
    customer = load(spark, folder, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    cutoff_day = F.lit(CUTOFF).cast("date")
    return customer.join(history, F.col("c_custkey") == F.col("o_custkey")).select(
        "c_custkey",
        "c_acctbal",
        "n_orders",
        "total_spend",
        F.datediff(cutoff_day, F.col("_first").cast("date")).alias("tenure_days"),
        F.datediff(cutoff_day, F.col("_last").cast("date")).alias("recency_days"),
        "n_priorities",
        _flag(F.col("n_orders") >= 9).alias("frequent"),
        F.when(F.col("c_acctbal") < 2500, "Low Income")
        .when(F.col("c_acctbal") < 7500, "Middle Income")
        .otherwise("High Income")
        .alias("balance_class"),
        _flag(F.col("_urgent") > 0).alias("has_urgent"),
        _flag(F.col("_open") > 0).alias("has_open"),
        "c_mktsegment",
        (F.col("_after") == 0).cast("int").alias(LABEL),
    )


def customer_nulls(spark: SparkSession, folder: str) -> DataFrame:
    """The same with holes: every 7th customer in numbers, every 11th in texts."""
    df = customer_features(spark, folder)
    return df.withColumns(
        {c: F.when(F.col("c_custkey") % 7 != 0, F.col(c)) for c in NUMERIC}
        | {c: F.when(F.col("c_custkey") % 11 != 0, F.col(c)) for c in TEXT}
    )


def scored_customers(spark: SparkSession, folder: str) -> DataFrame:
    z = F.col("n_orders") / F.lit(5.0) - 1 - F.col("c_acctbal") / F.lit(10000.0)
    return customer_features(spark, folder).withColumn("p", F.round(1 / (1 + F.exp(z)), 6))


def customer_table(spark: SparkSession, folder: str) -> DataFrame:
    """The customers in the columns of the churn table, with a key."""
    return customer_features(spark, folder).select(
        "c_custkey",
        F.col("tenure_days").alias("Age"),
        F.col("frequent").alias("FrequentFlyer"),
        F.col("balance_class").alias("AnnualIncomeClass"),
        F.col("n_priorities").alias("ServicesOpted"),
        F.col("has_urgent").alias("AccountSyncedToSocialMedia"),
        F.col("has_open").alias("BookedHotelOrNot"),
        F.col(LABEL).alias("Target"),
    )


def customer_codes(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the fixed category codes."""
    df = customer_table(spark, folder)
    return df.withColumns({c: map_encode(F.col(c), m) for c, m in CUSTOMER_CODES.items()})


def event_periods(spark: SparkSession, folder: str) -> DataFrame:
    """Events with the side column; the current side starts at SIDE_CUTOFF."""
    return load(spark, folder, "events").select(
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        (F.col("ts") < F.lit(SIDE_CUTOFF).cast("timestamp_ntz")).alias("is_ref"),
    )


def event_shifted(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a shifted current side."""
    current = ~F.col("is_ref")
    return event_periods(spark, folder).withColumns(
        {
            "value": F.when(current, F.col("value") * 1.5 + 8).otherwise(F.col("value")),
            "event_type": F.when(current & (F.col("event_id") % 2 == 1), "error").otherwise(F.col("event_type")),
        }
    )


def event_user(spark: SparkSession, folder: str) -> DataFrame:
    """Contacts per user in the columns of the generic cleaning job."""
    kind = F.col("event_type")
    return (
        load(spark, folder, "events")
        .groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("flight_count"),
            F.count_if(kind == "view").alias("walk_in_count"),
            F.count_if(kind == "click").alias("web_login_count"),
            F.count_if(kind == "signup").alias("mobile_app_login_count"),
            F.round(F.sum(F.when(kind == "purchase", F.col("value")).otherwise(0.0)), 2).alias("total_spending"),
            F.round(F.sum("value"), 2).alias("annual_income"),
            F.max(F.when(kind == "error", 1).otherwise(0)).alias("Target"),
        )
    )


# The same views as SQL text for the oracle.
SQL = {
    "customer_features": f"""
      customer_features AS (
        SELECT c.c_custkey, c.c_acctbal, o.n_orders, o.total_spend,
               date_diff('day', CAST(o.first_ts AS DATE), DATE '{CUTOFF}') AS tenure_days,
               date_diff('day', CAST(o.last_ts AS DATE), DATE '{CUTOFF}') AS recency_days,
               o.n_priorities,
               CASE WHEN o.n_orders >= 9 THEN 'Yes' ELSE 'No' END AS frequent,
               CASE WHEN c.c_acctbal < 2500 THEN 'Low Income' WHEN c.c_acctbal < 7500 THEN 'Middle Income'
                    ELSE 'High Income' END AS balance_class,
               CASE WHEN o.urgent > 0 THEN 'Yes' ELSE 'No' END AS has_urgent,
               CASE WHEN o.open_orders > 0 THEN 'Yes' ELSE 'No' END AS has_open,
               c.c_mktsegment,
               CASE WHEN o.after_orders = 0 THEN 1 ELSE 0 END AS churn
        FROM customer c JOIN (
          SELECT o_custkey,
                 count(*) FILTER (WHERE o_orderdate < TIMESTAMP '{CUTOFF}') AS n_orders,
                 round(sum(o_totalprice) FILTER (WHERE o_orderdate < TIMESTAMP '{CUTOFF}'), 2) AS total_spend,
                 min(o_orderdate) FILTER (WHERE o_orderdate < TIMESTAMP '{CUTOFF}') AS first_ts,
                 max(o_orderdate) FILTER (WHERE o_orderdate < TIMESTAMP '{CUTOFF}') AS last_ts,
                 count(DISTINCT o_orderpriority) FILTER (WHERE o_orderdate < TIMESTAMP '{CUTOFF}') AS n_priorities,
                 count(*) FILTER (WHERE o_orderdate < TIMESTAMP '{CUTOFF}' AND o_orderpriority = '1-URGENT') AS urgent,
                 count(*) FILTER (WHERE o_orderdate < TIMESTAMP '{CUTOFF}' AND o_orderstatus = 'O') AS open_orders,
                 count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '{CUTOFF}') AS after_orders
          FROM orders GROUP BY o_custkey) o ON o.o_custkey = c.c_custkey
        WHERE o.n_orders > 0)""",
    "customer_nulls": "customer_nulls AS (SELECT c_custkey, c_acctbal, "
    + ", ".join(f"CASE WHEN c_custkey % 7 <> 0 THEN {c} END AS {c}" for c in NUMERIC)
    + ", "
    + ", ".join(f"CASE WHEN c_custkey % 11 <> 0 THEN {c} END AS {c}" for c in TEXT)
    + ", churn FROM customer_features)",
    "scored_customers": """
      scored_customers AS (
        SELECT *, round(1 / (1 + exp(n_orders / CAST(5.0 AS DOUBLE) - 1 - c_acctbal / CAST(10000.0 AS DOUBLE))), 6) AS p
        FROM customer_features)""",
    "customer_table": """
      customer_table AS (
        SELECT c_custkey, tenure_days AS "Age", frequent AS "FrequentFlyer", balance_class AS "AnnualIncomeClass",
               n_priorities AS "ServicesOpted", has_urgent AS "AccountSyncedToSocialMedia",
               has_open AS "BookedHotelOrNot", churn AS "Target"
        FROM customer_features)""",
    "customer_codes": """
      customer_codes AS (
        SELECT c_custkey, "Age", CASE WHEN "FrequentFlyer" = 'Yes' THEN 1 ELSE 0 END AS "FrequentFlyer",
               CASE "AnnualIncomeClass" WHEN 'Middle Income' THEN 1 WHEN 'High Income' THEN 2 ELSE 0 END AS "AnnualIncomeClass",
               "ServicesOpted", CASE WHEN "AccountSyncedToSocialMedia" = 'Yes' THEN 1 ELSE 0 END AS "AccountSyncedToSocialMedia",
               CASE WHEN "BookedHotelOrNot" = 'No' THEN 1 ELSE 0 END AS "BookedHotelOrNot", "Target"
        FROM customer_table)""",
    "event_periods": f"""
      event_periods AS (
        SELECT event_id, ts, user_id, event_type, value, CAST(json_extract_string(props, '$.k') AS INT) AS k,
               ts < TIMESTAMP '{SIDE_CUTOFF}' AS is_ref
        FROM events)""",
    "event_shifted": """
      event_shifted AS (
        SELECT event_id, ts, user_id,
               CASE WHEN NOT is_ref AND event_id % 2 = 1 THEN 'error' ELSE event_type END AS event_type,
               CASE WHEN NOT is_ref THEN value * CAST(1.5 AS DOUBLE) + 8 ELSE value END AS value, k, is_ref
        FROM event_periods)""",
    "event_user": """
      event_user AS (
        SELECT user_id, count(*) AS flight_count,
               count(*) FILTER (WHERE event_type = 'view') AS walk_in_count,
               count(*) FILTER (WHERE event_type = 'click') AS web_login_count,
               count(*) FILTER (WHERE event_type = 'signup') AS mobile_app_login_count,
               round(sum(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END), 2) AS total_spending,
               round(sum(value), 2) AS annual_income,
               max(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS "Target"
        FROM events GROUP BY user_id)""",
}
_NEEDS = {
    "customer_nulls": ["customer_features"],
    "scored_customers": ["customer_features"],
    "customer_table": ["customer_features"],
    "customer_codes": ["customer_features", "customer_table"],
    "event_shifted": ["event_periods"],
}


def with_views(names: list[str], more: str = "") -> str:
    """``WITH`` clause that defines the named views and what they need."""
    order: list[str] = []
    for n in names:
        for need in [*_NEEDS.get(n, []), n]:
            if need not in order:
                order.append(need)
    parts = [SQL[n] for n in order]
    if more:
        parts.append(more)
    return "WITH " + ", ".join(parts) + "\n"
