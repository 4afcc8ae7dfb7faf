"""Registered split, sample and duplicate queries and their oracle SQL."""

from __future__ import annotations


from pyspark.sql import functions as F

from riskweave.operators import split
from riskweave.plans import views
from riskweave.plans.views import with_views
from riskweave.workload.common import rounded

KEY = ["c_custkey"]
COMBO = ["frequent", "balance_class", "has_urgent", "has_open", "n_priorities"]
SAMPLE = 700


def _customers(spark, sf):
    return views.customer_features(spark, sf)


def split_stratified(spark, sf):
    return split.stratified_split(_customers(spark, sf), KEY, "churn").select("c_custkey", "churn", "is_test")


def split_hash(spark, sf):
    return split.hash_split(_customers(spark, sf), KEY, 0.2, "42").select("c_custkey", "is_test")


def sample_n(spark, sf):
    return split.sample_n(_customers(spark, sf), KEY, SAMPLE, "7").select("c_custkey", "churn")


def sample_with_replacement(spark, sf):
    """Half as many draws again as there are customers of the table."""
    df = _customers(spark, sf).select("c_custkey", "churn")
    return split.sample_with_replacement(df, KEY, 3 * df.count() // 2, "7")


def sample_stratified(spark, sf):
    return split.sample_stratified(_customers(spark, sf), KEY, "churn", {0: 0.25, 1: 0.75}, "s").select(
        "c_custkey", "churn"
    )


def covariate_shift(spark, sf):
    df = views.customer_table(spark, sf).select("c_custkey", "Age", "FrequentFlyer", "Target")
    return split.covariate_shift(df)


def duplicate_profile(spark, sf):
    df = _customers(spark, sf).select(*COMBO, "churn")
    return split.duplicate_profile(df, COMBO)


def duplicate_lines(spark, sf):
    """Copies in the largest table: same quantity, discount, tax and flags."""
    df = views.load(spark, sf, "lineitem").select("l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    return split.duplicate_profile(df, ["l_quantity", "l_discount"])


def leakage_overlap(spark, sf):
    df = split.hash_split(_customers(spark, sf), KEY, 0.2, "42")
    features = ["n_orders", *COMBO]
    return rounded(split.leakage_overlap(df.filter("not is_test"), df.filter("is_test"), features))


def group_kfold(spark, sf):
    return split.group_folds(_customers(spark, sf), COMBO, 5).select("c_custkey", *COMBO, "fold")


def stratified_kfold(spark, sf):
    return split.stratified_folds(_customers(spark, sf), KEY, "churn", 5).select("c_custkey", "churn", "fold")


def stratified_kfold_exact(spark, sf):
    return split.stratified_folds(_customers(spark, sf), KEY, "churn", 5, exact=True).select("c_custkey", "churn", "fold")


def stratified_kfold_null_labels(spark, sf):
    """Exact folds where some labels are unknown: those rows are spread too."""
    df = _customers(spark, sf).withColumn("churn", F.when(F.col("c_custkey") % 7 != 0, F.col("churn")))
    return split.stratified_folds(df, KEY, "churn", 5, exact=True).select("c_custkey", "churn", "fold")


def union_current(spark, sf):
    df = _customers(spark, sf)
    old, new = df.filter("frequent = 'Yes'"), df.filter("has_urgent = 'Yes'")
    return split.append_rows(split.append_rows(None, old, ["c_custkey", "n_orders"]), new, ["c_custkey", "n_orders"])


QUERIES = {
    f.__name__: f
    for f in (
        split_stratified, split_hash, sample_n, sample_with_replacement, sample_stratified, covariate_shift,
        duplicate_profile, duplicate_lines, leakage_overlap, group_kfold, stratified_kfold, stratified_kfold_exact,
        stratified_kfold_null_labels,
        union_current,
    )
}

_CF = with_views(["customer_features"])
_KEY = "CAST(c_custkey AS VARCHAR)"


def _number(digest: str, digits: int = 8) -> str:
    return f"CAST('0x' || substr({digest}, 1, {digits}) AS BIGINT)"


_COMBO_SQL = ", ".join(COMBO)
_COMBO_TEXT = " || '|' || ".join(f"CAST({c} AS VARCHAR)" for c in COMBO)
_TEST = f"{_number(f'md5({_KEY} || {chr(39)}#42{chr(39)})')} % 10000 < 2000"

ORACLE = {
    "split_stratified": _CF
    + f"""SELECT c_custkey, churn, row_number() OVER (PARTITION BY churn ORDER BY md5({_KEY})) <=
            ceil(count(*) OVER (PARTITION BY churn) * 0.2::DOUBLE) AS is_test FROM customer_features""",
    "split_hash": _CF + f"SELECT c_custkey, {_TEST} AS is_test FROM customer_features",
    "sample_n": _CF + f"SELECT c_custkey, churn FROM customer_features ORDER BY md5({_KEY} || '#7') LIMIT {SAMPLE}",
    "sample_with_replacement": with_views(
        ["customer_features"],
        f"""ranked AS (SELECT c_custkey, churn, row_number() OVER (ORDER BY md5({_KEY} || '#7')) - 1 AS code FROM customer_features),
            draws AS (SELECT {_number("md5('draw' || CAST(i AS VARCHAR) || '#7')", 12)} % (SELECT count(*) FROM customer_features) AS code
                      FROM (SELECT unnest(range(3 * (SELECT count(*) FROM customer_features) // 2)) AS i))""",
    )
    + "SELECT c_custkey, churn FROM draws JOIN ranked USING (code)",
    "sample_stratified": _CF
    + f"SELECT c_custkey, churn FROM customer_features WHERE {_number(f'md5({_KEY} || {chr(39)}#s{chr(39)})')} % 10000 < "
    "CASE churn WHEN 0 THEN 2500 WHEN 1 THEN 7500 ELSE 0 END",
    "covariate_shift": with_views(["customer_table"])
    + """SELECT c_custkey, "Age" + 8 AS "Age", 'No' AS "FrequentFlyer", "Target" FROM customer_table""",
    "duplicate_profile": _CF
    + f"""SELECT (SELECT count(*) FROM customer_features) AS n_rows,
            (SELECT count(*) FROM (SELECT DISTINCT {_COMBO_SQL}, churn FROM customer_features)) AS distinct_rows,
            (SELECT count(*) FROM customer_features) - (SELECT count(*) FROM (SELECT DISTINCT {_COMBO_SQL}, churn FROM customer_features)) AS duplicate_rows,
            (SELECT count(*) FROM (SELECT DISTINCT {_COMBO_SQL} FROM customer_features)) AS distinct_features""",
    "duplicate_lines": """
        WITH d AS (SELECT l_quantity, l_discount, count(*) AS c FROM lineitem
                   GROUP BY l_quantity, l_discount, l_tax, l_returnflag, l_linestatus)
        SELECT sum(c)::BIGINT AS n_rows, count(*) AS distinct_rows, (sum(c) - count(*))::BIGINT AS duplicate_rows,
               (SELECT count(*) FROM (SELECT DISTINCT l_quantity, l_discount FROM lineitem)) AS distinct_features FROM d""",
    "leakage_overlap": with_views(
        ["customer_features"],
        f"s AS (SELECT n_orders, {_COMBO_SQL}, {_TEST} AS is_test FROM customer_features)",
    )
    + f"""SELECT count(*) AS n_test, count(*) FILTER (WHERE hit) AS n_overlap, round(count(*) FILTER (WHERE hit) / count(*)::DOUBLE, 6) AS overlap_share
          FROM (SELECT (n_orders, {_COMBO_SQL}) IN (SELECT (n_orders, {_COMBO_SQL}) FROM s WHERE NOT is_test) AS hit FROM s WHERE is_test)""",
    "group_kfold": _CF
    + f"SELECT c_custkey, {_COMBO_SQL}, {_number(f'md5({_COMBO_TEXT})')} % 5 AS fold FROM customer_features",
    "stratified_kfold": _CF + f"SELECT c_custkey, churn, {_number(f'md5({_KEY})')} % 5 AS fold FROM customer_features",
    "stratified_kfold_exact": _CF
    + f"SELECT c_custkey, churn, (row_number() OVER (PARTITION BY churn ORDER BY md5({_KEY})) - 1) % 5 AS fold FROM customer_features",
    "stratified_kfold_null_labels": _CF
    + f"SELECT c_custkey, churn, (row_number() OVER (PARTITION BY churn ORDER BY md5({_KEY})) - 1) % 5 AS fold FROM "
    "(SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 THEN churn END AS churn FROM customer_features)",
    "union_current": _CF
    + "SELECT c_custkey, n_orders FROM customer_features WHERE frequent = 'Yes' UNION ALL "
    "SELECT c_custkey, n_orders FROM customer_features WHERE has_urgent = 'Yes'",
}
