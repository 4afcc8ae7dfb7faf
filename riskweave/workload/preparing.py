"""Registered cleaning, encoding and feature queries and their oracle SQL."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import functions as F

from riskweave.functions.encoding import CUSTOMER_CODES, coerce_int, map_encode, safe_ratio
from riskweave.operators import features, prep, profile
from riskweave.plans import cleaning, views
from riskweave.plans.views import NUMERIC, TEXT, with_views
from riskweave.session import new_path
from riskweave.sources import tables
from riskweave.workload.common import rounded

KEY = "c_custkey"


def project_features(spark, sf):
    return views.customer_features(spark, sf).drop("churn")


def align_schema(spark, sf):
    df = views.customer_features(spark, sf)
    return features.align_schema(df, ["c_mktsegment", "n_orders", "not_there", KEY], on_missing="zero")


def rename_map(spark, sf):
    names = {"Age": "age", "FrequentFlyer": "frequent_flyer", "Target": "target", "absent": "x"}
    return tables.rename(views.customer_table(spark, sf), names)


def filter_isin(spark, sf):
    df = views.customer_features(spark, sf)
    return df.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select(KEY, "c_mktsegment", "churn")


def filter_eq(spark, sf):
    return views.customer_features(spark, sf).filter(F.col("frequent") == "Yes").select(KEY, "frequent", "churn")


def coerce_numeric(spark, sf):
    text = (
        F.when(F.col("event_id") % 3 == 0, F.col("value").cast("string"))
        .when(F.col("event_id") % 3 == 1, "n/a")
        .when(F.col("event_id") % 2 == 0, F.concat(F.lit("-"), F.get_json_object("props", "$.k")))
    )
    return views.load(spark, sf, "events").select("event_id", coerce_int(text).alias("number"))


def string_labels(spark, sf):
    words = F.split("p_type", " ")
    return views.load(spark, sf, "part").select(
        "p_partkey",
        F.concat_ws(" x ", words).alias("joined"),
        F.regexp_replace("p_name", "[_ ]", "\n").alias("wrapped"),
        F.when(F.startswith("p_type", F.lit("STANDARD")), "standard")
        .when(F.startswith("p_type", F.lit("SMALL")), "small")
        .otherwise("other")
        .alias("kind"),
        F.lower("p_brand").alias("brand"),
    )


def impute_median(spark, sf):
    df = views.customer_nulls(spark, sf).select(KEY, *NUMERIC)
    return rounded(prep.impute(df, prep.fit_medians(df, NUMERIC), {}))


def impute_mode(spark, sf):
    df = views.customer_nulls(spark, sf).select(KEY, *TEXT)
    return prep.impute(df, {}, prep.fit_modes(df, TEXT))


def clip_iqr(spark, sf):
    df = views.load(spark, sf, "events").select("event_id", "value")
    return rounded(prep.clip(df, prep.fit_clip(df, ["value", "absent"])))


def tercile_label(spark, sf):
    df = views.customer_features(spark, sf).select(KEY, "n_orders")
    return prep.with_tercile(df, "n_orders", prep.fit_terciles(df, "n_orders"), "travel_frequency_score")


def service_utilization(spark, sf):
    df = views.event_user(spark, sf).withColumn(
        "walk_in_count", F.when(F.col("user_id") % 5 != 0, F.col("walk_in_count"))
    )
    return prep.row_sum(df, [*cleaning.SERVICE_COLUMNS, "absent"], "service_utilization_rate").select(
        "user_id", "service_utilization_rate"
    )


def spending_ratio(spark, sf):
    ratio = safe_ratio(F.col("total_spending"), F.col("annual_income") + 1)
    return rounded(views.event_user(spark, sf).select("user_id", ratio.alias("spending_income_ratio")))


def encode_sorted(spark, sf):
    df = views.customer_nulls(spark, sf).select(KEY, *TEXT)
    return prep.encode_sorted(df, TEXT)[0]


def encode_first_seen(spark, sf):
    df = views.customer_nulls(spark, sf).select(KEY, *TEXT)
    return prep.encode_first_seen(df, TEXT, KEY)[0]


def encode_wide(spark, sf):
    """Codes of a text with as many values as rows: the dictionary is joined."""
    df = views.load(spark, sf, "customer").select(KEY, F.reverse("c_name").alias("c_name"))
    return prep.encode_sorted(df, ["c_name"])[0]


def encode_map(spark, sf):
    df = views.customer_table(spark, sf)
    return df.select(KEY, *[map_encode(F.col(c), m).alias(c) for c, m in CUSTOMER_CODES.items()])


def encode_unseen(spark, sf):
    """Dictionary from low-income customers, applied to everyone."""
    df = views.customer_features(spark, sf).select(KEY, "balance_class", "c_mktsegment")
    known = df.filter((F.col("balance_class") != "High Income") & (F.col("c_mktsegment") != "AUTOMOBILE"))
    cols = ["balance_class", "c_mktsegment"]
    return prep.apply_dictionary(df, prep.sorted_dictionary(known, cols), cols)


def standard_scale(spark, sf):
    df = views.customer_features(spark, sf).select(KEY, *NUMERIC)
    return rounded(prep.standard_scale(df, prep.fit_scale(df, NUMERIC)))


def _preprocessor(spark, sf):
    df = views.customer_nulls(spark, sf).drop(KEY, "c_acctbal")
    return prep.Preprocessor().fit(df, "churn")


def preprocess_fit_apply(spark, sf):
    p = _preprocessor(spark, sf)
    return rounded(p.transform(views.customer_nulls(spark, sf), keep=[KEY]))


def prep_roundtrip(spark, sf):
    path = new_path(spark, "preprocessor")
    _preprocessor(spark, sf).save(spark, path)
    loaded = prep.Preprocessor.load(spark, path)
    return rounded(loaded.transform(views.customer_nulls(spark, sf), keep=[KEY]))


def etl_generic(spark, sf):
    return rounded(cleaning.generic_cleaning(views.event_user(spark, sf), "Target", ["user_id"], write_input=True))


def etl_churn(spark, sf):
    df = views.customer_table(spark, sf)
    holed = df.withColumns(
        {
            "Age": F.when(F.col(KEY) % 7 != 0, F.col("Age")),
            "BookedHotelOrNot": F.when(F.col(KEY) % 11 != 0, F.col("BookedHotelOrNot")),
        }
    )
    return rounded(cleaning.customer_cleaning(holed, KEY, write_input=True))


def csv_roundtrip(spark, sf):
    df = views.customer_features(spark, sf)
    path = new_path(spark, "csv")
    tables.write_csv(df, path)
    return tables.read_csv(spark, path, df.schema)


def csv_glob(spark, sf):
    """Two CSV folders, read as one table by a pattern."""
    df = views.customer_features(spark, sf)
    path = new_path(spark, "csv-parts")
    for flag in ("Yes", "No"):
        tables.write_csv(df.filter(F.col("frequent") == flag), f"{path}/part-{flag}")
    return tables.read_csv(spark, f"{path}/part-*", df.schema)


def missing_table(spark, sf):
    """Rows of a journal that is there and of one that is not."""
    df = views.customer_codes(spark, sf).drop("Target")
    path = new_path(spark, "journal")
    tables.append_journal(df, path)
    schema = ", ".join(f"{n} {t}" for n, t in df.dtypes)
    found = [(name, tables.read_journal(spark, p, schema)) for name, p in (("present", path), ("missing", f"{path}-none"))]
    counted = [t.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n_rows"), F.sum("Age").alias("ages")) for name, t in found]
    return counted[0].unionByName(counted[1])


def missing_columns(spark, sf):
    """Which columns of the contract the customers have, and how filled they are."""
    return profile.required_columns(views.customer_nulls(spark, sf), [*NUMERIC, "frequent", "gender", "Target"])


def poly_powers(spark, sf):
    """Products of up to three columns, powers included."""
    df = views.customer_codes(spark, sf).select(KEY, "Age", "AnnualIncomeClass", "ServicesOpted")
    return features.Interactions(degree=3, interaction_only=False, recipe=()).fit(df, exclude=[KEY]).transform(df)


def parquet_roundtrip(spark, sf):
    df = views.customer_features(spark, sf)
    path = new_path(spark, "parquet")
    tables.write_parquet(df, path, ["balance_class"])
    return spark.read.parquet(path).select(*df.columns)


def journal_append(spark, sf):
    """Two appends, then the journal as one table."""
    df = views.customer_codes(spark, sf).drop("Target")
    path = new_path(spark, "journal")
    tables.append_journal(df.filter("FrequentFlyer = 1"), path)
    tables.append_journal(df.filter("FrequentFlyer = 0"), path)
    schema = ", ".join(f"{n} {t}" for n, t in df.dtypes)
    return tables.read_journal(spark, path, schema)


def base_features(spark, sf):
    return rounded(features.base_features(views.customer_codes(spark, sf)))


def _interactions(df):
    return features.Interactions().fit(df, exclude=[KEY, "Target"])


def poly_interactions(spark, sf):
    df = views.customer_codes(spark, sf)
    return rounded(_interactions(df).transform(df))


def poly_apply(spark, sf):
    """Fitted on the whole schema, applied to rows that lack a column."""
    df = views.customer_codes(spark, sf)
    return rounded(_interactions(df).transform(df.drop("AccountSyncedToSocialMedia", "Target")))


def poly_labels(spark, sf):
    """Mean of every interaction under its readable name."""
    df = views.customer_codes(spark, sf)
    fitted = _interactions(df)
    wide = fitted.transform(df).agg(*[F.avg(c).alias(c) for c in fitted.names])
    long = wide.unpivot([], fitted.names, "name", "mean")
    return rounded(long.join(F.broadcast(fitted.label_table(spark)), "name").select("name", "label", "mean"))


QUERIES = {
    f.__name__: f
    for f in (
        project_features, align_schema, rename_map, filter_isin, filter_eq, coerce_numeric, string_labels,
        impute_median, impute_mode, clip_iqr, tercile_label, service_utilization, spending_ratio, encode_sorted,
        encode_first_seen, encode_wide, encode_map, encode_unseen, standard_scale, preprocess_fit_apply,
        prep_roundtrip, etl_generic, etl_churn, csv_roundtrip, csv_glob, missing_table, missing_columns,
        parquet_roundtrip, journal_append, base_features, poly_powers,
        poly_interactions, poly_apply, poly_labels,
    )
}

_CF = with_views(["customer_features"])
_CN = with_views(["customer_nulls"])
_CT = with_views(["customer_table"])
_CC = with_views(["customer_codes"])
_EU = with_views(["event_user"])
_ALL = [KEY, "c_acctbal", *NUMERIC, *TEXT]


def _mode(c: str, source: str) -> str:
    return f"(SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"


def _median(c: str, source: str) -> str:
    return f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5::DOUBLE) FROM {source})"


def _sorted_codes(c: str, source: str) -> str:
    return f"SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT {c} AS v FROM {source})"


def _sorted_sql(source: str, known: str, columns: list[str], text: str) -> str:
    picks = ", ".join(f"coalesce((SELECT code FROM ({_sorted_codes(text.format(c=c), known)}) d WHERE d.v = {text.format(c='s.' + c)}), 0) AS {c}" for c in columns)
    return f"SELECT {KEY}, {picks} FROM {source} s"


def _prep_sql() -> str:
    cols = []
    for c in NUMERIC:
        filled = f"coalesce(CAST({c} AS DOUBLE), {_median(c, 'customer_nulls')})"
        cols.append(
            f"round(({filled} - (SELECT avg({c}) FROM customer_nulls)) / (SELECT coalesce(nullif(stddev_pop({c}), 0), 1) FROM customer_nulls), 6) AS {c}"
        )
    for c in TEXT:
        cols.append(
            f"coalesce((SELECT code FROM ({_sorted_codes(f"coalesce({c}, 'nan')", 'customer_nulls')}) d "
            f"WHERE d.v = coalesce(s.{c}, {_mode(c, 'customer_nulls')})), 0) AS {c}"
        )
    return _CN + f"SELECT {KEY}, {', '.join(cols)} FROM customer_nulls s"


def _clip(x: str, c: str, source: str) -> str:
    q1 = f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25::DOUBLE) FROM {source})"
    q3 = f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.75::DOUBLE) FROM {source})"
    return f"greatest({q1} - 1.5::DOUBLE * ({q3} - {q1}), least({q3} + 1.5::DOUBLE * ({q3} - {q1}), CAST({x} AS DOUBLE)))"


_BASE = (
    '"ServicesOpted" / ("Age" + 1)::DOUBLE AS services_per_age, "FrequentFlyer" * "BookedHotelOrNot" AS flyer_and_hotel, '
    '"AnnualIncomeClass" * "ServicesOpted" AS income_x_services'
)
_INPUTS = [
    "Age", "FrequentFlyer", "AnnualIncomeClass", "ServicesOpted", "AccountSyncedToSocialMedia", "BookedHotelOrNot",
    "services_per_age", "flyer_and_hotel", "income_x_services",
]
_PAIRS = [(a, b) for i, a in enumerate(_INPUTS) for b in _INPUTS[i + 1 :]]
_POLY = ", ".join(f'round(CAST("{a}" AS DOUBLE) * CAST("{b}" AS DOUBLE), 6) AS poly_{i}' for i, (a, b) in enumerate(_PAIRS))
_TERCILE = (
    "CASE WHEN {x} <= (SELECT quantile_cont({x}, 1.0::DOUBLE / 3) FROM {s}) THEN 'low' "
    "WHEN {x} <= (SELECT quantile_cont({x}, 2.0::DOUBLE / 3) FROM {s}) THEN 'medium' ELSE 'high' END"
)
_EU_DERIVED = """derived AS (SELECT *, walk_in_count + web_login_count + mobile_app_login_count AS service_utilization_rate,
                 total_spending / (annual_income + 1) AS spending_income_ratio FROM event_user)"""
_EU_CLIPPED = [
    "flight_count", "walk_in_count", "web_login_count", "mobile_app_login_count", "total_spending", "annual_income",
    "service_utilization_rate", "spending_income_ratio",
]

ORACLE = {
    "project_features": _CF + f"SELECT {', '.join(_ALL)} FROM customer_features",
    "align_schema": _CF + f"SELECT c_mktsegment, n_orders, 0 AS not_there, {KEY} FROM customer_features",
    "rename_map": _CT
    + 'SELECT c_custkey, "Age" AS age, "FrequentFlyer" AS frequent_flyer, "AnnualIncomeClass", "ServicesOpted", '
    '"AccountSyncedToSocialMedia", "BookedHotelOrNot", "Target" AS target FROM customer_table',
    "filter_isin": _CF + f"SELECT {KEY}, c_mktsegment, churn FROM customer_features WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')",
    "filter_eq": _CF + f"SELECT {KEY}, frequent, churn FROM customer_features WHERE frequent = 'Yes'",
    "coerce_numeric": "SELECT event_id, coalesce(CAST(trunc(TRY_CAST(CASE WHEN event_id % 3 = 0 THEN CAST(value AS VARCHAR) "
    "WHEN event_id % 3 = 1 THEN 'n/a' WHEN event_id % 2 = 0 THEN '-' || json_extract_string(props, '$.k') END AS DOUBLE)) AS BIGINT), 0) AS number FROM events",
    "string_labels": "SELECT p_partkey, array_to_string(string_split(p_type, ' '), ' x ') AS joined, "
    "regexp_replace(p_name, '[_ ]', chr(10), 'g') AS wrapped, CASE WHEN starts_with(p_type, 'STANDARD') THEN 'standard' "
    "WHEN starts_with(p_type, 'SMALL') THEN 'small' ELSE 'other' END AS kind, lower(p_brand) AS brand FROM part",
    "impute_median": _CN
    + f"SELECT {KEY}, "
    + ", ".join(f"round(coalesce(CAST({c} AS DOUBLE), {_median(c, 'customer_nulls')}), 6) AS {c}" for c in NUMERIC)
    + " FROM customer_nulls",
    "impute_mode": _CN
    + f"SELECT {KEY}, "
    + ", ".join(f"coalesce({c}, {_mode(c, 'customer_nulls')}) AS {c}" for c in TEXT)
    + " FROM customer_nulls",
    "clip_iqr": f"SELECT event_id, round({_clip('value', 'value', 'events')}, 6) AS value FROM events",
    "tercile_label": _CF
    + f"SELECT {KEY}, n_orders, {_TERCILE.format(x='n_orders', s='customer_features')} AS travel_frequency_score FROM customer_features",
    "service_utilization": _EU
    + "SELECT user_id, CASE WHEN user_id % 5 <> 0 THEN walk_in_count ELSE 0 END + web_login_count + mobile_app_login_count "
    "AS service_utilization_rate FROM event_user",
    "spending_ratio": _EU + "SELECT user_id, round(total_spending / (annual_income + 1), 6) AS spending_income_ratio FROM event_user",
    "encode_sorted": _CN + _sorted_sql("customer_nulls", "customer_nulls", TEXT, "coalesce({c}, 'nan')"),
    "encode_first_seen": _CN
    + f"SELECT {KEY}, "
    + ", ".join(
        f"coalesce((SELECT code FROM (SELECT v, row_number() OVER (ORDER BY f) - 1 AS code FROM (SELECT {c} AS v, min({KEY}) AS f "
        f"FROM customer_nulls WHERE {c} IS NOT NULL GROUP BY 1)) d WHERE d.v = s.{c}), 0) AS {c}"
        for c in TEXT
    )
    + " FROM customer_nulls s",
    "encode_wide": f"SELECT {KEY}, row_number() OVER (ORDER BY reverse(c_name)) - 1 AS c_name FROM customer",
    "encode_map": _CC
    + f'SELECT {KEY}, "FrequentFlyer", "AnnualIncomeClass", "AccountSyncedToSocialMedia", "BookedHotelOrNot" FROM customer_codes',
    "encode_unseen": with_views(
        ["customer_features"],
        "known AS (SELECT * FROM customer_features WHERE balance_class <> 'High Income' AND c_mktsegment <> 'AUTOMOBILE')",
    )
    + _sorted_sql("customer_features", "known", ["balance_class", "c_mktsegment"], "{c}"),
    "standard_scale": _CF
    + f"SELECT {KEY}, "
    + ", ".join(
        f"round(({c} - (SELECT avg({c}) FROM customer_features)) / (SELECT coalesce(nullif(stddev_pop({c}), 0), 1) FROM customer_features), 6) AS {c}"
        for c in NUMERIC
    )
    + " FROM customer_features",
    "preprocess_fit_apply": _prep_sql(),
    "prep_roundtrip": _prep_sql(),
    "etl_generic": with_views(["event_user"], _EU_DERIVED)
    + "SELECT user_id, "
    + ", ".join(f"round({_clip(c, c, 'derived')}, 6) AS {c}" for c in _EU_CLIPPED)
    + f', "Target", {_TERCILE.format(x="flight_count", s="derived")} AS travel_frequency_score FROM derived',
    "etl_churn": with_views(
        ["customer_table"],
        """holed AS (SELECT * REPLACE (CASE WHEN c_custkey % 7 <> 0 THEN "Age" END AS "Age",
               CASE WHEN c_custkey % 11 <> 0 THEN "BookedHotelOrNot" END AS "BookedHotelOrNot") FROM customer_table)""",
    )
    + f"""SELECT c_custkey, round(coalesce(CAST("Age" AS DOUBLE), {_median('"Age"', 'holed')}), 6) AS "Age",
           CASE WHEN "FrequentFlyer" = 'Yes' THEN 1 ELSE 0 END AS "FrequentFlyer",
           CASE "AnnualIncomeClass" WHEN 'Middle Income' THEN 1 WHEN 'High Income' THEN 2 ELSE 0 END AS "AnnualIncomeClass",
           CAST("ServicesOpted" AS DOUBLE) AS "ServicesOpted", "Target", """
    + ", ".join(
        f"(SELECT code FROM (SELECT v, row_number() OVER (ORDER BY f) - 1 AS code FROM (SELECT coalesce(\"{c}\", {_mode(chr(34) + c + chr(34), 'holed')}) AS v, "
        f"min(c_custkey) AS f FROM holed GROUP BY 1)) d WHERE d.v = coalesce(s.\"{c}\", {_mode(chr(34) + c + chr(34), 'holed')})) AS \"{c}\""
        for c in ("AccountSyncedToSocialMedia", "BookedHotelOrNot")
    )
    + " FROM holed s",
    "csv_roundtrip": _CF + f"SELECT {', '.join(_ALL)}, churn FROM customer_features",
    "csv_glob": _CF + f"SELECT {', '.join(_ALL)}, churn FROM customer_features",
    "missing_table": _CC + """SELECT 'present' AS name, count(*) AS n_rows, sum("Age")::BIGINT AS ages FROM customer_codes UNION ALL SELECT 'missing', 0, NULL""",
    "missing_columns": _CN
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {'false' if c in ('gender', 'Target') else 'true'} AS present, count(*) AS n_rows, "
        + ("count(*)" if c in ("gender", "Target") else f"count(*) - count({c})")
        + " AS n_null FROM customer_nulls"
        for c in [*NUMERIC, "frequent", "gender", "Target"]
    ),
    "poly_powers": _CC
    + 'SELECT c_custkey, "Age", "AnnualIncomeClass", "ServicesOpted", '
    + ", ".join(
        " * ".join(f'"{c}"::DOUBLE' for c in term) + f" AS poly_{i}"
        for i, term in enumerate(t for d in (2, 3) for t in combinations_with_replacement(("Age", "AnnualIncomeClass", "ServicesOpted"), d))
    )
    + " FROM customer_codes",
    "parquet_roundtrip": _CF + f"SELECT {', '.join(_ALL)}, churn FROM customer_features",
    "journal_append": _CC + 'SELECT * EXCLUDE ("Target") FROM customer_codes',
    "base_features": _CC + f"SELECT * REPLACE (round(services_per_age, 6) AS services_per_age) FROM (SELECT *, {_BASE} FROM customer_codes)",
    "poly_interactions": with_views(["customer_codes"], f"base AS (SELECT *, {_BASE} FROM customer_codes)")
    + f"SELECT * REPLACE (round(services_per_age, 6) AS services_per_age), {_POLY} FROM base",
    "poly_apply": with_views(
        ["customer_codes"],
        f'base AS (SELECT * EXCLUDE ("Target") REPLACE (0 AS "AccountSyncedToSocialMedia"), {_BASE} FROM customer_codes)',
    )
    + f"SELECT * REPLACE (round(services_per_age, 6) AS services_per_age), {_POLY} FROM base",
    "poly_labels": with_views(["customer_codes"], f"base AS (SELECT *, {_BASE} FROM customer_codes)")
    + " UNION ALL ".join(
        f"SELECT 'poly_{i}' AS name, '{a} {b}' AS label, round(avg(CAST(\"{a}\" AS DOUBLE) * CAST(\"{b}\" AS DOUBLE)), 6) AS mean FROM base"
        for i, (a, b) in enumerate(_PAIRS)
    ),
}
