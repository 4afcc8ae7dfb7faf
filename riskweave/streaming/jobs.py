"""Structured Streaming jobs: scoring, daily counts, windowed drift, history.

Every job reads a file or table stream, keeps its progress in a checkpoint and
writes in a way that a repeated micro-batch changes nothing. Rows later than
the watermark are left out of the daily counts; they stay in the journal, so
the batch report still sees them.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from riskweave.functions.labels import PSI_FLOOR, psi_level
from riskweave.operators.drift import drift_alert, drift_summary, numeric_counts, numeric_statistics
from riskweave.session import materialize

COUNT_SCHEMA = "day string, feature string, value string, n bigint, batch_id bigint"


def read_parquet_stream(spark: SparkSession, path: str, schema: StructType, max_files: int | None = None) -> DataFrame:
    """A folder, glob or single file as a stream of its files."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def run_append(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Process all available input and append it to a parquet table."""
    query = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def score_stream(stream: DataFrame, score: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> None:
    """Score with the very function of the batch job (a projection)."""
    run_append(score(stream), path, checkpoint)


def long_features(df: DataFrame, timestamp: str, categorical: Sequence[str], edges: Mapping[str, Sequence[float]]) -> DataFrame:
    """``(ts, feature, value)``: texts as they are, numbers as their bin id."""
    parts = [f"'{c}', cast(`{c}` as string)" for c in categorical]
    for c, inner in edges.items():
        bins = " + ".join(f"cast(`{c}` >= {float(e)!r}D as int)" for e in inner) or "0"
        parts.append(f"'{c}', case when `{c}` is not null then cast({bins} as string) end")
    long = df.selectExpr(f"cast(`{timestamp}` as timestamp) as ts", f"stack({len(parts)}, {', '.join(parts)}) as (feature, value)")
    return long.filter("value is not null")


def reference_edges(reference: DataFrame, numeric: Sequence[str]) -> dict[str, list[float]]:
    """Inner decile edges of a reference sample (at most nine per feature)."""
    counts = numeric_counts(reference.select(*numeric, F.lit(True).alias("is_ref")), numeric)
    return {r["feature"]: list(r["edges"] or []) for r in numeric_statistics(counts).select("feature", "edges").collect()}


def append_batch(df: DataFrame, batch_id: int, path: str, by: Sequence[str] = ()) -> None:
    """Write one micro-batch to its own folder: a repeat replaces itself."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*by) if by else writer).parquet(f"{path}/batch_id={batch_id}")


def append_drift(report: DataFrame, run_time: str, batch_id: int, history: str, alerts: str | None = None) -> None:
    """Add the summary of a report to the history, and an alert if there is
    drift; a repeated batch replaces what it wrote before."""
    summary = materialize(drift_summary(report), "summary")  # one row; the report is computed once
    append_batch(summary.withColumn("timestamp", F.lit(run_time)), batch_id, history)
    if alerts:
        found = drift_alert(summary).filter("drift_detected")
        append_batch(found.withColumn("timestamp", F.lit(run_time)), batch_id, alerts)


def daily_counts_stream(long: DataFrame, path: str, checkpoint: str, watermark: str = "1 day") -> None:
    """Counts per day, feature and value, updated as events arrive.

    Each micro-batch stores the changed counts; :func:`daily_counts` reads the
    newest state of every window, open ones included.
    """
    counts = (
        long.withWatermark("ts", watermark)
        .groupBy(F.window("ts", "1 day").alias("w"), "feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "feature", "value", "n")
    )
    query = (
        counts.writeStream.outputMode("update")
        .foreachBatch(lambda df, batch_id: append_batch(df, batch_id, path, ["day"]))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def daily_counts(spark: SparkSession, path: str, days: Sequence[str] | None = None) -> DataFrame:
    """The newest count of each ``(day, feature, value)``; the table is laid out
    by day, so with ``days`` only their folders are read."""
    stored = spark.read.schema(COUNT_SCHEMA).parquet(path)
    if days is not None:
        stored = stored.filter(F.col("day").isin(list(days)))
    return stored.groupBy("day", "feature", "value").agg(F.max_by("n", "batch_id").alias("n"))


def daily_counts_batch(long: DataFrame) -> DataFrame:
    """The same counts over a finished table."""
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    return long.groupBy(day, "feature", "value").agg(F.count(F.lit(1)).alias("n"))


def reference_shares(long: DataFrame) -> DataFrame:
    """``(feature, value, share)`` of a reference sample in long form."""
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("_n"))
    totals = counts.groupBy("feature").agg(F.sum("_n").alias("_t"))
    # one row per feature
    return counts.join(F.broadcast(totals), "feature").select(
        "feature", "value", (F.col("_n").cast("double") / F.col("_t")).alias("share")
    )


def daily_drift(counts: DataFrame, shares: DataFrame) -> DataFrame:
    """PSI and total variation of every day against the reference shares.

    Values a day lacks are not generated: their joint term is the reference's
    total minus what the day's values account for.
    """
    floor = F.lit(PSI_FLOOR)
    r = F.greatest(F.coalesce("share", F.lit(0.0)), floor)
    c = F.greatest(F.col("n") / F.col("_t"), floor)
    absent = (floor - r) * F.ln(floor / r)
    base = shares.groupBy("feature").agg(
        F.sum((floor - F.greatest("share", floor)) * F.ln(floor / F.greatest("share", floor))).alias("_all_absent")
    )
    totals = counts.groupBy("day", "feature").agg(F.sum("n").cast("double").alias("_t"))
    joined = counts.join(totals, ["day", "feature"]).join(shares, ["feature", "value"], "left")
    known = F.col("share").isNotNull()
    share = F.coalesce("share", F.lit(0.0))
    daily = joined.groupBy("day", "feature").agg(
        F.sum("n").alias("n"),
        F.sum((c - r) * F.ln(c / r) - F.when(known, absent).otherwise(0.0)).alias("_psi"),
        F.sum(F.abs(F.col("n") / F.col("_t") - share)).alias("_l1"),
        F.sum(share).alias("_seen"),
    )
    # one row per feature
    return daily.join(F.broadcast(base), "feature").select(
        "day",
        "feature",
        "n",
        (F.col("_psi") + F.col("_all_absent")).alias("psi"),
        (0.5 * (F.col("_l1") + 1.0 - F.col("_seen"))).alias("tv_distance"),
    ).withColumn("psi_level", psi_level(F.col("psi")))


def daily_drift_stream(
    long: DataFrame, shares: DataFrame, counts_path: str, drift_path: str, checkpoint: str, watermark: str = "1 day"
) -> None:
    """Counts as in :func:`daily_counts_stream`; after each micro-batch the
    drift of the days it touched is computed from the stored counts of those
    days. The reference shares are written once and read back."""
    spark = long.sparkSession
    shares = materialize(shares, "shares")

    def after_batch(df: DataFrame, batch_id: int) -> None:
        append_batch(df, batch_id, counts_path, ["day"])
        stored = spark.read.schema(COUNT_SCHEMA).parquet(counts_path).filter(F.col("batch_id") == batch_id)
        # the days of one micro-batch: a few behind the watermark and the new ones
        days = [r["day"] for r in stored.select("day").distinct().collect()]
        append_batch(daily_drift(daily_counts(spark, counts_path, days), shares), batch_id, drift_path)

    counts = (
        long.withWatermark("ts", watermark)
        .groupBy(F.window("ts", "1 day").alias("w"), "feature", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "feature", "value", "n")
    )
    query = (
        counts.writeStream.outputMode("update")
        .foreachBatch(after_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def newest_drift(spark: SparkSession, path: str) -> DataFrame:
    """The newest drift row of each day and feature."""
    stored = spark.read.parquet(path)
    rest = [c for c in stored.columns if c not in ("day", "feature", "batch_id")]
    newest = stored.groupBy("day", "feature").agg(F.max_by(F.struct(*rest), "batch_id").alias("_r"))
    return newest.select("day", "feature", *[F.col("_r")[c].alias(c) for c in rest])
