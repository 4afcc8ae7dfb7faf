"""Session helpers and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_ROWS = 10_000


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "riskweave") -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint folder).
    Only a local master may fall back to a machine-local folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="riskweave-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


_made: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; see :func:`clean_up`."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def paths_made() -> int:
    """How many paths this process has made and not removed; for :func:`clean_up`."""
    return len(_made)


def clean_up(spark: SparkSession, since: int = 0, keep: tuple[str, ...] = ()) -> int:
    """Remove what this process wrote below the shared folder, from the path
    number ``since`` on and without those in ``keep``.

    For the end of a job: tables that are still to be computed may read from
    there. Paths are deleted through Spark's file system, wherever they are.
    """
    return sum(remove(spark, p) for p in _made[since:] if p not in keep)


def remove(spark: SparkSession, path: str) -> bool:
    """Remove one path of :func:`new_path`; nothing may read from it any more."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    _made.remove(path)
    return bool(place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True))


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage,
    survives lost executors and gives the planner its true size."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A lookup table ready to be joined to a large one.

    Up to ``max_rows`` rows (checked, never assumed) it is fetched and
    broadcast, so the large side is not shuffled. A larger one is written out
    and joined without a hint: the planner sees its size and splits hot keys.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) <= max_rows:
        return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
    return materialize(df, "lookup")
