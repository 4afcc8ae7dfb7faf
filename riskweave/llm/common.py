"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word contracts: tab, line feed, vertical tab, form feed, carriage return, space.
NOT_SPACE = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def remainder_of(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def lower_ascii(text: Column) -> Column:
    """Lower-cases A-Z only; other letters stay as they are."""
    return F.translate(text, UPPER, UPPER.lower())


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where the table has them already (whatever their case)."""
    taken = {c.lower() for c in df.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found
