"""Stable hashes: the same row gets the same number on any cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_NULL_MARK = "\x00"


def key_text(columns: Sequence[str | Column]) -> Column:
    """Columns joined with ``|``; null has its own mark so it differs from ''."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit(_NULL_MARK)) for p in parts])


def key_digest(columns: Sequence[str | Column], seed: str = "") -> Column:
    """32 hex digits."""
    text = key_text(columns)
    return F.md5((F.concat(text, F.lit(f"#{seed}")) if seed else text).cast("binary"))


def digest_number(digest: Column, hex_digits: int = 8) -> Column:
    """The leading hex digits of a digest as a number."""
    return F.conv(F.substring(digest, 1, hex_digits), 16, 10).cast("bigint")


def hash_mod(columns: Sequence[str | Column], modulus: int, seed: str = "") -> Column:
    return F.pmod(digest_number(key_digest(columns, seed)), F.lit(modulus)).cast("int")
