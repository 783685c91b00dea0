"""Repeatable pseudo-random numbers and keys from a row's own key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def seeded_digest(key: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))


def digest_number(digest: Column, hex_digits: int) -> Column:
    """The leading hex digits as an integer; 0 where there is no digest."""
    return F.coalesce(F.conv(F.substring(digest, 1, hex_digits), 16, 10).cast("bigint"), F.lit(0).cast("bigint"))


def view_key(view: str, day: Column) -> Column:
    """The row key of a daily view: the same day gets the same key on every run."""
    return F.sha2(F.concat_ws("|", F.lit(view), F.date_format(day, "yyyy-MM-dd")), 256)
