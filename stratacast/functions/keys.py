"""Surrogate keys."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def surrogate_key(*parts: Column) -> Column:
    """md5 hex of the parts' text joined by '|'; null if any part is null."""
    texts = []
    for part in parts:
        texts += [F.lit("|"), part.cast("string")]
    return F.md5(F.concat(*texts[1:]))
