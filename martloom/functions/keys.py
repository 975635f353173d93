"""Hash surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stand-in text for a NULL part and the separator between parts.
NULL_PART = "_dbt_utils_surrogate_key_null_"
SEPARATOR = "-"


def surrogate_key(*columns: str | Column) -> Column:
    """md5 over the text of the columns; the same natural key always gives the same surrogate key."""
    parts = [F.col(c) if isinstance(c, str) else c for c in columns]
    return F.md5(F.concat_ws(SEPARATOR, *[F.coalesce(p.cast("string"), F.lit(NULL_PART)) for p in parts]))


# Stands before the bytes of a text that is no hash, so that it is longer than any hash.
NO_HASH = b"=" * 17


def packed(text: Column) -> Column:
    """A text as bytes: 16 if it is a hash as ``surrogate_key`` writes them, else its own after a mark. None are alike."""
    half = F.unhex(text)
    is_hash = (F.length(text) == 32) & (F.lower(F.hex(half)) == text)
    return F.when(is_hash, half).when(text.isNotNull(), F.concat(F.lit(NO_HASH), text.cast("binary")))


def unpacked(name: str) -> Column:
    """The text that a column of bytes was packed from."""
    return F.when(F.length(name) == 16, F.lower(F.hex(name))).otherwise(F.substring(name, len(NO_HASH) + 1, 1 << 30).cast("string"))
