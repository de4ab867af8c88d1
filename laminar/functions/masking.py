"""Protection of sensitive user columns before serving."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_email(c: Column | str, salt: str) -> Column:
    """SHA-256 hex digest of salt and address (NULL stays NULL). Without a secret salt the
    digest of a guessed address can be compared, so give one outside tests."""
    return F.sha2(F.concat(F.lit(salt), F.col(c) if isinstance(c, str) else c), 256)


def mask_phone(c: Column | str, keep: int = 4) -> Column:
    """All but the last ``keep`` characters replaced by ``*``; short values fully masked."""
    col = F.col(c) if isinstance(c, str) else c
    n = F.length(col)
    return F.when(n > keep, F.concat(F.repeat(F.lit("*"), n - keep), F.right(col, F.lit(keep)))) \
        .otherwise(F.repeat(F.lit("*"), n))
