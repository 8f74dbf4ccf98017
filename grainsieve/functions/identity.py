"""Document ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_KEY = "hash"


def document_id(key: str | None = None, text: Column | None = None) -> Column:
    """Hex sha-256 of the text for no key or ``"hash"``, else the ``meta`` field ``key``."""
    if key is None or key == HASH_KEY:
        return F.sha2(F.col("text") if text is None else text, 256)
    return F.col("meta").getField(key).cast("string")
