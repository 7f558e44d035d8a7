"""Content checksums and surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def checksum(col) -> Column:
    """SHA-256 hex of the raw text (the landing manifests hash raw bytes)."""
    return F.sha2(F.col(col) if isinstance(col, str) else col, 256)


def surrogate_key(*cols) -> Column:
    """Stable 64-bit key of the natural key columns."""
    return F.xxhash64(*[F.col(c) if isinstance(c, str) else c for c in cols])
