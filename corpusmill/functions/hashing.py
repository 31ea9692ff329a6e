"""Deterministic content-hash bucket used for train / valid / test splits."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the bucket divides the first 32 bits of SHA-256 by 0xFFFFFFFF,
# so the bucket lies in [0, 1] with 1.0 reachable.
_MAX_U32 = 4294967295.0


def split_bucket(key: Column | str) -> Column:
    """``int(sha256(key utf-8).hexdigest()[:8], 16) / 0xFFFFFFFF`` as a double.

    All JVM-side: ``sha2`` gives the hex digest, ``conv`` turns the first eight hex
    digits into an integer.  Both operands are exact doubles (< 2**53), so the
    division rounds exactly like Python's true division."""
    key = F.col(key) if isinstance(key, str) else key
    head = F.substring(F.sha2(key.cast("binary"), 256), 1, 8)
    return F.conv(head, 16, 10).cast("bigint").cast("double") / F.lit(_MAX_U32)
