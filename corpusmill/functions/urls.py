"""URL quoting equal to Python's ``urllib.parse.quote(s)`` (safe='/')."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def url_quote(c: Column | str) -> Column:
    """Percent-encode UTF-8 bytes, keeping ``A-Za-z0-9_.-~`` and ``/``.

    Spark's ``url_encode`` is form encoding (space -> ``+``, keeps ``*``, encodes
    ``~`` and ``/``); four literal replacements turn it into path quoting.  A literal
    ``+`` in the input is already ``%2B`` at that point, so only spaces change."""
    c = F.col(c) if isinstance(c, str) else c
    enc = F.url_encode(c)
    for old, new in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        enc = F.replace(enc, F.lit(old), F.lit(new))
    return enc
