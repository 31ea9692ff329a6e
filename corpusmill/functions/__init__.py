"""Column expressions.  Everything here returns a ``Column`` and stays JVM-side,
except :func:`nfc`, the one Arrow-batched Python UDF (Spark has no Unicode
normalisation built-in)."""

from corpusmill.functions.text import (  # noqa: F401
    WHITESPACE_CLASS,
    ZWSP,
    nfc,
    norm,
    row_text,
    safe_float,
    strip_ws,
    duration,
)
from corpusmill.functions.hashing import split_bucket  # noqa: F401
from corpusmill.functions.urls import url_quote  # noqa: F401
