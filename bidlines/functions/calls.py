"""Classes of model-call errors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def error_class(c: Column) -> Column:
    """``auth``, ``rate_limit``, ``not_found`` or ``other``; the first that fits. Null stays null."""
    low = F.lower(c)
    auth = F.lit(False)
    for marker in P.AUTH_MARKERS:
        auth = auth | c.contains(marker)
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(auth, "auth")
        .when(c.contains("429") | low.contains("rate limit") | low.contains("too many requests"), "rate_limit")
        .when(c.contains("404") | low.contains("not found"), "not_found")
        .otherwise("other")
    )
