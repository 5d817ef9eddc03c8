"""Column references that survive names holding ``:``, ``@``, ``.`` or a back-quote.

Projections over many columns are given to Spark as SQL text: one call instead
of one per column, which matters where a plan is built per micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def quoted(*parts: str) -> str:
    """SQL text for a (possibly nested) field, every part back-quoted."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def aliased(target: str, *parts: str) -> str:
    """SQL text that selects a (possibly nested) field under another name."""
    return f"{quoted(*parts)} AS {quoted(target)}"


def text_literal(text: str | None) -> str:
    """SQL text for a string value, or for a NULL string."""
    if text is None:
        return "CAST(NULL AS STRING)"
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def field(*parts: str) -> Column:
    """Column for a (possibly nested) field given by its path parts."""
    return F.col(quoted(*parts))


def column_lookup(spark: SparkSession, columns: Sequence[str]) -> Callable[[str], str | None]:
    """Return ``name -> the column it means, or None``.

    Follows the session's ``spark.sql.caseSensitive`` so that it agrees with
    what Spark itself resolves. An exact spelling wins over another case.
    """
    exact = set(columns)
    if spark.conf.get("spark.sql.caseSensitive") == "true":
        folded: dict[str, str] = {}
    else:
        folded = {name.lower(): name for name in reversed(columns)}
    return lambda name: name if name in exact else folded.get(name.lower())
