"""Expressions as SQL text, for ``selectExpr``, ``expr`` and ``where``.

Text goes to Spark's parser in one call.  Building the same trees column by
column costs a round trip to the JVM per node, which for tables this wide takes
longer than planning them.
"""

from __future__ import annotations


def quoted(name: str) -> str:
    """A column by exact name, which may hold spaces or dots."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
