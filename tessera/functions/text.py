"""Text templates as column expressions."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F


def fill(template: str, **slots: Column) -> Column:
    """``template`` with each ``{name}`` replaced by a column."""
    pieces = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if name is not None:
            pieces.append(slots[name].cast("string"))
    return F.concat(*pieces)


def python_repr(text: Column) -> Column:
    """How Python shows a string or None, for ordinary strings."""
    quote = F.when(F.contains(text, F.lit("'")) & ~F.contains(text, F.lit('"')), F.lit('"')).otherwise(
        F.lit("'")
    )
    escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return F.when(text.isNull(), F.lit("None")).otherwise(F.concat(quote, escaped, quote))
