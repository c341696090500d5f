"""The ``themes`` field of a search hit: a list, one text, or something else."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mediasignal.functions.text import sorted_set


def themes_text(themes: Column) -> Column:
    """A list gives its distinct non-empty strings, sorted and joined; a string
    gives itself; anything else gives ``""``."""
    kind = F.schema_of_variant(themes)
    items = F.filter(
        F.try_variant_get(themes, "$", "array<variant>"),
        lambda v: F.coalesce(F.schema_of_variant(v), F.lit("")) == "STRING",
    )
    texts = F.filter(F.transform(items, lambda v: v.cast("string")), lambda t: t != "")
    return F.coalesce(
        F.when(kind.startswith("ARRAY"), sorted_set(texts))
        .when(kind == "STRING", F.try_variant_get(themes, "$", "string")),
        F.lit(""),
    )
